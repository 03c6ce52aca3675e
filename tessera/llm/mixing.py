"""Mixing sources to target weights by capped water-filling, in DataFrame functions only.

Sources get words in proportion to their weights; one whose share passes ``max_epochs`` times
its size stops there, and what it leaves is shared again by weight. The fixed point of that
resharing is a water level: with sources ordered by cap per weight, the level is (wanted words
less the caps of those before) / (weights from here on) at the first source that it does not
reach over. A target is met by whole repetitions of the source and a seeded order of its
documents, of which the first ones are repeated once more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.columns import c
from tessera.llm.common import WORD

#: Leading hex digits of the seeded hash that name a block of documents; blocks are summed first.
BLOCK_DIGITS = 3


def targets(sizes: DataFrame, weights=(5, 2, 1), share: float = 1.5, max_epochs: int = 2) -> DataFrame:
    """``source, source_size, target`` from one row ``source, source_size`` for each source.

    Sources by code point, null last, take the weights in turn. If the share passes
    ``max_epochs``, every source stops at its cap.
    """
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    place = F.row_number().over(by_name)
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), ((place - 1) % len(weights) + 1).cast("int"))
    s = sizes.withColumn("weight", w).withColumn("cap", F.col("source_size") * max_epochs)
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.asc_nulls_last("source"))
    everything = by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = (s.withColumn("wanted", F.lit(share) * F.sum("source_size").over(everything))
         .withColumn("full", F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, 0)) - F.col("cap"))
         .withColumn("open", F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing)))
         .withColumn("level", (F.col("wanted") - F.col("full")) / F.col("open"))
         .withColumn("under", F.col("level") * F.col("weight") <= F.col("cap")))
    first = F.min(F.when(F.col("under"), F.struct("full", F.negative("open").alias("o"), "level"))).over(everything)
    level = first["level"]
    return s.withColumn("water", level).select(
        "source", "source_size",
        F.when(F.col("water").isNull(), F.col("cap").cast("double"))
        .otherwise(F.least(F.col("water") * F.col("weight"), F.col("cap").cast("double"))).alias("target"))


def mix(docs: DataFrame, carry=("doc_id",), id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", weights=(5, 2, 1), share: float = 1.5, max_epochs: int = 2,
        seed: int = 0) -> DataFrame:
    """``row`` (struct of the carried columns), ``size, source, source_size, target, repeats``.

    ``size`` counts the text's words (null: 0). ``repeats`` is how often the mix holds the row.
    A source's taken words miss its target by half a document at most. The order of documents
    depends on seed, id and text alone, so reruns agree; repeated rows stand side by side in it.
    An empty table gives an empty mix; a null source is a source; other columns may have any name.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    name = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("")), text)
    rows = docs.select(F.struct(*map(c, carry)).alias("row"), F.col(source_col).alias("source"),
                       F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), F.md5(name).alias("h"),
                       F.col(text_col).isNull().alias("void"))
    # rows alike in id and text are told apart by what else they carry
    rest = [x for x in carry if x not in (id_col, text_col)]
    rows = rows.withColumn("tie", F.to_json(F.struct(*[F.col("row")[x].alias(x) for x in rest])) if rest else F.lit(""))
    rows = rows.withColumn("block", F.substring("h", 1, BLOCK_DIGITS))
    blocks = rows.groupBy("source", "block").agg(F.sum("size").alias("block_size"))
    goal = targets(blocks.groupBy("source").agg(F.sum("block_size").alias("source_size")), weights, share, max_epochs)
    goal = goal.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                           .otherwise(F.lit(0)).cast("long"))
    goal = goal.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    before = F.sum("block_size").over(Window.partitionBy("source").orderBy("block")) - F.col("block_size")
    placed = blocks.withColumn("before", before)
    g, b = goal.alias("g"), placed.alias("b")
    plan = b.join(g, F.col("b.source").eqNullSafe(F.col("g.source"))).select(
        F.col("b.source").alias("s"), F.col("b.block").alias("k"), "before", "source_size", "target", "whole", "rest")
    joined = rows.join(plan, rows.source.eqNullSafe(plan.s) & (rows.block == plan.k)).drop("s", "k")
    inner = Window.partitionBy("source", "block").orderBy("h", "size", "void", "tie").rowsBetween(Window.unboundedPreceding, 0)
    start = F.col("before") + F.sum("size").over(inner) - F.col("size")
    extra = (start + F.col("size") / 2 <= F.col("rest")).cast("long")
    return joined.withColumn("repeats", F.col("whole") + extra).select(
        "row", "size", "source", "source_size", "target",
        F.when(F.col("whole") >= max_epochs, F.lit(max_epochs).cast("long")).otherwise(F.col("repeats")).alias("repeats"))


def sample(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of ``docs`` with all their columns, each as often as it is taken.

    Null and empty texts have no words and come along where the order puts them. Of rows alike in id
    and text, the first by their other columns (as JSON) is taken once more first. Column names, repeats and empty tables: as in :func:`mix`.
    """
    mixed = mix(docs, carry=tuple(docs.columns), **options)
    copies = F.array_repeat(F.lit(0), F.col("repeats").cast("int"))
    return mixed.withColumn("copy", F.explode(copies)).select("row.*")


#: DuckDB SQL for the query on `documents`: the same level from the sorted sources, the same seeded order.
MIX_SQL = r"""with d as (select doc_id, source,
    cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size,
    md5('0:' || coalesce(cast(doc_id as varchar), '') || ':' || coalesce(text, '')) as h from documents),
s as (select source, cast(sum(size) as bigint) as source_size,
    [5, 2, 1][(row_number() over (order by source nulls last) - 1) % 3 + 1] as weight from d group by source),
o as (select *, 1.5::double * (select cast(sum(source_size) as bigint) from s) as wanted,
    cast(coalesce(sum(2 * source_size) over (order by 2 * source_size / weight, source nulls last
        rows between unbounded preceding and 1 preceding), 0) as bigint) as filled,
    cast(sum(weight) over (order by 2 * source_size / weight, source nulls last
        rows between current row and unbounded following) as bigint) as open_w,
    row_number() over (order by 2 * source_size / weight, source nulls last) as place from s),
l as (select (wanted - filled) / open_w as level from o
    where (wanted - filled) / open_w * weight <= 2 * source_size order by place limit 1),
t as (select source, source_size, least((select level from l) * weight, cast(2 * source_size as double)) as target from o),
w as (select *, case when source_size > 0 then cast(floor(target / source_size) as bigint) else 0 end as whole from t),
c as (select d.doc_id, d.size, w.source_size, w.target, w.whole,
    sum(d.size) over (partition by d.source order by h, d.size rows between unbounded preceding and current row)
        - d.size + d.size / 2.0::double <= w.target - w.whole * w.source_size as extra
    from d join w on d.source is not distinct from w.source)
select doc_id, size, source_size, target,
    cast(size * (case when whole >= 2 then 2 else whole + extra::int end) as bigint) as taken from c"""
