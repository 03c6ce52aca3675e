"""Secret scans with corpus-wide ownership frequency, in DataFrame functions only.

Candidates are found by pattern in every whole text. Their hashes are counted over the corpus
by distinct repositories and owners: a value that many owners hold is a copied example; one that
a single owner holds in few repositories, and that looks random, is taken for a live credential.
Live ones get a span of their own kind beside the base spans.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.columns import quote
from tessera.llm.common import checkpointed, row_key

#: The kinds in their listed order, and the least length of what counts (see _KINDS).
KINDS = ("assign", "access", "hex", "live")
WORDS = ("password", "passwd", "secret", "token", "api_?key")


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


ASSIGN = ("(" + "|".join(map(_either_case, WORDS)) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
#: kind -> pattern, the group that must be long enough counted in the pattern itself (0: all), that length.
_KINDS = {"assign": (ASSIGN, 2, 6), "access": ("AKIA[A-Z0-9]+", 0, 20), "hex": ("[0-9a-f]+", 0, 24)}
#: A run of hex digits is matched whole, so asking for its length at once finds the same spans.
_FAST = {"hex": "[0-9a-f]{24,}"}
#: Plain strings one of which a text needs for a match, in lower case; far cheaper to look for than the pattern.
_NEEDS = {"assign": ("password", "passwd", "secret", "token", "apikey", "api_key"), "access": ("akia",), "hex": ("",)}


def _found(kind: str):
    """Array of every match: its number, the length from the last match's end, its own length, its value."""
    pattern, group, _ = _KINDS[kind]
    pattern, text = _FAST.get(kind, pattern), F.col("text")
    # \G ties a match to the end of the one before, so a text is passed once
    each = F.lit(rf"(?s)\G(.*?)({pattern})")
    got = F.arrays_zip(F.regexp_extract_all(text, each, F.lit(0)).alias("whole"),
                       F.regexp_extract_all(text, each, F.lit(2)).alias("match"),
                       F.regexp_extract_all(text, each, F.lit(group + 2)).alias("value"))
    rows = F.transform(got, lambda x, i: F.struct(
        F.lit(KINDS.index(kind)).alias("kind"), i.alias("i"), F.length(x["whole"]).alias("step"),
        F.length(x["match"]).alias("length"), x["value"].alias("value")))
    needs = [F.col("lower").contains(w) for w in _NEEDS[kind] if w]
    return F.when(reduce(Column.__or__, needs, F.lit(not needs)), F.when(text.rlike(pattern), rows))


def _list(spans, kinds: int):
    """``kind:start:end`` of the spans of the first kinds, by start and then kind."""
    names = F.array(*[F.lit(k) for k in KINDS])
    kept = F.sort_array(F.filter(spans, lambda x: x["kind"] < kinds))
    return F.concat_ws(",", F.transform(kept, lambda x: F.concat_ws(
        ":", F.try_element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))))


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo_col: str = "doc_id",
          owner_col: str = "source", max_owners: int = 1, max_repos: int = 3, min_length: int = 16,
          min_distinct: int = 8) -> DataFrame:
    """``doc_id, text_key, kind, start, end, value``: each base span, and a live one beside it where due.

    Offsets are code points, end exclusive. Live: held by at most ``max_owners`` owners in at most
    ``max_repos`` repositories each row of which is counted once, at least ``min_length`` characters
    with a digit and ``min_distinct`` different ones. A null repository or owner is one of its own.
    Rows alike in id and text give their spans once.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(repo_col).cast("string").alias("repo"),
                       F.col(owner_col).cast("string").alias("owner"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    none = F.array().cast("array<struct<kind:int,i:int,step:int,length:int,value:string>>")
    found = F.concat(*[F.coalesce(_found(k), none) for k in _KINDS])
    rows = rows.withColumn("lower", F.lower("text"))
    hits = (rows.select("doc_id", "repo", "owner", row_key(F.col("text")).alias("text_key"), found.alias("found"))
            .select("doc_id", "repo", "owner", "text_key", F.explode("found").alias("f")).select("*", "f.*").drop("f"))
    hits = checkpointed(hits.withColumn("value_hash", F.md5("value")))  # the patterns run once over the texts
    here = Window.partitionBy("doc_id", "text_key", "kind").orderBy("i")
    end = F.sum("step").over(here)
    least = F.try_element_at(F.array(*[F.lit(n) for _, _, n in _KINDS.values()]), F.col("kind") + 1)
    base = (hits.drop("repo", "owner").distinct().withColumn("end", end)
            .where(F.length("value") >= least)
            .select("doc_id", "text_key", "kind", (F.col("end") - F.col("length")).alias("start"), "end", "value",
                    "value_hash"))
    counted = (hits.where(F.length("value") >= least).groupBy("value_hash", "owner", "repo")
               .agg(F.first("value").alias("value")).groupBy("value_hash", "owner")
               .agg(F.count(F.lit(1)).alias("repos"), F.first("value").alias("value")).groupBy("value_hash")
               .agg(F.count(F.lit(1)).alias("owners"), F.sum("repos").alias("repos"), F.first("value").alias("value")))
    letters = F.size(F.array_distinct(F.split("value", "")))
    live = counted.where((F.col("owners") <= max_owners) & (F.col("repos") <= max_repos)
                         & (F.length("value") >= min_length) & (letters >= min_distinct)
                         & F.col("value").rlike("[0-9]")).select("value_hash")
    own = base.join(live, "value_hash", "left_semi").withColumn("kind", F.lit(KINDS.index("live")))
    return base.unionByName(own).drop("value_hash")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Digest per row: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live``.

    A null or empty text and one without candidates have zero counts and empty lists; null ids
    and repeated rows keep their rows; other columns may have any name.
    """
    by_row = spans(docs, id_col, text_col, **options).groupBy("doc_id", "text_key").agg(
        F.collect_list(F.struct("start", "kind", "end")).alias("found"))
    all_rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                           row_key(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("text_key"))
    r, s = all_rows.alias("r"), by_row.alias("s")
    joined = r.join(s, F.col("r.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("r.text_key") == F.col("s.text_key")),
                    "left").select("r.doc_id", F.coalesce("found", F.array().cast(by_row.schema["found"].dataType)).alias("found"))
    count = lambda k: F.size(F.filter("found", lambda x: x["kind"] == KINDS.index(k))).cast("long").alias(f"n_{k}")
    return joined.select("doc_id", count("assign"), count("access"), count("hex"),
                         F.sha2(_list(F.col("found"), 3), 256).alias("base_sha256"),
                         _list(F.col("found"), 4).alias("spans"), count("live"))


def redact(docs: DataFrame, mark: str = "[secret]", id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with every live value replaced by ``mark`` in the texts that hold it; copied examples stay.

    Longer values go first, equally long ones by code point. A null or empty text stays as it is, null
    ids and repeated rows keep their rows, columns keep their order and may have any name (dots
    and names of this operator's own columns included). An empty table stays empty.
    """
    live = (spans(docs, id_col, text_col, **options).where(F.col("kind") == KINDS.index("live"))
            .groupBy("doc_id", "text_key").agg(F.collect_set("value").alias("values")))
    d_col = lambda name: F.col(f"d.{quote(name)}")
    text = d_col(text_col)
    longest = F.array_sort(F.coalesce("s.values", F.array().cast("array<string>")),
                           lambda a, b: F.when(F.length(a) != F.length(b), F.length(b) - F.length(a))
                           .when(a < b, -1).when(a > b, 1).otherwise(0))
    clean = F.aggregate(longest, text, lambda t, v: F.replace(t, v, F.lit(mark)))
    d = docs.alias("d").join(live.alias("s"), d_col(id_col).cast("long").eqNullSafe(F.col("s.doc_id"))
                             & (row_key(F.coalesce(text, F.lit(""))) == F.col("s.text_key")), "left")
    return d.select(*[clean.alias(c) if c == text_col else d_col(c) for c in docs.columns])


def _kind_sql(kind: str) -> str:
    pattern, group, least = _KINDS[kind]
    each = "(?s)(.*?)(" + pattern.replace("'", "''") + ")"
    part = lambda g: f"regexp_extract_all(t, '{each}', {g})"
    return (f"select r, {KINDS.index(kind)} as kind, unnest(range(1, len({part(0)}) + 1)) as i, "
            f"unnest({part(0)}) as whole, unnest({part(2)}) as m, unnest({part(group + 2)}) as v from d "
            f"where regexp_matches(t, '{pattern.replace(chr(39), chr(39) * 2)}')")


SCAN_SQL = f"""with d as materialized (select row_number() over () as r, doc_id, source, coalesce(text, '') as t from documents),
h as ({' union all '.join(_kind_sql(k) for k in _KINDS)}),
p as (select r, kind, v, length(m) as n, sum(length(whole)) over (partition by r, kind order by i) as e from h),
b as (select r, kind, cast(e - n as bigint) as s, cast(e as bigint) as e, v from p
    where length(v) >= [6, 20, 24][kind + 1]),
f as (select v from b join d using (r) group by v having count(distinct coalesce(source, '<null>')) <= 1
    and count(distinct (coalesce(source, '<null>'), coalesce(doc_id, -1))) <= 3
    and length(v) >= 16 and len(list_distinct(string_split(v, ''))) >= 8 and regexp_matches(v, '[0-9]')),
a as (select r, kind, s, e from b union all select r, 3, s, e from b where v in (select v from f)),
g as (select r, count(*) filter (kind = 0) as n_assign, count(*) filter (kind = 1) as n_access,
    count(*) filter (kind = 2) as n_hex, count(*) filter (kind = 3) as n_live,
    string_agg(['assign', 'access', 'hex'][kind + 1] || ':' || s || ':' || e, ',' order by s, kind) filter (kind < 3) as base,
    string_agg(['assign', 'access', 'hex', 'live'][kind + 1] || ':' || s || ':' || e, ',' order by s, kind, e) as spans
    from a group by r)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
    sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans, coalesce(n_live, 0) as n_live
from d left join g using (r)"""
