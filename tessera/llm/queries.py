"""The registered queries of the corpus operators, over whole tables, and the SQL of those that SQL can state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, language, lexical, minhash, mixing, phrases, quality, quality_rules, secret_scan, spotsigs, suffix_dedup, topk, toxicity
from tessera.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f
    return add


@_query("op1_suffix_dedup")
def op1(spark, sf_dir):
    return suffix_dedup.cut(table(spark, sf_dir, "documents"))


@_query("op2_minhash")
def op2(spark, sf_dir):
    return minhash.near(table(spark, sf_dir, "documents")).drop("text_key")


@_query("op3_spotsigs")
def op3(spark, sf_dir):
    return spotsigs.against_edited_and_next(table(spark, sf_dir, "documents"))


@_query("op4_secret_scan", secret_scan.SCAN_SQL)
def op4(spark, sf_dir):
    return secret_scan.scan(table(spark, sf_dir, "documents"))


@_query("op5_toxicity")
def op5(spark, sf_dir):
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query("op6_mixing", mixing.MIX_SQL)
def op6(spark, sf_dir):
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("repeats")).alias("taken"))


@_query("op7_language")
def op7(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    items = language.from_documents(docs).unionByName(language.from_pages(table(spark, sf_dir, "pages")))
    return language.identify(items, language.train_on(docs)).drop("text_key")


@_query("op8_quality")
def op8(spark, sf_dir):
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query("op9_topk", """with v as (select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as e
    from embeddings where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
q as (select distinct * from v where vec_id % 100 = 0),
s as (select q.vec_id as query_id, v.vec_id, cast(list_sum(list_transform(list_zip(q.e, v.e), lambda z: z[1] * z[2])) as bigint) as score
    from q join v on q.vec_id <> v.vec_id and len(q.e) = len(v.e)),
r as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from s)
select query_id, rank, vec_id, score from r where rank <= 10""")
def op9(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


@_query("op10_bpe")
def op10(spark, sf_dir):
    return bpe.round_trip(table(spark, sf_dir, "documents"))


@_query("op11_lexical_search", lexical.RANK_SQL)
def op11(spark, sf_dir):
    return lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query("op12_quality_rules")
def op12(spark, sf_dir):
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query("op13_phrases", phrases.MINE_SQL)
def op13(spark, sf_dir):
    return phrases.mine(table(spark, sf_dir, "documents"))
