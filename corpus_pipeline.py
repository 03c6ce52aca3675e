"""From raw documents to token digests: stages, each reread from Parquet, over all that the one before kept."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import bpe, language, minhash, mixing, secret_scan
from tessera.session import ensure_checkpoint_dir, remove
from tessera.sources.tables import table

#: SQL can state neither the learned language evidence nor BPE; tests hold the rows against brute force.
ORACLE_SQL = None
#: Similarity in hundredths from which the near-duplicates stage links documents, as its test holds it.
NEAR = 85


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language stays open go, null and empty texts among them; every column is kept, whatever its name."""
    return language.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays; texts without words all stay, of whole repeats one."""
    return minhash.keep_one(docs, link=NEAR)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live credentials are masked; every document stays, with nulls, repeats and columns as they are."""
    return secret_scan.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it; a null source is a source, ties go by all columns."""
    return mixing.sample(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids' digests of each document of the mix, one row for each copy; a null text has no tokens."""
    return bpe.round_trip(docs)


STAGES = [("languages", languages), ("near_duplicates", near_duplicates), ("secrets", secrets), ("mixing", mixture), ("bpe", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for `documents`; every stage is written to the shared folder once and read from there.

    A stage's folder goes once the next one is written, so two of them exist at most. Rows with null,
    empty or repeated values follow the stages' own rules; an empty table gives no rows.
    """
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid4().hex}"
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if last:
            remove(spark, last)
        last = f"{folder}/{name}"
    return docs
