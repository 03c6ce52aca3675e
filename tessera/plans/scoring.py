"""Batch scoring of parsed requests: feature check, prediction, probabilities."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.arrays import confidence
from tessera.functions.columns import c
from tessera.operators.clean import fill_missing
from tessera.operators.models import score


def missing_features(df: DataFrame, required: list[str]) -> list[str]:
    """Required names absent from a table's columns, in required order."""
    return [f for f in required if f not in df.columns]


def score_requests(model: PipelineModel, requests: DataFrame, features: list[str],
                   id_cols: tuple[str, ...] = ("request_id", "pos")) -> DataFrame:
    """Score ``status = 'ok'`` rows with the model's feature order.

    Records that lack a value their sibling has are filled with 0 first
    (the model has no missing-value handling). Rejected and malformed
    requests pass through with their error and no prediction.
    """
    missing = missing_features(requests, features)
    if missing:
        raise ValueError(f"Missing features: {missing}")
    ok = requests.where(F.col("status") == "ok")
    x = fill_missing(ok.select(*[c(i) for i in id_cols], *[c(f) for f in features]))
    scored = score(model, x, keep=list(id_cols))
    scored = scored.withColumn("confidence", confidence(F.col("probability")))
    rejects = requests.where(F.col("status") != "ok").select(
        *[c(i) for i in id_cols], F.lit(None).cast("int").alias("prediction"),
        F.lit(None).cast("array<double>").alias("probability"), F.lit(None).cast("double").alias("confidence"),
        "status", "error")
    return scored.withColumns({"status": F.lit("ok"), "error": F.lit(None).cast("string")}).unionByName(rejects)
