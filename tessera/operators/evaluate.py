"""Classification metrics from a confusion table.

The only data-sized step is ``groupBy(label, prediction).count()`` (partial
aggregation on every executor); every metric comes from that tiny table.
Precision, recall and F1 are support-weighted over the classes seen in
either column; an empty denominator counts as 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import c


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``(label, prediction, n)``."""
    return df.groupBy(c(label).alias("label"), c(prediction).alias("prediction")) \
             .agg(F.count(F.lit(1)).alias("n"))


def per_class(conf: DataFrame) -> DataFrame:
    """``(class, support, predicted, tp)`` from a confusion table."""
    rows = F.array(
        F.struct(F.col("label").alias("cls"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted"),
                 F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("tp")),
        F.struct(F.col("prediction").alias("cls"), F.lit(0).cast("long").alias("support"),
                 F.col("n").alias("predicted"), F.lit(0).cast("long").alias("tp")))
    return conf.select(F.inline(rows)).groupBy("cls").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp"))


def evaluate(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``(metric, value)`` rows: accuracy and weighted precision, recall, F1."""
    pc = per_class(confusion(df, label, prediction))
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(F.lit(0.0))
    total = F.sum("support")
    agg = pc.agg(
        (F.sum("tp") / total).alias("accuracy"),
        (F.sum(F.col("support") * prec) / total).alias("precision"),
        (F.sum(F.col("support") * rec) / total).alias("recall"),
        (F.sum(F.col("support") * f1) / total).alias("f1"))
    names = ["accuracy", "precision", "recall", "f1"]
    return agg.select(F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in names])))


def metrics_dict(df: DataFrame, label: str = "label", prediction: str = "prediction") -> dict:
    """The four metrics as a small dict (four numbers reach the driver)."""
    return {r["metric"]: r["value"] for r in evaluate(df, label, prediction).collect()}
