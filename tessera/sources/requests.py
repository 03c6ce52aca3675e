"""Prediction requests held as JSON text, parsed into rows (and rejects)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import c


def parse_tabular_requests(df: DataFrame, json_col: str, schema: str, required: list[str],
                           id_col: str = "request_id") -> DataFrame:
    """One row per record of each request; ``status`` ok | rejected | malformed.

    A request is a JSON object (one record) or a list of objects. Features
    are the union of keys over the request's records; any required name
    missing from that union rejects the whole request (one row, ``pos``
    null, ``error`` naming the missing features in required order). A record
    lacking a key its sibling has is still scored, with a null value.
    """
    text = F.trim(c(json_col))
    as_list = F.when(text.startswith("{"), F.concat(F.lit("["), text, F.lit("]"))).otherwise(text)
    raw = F.from_json(as_list, "array<string>")
    req = F.array(*[F.lit(r) for r in required])
    d = df.select(c(id_col).alias(id_col), raw.alias("__raw"),
                  F.from_json(as_list, f"array<struct<{schema}>>").alias("__rec"))
    keys = F.array_distinct(F.flatten(F.transform("__raw", lambda e: F.coalesce(
        F.json_object_keys(e), F.array().cast("array<string>")))))
    d = d.withColumn("__missing", F.array_except(req, keys))
    bad_shape = F.col("__raw").isNull() | F.exists("__raw", lambda e: F.json_object_keys(e).isNull())
    status = (F.when(bad_shape, F.lit("malformed"))
               .when(F.size("__missing") > 0, F.lit("rejected"))
               .otherwise(F.lit("ok")))
    d = d.withColumn("status", status)
    err = (F.when(F.col("status") == "malformed", F.lit("Request must be a JSON object or list of objects"))
            .when(F.col("status") == "rejected",
                  F.concat(F.lit("Missing features: "), F.array_join("__missing", ", "))))
    d = d.withColumn("error", err)
    # one generator for both outcomes: records of good requests, a single
    # all-null record for rejected and malformed ones (no second pass)
    rec_type = d.schema["__rec"].dataType
    none = F.array(F.lit(None).cast(rec_type.elementType))
    recs = F.when(F.col("status") == "ok", F.col("__rec")).otherwise(none)
    out = d.select(id_col, "status", "error", F.posexplode(recs).alias("__pos", "__r"))
    fields = [f.name for f in rec_type.elementType.fields]
    return out.select(id_col, F.when(F.col("status") == "ok", F.col("__pos")).alias("pos"),
                      *[F.col("__r")[f].alias(f) for f in fields], "status", "error")


def parse_text_requests(df: DataFrame, json_col: str, id_col: str = "request_id") -> DataFrame:
    """``(request_id, text, status, error)``: the request must be an object with ``text``."""
    j = c(json_col)
    keys = F.json_object_keys(j)
    has_text = F.coalesce(F.array_contains(keys, "text"), F.lit(False))
    text = F.get_json_object(j, "$.text")
    return df.select(
        c(id_col).alias(id_col),
        F.when(has_text, text).alias("text"),
        F.when(has_text, F.lit("ok")).otherwise(F.lit("rejected")).alias("status"),
        F.when(~has_text, F.lit('Request must contain "text" field')).alias("error"))
