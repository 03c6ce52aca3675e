"""Queries for ETL profiling, projections, model training, search and scoring.

`gbt_cv_eval` fits one point of its family's grid (100 trees), `gbt_leaf_leaderboard` searches one
point of the other's over five folds; the grids themselves, 72 points and more times five folds,
are the default of ``train_tabular`` and a matter for a cluster. Queries that fit a model return what SQL can state about the result.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators.clean import profile_with_nulls
from tessera.operators.models import build_model, leaderboard, load_model, score
from tessera.plans.catalog import (LINEITEM_COLS, LINEITEM_NULLS_SQL, LINEITEM_NUMERIC, LINEITEM_STRING,
                                   _union, register, rounded)
from tessera.plans.derived import documents_labelled, lineitem_with_nulls
from tessera.plans.scoring import score_requests
from tessera.operators.split import test_count
from tessera.plans.training import (holdout_metrics, split_xy, text_label, train_pipeline, train_tabular, train_text,
                                    train_text_pipeline)
from tessera.plans.queries_text import _TAB_REQ_SQL, REQUEST_SCHEMA, REQUIRED, tabular_request_text, text_request_text
from tessera.sources.requests import parse_tabular_requests, parse_text_requests
from tessera.sources.tables import table
from tessera.streaming.runs import scratch_path, staged


def _etl_profile_sql():
    parts = []
    for col in LINEITEM_COLS:
        z = f"count(*) filter (where {col} is null) as null_count"
        if col in LINEITEM_NUMERIC:
            x = f"cast({col} as double)"
            parts.append(f"select '{col}' as column_name, {z}, count({col}) as n, round(avg({x}), 6) as mean, "
                         f"round(stddev_samp({x}), 6) as stddev, round(min({x}), 6) as min_num, "
                         f"round(max({x}), 6) as max_num, cast(null as varchar) as min_str, "
                         f"cast(null as varchar) as max_str from t")
        elif col in LINEITEM_STRING:
            x = f"try_cast({col} as double)"
            parts.append(f"select '{col}' as column_name, {z}, count({col}) as n, round(avg({x}), 6) as mean, "
                         f"round(stddev_samp({x}), 6) as stddev, cast(null as double) as min_num, "
                         f"cast(null as double) as max_num, min({col}) as min_str, max({col}) as max_str from t")
        else:
            parts.append(f"select '{col}' as column_name, {z}, cast(null as bigint) as n, cast(null as double) "
                         f"as mean, cast(null as double) as stddev, cast(null as double) as min_num, "
                         f"cast(null as double) as max_num, cast(null as varchar) as min_str, "
                         f"cast(null as varchar) as max_str from t")
    return f"with t as ({LINEITEM_NULLS_SQL})\n" + _union(parts)


@register("etl_profile", _etl_profile_sql())
def q_etl_profile(spark, sf_dir):
    return rounded(profile_with_nulls(lineitem_with_nulls(spark, sf_dir)))


@register("feature_projection", "select o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority, "
          "o_orderstatus from orders")
def q_feature_projection(spark, sf_dir):
    df, _ = split_xy(table(spark, sf_dir, "orders"), "o_orderstatus")
    return df


@register("text_label_projection", "select cast(text as varchar) as text, cast(quality as integer) as label "
          "from documents left join labels using (doc_id)")
def q_text_label_projection(spark, sf_dir):
    return text_label(documents_labelled(spark, sf_dir), "text", "quality")


def _orders_training(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", "o_custkey", "o_totalprice",
                    F.dayofyear("o_orderdate").alias("o_dayofyear"),
                    (F.col("o_orderstatus") == "F").cast("int").alias("is_final"))


# One point of each family's grid.
POINT = {"n_estimators": [100], "max_depth": [3], "learning_rate": [0.1], "subsample": [1.0], "colsample_bytree": [1.0]}
LEAF_POINT = dict(POINT, max_depth=[7], num_leaves=[31])


@register("gbt_cv_eval")
def q_gbt_cv_eval(spark, sf_dir):
    _, _, scored, _ = train_tabular(_orders_training(spark, sf_dir), "o_orderkey", "is_final",
                                    ["o_totalprice", "o_custkey", "o_dayofyear"], "gbt", grid=POINT, search=False)
    return rounded(holdout_metrics(scored), 9)


@register("gbt_leaf_leaderboard")
def q_gbt_leaf_leaderboard(spark, sf_dir):
    _, _, _, cv = train_tabular(_orders_training(spark, sf_dir), "o_orderkey", "is_final",
                                ["o_totalprice", "o_custkey", "o_dayofyear"], "gbt_leaf", grid=LEAF_POINT)
    return leaderboard(spark, cv)


# Two points of the first family, with few trees (seven fits have to end in seconds).
TWO_POINTS = dict(POINT, n_estimators=[10], learning_rate=[0.1, 0.2])


@register("gbt_search_board", """with r as (select unnest(range(1, 3)) as "rank")
select "rank"::integer as "rank", 2::bigint as points, true as in_order, true as accuracy_is_a_share, "rank" = 1 as refitted from r""")
def q_gbt_search_board(spark, sf_dir):
    """A search that compares two points over three folds: the board's order, and that the best one was refitted."""
    model, _, _, cv = train_tabular(_orders_training(spark, sf_dir), "o_orderkey", "is_final",
                                    ["o_totalprice", "o_custkey", "o_dayofyear"], "gbt", grid=TWO_POINTS, folds=3)
    board = leaderboard(spark, cv)
    step = model.stages[-1].getStepSize()
    best = board.agg(F.max("mean_accuracy").alias("best"), F.countDistinct("params").alias("points"))
    return board.crossJoin(best).select(
        "rank", "points", ((F.col("rank") > 1) | (F.col("mean_accuracy") == F.col("best"))).alias("in_order"),
        F.col("mean_accuracy").between(0, 1).alias("accuracy_is_a_share"), F.col("params").contains(f"stepSize={step}").alias("refitted"))


_TEST_ROWS_SQL = "cast(ceil(0.2 * count(*)) as bigint)"


def _saved_run(spark, registry, kind, metrics, data, score_with):
    """Facts of a pipeline run: what was saved, and that the reloaded model answers every row."""
    model, features, stored = load_model(spark, registry, model_type=kind)
    answered = score_with(model).where(F.col("prediction").isin(0, 1)).count()
    return spark.createDataFrame(
        [(kind, len(features), sorted(stored) == sorted(metrics), answered, test_count(data, 0.2))],
        "model_type string, n_features int, metrics_stored boolean, answered long, test_rows long")


@register("tabular_pipeline", f"select 'gbt' as model_type, 3::integer as n_features, true as metrics_stored, "
                              f"count(*) as answered, {_TEST_ROWS_SQL} as test_rows from orders")
def q_tabular_pipeline(spark, sf_dir):
    base = scratch_path(spark, "tabular-pipeline")
    _orders_training(spark, sf_dir).write.parquet(f"{base}/train.parquet")
    feats = ["o_totalprice", "o_custkey", "o_dayofyear"]
    _, metrics = train_pipeline(spark, f"{base}/train.parquet", "o_orderkey", "is_final", f"{base}/models", feats,
                                "gbt", grid=dict(POINT, n_estimators=[20]))
    data = spark.read.parquet(f"{base}/train.parquet")
    return _saved_run(spark, f"{base}/models", "gbt", metrics, data.count(), lambda m: score(m, data))


@register("text_pipeline", f"select 'text_classifier' as model_type, 1::integer as n_features, true as metrics_stored, "
                           f"count(*) as answered, {_TEST_ROWS_SQL} as test_rows from documents join labels using (doc_id)")
def q_text_pipeline(spark, sf_dir):
    base = scratch_path(spark, "text-pipeline")
    documents_labelled(spark, sf_dir, "inner").write.parquet(f"{base}/train.parquet")
    _, metrics = train_text_pipeline(spark, f"{base}/train.parquet", "doc_id", "text", "quality", f"{base}/models")
    data = spark.read.parquet(f"{base}/train.parquet")
    return _saved_run(spark, f"{base}/models", "text_classifier", metrics, data.count(), lambda m: score(m, data))


@register("text_model_eval")
def q_text_model_eval(spark, sf_dir):
    docs = documents_labelled(spark, sf_dir, "inner")
    _, scored = train_text(docs, "doc_id", "text", "quality")
    return rounded(holdout_metrics(scored), 9)


@register("request_scoring", f"""select request_id, pos, status, error,
  case when status = 'ok' then true end as has_class, case when status = 'ok' then true end as has_confidence
from ({_TAB_REQ_SQL})""")
def q_request_scoring(spark, sf_dir):
    # parsed once, for the fit and for the answers
    req = staged(parse_tabular_requests(tabular_request_text(table(spark, sf_dir, "events")), "body",
                                        REQUEST_SCHEMA, REQUIRED), "scoring-requests")
    feats = ["feature1", "feature2"]
    hist = (req.where((F.col("status") == "ok") & F.col("feature2").isNotNull() & F.col("feature3").isNotNull())
               .withColumn("label", (F.col("feature3") == "purchase").cast("int")))
    pipe = build_model("gbt", feats, "label")
    gbt = pipe.getStages()[-1]
    model = pipe.fit(hist, {gbt.maxIter: 100, gbt.maxDepth: 3})
    return _facts(score_requests(model, req, feats), "request_id", "pos")


def _facts(scored, *ids):
    """What holds of every answer whatever the fit: a class of the two, a confidence of half at least."""
    return scored.select(*ids, "status", "error", F.col("prediction").isin(0, 1).alias("has_class"),
                         F.col("confidence").between(0.5, 1).alias("has_confidence"))


@register("text_scoring", """with r as (select doc_id as request_id, not (doc_id % 7 = 3 or doc_id % 5 = 4) as ok from documents)
select request_id, case when ok then 'ok' else 'rejected' end as status,
       case when not ok then 'Request must contain "text" field' end as error,
       case when ok then true end as has_class, case when ok then true end as has_confidence from r""")
def q_text_scoring(spark, sf_dir):
    """Request text to prediction and confidence: parse, the text model, the answers."""
    docs = documents_labelled(spark, sf_dir, "inner")
    model, _ = train_text(docs, "doc_id", "text", "quality")
    req = parse_text_requests(text_request_text(table(spark, sf_dir, "documents")), "body")
    return _facts(score_requests(model, req, ["text"], ("request_id",)), "request_id")
