import tempfile
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tessera.operators.quality import check_missing
from tessera.operators.timeseries import rate
from tessera.streaming.quality import stream_quality
from tessera.streaming.rates import stream_rate
from tessera.streaming.runs import drain

T0 = datetime(2024, 1, 1)


def test_stream_rate_equals_batch_for_final_windows(spark):
    base = tempfile.mkdtemp(prefix="tessera-stream-")
    rows = [("a", T0 + timedelta(seconds=37 * i), float(i % 50)) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, value double")
    df.write.parquet(f"{base}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{base}/in")
    out = drain(stream_rate(stream, ["k"], 300, 60, watermark="10 minutes"), f"{base}/out", f"{base}/ck")
    got = {(r["t"], round(r["value"], 9)) for r in out.collect()}
    last = max(r[1] for r in rows) - timedelta(minutes=10)
    exp = {(r["t"], round(r["value"], 9)) for r in rate(df, ["k"], 300, 60).collect() if r["t"] <= last}
    assert got and got == exp


def test_stream_quality_per_batch(spark):
    base = tempfile.mkdtemp(prefix="tessera-stream-q-")
    df = spark.createDataFrame([(1, None), (2, "x")], "id int, s string")
    df.write.parquet(f"{base}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{base}/in")
    q = stream_quality(stream, f"{base}/res", f"{base}/ver", f"{base}/ck", missing_threshold=0.1)
    q.awaitTermination(120)
    res = spark.read.parquet(f"{base}/res")
    batch = {r["column_name"]: r["missing_fraction"] for r in res.collect()}
    assert batch == {r["column_name"]: r["missing_fraction"] for r in check_missing(df).collect()}
    assert spark.read.parquet(f"{base}/ver").first()["overall_passed"] is False


def test_stream_scoring_writes_scores_and_log(spark):
    from tessera.operators.models import build_model
    from tessera.streaming.scoring import stream_scores
    from tessera.streaming.triggers import trigger_for

    base = tempfile.mkdtemp(prefix="tessera-stream-s-")
    train = spark.range(200).select((F.col("id") % 7).cast("double").alias("a"),
                                    ((F.col("id") % 7) > 3).cast("int").alias("label"))
    pipe = build_model("gbt", ["a"])
    gbt = pipe.getStages()[-1]
    model = pipe.fit(train, {gbt.maxIter: 3, gbt.maxDepth: 2})
    reqs = spark.createDataFrame([(1, '{"a": 6}'), (2, '[{"a": 1}, {"a": 5}]'), (3, '{"b": 1}'), (4, "{")],
                                 "request_id bigint, body string")
    reqs.write.parquet(f"{base}/in")
    q = stream_scores(spark, f"{base}/in", model, ["a"], "a double", ["a"], f"{base}/scores",
                      f"{base}/log", f"{base}/ck")
    q.awaitTermination(180)
    scores = {(r["request_id"], r["pos"]): r for r in spark.read.parquet(f"{base}/scores").collect()}
    assert scores[(1, 0)]["prediction"] == 1 and scores[(2, 0)]["prediction"] == 0
    assert scores[(3, None)]["status"] == "rejected" and scores[(4, None)]["status"] == "malformed"
    log = spark.read.parquet(f"{base}/log").collect()
    assert sum(r["rows"] for r in log) == 5 and all(r["processing_time_seconds"] >= 0 for r in log)
    assert trigger_for(None) == {"availableNow": True}
    assert trigger_for("5 seconds") == {"processingTime": "5 seconds"}


def _run(q):
    q.awaitTermination(180)
    assert q.exception() is None


def test_quality_over_the_whole_stream_equals_one_batch(spark):
    from tessera.operators.quality import run_all_checks
    from tessera.streaming.quality import stream_checks, stream_partials
    base = tempfile.mkdtemp(prefix="tessera-stream-t-")
    df = spark.createDataFrame([(i, None if i % 4 == 0 else "x", str(i) if i % 9 else "bad", float("nan") if i == 5 else i / 7)
                                for i in range(90)], "id int, s string, t string, v double")
    df.repartition(6).write.parquet(f"{base}/in")
    spark.createDataFrame([], df.schema).write.mode("append").parquet(f"{base}/in")
    ranges, types = {"id": (0, 80), "t": (0, 100), "v": (0, 50), "none": (0, 1)}, {"id": "int"}
    start = lambda: stream_partials(spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in"),
                                    f"{base}/partials", f"{base}/ck", ranges)
    _run(start())
    partials = spark.read.parquet(f"{base}/partials")
    assert partials.count() >= 6
    norm = lambda d: sorted(map(str, d.collect()))
    expected = norm(run_all_checks(df, types, ranges))
    assert norm(stream_checks(partials, df, types, ranges)) == expected
    df.where("id = 3").write.mode("append").parquet(f"{base}/in")  # the query goes on where it stopped
    _run(start())
    both = spark.read.parquet(f"{base}/in")
    assert norm(stream_checks(spark.read.parquet(f"{base}/partials"), both, types, ranges)) == norm(run_all_checks(both, types, ranges))


def test_a_replayed_batch_replaces_its_partial_row(spark):
    from tessera.operators.quality import merged_checks, partial_stats, run_all_checks
    from tessera.streaming.triggers import write_batch
    path = tempfile.mkdtemp(prefix="tessera-partials-")
    df = spark.createDataFrame([(1, None), (2, "x"), (3, "y")], "id int, s string")
    for k, part in ((0, "id = 1"), (1, "id > 1"), (1, "id > 1")):
        write_batch(partial_stats(df.where(part)), k, path)
    norm = lambda d: sorted(map(str, d.collect()))
    assert norm(merged_checks(spark.read.parquet(path), df)) == norm(run_all_checks(df))


def test_redelivered_and_late_requests_are_answered_once(spark):
    from tessera.operators.models import build_model
    from tessera.streaming.scoring import stream_scores
    base = tempfile.mkdtemp(prefix="tessera-stream-r-")
    train = spark.range(100).select((F.col("id") % 7).cast("double").alias("a"), ((F.col("id") % 7) > 3).cast("int").alias("label"))
    pipe = build_model("gbt", ["a"])
    gbt = pipe.getStages()[-1]
    model = pipe.fit(train, {gbt.maxIter: 2, gbt.maxDepth: 2})
    at = lambda minutes: T0 + timedelta(minutes=minutes)
    files = [[(1, '{"a": 6}', at(0)), (2, '{"a": 1}', at(1)), (1, '{"a": 6}', at(2)), (9, '{"a": 1}', None)],
             [(1, '{"a": 6}', at(9)), (3, "{", at(60)), (2, '{"a": 1}', at(3))],
             [(4, '{"b": 1}', at(61)), (3, "{", at(62))],
             [(5, '{"a": 5}', at(5))]]  # an hour late
    for f in files:
        spark.createDataFrame(f, "request_id bigint, body string, sent timestamp").coalesce(1).write.mode("append").parquet(f"{base}/in")
    args = dict(file_schema="request_id bigint, body string, sent timestamp", max_files_per_trigger=1, sent_col="sent",
                delay="20 minutes", rejects_path=f"{base}/rejects")
    _run(stream_scores(spark, f"{base}/in", model, ["a"], "a double", ["a"], f"{base}/scores", f"{base}/log", f"{base}/ck", **args))
    assert sorted(r.request_id for r in spark.read.parquet(f"{base}/scores").collect()) == [1, 2]
    assert sorted((r.request_id, r.status) for r in spark.read.parquet(f"{base}/rejects").collect()) == [(3, "malformed"), (4, "rejected")]
    log = spark.read.parquet(f"{base}/log").agg(F.sum("rows"), F.sum("rejected")).first()
    assert tuple(log) == (4, 2)


def test_scores_of_a_run_are_replaced_when_it_runs_again(spark):
    from tessera.sources.sinks import write_scores
    base = tempfile.mkdtemp(prefix="tessera-scores-")
    df = spark.createDataFrame([(1, "ok"), (2, "rejected"), (3, "ok")], "request_id int, status string")
    for run in ("a", "b", "a"):
        assert write_scores(df, f"{base}/s", f"{base}/l", run, F.col("status") != "ok")[:2] == (run, 3)
    assert spark.read.parquet(f"{base}/s").count() == 6
    assert sorted((r.run_id, r["rows"], r.rejected) for r in spark.read.parquet(f"{base}/l").collect()) == [("a", 3, 1), ("b", 3, 1)]
    name, n, seconds = write_scores(df.limit(0), f"{base}/none")
    assert n == 0 and seconds > 0 and len(name) == 32


def test_spans_are_written_by_all_tasks_in_order_of_time(spark):
    from tessera.streaming.runs import publish_in_turn
    base = tempfile.mkdtemp()
    df = spark.range(4000, numPartitions=4).select((F.col("id") * 7919 % 4000).alias("v"), F.timestamp_seconds(F.col("id") * 7919 % 4000).alias("ts"))
    seen = 0
    for k in publish_in_turn(df, f"{base}/spans", "ts", 4):
        rows = spark.read.parquet(f"{base}/spans")
        top = rows.agg(F.max("v"), F.count("v")).first()
        assert top[0] == top[1] - 1 and top[1] > seen and len(rows.inputFiles()) >= 2 * (k + 1)
        seen = top[1]
    assert seen == 4000


def test_requests_are_parsed_once_for_fit_and_answers(spark, monkeypatch):
    from tessera.plans import queries_models, queries_stream
    from tessera.streaming import scoring
    plans = []
    for module in (queries_models, queries_stream, scoring):
        def kept(model, requests, *args, real=module.score_requests):
            plans.append(requests._jdf.queryExecution().optimizedPlan().toString())
            return real(model, requests, *args)
        monkeypatch.setattr(module, "score_requests", kept)
    queries_stream.q_batch_scoring_log(spark, "/root/testdata/sf0.001")
    queries_models.q_request_scoring(spark, "/root/testdata/sf0.001")
    assert len(plans) == 2 and not any("from_json" in p for p in plans)
    queries_stream.q_stream_scoring(spark, "/root/testdata/sf0.001")
    assert len(plans) > 2 and all("InMemoryRelation" in p for p in plans[2:])
