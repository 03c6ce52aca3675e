"""The sample store: what scans prune, and that pruning loses nothing."""

import re
import tempfile
from datetime import datetime, timedelta
from itertools import product

import pytest

from tessera.sources.samples import _pruned, implied, read_store, read_store_stream, write_samples
from tessera.streaming.runs import drain

T0 = datetime(2024, 3, 1, 12)


@pytest.fixture(scope="module")
def store(spark):
    rows = []
    for i in range(400):
        labels = {"path": ["/predict/a", "/predict/b", "/health", "x/predict/a", ""][i % 5]}
        if i % 3:
            labels["status"] = ["200", "500"][i % 2]
        rows.append((["m1", "m2"][i % 2], labels if i % 11 else None, T0 + timedelta(hours=i), float(i)))
    df = spark.createDataFrame(rows, "metric string, labels map<string,string>, ts timestamp_ntz, value double")
    path = tempfile.mkdtemp(prefix="tessera-store-") + "/s"
    write_samples(df.where("value < 200"), path, ["status", "path"])
    write_samples(df.where("value >= 200"), path, ["status", "path"])
    return rows, path


MATCHERS = [("path", "=", "/health"), ("path", "=", ""), ("path", "!=", "/health"), ("path", "!=", ""), ("status", "!=", "200"),
            ("path", "=~", "/predict.*"), ("path", "=~", "/predict/(a|b)"), ("path", "=~", "a|/health|"), ("path", "=~", "/predict/a?"),
            ("path", "!~", "/predict.*"), ("status", "=~", ".*"), ("status", "=~", "2..|"), ("path", "=~", ""), ("none", "=", ""),
            ("none", "=", "x"), ("none", "!=", "x"), ("none", "=~", "x*"), ("none", "!~", "x*")]


def holds(labels, label, op, value):
    text = (labels or {}).get(label, "")
    hit = text == value if op in ("=", "!=") else re.fullmatch(value, text) is not None
    return hit if op in ("=", "=~") else not hit


def test_each_matcher_keeps_what_a_literal_check_keeps(spark, store):
    rows, path = store
    for m in MATCHERS:
        got = sorted(r.value for r in read_store(spark, path, None, [m]).collect())
        assert got == [r[3] for r in rows if holds(r[1], *m)], m


def test_metric_range_and_matchers_together_in_batch_and_stream(spark, store):
    rows, path = store
    start, end = T0 + timedelta(hours=50), T0 + timedelta(hours=230)
    for metric, ms in product(["m1", "absent"], [[("path", "=~", "/predict/(a|b)"), ("status", "!=", "500")]]):
        want = [r[3] for r in rows if r[0] == metric and start < r[2] <= end and all(holds(r[1], *m) for m in ms)]
        got = read_store(spark, path, metric, ms, start, end)
        assert got.columns == ["metric", "path", "status", "ts", "value"] and sorted(r.value for r in got.collect()) == want
        base = tempfile.mkdtemp(prefix="tessera-store-st-")
        live = drain(read_store_stream(spark, path, metric, ms, str(start), str(end), 3), f"{base}/out", f"{base}/ck") if want else got
        assert sorted(r.value for r in live.collect()) == want


def test_scan_takes_metric_day_labels_and_time(spark, store):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        check_scan(spark, store)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def check_scan(spark, store):
    df = read_store(spark, store[1], "m1", [("path", "=~", "/predict.*"), ("status", "=", "200")], T0, T0 + timedelta(days=2))
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("FileScan"):]
    folders, pushed = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", scan, re.S)[1], re.search(r"PushedFilters: \[(.*?)\], ReadSchema", scan, re.S)[1]
    assert "metric" in folders and "day" in folders
    assert "EqualTo(label_status,200)" in pushed and "StringStartsWith(label_path,/predict)" in pushed and "ts" in pushed
    some = read_store(spark, store[1], None, [("path", "=~", "/predict/(a|b)")])._jdf.queryExecution().executedPlan().toString()
    assert "In(label_path, [/predict/a,/predict/b])" in some


def test_what_a_regex_says_plainly():
    assert implied("/health") == ("in", ["/health"]) and implied("a(b|c)d") == ("in", ["abd", "acd"])
    assert implied("/predict.*") == ("prefix", ["/predict"]) and implied("/predict/a?") == ("prefix", ["/predict/"])
    assert implied(".*") is None and implied("ab|c.*") is None and implied("") == ("in", [""])
    assert implied(r"a\.b") == ("prefix", ["a"]) and implied("ab{2}") == ("prefix", ["a"]) and implied("ab+") == ("prefix", ["ab"])


def test_samples_that_could_not_be_found_again_are_refused(spark):
    schema = "metric string, labels map<string,string>, ts timestamp_ntz, value double"
    for row in (("m", {"pod": "x"}, T0, 1.0), (None, {}, T0, 1.0), ("m", {}, None, 1.0)):
        with pytest.raises(Exception, match="store does not have|without metric"):
            write_samples(spark.createDataFrame([row], schema), tempfile.mkdtemp() + "/s", ["path"])
    with pytest.raises(ValueError):
        _pruned(spark.createDataFrame([], schema), None, [], "2024-01-01", None)


def test_tasks_of_a_write_follow_from_the_number_of_samples(spark, monkeypatch):
    from tessera.session import ensure_checkpoint_dir
    from tessera.sources import samples as store
    monkeypatch.setattr(store, "FILE_ROWS", 1000, raising=False)
    df = spark.range(12_000).selectExpr("'m' as metric", "map('path', cast(id % 10 as string)) as labels",
                                        "timestamp'2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, id div 10) as ts", "cast(id as double) as value")
    path = tempfile.mkdtemp() + "/s"
    write_samples(df, path, ["path"])
    back = spark.read.parquet(path)
    sizes = [spark.read.parquet(f).count() for f in back.inputFiles()]
    assert sum(sizes) == 12_000 and len(sizes) >= 10 and max(sizes) <= 2500
    where = spark._jvm.org.apache.hadoop.fs.Path(ensure_checkpoint_dir(spark) + "/tessera-unsorted-samples-*")
    left = where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where)
    assert len(left) == 0


def test_metric_scan_writes_each_folder_without_a_sort_over_metrics(spark, monkeypatch):
    from pyspark.sql import DataFrameWriter
    from tessera.plans import queries_store
    dealt, real = [], DataFrameWriter.partitionBy
    monkeypatch.setattr(DataFrameWriter, "partitionBy", lambda self, *names: dealt.append(names) or real(self, *names))
    row = queries_store.q_metric_scan(spark, "/root/testdata/sf0.001").collect()
    assert not dealt and len(row) == 1 and row[0].samples == spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()
