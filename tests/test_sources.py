import pytest
from pyspark.sql import functions as F

from tessera.sources import files, sinks
from tessera.sources.files import extract, read_training
from tessera.sources.logs import parse_service_log
from tessera.sources.sinks import load


def test_csv_json_parquet_scans(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 1.5), (2, None, None)], "id int, s string, x double")
    df.write.option("header", True).csv(str(tmp_path / "c"))
    df.write.json(str(tmp_path / "j"))
    df.write.parquet(str(tmp_path / "p"))
    c = extract(spark, str(tmp_path / "c"), "csv")
    assert dict(c.dtypes) == {"id": "int", "s": "string", "x": "double"}
    assert c.where(F.col("s").isNull()).count() == 1
    assert extract(spark, str(tmp_path / "j"), "json").count() == 2
    assert extract(spark, str(tmp_path / "p"), "parquet").count() == 2
    assert extract(spark, str(tmp_path / "c"), "csv", schema="id int, s string, x double").count() == 2


def test_unknown_formats_raise_before_any_job(spark):
    with pytest.raises(ValueError, match="Unsupported format: xml"):
        extract(spark, "/nowhere", "xml")
    with pytest.raises(ValueError, match="Unsupported file format"):
        read_training(spark, "/nowhere/data.txt")


def test_training_scan_by_suffix(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t.parquet"))
    assert read_training(spark, str(tmp_path / "t.parquet")).count() == 3


def test_sinks_and_guards(spark, tmp_path):
    df = spark.range(5).withColumn("s", F.lit("x"))
    load(df, str(tmp_path / "out"), "parquet")
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5
    load(df, str(tmp_path / "out_csv"), "csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "out_csv")).count() == 5
    with pytest.raises(ValueError, match="Unsupported format: json"):
        load(df, str(tmp_path / "j"), "json")
    back = spark.read.parquet(str(tmp_path / "out"))
    with pytest.raises(ValueError, match="also a source"):
        load(back, str(tmp_path / "out"), "parquet")


def test_service_log_lines(spark):
    lines = spark.createDataFrame([
        ("2024-01-01 10:00:00,123 [INFO] - Tabular prediction completed in 0.0123 seconds",),
        ("2024-01-01 10:00:01,000 [ERROR] - Error during tabular prediction: boom",),
        ("garbage",)], "value string")
    rows = parse_service_log(lines).collect()
    assert rows[0]["level"] == "INFO" and rows[0]["seconds"] == pytest.approx(0.0123)
    assert rows[0]["ts"].microsecond == 123000
    assert rows[1]["level"] == "ERROR" and rows[1]["seconds"] is None
    assert rows[2]["ts"] is None and rows[2]["level"] is None


def _frame(spark, n):
    return spark.range(n).selectExpr("id", "cast(id as string) as s")


@pytest.mark.parametrize("format", ["parquet", "csv"])
def test_a_failed_overwrite_leaves_the_old_data(spark, tmp_path, format):
    path = str(tmp_path / "t")
    load(_frame(spark, 5), path, format)
    broken = spark.range(100).repartition(4).selectExpr("if(id = 77, raise_error('lost'), id) as id", "'x' as s")
    with pytest.raises(Exception, match="lost"):
        load(broken, path, format)
    read = extract(spark, path, format)
    assert read.count() == 5 and sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["t"]
    load(_frame(spark, 9), path, format)
    assert extract(spark, path, format).count() == 9


def test_publishing_cut_off_between_its_renames_is_recovered(spark, tmp_path):
    path = tmp_path / "t"
    load(_frame(spark, 5), str(path))
    path.rename(tmp_path / f"t{sinks.OLD}")
    assert sinks.recover(spark, str(path)) and not sinks.recover(spark, str(path))
    assert spark.read.parquet(str(path)).count() == 5


def test_a_write_without_commit_marker_is_not_published(spark, tmp_path):
    path = str(tmp_path / "t")
    load(_frame(spark, 5), path)

    def half(folder):
        _frame(spark, 2).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(folder)

    with pytest.raises(RuntimeError, match="commit marker"):
        sinks.publish(spark, half, path)
    assert spark.read.parquet(path).count() == 5


def test_roots_come_from_the_plan(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    load(_frame(spark, 3), a)
    load(_frame(spark, 3), b, "csv")
    both = spark.read.parquet(a).join(extract(spark, b, "csv"), "id")
    assert sorted(r.rsplit("/", 1)[1] for r in sinks.scan_roots(both)) == ["a", "b"]
    assert sinks.scan_roots(spark.range(3)) == []
    spark.read.parquet(a).createOrReplaceTempView("inner_rows")
    nested = spark.sql("select * from range(3) where id in (select id from inner_rows)")
    for df, path in ((both, a), (both, b), (nested, a), (both.limit(1), str(tmp_path))):
        with pytest.raises(ValueError, match="also a source"):
            load(df, path)


def test_malformed_lines_are_kept_apart(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b,c\n1,x,2.5\n2,y\n3,z,1.5,9\n\n4,,0.5\n")
    rows, bad = files.extract_checked(spark, str(tmp_path / "x.csv"), "csv")
    assert sorted((r.a, r.b, r.c) for r in rows.collect()) == [(1, "x", 2.5), (4, None, 0.5)]
    assert sorted(r.line for r in bad.collect()) == ["2,y", "3,z,1.5,9"] and bad.count() == 2
    (tmp_path / "x.json").write_text('{"a": 1, "n": {"k": [1, 2]}}\n{"a": \n{"a": 2}\n')
    rows, bad = files.extract_checked(spark, str(tmp_path / "x.json"), "json")
    assert sorted((r.a, r.n.k if r.n else None) for r in rows.collect()) == [(1, [1, 2]), (2, None)]
    assert [r.line for r in bad.collect()] == ['{"a": '] and rows.columns == ["a", "n"]
    with pytest.raises(ValueError):
        files.extract_checked(spark, str(tmp_path), "parquet")
