import pytest
from pyspark.sql import functions as F

from tessera.functions.arrays import argmax, confidence, softmax
from tessera.operators.evaluate import evaluate
from tessera.operators.features import apply_scaler, build_vocab, encode, fit_scaler, tokenize


def test_tokenize_truncates_and_handles_null(spark):
    texts = [(0, ""), (1, None), (2, " ".join(["w"] * 126)), (3, " ".join(["w"] * 127)), (4, "A, b! " * 100)]
    df = spark.createDataFrame(texts, "id int, text string")
    rows = {r["id"]: r["tokens"] for r in tokenize(df, "text", 128).collect()}
    assert rows[0] == ["[CLS]", "[SEP]"] and rows[1] == ["[CLS]", "[SEP]"]
    assert len(rows[2]) == 128 and len(rows[3]) == 128
    assert rows[4][:5] == ["[CLS]", "a", ",", "b", "!"] and len(rows[4]) == 128


def test_encode_pads_and_masks(spark):
    df = spark.createDataFrame([(0, "b a b b"), (1, "a z"), (2, "")], "id int, text string")
    vocab = build_vocab(df, "text", 2)
    assert [(r["token"], r["id"]) for r in vocab.orderBy("id").collect()] == [("b", 4), ("a", 5)]
    enc = {r["id"]: r for r in encode(tokenize(df, "text", 8), vocab, max_length=8).collect()}
    assert enc[0]["input_ids"] == [2, 4, 5, 4, 4, 3, 0, 0]
    assert enc[0]["attention_mask"] == [1, 1, 1, 1, 1, 1, 0, 0]
    assert enc[1]["input_ids"][:4] == [2, 5, 1, 3]  # z is unknown
    assert enc[2]["input_ids"] == [2, 3, 0, 0, 0, 0, 0, 0]
    longest = encode(tokenize(df, "text", 8), vocab, pad="longest").collect()
    assert {len(r["input_ids"]) for r in longest} == {6}


def test_encode_needs_no_key(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "c d"), (None, "a"), (None, None)], "id int, text string")
    enc = encode(tokenize(df, "text", 8), build_vocab(df, "text", 9), max_length=5).collect()
    # by count, then by token: a, b, c, d
    assert sorted(tuple(r["input_ids"]) for r in enc) == [(2, 3, 0, 0, 0), (2, 4, 3, 0, 0), (2, 4, 5, 3, 0), (2, 6, 7, 3, 0)]


def test_softmax_argmax_confidence(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0],), ([1000.0, 0.0],)], "l array<double>")
    rows = df.select(softmax(F.col("l")).alias("p")).select(
        "p", argmax(F.col("p")).alias("a"), confidence(F.col("p")).alias("c")).collect()
    assert sum(rows[0]["p"]) == pytest.approx(1.0) and rows[0]["a"] == 1
    assert rows[1]["p"][0] == pytest.approx(1.0) and rows[1]["a"] == 0 and rows[1]["c"] == pytest.approx(1.0)


def test_scaler_uses_population_std_and_constant_columns(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, k double")
    out = apply_scaler(df, fit_scaler(df, ["x", "k"])).collect()
    assert [r["x"] for r in out] == [-1.0, 1.0] and [r["k"] for r in out] == [0.0, 0.0]


def test_weighted_metrics_with_unseen_classes(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 1)], "label int, prediction int")
    m = {r["metric"]: r["value"] for r in evaluate(df).collect()}
    assert m["accuracy"] == pytest.approx(0.5)
    assert m["recall"] == pytest.approx(m["accuracy"])  # weighted recall equals accuracy
    # class 0: P=1, R=.5; class 1: P=1/3, R=1; class 2: never predicted -> 0
    assert m["precision"] == pytest.approx((2 * 1 + 1 * (1 / 3)) / 4)


def test_quantile_cuts_hold_for_skew_few_values_and_any_partitioning(spark):
    from tessera.operators.features import quantile_cuts
    n = 4000
    place = F.pmod(F.xxhash64("id"), F.lit(n)) / n
    df = spark.range(n).select(
        F.when(F.col("id") == 0, 1e9).otherwise(F.exp(20 * place) / 1e9).alias("a.b"),  # nearly all in one cell at first
        F.when(F.col("id") < 5, F.col("id") * 1e-12).otherwise(0.5).alias("few"), F.lit(0.0).alias("same"),
        F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, F.lit(float("nan"))).otherwise(place * 2).alias("gaps"),
        F.lit(None).cast("double").alias("none"))
    names = ["a.b", "few", "same", "gaps", "none"]
    cuts = quantile_cuts(df, names)
    assert cuts == quantile_cuts(df.repartition(7), names)
    assert cuts[1] == [0.0, 1e-12, 2e-12, 3e-12, 4e-12, 0.5] and cuts[2] == [0.0] and cuts[4] == []
    rows = df.toPandas()
    for i in (0, 3):
        x, ends = rows[names[i]].dropna(), cuts[i]
        held = [((x > lo) & (x <= hi)).sum() for lo, hi in zip([float("-inf"), *ends], ends)]
        assert len(ends) == 32 and ends == sorted(set(ends)) and ends[-1] == x.max() and sum(held) == len(x)
        assert max(held) <= len(x) / 32 * 1.13 + x.value_counts().max()
