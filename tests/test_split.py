import math

import pytest
from pyspark.sql import functions as F

from tessera.operators.split import assign_batches, epoch_loss, fold_allocation, stratified_folds, train_test_split


@pytest.mark.parametrize("n", [1, 7, 10, 101])
def test_split_exact_and_partition_independent(spark, n):
    parts = []
    for p in (1, 8):
        df = spark.range(n).repartition(p).withColumnRenamed("id", "key")
        s = train_test_split(df, "key", 0.2)
        rows = {r["key"]: r["split"] for r in s.collect()}
        assert len(rows) == n
        assert sum(v == "test" for v in rows.values()) == math.ceil(0.2 * n)
        parts.append(rows)
    assert parts[0] == parts[1]


def test_fold_allocation_follows_sorted_labels():
    # 7 of class 0 then 3 of class 1 in sorted order, 5 folds: positions p -> fold p % 5
    alloc = fold_allocation([(1, 3), (0, 7)], 5)
    assert alloc[0] == [2, 2, 1, 1, 1] and alloc[1] == [0, 0, 1, 1, 1]


def test_stratified_folds_are_contiguous_blocks(spark):
    df = spark.range(200).select(F.col("id").alias("key"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    f = stratified_folds(df, "y", "key", 5)
    counts = {(r["y"], r["fold"]): r["count"] for r in f.groupBy("y", "fold").count().collect()}
    alloc = fold_allocation([(0, 133), (1, 67)], 5)
    for y in (0, 1):
        for k in range(5):
            assert counts.get((y, k), 0) == alloc[y][k]
    # folds are increasing along the hash order within each class
    ordered = f.withColumn("h", F.md5(F.concat_ws(":", F.lit("42"), F.col("key").cast("string"))))
    for y in (0, 1):
        seq = [r["fold"] for r in ordered.where(F.col("y") == y).orderBy("h", "key").collect()]
        assert seq == sorted(seq)


def test_batches_ranks_and_loss(spark):
    df = spark.range(50).select(F.col("id").alias("key"), (F.col("id") % 2).cast("double").alias("loss"))
    b = assign_batches(df, "key", 16, epoch=0)
    sizes = sorted(r["count"] for r in b.groupBy("batch").count().collect())
    assert sizes == [2, 16, 16, 16]
    assert sorted(r["batch"] for r in b.select("batch").distinct().collect()) == [0, 1, 2, 3]
    other = assign_batches(df, "key", 16, epoch=1)
    assert [r["key"] for r in b.orderBy("batch", "key").collect()] != \
        [r["key"] for r in other.orderBy("batch", "key").collect()]
    el = epoch_loss(b).collect()[0]
    assert el["n_batches"] == 4


def test_approximate_split_needs_no_counting(spark):
    df = spark.range(2000).withColumnRenamed("id", "key")
    s = train_test_split(df, "key", 0.2, exact=False)
    n_test = s.where(F.col("split") == "test").count()
    assert 300 < n_test < 500 and s.count() == 2000


def test_boundary_search_equals_a_full_sort(spark):
    import hashlib

    df = spark.range(3001).repartition(3).withColumnRenamed("id", "key")
    split = {r["key"]: r["split"] for r in train_test_split(df, "key", 0.2).collect()}
    order = sorted(split, key=lambda k: (hashlib.md5(f"42:{k}".encode()).hexdigest(), k))
    cut = math.ceil(0.2 * 3001)
    assert {k for k, v in split.items() if v == "test"} == set(order[:cut])


def test_folds_reject_rows_without_label(spark):
    df = spark.createDataFrame([(k, k % 2 if k else None) for k in range(20)], "key long, y int")
    with pytest.raises(ValueError, match="no y"):
        stratified_folds(df, "y", "key", 5)


def test_split_of_repeated_keys_is_exact_or_refused(spark):
    df = spark.createDataFrame([(k // 10,) for k in range(100)], "key long")
    with pytest.raises(ValueError, match="share the boundary key"):
        train_test_split(df, "key", 0.25).count()
    assert train_test_split(df, "key", 0.2).where("split = 'test'").count() == 20


def _split_of(spark, rows, size, parts):
    df = spark.createDataFrame(rows, "key long, a string, `a.b` int").repartition(parts)
    out = train_test_split(df, "key", size, ties="content")
    assert out.columns == ["key", "a", "a.b", "split"]
    return sorted(map(str, out.collect()))


@pytest.mark.parametrize("size", [0.05, 0.25, 0.5, 0.99, 7])
def test_repeated_keys_split_exactly_and_alike_for_any_partitioning(spark, size):
    hot = [(1, f"x{i % 50}" if i % 3 else None, i % 2) for i in range(300)]  # one key holds most rows, many alike
    rows = hot + [(i // 4, "y", i) for i in range(120)] + [(None, None, None)] * 20
    one, eight = _split_of(spark, rows, size, 1), _split_of(spark, rows, size, 8)
    n = len(rows)
    assert one == eight and len(one) == n
    assert sum("split='test'" in r for r in one) == (math.ceil(size * n) if isinstance(size, float) else size)
    df = spark.createDataFrame(rows, "key long, a string, `a.b` int")
    assert sorted(map(str, train_test_split(df, "key", size, ties="content").drop("split").collect())) == sorted(map(str, df.collect()))


def test_rows_that_are_all_alike_split_by_their_count(spark):
    df = spark.createDataFrame([(5, "x")] * 103, "key long, a string").repartition(6)
    got = train_test_split(df, "key", 0.2, ties="content").groupBy("split").count().collect()
    assert {r.split: r["count"] for r in got} == {"test": 21, "train": 82}
    with pytest.raises(ValueError):
        train_test_split(df, "key", ties="guess")


def test_folds_of_many_labels_need_no_rows_on_the_driver(spark, monkeypatch):
    from pyspark.sql import DataFrame
    n, k = 6000, 4
    df = spark.range(n).select(F.col("id").alias("key"), (F.col("id") * 7919 % 2003).cast("string").alias("y"), F.lit(1).alias("n"))
    collected = []
    monkeypatch.setattr(type(df), "collect", lambda self, c=type(df).collect: collected.append(r := c(self)) or r)
    out = stratified_folds(df, "y", "key", k)
    assert isinstance(out, DataFrame) and sum(map(len, collected)) <= 2
    monkeypatch.undo()
    got = {}
    for r in out.collect():
        got.setdefault(r.y, []).append((r.key, r.fold))
    alloc = fold_allocation([(y, len(v)) for y, v in got.items()], k)
    import hashlib
    for y, rows in got.items():
        rows.sort(key=lambda x: (hashlib.md5(f"42:{x[0]}".encode()).hexdigest(), x[0]))
        assert [f for _, f in rows] == [f for f in range(k) for _ in range(alloc[y][f])]
    assert out.columns == ["key", "y", "n", "fold"]


def test_folds_refuse_repeated_boundary_keys(spark):
    df = spark.createDataFrame([(k // 10, 1) for k in range(100)], "key long, y int")
    with pytest.raises(ValueError, match="share the boundary key"):
        stratified_folds(df, "y", "key", 3)


@pytest.mark.parametrize("few", [10_000, 1])
def test_folds_read_no_class_whole_in_one_task(spark, monkeypatch, few):
    from tessera.operators import split
    monkeypatch.setattr(split, "FEW_CLASSES", few, raising=False)
    monkeypatch.setattr(split, "FREQUENT", 1000, raising=False)
    n = 8000
    y = F.when(F.col("id") < 6000, 0).when(F.col("id") < 7900, 1).otherwise(F.col("id") % 7 + 2)
    df = spark.range(n, numPartitions=8).select(F.col("id").alias("key"), y.cast("int").alias("y"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = stratified_folds(df, "y", "key", 5)
        most = out.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        rows = {r.key: (r.y, r.fold) for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert most <= 1100 and len(rows) == n
    import hashlib
    sizes = {}
    for y, _ in rows.values():
        sizes[y] = sizes.get(y, 0) + 1
    alloc = fold_allocation(list(sizes.items()), 5)
    for y in sizes:
        mine = sorted((k for k in rows if rows[k][0] == y), key=lambda k: (hashlib.md5(f"42:{k}".encode()).hexdigest(), k))
        assert [rows[k][1] for k in mine] == [f for f in range(5) for _ in range(alloc[y][f])]


def test_rows_are_dealt_evenly_and_alike_for_any_partitioning(spark):
    from tessera.operators.split import dealt
    df = spark.range(5000).select(F.col("id").alias("key"))
    assert dealt(df, "key", 5000).rdd.getNumPartitions() == 1
    parts = [dealt(df.repartition(p), "key", 5000, most=1000, least=10).rdd.glom().map(lambda rs: [r.key for r in rs]).collect() for p in (1, 7)]
    assert parts[0] == parts[1] and max(map(len, parts[0])) <= 1000


def test_few_boundaries_are_found_without_a_shuffle_of_rows(spark, monkeypatch):
    from tessera.operators import split
    real, found = split.located, []
    monkeypatch.setattr(split, "located", lambda *a, **b: found.append(real(*a, **b)) or found[-1])
    df = spark.range(3000).select(F.col("id").alias("key"), (F.col("id") % 3).cast("int").alias("y"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        parts = train_test_split(df, "key", 0.2)
        folds = stratified_folds(df, "y", "key", 5)
        plans = [f._jdf.queryExecution().sparkPlan().toString() for f in found]
        assert parts.where("split = 'test'").count() == 600 and folds.groupBy("y", "fold").count().agg(F.min("count"), F.max("count")).first() == (200, 200)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    semi = [line for plan in plans for line in plan.splitlines() if "LeftSemi" in line]
    assert len(found) == 2 and semi and all("Broadcast" in line for line in semi)
