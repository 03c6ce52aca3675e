"""Reproducible splits, folds and mini-batches that do not depend on partitioning.

Rows are ordered by ``md5("<seed>:<key>")`` (then the key), which any engine
computes the same way. Splits and folds are contiguous blocks of that order,
so each row only needs to be compared with a few boundary rows. Boundaries
are found without sorting the data:

1. count rows per 3-hex-digit hash prefix (4,096 groups, partial aggregation);
2. inside the prefixes that hold a boundary, count per 6-digit prefix;
3. inside those, count per key (about n / 16.7 million keys at scale).

The split itself is then a per-row comparison, with no shuffle and no join; folds compare
each row with the boundaries of its class, which are joined by label.
Mini-batches need every row's rank: rows are counted by hash prefix (or stretch
of the key), and a rank is the position within the prefix plus the rows before it.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.columns import c
from tessera.session import cut_lineage

H = "__h"
G = "__g"
#: Boundary rows of so many classes go to every task; of more classes, only those of the frequent ones.
FEW_CLASSES = 10_000
#: Rows of a class from which it is frequent: one task of a join by label would read them all.
FREQUENT = 1_000_000


def order_hash(key: str, seed: int = 42, epoch: int | None = None) -> Column:
    """``md5("seed:key")`` or ``md5("seed:epoch:key")`` as hex text."""
    parts = [F.lit(str(seed))] + ([F.lit(str(epoch))] if epoch is not None else []) + \
            [c(key).cast("string")]
    return F.md5(F.concat_ws(":", *parts))


def _narrowed(counts: DataFrame, within: list[str], by: list[str], wanted: DataFrame, ids: list[str]) -> DataFrame:
    """The unit (``by``) that holds each wanted rank, and the rank inside it.

    ``counts`` has ``n`` rows for each unit of a group (``within``); ``wanted`` has a rank ``__r`` in a group.
    """
    w = Window.partitionBy(*within).orderBy(*by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (counts.withColumn("__upto", F.sum("n").over(w)).join(wanted, within)
            .where((F.col("__r") <= F.col("__upto")) & (F.col("__r") > F.col("__upto") - F.col("n")))
            .select(*ids, *within, *[b for b in by if b not in within], (F.col("__r") - F.col("__upto") + F.col("n")).alias("__r"),
                    (F.col("__upto") - F.col("n")).alias("__before"), "n"))


def located(df: DataFrame, key: str, targets: DataFrame, ids: list[str],
            kept: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The row at each wanted rank of each group: ``ids..., __g, __h, __k``, its place ``__r`` among the ``n`` rows of its key.

    ``df`` carries the hash ``__h`` and the group ``__g``; ``targets`` has ``ids..., __g, __r`` (1-based). Rows are
    counted by prefix of 3 digits, then, under the prefixes that hold a target, of 6, then by key; each time partial
    sums first, and what holds the targets is joined, not fetched. Few targets are ``kept`` after each count, so that no
    count is planned again, and go to every task: rows are judged where they are read, and only counts are shuffled.
    """
    d = df.select(G, H, F.substring(H, 1, 3).alias("__p3"), F.substring(H, 1, 6).alias("__p6"), c(key).alias("__k"))
    n = F.count(F.lit(1)).alias("n")
    at = _narrowed(d.groupBy(G, "__p3").agg(n), [G], ["__p3"], targets, ids).drop("n", "__before")
    at = kept(at) if kept else at
    for by, finer in (([G, "__p3"], ["__p6"]), ([G, "__p6"], [H, "__k"])):
        holding = at.select(*by).distinct()
        inside = d.join(F.broadcast(holding) if kept else holding, by, "left_semi").groupBy(*by, *finer).agg(n)
        at = _narrowed(inside, by, finer, at, ids).drop("__before", *(["n"] if finer == ["__p6"] else []))
        at = kept(at) if kept and finer == ["__p6"] else at
    return at.select(*ids, G, H, "__k", "__r", "n")


def _refuse_ties(after: int, key) -> None:
    if after:
        raise ValueError(f"{after} more rows share the boundary key {key}; name columns that tell rows apart")


def _after(key: str, bound: tuple) -> Column:
    """Row sorts after the boundary row in (hash, key) order."""
    h, k = bound
    return (F.col(H) > F.lit(h)) | ((F.col(H) == F.lit(h)) & (c(key) > F.lit(k)))


def test_count(n: int, test_size: float) -> int:
    """Rows in the test part: ``ceil(test_size * n)`` for a fraction, else the number."""
    if isinstance(test_size, float) and 0 < test_size < 1:
        return int(math.ceil(test_size * n))
    return int(test_size)


def _by_content(df: DataFrame, key: str, seed: int) -> Column:
    """The hash of the key, then one of the whole row, which tells rows of one key apart unless they are alike."""
    return F.concat(order_hash(key, seed), F.md5(F.to_json(F.struct(*[c(x) for x in df.columns]))))


def train_test_split(df: DataFrame, key: str, test_size: float = 0.2, seed: int = 42,
                     exact: bool = True, split_col: str = "split", ties: str = "refuse") -> DataFrame:
    """Add ``split`` = 'test' | 'train'; the test part is the first ``ceil(test_size * n)``
    rows in hash order (disjoint, complete, same for any partitioning).

    ``exact=False`` skips the counting jobs and compares the hash with a
    fixed threshold (test size then only approximately ``test_size * n``).

    If the boundary falls between rows of one key, ``ties="refuse"`` raises, and ``ties="content"``
    allots them by a hash of the whole row. Rows that are alike in every column cannot be told apart: as many
    of them as the size needs go to the test part, from their count, so reruns agree there too.
    """
    if ties not in ("refuse", "content"):
        raise ValueError(f"ties must be 'refuse' or 'content', not {ties!r}")
    hashed = df.withColumn(H, order_hash(key, seed))
    if not exact:
        cut = format(int(test_size * 16 ** 8), "08x")
        out = F.when(F.substring(H, 1, 8) < F.lit(cut), "test").otherwise("train")
        return hashed.withColumn(split_col, out).drop(H)
    n = df.count()
    m = test_count(n, test_size)
    if m <= 0 or m >= n:
        return df.withColumn(split_col, F.lit("train" if m <= 0 else "test"))
    one_row = df.sparkSession.range(1)
    target = one_row.select(F.lit(0).alias(G), F.lit(m).cast("long").alias("__r"))

    def kept(at):  # the one target
        row = at.first()
        return one_row.select(*[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in at.schema])

    def boundary(d):
        return located(d.withColumn(G, F.lit(0)), key, target, [], kept).first()

    at = boundary(hashed)
    if at["n"] > at["__r"]:
        if ties == "refuse":
            _refuse_ties(at["n"] - at["__r"], at["__k"])
        hashed = df.withColumn(H, _by_content(df, key, seed))
        at = boundary(hashed)
    side = F.when(_after(key, (at[H], at["__k"])), "train").otherwise("test")
    if at["n"] == at["__r"]:
        return hashed.withColumn(split_col, side).drop(H)
    # rows alike in every column straddle the boundary: one of them, as often as each side needs it
    alike = (F.col(H) == at[H]) & c(key).eqNullSafe(F.lit(at["__k"]))
    one = hashed.where(alike).limit(1)
    parts = F.array(*[F.struct(F.lit(name).alias("s"), F.lit(int(times)).alias("t"))
                      for name, times in (("test", at["__r"]), ("train", at["n"] - at["__r"]))])
    copies = one.withColumn("__part", F.explode(parts)).withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__part.t"))))
    copies = copies.select(*[c(x) for x in df.columns], F.col("__part.s").alias(split_col))
    return hashed.where(~alike).withColumn(split_col, side).drop(H).unionByName(copies)


def fold_allocation(class_counts: list[tuple[object, int]], k: int) -> dict:
    """Rows of each class per fold for an unshuffled stratified k-fold.

    Labels are sorted; position ``p`` of the sorted label list goes to fold
    ``p % k``, and each class takes its folds' counts in data order.
    """
    out, start = {}, 0
    for label, n in sorted(class_counts, key=lambda t: t[0]):
        alloc = []
        for f in range(k):
            first = start + ((f - start) % k)
            alloc.append(len(range(first, start + n, k)))
        out[label] = alloc
        start += n
    return out


def _fold_ranks(totals: DataFrame, k: int) -> DataFrame:
    """``__g, n, __f, __r``: the rank in its class of the last row of each fold but the last; see :func:`fold_allocation`.

    ``totals`` has one row for each class.
    """
    start = F.sum("n").over(Window.orderBy(G).rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    t = totals.withColumn("__s", start).withColumn("__f", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    first = F.pmod(F.col("__f") - F.col("__s"), F.lit(k))  # rows of the class before the fold's first one
    t = t.withColumn("__a", F.greatest(F.floor((F.col("n") - 1 - first) / k) + 1, F.lit(0)))
    upto = Window.partitionBy(G).orderBy("__f").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return t.withColumn("__r", F.sum("__a").over(upto)).where(F.col("__f") < k - 1).select(G, "n", "__f", "__r")


def stratified_folds(df: DataFrame, label: str, key: str, k: int = 5, seed: int = 42,
                     fold_col: str = "fold") -> DataFrame:
    """Add ``fold`` in ``0..k-1``: per class, contiguous blocks in hash order whose
    sizes follow an unshuffled stratified k-fold over the sorted labels.

    The boundary rows of all classes are found and kept in one table, a row for each class; a row's fold is
    the number of its class's boundaries that lie before it. That table goes to every task if the classes
    are few, so that rows stay where they are. Of many classes those of the frequent ones do, and only rows of the
    others are shuffled by label: no task reads a large class. The driver collects counts only, however
    many classes there are.
    """
    hashed = df.withColumn(H, order_hash(key, seed)).withColumn(G, c(label))
    totals = cut_lineage(hashed.groupBy(G).agg(F.count(F.lit(1)).alias("n")))  # one row for each class
    rows, lost, classes = totals.agg(F.sum("n"), F.sum(F.when(F.col(G).isNull(), F.col("n"))), F.count(F.lit(1))).first()
    if lost:
        raise ValueError(f"{lost} rows have no {label}; folds need a label on every row")
    if (rows or 0) < k:
        raise ValueError(f"Cannot make {k} folds from {rows or 0} rows")
    ranks = _fold_ranks(totals, k)
    inside = (F.col("__r") > 0) & (F.col("__r") < F.col("n"))
    bounds = cut_lineage(located(hashed, key, ranks.where(inside).select("__f", G, "__r"), ["__f"],
                                cut_lineage if classes <= FEW_CLASSES else None))
    tie = bounds.where(F.col("n") > F.col("__r")).first()
    if tie:
        _refuse_ties(tie["n"] - tie["__r"], tie["__k"])
    table = (ranks.groupBy(G).agg(F.count_if(F.col("__r") <= 0).alias("__empty"), F.first("n").alias("n"))
             .join(bounds.groupBy(G).agg(F.collect_list(F.struct(H, "__k")).alias("__bounds")), G, "left")
             .select(F.col(G).alias("__label"), F.struct("__empty", "__bounds").alias("__cut"), F.col("n").alias("__n")))
    by_label = hashed[G] == F.col("__label")
    if classes <= FEW_CLASSES:
        joined = hashed.join(F.broadcast(table.drop("__n")), by_label)
    else:
        frequent = F.broadcast(table.where(F.col("__n") >= FREQUENT).drop("__n"))
        rare = table.where(F.col("__n") < FREQUENT).drop("__n")
        joined = hashed.join(frequent, by_label).unionByName(
            hashed.join(frequent, by_label, "left_anti").join(rare, by_label))
    mine = F.struct(F.col(H).alias(H), c(key).alias("__k"))
    bounds_type = table.schema["__cut"].dataType["__bounds"].dataType
    before = F.size(F.filter(F.coalesce("__cut.__bounds", F.array().cast(bounds_type)), lambda b: b < mine))
    return joined.withColumn(fold_col, (F.col("__cut.__empty") + before).cast("int")).select(*[c(x) for x in df.columns], fold_col)


def dealt(df: DataFrame, key: str | list[str], rows: int, most: int = 2_000_000, least: int = 20_000) -> DataFrame:
    """``df`` of ``rows`` rows in tasks of ``most`` rows at most, for jobs that read it over and over.

    Rows are dealt by the key and sorted by it, so the parts are alike however the input was cut. Each task
    of each job costs the driver a report, so a small input is dealt to fewer tasks than there are cores,
    ``least`` rows to each, and a large one to whole rounds of the cores.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = math.ceil(rows / most)
    parts = math.ceil(parts / cores) * cores if parts > cores else min(cores, math.ceil(rows / least))
    by = [c(x) for x in ([key] if isinstance(key, str) else key)]
    return df.repartition(max(1, parts), *by).sortWithinPartitions(*by)


def rank_in_groups(df: DataFrame, group: Column, order: list[Column], rank_col: str = "rank") -> DataFrame:
    """1-based position of every row, for groups that follow each other in the wanted order.

    ``group`` is a column of few values (it is counted first: one row for each value, whose running
    total is the group's offset); ``order`` is total within a group. The rows are shuffled once.
    """
    d = df.withColumn(G, group)
    before = Window.orderBy(G).rowsBetween(Window.unboundedPreceding, -1)
    offsets = d.groupBy(G).agg(F.count(F.lit(1)).alias("__n")).select(
        G, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    inside = F.row_number().over(Window.partitionBy(G).orderBy(*order))
    return (d.withColumn(rank_col, inside).join(F.broadcast(offsets), G)
             .withColumn(rank_col, F.col(rank_col) + F.col("__off")).drop(G, "__off"))


def assign_batches(df: DataFrame, key: str, batch_size: int = 16, epoch: int = 0, seed: int = 42,
                   shuffle: bool = True, batch_col: str = "batch") -> DataFrame:
    """Mini-batch number per row: ``floor((rank - 1) / batch_size)``.

    Shuffled batches order rows by ``md5("seed:epoch:key")`` (a new order each
    epoch); unshuffled ones keep the order of a numeric, non-null key. The last batch may be partial.
    """
    if shuffle:
        d = df.withColumn(H, order_hash(key, seed, epoch))
        # 65,536 prefixes of the hash, whatever the input
        r = rank_in_groups(d, F.substring(H, 1, 4), [F.col(H), c(key)], "__rank").drop(H)
    else:
        n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        place = c(key).cast("double")
        cuts = df.select(place.alias("__x")).where("__x is not null").approxQuantile(
            "__x", [k / n for k in range(1, n)], 0.2 / n) if n > 1 else []
        splits = [-float("inf"), *sorted({0.0, *cuts}), float("inf")]
        d = Bucketizer(splits=splits, inputCol="__x", outputCol="__stretch").transform(df.withColumn("__x", place))
        r = rank_in_groups(d, F.col("__stretch"), [c(key)], "__rank").drop("__x", "__stretch")
    return r.withColumn(batch_col, F.floor((F.col("__rank") - 1) / batch_size).cast("long")).drop("__rank")


def epoch_loss(df: DataFrame, loss: str = "loss", batch: str = "batch") -> DataFrame:
    """Mean over batches of each batch's mean loss (differs from the row mean
    when the last batch is partial)."""
    per_batch = df.groupBy(c(batch)).agg(F.avg(c(loss)).alias("__bl"))
    return per_batch.agg(F.avg("__bl").alias("epoch_loss"), F.count(F.lit(1)).alias("n_batches"))
