"""Feature operators: standard scaling and word-level text encoding."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.columns import c
from tessera.session import cut_lineage


def fit_scaler(df: DataFrame, cols: list[str]) -> DataFrame:
    """``(column_name, mean, std)`` with population std; a constant column gets std 1.

    One aggregate for all columns. Fit on the training part only.
    """
    aggs = []
    for i, name in enumerate(cols):
        x = c(name).cast("double")
        aggs += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}")]
    rows = F.array(*[F.struct(F.lit(name).alias("column_name"), F.col(f"m{i}").alias("mean"),
                              F.when(F.col(f"s{i}") == 0, F.lit(1.0)).otherwise(F.col(f"s{i}")).alias("std"))
                     for i, name in enumerate(cols)])
    return df.agg(*aggs).select(F.inline(rows))


def apply_scaler(df: DataFrame, stats: DataFrame | dict, suffix: str = "") -> DataFrame:
    """``(x - mean) / std`` per fitted column; other columns pass through.

    ``stats`` (one row per feature column, so a bounded handful of numbers)
    is read once and inlined as literals, keeping the projection in codegen.
    """
    if isinstance(stats, DataFrame):
        stats = {r["column_name"]: (r["mean"], r["std"]) for r in stats.collect()}
    out = []
    for name in df.columns:
        if name in stats:
            mean, std = stats[name]
            out.append(((c(name).cast("double") - F.lit(mean)) / F.lit(std)).alias(name + suffix))
            if suffix:
                out.append(c(name))
        else:
            out.append(c(name))
    return df.select(*out)


def quantile_cuts(df: DataFrame, cols: list[str], bins: int = 32, cells: int = 1024) -> list[list[float]]:
    """Upper ends of at most ``bins`` bins of each scaled column, of about as many rows each; every value, if they are few.

    All rows are counted by cell, in cells of even width at first. A cell of two values or more that holds an eighth of a
    bin is cut further and the column counted again, so an end lies less than that beyond its quantile, however skewed the
    column is. The counts are exact: the ends are the same for any partitioning. The driver gets one row for each cell.
    Nulls, NaN and infinite values do not count.
    """
    edges = {i: [8 * k / cells - 4 for k in range(cells + 1)] for i, _ in enumerate(cols)}
    cuts: list[list[float]] = [[] for _ in cols]
    while edges:
        values = df.select(*[c(cols[i]).cast("double").alias(f"x{i}") for i in edges])
        cut = Bucketizer(splitsArray=[[-math.inf, *e, math.inf] for e in edges.values()], handleInvalid="keep",
                         inputCols=[f"x{i}" for i in edges], outputCols=[f"cell{i}" for i in edges]).transform(values)
        each = F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"x{i}").alias("x"), F.col(f"cell{i}").alias("cell")) for i in edges])
        counts = (cut.select(F.inline(each)).where(F.abs("x") < math.inf).groupBy("i", "cell")
                  .agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect())
        finer = {}
        for i in edges:
            held = sorted((r.lo, r.hi, r.n) for r in counts if r.i == i)
            n = sum(r[2] for r in held)
            coarse = [(lo, hi) for lo, hi, m in held if lo < hi and (m * 8 * bins >= n or len(held) <= bins)]
            if coarse:
                # the last edge parts the highest value from the others, however close they are
                new = {e for lo, hi in coarse for e in [*(lo + (hi - lo) * k / 64 for k in range(1, 64)), hi] if lo < e <= hi}
                finer[i] = sorted(new.union(edges[i]))
            elif len(held) <= bins:
                cuts[i] = [hi for _, hi, _ in held]
            else:
                upto, ends = 0, []
                for _, hi, m in held:
                    # the cell holds the last row of a bin, or of several
                    if (upto + m) * bins // n > upto * bins // n:
                        ends.append(hi)
                    upto += m
                cuts[i] = ends
        edges = finer
    return cuts


# Special tokens and their ids, and the word pattern (letters,
# digits and underscore form words; every other non-space character is a token).
PAD, UNK, CLS, SEP = "[PAD]", "[UNK]", "[CLS]", "[SEP]"
SPECIAL_IDS = {PAD: 0, UNK: 1, CLS: 2, SEP: 3}
TOKEN_PATTERN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"


def words(text) -> Column:
    """Lower-cased word and punctuation tokens of a text column (whole text)."""
    col = text if not isinstance(text, str) else c(text)
    return F.regexp_extract_all(F.lower(F.coalesce(col.cast("string"), F.lit(""))),
                                F.lit(TOKEN_PATTERN), 0)


def tokenize(df: DataFrame, text_col: str = "text", max_length: int = 128,
             out: str = "tokens") -> DataFrame:
    """``[CLS] + first (max_length - 2) tokens + [SEP]`` per row; null text gives an empty body."""
    body = F.slice(words(text_col), 1, max_length - 2)
    return df.withColumn(out, F.concat(F.array(F.lit(CLS)), body, F.array(F.lit(SEP))))


def build_vocab(df: DataFrame, text_col: str = "text", size: int = 30000) -> DataFrame:
    """``(token, id, n)``: the ``size`` most frequent tokens of the whole texts,
    ties by token; ids start after the four special ids.

    Counting is a partial aggregation. To avoid merging ``size`` rows from
    every partition on one task, the exact count threshold comes first from
    the counts-of-counts table (one row per distinct frequency, at most
    sqrt(2 x tokens) rows); only tokens at or above it are sorted. The
    counts are checkpointed once, so the texts are tokenised in one pass.
    """
    counts = df.select(F.explode(words(text_col)).alias("token")).groupBy("token") \
        .agg(F.count(F.lit(1)).alias("n"))
    # the threshold and the top-k both read the counts: tokenise the texts once and
    # keep the (distinct-token sized) counts in the shared checkpoint folder
    counts = cut_lineage(counts)
    by_freq = counts.groupBy("n").agg(F.count(F.lit(1)).alias("tokens"))
    # frequencies from the top down, with the number of tokens at or above each
    ahead = Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = (by_freq.withColumn("at_or_above", F.sum("tokens").over(ahead))
                  .where(F.col("at_or_above") >= size).agg(F.max("n").alias("n")).first())
    threshold = cut["n"] if cut is not None and cut["n"] is not None else 1
    top = counts.where(F.col("n") >= threshold).orderBy(F.desc("n"), F.asc("token")).limit(size)
    w = Window.orderBy(F.desc("n"), F.asc("token"))
    return top.select("token", (F.row_number().over(w) + len(SPECIAL_IDS) - 1).cast("int").alias("id"), "n")


#: Vocabulary rows up to which a task holds them as a lookup (a default vocabulary has 30,000).
MAX_LOOKUP = 1_000_000


def _lookup(vocab: DataFrame) -> dict[str, int]:
    """Token ids on the driver; the vocabulary's size is checked first."""
    n = vocab.count()
    if n > MAX_LOOKUP:
        raise ValueError(f"vocabulary of {n} tokens; encode holds at most {MAX_LOOKUP}")
    return {r["token"]: r["id"] for r in vocab.select("token", "id").collect()} | SPECIAL_IDS


def encode(df: DataFrame, vocab: DataFrame, tokens_col: str = "tokens",
           max_length: int = 128, pad: str = "max", batch_col: str | None = None) -> DataFrame:
    """Token ids, padded with 0, and the attention mask (1 real, 0 pad).

    Each row is encoded by itself, so no key is needed and nothing is shuffled; the vocabulary,
    whose size is checked, travels as a broadcast lookup. Unknown and null tokens get the UNK id, a
    null token list is empty. ``pad="longest"`` pads to the longest row of each ``batch_col``
    group (of the table without one) instead of ``max_length``.
    """
    from tessera.functions.arrays import mask_for, pad_right
    ids_of = df.sparkSession.sparkContext.broadcast(_lookup(vocab))

    @F.pandas_udf("array<int>")
    def ids(tokens: pd.Series) -> pd.Series:
        get, unk = ids_of.value.get, SPECIAL_IDS[UNK]
        return tokens.map(lambda row: [] if row is None else [get(t, unk) for t in row])

    joined = df.withColumn("__ids", ids(c(tokens_col)))
    if pad == "max":
        length = F.lit(max_length)
    elif pad == "longest" and batch_col:
        length = F.max(F.size("__ids")).over(Window.partitionBy(c(batch_col)))
    elif pad == "longest":
        # one batch: the longest row is one number from a partial aggregate (no one-task window)
        longest = df.agg(F.max(F.size(c(tokens_col))).alias("m")).first()["m"] or 0
        length = F.lit(max(int(longest), 0))
    else:
        raise ValueError(f"Unknown padding: {pad}")
    return (joined.withColumn("input_ids", pad_right(F.col("__ids"), length))
                  .withColumn("attention_mask", mask_for(F.col("__ids"), length))
                  .drop("__ids"))
