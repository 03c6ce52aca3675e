"""MinHash near-duplicates: banded candidates, Odd sketch verification, exact links, components.

A text's distinct five-word shingles are hashed; texts with the same set are one class. MinHash
samples of each set give the keys of bands. The same samples are folded into a parity bitmap:
each flips one bit, so the XOR of two bitmaps has as many bits as samples differ (less
collisions), and its population count estimates high similarities closely. Candidates that share
a band and whose bitmaps are close enough are confirmed on the full sets.

Pairs within a band's bucket are not listed. First each class meets one pivot of its bucket.
Components of those links are found; then only buckets that still hold several components are
searched, in tiles of bounded size, for links that cross components. A tile hands on the rows
whose sketches look alike, gets their full sets, and returns only links that join components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import c
from tessera.llm.common import Remembered, checkpointed, forgetting, mix64, row_key, text_or_empty
from tessera.llm.components import components

#: Words of a shingle; similarity in hundredths from which texts are linked unless a caller names another.
SHINGLE, LINK = 5, 85
#: Samples of a band; as many bands that a pair just alike enough shares none with this probability at most.
ROWS, LEAST_MISS = 5, 1e-5
#: Samples and bits of an Odd sketch; deviations beyond the mean of a pair just alike enough that its bits may differ.
SAMPLES, BITS, DEVIATIONS = 128, 512, 4.5
#: Classes of a bucket that one search task compares; larger buckets are searched block against block.
BLOCK = 256
_RNG = np.random.default_rng(20)
_FACTORS = _RNG.integers(0, 2 ** 63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SALTS = _RNG.integers(0, 2 ** 63, SAMPLES, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Sieve:
    """What follows from a similarity in hundredths: number of bands, bits of two sketches that may differ."""

    link: int
    bands: int
    max_odd: int


@lru_cache(maxsize=None)
def sieve(link: int) -> Sieve:
    """Bands and bits for pairs of similarity ``link`` or more (1 to 100).

    Of the samples a binomial number d differs, and 2 d draws flip one of the bits each; mean and
    variance of the bits that are flipped an odd number of times are those over all d.
    """
    if not 1 <= link <= 100:
        raise ValueError(f"similarity in hundredths: {link}")
    alike = link / 100
    bands = 1 if link == 100 else math.ceil(math.log(LEAST_MISS) / math.log1p(-alike ** ROWS))
    mean = square = 0.0
    for d in range(SAMPLES + 1):
        chance = math.comb(SAMPLES, d) * (1 - alike) ** d * alike ** (SAMPLES - d)
        one, two = (1 - 2 / BITS) ** (2 * d), (1 - 4 / BITS) ** (2 * d)
        mean += chance * BITS * (1 - one) / 2
        square += chance * (BITS * (1 - one) / 2 + BITS * (BITS - 1) * (1 - 2 * one + two) / 4)
    return Sieve(link, bands, math.floor(mean + DEVIATIONS * math.sqrt(max(0.0, square - mean ** 2))))


@lru_cache(maxsize=4)
def _factors(n: int) -> np.ndarray:
    """Odd factors of the samples; bands may need more of them than a sketch has."""
    more = np.random.default_rng(21).integers(0, 2 ** 63, max(0, n - SAMPLES), dtype=np.uint64)
    return np.concatenate([_FACTORS, more * np.uint64(2) + np.uint64(1)])


@lru_cache(maxsize=1)
def _words() -> Remembered:
    return Remembered(xxhash.xxh3_64_intdigest)


def shingles(text: str) -> np.ndarray:
    """Sorted hashes of the distinct shingles; fewer words than a shingle's are one, none give none."""
    words = text.encode("utf-8").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_words().__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - SHINGLE + 1)
    out = np.full(n, 0 if len(h) >= SHINGLE else len(h), np.uint64)
    for k in range(min(SHINGLE, len(h))):
        out = mix64(out * _STEP + h[k:k + n])
    return np.unique(out)


def samples(found: np.ndarray, bands: int = 0) -> np.ndarray:
    """The MinHash samples, enough for a sketch and the bands: the least product with each factor, modulo 2**64."""
    factors = _factors(max(SAMPLES, bands * ROWS))
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for s in range(0, len(found), 4096):
        np.minimum(least, (found[s:s + 4096, None] * factors).min(axis=0), out=least)
    return least


def band_keys(least: np.ndarray, bands: int) -> np.ndarray:
    keys = np.arange(bands, dtype=np.uint64)
    for k in range(ROWS):
        keys = mix64(keys * _STEP + least[:bands * ROWS].reshape(bands, ROWS)[:, k])
    return keys.view(np.int64)


def odd_sketch(least: np.ndarray) -> np.ndarray:
    """Parity bitmap of the first samples, as 64-bit words."""
    bit = (mix64(least[:SAMPLES] ^ _SALTS) % np.uint64(BITS)).astype(np.int64)
    return np.packbits(np.bincount(bit, minlength=BITS).astype(np.uint8) & 1).view(np.int64)


def _sketches(batches: Iterator[pa.RecordBatch], n_bands: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, keys, bands, odd = [], [], [], []
        for value in batch.column(2):
            found = shingles(value.as_py())
            sizes.append(len(found))
            keys.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
            least = samples(found, n_bands)
            bands.append(band_keys(least, n_bands) if len(found) else [])
            odd.append(odd_sketch(least))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
             pa.array(bands, pa.list_(pa.int64())), pa.array(odd, pa.list_(pa.int64()))],
            ["doc_id", "text_key", "n_shingles", "node", "bands", "odd"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingles(t.as_py()).view(np.int64) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["node", "found"])


def _odd_bits(a: str, b: str):
    """Population count of the XOR of two sketches."""
    bits = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(bits, F.lit(0), lambda s, x: s + x)


_TILE = ["bucket", "tile_a", "tile_b"]


def _pairs(cols: dict, close: np.ndarray) -> np.ndarray:
    """Which pairs of a tile (a block, or two blocks, of one bucket) are compared: each once, across components."""
    label = np.unique(cols["label"], return_inverse=True)[1]
    block, a, b = cols["block"], cols["tile_a"][0], cols["tile_b"][0]
    wanted = (block[:, None] == a) & (block[None, :] == b) & (label[:, None] != label[None, :]) & close
    return np.triu(wanted, 1) if a == b else wanted


def _columns(table: pa.Table, names: list[str]) -> dict:
    return {n: np.array(table.column(n).to_pylist(), object) if pa.types.is_binary(table.schema.field(n).type)
            else table.column(n).to_numpy() for n in names}


def _search(table: pa.Table, by: Sieve) -> pa.Table:
    """The rows of a tile that look alike to one of another component: by size and by Odd sketch."""
    cols = _columns(table, ["label", "block", "tile_a", "tile_b", "n_shingles"])
    size = cols["n_shingles"]
    odd = np.stack([np.asarray(x, np.int64) for x in table.column("odd").to_pylist()]).view(np.uint64)
    bits = sum(np.bitwise_count(odd[:, None, k] ^ odd[None, :, k]).astype(np.int16) for k in range(odd.shape[1]))
    close = (bits <= by.max_odd) & (100 * np.minimum.outer(size, size) >= by.link * np.maximum.outer(size, size))
    pairs = _pairs(cols, close)
    return table.drop_columns(["odd"]).filter(pa.array(pairs.any(axis=0) | pairs.any(axis=1)))


def _link(table: pa.Table, by: Sieve) -> pa.Table:
    """Links of a tile on its full sets, as few as join its components.

    Intersections of all pairs at once: a product of the 0/1 matrix of the shingles that more than
    one set holds, in slices of columns.
    """
    cols = _columns(table, ["node", "label", "block", "tile_a", "tile_b", "n_shingles"])
    n, size = table.num_rows, cols["n_shingles"]
    found = table.column("found").combine_chunks()
    values, back, count = np.unique(found.flatten().to_numpy(), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n), np.diff(found.offsets.to_numpy()))
    column = np.where(count > 1, np.cumsum(count > 1) - 1, -1)[back]
    both = np.zeros((n, n), np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for s in range(0, int((count > 1).sum()), 4096):
        part = slice(*np.searchsorted(column, [s, s + 4096]))
        holds = np.zeros((n, 4096), np.float32)
        holds[row[part], column[part] - s] = 1
        both += holds @ holds.T
    alike = 100 * both >= by.link * (np.add.outer(size, size) - both)
    head: dict = {}

    def top(x):
        while head.get(x, x) != x:
            x = head[x]
        return x

    out = [[], []]
    for i, j in zip(*np.nonzero(_pairs(cols, alike))):
        x, y = top(cols["label"][i]), top(cols["label"][j])
        if x != y:
            head[max(x, y)] = min(x, y)
            out[0].append(cols["node"][i])
            out[1].append(cols["node"][j])
    return pa.Table.from_arrays([pa.array(c, pa.binary()) for c in out], ["u", "v"])


def _full_sets(wanted: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """``node, found``: the full sets of some classes, from the text of one row each."""
    named = wanted.join(classes.select("node", "first"), "node").select("node", "first.*")
    found = (texts.join(named, texts.doc_id.eqNullSafe(named.doc_id) & (texts.text_key == named.text_key))
             .select("node", "text").dropDuplicates(["node"]).mapInArrow(forgetting(_sets, _words), "node binary, found array<long>"))
    return checkpointed(found)


def _confirmed(pairs: DataFrame, classes: DataFrame, texts: DataFrame, by: Sieve) -> DataFrame:
    """Of candidate pairs ``u, v`` those whose full sets are alike enough."""
    found = _full_sets(pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct(), classes, texts)
    u = found.select(F.col("node").alias("u"), F.col("found").alias("fu"))
    v = found.select(F.col("node").alias("v"), F.col("found").alias("fv"))
    shared = F.size(F.array_intersect("fu", "fv"))
    union = F.size("fu") + F.size("fv") - shared
    return (pairs.join(u, "u").join(v, "v").where(100 * shared >= by.link * union).select("u", "v"))


def near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_label: bool = False,
         link: int = LINK) -> DataFrame:
    """``doc_id, text_key, n_shingles, component_id, kept`` of every row.

    ``component_id`` is the least id that links reach, the row's own included; ``kept`` says that
    it is the row's own. Texts without words (null, empty) are linked with nothing. Equal sets are
    linked. Null ids keep their row and name no component as long as an id is there; rows with the
    same id are rows of their own. Other columns are ignored, whatever their names. ``with_label``
    adds the component's own key, null without words. Texts are linked from a similarity of ``link``
    hundredths.
    """
    by = sieve(link)
    texts = text_or_empty(docs, id_col, text_col).withColumn("text_key", row_key(F.col("text")))
    rows = checkpointed(texts.select("doc_id", "text_key", "text").mapInArrow(
        forgetting(lambda batches: _sketches(batches, by.bands), _words), "doc_id long, text_key long, n_shingles long, node binary, bands array<long>, odd array<long>"))
    classes = checkpointed(rows.where("n_shingles > 0").groupBy("node").agg(
        F.min("doc_id").alias("least_id"), F.min(F.struct("doc_id", "text_key")).alias("first"),
        F.min("n_shingles").alias("n_shingles"), F.min("bands").alias("bands"), F.min("odd").alias("odd")))
    spread = classes.select("node", F.explode("bands").alias("bucket"))
    pivots = (spread.groupBy("bucket").agg(F.min("node").alias("pivot"), F.count(F.lit(1)).alias("n"))
              .where("n > 1").drop("n"))
    members = checkpointed(spread.join(pivots, "bucket"))
    size = classes.select("node", "n_shingles", "odd")
    pairs = members.where("node <> pivot").select(F.col("pivot").alias("u"), F.col("node").alias("v")).distinct()
    pu = size.select(F.col("node").alias("u"), F.col("n_shingles").alias("nu"), F.col("odd").alias("ou"))
    pv = size.select(F.col("node").alias("v"), F.col("n_shingles").alias("nv"), F.col("odd").alias("ov"))
    alike = (100 * F.least("nu", "nv") >= by.link * F.greatest("nu", "nv")) & (_odd_bits("ou", "ov") <= by.max_odd)
    close = checkpointed(pairs.join(pu, "u").join(pv, "v").where(alike).select("u", "v"))
    links = checkpointed(_confirmed(close, classes, texts, by))
    labels = components(links, "u", "v")

    # what is left: buckets that hold several components
    held = members.join(labels, "node", "left").select("bucket", "node", F.coalesce("label", "node").alias("label"))
    open_ = (held.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi"))
             .where("lo <> hi").select("bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")))
    dealt = (held.join(open_, "bucket").join(size, "node")
             .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")))
    tiles = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1),
                        lambda k: F.struct(F.least(k, F.col("block")).alias("a"), F.greatest(k, F.col("block")).alias("b")))
    dealt = dealt.select("bucket", "node", "label", "n_shingles", "odd", "block", F.explode(tiles).alias("t")).select(
        "*", F.col("t.a").alias("tile_a"), F.col("t.b").alias("tile_b")).drop("t")
    schema = "bucket long, node binary, label binary, n_shingles long, block int, tile_a int, tile_b int"
    close = checkpointed(dealt.groupBy(*_TILE).applyInArrow(lambda t: _search(t, by), schema))
    found = _full_sets(close.select("node").distinct(), classes, texts)
    more = checkpointed(close.join(found, "node").groupBy(*_TILE).applyInArrow(lambda t: _link(t, by), "u binary, v binary"))
    labels = components(links.union(more), "u", "v")

    named = (classes.select("node", "least_id").join(labels, "node", "left")
             .select("node", "least_id", F.coalesce("label", "node").alias("label")))
    least = named.groupBy("label").agg(F.min("least_id").alias("component_id"))
    by_node = named.join(least, "label").select("node", "component_id", "label")
    r = rows.select("doc_id", "text_key", "n_shingles", "node")
    return r.join(by_node, "node", "left").select(
        "doc_id", "text_key", "n_shingles", *["label"] * with_label,
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", link: int = LINK) -> DataFrame:
    """``docs`` with one row of each component, of the least id (then text hash); rows without words all stay.

    Of rows that share id and text the first by all their columns (as JSON) stays, without words
    too. Null ids stay if no row of their component has an id. Columns keep their order and may have any
    name. An empty table stays empty.
    """
    found = near(docs, id_col, text_col, with_label=True, link=link)
    per_row = found.where("kept and label is not null").groupBy("label", "doc_id", "text_key").agg(F.count(F.lit(1)).alias("n"))
    one = per_row.groupBy("label").agg(F.min(F.struct("doc_id", "text_key", "n")).alias("f")).select("f.*")
    stays = one.unionByName(found.where("label is null").select("doc_id", "text_key", F.lit(1).alias("n")).distinct())
    names = docs.columns
    d = docs.select(F.struct(*map(c, names)).alias("row"), F.col(id_col).cast("long").alias("id"),
                    row_key(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("key"))
    joined = d.join(stays, d.id.eqNullSafe(stays.doc_id) & (d.key == stays.text_key))
    # rows that share id and text: the first by all columns, whoever evaluates it
    repeats = joined.where("n > 1").groupBy("id", "key").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return joined.where("n = 1").select("row.*").unionByName(repeats.select("row.*"))
