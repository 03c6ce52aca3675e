"""Document fingerprints by SpotSigs: content words that follow common-word anchors.

Each anchor (a common word of the language, or a word that its own hash picks, which code, lists and
other languages have too) is followed by a chain of the next content words; anchor and chain make
one signature, whatever the rest of the text holds. The fingerprint of a text is the sorted set of its
signature hashes, as hex, repeats numbered apart. Two are compared by Jaccard similarity; sets whose
lengths alone rule out the wanted similarity are not compared at all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Remembered, forgetting, mix64, partitions, row_key, text_or_empty

#: Common words that anchor a chain.
ANCHORS = frozenset("""
the a an of to and in is that for it as was with be by on at from this are or not
der die das und ist von zu den mit für auf des dem ein eine nicht sich auch als im
le la les de des et en un une est que pour dans avec du au par sur pas ne
el los las y en es por con para su del al se lo como más una
""".split())
#: Content words of a chain, and hex digits of a signature.
CHAIN, DIGITS = 2, 8
#: One content word in so many is an anchor too, by its hash.
PICKED = 3
_SALTS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def _word_value(word: str) -> int:
    """Hash of the word's letters and digits, odd for an anchor, 0 without any."""
    plain = word if word.isalnum() else "".join(c for c in word if c.isalnum())
    if not plain:
        return 0
    return xxhash.xxh3_64_intdigest(plain.encode("utf-8")) & ~1 | (plain in ANCHORS)


@lru_cache(maxsize=1)
def _words() -> Remembered:
    return Remembered(_word_value)


def signatures(text: str) -> np.ndarray:
    """Sorted 32-bit signatures of a whole text; a repeated signature counts as often as it occurs.

    The word of the least hash anchors a chain as long as the text gives, so that each text with words has one.
    """
    words = text.lower().split()
    value = np.fromiter(map(_words().__getitem__, words), np.uint64, len(words))
    value = value[value != 0]
    if not len(value):
        return np.empty(0, np.uint32)
    anchor = (value & np.uint64(1)).astype(bool)
    content, following = value[~anchor], np.cumsum(~anchor)  # content words up to each place, its own included
    picked = anchor | ((value >> np.uint64(1)) % np.uint64(PICKED) == 0)
    places = np.flatnonzero(picked & (following + CHAIN <= len(content)))
    h = value[places] * _SALTS[0]
    for k in range(CHAIN):
        h = mix64(h ^ (content[following[places] + k] * _SALTS[1 + k % 2]))
    least = int(value.argmin())
    chain = content[following[least]:following[least] + CHAIN]
    one = value[least:least + 1] * _SALTS[2]
    for k in range(len(chain)):
        one = mix64(one ^ (chain[k:k + 1] * _SALTS[1 + k % 2]))
    h = np.sort(np.concatenate([h, one]))
    first = np.concatenate([[True], h[1:] != h[:-1]])
    repeat = np.arange(len(h)) - np.flatnonzero(first)[np.cumsum(first) - 1]
    h = mix64(h + repeat.astype(np.uint64) * _SALTS[0])  # the k-th occurrence is an element of its own: a multiset
    return np.unique((h >> np.uint64(32)).astype(np.uint32))


def to_text(sigs: np.ndarray) -> str:
    return sigs.astype(">u4").tobytes().hex()


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u4")


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard similarity of two signature sets; 0 unseen if their lengths cannot give ``least``.

    Two empty sets are alike (1), an empty and a filled one are not (0).
    """
    short, long = sorted((len(a), len(b)))
    if long == 0:
        return 1.0
    if short < least * long or short == 0:
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (short + long - both)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_signatures, fingerprint`` of every whole text (null: empty, whose fingerprint is empty)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [signatures(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(map(len, sets)), pa.int64()),
                                              pa.array(list(map(to_text, sets)), pa.string())],
                                             ["doc_id", "n_signatures", "fingerprint"])

    return text_or_empty(docs, id_col, text_col).mapInArrow(forgetting(run, _words), "doc_id long, n_signatures long, fingerprint string")


def length_class(n, least: float):
    """Class of a set length; sets alike by ``least`` or more lie in the same or in neighbouring classes."""
    return F.floor(F.log(F.greatest(n, F.lit(1))) / F.log(F.lit(1 / least))).cast("int")


def similar(docs: DataFrame, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pairs ``a, b, likeness`` of different fingerprints alike by ``least`` or more, with ``n_a, n_b`` texts each.

    Equal fingerprints are one row, named by its least id. Sets are partitioned by length class.
    Within a class a pair must share one of the rarest signatures of either set (a prefix whose
    length follows from the set's own), so frequent signatures are never joined on. Empty sets
    have no pairs.
    """
    sets = (fingerprints(docs, id_col, text_col).where("n_signatures > 0").groupBy("fingerprint")
            .agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("n"), F.first("n_signatures").alias("size")))
    pieces = F.transform(F.sequence(F.lit(0).cast("long"), F.col("size") - 1),
                         lambda i: F.substring(F.col("fingerprint"), (i * DIGITS + 1).cast("int"), F.lit(DIGITS)))
    sets = sets.withColumn("sigs", pieces)
    rarity = sets.select(F.explode("sigs").alias("sig")).groupBy("sig").agg(F.count(F.lit(1)).alias("df"))
    listed = (sets.select("fingerprint", "size", F.explode("sigs").alias("sig")).join(rarity, "sig")
              .groupBy("fingerprint", "size").agg(F.sort_array(F.collect_list(F.struct("df", "sig"))).alias("by_df")))
    keep = (F.col("size") - F.ceil(F.col("size") * least) + 1).cast("int")
    keys = listed.select("fingerprint", "size", length_class(F.col("size"), least).alias("class"),
                         F.explode(F.slice("by_df.sig", 1, keep)).alias("sig"))
    left = keys.select("sig", F.explode(F.array(F.col("class"), F.col("class") + 1)).alias("class"),
                       F.col("fingerprint").alias("fa"), F.col("size").alias("na"))
    right = keys.select("sig", "class", F.col("fingerprint").alias("fb"), F.col("size").alias("nb"))
    small, large = F.least("na", "nb"), F.greatest("na", "nb")
    pairs = (left.join(right, ["sig", "class"])
             .where((F.col("fa") != F.col("fb")) & (small >= large * least))
             .select(F.least("fa", "fb").alias("fa"), F.greatest("fa", "fb").alias("fb")).distinct())
    a = sets.select(F.col("fingerprint").alias("fa"), F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("sigs").alias("sa"))
    b = sets.select(F.col("fingerprint").alias("fb"), F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("sigs").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    alike = both / (F.size("sa") + F.size("sb") - both)
    return (pairs.join(a, "fa").join(b, "fb").withColumn("likeness", alike)
            .where(F.col("likeness") >= least).select("a", "b", "n_a", "n_b", "likeness"))


def _edited(text: str, following: str) -> str:
    """The last third of the code points replaced by as many of the next text's first ones."""
    cut = len(text) // 3
    return text[:len(text) - cut] + following[:cut]


_COLS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by (stretch, ghost, order); each is answered when its successor is read."""
    stretch = doc_id = text = sigs = None
    for batch in batches:
        out = [[] for _ in _COLS]
        for s, ghost, i, t in zip(*(c.to_pylist() for c in batch.columns)):
            mine = signatures(t)
            if stretch == s and text is not None:
                new = _edited(text, t)
                changed = signatures(new) if new != text else sigs
                row = (doc_id, len(text), hashlib.sha256(new.encode("utf-8")).hexdigest(), to_text(sigs),
                       to_text(changed), likeness(sigs, changed), likeness(sigs, mine))
                for col, v in zip(out, row):
                    col.append(v)
            stretch, doc_id, text, sigs = s, i, (None if ghost else t), mine
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(out, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(),
                                                  pa.float64(), pa.float64()))], _COLS)


def against_edited_and_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each fingerprint beside that of the edited text and of the next document by descending id.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.
    The documents are dealt into stretches of the id order; the first row of each stretch also
    ends the stretch before it, and the first of all ends the last, so that each row meets its
    successor in one task. Rows with equal ids follow by text hash, null ids come last; whole
    repeats follow each other. An empty table gives no rows.
    """
    n = partitions(docs)
    rows = text_or_empty(docs, id_col, text_col)
    rows = rows.select("doc_id", "text", F.col("doc_id").isNull().cast("int").alias("no_id"),
                       F.bitwise_not(F.coalesce("doc_id", F.lit(0))).alias("down"), row_key(F.col("text")).alias("text_key"),
                       F.coalesce(-F.col("doc_id").cast("double"), F.lit(float("inf"))).alias("place"))
    cuts = rows.where("no_id = 0").approxQuantile("place", [k / n for k in range(1, n)], 0.2 / n) if n > 1 else []
    splits = [-float("inf"), *sorted({0.0} | {c for c in cuts if abs(c) < float("inf")}), float("inf")]
    rows = Bucketizer(splits=splits, inputCol="place", outputCol="stretch").transform(rows)
    order = ["no_id", "down", "text_key"]
    # one row for each stretch: as many as the shuffle has partitions
    heads = sorted(rows.groupBy("stretch").agg(F.min(F.struct(*order)).alias("o")).select("stretch", "o.*").collect())
    columns = ["doc_id", "text", "stretch", *order]
    if not heads:
        return docs.sparkSession.createDataFrame(
            [], "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
            "near_edited double, near_next double")
    ends = docs.sparkSession.createDataFrame(
        [(h[1], h[2], h[3], heads[k - 1][0]) for k, h in enumerate(heads)],
        "no_id int, down long, text_key long, stretch double")
    ghosts = rows.drop("stretch").join(F.broadcast(ends), order).select(*columns).withColumn("ghost", F.lit(1))
    dealt = rows.select(*columns).withColumn("ghost", F.lit(0)).unionByName(ghosts)
    return (dealt.repartitionByRange(n, "stretch").sortWithinPartitions("stretch", "ghost", *order)
            .select("stretch", "ghost", "doc_id", "text")
            .mapInArrow(forgetting(_compare, _words), "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                        "edited_fingerprint string, near_edited double, near_next double"))
