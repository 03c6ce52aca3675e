"""Language identification by Bayesian fusion of text, markup, address and host evidence.

The text's likelihood under each language comes from hashed character n-grams. Grouped counts of
the texts' own verdicts, over all rows, give a prior for each host, smoothed towards its address
suffix and that towards the whole; and how probable each declared language is in texts of a
language. The posterior of a row is the product of the three.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import REMEMBERED_WORDS, checkpointed, mix64, row_key

#: Sample texts of each language that are fetched for training at most.
MAX_PER_LANGUAGE = 300
#: Rows of the n-gram table, n-gram lengths in bytes, smoothing count.
BUCKETS, GRAMS, SMOOTH = 1 << 16, (2, 3, 4), 0.5
#: Weight of the text's log-likelihood (n-grams overlap, so they are not independent).
TEMPER = 0.25
#: Rows that the next level's prior counts as in a host's or suffix's.
PRIOR_ROWS = 20.0
#: A row is rejected if no language is likelier than all others together, if fewer of its n-grams are
#: known from any language, or if fewer of its words can be read in any language.
LEAST_POSTERIOR, LEAST_KNOWN, LEAST_READ = 0.5, 0.3, 0.3
#: A word can be read in a language if its n-grams have on average more than this: what each of the
#: table's rows would have if all were equally likely. Rows drawn blindly never have more on average.
LEAST_LIKELY = -float(np.log(BUCKETS))


def gram_keys(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the n-grams that start at each byte of the marked words (0: none), and the words' starts.

    Different n-grams have different keys: length and bytes fill less than 64 bits, and mix64 is one-to-one.
    """
    marked = [b"<" + w.encode("utf-8") + b">" for w in words]
    size = np.array([len(m) for m in marked], np.int64)
    data = np.frombuffer(b"".join(marked), np.uint8).astype(np.uint64)
    start = np.cumsum(size) - size
    room = np.repeat(start + size, size) - np.arange(len(data))
    keys = np.zeros((len(GRAMS), len(data)), np.uint64)
    for k, n in enumerate(GRAMS):
        code = np.full(max(0, len(data) - n + 1), n, np.uint64)
        for i in range(n):
            code = code << np.uint64(8) | data[i:i + len(code)]
        keys[k, :len(code)] = np.where(room[:len(code)] >= n, mix64(code), np.uint64(0))
    return keys, start


def table_rows(keys: np.ndarray) -> np.ndarray:
    """Table rows of n-grams (BUCKETS: none)."""
    return np.where(keys != 0, (keys % np.uint64(BUCKETS)).astype(np.int64), BUCKETS)


class Evidence:
    """Words' evidence in rows of one bounded matrix, worked out for all new words of a text at once."""

    def __init__(self, model: Model):
        self.table = np.zeros((BUCKETS + 1, len(model.names) + 1), np.float32)
        self.table[:-1] = np.column_stack([model.table, np.ones(BUCKETS)])
        bits = len(model.known).bit_length() + 2
        self.shift = np.uint64(64 - bits)
        self.first = np.searchsorted(model.known, np.arange(1 << bits, dtype=np.uint64) << self.shift)
        self.known = np.append(model.known, np.uint64(np.iinfo(np.uint64).max))
        self.place: dict[str, int] = {}
        self.rows = np.zeros((REMEMBERED_WORDS, self.table.shape[1] + 3), np.float32)

    def is_known(self, keys: np.ndarray) -> np.ndarray:
        """Which n-grams the training texts hold: steps from the first known key with the same leading bits."""
        at = self.first[(keys >> self.shift).astype(np.int64)]
        low = np.flatnonzero(self.known[at] < keys)
        while low.size:
            at[low] += 1
            low = low[self.known[at[low]] < keys[low]]
        return self.known[at] == keys

    def of(self, text: str) -> np.ndarray:
        """Log-likelihoods, number of n-grams and of those known, of words that can be read and of words.

        Words of digits alone do not count.
        """
        words = [w for w in text.lower().split() if not w.isdigit()]
        total = np.zeros(self.rows.shape[1])
        for k in range(0, len(words), REMEMBERED_WORDS // 4):
            part = words[k:k + REMEMBERED_WORDS // 4]
            new = list(set(part).difference(self.place))
            if len(self.place) + len(new) > REMEMBERED_WORDS:
                self.place.clear()
                new = list(set(part))
            if new:
                at = len(self.place)
                self.place.update(zip(new, range(at, at + len(new))))
                keys, start = gram_keys(new)
                ll = sum(np.add.reduceat(self.table[r], start) for r in table_rows(keys))
                hits = sum(np.add.reduceat(self.is_known(k), start, dtype=np.int64) for k in keys)
                readable = ll[:, :-1].max(axis=1) > LEAST_LIKELY * ll[:, -1]
                self.rows[at:at + len(new)] = np.column_stack([ll, hits, readable, np.ones(len(new))])
            index = np.fromiter(map(self.place.__getitem__, part), np.int64, len(part))
            total += self.rows[index].sum(axis=0, dtype=np.float64)
        return total


@dataclass
class Model:
    """Names of the languages; log-probability of each table row in each; sorted keys of all n-grams of the training."""

    names: list[str]
    table: np.ndarray
    known: np.ndarray


def train(texts: list[str], langs: list[str]) -> Model:
    names = sorted(set(langs))
    counts, known = np.zeros((BUCKETS, max(1, len(names)))), np.empty(0, np.uint64)
    for k, name in enumerate(names):
        times = Counter(w for t, x in zip(texts, langs) if x == name for w in t.lower().split())
        if times:
            keys, start = gram_keys(list(times))
            weight = np.repeat(np.fromiter(times.values(), np.float64), np.diff([*start, keys.shape[1]]))
            counts[:, k] = sum(np.bincount(r, weight, BUCKETS + 1)[:-1] for r in table_rows(keys))
            known = np.union1d(known, keys[keys != 0])
    table = np.log((counts + SMOOTH) / (counts.sum(axis=0) + SMOOTH * BUCKETS))
    return Model(names or ["und"], table.astype(np.float32), known)


def train_on(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model from a bounded sample of each language, by a hash of id and text."""
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"),
        F.xxhash64(F.col(id_col).cast("long"), F.col(text_col)).alias("h"))
    ids = rows.select("lang", "h").distinct()
    for part in (F.pmod("h", F.lit(64)), F.lit(0)):  # first within slices of a language, which may hold most rows
        first = Window.partitionBy("lang", part).orderBy("h")
        ids = ids.withColumn("k", F.row_number().over(first)).where(F.col("k") <= MAX_PER_LANGUAGE)
    got = rows.join(F.broadcast(ids.select("lang", "h")), ["lang", "h"]).dropDuplicates(["h"]).collect()
    got.sort(key=lambda r: (r.lang, r.h))
    return train([r.text for r in got], [r.lang for r in got])


def identify(items: DataFrame, model: Model) -> DataFrame:
    """``items`` without their text, with ``lang, text_lang, posterior, known, keep``.

    ``items`` has ``text, declared, suffix, host`` and any columns that name a row (none of the
    names above). ``known`` is the share of the text's n-grams that the training texts hold. A null or
    empty text, or one that is mostly of other n-grams than theirs, is rejected as ``und``. Null
    declared languages say nothing; null hosts and suffixes are a group of their own. Ties go to
    the first language by name. An empty table gives none.
    """
    names, shared = model.names, items.sparkSession.sparkContext.broadcast(model)
    carried = [c for c in items.columns if c != "text"]
    out = items.select(*carried, F.array().cast("array<double>").alias("ll")).schema
    at = items.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evidence = Evidence(shared.value)
        for batch in batches:
            ll = [evidence.of(t.as_py() or "") for t in batch.column(at)]
            cols = [batch.column(k) for k in range(batch.num_columns) if k != at]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(ll, pa.list_(pa.float64()))], [*carried, "ll"])

    scored = items.mapInArrow(run, out)
    n = len(names)
    ll = F.slice("ll", 1, n)
    scored = checkpointed(scored.select(
        *carried, F.transform(ll, lambda x: x * TEMPER).alias("ll"), F.element_at("ll", n + 1).alias("n_grams"),
        F.element_at("ll", n + 2).alias("n_seen"), F.element_at("ll", n + 3).alias("n_read"),
        F.element_at("ll", n + 4).alias("n_words"),
        (F.array_position(ll, F.array_max(ll)) - 1).cast("int").alias("best")))
    voice = scored.where("n_seen > 0")
    votes = [F.sum((F.col("best") == k).cast("long")).alias(f"v{k}") for k in range(n)]
    total = lambda p: sum((F.col(f"{p}{k}") for k in range(1, n)), F.col(f"{p}0"))
    host = voice.groupBy("suffix", "host").agg(*votes)
    suffix = host.groupBy("suffix").agg(*[F.sum(f"v{k}").alias(f"s{k}") for k in range(n)])
    whole = suffix.agg(*[F.coalesce(F.sum(f"s{k}"), F.lit(0)).alias(f"w{k}") for k in range(n)])
    share = lambda p, k, up, rows: (F.col(f"{p}{k}") + rows * up) / (total(p) + rows)
    of_all = [(F.col(f"w{k}") + 1) / (total("w") + n) for k in range(n)]
    suffix = suffix.join(F.broadcast(whole)).select(
        "suffix", *[share("s", k, of_all[k], PRIOR_ROWS).alias(f"p{k}") for k in range(n)])
    host = host.alias("h").join(suffix.alias("s"), F.col("h.suffix").eqNullSafe(F.col("s.suffix"))).select(
        F.col("h.suffix").alias("hs"), F.col("h.host").alias("hh"),
        F.array(*[F.log(share("v", k, F.col(f"p{k}"), PRIOR_ROWS)) for k in range(n)]).alias("prior"))
    said = voice.where("declared is not null").groupBy("declared").agg(*votes)
    of_lang = said.agg(*[F.sum(f"v{k}").alias(f"n{k}") for k in range(n)], F.count(F.lit(1)).alias("kinds"))
    said = said.join(F.broadcast(of_lang)).select(
        F.col("declared").alias("d"),
        F.array(*[F.log((F.col(f"v{k}") + 1) / (F.col(f"n{k}") + F.col("kinds"))) for k in range(n)]).alias("saying"))
    flat = F.array(*[F.lit(0.0)] * n)
    fused = (scored.join(host, F.col("suffix").eqNullSafe(F.col("hs")) & F.col("host").eqNullSafe(F.col("hh")), "left")
             .join(said, F.col("declared") == F.col("d"), "left"))
    plus = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    fused = fused.withColumn("lp", plus(plus(F.col("ll"), F.coalesce("prior", flat)), F.coalesce("saying", flat)))
    fused = fused.withColumn("top", F.array_max("lp"))
    weight = F.aggregate("lp", F.lit(0.0), lambda s, x: s + F.exp(x - F.col("top")))
    tongue = F.array(*[F.lit(x) for x in names])
    known = F.when(F.col("n_grams") > 0, F.col("n_seen") / F.col("n_grams")).otherwise(F.lit(0.0))
    read = F.col("n_read") >= LEAST_READ * F.col("n_words")
    keep = (known >= LEAST_KNOWN) & read & (1 / weight >= LEAST_POSTERIOR)
    place = F.array_position("lp", F.col("top")).cast("int")
    return fused.select(*carried, F.when(keep, F.element_at(tongue, place)).otherwise("und").alias("lang"),
                        F.when(F.col("n_seen") > 0, F.element_at(tongue, F.col("best") + 1)).otherwise("und").alias("text_lang"),
                        (1 / weight).alias("posterior"), known.alias("known"), keep.alias("keep"))


def tag(column):
    """Primary part of a declared language, lower case; null if there is none."""
    t = F.regexp_extract(F.lower(column), "^[^a-z]*([a-z]{2,3})\\b", 1)
    return F.when(t != "", t)


def from_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                   source_col: str = "source") -> DataFrame:
    """Items of plain documents: the declared language is a column, the source stands for the host."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("page_id"),
                       row_key(F.coalesce(F.col(text_col), F.lit(""))).alias("text_key"), F.col(text_col).alias("text"),
                       tag(F.col(lang_col)).alias("declared"), F.lit(None).cast("string").alias("suffix"),
                       F.col(source_col).alias("host"))


def from_pages(pages: DataFrame) -> DataFrame:
    """Items of web pages: text outside tags, scripts and styles; the html tag's language; the address."""
    html = F.coalesce("html", F.lit(""))
    shown = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&[a-z#0-9]+;", " ")
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1))
    host = F.when(host != "", host)
    return pages.select(F.lit(None).cast("long").alias("doc_id"), F.col("page_id").cast("long").alias("page_id"),
                        row_key(html).alias("text_key"), shown.alias("text"),
                        tag(F.regexp_extract(html, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z-]+)", 1)).alias("declared"),
                        F.regexp_extract(host, r"([^.]+)$", 1).alias("suffix"), host.alias("host"))


def keep_identified(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose language stays open.

    Null and empty texts go; rows alike in id and text go or stay together; null ids and all columns,
    whatever their names, are kept. Without any declared language nothing can be learnt and every row
    goes. An empty table stays empty.
    """
    items = from_documents(docs)
    kept = identify(items, train_on(docs)).where("keep").select("doc_id", "text_key").distinct().alias("k")
    d = docs.alias("d")
    return d.join(kept, F.col("d.doc_id").cast("long").eqNullSafe(F.col("k.doc_id"))
                  & (row_key(F.coalesce(F.col("d.text"), F.lit(""))) == F.col("k.text_key")), "left_semi")
