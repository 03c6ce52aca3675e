"""Ranked lexical search by NRA: sequential reads of impact-sorted lists between score bounds.

Every task cuts its documents into shards of bounded size. A shard's postings of the query
terms are sorted by impact, and each item reads the lists of its terms from the top, block after
block. A document's lower bound is the sum of the impacts read for it, its upper bound adds the
last impact read of every list in which it was not met. Reading goes on until no other document
can enter the best k or tie with them and the bounds of those k have met. What the task's
earlier shards gave for an item counts from the start. The tasks' lists are merged in two levels.

Statistics (documents, terms, document frequencies) come from a first pass over all documents.
Items travel in blocks of bounded size, each against all documents.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import partitions, text_or_empty

#: Terms of all items of one block, about; a block's terms, frequencies and items are broadcast.
BLOCK_TERMS = 1_000_000
#: Postings or documents that end a shard; first entries that are read of a list.
SHARD_POSTINGS, SHARD_DOCS, FIRST_READ = 2_000_000, 32_768, 64
#: Fixed values of the score: scale, saturation and length weights in hundredths.
SCALE, K_TIMES, B_HUNDREDTHS = 1000, 8, 90
#: Salts of the merge's first level.
SALTS = 32
_NO_ID = np.iinfo(np.int64).max
_LETTERS = (string.digits + string.ascii_letters).encode()
_FOLD = bytes(b if b >= 0x80 or b in _LETTERS else 0x20 for b in range(256)).lower()


class _Vocabulary(dict):
    """Term -> number, -1 for the terms of no item."""

    def __missing__(self, term):
        return -1


def terms(text: bytes) -> list[bytes]:
    """Terms of a whole UTF-8 text in order: runs of ASCII letters, digits and all other characters beyond ASCII."""
    return text.translate(_FOLD).split()


def _term_set(text: Column) -> Column:
    """The distinct terms of a text column, by the same rule."""
    folded = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.array_distinct(F.regexp_extract_all(folded, F.lit(r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"), F.lit(1)))


def _counted(texts: list[bytes], vocabulary: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms with repeats of each text; and of each text and vocabulary term in it: text, term, occurrences."""
    found = [terms(t) for t in texts]
    n = np.fromiter(map(len, found), np.int64, len(found))
    number = np.fromiter((vocabulary[t] for f in found for t in f), np.int64, int(n.sum()))
    key = np.repeat(np.arange(len(found)), n) * max(1, len(vocabulary)) + number
    key, tf = np.unique(key[number >= 0], return_counts=True)
    return n, key // max(1, len(vocabulary)), key % max(1, len(vocabulary)), tf


def _statistics(shared):
    """Task: partial sums of document frequencies by term number; -1 counts documents with a term, -2 all terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _Vocabulary(shared.value[0])
        df, docs, total = np.zeros(len(vocabulary), np.int64), 0, 0
        for batch in batches:
            n, _, term, _ = _counted(batch.column(1).cast(pa.binary()).to_pylist(), vocabulary)
            df += np.bincount(term, minlength=len(df))
            docs, total = docs + int((n > 0).sum()), total + int(n.sum())
        met = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-1, -2], met])),
                                          pa.array(np.concatenate([[docs, total], df[met]]))], ["term", "n"])
    return run


class Shard:
    """Impact-sorted lists over some documents; ``ids`` break ties, smaller first."""

    def __init__(self, ids: np.ndarray, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, n_terms: int):
        filled = impact > 0
        doc, term, impact = doc[filled], term[filled], impact[filled]
        order = np.lexsort((-impact, term))
        self.ids, self.doc, self.impact = ids, doc[order], impact[order]
        self.starts = np.searchsorted(term[order], np.arange(n_terms + 1))

    def best(self, query: np.ndarray, k: int, known: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """The k best of ``known`` and of this shard as (-score, id), in order; sums stay exact below 2**53.

        Each round reads as much of every list again as was read before it.
        """
        lists = [t for t in query if self.starts[t] < self.starts[t + 1]]
        starts, ends = self.starts[lists], self.starts[[t + 1 for t in lists]]
        read, depth = starts.copy(), FIRST_READ
        doc, of, impact = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        open_, alive = True, np.ones(len(self.ids), bool)
        while True:
            stop = np.minimum(starts + depth, ends)
            at = np.concatenate([np.empty(0, np.int64), *map(np.arange, read, stop)])
            new_of = np.repeat(np.arange(len(lists)), stop - read)
            if not open_:  # no document that was not met before matters, nor one that fell out
                wanted = alive[self.doc[at]]
                at, new_of = at[wanted], new_of[wanted]
            doc, of = np.concatenate([doc, self.doc[at]]), np.concatenate([of, new_of])
            impact = np.concatenate([impact, self.impact[at]])
            read, depth = stop, depth * 2
            # nothing unread of a list exceeds its last impact read
            frontier = np.where(read < ends, self.impact[np.maximum(read, 1) - 1], 0) if lists else np.empty(0, np.int64)
            rest = int(frontier.sum())
            lower = np.bincount(doc, impact, len(self.ids)).astype(np.int64)
            upper = lower + rest - np.bincount(doc, frontier[of], len(self.ids)).astype(np.int64)
            met = np.flatnonzero((lower > 0) & alive)
            top = self._top(met, lower, k, known)
            if len(top) == k:
                score, last = -top[-1][0], top[-1][1]
                open_ = open_ and rest >= score
                alive &= (upper > score) | ((upper == score) & (self.ids <= last))
            else:
                open_ = open_ and rest > 0
            if not open_:
                seen = np.zeros(len(alive), bool)
                seen[met] = True
                alive &= seen
                left = np.flatnonzero(alive)
                if (lower[left] == upper[left]).all():
                    return self._top(left, lower, k, known)
                keep = alive[doc]
                doc, of, impact = doc[keep], of[keep], impact[keep]

    def _top(self, docs: np.ndarray, lower: np.ndarray, k: int, known: list[tuple[int, int]]) -> list[tuple[int, int]]:
        if len(docs) > k:
            least = np.partition(lower[docs], -k)[-k]
            docs = docs[lower[docs] >= least]
            docs = docs[np.lexsort((self.ids[docs], -lower[docs]))[:k]]
        return sorted(known + list(zip((-lower[docs]).tolist(), self.ids[docs].tolist())))[:k]


def _search(shared, k: int):
    """Task: each item's k best documents of the partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, items, weight, docs, total = shared.value
        vocabulary = _Vocabulary(words)
        best: list[list[tuple[int, int]]] = [[] for _ in items]
        held: list[tuple] = []
        postings = rows = 0

        def close():
            at = np.cumsum([0] + [len(h[0]) for h in held])
            ids, n, term, tf = (np.concatenate([h[c] for h in held]) for c in (0, 1, 3, 4))
            doc = np.concatenate([h[2] + a for h, a in zip(held, at)])
            m = 100 - B_HUNDREDTHS + (B_HUNDREDTHS * n * docs) // max(total, 1)
            impact = weight[term] * ((1_000_000_000 * tf) // (SCALE * tf + K_TIMES * m[doc]))
            shard = Shard(ids, doc, term, impact, len(words))
            for j, (_, query) in enumerate(items):
                best[j] = shard.best(query, k, best[j])
            held.clear()

        for batch in batches:
            ids = np.array([_NO_ID if i is None else i for i in batch.column(0).to_pylist()], np.int64)
            n, doc, term, tf = _counted(batch.column(1).cast(pa.binary()).to_pylist(), vocabulary)
            held.append((ids, n, doc, term, tf))
            postings, rows = postings + len(term), rows + len(ids)
            if postings >= SHARD_POSTINGS or rows >= SHARD_DOCS:
                close()
                postings = rows = 0
        if held:
            close()
        out = [(j, items[j][0], None if i == _NO_ID else i, -s) for j, found in enumerate(best) for s, i in found]
        cols = list(zip(*out)) or [(), (), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                                         ["item", "item_id", "doc_id", "score"])
    return run


def rank(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score`` of each item's ``k`` best documents with a score above 0.

    Equal scores rank by ascending id, a null id last. A null or empty text has no term: as a
    document it is never found nor counted, as an item it gives no rows. Each row of ``docs``
    is a document, also when id and text repeat; whole repeats of an item count once, items of equal id and other
    text are ranked each for itself. Columns besides the named ones are ignored, whatever their
    names. Empty tables give no rows. ``block_terms`` bounds what is broadcast at a time.
    """
    rows = text_or_empty(docs, id_col, text_col)
    asked = text_or_empty(items, item_col, item_text_col).distinct().select("doc_id", "text", _term_set(F.col("text")).alias("terms"))
    spark, schema = docs.sparkSession, "item int, item_id long, doc_id long, score long"
    size = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = max(1, -(-size // block_terms))
    found = []
    for b in range(blocks):
        part = asked.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)) == b) if blocks > 1 else asked
        part = part.where(F.size("terms") > 0).select("doc_id", "terms").collect()
        words = {t.encode("utf-8"): None for r in part for t in r.terms}
        words = {t: i for i, t in enumerate(words)}
        queries = [(r.doc_id, np.array([words[t.encode("utf-8")] for t in r.terms])) for r in part]
        sums = dict(rows.mapInArrow(_statistics(spark.sparkContext.broadcast((words,))), "term long, n long")
                    .groupBy("term").agg(F.sum("n").alias("n")).collect())  # a block's terms at most
        n, total = sums.get(-1, 0), sums.get(-2, 0)
        df = np.array([sums.get(i, 0) for i in range(len(words))], np.float64)
        weight = np.floor(1000 * np.log((2 * n + 2) / (2 * df + 1))).astype(np.int64)
        shared = spark.sparkContext.broadcast((words, queries, weight, n, total))
        found.append(rows.mapInArrow(_search(shared, k), schema).withColumn("block", F.lit(b)))
    best = found[0]
    for f in found[1:]:
        best = best.unionByName(f)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    salt = F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS))
    for keys in (["block", "item", "salt"], ["block", "item"]):
        w = Window.partitionBy(*keys).orderBy(*order)
        best = best.withColumn("salt", salt).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return best.select("item_id", "rank", "doc_id", "score")


RANK_SQL = r"""with d as (select row_number() over () as r, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as t from documents where text is not null),
i as (select row_number() over () as i, item_id, list_distinct(
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as t
    from (select distinct item_id, text from benchmark where text is not null)),
it as (select i, item_id, unnest(t) as term from i),
c as (select count(*) as n_docs, sum(len(t))::bigint as l from d where len(t) > 0),
tf as (select r, doc_id, n, term, count(*) as tf from (select r, doc_id, len(t) as n, unnest(t) as term from d)
    where term in (select term from it) group by all),
w as (select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * df + 1)::double))::bigint as w
    from (select term, count(*) as df from tf group by term), c),
s as (select i, item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // l))))::bigint as score
    from it join tf using (term) join w using (term), c group by all)
select item_id, rank, doc_id, score from (
    select *, row_number() over (partition by i order by score desc, doc_id nulls last)::integer as rank from s where score > 0)
where rank <= 10"""
