"""Suffix-array dedup: every byte covered by a 200-byte string that also starts elsewhere goes.

Only some suffixes are sorted. Every 200-byte window names one place in it, its anchor: the
leftmost of its 128-byte strings of least hash. Equal windows have their anchors at equal
offsets, so it is enough to compare the suffixes that start at anchors, each with the bytes
before it that its windows reach. An anchor whose 128-byte string occurs once in the corpus has
no equal window and is left out (its distinguishing prefix is already known).

Each task sorts its suffixes into runs, one for each receiver (a hash of the first 128 bytes),
front-codes them (bytes shared with the suffix before, then the rest) and sends them. A receiver
merges its runs with a loser tree whose nodes keep the length of the prefix that a loser shares
with the winner; a comparison starts behind what is known to be equal. The merged order comes
with the shared prefix of neighbours, which says for every offset which windows are equal.

Strings that very many suffixes begin with are not sent to one receiver: their windows are sent
one by one, each by the hash of its own 200 bytes, where equal ones of a run are one entry.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import checkpointed, mix64, partitions, row_key, text_or_empty

#: Length of a repeated string, of an anchor's string, and the number of anchor strings of a window.
LENGTH, GRAM = 200, 128
SPAN = LENGTH - GRAM + 1
#: Suffixes with equal first GRAM bytes beyond which windows are sent one by one.
HOT = 20_000
#: Suffixes that one receiver merges, about.
PER_PART = 40_000
#: Hot strings up to which their hashes are broadcast (8 bytes each).
MAX_BROADCAST = 100_000
#: Bytes of whole documents that are hashed at once.
CHUNK = 1 << 19
_PLACE = np.uint64((1 << 31) - 1)
_RNG = np.random.default_rng(11)
_BYTES = _RNG.integers(0, 2 ** 63, 256, dtype=np.uint64) * np.uint64(2)
_FACTORS = _RNG.integers(0, 2 ** 63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each place, by doubling."""
    h, width = _BYTES[data], 1
    for k in range(GRAM.bit_length() - 1):
        h = h[:-width] * _FACTORS[k] + h[width:]
        width *= 2
    return mix64(h)


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each window of ``width`` keys, by doubling."""
    now = 1
    while now * 2 <= width:
        keys = np.minimum(keys[:-now], keys[now:])
        now *= 2
    rest = width - now
    return np.minimum(keys[:-rest], keys[rest:]) if rest else keys


def anchors(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Of each anchor: text number, place, least and greatest offset of its windows, string hash."""
    length = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    if len(data) < LENGTH:
        return tuple(np.empty(0, np.int64) for _ in range(4)) + (np.empty(0, np.uint64),)
    start = np.cumsum(length) - length
    h = _gram_hashes(data)
    place = np.arange(len(h), dtype=np.uint64)
    of = (_least((h & ~_PLACE) | place, SPAN) & _PLACE).astype(np.int64)
    doc = np.repeat(np.arange(len(texts)), length)[:len(of)]
    window = np.flatnonzero(np.arange(len(of)) + LENGTH <= (start + length)[doc])
    of, doc = of[window], doc[window]
    first = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (doc[1:] != doc[:-1])])[:len(of)])
    last = np.concatenate([first[1:] - 1, [len(of) - 1]]) if len(first) else first
    at = of[first]
    return doc[first], at - start[doc[first]], at - window[last], at - window[first], h[at]


def _chunks(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list[bytes]]]:
    """Number of the first text and some whole texts, CHUNK bytes together unless one is longer."""
    at, held, size = 0, [], 0
    for k, value in enumerate(batch.column(column)):
        t = value.as_py().encode("utf-8")
        if held and size + len(t) > CHUNK:
            yield at, held
            at, held, size = k, [], 0
        held.append(t)
        size += len(t)
    if held:
        yield at, held


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``hash, ref, spot, n``; equal strings of a batch send one witness with their number.

    n = 1: a string that is alone in its batch and waits for a verdict; n > 1: the witness; n = 0:
    one of several in its batch, which stays whatever the others hold, and may go anywhere.
    """
    for batch in batches:
        ref, found = batch.column(0).to_numpy(), []
        for at, texts in _chunks(batch, 1):
            doc, place, low, high, h = anchors(texts)
            found.append((ref[doc + at], place << 16 | high << 8 | low, h.view(np.int64)))
        if not found:
            continue
        ref, spot, h = (np.concatenate(c) for c in zip(*found))
        values, back, n = np.unique(h, return_inverse=True, return_counts=True)
        alone = n[back] == 1
        witness = values[n > 1]
        none = np.zeros(len(witness), np.int64)
        columns = (np.concatenate([h, witness]), np.concatenate([ref, none]), np.concatenate([spot, none]),
                   np.concatenate([alone.astype(np.int64), n[n > 1]]))
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["hash", "ref", "spot", "n"])


def _verdicts(hot: int):
    """Of rows sorted by hash: those whose string occurs again, and a row n = -1 for each hot string."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry = [np.empty(0, np.int64)] * 4
        for batch in batches:
            now = [np.concatenate([c, batch.column(i).to_numpy()]) for i, c in enumerate(carry)]
            if not len(now[0]):
                continue
            cut = int(np.searchsorted(now[0], now[0][-1]))  # the last group may go on in the next batch
            carry = [c[cut:] for c in now]
            yield _decided([c[:cut] for c in now], hot)
        yield _decided(carry, hot)
    return run


def _decided(rows: list[np.ndarray], hot: int) -> pa.RecordBatch:
    h, ref, spot, n = rows
    if len(h):
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        total = np.add.reduceat(n, first)
        again = np.repeat(total, np.diff([*first, len(h)])) > 1
        keep = np.flatnonzero((n == 0) | (n == 1) & again)
        big = h[first[total > hot]]
        h, ref, spot, n = (np.concatenate([c[keep], x]) for c, x in
                           ((h, big), (ref, big * 0), (spot, big * 0), (np.zeros(len(h), np.int64), big * 0 - 1)))
    return pa.RecordBatch.from_arrays([pa.array(c) for c in (h, ref, spot, n)], ["hash", "ref", "spot", "n"])


def shared(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which ``known`` bytes are equal already and are not looked at."""
    n = min(len(a), len(b))
    x = int.from_bytes(a[known:n], "big") ^ int.from_bytes(b[known:n], "big")
    return n - (x.bit_length() + 7) // 8


def front_code(suffixes: list[bytes]) -> tuple[bytes, bytes, bytes]:
    """Bytes shared with the one before, lengths of the rests, the rests; of sorted suffixes."""
    before, common, size, rest = b"", bytearray(), bytearray(), []
    for s in suffixes:
        n = shared(before, s, 0)
        common.append(n)
        size.append(len(s) - n)
        rest.append(s[n:])
        before = s
    return bytes(common), bytes(size), b"".join(rest)


class Run:
    """A sorted run, decoded as it is read: the suffix at hand and what it shares with the one before."""

    __slots__ = ("common", "size", "rest", "at", "offset", "suffix", "known")

    def __init__(self, common: bytes, size: bytes, rest: bytes):
        self.common, self.size, self.rest = common, size, rest
        self.at, self.offset, self.suffix, self.known = -1, 0, b"", 0
        self.step()

    def step(self) -> None:
        self.at += 1
        if self.at == len(self.common):
            self.suffix = None
            return
        self.known = self.common[self.at]
        end = self.offset + self.size[self.at]
        self.suffix = self.suffix[:self.known] + self.rest[self.offset:end]
        self.offset = end


def merge(runs: list[Run]) -> Iterator[tuple[int, int, int]]:
    """Run number, place in the run and prefix shared with the one before, in sorted order.

    A loser tree. ``known`` of a run is what its suffix shares with the last winner that passed
    its node. Of two, the one that shares more with that winner is the smaller; only when both
    share as much are they compared, from there on. A spent run loses to all.
    """
    width = 1
    while width < len(runs):
        width *= 2
    known = [0] * width
    suffix = [r.suffix for r in runs] + [None] * (width - len(runs))

    def beats(a: int, b: int) -> bool:
        """Whether a wins; the loser's known prefix becomes what it shares with the winner."""
        if suffix[b] is None:
            return True
        if suffix[a] is None:
            return False
        if known[a] != known[b]:
            return known[a] > known[b]
        x, y = suffix[a], suffix[b]
        n = shared(x, y, known[a])
        wins = len(x) <= len(y) if n == min(len(x), len(y)) else x[n] < y[n]
        known[b if wins else a] = n
        return wins

    tree = [0] * width
    winners = list(range(width))
    level = width
    while level > 1:  # first round: losers stay in the nodes, winners go up
        level //= 2
        up = []
        for k in range(level):
            a, b = winners[2 * k], winners[2 * k + 1]
            if not beats(a, b):
                a, b = b, a
            tree[level + k] = b
            up.append(a)
        winners = up
    best = winners[0]
    while suffix[best] is not None:
        run = runs[best]
        yield best, run.at, known[best]
        run.step()
        suffix[best], known[best] = run.suffix, run.known
        node = (best + width) // 2
        while node:
            other = tree[node]
            # the common cases without a call
            if suffix[other] is not None:
                if suffix[best] is None or known[other] > known[best]:
                    tree[node], best = best, other
                elif known[other] == known[best] and not beats(best, other):
                    tree[node], best = best, other
            node //= 2


_RUN = "part int, common binary, size binary, rest binary, left binary, left_size binary, entry binary, ids binary"


def _runs(parts: int):
    """Front-coded runs of each batch, one for each receiver that gets something."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_id = batch.column(0).fill_null(0).to_numpy()
            no_id, text_key = batch.column(0).is_null().to_numpy(zero_copy_only=False), batch.column(1).to_numpy()
            copies = batch.column(3).to_numpy()
            dealt: dict[int, dict] = defaultdict(lambda: defaultdict(list))
            for d, (text, spots, hot) in enumerate(zip(batch.column(2), batch.column(4), batch.column(5))):
                t, hot = text.as_py().encode("utf-8"), set(hot.as_py())
                for spot in spots.as_py():
                    place, high, low = spot >> 16, spot >> 8 & 255, spot & 255
                    if spot in hot:
                        for o in range(low, high + 1):
                            window = t[place - o:place - o + LENGTH]
                            key = t[place:place + LENGTH - o], t[place - o:place][::-1]
                            dealt[xxhash.xxh3_64_intdigest(window, o + 1) % parts][key].append((d, place))
                    else:
                        suffix = t[place:place + LENGTH - low]
                        key = suffix, t[place - high:place][::-1]
                        dealt[xxhash.xxh3_64_intdigest(suffix[:GRAM]) % parts][key].append((d, place))
            rows = []
            for part, entries in dealt.items():
                keys = sorted(entries)
                ids = np.array([x for k in keys for x in entries[k]], np.int64)
                count = [len(entries[k]) for k in keys]
                d = ids[:, 0]
                packed = np.stack([doc_id[d], text_key[d], ids[:, 1], no_id[d], np.minimum(copies[d], 2)], axis=1)
                common, size, rest = front_code([k[0] for k in keys])
                rows.append((part, common, size, zlib.compress(rest, 1), zlib.compress(b"".join(k[1] for k in keys), 1),
                             bytes(len(k[1]) for k in keys),
                             np.repeat(np.arange(len(keys)), count).astype(np.int32).tobytes(),
                             packed.astype(np.int64).tobytes()))
                if len(rows) >= 256:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)
    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), *[pa.binary()] * 7]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                      ["part", "common", "size", "rest", "left", "left_size", "entry", "ids"])


_FOUND = "doc_id long, text_key long, no_id boolean, low array<int>, high array<int>"


def _receive(table: pa.Table) -> pa.Table:
    """Repeated windows of one receiver's suffixes: for each text the ranges of their starts."""
    cols = {n: table.column(n).to_pylist() for n in table.column_names if n != "part"}
    runs = [Run(c, s, zlib.decompress(r)) for c, s, r in zip(cols["common"], cols["size"], cols["rest"])]
    base = np.cumsum([0, *(len(r.common) for r in runs)])
    n = int(base[-1])
    order, lcp = np.empty(n, np.int64), np.empty(n, np.int64)
    for k, (r, at, known) in enumerate(merge(runs)):
        order[k], lcp[k] = base[r] + at, known
    right = np.concatenate([np.frombuffer(c, np.uint8).astype(np.int64) + np.frombuffer(s, np.uint8)
                            for c, s in zip(cols["common"], cols["size"])])
    left = np.concatenate([np.frombuffer(s, np.uint8) for s in cols["left_size"]]).astype(np.int64)
    low, high = LENGTH - right, left
    # the bytes before the anchors, backwards, sorted likewise
    grid = np.zeros((n, SPAN), np.uint8)
    grid[np.arange(SPAN) < left[:, None]] = np.frombuffer(b"".join(map(zlib.decompress, cols["left"])), np.uint8)
    by_left = np.argsort(grid.view(f"S{SPAN}").ravel(), kind="stable")
    differ = grid[by_left[1:]] != grid[by_left[:-1]]
    left_lcp = np.concatenate([[0], np.where(differ.any(axis=1), differ.argmax(axis=1), SPAN)])
    ids = np.concatenate([np.frombuffer(x, np.int64).reshape(-1, 5) for x in cols["ids"]])
    entry = np.concatenate([np.frombuffer(x, np.int32).astype(np.int64) + b for x, b in zip(cols["entry"], base)])
    weight = np.bincount(entry, ids[:, 4], n)
    repeated = np.zeros((n, SPAN + 1), bool)
    right_class, left_class = np.empty(n, np.int64), np.empty(n, np.int64)
    for o in range(SPAN):
        active = np.flatnonzero((low <= o) & (o <= high))
        if not len(active):
            continue
        right_class[order] = np.cumsum(lcp < LENGTH - o)
        left_class[by_left] = np.cumsum(left_lcp < o)
        key = right_class[active] * (n + 1) + left_class[active]
        _, back = np.unique(key, return_inverse=True)
        repeated[active, o] = np.bincount(back, weight[active])[back] > 1
    edges = np.diff(repeated.astype(np.int8), axis=1, prepend=0)
    at, begin = np.nonzero(edges == 1)
    end = np.nonzero(edges == -1)[1] - 1
    # every range of an entry, for every place where the entry stands
    count = np.bincount(at, minlength=n)
    first = np.cumsum(count) - count
    times = count[entry]
    who = np.repeat(np.arange(len(entry)), times)
    which = np.arange(len(who)) - np.repeat(np.cumsum(times) - times, times) + first[entry[who]]
    place = ids[who, 2]
    starts, ends = place - end[which], place - begin[which]
    by_text = np.lexsort((ids[who, 3], ids[who, 1], ids[who, 0]))
    key = ids[who][by_text][:, [0, 1, 3]]
    new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)])[:len(key)])
    offsets = pa.array(np.concatenate([new, [len(key)]]).astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, pa.array(x[by_text].astype(np.int32))) for x in (starts, ends)]
    return pa.Table.from_arrays([pa.array(key[new, 0]), pa.array(key[new, 1]), pa.array(key[new, 2] == 1), *lists],
                                ["doc_id", "text_key", "no_id", "low", "high"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of what is left of each text."""
    for batch in batches:
        out = [[] for _ in range(4)]
        for text, whole, low, high in zip(*(batch.column(k) for k in range(1, 5))):
            data = np.frombuffer(text.as_py().encode("utf-8"), np.uint8)
            gone = np.zeros(len(data) + 1, np.int32)
            if whole.as_py():
                gone[:-1] = len(data) >= LENGTH
            elif low.is_valid:
                np.add.at(gone, low.values.to_numpy(), 1)
                np.add.at(gone, high.values.to_numpy() + LENGTH, -1)
                gone = np.cumsum(gone)
            gone = gone[:-1] > 0
            spans = int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1))
            row = len(data), int(gone.sum()), spans, hashlib.sha256(data[~gone].tobytes()).hexdigest()
            for col, v in zip(out, row):
                col.append(v)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, k) for c, k in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.string())))],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def repeated_windows(rows: DataFrame, firsts: DataFrame, hot: int) -> DataFrame:
    """``doc_id, text_key, no_id, low, high``: ranges of starts of windows that occur elsewhere too.

    ``rows`` are ``doc_id, text_key, ref, text``; ``firsts`` names one row of each distinct text and
    its number of copies.
    """
    long = rows.where(F.octet_length("text") >= LENGTH)
    sent = long.select("ref", "text").mapInArrow(_occurrences, "hash long, ref long, spot long, n long")
    deal = F.when(F.col("n") == 0, F.xxhash64("ref", "spot")).otherwise(F.col("hash"))
    found = checkpointed(sent.repartition(partitions(rows), deal).sortWithinPartitions("hash").mapInArrow(
        _verdicts(hot), "hash long, ref long, spot long, n long"))
    hottest = found.where("n = -1").select("hash", F.lit(True).alias("is_hot"))
    n_hot = hottest.count()
    found = found.where("n = 0")
    n_found = found.count()
    if n_hot:
        found = found.join(F.broadcast(hottest) if n_hot <= MAX_BROADCAST else hottest, "hash", "left")
    else:
        found = found.withColumn("is_hot", F.lit(False))
    spots = found.groupBy("ref").agg(F.collect_list("spot").alias("spots"),
                                     F.collect_list(F.when(F.col("is_hot"), F.col("spot"))).alias("hot"))
    parts = max(partitions(rows), -(-n_found // PER_PART))
    chosen = firsts.select("ref", "copies").join(spots, "ref")
    runs = (rows.join(chosen, "ref").select("doc_id", "text_key", "text", "copies", "spots", "hot")
            .mapInArrow(_runs(parts), _RUN))
    return runs.groupBy("part").applyInArrow(_receive, _FOUND)


def cut(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row.

    Texts are UTF-8 bytes, null as empty; matches do not cross rows. Rows with equal texts lose
    them whole from 200 bytes on; shorter texts lose nothing. Null ids and repeated rows keep
    their rows; other columns are ignored, whatever their names.
    """
    rows = text_or_empty(docs, id_col, text_col).withColumn("text_key", row_key(F.col("text")))
    rows = rows.withColumn("ref", F.xxhash64("doc_id", "text_key"))
    firsts = checkpointed(rows.where(F.octet_length("text") >= LENGTH).groupBy(F.md5("text").alias("digest")).agg(
        F.min(F.struct("doc_id", "text_key", "ref")).alias("f"), F.count(F.lit(1)).alias("copies")).select("f.*", "copies"))
    ranges = (repeated_windows(rows, firsts, hot).groupBy("doc_id", "text_key", "no_id")
              .agg(F.flatten(F.collect_list("low")).alias("low"), F.flatten(F.collect_list("high")).alias("high")))
    ranges = ranges.select(F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"), "text_key", "low", "high")
    f, g = firsts.alias("f"), ranges.alias("g")
    known = f.join(g, F.col("f.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.col("f.text_key") == F.col("g.text_key")),
                   "left").select("ref", F.struct("f.doc_id", "f.text_key", "copies", "low", "high").alias("k"))
    # by ref alone, as in the join with the spots: both then read one exchange of the texts; rows
    # whose refs are equal by chance are told apart behind it
    known = known.groupBy("ref").agg(F.collect_list("k").alias("k"))
    joined = rows.join(known, "ref", "left").withColumn("k", F.get(F.filter(
        "k", lambda x: x["doc_id"].eqNullSafe(F.col("doc_id")) & (x["text_key"] == F.col("text_key"))), F.lit(0)))
    whole = F.coalesce(F.col("k.copies"), F.lit(2)) > 1  # a row that is not the first of its text is a copy
    return joined.select("doc_id", "text", whole.alias("whole"), "k.low", "k.high").mapInArrow(
        _cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
