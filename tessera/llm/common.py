"""Helpers shared by the corpus operators: row identity, word hashing, shared checkpoints."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from sys import getsizeof

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir

#: A word, for every operator that counts or hashes words.
WORD = r"[^\x20\x09-\x0D]+"
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)


#: Words, and bytes of words and values, that a Python worker remembers; beyond either the older half is forgotten.
REMEMBERED_WORDS, REMEMBERED_BYTES = 400_000, 160 << 20
#: Bytes of a dictionary's entry.
_ENTRY = 100
#: Longer words are worked out anew each time.
REMEMBERED_CHARS = 64


class Remembered(dict):
    """Word -> value, worked out on demand; two generations bound its size, not its results."""

    def __init__(self, value_of: Callable):
        super().__init__()
        self.value_of, self.old, self.bytes = value_of, {}, 0

    def __missing__(self, word):
        value = self.old.get(word)
        if value is None:
            value = self.value_of(word)
            if len(word) > REMEMBERED_CHARS:
                return value
        if len(self) >= REMEMBERED_WORDS // 2 or self.bytes >= REMEMBERED_BYTES // 2:
            self.old, self.bytes = dict(self), 0
            self.clear()
        self[word] = value
        self.bytes += getsizeof(word) + getsizeof(value) + _ENTRY
        return value

    def forget(self) -> None:
        """Worker processes outlive their tasks; what a task remembered should not."""
        self.clear()
        self.old, self.bytes = {}, 0


def forgetting(run: Callable, remembered: Callable) -> Callable:
    """A task function over batches after which ``remembered()`` is empty, however it ends."""
    def bounded(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            remembered().forget()
    return bounded


def text_or_empty(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id (as long) and the text, a null text as the empty one; other columns are left behind."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def row_key(text: Column) -> Column:
    """64-bit text hash; with doc_id it names a row up to whole repeats."""
    return F.xxhash64(text)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values over all bits (arithmetic modulo 2**64)."""
    x = (x ^ (x >> _S30)) * _MIX1
    x = (x ^ (x >> _S27)) * _MIX2
    return x ^ (x >> _S31)


def byte_numbers(salt: int) -> np.ndarray:
    """A random number for each byte; the last one, odd, is the base of a :class:`PrefixHasher`."""
    table = np.random.default_rng(salt).integers(0, 1 << 64, 257, dtype=np.uint64)
    table[256] = table[256] << np.uint64(3) | np.uint64(5)
    return table


class PrefixHasher:
    """Hashes of all words of a buffer from the prefix sums of one polynomial over its bytes, modulo 2**64.

    No hash is 0 or 1.
    """

    def __init__(self, numbers: np.ndarray):
        self.numbers = numbers
        self.up = self.down = np.ones(0, np.uint64)

    def __call__(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        if len(self.up) < len(data) + 1:
            base = int(self.numbers[256])
            self.up, self.down = (np.full(len(data) + 1, x, np.uint64) for x in (base, pow(base, -1, 1 << 64)))
            self.up[0] = self.down[0] = 1
            np.multiply.accumulate(self.up, out=self.up)
            np.multiply.accumulate(self.down, out=self.down)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.numbers[data] * self.up[:len(data)], out=sums[1:])
        return mix64((sums[stops] - sums[starts]) * self.down[starts]) | np.uint64(2)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` in the folder that spark.checkpoint.dir names; see ensure_checkpoint_dir."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def partitions(df: DataFrame) -> int:
    """The session's number of shuffle partitions."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
