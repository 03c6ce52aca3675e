"""Byte-level BPE: encode by merge ranks, decode by concatenating vocabulary strings.

A word starts as a doubly linked list of byte symbols. Every adjacent pair that has a merge
goes into a priority queue by (rank, place); the lowest is applied to the list, its new
neighbours are queued, and entries whose symbols have changed meanwhile are skipped. Decoding
joins the vocabulary's byte strings. The vocabulary file is a parameter; nothing is trained.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tessera.llm.common import Remembered, forgetting, text_or_empty

#: Fixed value: the pre-tokenising pattern of byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
DEFAULT_VOCABULARY = "byte_bpe_50k.json"


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class ByteBpe:
    """Encoder and decoder of one vocabulary file in the tokenizers library's JSON format."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec["pre_tokenizer"] or {}, spec["model"]
        if (model.get("type"), pre.get("type"), pre.get("add_prefix_space"), spec["normalizer"]) != (
                "BPE", "ByteLevel", False, None):
            raise ValueError(f"not a plain byte-level BPE file: {path}")
        vocab, alphabet = model["vocab"], byte_alphabet()
        byte_of = {c: b for b, c in alphabet.items()}
        self.byte_id = [vocab[alphabet[b]] for b in range(256)]
        self.pairs: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.pairs[vocab[a] << 32 | vocab[b]] = (rank, vocab[a + b])
        self.strings = {i: bytes(byte_of[c] for c in s) for s, i in vocab.items()}
        added = spec.get("added_tokens") or []
        self.added = {t["content"]: t["id"] for t in added}
        self.strings |= {i: s.encode("utf-8") for s, i in self.added.items()}
        self.decimal = {i: str(i) for i in self.strings}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.split_added = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if added else None
        self.find = regex.compile(PATTERN).findall
        self.words = Remembered(lambda word: self.merge_word(word.encode("utf-8")))

    def merge_word(self, word: bytes) -> tuple[int, ...]:
        """Ids of one pre-token."""
        sym = [self.byte_id[b] for b in word]
        n, pairs = len(sym), self.pairs
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        queue = []
        for i in range(n - 1):
            m = pairs.get(sym[i] << 32 | sym[i + 1])
            if m:
                queue.append((m[0], i, m[1], sym[i], sym[i + 1]))
        heapq.heapify(queue)
        while queue:
            _, i, new, left, right = heapq.heappop(queue)
            j = after[i]
            if sym[i] != left or j == n or sym[j] != right:
                continue  # stale: a neighbour was merged after this entry was queued
            sym[i], sym[j] = new, -1
            j = after[i] = after[j]
            if j < n:
                before[j] = i
                m = pairs.get(new << 32 | sym[j])
                if m:
                    heapq.heappush(queue, (m[0], i, m[1], new, sym[j]))
            h = before[i]
            if h >= 0:
                m = pairs.get(sym[h] << 32 | new)
                if m:
                    heapq.heappush(queue, (m[0], h, m[1], sym[h], new))
        return tuple(s for s in sym if s >= 0)

    def encode(self, text: str) -> list[int]:
        """Ids of a text; strings of added tokens in it become their single ids."""
        if self.split_added is None or not self.split_added.search(text):
            return list(chain.from_iterable(map(self.words.__getitem__, self.find(text))))
        ids: list[int] = []
        for k, part in enumerate(self.split_added.split(text)):
            if k % 2:
                ids.append(self.added[part])
            else:
                ids += chain.from_iterable(map(self.words.__getitem__, self.find(part)))
        return ids

    def decode(self, ids: list[int]) -> str:
        """Vocabulary strings joined; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", errors="replace")


@lru_cache(maxsize=4)
def load(vocabulary: str) -> ByteBpe:
    """One encoder per vocabulary and Python process; a bare name is a file of public_tokenizers."""
    if "/" not in vocabulary:
        import public_tokenizers
        vocabulary = public_tokenizers.path(vocabulary)
    return ByteBpe(vocabulary)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """``doc_id, ids array<int>`` of every whole text.

    A null or empty text has no ids; a null id is kept; repeated rows each give a row; columns
    besides the two named are ignored, whatever their names.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(vocabulary)
        for batch in batches:
            ids = [bpe.encode(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))],
                                             ["doc_id", "ids"])

    return text_or_empty(docs, id_col, text_col).mapInArrow(forgetting(run, lambda: load(vocabulary).words), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; null ids decode to the empty text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(vocabulary)
        for batch in batches:
            texts = [bpe.decode(x or []) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """Digests of encoding and decoding every whole text in one pass.

    ``doc_id, n_tokens, ids_sha256`` (decimal ids joined by commas) and ``decoded_sha256`` (UTF-8
    of the decoded text). Nulls, repeats and further columns: as in :func:`encode`.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(vocabulary)
        for batch in batches:
            counts, id_sha, text_sha = [], [], []
            for value in batch.column(1):
                ids = bpe.encode(value.as_py())
                counts.append(len(ids))
                joined = ",".join(map(bpe.decimal.__getitem__, ids))
                id_sha.append(hashlib.sha256(joined.encode("ascii")).hexdigest())
                text_sha.append(hashlib.sha256(bpe.decode(ids).encode("utf-8")).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(id_sha), pa.array(text_sha)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return text_or_empty(docs, id_col, text_col).mapInArrow(
        forgetting(run, lambda: load(vocabulary).words), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
