import math
import re
from collections import Counter

import numpy as np
import pytest

from tessera.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    found = [(i, words(t)) for i, t in docs]
    found = [(i, w) for i, w in found if w]
    n, total = len(found), sum(len(w) for _, w in found)
    df = Counter(t for _, w in found for t in set(w))
    found = [(i, len(w), Counter(w)) for i, w in found]
    out = []
    for item, text in set(items):
        scored = []
        for i, long, tf in found:
            m = 10 + 90 * long * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10 ** 9 * tf[t] // (1000 * tf[t] + 8 * m))
                    for t in set(words(text)))
            if s:
                scored.append((-s, math.inf if i is None else i))
        out += [(item, r, None if i == math.inf else i, -s) for r, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def items_of(spark, items):
    schema = "item_id long, text string, doc_id long, terms string, rank int, score long, salt int, block int"
    return spark.createDataFrame([(i, t, 1, "x", 2, 3, 4, 5) for i, t in items], schema)


def run(spark, make, docs, items, **kw):
    got = lexical.rank(make(docs), items_of(spark, items), **kw).collect()
    return sorted([(r.item_id, r["rank"], r.doc_id, r.score) for r in got], key=str)


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(5)
    vocabulary = ["the", "of", "é", "Ünï", "x1", *(f"w{k}" for k in range(40))]
    weight = 1 / np.arange(1, len(vocabulary) + 1)
    text = lambda n: " ,.- "[rng.integers(5)].join(rng.choice(vocabulary, n, p=weight / weight.sum()))
    docs = [(i, text(rng.integers(1, 30)).upper() if i % 7 == 0 else text(rng.integers(1, 30))) for i in range(200)]
    docs += [(300 + i, docs[i % 5][1]) for i in range(60)]  # ties
    docs += [(3, docs[3][1]), (None, "the w1 w2"), (400, None), (401, ""), (402, "--- !!"), (403, "w39 " * 30_000)]
    items = [(i, text(12)) for i in range(15)]
    return docs, items + [items[0], (1, "w5 w6"), (None, "w39"), (90, None), (91, ""), (92, "nowhere"), (93, docs[0][1])]


def test_equals_brute_force(spark, make, corpus):
    assert run(spark, make, *corpus) == brute(*corpus)


@pytest.mark.parametrize("k", [1, 3])
def test_small_shards_blocks_and_reads(spark, make, corpus, k, monkeypatch):
    monkeypatch.setattr(lexical, "SHARD_DOCS", 16)
    monkeypatch.setattr(lexical, "FIRST_READ", 1)
    docs, items = corpus
    assert run(spark, make, docs, items, k=k, block_terms=20) == brute(docs, items, k)


def test_shards_one_after_the_other_keep_the_best():
    rng = np.random.default_rng(1)
    known, every = [], []
    for s in range(20):
        ids = rng.permutation(50) + 100 * (s // 2)
        doc, term = np.divmod(np.unique(rng.integers(0, 50 * 6, 120)), 6)
        impact = rng.integers(0, 4, len(doc))
        every += list(zip((-np.bincount(doc, impact, 50).astype(int)).tolist(), ids.tolist()))
        known = lexical.Shard(ids, doc, term, impact, 6).best(np.arange(6), 7, known)
        assert known == sorted(x for x in every if x[0])[:7]


def test_reading_stops_before_the_lists_end(monkeypatch):
    n = 4096
    impact = np.concatenate([[1000], np.full(n - 1, 1)])
    shard = lexical.Shard(np.arange(n), np.tile(np.arange(n), 2), np.repeat([0, 1], n), np.tile(impact, 2), 2)
    reads = []
    arange = np.arange
    monkeypatch.setattr(lexical.np, "arange", lambda *a: reads.append(a) or arange(*a))
    assert shard.best(arange(2), 1, []) == [(-2000, 0)]
    assert max((a[1] - a[0] for a in reads if len(a) == 2), default=0) <= lexical.FIRST_READ


def test_empty_tables(spark, make):
    assert run(spark, make, [], [(1, "a")]) == [] and run(spark, make, [(1, "a")], []) == []
