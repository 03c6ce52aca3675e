import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import phrases


def brute(rows, least, longest, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i:i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    candidates = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    out = []
    for p, a in candidates.items():
        if any(q[0] == p[0] and len(q) > len(p) and 100 * b >= 100 * a
               and any(q[i:i + len(p) - 1] == p[1:] for i in range(1, len(q))) for q, b in candidates.items()):
            continue
        lang, w = p[0], p[1:]
        s, k = min((1000 * a * n[lang] // (f[(lang, *w[:k])] * f[(lang, *w[k:])]), k) for k in range(1, len(w)))
        out.append((lang, -s, -a, " ".join(w).encode(), f[(lang, *w[:k])], f[(lang, *w[k:])], n[lang]))
    out.sort()
    place, ranked = Counter(), []
    for lang, s, a, p, l, r, total in out:
        place[lang] += 1
        if place[lang] <= top:
            ranked.append((lang, place[lang], p.decode(), -a, l, r, total, -s))
    return sorted(ranked)


def run(spark, rows, least, longest=5, top=2000):
    schema = "text string, lang string, words string, id long, next long, f int, k int, phrase string, n int"
    docs = spark.createDataFrame([(t, lang, "x", 1, 2, 3, 4, "y", 5) for lang, t in rows], schema).repartition(3)
    return sorted(map(tuple, phrases.mine(docs, least, longest, top).collect()))


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(8)
    words = ["Été", "of", "the", "#x", "\x00", "New", "york", "state", "a|b", "\x0e"]
    mark = [" ", " ", " ", "\t ", ". ", ",", "\n", "\x0b", "\r\n", "? "]
    rows = []
    for i in range(120):
        lang = ["en", "de", None, "", "en"][i % 5]
        text = "".join(words[j] + mark[k] for j, k in zip(rng.integers(0, len(words), 40) % (3 + i % 8), rng.integers(0, 10, 40)))
        rows.append((lang, text + ["", "new york city hall now. ", "NEW YORK City hall "][i % 3]))
    return rows + rows[:7] + [("en", None), ("en", ""), ("en", " \t.,\n"), ("xx", None), ("en", "again and " * 20_000)]


@pytest.mark.parametrize("least, longest, top", [(4, 5, 2000), (9, 3, 5)])
def test_equals_brute_force(spark, corpus, least, longest, top):
    assert run(spark, corpus, least, longest, top) == brute(corpus, least, longest, top)


def test_many_small_tries(spark, corpus, monkeypatch):
    monkeypatch.setattr(phrases, "BLOCK_PHRASES", 12)
    assert run(spark, corpus, 6) == brute(corpus, 6, 5, 2000)


def test_words_that_share_a_hash_take_another_salt(spark, corpus, monkeypatch):
    letters = phrases._letters

    def poor(salt):
        return letters(salt) if salt else np.where(np.arange(257) < 256, 3, letters(0)).astype(np.uint64)  # only the length counts

    salts = []
    count = phrases._count_words
    monkeypatch.setattr(phrases, "_count_words", lambda salt: salts.append(salt) or _in_task(count, salt, poor))
    rows = corpus[:30]
    assert run(spark, rows, 3) == brute(rows, 3, 5, 2000) and salts == [0, 1]


def _in_task(count, salt, poor):
    """The counting task with the poor hasher, which only this process would know otherwise."""
    def task(batches):
        from tessera.llm import phrases as there
        good = there._letters
        there._letters = poor
        try:
            yield from count(salt)(batches)
        finally:
            there._letters = good
    return task


def test_chunks_are_cut_between_pieces_and_texts(monkeypatch):
    monkeypatch.setattr(phrases, "CHUNK_BYTES", 9)
    texts = ["one two, three four five six seven. eight", "", "Nine", "ten.\n", "é eleven" * 3]
    batch = pa.RecordBatch.from_arrays([pa.array(["a", "b", "a", "b", "c"]), pa.array(texts)], ["lang", "text"])
    found = [(c.langs[c.number[i]], c.word(i)) for c in phrases._chunks(iter([batch.slice(0, 2), batch.slice(2)])) for i in range(len(c.starts))]
    assert found == [(x, w) for x, t in zip("abab c".replace(" ", ""), texts) for w in re.findall(r"[^ .,\n]+", t.lower())]


def test_tries_find_each_phrase_where_it_begins():
    rng = np.random.default_rng(2)
    for depth in (1, 2, 4):
        words = np.unique(rng.integers(2, 40, (300, depth)).astype(np.uint64), axis=0)
        langs = [["p", "q"][int(x)] for x in rng.integers(0, 2, len(words))]
        trie = phrases.Trie.build(langs, words)
        value, number = rng.integers(1, 45, 3000).astype(np.uint64), np.repeat([0, 1, 2], 1000)
        at, phrase, _ = trie.walk(["p", "q", "none"], number, value)
        known = {(x, *w): i for i, (x, w) in enumerate(zip(langs, words.tolist()))}
        wanted = [(i, known[key]) for i in range(3000 - depth + 1)
                  if (key := (["p", "q", "none"][number[i]], *value[i:i + depth].tolist())) in known]
        assert list(zip(at.tolist(), phrase.tolist())) == wanted


def test_exact_beyond_64_bits(spark):
    schema = "lang string, words array<long>, phrase string, f long, k int"
    big = 3_000_000_000_000
    every = spark.createDataFrame([("en", [1], "a", big, 1), ("en", [2], "b", big - 1, 1), ("en", [1, 2], "a b", big - 7, 2)], schema)
    got = phrases._ranked(every, spark.createDataFrame([("en", 9 * big)], "lang string, n long"), 10).first()
    assert got.score == 1000 * (big - 7) * 9 * big // (big * (big - 1))


def test_empty_and_rare(spark):
    assert run(spark, [], 1) == [] and run(spark, [("en", "a b a b")], 3) == [] and run(spark, [("en", None)], 1) == []
