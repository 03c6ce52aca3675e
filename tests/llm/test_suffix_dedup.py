import hashlib
import random
from collections import Counter

import pytest

from tessera.llm import suffix_dedup as sd


def brute(texts):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[a:a + 200] for d in data for a in range(len(d) - 199))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for a in range(len(d) - 199):
            if seen[d[a:a + 200]] > 1:
                gone[a:a + 200] = b"\x01" * 200
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus():
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdeé\x00", k=rng.randint(1, 7))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choices(words, k=n))
    shared = [prose(60) for _ in range(5)]
    texts = [prose(rng.randint(1, 300)) for _ in range(30)]
    for k in range(80):  # passages at random places, cut and edited at random
        parts = []
        for _ in range(rng.randint(1, 4)):
            p = rng.choice(shared)
            a = rng.randrange(len(p) // 2)
            p = p[a:a + rng.randint(150, len(p))]
            if rng.random() < 0.3:
                m = rng.randrange(len(p))
                p = p[:m] + "#" + p[m + 1:]
            parts += [prose(rng.randint(0, 15)), p]
        texts.append("".join(parts))
    texts += [texts[3]] * 3 + ["a" * 199, "a" * 200, "b" * 201, "ab" * 300, "c" * 600, None, "", prose(100) * 2]
    texts += ["x" * 199 + "y", "z" + "x" * 199 + "y"]
    return texts


@pytest.mark.parametrize("hot", [20_000, 4])
def test_equals_brute_force(make, hot):
    texts = corpus()
    rows = [(None if k == 5 else 7 if k in (8, 9) else k, t) for k, t in enumerate(texts)]
    got = sd.cut(make(rows), hot=hot).collect()
    want = [(i, *w) for (i, _), w in zip(rows, brute(texts))]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_repeated_rows_and_empty_table(make):
    long = "word " * 50
    got = sd.cut(make([(1, long), (1, long), (2, "short"), (2, "short")])).collect()
    assert sorted((r.doc_id, r.n_removed, r.n_spans) for r in got) == [(1, 250, 1), (1, 250, 1), (2, 0, 0), (2, 0, 0)]
    assert sd.cut(make([])).count() == 0


def test_loser_tree_merges_runs_with_shared_prefixes():
    rng = random.Random(2)
    for count in (1, 2, 5, 8):
        runs = [sorted("".join(rng.choices("ab", k=rng.randint(1, 12))).encode() for _ in range(rng.randint(1, 40)))
                for _ in range(count)]
        coded = [sd.front_code(r) for r in runs]
        merged = list(sd.merge([sd.Run(*c) for c in coded]))
        out = [runs[r][at] for r, at, _ in merged]
        assert out == sorted(s for r in runs for s in r)
        for a, b, (_, _, known) in zip(out, out[1:], merged[1:]):
            assert known == sd.shared(a, b, 0)
