import random

import numpy as np

from tessera.llm import components, minhash


def word_sets(texts):
    out = []
    for t in texts:
        w = (t or "").encode().lower().split()
        n = minhash.SHINGLE
        out.append({tuple(w[k:k + n]) for k in range(len(w) - n + 1)} or ({tuple(w)} if w else set()))
    return out


def brute(rows):
    sets, label = word_sets([t for _, t in rows]), list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                label[find(a)] = find(b)
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(k) and rows[j][0] is not None]
        least = min(ids, default=None) if sets[k] else i
        out.append((i, len(sets[k]), least, i == least))
    return out


def corpus():
    rng = random.Random(4)
    prose = lambda n: [f"w{rng.randint(0, 3000)}" for _ in range(n)]
    texts = [" ".join(prose(rng.randint(1, 120))) for _ in range(40)]
    for _ in range(6):  # families of near copies about the threshold
        origin = prose(rng.randint(40, 200))
        for _ in range(25):
            w = list(origin)
            for _ in range(rng.randint(0, 5)):
                w[rng.randrange(len(w))] = f"e{rng.randint(0, 9)}"
            texts.append(" ".join(w))
    chain = prose(200)  # neighbours alike, ends not
    texts += [" ".join(chain[k:k + 120]) for k in range(0, 60, 6)]
    texts += [None, "", " \t\n", "One two", "one  TWO", "ONE two three", "É a b c d", "é a b c d"]
    rng.shuffle(texts)
    return [(None if k == 11 else 5 if k in (20, 21) else 1000 - k, t) for k, t in enumerate(texts)]


def test_components_equal_brute_force(make, monkeypatch):
    rows = corpus()
    want = sorted(brute(rows), key=repr)
    got = [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near(make(rows)).collect()]
    assert sorted(got, key=repr) == want
    monkeypatch.setattr(minhash, "BLOCK", 3)  # buckets searched block against block
    got = [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near(make(rows)).collect()]
    assert sorted(got, key=repr) == want


def test_odd_sketch_estimates_high_similarity():
    rng = np.random.default_rng(0)
    a = np.unique(rng.integers(0, 2 ** 62, 1000, dtype=np.uint64))
    for share in (1.0, 0.95, 0.9):
        keep = int(len(a) * share)
        b = np.unique(np.concatenate([a[:keep], rng.integers(0, 2 ** 62, len(a) - keep, dtype=np.uint64)]))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        x = minhash.odd_sketch(minhash.samples(a)) ^ minhash.odd_sketch(minhash.samples(b))
        bits = np.bitwise_count(x.view(np.uint64)).sum()
        estimate = 1 + minhash.BITS / (4 * minhash.SAMPLES) * np.log(1 - 2 * bits / minhash.BITS)
        assert abs(estimate - true) < 0.13


def test_keep_one_of_each_group(make):
    rows = corpus()
    out = minhash.keep_one(make(rows))
    wanted = [i for i, n, _, kept in brute(rows) if kept]
    assert out.columns == make(rows).columns
    got = [r.doc_id for r in out.collect()]
    assert set(got) == set(wanted) and out.where("trim(text) <> ''").count() <= len(got)


def test_empty_and_components_of_a_chain(make, spark):
    assert minhash.near(make([])).count() == 0
    links = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = {r.node: r.label for r in components.components(links, "a", "b").collect()}
    assert got == {k: 0 for k in range(41)} | {100: 100, 101: 100}


def test_bands_and_sketch_bits_follow_from_the_similarity():
    by = minhash.sieve(85)
    assert (by.bands, by.max_odd) == (20, 68) and minhash.sieve(80).max_odd > 68
    for link in (50, 80, 85, 95):
        assert (1 - (link / 100) ** minhash.ROWS) ** minhash.sieve(link).bands <= 1e-5


def test_keep_one_links_from_a_given_similarity(make):
    rng = random.Random(8)
    rows, pairs = [], 0
    for k in range(60):  # pairs of similarity 0.80 to 0.85 and of less than 0.80
        a = [f"v{rng.randrange(10 ** 6)}" for _ in range(104)]
        cut = rng.choice([10, 11, 9, 13, 16])  # of 100 shingles, the last so many differ
        b = a[:-cut] + [f"u{rng.randrange(10 ** 6)}" for _ in range(cut)]
        pairs += 100 * (100 - cut) >= 80 * (100 + cut)
        rows += [(2 * k, " ".join(a)), (2 * k + 1, " ".join(b))]
    got = {r.doc_id for r in minhash.keep_one(make(rows), link=80).collect()}
    assert 0 < pairs < 60 and len(got) == 120 - pairs
    sets = word_sets([t for _, t in rows])
    alike = {2 * k + 1 for k in range(60)
             if 100 * len(sets[2 * k] & sets[2 * k + 1]) >= 80 * len(sets[2 * k] | sets[2 * k + 1])}
    assert got == set(range(120)) - alike
    assert minhash.near(make(rows), link=85).where("not kept").count() < len(alike)


def test_repeats_that_differ_elsewhere_are_chosen_by_all_columns(spark):
    schema = "doc_id long, text string, source string"
    for order in ("abc", "cba", "bca"):
        docs = spark.createDataFrame([(1, "one two three", c) for c in order] + [(2, "four", "z")], schema).coalesce(1)
        assert sorted(map(tuple, minhash.keep_one(docs).collect())) == [(1, "one two three", "a"), (2, "four", "z")]
