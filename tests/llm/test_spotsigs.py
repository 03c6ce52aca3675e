import hashlib
import random
from itertools import combinations

from tessera.llm import spotsigs
from tessera.sources.tables import table
from tests.llm.test_minhash import corpus

SMALL = "/root/testdata/sf0.001"


def test_against_edited_and_next(make):
    rows = [(5, "The cat sat on a mat."), (3, ""), (9, None), (3, "the dog and the fox ran to the den"), (7, "é" * 10),
            (None, "null id of the row"), (2, "x"), (2, "x")]
    docs = make(rows)
    keyed = {(r.doc_id, r.text or "", r.k) for r in docs.selectExpr("doc_id", "text", "xxhash64(coalesce(text, '')) as k").collect()}
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (
        r[0] is None, -(r[0] or 0), next(k for i, t, k in keyed if (i, t) == r)))
    want = []
    for k, (i, t) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        cut = len(t) // 3
        new = t[:len(t) - cut] + following[:cut]
        a, e, n = map(spotsigs.signatures, (t, new, following))
        want.append((i, len(t), hashlib.sha256(new.encode()).hexdigest(), spotsigs.to_text(a), spotsigs.to_text(e),
                     spotsigs.likeness(a, e), spotsigs.likeness(a, n)))
    got = spotsigs.against_edited_and_next(docs)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert spotsigs.against_edited_and_next(make([])).count() == 0
    one = spotsigs.against_edited_and_next(make([(1, "the one row of all")])).first()
    assert one.near_next == 1.0


def test_edits_are_told_from_other_texts(spark):
    got = spotsigs.against_edited_and_next(table(spark, SMALL, "documents")).where("n_chars > 300").toPandas()
    assert (got.near_edited > got.near_next).mean() > 0.97 and got.near_next.median() < 0.02


def test_fingerprint_round_trip_and_anchors():
    a = spotsigs.signatures("The quick fox, the lazy dog and THE quick fox")
    assert (spotsigs.from_text(spotsigs.to_text(a)) == a).all()
    assert spotsigs.likeness(a, a[:1], least=0.9) == 0.0 and spotsigs.likeness(a[:0], a[:0]) == 1.0


def test_similar_equals_all_pairs(make):
    rows = [(i, " the ".join(t.split(" w"))) for i, t in corpus() if t and i]
    sets = {}
    for i, t in rows:
        s = spotsigs.signatures(t)
        if len(s):
            sets.setdefault(spotsigs.to_text(s), [s, []])[1].append(i)
    want = set()
    for (s, a), (t, b) in combinations(sets.values(), 2):
        if spotsigs.likeness(s, t) >= 0.8:
            want.add(frozenset((min(a), min(b))))
    got = spotsigs.similar(make(rows)).collect()
    assert {frozenset((r.a, r.b)) for r in got} == want and len(got) == len(want)


def test_likeness_does_not_depend_on_the_density_of_anchors():
    rng, common = random.Random(5), ["the", "of", "and", "to"]
    for size in (60, 600):
        got = []
        for _ in range(20):
            plain = [f"x{rng.randrange(10 ** 6)}" for _ in range(size)]  # no common word: a list, code, another language
            prose = [rng.choice(common) if rng.random() < 0.5 else f"y{rng.randrange(10 ** 6)}" for _ in range(size // 2)]
            kept = plain[:size - size // 3]
            got.append(spotsigs.likeness(*(spotsigs.signatures(" ".join(w)) for w in (plain, kept + prose[:size // 3]))))
            assert len(spotsigs.signatures(" ".join(plain))) > size // 8
        assert 0.3 < sum(got) / len(got) < 0.7
    # a text below the chain's length, or with no picked word, has a signature
    assert all(len(spotsigs.signatures(t)) for t in ("x", "the", "x y", "the x", *(f"w{k} v{k} u{k}" for k in range(50))))
    assert len({spotsigs.to_text(spotsigs.signatures(f"w{k}")) for k in range(50)}) == 50
