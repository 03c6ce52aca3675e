from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from tessera.llm import mixing


def water_fill(sizes, weights, share, most):
    """Literal resharing: clamp, share the rest by weight, again until none is above."""
    target, total = {}, share * sum(sizes.values())
    open_ = set(sizes)
    while open_:
        left = total - sum(target.values())
        w = sum(weights[s] for s in open_)
        over = {s for s in open_ if left * weights[s] / w > most * sizes[s]}
        if not over:
            return target | {s: left * weights[s] / w for s in open_}
        target |= {s: float(most * sizes[s]) for s in over}
        open_ -= over
    return target


ROWS = [(i, " ".join(["w"] * (i % 17 + 1))) for i in range(300)] + [(7, "a b"), (7, "a b"), (None, "x y\tz"), (400, None), (401, "")]


def sources(n):
    return [("en", (None if i % 9 == 0 else f"s{i % 5}" if i % 3 else "big")) for i in range(n)]


def test_targets_and_taken_words(make):
    docs = make(ROWS, sources(len(ROWS)))
    got = mixing.mix(docs, carry=("doc_id", "source")).select("row.*", "size", "source_size", "target", "repeats").collect()
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.size * r.repeats
        assert 0 <= r.repeats <= 2
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    want = water_fill(sizes, {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}, 1.5, 2)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert abs(taken[r.source] - r.target) <= 9
    assert sum(want.values()) == pytest.approx(1.5 * sum(sizes.values()))
    again = mixing.mix(docs.repartition(7), carry=("doc_id", "source")).select("row.*", "size", "source_size", "target", "repeats")
    assert sorted(again.collect(), key=repr) == sorted(got, key=repr)


def test_equals_sql(make):
    docs = make(ROWS, sources(len(ROWS)))
    got = mixing.mix(docs).select("row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("repeats")).alias("taken"))
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "source").toPandas().astype({"doc_id": "Int64"}))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(con.execute(mixing.MIX_SQL).fetchall(), key=repr)


def test_sample_repeats_rows_with_all_columns(make):
    docs = make(ROWS, sources(len(ROWS)))
    mixed = mixing.mix(docs).select(F.sum("repeats")).first()[0]
    out = mixing.sample(docs)
    assert out.columns == docs.columns and out.count() == mixed


def test_empty_and_wordless(make):
    assert mixing.mix(make([])).count() == 0
    assert [r.target for r in mixing.mix(make([(1, ""), (2, None)])).collect()] == [0.0, 0.0]
