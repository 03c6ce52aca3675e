import math

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import topk


def brute(rows, k):
    good = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, v in {(i, tuple(v)) for i, v in good if i % 100 == 0}:
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q and len(w) == len(v))
        out |= {(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)}
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], "vec_id long, embedding array<float>, shard int, kind int, vector int")


def run(spark, rows, k=10):
    got = topk.top_k(frame(spark, rows), F.col("vec_id") % 100 == 0, k)
    return [(r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect()]


def test_equals_brute_force_with_ties_and_bad_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 4) / 2]) for i in range(450)]  # many equal scores
    rows += [(500, None), (600, [1.0, None, 0.0, 1.0]), (601, [float("nan")] * 4), (602, [float("inf")] * 4),
             (None, [1.0] * 4), (700, [1.0, 2.0]), (701, [3.0, 4.0]), (100, rows[100][1])]
    got = run(spark, rows)
    assert set(got) == brute(rows, 10) and len(got) == len(set(got))


def test_fewer_candidates_and_none(spark):
    assert set(run(spark, [(0, [1.0]), (1, [2.0])])) == {(0, 1, 1, 1024 * 2048)}
    assert run(spark, [(0, [1.0])]) == [] and run(spark, []) == []


def test_products_beyond_float_range_stay_exact():
    a, b = np.array([[2.0 ** 40, 1.0]]), np.array([[2.0 ** 20, 3.0]])
    assert int(topk._scores(a, b)[0, 0]) == 2 ** 60 + 3


def test_partial_selection_takes_low_places_of_ties():
    assert sorted(topk._best(np.array([1.0, 5, 5, 5, 2]), 2)) == [1, 2]
