from functools import reduce

import numpy as np

from pagemill.llm import neighbours as N


def brute(rows, asked, k):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    out = []
    for q in sorted(set(asked) & {i for i, _ in good}):
        e = max(v.tolist() for i, v in good if i == q)
        scored = sorted((-reduce(lambda t, x: t + x, (float(a * b) for a, b in zip(e, v, strict=True)), 0.0), i) for i, v in good if i != q)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return out


def test_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(N, "QUERY_BLOCK", 9)
    monkeypatch.setattr(N, "CANDIDATE_BLOCK", 40)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).round(3).tolist()) for i in range(150)]
    rows += [(200 + i, rows[4][1]) for i in range(40)]  # ties
    rows += [(300, None), (301, [0.0] * 8), (302, [None] * 8), (303, [float("nan")] * 8), (304, [float("inf")] * 8), (None, rows[0][1])]
    rows += [(5, rows[5][1]), (7, rows[8][1]), (7, rows[7][1]), (10, rng.normal(size=8).tolist())]  # repeated ids
    rows += [(400, [5e-324] * 8), (401, [-1e-310] + [0.0] * 7), (402, [1e200] + [0.0] * 7), (403, [2e-310] * 8)]
    v = spark.createDataFrame([(i, e, "x") for i, e in rows], "vec_id long, embedding array<double>, rank string")
    got = N.nearest(v, v.filter("vec_id % 5 = 0"), 6)
    got = sorted(map(tuple, got.select("query_id", "rank", "vec_id", "score").collect()))
    assert got == brute(rows, [i for i, _ in rows if i is not None and i % 5 == 0], 6)


def test_few_and_none(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.5, 0.5])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in N.nearest(v, v.filter("vec_id = 1"), 20).collect()] == [(1, 1, 2, 0.5)]
    assert N.nearest(v.limit(0), v, 3).collect() == [] and N.nearest(v, v.limit(0), 3).collect() == []


def test_long_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=1500).round(2).tolist()) for i in range(60)]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, N.nearest(v, v.filter("vec_id % 20 = 0"), 5).collect()))
    assert got == brute(rows, [0, 20, 40], 5)
