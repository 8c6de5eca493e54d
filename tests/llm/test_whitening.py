import numpy as np
import pytest

from pagemill.llm import whitening as W
from pagemill.llm.queries import QUERIES


def brute(rows, components=8):
    """Rows (vec_id, vector) that take part: their ids, n x - S, and the whitened entries up to sign."""
    x = np.array([np.floor(np.array(v, float) * 1024).astype(int) + 100_000 for _, v in rows]).astype(object)
    n = len(x)
    y = x * n - x.sum(0)
    c = y.astype(float) / n
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    return (y**2).sum(1), c @ u / np.sqrt(e), e, np.trace(c.T @ c / n)


def held_to(out, rows, components=8):
    deviation, white, e, trace = brute(rows, components)
    got = {(r.vec_id, r.component): r for r in out}
    assert len(got) == len(out) == white.size
    for j in range(white.shape[1]):
        column = np.array([got[i, j + 1].whitened for i, _ in rows])
        assert min(np.abs(column - white[:, j]).max(), np.abs(column + white[:, j]).max()) < 1e-8
        assert abs(got[rows[0][0], j + 1].explained - e[j] / trace) < 1e-10
    assert all(got[i, 1].deviation == d and got[i, 1].n == len(rows) for (i, _), d in zip(rows, deviation, strict=True))
    assert {r.identity_error for r in out} == {out[0].identity_error} and out[0].identity_error < 1e-8


def test_against_brute_force(spark):
    rng = np.random.default_rng(1)
    spread = rng.normal(size=(12, 12))
    good = [(i, (rng.normal(size=12) @ spread).round(4).tolist()) for i in range(200)]
    good += [(500 + i, good[3][1]) for i in range(90)]  # one vector many times
    bad = [(900, None), (901, []), (902, [None] * 12), (903, [float("nan")] * 12), (904, [float("inf")] * 12), (905, [1.0] * 11), (906, [1e300] * 12)]
    v = spark.createDataFrame([(i, e, "x") for i, e in good + bad], "vec_id long, embedding array<double>, N string")
    out = W.whiten(v).collect()
    held_to(out, good)
    assert out[0].asDict().keys() >= {"vec_id", "component", "explained"}


def test_repeated_and_null_ids(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 3.0]), (None, [5.0, 1.0]), (None, None)]
    out = W.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted((r.vec_id or 0, r.component) for r in out) == [(0, 1), (0, 2), (1, 1), (1, 1), (1, 2), (1, 2)] and {r.n for r in out} == {3}


def test_large_entries_stay_exact(spark):
    rows = [(i, [1e12 * (i % 7) + i, -3e13 + i * i, float(i)]) for i in range(40)]
    deviation, white, e, trace = brute(rows, 3)
    out = W.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 3).collect()
    for r in out:
        want = int(deviation[r.vec_id])
        assert r.deviation == (want if want < 1 << 63 else None)
    assert {r.component for r in out} <= {1, 2, 3} and max(r.identity_error for r in out) < 1e-4
    far = [(i, [2e15 * (i % 3), 1.0 * i]) for i in range(30)]  # n x passes 64 bits
    out = W.whiten(spark.createDataFrame(far, "vec_id long, embedding array<double>"), 1).collect()
    got = np.array([r.whitened for r in sorted(out, key=lambda r: r.vec_id)])
    deviation, want = brute(far, 1)[0], brute(far, 1)[1][:, 0]
    assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-8
    assert {r.vec_id: r.deviation for r in out} == {i: int(d) if d < 1 << 63 else None for i, d in enumerate(deviation)}


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)], [(1, [])]])
def test_nothing_to_whiten(spark, rows):
    out = W.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert out.collect() == [] and out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_fewer_components_than_dimensions_allow(spark):
    rows = [(i, [float(i), 2.0 * i, 0.0]) for i in range(9)]  # one direction
    out = W.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert [r.component for r in out] == [1] * 9 and all(abs(r.explained - 1) < 1e-9 for r in out)


def test_registered_query(spark):
    out = QUERIES["op11_whitening"](spark, "/root/testdata/sf0.001").collect()
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    held_to(out, rows)


def test_identity_error_is_that_of_the_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=5).tolist()) for i in range(300)]
    v = W.whole_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3))
    fitted = W.fit(v, 3)
    assert W.identity_error(v, fitted) < 1e-10
    fitted.projections[:, 1] = 0.6 * fitted.projections[:, 0] + 0.8 * fitted.projections[:, 1]
    assert abs(W.identity_error(v, fitted) - 0.6) < 1e-10
    fitted.projections *= 2
    assert abs(W.identity_error(v.filter("vec_id < 300"), fitted) - 3) < 1e-9
