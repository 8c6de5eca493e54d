import duckdb
import pytest

from pagemill.llm import mixing


def frame(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, rate string, Size int")
    return df.selectExpr("*", "1 AS of", "2 AS seed")


def rows(n=3000):
    sources = ["a", "b", None, "é", "Z"]
    out = [(i, sources[(i * i) % 7 % 5] if i % 3 else "a", " ".join(["w"] * (i * 37 % 90)), "x", 1) for i in range(n)]
    return out + [(7, "a", None, "x", 1), (7, "a", "", "x", 1), (None, None, "one two\tthree", None, None)]


def test_targets_by_hand(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 100), ("c", 90)], "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    # 300 words by 3, 1, 2: a is capped at 20; 280 by 1 and 2 would give c 187, so it is capped at 180, and b has the rest
    assert got == {"a": 20.0, "b": 100.0, "c": 180.0}


@pytest.mark.parametrize("sizes", [(300, 100, 200), (100, 100, 100, 300, 100), (0, 50, 100, 150, 50, 100)])
def test_targets_of_sources_that_tie(spark, sizes):
    rows = [(f"s{i}", n) for i, n in enumerate(sizes)]
    got = {r.source: r.target for r in mixing.source_targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    if sizes == (300, 100, 200):
        assert got == {"s0": 450.0, "s1": 150.0, "s2": 300.0}
    assert sum(got.values()) == pytest.approx(1.5 * sum(sizes))
    free = [got[f"s{i}"] / mixing.WEIGHTS[i % 3] for i, n in enumerate(sizes) if got[f"s{i}"] < mixing.MOST * n]
    assert free and max(free) == pytest.approx(min(free))


def test_totals_and_bounds(spark):
    out = mixing.mix(frame(spark, rows())).collect()
    assert len(out) == 3003 and all((r.of, r.seed) == (1, 2) for r in out)
    by_source = {}
    for r in out:
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        by_source.setdefault((r.source, r.target), []).append(r)
    total = sum(r.size for r in out)
    assert sum(t for _, t in by_source) == pytest.approx(1.5 * total)
    for (_, target), docs in by_source.items():
        assert target <= 2 * docs[0].source_size + 1e-9
        assert abs(sum(r.taken for r in docs) - target) <= 0.03 * target + 90
    again = {(r.doc_id, r.taken, r.size) for r in mixing.mix(frame(spark, rows())).collect()}
    assert again == {(r.doc_id, r.taken, r.size) for r in out}


@pytest.mark.parametrize("most", [0, 10_000])
def test_same_as_sql(spark, monkeypatch, most):
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", most)
    docs = frame(spark, [r for r in rows(400) if r[0] is not None])
    documents = docs.toPandas()  # noqa: F841
    want = sorted(duckdb.sql(mixing.mix_sql()).fetchall())
    got = mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")
    assert sorted(map(tuple, got.collect())) == want


@pytest.mark.parametrize("ident", [None, 5])
def test_sources_of_null_or_equal_ids_come_near_their_targets(spark, ident):
    rows = [(ident, f"s{i % 3}", f"w{i} " * (1 + i % 4), "x", 1) for i in range(6000)]
    for r in mixing.mix(frame(spark, rows)).groupBy("source", "target").sum("taken").collect():
        assert abs(r["sum(taken)"] - r.target) <= 0.03 * r.target


@pytest.mark.parametrize("sizes", [(300, 100, 200), (100, 100, 100, 300, 100), (0, 50, 100, 150, 50, 100)])
def test_sql_where_sources_tie(spark, sizes):
    docs = frame(spark, [(i, f"s{i}", "w " * n, "x", 1) for i, n in enumerate(sizes)])
    documents = docs.toPandas()  # noqa: F841
    got = mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")
    assert sorted(map(tuple, got.collect())) == sorted(duckdb.sql(mixing.mix_sql()).fetchall())


def test_very_long_text(spark):
    out = {r.doc_id: r for r in mixing.mix(frame(spark, [(1, "a", "word " * 1_500_000, "x", 1), (2, "b", "w", "x", 1)])).collect()}
    assert out[1].size == 1_500_000 and out[1].taken in (1_500_000, 3_000_000)


def test_empty_and_nothing_to_take(spark):
    assert mixing.mix(frame(spark, []).limit(0)).collect() == []
    out = mixing.mix(frame(spark, [(1, "a", None, "", 0), (2, "b", " \n", "", 0)])).collect()
    assert [(r.taken, r.target) for r in out] == [(0, 0.0)] * 2


def test_repeat_rows(spark):
    mixed = spark.createDataFrame([(1, 0), (2, 1), (3, 2)], "doc_id long, copies int")
    assert sorted(r.doc_id for r in mixing.repeat_rows(mixed).collect()) == [2, 3, 3]
