import pytest
from pyspark.sql import functions as F

from pagemill.llm import warc


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"http://x/{i}", "<p>" + "é" * (i % 50), 1) for i in range(3000)]
    rows += [(None, None, None, 2), (None, None, None, 2), (5, "http://x/5", "again", 3)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest int")


def test_manifest_lies_end_to_end(pages):
    rows = warc.manifest(pages).collect()
    assert len(rows) == 3003
    by = {}
    for r in rows:
        by.setdefault(r.archive, []).append(r)
    assert {a for a in by if a >= 0} == {0, 1, 2} and sum(len(r) for a, r in by.items() if a < 0) == 2
    for records in by.values():
        records.sort(key=lambda r: r.record_no)
        assert [r.record_no for r in records] == list(range(len(records)))
        assert records[0].start == 0 and all(a.end == b.start for a, b in zip(records, records[1:], strict=False))


def test_record_is_warc(spark):
    r = spark.range(1).select(warc.record(F.lit(0), F.lit(3), F.lit("http://x/"), F.lit("é")).alias("r")).first().r
    head, body = r.split("\r\n\r\n", 1)
    assert head.startswith("WARC/1.0\r\n") and "<urn:record:0:3>" in head and "Content-Length: 2" in head and body == "é\r\n\r\n"


def test_audit_finds_what_differs(spark, pages):
    original = warc.durable(warc.manifest(pages))
    key = F.col("archive") * 10_000 + F.col("record_no")
    changed = original.filter(~key.isin(17, 10_300)).withColumn("digest", F.when(key.isin(3, 20_900), "bad").otherwise(F.col("digest")))
    extra = spark.createDataFrame([(0, 5000, 1, 9, 10, "d")], changed.schema)
    out = sorted((r.archive, r.record_no, r.state) for r in warc.audit(original, changed.unionByName(extra)).collect())
    assert out == [(0, 3, "altered"), (0, 17, "missing"), (0, 5000, "extra"), (1, 300, "missing"), (2, 900, "altered")]
    assert warc.audit(original, original).collect() == []
    assert warc.audit(original.limit(0), original.limit(0)).collect() == []


def test_shifted_archive_and_repeated_and_null_ids(spark, pages):
    same = pages.filter("page_id is null or page_id % 97 <> 13 and page_id % 389 <> 7")
    assert warc.audit(warc.manifest(same), warc.damaged(same)).collect() == []
    rows = [(5 * 1024 + i // 2, f"http://y/{i}", "x" * (i % 7), 0) for i in range(300)]
    more = same.unionByName(spark.createDataFrame(rows, same.schema).filter("page_id % 97 <> 13 and page_id % 389 <> 7"))
    out = warc.audit(warc.manifest(more), warc.damaged(more)).collect()
    n = more.filter("page_id >= 5120").count()
    assert {r.archive for r in out} == {5} and sorted(r.record_no for r in out) == list(range(100, n))
    assert {r.record_no for r in out if r.state == "missing"} == {100} and {r.state for r in out} == {"missing", "moved"}


def test_many_differing_archives(spark, pages, monkeypatch):
    original = warc.durable(warc.manifest(pages))
    bad = original.withColumn("digest", F.when(F.col("record_no") == 7, "bad").otherwise(F.col("digest")))
    few = sorted(map(tuple, warc.audit(original, bad).collect()))
    monkeypatch.setattr(warc, "LISTED", 1)
    assert sorted(map(tuple, warc.audit(original, bad).collect())) == few and len(few) == 3
