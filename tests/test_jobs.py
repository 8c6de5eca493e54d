import datetime as dt

import pytest

from pagemill.jobs import publish as J
from pagemill.operators.rejects import message_rejects, page_rejects
from pagemill.sources import folders
from pagemill.sources.schemas import FETCHED, MESSAGES, PAGES
from pagemill.sources.tables import read_pages

RULES = [(1, r"/t/", "thread"), (2, r"\.html$", "article")]
KINDS = "prio int, pat string, kind string"


def at(hour):
    return dt.datetime(2024, 1, 1, hour)


def test_jobs_store_their_tables_and_keep_the_last_runs(spark, tmp_path):
    root, rules = str(tmp_path / "out"), spark.createDataFrame(RULES, KINDS)
    rows = [(1, "http://h/t/a?page=1", "<a href='/t/z'></html>", at(9)), (2, "http://h/t/a?page=1", "old</html>", at(5)), (3, "http://h/t/a?page=2", "cut", at(7)), (4, None, "", None)]
    spark.createDataFrame(rows, FETCHED).write.parquet(str(tmp_path / "in"))
    pages = read_pages(spark, str(tmp_path / "in"), fetched=True)
    for _ in range(3):
        J.publish_pages(pages, rules, root, keep_params=("page",), keep=2)
    assert folders.written(spark, f"{root}/records", "run") == [1, 2]
    records = {r.canon: (r.page_id, r.kind) for r in J.current(spark, root, "records").collect()}
    assert records == {"h/t/a?page=1": (1, "thread"), "h/t/a?page=2": (3, "thread"), None: (4, None)}
    assert [r.canon for r in J.current(spark, root, "frontier").collect()] == ["h/t/z"]
    assert J.current(spark, root, "records", run=1).count() == 3
    for table, run in (("records", 0), ("nothing", None)):
        with pytest.raises(ValueError):
            J.current(spark, root, table, run)
    with pytest.raises(ValueError):
        J.publish(pages, root, "records", keep=0)


def test_a_run_that_is_cut_off_is_not_seen(spark, tmp_path):
    root = str(tmp_path)
    J.publish(spark.range(3), root, "t")
    spark.range(9).write.parquet(f"{root}/t/run=1")
    folders.delete(spark, f"{root}/t/run=1/_SUCCESS")
    assert J.current(spark, root, "t").count() == 3
    assert J.publish(spark.range(5), root, "t").count() == 5 and folders.written(spark, f"{root}/t", "run") == [0, 1]


def test_page_rejects(spark):
    rows = [(1, "http://h/t/1", "<p></html>\n"), (2, None, "x</html>"), (3, "ftp://h/t/2", " "), (4, "http://h/x", None), (5, "http:///t/", "x"), (6, "", "</html>")]
    out = page_rejects(spark.createDataFrame(rows, PAGES), spark.createDataFrame(RULES, KINDS))
    got = sorted((r.page_id, r.reason) for r in out.collect())
    assert got == [(2, "no address"), (3, "bad address"), (3, "empty"), (4, "empty"), (4, "no kind"), (5, "bad address"), (5, "cut off"), (6, "bad address"), (6, "no kind")]
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_message_rejects(spark):
    rows = [(1, 0, "a", "x"), (1, 1, "a", "x"), (1, 1, None, None), (None, 3, "a", "x"), (2, None, "a", "x"), (2, None, "a", "x"), (2, -4, "b", "")]
    got = sorted((r.thread_id or 0, -9 if r.seq is None else r.seq, r.reason, r.n) for r in message_rejects(spark.createDataFrame(rows, MESSAGES)).collect())
    assert got == [(0, 3, "no thread", 1), (1, 1, "no author", 1), (1, 1, "no text", 1), (1, 1, "repeated number", 2), (2, -9, "no number", 2), (2, -4, "negative number", 1)]
    assert message_rejects(spark.createDataFrame([], MESSAGES)).collect() == []


def test_threads_are_published(spark, tmp_path):
    J.publish_threads(spark.createDataFrame([(1, 0, "a", "x"), (1, 3, "b", "y"), (1, 3, "b", "y")], MESSAGES), str(tmp_path))
    assert J.current(spark, str(tmp_path), "threads").first().n_messages == 3
    assert [tuple(r) for r in J.current(spark, str(tmp_path), "gaps").collect()] == [(1, 1, 2)]
    assert J.current(spark, str(tmp_path), "message_rejects").first().reason == "repeated number"
