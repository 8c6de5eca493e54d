import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from pagemill.operators.pages import latest_pages
from pagemill.sources import folders
from pagemill.streaming import activity as A
from pagemill.streaming import snapshots as S
from pagemill.streaming import upserts as U

PAGES = "page_id long, url string, html string, at long"
EVENTS = "event_id long, ts timestamp, user_id long, event_type string"
ROWS = [
    (1, "http://h/a", "a1", 5), (2, "http://www.h/a/", "a2", 9), (3, "http://h/a", "a3", 7), (4, "http://h/b", "b1", 1), (4, "http://h/b", "b2", 1),
    (5, None, "n1", 1), (6, None, "n2", 2), (6, None, "n2", 2), (7, "http://h/c", None, None), (None, "http://h/c", "c2", None), (8, "http://h/d?page=2", "d", 1),
]


def event(i, minute, kind="v", user=1):
    return (i, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute), user, kind)


def put(spark, rows, schema, folder):
    df = spark.createDataFrame(rows, schema)
    if "ts" in df.columns:
        df = df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    df.coalesce(1).write.mode("append").parquet(folder)


def kept(df):
    return sorted(map(repr, df.select("page_id", "url", "html", "at", "canon").collect()))


@pytest.mark.parametrize("order", list(itertools.permutations(range(3)))[::2])
def test_pages_in_any_order_are_the_latest_pages(spark, tmp_path, order):
    want = kept(latest_pages(spark.createDataFrame(ROWS, PAGES), order="at", keep_params=("page",)))
    for i, k in enumerate(order):
        S.upsert_pages(spark.createDataFrame([*ROWS[k::3], *ROWS[k : k + 1]], PAGES), i, str(tmp_path), "at", ("page",))
        if i == 1:
            U.fold(spark, str(tmp_path), S._latest)
    assert kept(S.read_latest(spark, str(tmp_path))) == want
    # A batch that runs again changes nothing, and neither do batches of known pages or of none.
    S.upsert_pages(spark.createDataFrame(ROWS[order[2] :: 3], PAGES), 2, str(tmp_path), "at", ("page",))
    S.upsert_pages(spark.createDataFrame(ROWS, PAGES), 3, str(tmp_path), "at", ("page",))
    assert spark.read.parquet(f"{tmp_path}/changes/batch=3").count() == 0
    S.upsert_pages(spark.createDataFrame([], PAGES), 4, str(tmp_path), "at", ("page",))
    assert kept(S.read_latest(spark, str(tmp_path))) == want


def test_large_batches_are_merged_by_a_shuffle(spark, tmp_path, monkeypatch):
    want = kept(latest_pages(spark.createDataFrame(ROWS, PAGES), order="at"))
    monkeypatch.setattr(S, "MOST_WINNERS", 0)
    for i in range(3):
        S.upsert_pages(spark.createDataFrame(ROWS[i::3], PAGES), i, str(tmp_path), "at")
    assert kept(S.read_latest(spark, str(tmp_path))) == want


def test_other_columns_of_pages_stay(spark, tmp_path):
    named = spark.createDataFrame(ROWS, PAGES).selectExpr("*", "1 as best", "2 as of", "3 as held", "4 as version", "5 as address", "6 as tied", "7 as n")
    for i in range(2):
        S.upsert_pages(named, i, str(tmp_path), "at")
    out = S.read_latest(spark, str(tmp_path))
    assert {tuple(r) for r in out.select("best", "of", "held", "version", "address", "tied", "n").collect()} == {(1, 2, 3, 4, 5, 6, 7)}
    assert kept(out) == kept(latest_pages(named, order="at"))


def test_stream_of_pages_goes_on(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    assert S.read_latest(spark, out) is None
    for part in (ROWS[:4], ROWS[4:7], ROWS[7:]):
        put(spark, part, PAGES, src)
        S.store_latest(S.stream_pages(spark, src, at="long"), out, order="at", fold_after=2)
    assert kept(S.read_latest(spark, out)) == kept(latest_pages(spark.createDataFrame(ROWS, PAGES), order="at"))
    assert folders.written(spark, f"{out}/folded", "upto") == [1] and folders.written(spark, f"{out}/changes", "batch") == [2]


def test_folds_that_are_cut_off(spark, tmp_path):
    folder, one = str(tmp_path), lambda n: spark.createDataFrame([("k", n)], "key string, v long")
    merged = lambda rows: rows.groupBy("key").agg(F.sum("v").alias("v"))
    for n in range(3):
        U.write_changes(one(n + 1), folder, n)
    half = spark.createDataFrame([("k", 99, False)], "key string, v long, closed boolean")
    half.write.partitionBy("closed").parquet(f"{folder}/folded/upto=2")
    folders.delete(spark, f"{folder}/folded/upto=2/_SUCCESS")  # as if its job had died
    assert merged(U.read_changes(spark, folder)).first().v == 6
    U.fold(spark, folder, merged)
    U.write_changes(one(50), folder, 1)  # as if it had not been deleted
    U.write_changes(one(4), folder, 3)
    assert merged(U.read_changes(spark, folder)).first().v == 10
    U.fold(spark, folder, merged)
    U.fold(spark, folder, merged)
    assert merged(U.read_changes(spark, folder)).first().v == 10 and folders.written(spark, f"{folder}/changes", "batch") == []


def test_closed_windows_are_written_once(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    for k, minutes in enumerate([[0, 1, 12], [120, 121], [2, 240]]):
        put(spark, [event(10 * k + i, m) for i, m in enumerate(minutes)], EVENTS, src)
        A.store_counts(A.activity_counts(A.read_stream(spark, src), "10 minutes", delay="5 minutes"), out)
    starts = lambda df: sorted((r.window_start.hour * 60 + r.window_start.minute, r.n) for r in df.collect())
    assert starts(A.read_counts(spark, out)) == [(0, 2), (10, 1), (120, 2), (240, 1)]
    closed = [starts(spark.read.parquet(f"{out}/folded/upto={n}/closed=true")) if folders.exists(spark, f"{out}/folded/upto={n}/closed=true") else [] for n in folders.written(spark, f"{out}/folded", "upto")]
    assert sorted(itertools.chain(*closed)) == [(0, 2), (10, 1), (120, 2)]
    open_ = [n for n in folders.written(spark, f"{out}/folded", "upto") if folders.exists(spark, f"{out}/folded/upto={n}/closed=false")]
    assert len(open_) == 1 and starts(U.read_changes(spark, out)) == [(240, 1)]


def test_sessions(spark, tmp_path):
    minutes = [0, 10, 19, 29, 50, 51, 100]  # 29 is a gap after 19
    rows = [event(i, m) for i, m in enumerate(minutes)] + [event(20, 5, user=2), event(21, 5, user=None)]
    batch = A.session_counts(spark.createDataFrame(rows, EVENTS), "10 minutes")
    got = sorted((r.user_id or 0, r.session_start.minute + 60 * r.session_start.hour, r.session_end.minute + 60 * r.session_end.hour, r.n) for r in batch.collect())
    assert got == [(0, 5, 15, 1), (1, 0, 39, 4), (1, 50, 61, 2), (1, 100, 110, 1), (2, 5, 15, 1)]
    src = str(tmp_path / "in")
    for part in (rows[1::2], rows[::2]):
        put(spark, part, EVENTS, src)
    stream = lambda: A.session_counts(A.read_stream(spark, src, files_at_once=1), "10 minutes", "3 hours")
    A.store_sessions(stream(), str(tmp_path / "all"), "complete")
    assert sorted(map(repr, A.read_sessions(spark, str(tmp_path / "all")).collect())) == sorted(map(repr, batch.collect()))
    for last in (400, 800):
        put(spark, [event(last, last)], EVENTS, src)
        A.store_sessions(stream(), str(tmp_path / "some"))
    done = {repr(r) for r in A.read_sessions(spark, str(tmp_path / "some")).collect()}
    assert {repr(r) for r in batch.collect()} <= done
    with pytest.raises(ValueError):
        A.store_sessions(stream(), str(tmp_path / "no"), "update")


def test_repeats_within_the_watermark_and_past_it(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    first = [event(1, 0), event(2, 1), event(2, 1)]
    later = [[event(1, 0), event(3, 30)], [event(4, 300)], [event(5, 310)], [event(1, 0), event(2, 320)]]
    for part in (first, *later):
        put(spark, part, EVENTS, src)
        A.store_events(A.delivered_once(A.read_stream(spark, src), "1 hour"), out)
    got = sorted((r.event_id, r.ts.minute + 60 * r.ts.hour) for r in A.read_events(spark, out).collect())
    # Event 1 comes once more past the watermark and is late; id 2 comes again with a time beyond it and is new.
    assert got == [(1, 0), (2, 1), (2, 320), (3, 30), (4, 300), (5, 310)]
    once = A.delivered_once(spark.createDataFrame([*first, event(2, 0)], EVENTS))
    assert sorted((r.event_id, r.ts.minute) for r in once.collect()) == [(1, 0), (2, 0)]


def test_late_events_are_kept_aside(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    parts = [[event(1, 0), event(2, 95)], [event(3, 2), event(4, 180), event(5, 62)], [event(6, 3), event(7, 179), event(8, 150), (9, None, 1, "v")], [event(10, 400)]]
    for part in parts:
        put(spark, part, EVENTS, src)
        A.store_counts_and_late(A.read_stream(spark, src), out, "1 hour", "30 minutes")
    late = {r.event_id: r.batch for r in A.read_late(spark, out).collect()}
    assert late == {3: 1, 6: 2, 9: 2}  # the window of 0 to 60 is closed from batch 1 on, that of 120 to 180 not yet in batch 2
    counts = {r.window_start.hour: r.n for r in A.read_counts_in_time(spark, out).collect()}
    assert counts == {0: 1, 1: 2, 2: 2, 3: 1, 6: 1} and sum(counts.values()) + len(late) == 10
    assert {r.window_start.hour for r in U.read_closed(spark, out).collect()} == {0, 1, 2, 3}


def test_a_batch_that_runs_again_counts_once(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    put(spark, [event(1, 0), event(2, 300)], EVENTS, src)
    A.store_counts_and_late(A.read_stream(spark, src), out, "1 hour")
    put(spark, [event(3, 1), event(4, 301)], EVENTS, src)
    folders.delete(spark, f"{out}/state/commits")  # as if the first batch had not been seen to end
    A.store_counts_and_late(A.read_stream(spark, src), out, "1 hour")
    assert sum(r.n for r in A.read_counts_in_time(spark, out).collect()) + A.read_late(spark, out).count() == 4


def test_nothing_stored(spark, tmp_path):
    for read in (A.read_counts, A.read_late, A.read_events):
        with pytest.raises(ValueError):
            read(spark, str(tmp_path / "none"))
