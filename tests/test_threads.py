import datetime as dt

from pyspark.sql import functions as F

from pagemill.operators import threads as T
from pagemill.sources.schemas import MESSAGES
from pagemill.streaming import activity as A
from pagemill.streaming.activity import activity_counts


def messages(spark, rows):
    return spark.createDataFrame(rows, MESSAGES)


ROWS = [(1, 0, "a", "xx"), (1, 1, "b", "yyy"), (1, 2, "a", None), (1, 5, None, "z"), (2, 0, "a", "q")]


def test_rollups(spark):
    out = {r.thread_id: tuple(r)[1:] for r in T.thread_rollup(messages(spark, ROWS)).collect()}
    assert out == {1: (4, 6, 2, None), 2: (1, 1, 1, "a")}
    out = {r.author: tuple(r)[1:] for r in T.author_rollup(messages(spark, ROWS)).collect()}
    assert out == {"a": (3, 3, 2), "b": (1, 3, 1), None: (1, 1, 1)}
    near = {r.author: r.n_threads for r in T.author_rollup(messages(spark, ROWS), approximate=True).collect()}
    assert near == {"a": 2, "b": 1, None: 1}


def test_context_and_top(spark):
    out = T.message_context(messages(spark, ROWS)).filter("thread_id = 1").orderBy("seq").collect()
    assert [(r.prev_author, r.running_chars) for r in out] == [(None, 2), ("a", 5), ("b", 5), ("a", 6)]
    top = T.top_messages(messages(spark, ROWS), 2).orderBy("thread_id", "rank").collect()
    assert [(r.thread_id, r.seq) for r in top] == [(1, 1), (1, 0), (2, 0)]


def test_gaps(spark):
    rows = [*ROWS, (3, 4, "a", ""), (4, 10**12, "a", ""), (4, 1, "b", ""), (4, -3, "b", "")]
    m = messages(spark, rows)
    gaps = sorted(map(tuple, T.message_gaps(m).collect()))
    assert gaps == [(1, 3, 4), (3, 0, 3), (4, 0, 0), (4, 2, 10**12 - 1)]
    few = [(1, 3), (1, 4), (3, 0), (3, 1), (3, 2), (3, 3), (4, 0)]
    assert sorted(map(tuple, T.missing_messages(m, 5).collect())) == [*few, *((4, i) for i in range(2, 6))]
    long = messages(spark, [(9, 200_001, "a", ""), (9, 0, "a", "")])
    assert [r.seq for r in T.missing_messages(long).orderBy("seq").collect()] == list(range(1, 200_001))
    assert [tuple(r) for r in T.oversized_threads(m).collect()] == [(4, 10**12)]


def event(i, minute, kind="v"):
    return (i, dt.datetime(2024, 1, 1, 0, 0) + dt.timedelta(minutes=minute), 1, kind)


SCHEMA = "event_id long, ts timestamp, user_id long, event_type string"


def run(spark, tmp_path, batches, mode, **window):
    """Counts of a stream that gets the batches one file at a time."""
    src = str(tmp_path / "in")
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{src}/b={i}")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{src}/*")
    name = f"counts_{mode}_{len(batches)}"
    q = activity_counts(stream, "10 minutes", **window).writeStream.outputMode(mode).format("memory").queryName(name).start()
    q.processAllAvailable()
    q.stop()
    return sorted(map(tuple, spark.table(name).collect()))


def test_stream_equals_batch(spark, tmp_path):
    batches = [[event(i, i) for i in range(10)], [event(20 + i, 10 + i, "w") for i in range(15)], [event(50, 60)]]
    flat = spark.createDataFrame(sum(batches, []), SCHEMA)
    want = sorted(map(tuple, activity_counts(flat, "10 minutes", slide="5 minutes").collect()))
    assert run(spark, tmp_path, batches, "complete", slide="5 minutes") == want


def test_late_events_are_dropped(spark, tmp_path):
    # Spark drops by the watermark of the batch before the last, so a batch lies between
    batches = [[event(1, 0)], [event(2, 120)], [event(3, 240)], [event(4, 1)], [event(5, 480)], [event(6, 481)]]
    out = run(spark, tmp_path, batches, "append", delay="5 minutes")
    starts = {r[0].minute + 60 * r[0].hour: r[3] for r in out}
    assert starts == {0: 1, 120: 1, 240: 1}


def test_stored_stream_goes_on_and_drops_old_state(spark, tmp_path):
    src, folder = str(tmp_path / "in"), str(tmp_path / "out")
    batches = [[event(1, 0), event(2, 1)], [event(3, 2), event(4, 120)], [event(5, 240)], [event(6, 1), event(7, 480)]]
    for rows in batches:
        flat = spark.createDataFrame(rows, SCHEMA).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
        flat.coalesce(1).write.mode("append").parquet(src)
        A.store_counts(activity_counts(A.read_stream(spark, src), "10 minutes", delay="5 minutes"), folder)
    out = {r.window_start.hour * 60 + r.window_start.minute: r.n for r in A.read_counts(spark, folder).collect()}
    assert out == {0: 3, 120: 1, 240: 1, 480: 1}  # the last event of minute 1 came too late
