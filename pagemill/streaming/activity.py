"""Event-time activity counts, batch or stream."""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from pagemill.sources.schemas import ACTIVITY_FILES
from pagemill.streaming.upserts import fold, read_changes, read_closed, write_changes


def activity_counts(events: DataFrame, size: str, slide: str | None = None, delay: str = "1 hour") -> DataFrame:
    """Counts by window and event type, tumbling or (with slide) sliding.

    On a stream, state is bounded by delay, and events later than that are dropped; on a batch the watermark has
    no effect. ts must be a TIMESTAMP.
    """
    window = F.window("ts", size, slide) if slide else F.window("ts", size)
    counts = events.withWatermark("ts", delay).groupBy(window.alias("w"), "event_type").count()
    return counts.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "event_type", F.col("count").alias("n")
    )


def read_stream(spark: SparkSession, folder: str, files: str = "*.parquet", files_at_once: int | None = None) -> DataFrame:
    """Stream of activity from the files of a folder that match a name pattern; files that come later are read too."""
    reader = spark.readStream.schema(ACTIVITY_FILES).option("pathGlobFilter", files)
    stream = (reader.option("maxFilesPerTrigger", files_at_once) if files_at_once else reader).parquet(folder)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def _run(writer: DataStreamWriter, folder: str) -> StreamingQuery:
    """Run a stream over what there is. Progress and state are kept in folder/state, so that a run that is cut off goes on
    where it was."""
    query = writer.option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def _watermark(query: StreamingQuery) -> str | None:
    """The watermark of a stream's last batch, as a time with its zone."""
    return ((query.lastProgress or {}).get("eventTime") or {}).get("watermark")


def store_counts(counts: DataFrame, folder: str) -> None:
    """Run a stream of counts over what there is, and keep its changed counts in folder.

    Update mode: the state of windows that the watermark has passed is dropped. A batch that runs again replaces what it
    wrote, and leaves that of other batches alone. At the end, the batches' changes are folded, and the counts of windows
    that the watermark has passed are set aside for good. read_counts gives the result.
    """
    writer = counts.writeStream.outputMode("update").foreachBatch(lambda batch, number: write_changes(batch, folder, number))
    passed = _watermark(_run(writer, folder))
    fold(counts.sparkSession, folder, compacted, F.col("window_end") <= F.lit(passed).cast("timestamp"))


def read_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The counts of a stored stream: of each window and event type, those of the last batch that changed them. Windows that
    were closed when they were folded are read as they are."""
    return _with_closed(spark, folder, compacted)


def _with_closed(spark: SparkSession, folder: str, merged: Callable[[DataFrame], DataFrame]) -> DataFrame:
    open_, closed = read_changes(spark, folder), read_closed(spark, folder)
    if open_ is None and closed is None:
        raise ValueError(f"no batch has been stored in {folder}")
    return reduce(DataFrame.unionByName, [t for t in (None if open_ is None else merged(open_), closed) if t is not None])


WINDOW = ("window_start", "window_end", "event_type")


def compacted(counts: DataFrame) -> DataFrame:
    """The last counts of each window and event type."""
    return counts.groupBy(*WINDOW).agg(F.max_by("n", "batch").alias("n"))


def session_counts(events: DataFrame, gap: str, delay: str = "1 hour") -> DataFrame:
    """Sessions of each user: actions that follow each other within gap, with their first and last time and number.

    A session ends a gap after its last action. On a stream, each user's open sessions are state, merged as actions come in
    any order, and dropped once the watermark has passed their ends. On a batch, actions in one stretch of time as long as the
    gap are added up first, since they are in one session whatever lies between, so a user of very many actions arrives as
    one row for each stretch.
    """
    if events.isStreaming:
        rows = events.withWatermark("ts", delay).select("user_id", "ts", F.col("ts").alias("last"), F.lit(1).alias("n"))
        until = F.lit(gap)
    else:
        stretch = F.window("ts", gap)
        rows = events.groupBy("user_id", stretch).agg(F.min("ts").alias("ts"), F.max("ts").alias("last"), F.count(F.lit(1)).alias("n"))
        until = F.expr(f"make_interval(0, 0, 0, 0, 0, 0, (unix_micros(last + interval {gap}) - unix_micros(ts)) / 1000000bd)")
    sessions = rows.groupBy("user_id", F.session_window("ts", until).alias("s"))
    sessions = sessions.agg(F.min("ts").alias("first_ts"), F.max("last").alias("last_ts"), F.sum("n").alias("n"))
    return sessions.select("user_id", F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "n")


def store_sessions(sessions: DataFrame, folder: str, mode: str = "append") -> None:
    """Run a stream of sessions over what there is, and keep them in folder.

    In append mode, each session is written once the watermark has passed its end, and its state is dropped; sessions that
    may still grow are not there yet. In complete mode, all sessions are, and the last batch replaces those before it; all
    of them stay state, so that is for streams of bounded length.
    """
    if mode not in ("append", "complete"):
        raise ValueError("sessions are appended or complete")

    def store(batch: DataFrame, number: int) -> None:
        write_changes(batch, folder, number if mode == "append" else 0)

    _run(sessions.writeStream.outputMode(mode).foreachBatch(store), folder)


def read_sessions(spark: SparkSession, folder: str) -> DataFrame:
    """The sessions of a stored stream."""
    return _with_closed(spark, folder, lambda rows: rows.drop("batch"))


def delivered_once(events: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Events without repeats of their event_id.

    On a stream, ids are state until the watermark passes their time by delay: repeats within it are dropped, and so are
    events that come later than the watermark. An id that comes again with a time beyond that is a new event. On a batch,
    the earliest event of an id stays.
    """
    if events.isStreaming:
        return events.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["event_id"])
    rest = [c for c in events.columns if c not in ("event_id", "ts")]
    first = events.groupBy("event_id").agg(F.min(F.struct("ts", *rest)).alias("first"))
    return first.select("event_id", "first.*").select(*events.columns)


def store_events(events: DataFrame, folder: str) -> None:
    """Run a stream of events over what there is, and keep them in folder, by batch; read_events gives them."""
    _run(events.writeStream.foreachBatch(lambda batch, number: write_changes(batch, folder, number)), folder)


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    """The events of a stored stream."""
    return _with_closed(spark, folder, lambda rows: rows.drop("batch"))


def store_counts_and_late(events: DataFrame, folder: str, size: str, delay: str = "1 hour") -> None:
    """Run a stream of events over what there is: count those in time by tumbling window and event type, and keep the others.

    Before a batch, the watermark is the largest time of all earlier batches less delay. Events whose window ends at it or
    before, and those without a time, go to folder/late as they are; the others are counted. So each event is in one of the
    two, and both are the same however often a batch runs again. A batch's counts are added to those of others when they are
    read or, at the end, folded, so nothing is kept as state; windows that the watermark has passed are set aside for good.
    """
    spark = events.sparkSession

    def store(batch: DataFrame, number: int) -> None:
        passed = _passed(spark, folder, delay, number)
        timed = batch.withColumn("__w", F.window("ts", size))  # leaves out rows without a time
        late = F.coalesce(F.unix_micros("__w.end") <= F.lit(passed), F.lit(False))
        write_changes(timed.filter(late).drop("__w").unionByName(batch.filter("ts is null")), f"{folder}/late", number)
        keys = F.col("__w.start").alias("window_start"), F.col("__w.end").alias("window_end"), "event_type"
        write_changes(timed.filter(~late).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("last_ts")), folder, number)

    _run(events.writeStream.foreachBatch(store), folder)
    fold(spark, folder, _added, F.unix_micros("window_end") <= F.lit(_passed(spark, folder, delay)))


def _passed(spark: SparkSession, folder: str, delay: str, before: int | None = None) -> int | None:
    """The largest time of stored counts less delay, in microseconds. The window that has it is never closed, so closed ones aren't read."""
    counts = read_changes(spark, folder, before)
    return None if counts is None else counts.agg(F.unix_micros(F.max("last_ts") - F.expr(f"interval {delay}"))).first()[0]


def _added(counts: DataFrame) -> DataFrame:
    return counts.groupBy(*WINDOW).agg(F.sum("n").alias("n"), F.max("last_ts").alias("last_ts"))


def read_counts_in_time(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of the events that came in time."""
    return _with_closed(spark, folder, _added).drop("last_ts")


def read_late(spark: SparkSession, folder: str) -> DataFrame:
    """The events that came late, with the batch that they came in."""
    late = read_changes(spark, f"{folder}/late")
    if late is None:
        raise ValueError(f"no batch has been stored in {folder}")
    return late
