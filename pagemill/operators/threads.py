"""Rollups, context and gaps of message threads ``(thread_id, seq, author, text)``."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Numbers of a stretch that is expanded at once, and of the longest gap that is listed number by number.
RUN, LONGEST = 1 << 16, 1 << 30
#: Largest number that oversized_threads doesn't report.
MAX_SEQ = 1_000_000


def thread_rollup(messages: DataFrame) -> DataFrame:
    """Messages, characters, authors and last author of each thread.

    Counted by (thread, author) first: distinct authors are then a plain count, and a hot thread arrives as one
    row for each author and task.
    """
    by_author = messages.groupBy("thread_id", "author").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"), F.max(F.struct("seq", "author")).alias("last")
    )
    return by_author.groupBy("thread_id").agg(
        F.sum("n").alias("n_messages"),
        F.coalesce(F.sum("chars"), F.lit(0)).alias("n_chars"),
        F.count("author").alias("n_authors"),
        F.max("last")["author"].alias("last_author"),
    )


def author_rollup(messages: DataFrame, approximate: bool = False) -> DataFrame:
    """Messages, characters and threads of each author; approximate counts threads with a sketch."""
    if approximate:
        return messages.groupBy("author").agg(
            F.count(F.lit(1)).alias("n_messages"),
            F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n_chars"),
            F.approx_count_distinct("thread_id").alias("n_threads"),
        )
    by_thread = messages.groupBy("author", "thread_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars")
    )
    return by_thread.groupBy("author").agg(
        F.sum("n").alias("n_messages"),
        F.coalesce(F.sum("chars"), F.lit(0)).alias("n_chars"),
        F.count("thread_id").alias("n_threads"),
    )


def message_context(messages: DataFrame) -> DataFrame:
    """Previous author and running characters in each thread. Texts are dropped before the shuffle. Messages of one number
    are in order of author, then length."""
    t = messages.select("thread_id", "seq", "author", F.coalesce(F.length("text"), F.lit(0)).alias("chars"))
    w = Window.partitionBy("thread_id").orderBy("seq", "author", "chars")
    return t.select(
        "thread_id",
        "seq",
        "author",
        F.lag("author").over(w).alias("prev_author"),
        F.sum("chars").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("running_chars"),
    )


def top_messages(messages: DataFrame, k: int) -> DataFrame:
    """The k longest messages of each thread, ties by seq, then author. Spark keeps k rows a task before it shuffles."""
    t = messages.select("thread_id", "seq", "author", F.coalesce(F.length("text"), F.lit(0)).alias("chars"))
    w = Window.partitionBy("thread_id").orderBy(F.desc("chars"), "seq", "author")
    return t.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def missing_messages(messages: DataFrame, max_seq: int | None = None, longest: int = LONGEST) -> DataFrame:
    """Gaps of each thread between 0 and its largest number, as one row for each missing number.

    Gaps of over longest numbers, which only absurd numbers make, are not listed number by number: long_gaps reports them as
    ranges, so nothing is lost. Other long gaps are cut into stretches of RUN numbers, which are dealt over the cluster before
    they are expanded, so no task has more than a stretch in memory. With max_seq, only missing numbers up to it count, and
    oversized_threads reports the threads that go on.
    """
    gaps = _up_to(message_gaps(messages), max_seq).filter(F.col("gap_to") - F.col("gap_from") < longest)
    short = F.col("gap_to") - F.col("gap_from") < RUN
    begin = F.explode(F.sequence("gap_from", "gap_to", F.lit(RUN).cast("long"))).alias("begin")
    cut = gaps.filter(~short).select("thread_id", "gap_to", begin).repartition("thread_id", "begin")
    stretches = cut.select("thread_id", F.col("begin").alias("gap_from"), F.least("gap_to", F.col("begin") + (RUN - 1)).alias("gap_to"))
    every = gaps.filter(short).unionByName(stretches)
    return every.select("thread_id", F.explode(F.sequence("gap_from", "gap_to")).alias("seq"))


def long_gaps(messages: DataFrame, max_seq: int | None = None, longest: int = LONGEST) -> DataFrame:
    """The gaps that missing_messages doesn't list, as message_gaps has them."""
    return _up_to(message_gaps(messages), max_seq).filter(F.col("gap_to") - F.col("gap_from") >= longest)


def _up_to(gaps: DataFrame, max_seq: int | None) -> DataFrame:
    if max_seq is None:
        return gaps
    return gaps.withColumn("gap_to", F.least("gap_to", F.lit(max_seq).cast("long"))).filter("gap_from <= gap_to")


def message_gaps(messages: DataFrame) -> DataFrame:
    """Gaps as ranges ``(thread_id, gap_from, gap_to)``; their number is bounded by the messages, whatever the numbers are."""
    w = Window.partitionBy("thread_id").orderBy("seq")
    t = messages.filter(F.col("seq") >= 0).select("thread_id", "seq")
    t = t.select("thread_id", "seq", F.coalesce(F.lag("seq").over(w), F.lit(-1).cast("long")).alias("prev"))
    return t.filter(F.col("seq") > F.col("prev") + 1).select(
        "thread_id", (F.col("prev") + 1).alias("gap_from"), (F.col("seq") - 1).alias("gap_to")
    )


def oversized_threads(messages: DataFrame, max_seq: int = MAX_SEQ) -> DataFrame:
    """Threads whose numbers exceed max_seq, with the largest."""
    top = messages.groupBy("thread_id").agg(F.max("seq").alias("max_seq"))
    return top.filter(F.col("max_seq") > max_seq)
