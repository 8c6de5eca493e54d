"""What jobs leave out or can't place, as tables of reasons beside their results."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.functions.urls import url_host, url_origin
from pagemill.operators.pages import with_kind


def page_rejects(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """(page_id, url, reason): one row for each page and reason, in no way exclusive.

    Reasons: ``no address``, ``bad address`` (no http(s) address with a host), ``no kind`` (no rule matches), ``empty`` and
    ``cut off``. Pages are read once and stay where they are.
    """
    cut = ~F.coalesce(F.col("html").rlike(r"</html>\s*$"), F.lit(False))
    url, empty = F.col("url"), F.coalesce(F.length(F.trim("html")), F.lit(0)) == 0
    reasons = (
        ("no address", url.isNull()),
        ("bad address", url.isNotNull() & (url_origin(url).isNull() | url_host(url).isNull())),
        ("no kind", url.isNotNull() & F.col("kind").isNull()),
        ("empty", empty),
        ("cut off", cut & ~empty),
    )
    found = F.array_compact(F.array(*(F.when(when, F.lit(reason)) for reason, when in reasons)))
    return with_kind(pages, rules).select("page_id", "url", F.explode(found).alias("reason"))


def message_rejects(messages: DataFrame) -> DataFrame:
    """(thread_id, seq, reason, n): how many messages of a thread and number have a reason to be looked at.

    Reasons: ``no thread``, ``no number``, ``negative number``, ``no author``, ``no text`` (null), and ``repeated number``, which
    counts all messages of the number. Counted before they are shuffled, so a hot thread arrives as short rows.
    """
    t = messages.groupBy("thread_id", "seq").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("author").isNull()).alias("no_author"), F.count_if(F.col("text").isNull()).alias("no_text")
    )
    known = F.col("thread_id").isNotNull() & F.col("seq").isNotNull()
    reasons = (
        ("no thread", F.when(F.col("thread_id").isNull(), F.col("n"))),
        ("no number", F.when(F.col("seq").isNull(), F.col("n"))),
        ("negative number", F.when(F.col("seq") < 0, F.col("n"))),
        ("no author", F.nullif("no_author", F.lit(0))),
        ("no text", F.nullif("no_text", F.lit(0))),
        ("repeated number", F.when(known & (F.col("n") > 1), F.col("n"))),
    )
    found = F.array(*(F.struct(F.lit(reason).alias("reason"), n.cast("long").alias("n")) for reason, n in reasons))
    rows = t.select("thread_id", "seq", F.inline(found).alias("reason", "many"))
    return rows.filter("many is not null").withColumnRenamed("many", "n")
