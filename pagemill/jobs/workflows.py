"""The three end-to-end jobs."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagemill.functions.urls import canonical_url
from pagemill.operators import links as L
from pagemill.operators import pages as P


def current_page_records(pages: DataFrame, rules: DataFrame, keep_params: tuple[str, ...] = (), order: str = "page_id") -> DataFrame:
    """W1: latest snapshot of each address, extracted and labelled in one pass over the fetched bodies. keep_params: parameters
    that tell addresses apart, such as the page of a thread. order: what makes a snapshot later than another."""
    latest = P.latest_pages(pages, order, keep_params).select("page_id", "url", "html")
    return P.page_records(P.with_kind(latest, rules), "kind", keep_params=keep_params)


def crawl_frontier(pages: DataFrame, k: int, keep_params: tuple[str, ...] = ()) -> DataFrame:
    """W2: the k most linked addresses that aren't saved yet.

    Links are counted by (address, page) before they meet, and known addresses are subtracted from the counts, so pages
    are parsed once.
    """
    links = L.extract_links(pages).filter(F.col("target").isNotNull())
    by_page = links.groupBy(canonical_url(F.col("target"), keep_params).alias("canon"), "page_id").agg(F.count(F.lit(1)).alias("n"))
    ranked = by_page.groupBy("canon").agg(F.sum("n").alias("n_links"), F.count("page_id").alias("n_pages"))
    known = pages.select(canonical_url(F.col("url"), keep_params).alias("canon"))
    return ranked.join(known, "canon", "left_anti").orderBy(F.desc("n_links"), "canon").limit(k)


def thread_report(messages: DataFrame) -> DataFrame:
    """W3: messages, characters, authors, last author, changes of author and missing numbers of each thread.

    One shuffle by thread, of short rows: the window and all aggregates after it share its partitioning.
    """
    w = Window.partitionBy("thread_id").orderBy("seq")
    t = messages.select("thread_id", "seq", "author", F.coalesce(F.length("text"), F.lit(0)).alias("chars"))
    t = t.withColumns({"prev_author": F.lag("author").over(w), "prev_seq": F.lag("seq").over(w)})
    changed = ~F.col("author").eqNullSafe(F.col("prev_author")) & F.col("prev_author").isNotNull()
    before = F.greatest(F.coalesce("prev_seq", F.lit(-1)), F.lit(-1))
    return t.groupBy("thread_id").agg(
        F.count(F.lit(1)).alias("n_messages"),
        F.sum("chars").alias("n_chars"),
        F.count_distinct("author").alias("n_authors"),
        F.max(F.struct("seq", "author"))["author"].alias("last_author"),
        F.count_if(changed).alias("n_switches"),
        F.sum(F.greatest(F.col("seq") - before - 1, F.lit(0))).alias("n_missing"),
    )
