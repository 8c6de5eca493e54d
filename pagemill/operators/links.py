"""Link extraction, the crawl frontier and in-link counts."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.functions import html as H
from pagemill.functions.filters import bits_for, key_filter, may_hold
from pagemill.functions.urls import canonical_url, resolve_href
from pagemill.sources.tables import scratch_folder


def extract_links(pages: DataFrame) -> DataFrame:
    """One row per outgoing link with its position and resolved target. Entities in it stay as they are."""
    found = F.regexp_extract_all(H.clean_html(F.col("html")), F.lit(H.LINK), F.lit(1))
    rows = pages.select("page_id", "url", F.posexplode(found).alias("pos", "quoted"))
    rows = rows.select("page_id", "url", "pos", F.regexp_replace("quoted", H.QUOTES, "").alias("href"))
    return rows.select("page_id", "pos", "href", resolve_href(F.col("url"), F.col("href")).alias("target"))


def _targets(links: DataFrame, keep_params: tuple[str, ...] = ()) -> DataFrame:
    t = links.filter(F.col("target").isNotNull())
    return t.select(canonical_url(F.col("target"), keep_params).alias("target")).distinct()


def _known(pages: DataFrame, keep_params: tuple[str, ...] = ()) -> DataFrame:
    return pages.select(canonical_url(F.col("url"), keep_params).alias("target"))


def frontier(links: DataFrame, pages: DataFrame, keep_params: tuple[str, ...] = ()) -> DataFrame:
    """Distinct canonical targets that no saved page has: the list to fetch next."""
    return _targets(links, keep_params).join(_known(pages, keep_params), "target", "left_anti")


def internal_links(links: DataFrame, pages: DataFrame, keep_params: tuple[str, ...] = ()) -> DataFrame:
    """Distinct canonical targets that a saved page has."""
    return _targets(links, keep_params).join(_known(pages, keep_params), "target", "left_semi")


def filtered_frontier(links: DataFrame, pages: DataFrame, keep_params: tuple[str, ...] = ()) -> DataFrame:
    """The same as frontier, for a very large set of known pages.

    A Bloom filter of the known addresses parts the targets, which are written once: those that fail it are surely new and
    meet no known page. A filter of the others then leaves only the known addresses that may be among them, and these two
    small rests are joined exactly. A side of more keys than a filter of bounded size can tell apart goes unfiltered: either
    filter alone spares most of the join, and without both this is frontier.
    """
    spark = links.sparkSession
    path = scratch_folder(spark)
    known = _known(pages, keep_params).filter("target is not null")
    targets = _targets(links, keep_params)
    bits = bits_for(known.count())
    may = F.lit(True) if bits is None else may_hold(key_filter(known, "target", bits), targets, "target")
    targets.withColumn("maybe", may).write.parquet(path)
    marked = spark.read.parquet(path)
    new, maybe = marked.filter(~F.col("maybe")).select("target"), marked.filter("maybe").select("target")
    n = maybe.count()
    bits = bits_for(n)
    if n and bits is not None:
        known = known.filter(may_hold(key_filter(maybe, "target", bits), known, "target"))
    return new.unionByName(maybe.join(known, "target", "left_anti")) if n else new


def inlink_counts(links: DataFrame) -> DataFrame:
    """Links and linking pages for each target. Counted by (target, page) first, so that a menu link found on
    every page is spread over tasks before its total is made."""
    by_page = links.filter(F.col("target").isNotNull()).groupBy("target", "page_id").agg(F.count(F.lit(1)).alias("n"))
    return by_page.groupBy("target").agg(F.sum("n").alias("n_links"), F.count("page_id").alias("n_pages"))


def top_targets(links: DataFrame, k: int) -> DataFrame:
    """The k targets with most links, ties by target."""
    return inlink_counts(links).orderBy(F.desc("n_links"), "target").limit(k)


#: Targets that a sketch of frequent ones holds, and the groups of tasks whose sketches are merged first.
TRACKED, SKETCHES = 1 << 16, 256


def frequent_targets(links: DataFrame, k: int, tracked: int = TRACKED) -> DataFrame:
    """The same as top_targets, in two passes that shuffle candidates only. links is read twice: give a stored table.

    The first pass makes a mergeable sketch of frequent targets, the second counts the sketch's targets exactly. A sketch of
    N links names every target of more than twice its error, 2.625 N / tracked at most, so where the k-th count is above
    that, or the sketch was large enough for all targets, no other target can be among the first k. Where neither holds,
    links are spread too evenly for a sketch, and all targets are counted.
    """
    t = links.filter(F.col("target").isNotNull())
    parts = t.groupBy((F.spark_partition_id() % SKETCHES).alias("part"))
    sketches = parts.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k_accumulate(target, {tracked})").alias("sketch"))
    merged = sketches.groupBy(F.lit("all")).agg(F.sum("n").alias("n"), F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"))
    path = scratch_folder(links.sparkSession)
    merged.select("n", F.inline(F.expr(f"approx_top_k_estimate(sketch, {tracked})"))).write.parquet(path)
    named = links.sparkSession.read.parquet(path)
    sums = named.agg(F.max("n").alias("n"), F.sum("count").alias("held")).first()
    counted = inlink_counts(t.join(F.broadcast(named.select(F.col("item").alias("target"))), "target", "left_semi"))
    first = counted.orderBy(F.desc("n_links"), "target").limit(k)
    if sums.n and sums.held < sums.n:
        path = scratch_folder(links.sparkSession)
        first.write.parquet(path)
        first = links.sparkSession.read.parquet(path).orderBy(F.desc("n_links"), "target")
        least = first.agg(F.count(F.lit(1)).alias("found"), F.min("n_links").alias("n")).first()
        if least.found < k or least.n <= 2 * 2.625 * sums.n / tracked:
            return top_targets(links, k)
    return first
