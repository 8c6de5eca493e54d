"""Per-page operators: extraction, labels, rollups and the latest snapshot of each address."""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from pagemill.functions import html as H
from pagemill.functions.urls import canonical_url, url_host
from pagemill.operators.rules import indexed_rules, kinds_of_urls
from pagemill.sources.tables import scratch_folder


def page_records(pages: DataFrame, *keep: str, keep_params: tuple[str, ...] = ()) -> DataFrame:
    """One record for each page: canonical address, host, title, decoded text and fingerprint, and the columns in keep.
    Narrow: no shuffle."""
    return pages.select(
        "page_id",
        canonical_url(F.col("url"), keep_params).alias("canon"),
        url_host(F.col("url")).alias("host"),
        H.page_title(F.col("html")).alias("title"),
        H.decode_entities(H.page_text(F.col("html"))).alias("text"),
        H.content_hash(F.col("html")).alias("hash"),
        *keep,
    )


def truncated_pages(pages: DataFrame, keep: bool = True) -> DataFrame:
    """Pages cut off before ``</html>``, or with keep=False the others. A null page is cut off."""
    cut = ~F.coalesce(F.col("html").rlike(r"</html>\s*$"), F.lit(False))
    return pages.filter(cut if keep else ~cut)


def extract_blocks(pages: DataFrame) -> DataFrame:
    """One row per ``<p>...</p>`` with its position. Blocks don't nest: an unclosed one runs to the next ``</p>``."""
    found = F.regexp_extract_all(H.clean_html(F.col("html")), F.lit(H.BLOCK), F.lit(1))
    return pages.select("page_id", F.posexplode(found).alias("pos", "block"))


#: Rows that a rule table may have: it is a caller's list, whose patterns become part of the plan.
MOST_RULES = 1000


def _rule_list(rules: DataFrame, *columns: str) -> list:
    """The rows of a rule table, in order of prio and then of the other columns."""
    found = rules.select(*columns).limit(MOST_RULES + 1).collect()
    if len(found) > MOST_RULES:
        raise ValueError(f"a rule table has {MOST_RULES} rows at most")
    return sorted(found, key=lambda r: (r["prio"], *map(str, r)))


def extract_fields(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Named fields by a rule table ``(kind, field, prio, pattern)``, so that page layouts stay data.

    pages: ``(page_id, html, kind)``, as with_kind gives them. For each page and field of its kind, the first group of the
    first rule in order of prio that matches with a non-empty group wins; null if none does. The rules of a page's kind are
    evaluated on the page's row: nothing is shuffled, and html is not repeated.
    """
    by_kind: dict[str, dict[str, list[Column]]] = {}
    for r in _rule_list(rules, "kind", "field", "prio", "pattern"):
        value = F.nullif(F.regexp_extract("html", r["pattern"], 1), F.lit(""))
        by_kind.setdefault(r["kind"], {}).setdefault(r["field"], []).append(value)
    found = F.lit(None).cast("array<struct<field:string,value:string>>")
    for kind, fields in by_kind.items():
        values = F.array(*(F.struct(F.lit(f).alias("field"), F.coalesce(*v).alias("value")) for f, v in fields.items()))
        found = F.when(F.col("kind") == kind, values).otherwise(found)
    return pages.select("page_id", F.inline(found))


def with_kind(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """pages with the kind that rules ``(prio, pat, kind)`` give: of the patterns that match a URL, the lowest prio wins.

    Pages that no pattern matches, and those without a URL, have a null kind. Up to MOST_RULES patterns are part of the plan,
    so pages stay where they are. Of more rules, those whose patterns begin with some text after ``^`` are found by it, for
    each distinct URL once, and pages meet their kinds by URL; of the others there may be as many as the plan may have.
    """
    if rules.limit(MOST_RULES + 1).count() <= MOST_RULES:
        return pages.withColumn("kind", _first_rule(rules, "string", lambda r: F.lit(r["kind"])))
    indexed, rest = indexed_rules(rules.withColumn("prio", F.col("prio").cast("int")))
    row = "struct<prio:int,pat:string,kind:string>"
    best = _first_rule(rest, row, lambda r: F.struct(*(F.lit(r[c]).alias(c) for c in ("prio", "pat", "kind"))).cast(row))
    found = kinds_of_urls(pages, indexed).withColumnsRenamed({"url": "__url", "best": "__best"})
    met = pages.join(found, F.col("url") == F.col("__url"), "left")
    return met.withColumn("kind", F.least("__best", best)["kind"]).drop("__url", "__best")


def _first_rule(rules: DataFrame, kind: str, value: Callable[[Row], Column]) -> Column:
    """Of the rules whose patterns match url, the first one's value; null if none does."""
    out = F.lit(None).cast(kind)
    for r in reversed(_rule_list(rules, "prio", "pat", "kind")):
        out = F.when(F.col("url").rlike(r["pat"]), value(r)).otherwise(out)
    return out


def classify_pages(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """(page_id, kind) of each page, by with_kind."""
    return with_kind(pages, rules).select("page_id", "kind")


#: Winners up to which they are broadcast, so that bodies stay where they are; beyond, bodies are shuffled but never sorted.
MOST_WINNERS = 1 << 20


def latest_pages(pages: DataFrame, order: str = "page_id", keep_params: tuple[str, ...] = ()) -> DataFrame:
    """The latest snapshot for each canonical address: the one of the greatest order, then page_id, then digest.

    Pages without an address are each one for themselves. Rows that agree in page_id, url, html and order are one page.
    keep_params: parameters that tell addresses apart, as for canonical_url.

    The winners are found by aggregates over keys, whose partial steps collapse a hot address before the shuffle, and are
    written to a table of keys. That pass reads no bodies: only where several rows of an address agree in order and page_id,
    or pages have no address, are digests of their bodies compared. All other bodies are read once, to be fetched.
    """
    spark = pages.sparkSession
    keyed = pages.withColumn("canon", canonical_url(F.col("url"), keep_params))
    best = F.struct(F.col(order).alias("order_key"), "page_id").alias("best")
    counted = keyed.select("canon", best).groupBy("canon", "best").agg(F.count(F.lit(1)).alias("n"))
    path = scratch_folder(spark)
    counted.groupBy("canon").agg(F.max(F.struct("best", "n")).alias("newest")).select(
        "canon", "newest.best", (F.col("newest.n") > 1).alias("tied")
    ).write.parquet(path)
    newest = spark.read.parquet(path)
    several, alone = F.col("tied"), F.col("canon").isNull()
    sizes = newest.agg(F.count_if(~several & ~alone).alias("single"), F.count_if(several & ~alone).alias("tied"), F.count_if(alone).alias("alone")).first()

    def fetched(which: Column, n: int) -> DataFrame:
        keys = newest.filter(which).select(F.col("canon").alias("__canon"), F.col("best").alias("__best"))
        keys = F.broadcast(keys) if n <= MOST_WINNERS else keys.hint("shuffle_hash")
        same = (F.col("canon") == F.col("__canon")) & best.eqNullSafe(F.col("__best"))
        return keyed.join(keys, same, "left_semi")

    parts = [fetched(~several & ~alone, sizes.single)]
    if sizes.tied or sizes.alone:  # few: their bodies are compared by digest, and shuffled by it
        tied = fetched(several & ~alone, sizes.tied).unionByName(keyed.filter("canon is null")).withColumn("__row", F.xxhash64("page_id", "url", "html", order))
        won = tied.groupBy("canon", F.when(F.col("canon").isNull(), F.col("__row")).alias("__alone")).agg(F.max("__row").alias("__row")).select("__row")
        parts.append(tied.join(won.hint("shuffle_hash"), "__row", "left_semi").dropDuplicates(["__row"]).drop("__row"))
    return reduce(DataFrame.unionByName, parts)


def page_cube(pages: DataFrame) -> DataFrame:
    """Page counts by host and language with subtotals."""
    t = pages.select(url_host(F.col("url")).alias("host"), H.page_lang(F.col("html")).alias("lang"))
    return t.cube("host", "lang").agg(F.count(F.lit(1)).alias("n_pages"), F.grouping_id().alias("level"))


def diff_snapshots(old: DataFrame, new: DataFrame, keep_params: tuple[str, ...] = ()) -> DataFrame:
    """State of each address between two snapshots: new, gone, changed or same. Only digests are shuffled.

    Of the pages of an address, the one of the greatest id, then digest, counts. Pages without an address are compared by
    their ids.
    """

    def digests(pages: DataFrame, side: str) -> DataFrame:
        t = pages.select("page_id", canonical_url(F.col("url"), keep_params).alias("canon"), H.content_hash(F.col("html")).alias("h"))
        t = t.withColumn("alone", F.when(F.col("canon").isNull(), F.col("page_id")))
        t = t.groupBy("canon", "alone").agg(F.max(F.struct("page_id", "h")).alias(side))
        return t.withColumnsRenamed({"canon": f"canon_{side}", "alone": f"alone_{side}"})

    same_key = F.col("canon_o").eqNullSafe(F.col("canon_n")) & F.col("alone_o").eqNullSafe(F.col("alone_n"))
    both = digests(old, "o").join(digests(new, "n"), same_key, "full_outer")
    state = (
        F.when(F.col("o").isNull(), "new")
        .when(F.col("n").isNull(), "gone")
        .when(F.col("o.h").eqNullSafe(F.col("n.h")), "same")
        .otherwise("changed")
    )
    return both.select(
        F.coalesce("canon_o", "canon_n").alias("canon"), F.col("o.page_id").alias("old_id"), F.col("n.page_id").alias("new_id"), state.alias("state")
    )


def recent_rank(pages: DataFrame, k: int) -> DataFrame:
    """The k latest snapshots of each address, keys only."""
    keys = pages.select("page_id", canonical_url(F.col("url")).alias("canon"))
    w = Window.partitionBy("canon").orderBy(F.desc("page_id"))
    return keys.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
