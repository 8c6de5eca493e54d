"""Snapshots of pages stored by address, so that what follows needs no shuffle.

A stored snapshot is a table bucketed and sorted by its key: the canonical address, or the id of a page without one. It is
shuffled once, when it is written; its latest pages and its comparison with another snapshot of as many buckets are then
made bucket by bucket. Its files lie in the folder that is named, and the table is known to the session's catalog.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.functions.html import content_hash
from pagemill.functions.urls import canonical_url

#: Buckets of a stored snapshot. Snapshots that are compared need as many; some 10 GB each is a good size.
BUCKETS = 64


def address_key(keep_params: tuple[str, ...] = ()) -> Column:
    """A page's canonical address; for one without, its id behind a character that no address begins with."""
    return F.coalesce(canonical_url(F.col("url"), keep_params), F.concat(F.lit("\0"), F.coalesce(F.col("page_id").cast("string"), F.lit(""))))


def store_snapshot(pages: DataFrame, table: str, path: str, buckets: int = BUCKETS, keep_params: tuple[str, ...] = (), mode: str = "errorifexists") -> DataFrame:
    """Store pages as a table of key, hash and their own columns; with mode append, beside what the table has."""
    rows = pages.withColumns({"key": address_key(keep_params), "hash": content_hash(F.col("html"))})
    # One task for each bucket, so that a bucket is one file for each time that the table is written to.
    writer = rows.repartition(buckets, "key").write.bucketBy(buckets, "key").sortBy("key")
    writer.mode(mode).format("parquet").option("path", path).saveAsTable(table)
    return pages.sparkSession.table(table)


def read_snapshot(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def _newest(stored: DataFrame, order: str) -> DataFrame:
    version = F.struct(F.col(order).alias("order_key"), "page_id", "hash")
    return stored.groupBy("key").agg(F.max(version).alias("newest"))


def latest_stored(stored: DataFrame, order: str = "page_id") -> DataFrame:
    """The latest page of each key of a stored table, as latest_pages has it: of the greatest order, then page_id, then hash.

    Keys and digests are read first, bodies once, to be fetched; rows that agree in key, order, page_id and hash are one
    page. No rows are shuffled.
    """
    newest = _newest(stored, order).withColumnRenamed("key", "of")
    # No row is later than its key's newest. An equality here would be one more key that Spark shuffles by.
    is_newest = F.struct(F.col(order).alias("order_key"), "page_id", "hash") >= F.col("newest")
    won = stored.join(newest.hint("shuffle_hash"), (F.col("key") == F.col("of")) & is_newest, "left_semi")
    return won.dropDuplicates(["key"])


def diff_stored(old: DataFrame, new: DataFrame) -> DataFrame:
    """State of each address between two stored snapshots of as many buckets: new, gone, changed or same, as diff_snapshots
    has it. Bodies aren't read, and no rows are shuffled."""
    o = _newest(old, "page_id").select(F.col("key").alias("key_o"), F.col("newest").alias("o"))
    n = _newest(new, "page_id").select(F.col("key").alias("key_n"), F.col("newest").alias("n"))
    both = o.join(n, F.col("key_o") == F.col("key_n"), "full_outer")
    state = (
        F.when(F.col("o").isNull(), "new")
        .when(F.col("n").isNull(), "gone")
        .when(F.col("o.hash").eqNullSafe(F.col("n.hash")), "same")
        .otherwise("changed")
    )
    key = F.coalesce("key_o", "key_n")
    return both.select(
        F.when(~key.startswith("\0"), key).alias("canon"), F.col("o.page_id").alias("old_id"), F.col("n.page_id").alias("new_id"), state.alias("state")
    )
