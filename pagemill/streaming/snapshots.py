"""The latest page of each address, kept up to date from a stream of snapshots."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pagemill.operators.pages import MOST_WINNERS, latest_pages
from pagemill.sources.schemas import PAGES
from pagemill.streaming.upserts import fold, read_changes, write_changes

#: Batches after which what they changed is folded into one table.
FOLD_AFTER = 16


def stream_pages(spark: SparkSession, folder: str, files_at_once: int | None = None, **more) -> DataFrame:
    """Stream of page snapshots from the Parquet files of a folder; files that come later are read too. more: columns
    besides those of pages, with their types, such as ``fetched_at="timestamp"``."""
    schema = StructType(list(PAGES))
    for name, kind in more.items():
        schema.add(name, kind)
    reader = spark.readStream.schema(schema)
    if files_at_once:
        reader = reader.option("maxFilesPerTrigger", files_at_once)
    return reader.parquet(folder)


def _order(order: str) -> Column:
    """What makes one page of an address later than another. Digests part pages of one order and id."""
    return F.struct(F.col(order).alias("order_key"), F.col("page_id").alias("id"), F.xxhash64("page_id", "url", "html", order).alias("row"))


def upsert_pages(batch: DataFrame, number: int, folder: str, order: str = "page_id", keep_params: tuple[str, ...] = ()) -> None:
    """Merge a batch of pages into the table of latest pages in folder.

    Of each address in the batch, its latest page is kept if it is later than the one that earlier batches kept. Of those,
    only keys are read; where the batch is small enough, only those of its addresses leave the scan. The batch's own
    earlier writes are not looked at, so one that runs again comes to the same.
    """
    spark = batch.sparkSession
    found = latest_pages(batch, order, keep_params).withColumn("__version", _order(order))
    found = found.withColumn("__address", F.coalesce("canon", F.concat(F.lit("\0"), F.col("__version.row").cast("string"))))
    before = read_changes(spark, folder, before=number)
    if before is not None:
        few = batch.count() <= MOST_WINNERS
        known = before.select(F.col("__address").alias("__of"), F.col("__version").alias("__held"))
        if few:
            known = known.join(F.broadcast(found.select(F.col("__address").alias("__of"))), "__of", "left_semi")
        known = known.groupBy("__of").agg(F.max("__held").alias("__held"))
        known = F.broadcast(known) if few else known.hint("shuffle_hash")
        later = F.col("__held").isNull() | (F.col("__version") > F.col("__held"))
        found = found.join(known, F.col("__address") == F.col("__of"), "left").filter(later).drop("__of", "__held")
    write_changes(found, folder, number)


def store_latest(pages: DataFrame, folder: str, order: str = "page_id", keep_params: tuple[str, ...] = (), fold_after: int = FOLD_AFTER) -> None:
    """Run a stream of pages over what there is, and keep the latest page of each address in folder.

    Batches may come in any order of pages: the table is the same as latest_pages over all of them. Progress is kept in
    folder/state, so that a run that is cut off goes on where it was. After fold_after batches, the kept pages are folded.
    """

    def store(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        upsert_pages(batch, number, folder, order, keep_params)
        batch.unpersist()
        if (number + 1) % fold_after == 0:
            fold(batch.sparkSession, folder, _latest)

    writer = pages.writeStream.foreachBatch(store).option("checkpointLocation", f"{folder}/state")
    writer.trigger(availableNow=True).start().awaitTermination()


def _latest(rows: DataFrame) -> DataFrame:
    """Of each address, the row of the last version. Later batches only have later versions, so the last batch's row is it;
    bodies are fetched by a hash join on address and batch, as an address has one row in a batch."""
    last = rows.groupBy("__address").agg(F.max("batch").alias("batch"))
    return rows.join(last.hint("shuffle_hash"), ["__address", "batch"], "left_semi")


def read_latest(spark: SparkSession, folder: str) -> DataFrame | None:
    """The latest page of each address that a stream has stored, with canon and batch; None before the first batch."""
    rows = read_changes(spark, folder)
    return None if rows is None else _latest(rows).drop("__address", "__version")
