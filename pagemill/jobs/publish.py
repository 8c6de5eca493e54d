"""The end-to-end jobs as stored tables, a run at a time.

A job writes each of its tables to ``root/table/run=N``. Readers take the last complete run of a table, so one that is cut off
is not seen, and its number is used again. Runs beyond the last few are deleted once a new one is complete.
"""

from pyspark.sql import DataFrame, SparkSession

from pagemill.jobs import workflows
from pagemill.operators import threads as T
from pagemill.operators.rejects import message_rejects, page_rejects
from pagemill.sources.folders import delete, written
from pagemill.sources.tables import write_records

#: Complete runs of a table that are kept.
KEEP = 3


def publish(df: DataFrame, root: str, table: str, keep: int = KEEP) -> DataFrame:
    """Store df as the next run of a table and delete all but the last runs; the stored table."""
    if keep < 1:
        raise ValueError("at least one run is kept")
    spark = df.sparkSession
    runs = written(spark, f"{root}/{table}", "run")
    write_records(df, f"{root}/{table}/run={max(runs, default=-1) + 1}", mode="overwrite")
    for run in written(spark, f"{root}/{table}", "run")[:-keep]:
        delete(spark, f"{root}/{table}/run={run}")
    return current(spark, root, table)


def current(spark: SparkSession, root: str, table: str, run: int | None = None) -> DataFrame:
    """The last complete run of a table, or the one of a number."""
    runs = written(spark, f"{root}/{table}", "run")
    if not runs or (run is not None and run not in runs):
        raise ValueError(f"{root}/{table} has no complete run" + ("" if run is None else f" {run}"))
    return spark.read.parquet(f"{root}/{table}/run={runs[-1] if run is None else run}")


def publish_pages(pages: DataFrame, rules: DataFrame, root: str, k: int = 100_000, keep_params: tuple[str, ...] = (), keep: int = KEEP) -> None:
    """W1 and W2 over saved pages: the tables ``records``, ``page_rejects`` and ``frontier``.

    Where pages have a ``fetched_at``, it says which snapshot of an address is the latest; else page_id does.
    """
    order = "fetched_at" if "fetched_at" in pages.columns else "page_id"
    publish(workflows.current_page_records(pages, rules, keep_params, order), root, "records", keep)
    publish(page_rejects(pages, rules), root, "page_rejects", keep)
    publish(workflows.crawl_frontier(pages, k, keep_params), root, "frontier", keep)


def publish_threads(messages: DataFrame, root: str, keep: int = KEEP) -> None:
    """W3 over messages: the tables ``threads``, ``gaps`` (as ranges) and ``message_rejects``."""
    publish(workflows.thread_report(messages), root, "threads", keep)
    publish(T.message_gaps(messages), root, "gaps", keep)
    publish(message_rejects(messages), root, "message_rejects", keep)
