"""Readers of saved pages, messages and activity, and the writer of extracted records."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.sources.schemas import FETCHED, PAGES


def read_pages(spark: SparkSession, path: str, fetched: bool = False) -> DataFrame:
    """Saved page snapshots: Parquet, or JSON lines if the path ends in .json or .jsonl; with fetched, also their times."""
    reader = spark.read.schema(FETCHED if fetched else PAGES)
    return reader.json(path) if path.endswith((".json", ".jsonl")) else reader.parquet(path)


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """Messages of threads from a table of conversation turns; other columns are not read."""
    t = spark.read.parquet(path)
    return t.select(
        F.col("conv_id").cast("long").alias("thread_id"),
        F.col("turn").cast("long").alias("seq"),
        F.col("role").alias("author"),
        "text",
    )


def read_activity(spark: SparkSession, path: str) -> DataFrame:
    """Timestamped actions. Zone-less times are cast in the session's zone, so that a watermark can be set on them."""
    t = spark.read.parquet(path)
    return t.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type")


def write_records(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write extracted records as Parquet. Not partitioned by host: one forum means one huge host folder."""
    df.write.mode(mode).parquet(path)


def scratch_folder(spark: SparkSession) -> str:
    """A new path below the folder that the session's driver and executors share. On one machine, as in tests, it is local
    where none is named; on a cluster that is an error, as the folder would be missing on other machines."""
    sc = spark.sparkContext
    shared = sc.getConf().get("spark.checkpoint.dir", None)
    if not shared and sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir names no shared folder")
    return f"{shared or tempfile.mkdtemp(prefix='spark-')}/{uuid.uuid4().hex}"
