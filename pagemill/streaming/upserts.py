"""Tables that the batches of a stream are merged into by key, kept as folders of Parquet.

A batch writes its changes to ``changes/batch=N``. A batch that runs again replaces its own folder and no other, so a run
that is cut off anywhere goes on without loss or repeats. What has piled up is folded from time to time: the rows up to batch
N that may still change go to ``folded/upto=N/closed=false``, those that no later batch can change to ``closed=true``, and
the folders of the changes are deleted. Rows that were closed once are never read or written again by later folds. A folder
counts once it is complete, so a fold that is cut off changes nothing; folders of changes that a complete fold covers are
ignored until they are deleted.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.sources.folders import delete, exists, written


def write_changes(changes: DataFrame, folder: str, number: int) -> None:
    """Keep the changes of a batch, in place of what the same batch wrote before."""
    changes.write.mode("overwrite").parquet(f"{folder}/changes/batch={number}")


def read_changes(spark: SparkSession, folder: str, before: int | None = None) -> DataFrame | None:
    """All rows that may still change, with the batch that they come from; with before, those of earlier batches. Folded rows
    come from the last batch that was folded. None if there is nothing."""
    within = lambda n: before is None or n < before
    folds = [n for n in written(spark, f"{folder}/folded", "upto") if within(n)]
    paths = [f"{folder}/folded/upto={n}/closed=false" for n in folds[-1:]]
    paths = [p for p in paths if exists(spark, p)]
    batches = [n for n in written(spark, f"{folder}/changes", "batch") if within(n) and n > max(folds, default=-1)]
    paths += [f"{folder}/changes/batch={n}" for n in batches]
    if not paths:
        return None
    number = F.regexp_extract(F.col("_metadata.file_path"), r"/(?:changes/batch|folded/upto)=(\d+)/", 1)
    return spark.read.parquet(*paths).withColumn("batch", number.cast("long"))


def read_closed(spark: SparkSession, folder: str) -> DataFrame | None:
    """All rows that no later batch can change; None if there are none."""
    paths = [f"{folder}/folded/upto={n}/closed=true" for n in written(spark, f"{folder}/folded", "upto")]
    paths = [p for p in paths if exists(spark, p)]
    return spark.read.parquet(*paths) if paths else None


def fold(spark: SparkSession, folder: str, merged: Callable[[DataFrame], DataFrame], closed: Column | None = None) -> None:
    """Fold all changes there are: merged reduces rows that may still change to one for each key; closed says which of
    these no later batch can change."""
    batches, folds = written(spark, f"{folder}/changes", "batch"), written(spark, f"{folder}/folded", "upto")
    if batches and batches[-1] > max(folds, default=-1):
        rows = merged(read_changes(spark, folder)).drop("batch")
        rows = rows.withColumn("closed", F.lit(False) if closed is None else F.coalesce(closed, F.lit(False)))
        rows.write.mode("overwrite").partitionBy("closed").parquet(f"{folder}/folded/upto={batches[-1]}")
    for n in batches:
        delete(spark, f"{folder}/changes/batch={n}")
    for n in folds:
        if n < max(batches, default=-1):
            delete(spark, f"{folder}/folded/upto={n}/closed=false")
