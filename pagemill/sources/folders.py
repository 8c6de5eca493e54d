"""Folders of the store that the session reads from, whatever store that is."""

from pyspark.sql import SparkSession


def _system(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def written(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers of the completely written folders ``path/prefix=number``, rising."""
    system, folder = _system(spark, path)
    if not system.exists(folder):
        return []
    inside = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    names = [(s.getPath().getName(), s.getPath()) for s in system.listStatus(folder)]
    named = [(int(n.removeprefix(f"{prefix}=")), p) for n, p in names if n.startswith(f"{prefix}=")]
    return sorted(n for n, p in named if system.exists(inside(p, "_SUCCESS")))


def exists(spark: SparkSession, path: str) -> bool:
    system, folder = _system(spark, path)
    return system.exists(folder)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder with what is in it; one that isn't there is no error."""
    system, folder = _system(spark, path)
    system.delete(folder, True)
