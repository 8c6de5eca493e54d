"""Small helpers shared by the operators of this subpackage."""

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are maximal runs of characters other than space and the five ASCII controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder that the session names. On one machine, as in tests, one is set where none is named; on a
    cluster that is an error, as a folder of one machine would be missing on the others."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None)
    if sc.getCheckpointDir() is None:
        if not named and sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir names no shared folder")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-"))
    return named or sc.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> tuple[DataFrame, str]:
    """df as a Parquet table in the shared folder, and its path: smaller than a checkpoint, and kept until deleted."""
    path = f"{shared_folder(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path), path


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it lies in."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


#: Rows of keys up to which a table is broadcast, so that the other side stays where it is; beyond, both sides are shuffled.
MOST_KEYS = 1 << 20


def beside(keys: DataFrame, most: int = MOST_KEYS) -> DataFrame:
    """A stored table of short rows, to be broadcast if it has few enough of them, else to be shuffled and hashed."""
    return F.broadcast(keys) if keys.count() <= most else keys.hint("shuffle_hash")


def row_key(*columns: Column) -> Column:
    """64-bit key of a row. Rows that agree in these columns share it, and every operator here gives such rows
    the same result, so nothing depends on doc_id being unique or present."""
    return F.xxhash64(*columns)


def text_batches(batch: pa.RecordBatch, column: str, size: int = 1 << 20):
    """Cut an Arrow batch into slices of about size bytes of text, at least one row each.

    Yields (slice, bytes as uint8 array, int64 offsets from 0); null texts are empty.
    """
    values = batch.column(batch.schema.get_field_index(column))
    at = offsets(values)
    start, n = 0, len(batch)
    while start < n:
        stop = max(start + 1, int(np.searchsorted(at, at[start] + size, "right")) - 1)
        part = batch.slice(start, stop - start)
        yield part, data(values)[at[start] : at[stop]], at[start : stop + 1] - at[start]
        start = stop


def offsets(values: pa.Array) -> np.ndarray:
    """Offsets of a string or binary array into data(), with nulls empty."""
    wide = pa.types.is_large_string(values.type) or pa.types.is_large_binary(values.type)
    raw = np.frombuffer(values.buffers()[1], np.int64 if wide else np.int32)
    return raw[values.offset : values.offset + len(values) + 1].astype(np.int64)


def data(values: pa.Array) -> np.ndarray:
    buffer = values.buffers()[2]
    return np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenation of start, start + 1, ... of the given counts."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - counts), counts)


#: Odd multiplier of the polynomial hash of bytes, and its inverse modulo 2**64.
BASE = np.uint64(0x9E3779B97F4A7C15)
UNBASE = np.uint64(pow(int(BASE), -1, 1 << 64))


def powers(n: int, base: np.uint64) -> np.ndarray:
    """base**0 to base**(n - 1) modulo 2**64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers under which close values part."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


#: Bound on the bits of a filter of keys, a power of two.
FILTER_BITS = 1 << 27


def _slots(keys: np.ndarray, n_words: int) -> np.ndarray:
    """Bit of each key in a filter of so many 64-bit words."""
    return mixed(keys.view(np.uint64)) & np.uint64(64 * n_words - 1)


def key_filter(keys: DataFrame, n: int) -> np.ndarray:
    """Bits of all of n keys (the first column, long), eight or more for each up to FILTER_BITS. Which keys pass decides
    only what is looked up in the table of keys itself."""
    size = min(FILTER_BITS, 1 << max(6, (8 * n).bit_length())) // 64

    def slots(batches):
        for batch in batches:
            slot = _slots(batch.column(0).to_numpy(), size)
            bit = np.uint64(1) << (slot & np.uint64(63))
            yield pa.RecordBatch.from_arrays([pa.array((slot >> np.uint64(6)).view(np.int64)), pa.array(bit.view(np.int64))], names=["at", "bit"])

    found = keys.mapInArrow(slots, "at long, bit long").groupBy("at").agg(F.bit_or("bit").alias("bit")).toArrow()
    bits = np.zeros(size, np.uint64)
    bits[found.column("at").to_numpy()] = found.column("bit").to_numpy().view(np.uint64)
    return bits


def passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys (int64) may be among those of a filter."""
    slot = _slots(keys, len(bits))
    return (bits[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) > 0


def runs(held: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true bytes in concatenated texts; no run crosses texts."""
    border = np.zeros(len(held) + 1, bool)
    border[at] = True
    open_, close = held.copy(), held.copy()
    open_[1:] &= ~held[:-1] | border[1:-1]
    close[:-1] &= ~held[1:] | border[1:-1]
    return np.flatnonzero(open_), np.flatnonzero(close) + 1


def run_hashes(text: np.ndarray, at: np.ndarray, inside: np.ndarray, base: np.uint64 = BASE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the maximal runs of bytes for which the table inside holds, in the order of concatenated texts,
    and how many runs each text has. ASCII letters hash in lower case. base: an odd number."""
    if not len(text):
        return np.zeros(0, np.uint64), np.zeros(len(at) - 1, np.int64)
    low = np.arange(1, 257, dtype=np.uint64)
    low[65:91] += np.uint64(32)
    begin, end = runs(inside[text], at)
    sums = np.zeros(len(text) + 1, np.uint64)
    np.cumsum(low[text] * powers(len(text), base), out=sums[1:], dtype=np.uint64)
    unbase = np.uint64(pow(int(base), -1, 1 << 64))
    return mixed((sums[end] - sums[begin]) * powers(len(text), unbase)[begin]), np.diff(np.searchsorted(begin, at))
