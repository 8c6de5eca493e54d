"""Bloom filters: which keys surely aren't among those of a large table."""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits set for each key, bits that each key gets, and the bound on all bits: 32 MB.
HASHES, PER_KEY, MOST_BITS = 3, 8, 1 << 28


def _slots(key: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(bits)) for i in range(HASHES)]


def bits_for(n: int) -> int | None:
    """Bits of a filter of n keys, a power of two; None if the bound leaves fewer than two a key, which would pass nearly
    all."""
    bits = 64
    while bits < min(n * PER_KEY, MOST_BITS):
        bits *= 2
    return bits if n * 2 <= bits else None


def key_filter(keys: DataFrame, key: str, bits: int) -> np.ndarray:
    """The words of a filter of all keys. Each task adds up its own words first, so what is shuffled and what the driver gets
    is bounded by the filter's size."""
    slots = keys.select(F.explode(F.array(*_slots(F.col(key), bits))).alias("slot"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("slot").bitwiseAND(63).cast("int"))
    found = slots.groupBy(F.shiftright("slot", 6).alias("at")).agg(F.bit_or(bit).alias("bit")).toArrow()
    words = np.zeros(bits // 64, np.uint64)
    words[found.column("at").to_numpy()] = found.column("bit").to_numpy().view(np.uint64)
    return words


def may_hold(words: np.ndarray, df: DataFrame, key: str) -> Column:
    """Whether a key of df may be among those of a filter. Only hashes leave the JVM."""
    shared = df.sparkSession.sparkContext.broadcast(words)

    @F.pandas_udf("boolean")
    def passes(*slots: pd.Series) -> pd.Series:
        held = np.ones(len(slots[0]), bool)
        for s in slots:
            at = s.to_numpy().view(np.uint64)
            held &= (shared.value[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) > 0
        return pd.Series(held)

    return passes(*_slots(F.col(key), 64 * len(words)))
