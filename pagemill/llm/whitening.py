"""Whitening of embeddings by the eigenvectors of their covariance.

Entries c become whole numbers x = floor(1024 c) + 100000, so that counts, sums S and the centred entries n x - S are exact
whatever the order in which Spark adds them. Rows centred that way and divided by n, their only rounding, are the rows of an
MLlib RowMatrix; its Gramian over n is the covariance V. V is as large as the square of the vectors' dimension, whatever the
number of rows, and is taken apart on the driver. Each row is then projected on the first components and divided by the root
of their eigenvalues, in one narrow pass with the components broadcast.

Nothing is shuffled but sums: one row for each dimension and task, and the Gramian's partial sums, merged as a tree.

Which rows take part: those whose vector has an entry in every dimension of the table's longest, all finite and within the
64-bit range as x. Null and empty vectors, shorter ones, and those with null, non-finite or larger entries are dropped.
Repeated rows and rows with a null vec_id are rows like others. Components whose eigenvalue is zero up to rounding have no
whitened form and are left out, so equal vectors, a single one or an empty table give no rows.
"""

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import durable

#: Fixed values of the scale: x = floor(SCALE c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
#: Entries whose scaled size reaches this bound count as non-finite: beyond, x would not fit into 64 bits.
LARGEST = 2.0**62
LONG = (1 << 63) - 1
#: Dimensions that MLlib's Gramian allows.
MOST_DIMENSIONS = 65_535
OUT = "component int, n long, deviation long, whitened double"


@dataclass
class Whitening:
    """n rows of exact sums; projections (dimension by component) already divided by the root of the eigenvalues."""

    n: int
    sums: list[int]
    covariance: np.ndarray
    eigenvalues: np.ndarray
    projections: np.ndarray
    largest: int

    @property
    def wide(self) -> bool:
        """Whether n x - S may pass 64 bits."""
        return self.n * self.largest >= 1 << 61

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact: in 64 bits, or as Python integers where they may not suffice."""
        if self.wide:
            return x.astype(object) * self.n - np.array(self.sums, object)
        return x * self.n - np.array(self.sums, np.int64)


def integers(v: Column) -> Column:
    """A vector's entries as x."""
    return F.transform(v, lambda c: F.floor(c * F.lit(float(SCALE))).cast("long") + F.lit(SHIFT).cast("long"))


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """vectors, with the column __v of doubles, of rows whose entries are all there, finite and in range."""
    v = F.col("embedding").cast("array<double>")
    inside = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) * SCALE < LARGEST))
    return vectors.filter(F.coalesce(inside & (F.size(v) > 0), F.lit(False))).withColumn("__v", v)


def _matrix(column: pa.Array) -> np.ndarray:
    """x of the vectors of a batch, all of one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    return np.floor(flat * SCALE).astype(np.int64) + SHIFT


def _sums(batches):
    """For each dimension of a task's rows: rows, the sum of x and the largest size of x."""
    n, total, largest = 0, None, None
    for batch in batches:
        if not len(batch):
            continue
        x = _matrix(batch.column(0))
        size = np.abs(x).max(0)
        fits = int(size.max()) * len(x) < LONG
        part = (x if fits else x.astype(object)).sum(0).astype(object)
        n, total = n + len(x), part if total is None else total + part
        largest = size if largest is None else np.maximum(largest, size)
    if n:
        arrays = [pa.array(range(len(total)), pa.int32()), pa.array([n] * len(total), pa.int64()), pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0)), pa.array(largest)]
        yield pa.RecordBatch.from_arrays(arrays, names=["dim", "n", "total", "largest"])


def fit(vectors: DataFrame, components: int = 8) -> Whitening | None:
    """Whitening fitted on all rows of vectors, as whole_vectors gives them, of one length; None where there are none."""
    sums = vectors.select("__v").mapInArrow(_sums, "dim int, n long, total decimal(38,0), largest long")
    rows = sums.groupBy("dim").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.max("largest").alias("largest")).orderBy("dim").collect()
    if not rows:
        return None
    found = Whitening(int(rows[0].n), [int(r.total) for r in rows], np.zeros(0), np.zeros(0), np.zeros(0), max(int(r.largest) for r in rows))
    n = found.n
    exact = "decimal(38,0)" if found.wide else "long"
    minus = F.array(*(F.lit(Decimal(s) if found.wide else s).cast(exact) for s in found.sums))
    centre = lambda x, s: (x.cast(exact) * F.lit(n).cast("decimal(18,0)" if found.wide else "long") - s).cast("double") / F.lit(float(n))
    centred = vectors.select(array_to_vector(F.zip_with(integers(F.col("__v")), minus, centre)).alias("row"))
    matrix = RowMatrix(MLUtils.convertVectorColumnsFromML(centred, "row"), numCols=len(rows))
    found.covariance = matrix.computeGramianMatrix().toArray() / n
    values, units = np.linalg.eigh(found.covariance)
    values, units = values[::-1], units[:, ::-1]
    kept = values > max(values[0], 0.0) * len(values) * np.finfo(float).eps * 8
    kept[components:] = False
    found.eigenvalues, found.projections = values[kept], units[:, kept] / np.sqrt(values[kept])
    return found


def _centred(model: Whitening, frame: pd.DataFrame) -> np.ndarray:
    """n x - S of the rows of a frame, exact."""
    if not len(frame):
        return np.zeros((0, len(model.sums)), np.int64)
    return model.centred(np.floor(np.stack(frame["__v"].to_numpy()) * SCALE).astype(np.int64) + SHIFT)


def _whitened(model: Whitening, y: np.ndarray) -> np.ndarray:
    return (y.astype(np.float64) / model.n) @ model.projections


def project(vectors: DataFrame, fitted: Whitening, keep: list[str]) -> DataFrame:
    """The columns in keep, __deviation and __w, the whitened entries; narrow."""
    shared = vectors.sparkSession.sparkContext.broadcast(fitted)
    kinds = ", ".join(f"`{c}` {vectors.schema[c].dataType.simpleString()}" for c in keep)

    def run(frames):
        model = shared.value
        for frame in frames:
            y = _centred(model, frame)
            most = max((abs(int(y.max())), abs(int(y.min()))), default=0) if y.size else 0
            if most * most * len(model.sums) > LONG:
                squares = (y.astype(object) ** 2).sum(1)
                deviation = np.array([int(s) if s <= LONG else None for s in squares], object)
            else:
                deviation = (y.astype(np.int64) ** 2).sum(1)
            out = frame[keep].copy()
            out["__deviation"] = deviation
            out["__w"] = list(_whitened(model, y))
            yield out

    return vectors.select(*keep, "__v").mapInPandas(run, f"{kinds}{', ' if kinds else ''}__deviation long, __w array<double>")


def identity_error(vectors: DataFrame, fitted: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened entries minus the identity.

    Each task adds up its rows' products centred on its own mean; what the tasks' means differ by is added to that, centred
    on the mean of all, in a second step over one row for each task.
    """
    shared, k = vectors.sparkSession.sparkContext.broadcast(fitted), len(fitted.eigenvalues)

    def moments(frames):
        n, mean, scatter = 0, np.zeros(k), np.zeros((k, k))
        for frame in frames:
            w = _whitened(shared.value, _centred(shared.value, frame))
            if len(w):
                own = w.mean(0)
                total, off = n + len(w), own - mean
                scatter += (w - own).T @ (w - own) + np.outer(off, off) * (n * len(w) / total)
                n, mean = total, mean + off * (len(w) / total)
        if n:
            yield pd.DataFrame({"n": [n], "mean": [mean], "scatter": [scatter.ravel()]})

    tasks = durable(vectors.select("__v").mapInPandas(moments, "n long, mean array<double>, scatter array<double>"))
    sums = tasks.agg(F.sum("n"), *(F.sum(F.col("n") * F.col("mean")[i]) for i in range(k))).first()
    means = [s / sums[0] for s in sums[1:]]
    off = [F.col("mean")[i] - F.lit(means[i]) for i in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i + 1)]
    row = tasks.agg(*(F.sum(F.col("scatter")[i * k + j] + F.col("n") * off[i] * off[j]) for i, j in pairs)).first()
    return max(abs(s / sums[0] - (i == j)) for s, (i, j) in zip(row, pairs, strict=True))


def whiten(vectors: DataFrame, components: int = 8) -> DataFrame:
    """One row for each row that takes part and each component: the row's other columns, component (from 1), n, deviation,
    whitened, explained and identity_error.

    vectors: (vec_id, embedding) and others, which stay but for those named like a result. deviation, the sum of the squares
    of n x - S, is exact; it is null where it passes 64 bits. explained is the component's eigenvalue over the trace of the
    covariance, and identity_error the same value in all rows. The rows that take part are in the module's docstring.
    """
    made = {"component", "n", "deviation", "whitened", "explained", "identity_error", "embedding"}
    keep = [c for c in vectors.columns if c.lower() not in made]
    whole = whole_vectors(vectors)
    length = whole.agg(F.max(F.size("__v"))).first()[0]
    if length and length > MOST_DIMENSIONS:
        raise ValueError(f"vectors have {MOST_DIMENSIONS} dimensions at most")
    whole = whole.filter(F.size("__v") == (length or 0))
    fitted = fit(whole, components) if length else None
    if fitted is None or not len(fitted.eigenvalues):
        none = ", ".join(f"cast(null as {t}) as {c}" for c, t in (x.split() for x in OUT.split(", ")))
        nothing = f"{none}, cast(null as double) as explained, cast(null as double) as identity_error"
        return vectors.select(*keep).limit(0).selectExpr(*(f"`{c}`" for c in keep), *nothing.split(", "))
    projected = project(whole, fitted, keep)
    error = identity_error(whole, fitted)
    shares = F.array(*(F.lit(float(e)) for e in fitted.eigenvalues / np.trace(fitted.covariance)))
    rows = projected.select(*keep, "__deviation", F.posexplode("__w").alias("__at", "whitened"))
    return rows.select(
        *keep,
        (F.col("__at") + 1).alias("component"),
        F.lit(fitted.n).cast("long").alias("n"),
        F.col("__deviation").alias("deviation"),
        "whitened",
        F.element_at(shares, F.col("__at") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
