"""Exact nearest neighbours by largest inner product, with int8 product tiles.

Queries and candidates are dealt over a grid: each cell multiplies a block of queries with a block of candidates, both
quantised to int8 with one scale per vector, so that a cell's memory is bounded whatever the table's size. Rows are dealt
by a number that is stored with them and not by what they hold, so that a vector that very many rows share fills no cell.
With x = s q + e, the product of two vectors differs from that of their quantised forms by at most
|x| |e_y| + |e_x| |s_y q_y|. Candidates whose upper bound reaches the k-th best lower bound survive in the cell, and
only those are recomputed from the original floats in double precision. Cells' lists are merged by heaps.

That makes the search exact: quantisation only decides what is recomputed.
"""

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import durable

#: Vectors of a cell's two blocks.
QUERY_BLOCK, CANDIDATE_BLOCK = 8192, 16384
#: Rows of a tile within a cell.
TILE = 256
#: Dimensions whose products of codes add up exactly in float32.
EXACT = 1024
FOUND = "query_id long, vec_id long, score double"


def valid_vector(v: Column) -> Column:
    """Whether a vector takes part: not null, not empty, all components finite, not all zero."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales, norms of the vectors and of their errors. Norms are of the vectors over their largest component
    and then scaled back, so that neither tiny nor huge components leave the range of doubles on the way."""
    most = np.abs(x).max(1)
    scale = np.maximum(most / 127, np.finfo(np.float64).tiny)
    codes = np.rint(x / scale[:, None])
    unit = x / most[:, None]
    off = unit - codes * (scale / most)[:, None]
    return codes.astype(np.int8), scale, most * np.sqrt((unit * unit).sum(1)), most * np.sqrt((off * off).sum(1))


def code_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows of codes. Each run of EXACT dimensions gives whole numbers below 2**24, exact in float32."""
    out = 0.0
    for i in range(0, a.shape[1], EXACT):
        out = out + (a[:, i : i + EXACT] @ b[:, i : i + EXACT].T).astype(np.float64)
    return out


def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of rows in double precision, added in order of the components."""
    out = np.zeros(len(x))
    for i in range(x.shape[1]):
        out += x[:, i] * y[:, i]
    return out


def search(qid: np.ndarray, q: np.ndarray, cid: np.ndarray, c: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate, score): the k best of each query among the candidates, its own id left out, ties by id."""
    codes_q, scale_q, norm_q, err_q = quantise(q)
    codes_c, scale_c, norm_c, err_c = quantise(c)
    codes_q, codes_c = codes_q.astype(np.float32), codes_c.astype(np.float32)  # for the matrix product
    rough_norm = norm_c + err_c  # at least the norm of the quantised vector
    out = []
    for t in range(0, len(q), TILE):
        rows = slice(t, t + TILE)
        tile = code_products(codes_q[rows], codes_c) * scale_q[rows, None] * scale_c
        slack = norm_q[rows, None] * err_c + err_q[rows, None] * rough_norm
        slack = slack * (1 + 1e-6) + np.abs(tile) * 1e-6 + np.finfo(np.float64).tiny
        own = qid[rows, None] == cid
        low = np.where(own, -np.inf, tile - slack)
        kth = np.full(len(low), -np.inf) if len(cid) <= k else np.partition(low, -k, 1)[:, -k]
        i, j = np.nonzero((tile + slack >= kth[:, None]) & ~own)
        score = products(q[rows][i], c[j])
        order = np.lexsort((cid[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        place = np.arange(len(i)) - np.searchsorted(i, i)
        keep = place < k
        out.append((qid[rows][i[keep]], cid[j[keep]], score[keep]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (cid[:0], cid[:0], np.zeros(0))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def _cell(k: int):
    def run(group: pa.Table) -> pa.Table:
        asks = group.column("asks").to_numpy()
        ids, x = group.column("id").to_numpy(), _matrix(group.column("vector"))
        found = search(ids[asks], x[asks], ids[~asks], x[~asks], k) if asks.any() and not asks.all() else (ids[:0], ids[:0], np.zeros(0))
        return pa.table(dict(zip(("query_id", "vec_id", "score"), found, strict=True)))

    return run


def _merge(k: int):
    """The k best of each query over the lists of all cells, given in order of queries: one heap at a time."""

    def run(batches):
        heap: list[tuple[float, int]] = []
        query = None

        def closed():
            return [(query, r + 1, -v, s) for r, (s, v) in enumerate(sorted(heap, reverse=True))]

        for batch in batches:
            rows = []
            for q, v, s in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if q != query:
                    rows += closed()
                    heap, query = [], q
                item = (s, -v)
                if len(heap) < k:
                    heapq.heappush(heap, item)
                elif item > heap[0]:
                    heapq.heapreplace(heap, item)
            yield _ranked(rows)
        yield _ranked(closed())

    return run


def _ranked(rows: list[tuple[int, int, int, float]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
    types = (pa.int64(), pa.int32(), pa.int64(), pa.float64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["query_id", "rank", "vec_id", "score"])


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the k candidates with the largest inner product for each query.

    vectors and queries: (vec_id, embedding), embeddings of one dimension. Rows with a query's id are its own and no
    candidates; all others are, also where several share an id. Of queries that share an id, the one of the greatest
    vector asks. Vectors that are null, zero, or hold null or non-finite components take no part, nor do rows with a null
    id. Fewer candidates than k give as many rows. Other columns are not read.
    """

    def clean(df: DataFrame) -> DataFrame:
        v = df.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("vector"))
        return v.filter(F.col("id").isNotNull() & valid_vector(F.col("vector")))

    numbered = lambda df: durable(df.withColumn("number", F.monotonically_increasing_id()))
    candidates = numbered(clean(vectors))
    asked = numbered(clean(queries).groupBy("id").agg(F.max("vector").alias("vector")))
    down = max(1, -(-asked.count() // QUERY_BLOCK))
    across = max(1, -(-candidates.count() // CANDIDATE_BLOCK))

    def dealt(df: DataFrame, asks: bool) -> DataFrame:
        """Rows sent to the cells of their block's line of the grid."""
        own = F.pmod(F.xxhash64("number"), F.lit(down if asks else across))
        line = F.explode(F.sequence(F.lit(0), F.lit((across if asks else down) - 1)))
        cells = df.withColumn("own", own).withColumn("line", line)
        cell = (F.col("own") * across + F.col("line")) if asks else (F.col("line") * across + F.col("own"))
        return cells.select(cell.alias("cell"), F.lit(asks).alias("asks"), "id", "vector")

    grid = dealt(asked, True).unionByName(dealt(candidates, False))
    found = grid.groupBy("cell").applyInArrow(_cell(k), FOUND)
    merged = found.repartition("query_id").sortWithinPartitions("query_id").mapInArrow(_merge(k), "query_id long, rank int, vec_id long, score double")
    return merged


def nearest_sql(k: int, every: int) -> str:
    return f"""
    WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    q AS (SELECT vec_id, max(e) AS e FROM v WHERE vec_id % {every} = 0 GROUP BY vec_id),
    p AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score FROM q JOIN v c ON q.vec_id <> c.vec_id),
    r AS (SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank FROM p)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {k}"""
