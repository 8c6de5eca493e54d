"""Near-duplicate documents by circulant MinHash, with every link confirmed on the full shingle sets.

Signatures: a first permutation scatters the shingles over SLOTS places; the second, shifted circularly by 0 to
COORDINATES - 1, gives all coordinates. Shifted copies of one permutation lie side by side in its table, so a shingle's
values for all coordinates are one slice of it.

Documents with equal shingle sets form a class and are handled as one. Classes that share a band of their signatures
are candidates. No bucket is expanded into all its pairs: every class is paired with its bucket's leaders only, the least
and the greatest. Links that the full sets confirm merge components. What is left are buckets with classes of several
components; there, classes outside the first leader's component are compared with the rest, and the pairs that may be
similar are confirmed too. For that, a bucket is cut by the sizes of sets, as only those of similar sizes can be links, and
then into blocks: a task compares two blocks, whatever the size of the bucket. So no two classes that share a bucket are
left uncompared but those that are known to be in one component, or differ too much in size.

Before texts are fetched, a pair must pass two filters: its signatures agree often enough, and a bitmap of either set
doesn't rule the similarity out (a bit that only one side has set is an element that the other lacks).
"""

import functools
import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import WORD, beside, durable, mixed, offsets, row_key, run_hashes, text_batches

#: Bands and rows: a pair of similarity 0.8 misses all bands with probability (1 - 0.8**4)**28 < 4e-7.
BANDS, ROWS = 28, 4
COORDINATES = BANDS * ROWS
SLOTS = 1 << 20
#: Pairs whose signatures agree in less than this share are no candidates: at 0.8 that is 4.7 standard deviations off.
MAYBE = 0.62
#: Classes of a block; a task compares two blocks of a bucket.
BLOCK = 2000
#: Bits of the bitmap of a set.
BITS = 4096
#: Bytes of a sketch: the low 16 bits of each coordinate, then the bitmap.
SKETCH = 2 * COORDINATES + BITS // 8


@functools.cache
def _inside() -> np.ndarray:
    table = np.ones(256, bool)
    table[[32, *range(9, 14)]] = False
    return table


@functools.cache
def _circulant() -> np.ndarray:
    """Row i holds the second permutation at i, i + 1, ... as all coordinates of slot i."""
    table = np.random.default_rng(20240607).permutation(SLOTS).astype(np.uint32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([table, table[:COORDINATES]]), COORDINATES)


def shingles(text: np.ndarray, at: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of texts in order, repeats included, and how many each text has.

    A text with fewer words has its whole sequence as one shingle; one without words has none.
    """
    h, per_text = run_hashes(text, at, _inside())
    first = np.cumsum(per_text) - per_text
    many = np.maximum(per_text - words + 1, 0)
    starts = np.flatnonzero(np.arange(len(h)) < np.repeat(first + many, per_text))
    out = np.zeros(len(starts), np.uint64)
    for i in range(words):
        out = mixed(out + h[starts + i] + np.uint64(words))
    few = np.flatnonzero((per_text > 0) & (per_text < words))
    if not len(few):
        return out, many
    whole = []
    for i in few:
        one = np.uint64(1)
        for w in h[first[i] : first[i] + per_text[i]]:
            one = mixed(np.array([one + w]) * np.uint64(3))[0]
        whole.append(one)
    return np.insert(out, np.cumsum(many)[few] - many[few], whole), many + np.isin(np.arange(len(many)), few)


def signature(members: np.ndarray) -> np.ndarray:
    """Coordinates of a set of hashes."""
    slot = (mixed(members + np.uint64(77)) & np.uint64(SLOTS - 1)).astype(np.int64)
    table = _circulant()
    out = np.full(COORDINATES, SLOTS, np.uint32)
    for i in range(0, len(slot), 1024):
        np.minimum(out, table[slot[i : i + 1024]].min(0), out=out)
    return out


def sketch(members: np.ndarray) -> bytes:
    bits = np.zeros(BITS, bool)
    bits[(members & np.uint64(BITS - 1)).astype(np.int64)] = True
    return signature(members).astype("<u2").tobytes() + np.packbits(bits).tobytes()


def _sketches(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates and bitmaps (as 64-bit words) of a column of sketches."""
    raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, SKETCH)
    cut = 2 * COORDINATES
    return np.ascontiguousarray(raw[:, :cut]).view("<u2"), np.ascontiguousarray(raw[:, cut:]).view(np.uint64)


def may_link(sign_a, bits_a, n_a, sign_b, bits_b, n_b, percent: int) -> np.ndarray:
    """Which pairs of sketches can be links. Only MAYBE can err, and then by its bound."""
    only_a = np.bitwise_count(bits_a & ~bits_b).sum(1, dtype=np.int64)
    only_b = np.bitwise_count(bits_b & ~bits_a).sum(1, dtype=np.int64)
    both = np.minimum(n_a - only_a, n_b - only_b)
    return (100 * both >= percent * (n_a + n_b - both)) & ((sign_a == sign_b).mean(1) >= MAYBE)


def _sign(words: int, keep: list[str]):
    names = [*keep, "n", "class", "sketch"]

    def run(batches):
        for batch in batches:
            for part, text, at in text_batches(batch, "__text"):
                all_, counts = shingles(text, at, words)
                cut = np.concatenate([[0], np.cumsum(counts)])
                n, classes, sketches = [], [], []
                for a, b in zip(cut[:-1], cut[1:], strict=True):
                    members = np.unique(all_[a:b])
                    n.append(len(members))
                    classes.append(hashlib.blake2b(members.tobytes(), digest_size=16).digest())
                    sketches.append(sketch(members) if len(members) else b"")
                made = [pa.array(n, pa.int64()), pa.array(classes, pa.binary()), pa.array(sketches, pa.binary())]
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(keep))), *made], names=names)

    return run


def _bands(batches):
    """(node, n, bucket) for each band of a class."""
    for batch in batches:
        signs = _sketches(batch.column(2))[0].reshape(-1, BANDS, ROWS).astype(np.uint64)
        h = np.tile(np.arange(BANDS, dtype=np.uint64), (len(signs), 1))
        for i in range(ROWS):
            h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + signs[:, :, i])
        node, n = (np.repeat(batch.column(i).to_numpy(zero_copy_only=False), BANDS) for i in (0, 1))
        yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(n), pa.array(h.ravel().view(np.int64))], names=["node", "n", "bucket"])


def similar_enough(n_a: Column, n_b: Column, percent: int) -> Column:
    """Whether sets of these sizes can reach the similarity at all."""
    return 100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)


def _likely(percent: int):
    """The pairs (a, b, n_a, n_b, sketch_a, sketch_b) that may be links."""

    def run(batches):
        for batch in batches:
            n_a, n_b = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
            (sign_a, bits_a), (sign_b, bits_b) = (_sketches(batch.column(i)) for i in (4, 5))
            yield batch.select([0, 1]).filter(pa.array(may_link(sign_a, bits_a, n_a, sign_b, bits_b, n_b, percent)))

    return run


def _verify(words: int, percent: int):
    """Pairs (a, b) whose texts' sets reach the similarity."""

    def sets(text, at):
        all_, counts = shingles(text, at, words)
        cut = np.concatenate([[0], np.cumsum(counts)])
        return [all_[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]

    def run(batches):
        for batch in batches:
            for part, text, at in text_batches(batch, "text_a"):
                other = part.column(3)
                o = offsets(other)
                left = sets(text, at)
                right = sets(np.frombuffer(b"".join(x.encode() for x in other.to_pylist()), np.uint8), o - o[0])
                keep = []
                for x, y in zip(left, right, strict=True):
                    x, y = np.unique(x), np.unique(y)
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * both >= percent * (len(x) + len(y) - both))
                yield part.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return run


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, component) for the nodes of edges (a, b): component is the least node that can be reached.

    Alternates large-star and small-star steps until nothing changes; each step is a shuffle of the edges, whose number
    does not grow. Steps are stored, so that a lost executor costs one step.
    """
    e = durable(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    before = None
    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.filter("u > v")
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        e = durable(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % (1 << 40))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _across(percent: int):
    """Pairs that may be links of two blocks of a stratum of a bucket, at least one of each pair being outside the leader's
    component. Rows come sorted by (bucket, stratum, cell); a cell is a pair of blocks, and one of a block with itself."""

    def pairs(group: pa.Table):
        cell, outside, above, own = (group.column(c).to_numpy() for c in ("cell", "outside", "above", "own"))
        alone = cell[0] >> 32 == cell[0] & 0xFFFFFFFF
        sign, bits = _sketches(group.column("sketch"))
        node, comp, n = (group.column(c).to_numpy() for c in ("node", "component", "n"))
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i in np.flatnonzero(outside):
            other = (comp != comp[i]) & (~outside | (node > node[i])) & ~(above & above[i])
            j = np.flatnonzero(other if alone else other & (own != own[i]))
            j = j[100 * np.minimum(n[j], n[i]) >= percent * np.maximum(n[j], n[i])]
            j = j[may_link(sign[i : i + 1], bits[i : i + 1], n[i], sign[j], bits[j], n[j], percent)]
            a.append(np.minimum(node[i], node[j]))
            b.append(np.maximum(node[i], node[j]))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (a, b)], names=["a", "b"])

    def run(batches):
        held = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = t if held is None else pa.concat_tables([held, t])
            key = np.stack([t.column(c).to_numpy() for c in ("bucket", "stratum", "cell")])
            cut = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1
            for lo, hi in zip([0, *cut[:-1]], cut, strict=True) if len(cut) else ():
                yield pairs(t.slice(lo, hi - lo))
            held = t.slice(cut[-1] if len(cut) else 0)
        if held is not None and len(held):
            yield pairs(held)

    return run


class _Corpus:
    """Classes of a corpus, the buckets they share, and what confirms links between them."""

    def __init__(self, docs: DataFrame, signed: DataFrame, words: int, percent: int):
        self.docs, self.words, self.percent = docs, words, percent
        by_class = signed.filter("n > 0 and doc_id is not null").groupBy("class").agg(
            F.min(F.struct("doc_id", "key")).alias("first"), F.max("n").alias("n"), F.max("sketch").alias("sketch")
        )
        self.classes = durable(by_class.select("class", F.xxhash64("class").alias("node"), "first.*", "n", "sketch"))
        rows = self.classes.select("node", "n", "sketch").mapInArrow(_bands, "node long, n long, bucket long")
        member = F.struct("node", "n")
        leaders = rows.groupBy("bucket").agg(F.min(member).alias("least"), F.max(member).alias("greatest"))
        shared = rows.join(leaders.filter("least.node <> greatest.node"), "bucket")
        self.buckets = durable(shared)

    def leader_pairs(self) -> DataFrame:
        """Distinct pairs of classes with the leaders of their buckets."""
        b = self.buckets.select("node", "n", F.explode(F.array("least", "greatest")).alias("other"))
        b = b.filter((F.col("node") != F.col("other.node")) & similar_enough(F.col("n"), F.col("other.n"), self.percent))
        return b.select(F.least("node", "other.node").alias("a"), F.greatest("node", "other.node").alias("b")).distinct()

    def likely(self, pairs: DataFrame) -> DataFrame:
        a, b = (self.classes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}")) for x in "ab")
        met = pairs.join(a, "a").join(b, "b").select("a", "b", "n_a", "n_b", "s_a", "s_b")
        return met.mapInArrow(_likely(self.percent), "a long, b long")

    def residual_pairs(self, parts: DataFrame) -> DataFrame:
        """Pairs that may be links between classes of different components that share a bucket.

        Strata are of sizes of sets within percent of each other. A stratum meets itself and the one above it, so a class
        is in its own group, and above in that of the stratum below.
        """
        part = parts.select("node", "component")
        lead = part.select(F.col("node").alias("leader"), F.col("component").alias("lead"))
        b = self.buckets.select("bucket", "node", "n", F.col("least.node").alias("leader")).join(part, "node", "left")
        b = b.join(lead, "leader", "left").withColumn("component", F.coalesce("component", "node"))
        b = b.withColumn("outside", F.col("component") != F.coalesce("lead", "leader"))
        stratum = F.floor(F.log(F.col("n").cast("double")) / F.lit(-math.log(percent_share(self.percent)))).cast("int")
        roles = F.explode(F.array(*(F.struct((stratum - k).alias("stratum"), F.lit(k == 1).alias("above")) for k in (0, 1))))
        b = b.withColumn("role", roles).select("bucket", "role.*", "node", "component", "outside")
        sizes = b.groupBy("bucket", "stratum").agg(
            F.count(F.lit(1)).alias("size"), F.count_if("outside").alias("n_outside"), F.count_if(~F.col("above")).alias("n_own")
        )
        b = b.join(sizes.filter("size > 1 and n_outside > 0 and n_own > 0"), ["bucket", "stratum"])
        blocks = F.ceil(F.col("size") / BLOCK).cast("long")
        b = b.withColumn("own", F.pmod(F.xxhash64("node"), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
        cell = F.shiftleft(F.least("own", "other"), 32).bitwiseOR(F.greatest("own", "other"))
        b = b.withColumn("cell", cell).join(self.classes.select("node", "n", "sketch"), "node")
        b = b.select("bucket", "stratum", "cell", "own", "above", "outside", "component", "node", "n", "sketch")
        b = b.repartition("bucket", "stratum", "cell").sortWithinPartitions("bucket", "stratum", "cell")
        return b.mapInArrow(_across(self.percent), "a long, b long").distinct()

    def confirm(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that are links. Each needed text is fetched once, then sent to its pairs; the others stay where
        they are if the needed keys are few enough to be broadcast."""
        pairs = durable(pairs)
        ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        needed = durable(self.classes.select("node", "key").join(ends, "node", "left_semi"))
        keyed = self.docs.select(row_key(F.col("doc_id"), F.col("text")).alias("key"), "text")
        texts = keyed.join(beside(needed), "key").select("node", "text").dropDuplicates(["node"])
        a, b = (texts.select(F.col("node").alias(x), F.col("text").alias(f"text_{x}")) for x in "ab")
        met = pairs.join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b")
        return durable(met.mapInArrow(_verify(self.words, self.percent), "a long, b long"))


def percent_share(percent: int) -> float:
    """The share below which sizes of sets belong to different strata; all are in one for small percentages."""
    return min(max(percent, 1), 99) / 100 * (1 - 1e-9)


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, key, n_shingles, component_id and kept for each row of docs (doc_id, text).

    Documents are linked if percent of the union of their sets of words-shingles is shared; component_id is the least id
    that links reach. Null, empty and blank texts have no shingles and are linked with nothing. Rows that repeat an id
    are one document if their sets agree, else each is linked for itself. A row with a null id is linked with nothing,
    has a null component and is kept. Other columns of docs are not read. An empty table gives an empty table.
    """
    key = row_key(F.col("doc_id"), F.col("text")).alias("key")
    rows = docs.select("doc_id", key, F.col("text").alias("__text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    signed = rows.mapInArrow(_sign(words, ["doc_id", "key"]), f"doc_id {kind}, key long, n long, class binary, sketch binary")
    signed = durable(signed)
    corpus = _Corpus(docs, signed, words, percent)
    links = corpus.confirm(corpus.likely(corpus.leader_pairs()))
    parts = components(links)
    more = corpus.confirm(corpus.residual_pairs(parts))
    edges = more.unionByName(parts.select(F.col("node").alias("a"), F.col("component").alias("b")))
    parts = components(edges)
    named = corpus.classes.select("class", "node", "doc_id").join(parts, "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    by_class = named.join(least, "component").select("class", "component_id")
    linked = signed.filter("n > 0 and doc_id is not null").select("doc_id", "key", "n", "class").join(by_class, "class")
    alone = signed.filter("n = 0 or doc_id is null").select("doc_id", "key", "n", F.col("doc_id").alias("component_id"))
    out = linked.select("doc_id", "key", "n", "component_id").unionByName(alone)
    return out.select(
        "doc_id",
        "key",
        F.col("n").alias("n_shingles"),
        "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """docs with one document of each component, the one of the least id; same columns.

    Rows that repeat an id with its text are one document, also without words or id: the one of the greatest hash over all
    columns stays. Only such rows are shuffled with their texts.
    """
    found = near_duplicates(docs, words, percent).groupBy("key").agg(F.min(F.coalesce("kept", F.lit(True))).alias("kept"), F.count(F.lit(1)).alias("n"))
    marked = durable(found.filter(~F.col("kept") | (F.col("n") > 1)).withColumnRenamed("key", "__key"))
    keyed = docs.withColumn("__key", row_key(F.col("doc_id"), F.col("text")))
    once = keyed.join(beside(marked.select("__key")), "__key", "left_anti").select(*docs.columns)
    repeated = marked.filter("kept").select("__key")
    if not repeated.limit(1).count():
        return once
    rows = keyed.join(beside(repeated), "__key", "left_semi").withColumn("__row", F.xxhash64(*docs.columns))
    first = rows.groupBy("__key").agg(F.max("__row").alias("__row")).hint("shuffle_hash")
    return once.unionByName(rows.join(first, ["__key", "__row"], "left_semi").dropDuplicates(["__key"]).select(*docs.columns))


def near_duplicates_sql(words: int, percent: int, documents: str = "documents") -> str:
    """doc_id, n_shingles, component_id and kept as DuckDB SQL, by joining all shingles."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    split = f"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '{WORD}')"
    return f"""
    WITH RECURSIVE w AS MATERIALIZED (SELECT doc_id, {split} AS w FROM {documents}),
    s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i:i + {words - 1}], ' ') AS s
          FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {words - 1}, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
    n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    shared AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (s) WHERE a.doc_id < b.doc_id GROUP BY ALL),
    e AS MATERIALIZED (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
          WHERE 100 * c >= {percent} * (x.n + y.n - c)),
    both_ways AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
    reach AS (SELECT doc_id AS node, doc_id AS root FROM w UNION SELECT b, root FROM reach JOIN both_ways ON node = a)
    SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, min(root) AS component_id, w.doc_id = min(root) AS kept
    FROM w JOIN reach ON node = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id GROUP BY w.doc_id, n.n"""
