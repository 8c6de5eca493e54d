"""Exact removal of long repeated passages, by suffix arrays in a logarithmic index family.

A text's suffixes of interest are its windows of LENGTH bytes. They are too many to shuffle, so they travel in bundles:
every window contains a k-mer of least hash, its anchor, and a run of windows with one anchor is stored as one slice of
text. Equal windows have equal anchors at equal places, so only bundles of one anchor can share a window:

1. Anchors are counted. Those met once drop out; that is most of them. The bundles of the others are dealt by anchor as
   short rows (hashes and places), equal ones that a task meets close together in one row; a broadcast filter of bounded
   size keeps most of the rest from being dealt. Bundles with equal content, as whole copies and the inside of shared
   passages give, repeat in full.
2. The others fetch their slices of text, one of each content, and meet by anchor in index shards. A shard takes them
   in batches of BATCH windows. A batch gets a suffix array, its windows in order of all their bytes, and is merge-scanned
   against the levels of the shard's index for windows that match over the whole LENGTH. What is new becomes a level, and
   levels of about equal size merge, so that each window is merged a logarithmic number of times.
3. Repeated windows are joined to their documents and their union is cut out.

Order and matches are by bytes: within a batch by doubling ranks, between levels by binary search. An index keeps one of
equal windows, so a shard's memory grows with its different windows only. Anchors with many bundles, such as a line that
countless documents share, are split over shards by the place of the anchor in the window and by the bytes that all
windows of those places have: equal windows agree in both.

RepeatIndex keeps the family of all bundles in a folder, for batches of documents that come later: its levels are tables that
a new batch meets by anchor, and tables of about equal size are merged into one.
"""

import functools
import hashlib
import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm.common import BASE, UNBASE, delete, durable, key_filter, mixed, passes, powers, ranges, row_key, text_batches

LENGTH = 200
#: Bytes of an anchor k-mer, and k-mers in a window.
KMER = 40
SPREAD = LENGTH - KMER + 1
#: Bytes of text handled at once.
SLICE = 1 << 19
#: Texts whose anchors are found at once when they are counted.
SLICE_ROWS = 128
#: Bundles of one anchor from which it is split, and anchor places in a part.
HOT, PLACES = 1000, 16
#: Bundles among which a task joins equal ones before the shuffle.
GROUPED = 1 << 17
#: Windows of a batch of an index shard, and windows whose bytes are compared at once.
BATCH, COMPARED = 1 << 16, 1 << 14


@functools.cache
def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    return powers(n, BASE), powers(n, UNBASE)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and its inverse for n bytes and more; sizes are rounded up so that tables are reused."""
    return _power_tables(1 << max(16, int(n).bit_length()))


def _sums(text: np.ndarray) -> np.ndarray:
    """Prefix sums of the polynomial hash."""
    out = np.zeros(len(text) + 1, np.uint64)
    np.cumsum((text + np.uint64(1)) * _tables(len(text))[0][: len(text)], out=out[1:], dtype=np.uint64)
    return out


def _hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mixed((sums[end] - sums[start]) * _tables(len(sums))[1][start])


def _least_in_window(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of width values, by prefix and suffix minima of blocks of that width."""
    n = len(x) - width + 1
    full = np.full(-(-len(x) // width) * width, np.iinfo(x.dtype).max, x.dtype)
    full[: len(x)] = x
    blocks = full.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, 1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(back[:n], forward[width - 1 : width - 1 + n])


def bundles(text: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text number, start in it, windows, place of the anchor in the first window, anchor hash, content hash)."""
    n = len(text) - LENGTH + 1
    if n <= 0:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64, np.uint64))
    sums = _sums(text)
    kmer = mixed((sums[KMER:] - sums[:-KMER]) * _tables(len(sums))[1][: len(text) - KMER + 1])
    low = np.uint64(0xFFFFFFFF)
    order = (kmer & ~low) | np.arange(len(kmer), dtype=np.uint64)  # leftmost of equal hashes
    anchor = _least_in_window(order, SPREAD) & low
    valid = np.zeros(n + 1, np.int32)  # windows that cross no border
    size = np.diff(at)
    long = size >= LENGTH
    np.add.at(valid, at[:-1][long], 1)
    np.add.at(valid, (at[1:] - LENGTH + 1)[long], -1)
    valid = np.cumsum(valid)[:n] > 0
    new = valid.copy()
    new[1:] &= (anchor[1:] != anchor[:-1]) | ~valid[:-1]
    new[at[:-1][long]] = True
    start = np.flatnonzero(new)
    count = np.diff(np.append(np.cumsum(valid)[start] - 1, valid.sum()))
    a = anchor[start].astype(np.int64)
    number = np.searchsorted(at, start, "right") - 1
    return number, start - at[number], count, a - start, kmer[a], _hash(sums, start, start + count - 1 + LENGTH)


ANCHORED = "anchor long, content long, key long, start int, n int, place int, others array<struct<key:long,start:int>>"


def _grouped(found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    """Bundles (anchor, content, key, start, n, place), those of equal content as one row with the others' places."""
    anchor, content, key, start, count, place = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((start, key, content, anchor))
    anchor, content, key, start = anchor[order], content[order], key[order], start[order].astype(np.int32)
    lead = np.ones(len(order), bool)
    lead[1:] = (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1])
    first = np.flatnonzero(lead)
    more = np.diff(np.append(first, len(order))) - 1
    places = pa.StructArray.from_arrays([pa.array(key[~lead]), pa.array(start[~lead])], names=["key", "start"])
    at = pa.array(np.concatenate([[0], np.cumsum(more)]).astype(np.int32))
    others = pa.ListArray.from_arrays(at, places, mask=pa.array(more == 0))
    small = [count[order][first].astype(np.int32), place[order][first].astype(np.int32)]
    arrays = [pa.array(x) for x in (anchor[first], content[first], key[first], start[first], *small)]
    return pa.RecordBatch.from_arrays([*arrays, others], names=["anchor", "content", "key", "start", "n", "place", "others"])


def _anchor_counts(batches):
    """(anchor, times): how often the texts (key, __text) of a slice meet each anchor."""
    for batch in batches:
        for _, text, at in text_batches(batch, "__text", 8 * SLICE):
            found = []
            for i in range(0, len(at) - 1, SLICE_ROWS):
                some = at[i : i + SLICE_ROWS + 1]
                found.append(bundles(text[some[0] : some[-1]], some - some[0])[4])
            anchor, times = np.unique(np.concatenate(found).view(np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(times)], names=["anchor", "times"])


def _anchors(shared=None):
    """The bundles of (key, __text), those that pass the filter of anchors if there is one. A line that fills a text, and
    copies, reach the shuffle once for GROUPED bundles."""

    def run(batches):
        found, held = [], 0
        for batch in batches:
            for part, text, at in text_batches(batch, "__text", SLICE):
                number, start, count, place, anchor, content = bundles(text, at)
                key = part.column(0).to_numpy(zero_copy_only=False)[number]
                rows = (anchor.view(np.int64), content.view(np.int64), key, start, count, place)
                if shared is not None:
                    kept = passes(shared.value, rows[0])
                    rows = tuple(x[kept] for x in rows)
                found.append(rows)
                held += len(rows[0])
                if held >= GROUPED:
                    yield _grouped(found)
                    found, held = [], 0
        if held:
            yield _grouped(found)

    return run


def _packed(batches):
    """(key, packed): texts compressed for the shuffle."""
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        for part, text, at in text_batches(batch, "__text"):
            raw = text.tobytes()
            packed = [pack(raw[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(packed, pa.binary())], names=[*part.schema.names[:-1], "packed"])


BUNDLE = "key long, start int, n int, anchor long, part long, known boolean, slice binary"


def _slices(batches):
    """The slices of text of the bundles listed for each document; hot anchors in parts, by place and what all windows of
    these places have in common. Rows that repeat, all of one key, give their slices once a task: their windows are known to
    repeat, and what is looked for is who else has them."""
    unpack = zstandard.ZstdDecompressor().decompress
    seen = set()
    for batch in batches:
        for i in range(len(batch)):
            key = batch.column(0)[i].as_py()
            if key in seen:
                continue
            seen.add(key)
            raw = unpack(batch.column(1)[i].as_py())
            out = []
            for b in batch.column(2)[i].as_py():
                start, n, place = b["start"], b["n"], b["place"]
                done = 0
                while done < n:
                    # windows of one part have places of one range; places fall as windows move on
                    size, part = n, -1
                    if b["hot"]:
                        block = (place - done) // PLACES
                        size = min(n - done, (place - done) % PLACES + 1)
                        first = start + place - block * PLACES  # of the bytes that windows of all the places have
                        core = raw[first : first + LENGTH - PLACES + 1]
                        part = int.from_bytes(hashlib.blake2b(core, digest_size=7, salt=block.to_bytes(2)).digest())
                    s = start + done
                    out.append((key, s, size, b["anchor"], part, b["known"], raw[s : s + size - 1 + LENGTH]))
                    done += size
            columns = zip(*out, strict=True)
            types = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
            names = ("key", "start", "n", "anchor", "part", "known", "slice")
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=list(names))


def heads(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes at each place, most significant first."""
    wide = np.lib.stride_tricks.sliding_window_view(text, 8)
    return np.ascontiguousarray(wide[at]).view(">u8").ravel().astype(np.uint64)


def window_ranks(text: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Ranks of the windows at start by all their bytes, equal ones equal: ranks by 8 bytes are doubled to 16 and so on."""
    rank = np.unique(heads(text, np.arange(len(text) - 7)), return_inverse=True)[1]
    width = 8
    while width < LENGTH:
        # what two runs of width bytes cover, overlapping in the last round; runs beyond the text are in no window
        step = min(width, LENGTH - width)
        n = len(rank) - step
        rank = np.unique(rank[:n].astype(np.int64) << 32 | rank[step : step + n], return_inverse=True)[1]
        width += step
    return rank[start]


class SuffixArray:
    """Different windows in order of their bytes: text, where they start in it, their first eight bytes, and what owner
    (key, begin, known) each has; shown says which were already reported."""

    def __init__(self, text: np.ndarray, start: np.ndarray, head: np.ndarray, owner: np.ndarray, shown: np.ndarray):
        self.text, self.start, self.head, self.owner, self.shown = text, start, head, owner, shown

    def __len__(self) -> int:
        return len(self.start)

    def windows(self, which: np.ndarray) -> np.ndarray:
        """The bytes of windows, a row for each."""
        return np.lib.stride_tricks.sliding_window_view(self.text, LENGTH)[self.start[which]]

    def locate(self, other: "SuffixArray") -> tuple[np.ndarray, np.ndarray]:
        """Where each window of other belongs among these, and whether the one there is equal to it."""
        low = np.searchsorted(self.head, other.head, "left")
        high = np.searchsorted(self.head, other.head, "right")
        same = np.zeros(len(other), bool)
        asked = np.flatnonzero(low < high)
        for i in range(0, len(asked), COMPARED):
            some = asked[i : i + COMPARED]
            mine = other.windows(some)
            live = np.arange(len(some))
            while len(live):  # binary search among those of the same head
                at = some[live]
                middle = (low[at] + high[at]) // 2
                theirs = self.windows(middle)
                differs = theirs != mine[live]
                first = differs.argmax(1)
                rows = np.arange(len(live))
                equal = ~differs[rows, first]
                less = ~equal & (theirs[rows, first] < mine[live][rows, first])
                low[at[less]] = middle[less] + 1
                high[at[~less]] = middle[~less]
                same[at[equal]] = True
                low[at[equal]] = middle[equal]
                live = live[~equal & (low[at] < high[at])]
        return low, same

    def merged(self, other: "SuffixArray") -> "SuffixArray":
        """Both in one, no window of other being among these: each keeps its order, and other's go where they belong."""
        place = self.locate(other)[0] + np.arange(len(other))
        mine = np.ones(len(self) + len(other), bool)
        mine[place] = False

        def both(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            out = np.empty((len(mine), *a.shape[1:]), a.dtype)
            out[mine], out[~mine] = a, b
            return out

        return SuffixArray(
            np.concatenate([self.text, other.text]),
            both(self.start, other.start + len(self.text)),
            *(both(getattr(self, f), getattr(other, f)) for f in ("head", "owner", "shown")),
        )


class IndexFamily:
    """Suffix arrays in levels; a new batch meets every level, and levels of about equal size merge."""

    def __init__(self):
        self.levels: list[SuffixArray] = []

    def insert(self, text: np.ndarray, start: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Owners (key, begin, known) of the windows, of this batch and earlier ones, that are now known to repeat."""
        rank = window_ranks(text, start)
        order = np.argsort(rank, kind="stable")
        rank = rank[order]
        lead = np.ones(len(order), bool)
        lead[1:] = rank[1:] != rank[:-1]
        group = np.cumsum(lead) - 1
        repeats = np.diff(np.append(np.flatnonzero(lead), len(order))) > 1
        one = order[lead]
        new = SuffixArray(text, start[one], heads(text, start[one]), owner[one], np.ones(len(one), bool))
        found, fresh = [], np.ones(len(one), bool)
        for level in self.levels:  # from large to small
            place, same = level.locate(new)
            old = place[same]
            found.append(level.owner[old[~level.shown[old]]])
            level.shown[old] = True
            fresh &= ~same
        repeats |= ~fresh
        found.append(owner[order[repeats[group]]])
        new.shown = repeats
        if fresh.any():
            new.start, new.head, new.owner, new.shown = (x[fresh] for x in (new.start, new.head, new.owner, new.shown))
            self.levels.append(new)
        while len(self.levels) > 1 and len(self.levels[-2]) <= 2 * len(self.levels[-1]):
            small, large = self.levels.pop(), self.levels.pop()
            self.levels.append(large.merged(small))
        return np.concatenate(found)


def _shard(batches):
    """(key, begin, end) of the repeated windows of the bundles of an index shard, as spans of bytes."""
    family = IndexFamily()
    held: list[tuple[bytes, int, int, int, bool]] = []
    n_held = 0

    def take() -> pa.RecordBatch:
        text = np.frombuffer(b"".join(h[0] for h in held), np.uint8)
        key, begin, n, known = (np.array(x) for x in list(zip(*held, strict=True))[1:])
        at = np.cumsum([0, *(len(h[0]) for h in held[:-1])])
        start = ranges(at, n)
        owner = np.stack([np.repeat(key, n), ranges(begin, n), np.repeat(known, n)], 1).astype(np.int64)
        owner = family.insert(text, start, owner)
        owner = owner[owner[:, 2] == 0]
        owner = owner[np.lexsort((owner[:, 1], owner[:, 0]))]
        first = np.ones(len(owner), bool)  # windows that lie one after the other make one span
        first[1:] = (owner[1:, 0] != owner[:-1, 0]) | (owner[1:, 1] > owner[:-1, 1] + 1)
        s = np.flatnonzero(first)
        last = np.append(s[1:], len(owner))[: len(s)] - 1
        spans = [pa.array(owner[s, 0]), pa.array(owner[s, 1]), pa.array(owner[last, 1] + LENGTH)]
        return pa.RecordBatch.from_arrays(spans, names=["key", "begin", "end"])

    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("slice", "key", "start", "n", "known")]
        for row in zip(*columns, strict=True):
            held.append(row)
            n_held += row[3]
            if n_held >= BATCH:
                yield take()
                held, n_held = [], 0
    if held:
        yield take()


def merged_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by spans; spans that touch are one run."""
    out: list[list[int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return [(b, e) for b, e in out]


def _as_text(docs: DataFrame) -> DataFrame:
    return docs.select("key", F.coalesce("text", F.lit("")).alias("__text"))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(key, spans): for each distinct row of docs with repeats, the spans of bytes that repeated windows cover.

    docs: (key, text). Rows that share a key are occurrences of their own, and their spans are listed once. Spans may overlap.
    """
    texts = _as_text(docs)
    counted = texts.mapInArrow(_anchor_counts, "anchor long, times long")
    met = durable(counted.groupBy("anchor").agg(F.sum("times").alias("met")).filter("met > 1"))
    bits = docs.sparkSession.sparkContext.broadcast(key_filter(met.select("anchor"), met.count()))
    return _spans(texts.mapInArrow(_anchors(bits), ANCHORED), met, texts.mapInArrow(_packed, "key long, packed binary"))


def _spans(rows: DataFrame, met: DataFrame, packed: DataFrame) -> DataFrame:
    """The spans that repeat among the bundles in rows with the anchors met (anchor, met); packed has their texts.

    What is met is joined to the bundles, so that a hot anchor fills no task: its count is one row, and Spark splits the join.
    """
    times = F.when(F.col("others").isNotNull(), F.size("others") + 1).otherwise(1)
    rows = durable(rows.withColumn("times", times).join(met, "anchor"))
    by_content = rows.groupBy("anchor", "content").agg(F.sum("times").alias("alike"), F.min(F.struct("key", "start")).alias("lead"))
    met = rows.join(by_content, ["anchor", "content"])
    places = F.concat(F.array(F.struct("key", "start")), F.coalesce("others", F.array().cast("array<struct<key:long,start:int>>")))
    whole = met.filter("alike > 1").select(F.col("n"), F.inline(places)).select(
        "key", F.col("start").cast("long").alias("begin"), (F.col("start") + F.col("n") - 1 + LENGTH).cast("long").alias("end")
    )
    one = F.struct("start", "n", "place", "anchor", (F.col("alike") > 1).alias("known"), (F.col("met") > HOT).alias("hot"))
    first = F.struct("key", "start") == F.col("lead")
    wanted = met.filter(first & F.expr("alike < met")).groupBy("key").agg(F.collect_set(one).alias("wanted"))
    slices = packed.join(wanted.hint("shuffle_hash"), "key").select("key", "packed", "wanted").mapInArrow(_slices, BUNDLE)
    parts = slices.repartition("anchor", "part").mapInArrow(_shard, "key long, begin long, end long")
    return whole.unionByName(parts).groupBy("key").agg(F.collect_set(F.struct("begin", "end")).alias("spans"))


class RepeatIndex:
    """The bundles of all documents added so far, in a folder of the shared store, as a logarithmic family of tables.

    A new batch meets the bundles of every level that share an anchor with it; then it becomes a level, in order of
    anchor, and levels of about equal size are merged. A manifest names the tables that count; it is written last, so a run
    that is cut off changes nothing. Several writers at a time are not supported.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.version, self.levels, self.texts = 0, [], []
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/manifest")
        if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            rows = spark.read.parquet(f"{folder}/manifest")
            rows = rows.filter(F.col("version") == rows.agg(F.max("version")).first()[0]).orderBy("place").collect()
            self.version = rows[0].version
            self.levels = [(r.path, r.n) for r in rows if r.kind == "level"]
            self.texts = [r.path for r in rows if r.kind == "texts"]

    def _write(self, df: DataFrame, kind: str) -> str:
        path = f"{self.folder}/{kind}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return path

    def add(self, docs: DataFrame) -> DataFrame:
        """(key, spans) of what docs (key, text) repeat among themselves and of what they share with earlier documents,
        for those as well. Where a bundle of docs is one that earlier documents repeat already, their spans are given again, so
        results of several batches are to be united."""
        read = self.spark.read.parquet
        texts = _as_text(docs)
        new = self._write(texts.mapInArrow(_anchors(), ANCHORED).sortWithinPartitions("anchor"), "level")
        self.texts.append(self._write(texts.mapInArrow(_packed, "key long, packed binary"), "texts"))
        asked = read(new).select("anchor").distinct()
        rows = read(new)
        for path, _ in self.levels:
            rows = rows.unionByName(read(path).join(asked, "anchor", "left_semi"))
        times = F.when(F.col("others").isNotNull(), F.size("others") + 1).otherwise(1)
        met = rows.groupBy("anchor").agg(F.sum(times).alias("met")).filter("met > 1")
        spans = durable(_spans(rows, met, read(*self.texts)))
        self.levels.append((new, read(new).count()))
        gone = []
        while len(self.levels) > 1 and self.levels[-2][1] <= 2 * self.levels[-1][1]:
            (small, n), (large, m) = self.levels.pop(), self.levels.pop()
            both = read(large, small).repartition("anchor").sortWithinPartitions("anchor")
            self.levels.append((self._write(both, "level"), n + m))
            gone += [small, large]
        self.version += 1
        named = [("level", p, n) for p, n in self.levels] + [("texts", p, 0) for p in self.texts]
        rows = [(self.version, i, *row) for i, row in enumerate(named)]
        manifest = self.spark.createDataFrame(rows, "version long, place int, kind string, path string, n long")
        manifest.coalesce(1).write.mode("append").parquet(f"{self.folder}/manifest")
        for path in gone:
            delete(self.spark, path)
        return spans


def remove_repeats(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep, n_bytes, n_removed, n_spans and kept (the remaining bytes) for each row of docs (doc_id, text).

    Each byte covered by a string of LENGTH bytes that also starts anywhere else in docs, the same text included, is
    removed; strings are judged on the input and never cross documents. Null texts are empty; repeated rows repeat each
    other in full. Texts under LENGTH bytes stay as they are. Columns of docs other than keep are not read.
    """
    keyed = docs.select(*keep, row_key(F.col("doc_id"), F.col("text")).alias("key"), "text")
    spans = durable(repeated_spans(keyed))
    texts = keyed.select(*keep, "key", F.coalesce("text", F.lit("")).alias("__text"))
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    packed = texts.mapInArrow(_packed, f"{fields}, key long, packed binary")
    names = [*keep, "n_bytes", "n_removed", "n_spans", "kept"]

    def cut(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            made = []
            for packed, spans in zip(batch.column(len(keep)).to_pylist(), batch.column(len(keep) + 1).to_pylist(), strict=True):
                raw = unpack(packed)
                runs = merged_spans([(s["begin"], s["end"]) for s in spans or ()])
                edges = [0, *(x for run in runs for x in run), len(raw)]
                kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                made.append((len(raw), len(raw) - len(kept), len(runs), kept))
            columns = list(zip(*made, strict=True)) or [(), (), (), ()]
            types = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            arrays = [*(batch.column(i) for i in range(len(keep))), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    joined = packed.join(spans.hint("shuffle_hash"), "key", "left").select(*keep, "packed", "spans")
    return joined.mapInArrow(cut, f"{fields}, n_bytes long, n_removed long, n_spans long, kept binary")
