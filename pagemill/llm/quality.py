"""Quality of documents by attention-based multiple-instance learning.

A document is a bag of passages, and only the bag has a label: a text of poor quality is often ordinary prose around one bad
stretch. Every passage of PASSAGE words is encoded by how its bytes and words look (classes of neighbouring bytes, lengths,
repeats within the passage and within the document, common words by hash), a small network turns that into a vector h, and
gated attention weighs the passages of a document:

    a_k = softmax over k of  u . (tanh(V h_k) * sigmoid(U h_k)),    score = sigmoid(c . sum_k a_k h_k + b)

All weights, those of the attention included, are learned together from document labels by gradient descent (Adam with
decaying steps and weight decay, a fixed seed) on a bounded sample of the labelled documents: MOST_DOCUMENTS documents of
MOST_PASSAGES passages in all, the first by a hash of their ids. The fitted model is some tens of kilobytes. It is broadcast,
and every whole text is scored by it in one narrow pass, in slices of bounded size.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import WORD, delete, mixed, ranges, run_hashes, runs, stored, text_batches

#: Words of a passage.
PASSAGE = 40
#: Bounds on the labelled documents that the model is fitted on, on all their passages, and on those of one of them.
MOST_DOCUMENTS, MOST_PASSAGES, MOST_IN_ONE = 6_000, 120_000, 2_000
#: Slots of the hashed words, dimensions of h and of the attention.
SLOTS, WIDE, ATTENTION = 48, 24, 12
EPOCHS, BATCH, RATE, DECAY, SEED = 24, 48, 0.01, 1e-3, 12
MADE = ("held_out", "score", "predicted", "n_passages")

#: Classes of bytes, each with its bytes; what is in none is the last class.
CLASSES = (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r\x0b\x0c", b".,", b";:!?", b"'\"()-", bytes(range(128, 256)))
N_CLASSES = len(CLASSES) + 1
N_SHAPE = 8
N_INPUTS = N_CLASSES * N_CLASSES + N_SHAPE + SLOTS


def _tables() -> tuple[np.ndarray, np.ndarray]:
    kind, inside = np.full(256, N_CLASSES - 1, np.int64), np.ones(256, bool)
    for i, members in enumerate(CLASSES):
        kind[list(members)] = i
    inside[[32, *range(9, 14)]] = False
    return kind, inside


KIND, INSIDE = _tables()


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    order = np.argsort(keys)
    k = keys[order]
    twice = np.zeros(len(k), bool)
    if len(k) > 1:
        same = k[1:] == k[:-1]
        twice[1:] |= same
        twice[:-1] |= same
    out = np.zeros(len(k), bool)
    out[order] = twice
    return out


def encode(text: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Inputs of the passages of concatenated texts, and how many passages each text has: at least one."""
    words, per_text = run_hashes(text, at, INSIDE)
    begin, end = runs(INSIDE[text], at) if len(text) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    n = np.maximum(1, -(-per_text // PASSAGE))
    total = int(n.sum())
    first_word = np.cumsum(per_text) - per_text
    first_passage = np.cumsum(n) - n
    doc = np.repeat(np.arange(len(n)), per_text)
    passage = first_passage[doc] + (np.arange(len(words)) - first_word[doc]) // PASSAGE  # of each word
    out = np.zeros((total, N_INPUTS), np.float32)

    # A passage's bytes go from its first word to the next passage's; the first one has what stands before it too.
    opens = np.ones(len(words), bool)
    opens[1:] = passage[1:] != passage[:-1]
    borders = np.zeros(total, np.int64)
    borders[passage[opens]] = begin[opens]
    borders[first_passage] = at[:-1]
    size = np.diff(np.append(borders, len(text)))
    if len(text) > 1:
        of = np.repeat(np.arange(total), size)
        pair = KIND[text[:-1]] * N_CLASSES + KIND[text[1:]]
        inner = of[1:] == of[:-1]
        counts = np.bincount(of[:-1][inner] * (N_CLASSES * N_CLASSES) + pair[inner], minlength=total * N_CLASSES * N_CLASSES)
        out[:, : N_CLASSES * N_CLASSES] = np.sqrt(counts.reshape(total, -1) / np.maximum(size, 1)[:, None])

    at_words = np.bincount(passage, minlength=total)
    per_word = np.maximum(at_words, 1)
    share = lambda x: np.bincount(passage, x, minlength=total) / per_word
    length = np.minimum(end - begin, 60).astype(float)
    as_before = np.zeros(len(words))
    as_before[1:] = (words[1:] == words[:-1]) & (doc[1:] == doc[:-1])
    salt = mixed(np.arange(1, len(n) + 1, dtype=np.uint64))[doc]
    in_passage = mixed(words + mixed(passage.astype(np.uint64) + np.uint64(1 << 40)))
    triple = np.zeros(len(words))
    if len(words) > 2:
        run3 = mixed(mixed(mixed(words[:-2] + salt[:-2]) + words[1:-1]) + words[2:])
        inner = np.flatnonzero(doc[2:] == doc[:-2])
        triple[inner] = _repeated(run3[inner])
    mean = share(length)
    shape = out[:, N_CLASSES * N_CLASSES :][:, :N_SHAPE]
    shape[:, 0], shape[:, 1] = at_words / PASSAGE, mean / 10
    shape[:, 2] = np.sqrt(np.maximum(share(length * length) - mean * mean, 0)) / 10
    shape[:, 3], shape[:, 4], shape[:, 5] = share(as_before), share(_repeated(in_passage)), share(triple)
    shape[:, 6], shape[:, 7] = np.log1p(size / per_word) / 5, at_words == 0
    slots = np.bincount(passage * SLOTS + (words % np.uint64(SLOTS)).astype(np.int64), minlength=total * SLOTS)
    out[:, -SLOTS:] = np.sqrt(slots.reshape(total, SLOTS) / per_word[:, None])
    return out, n


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Model:
    """Scales of the inputs and the weights: encoder (we, be), attention (v, g, u), and bag (c, b)."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, first: np.ndarray, n: np.ndarray) -> dict[str, np.ndarray]:
        """All values on the way from inputs (already scaled) to the documents' logits."""
        w = self.weights
        h = np.tanh(x @ w["we"] + w["be"])
        t, s = np.tanh(h @ w["v"]), _sigmoid(h @ w["g"])
        e = (t * s) @ w["u"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, first), n))
        a = e / np.repeat(np.add.reduceat(e, first), n)
        z = np.add.reduceat(a[:, None] * h, first, axis=0)
        return {"h": h, "t": t, "s": s, "a": a, "z": z, "logit": z @ w["c"] + w["b"]}

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6).astype(np.float32)

    def scores(self, text: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score and number of passages of each text."""
        x, n = encode(text, at)
        return _sigmoid(self.forward(self.scaled(x), np.cumsum(n) - n, n)["logit"]), n


def gradients(w: dict[str, np.ndarray], x: np.ndarray, n: np.ndarray, f: dict[str, np.ndarray], y: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean cross-entropy of a batch of documents, by all weights."""
    d = (_sigmoid(f["logit"]) - y) / len(y)
    dz = np.repeat(d[:, None] * w["c"], n, axis=0)
    da = (dz * f["h"]).sum(1)
    first = np.cumsum(n) - n
    de = f["a"] * (da - np.repeat(np.add.reduceat(f["a"] * da, first), n))
    gate = de[:, None] * w["u"]
    dt, ds = gate * f["s"] * (1 - f["t"] ** 2), gate * f["t"] * f["s"] * (1 - f["s"])
    dh = f["a"][:, None] * dz + dt @ w["v"].T + ds @ w["g"].T
    dx = dh * (1 - f["h"] ** 2)
    return {"we": x.T @ dx, "be": dx.sum(0), "v": f["h"].T @ dt, "g": f["h"].T @ ds, "u": (f["t"] * f["s"]).T @ de, "c": f["z"].T @ d, "b": d.sum(0, keepdims=True)}


def train(x: np.ndarray, n: np.ndarray, y: np.ndarray, epochs: int = EPOCHS) -> Model:
    """Model from the inputs of all passages, the passages of each document and its label (0 or 1)."""
    rng = np.random.default_rng(SEED)
    model = Model(x.mean(0), np.maximum(x.std(0), 1e-3), {})
    x = model.scaled(x)
    y = y.astype(np.float32)
    normal = lambda *shape: (rng.normal(size=shape) / np.sqrt(shape[0])).astype(np.float32)
    zeros = lambda n: np.zeros(n, np.float32)
    w = model.weights
    w |= {"we": normal(N_INPUTS, WIDE), "be": zeros(WIDE), "v": normal(WIDE, ATTENTION), "g": normal(WIDE, ATTENTION), "u": normal(ATTENTION), "c": normal(WIDE), "b": zeros(1)}
    p = y.mean()
    w["b"][0] = np.log(p / (1 - p))
    first = np.cumsum(n) - n
    m, v, step = {k: np.zeros_like(a) for k, a in w.items()}, {k: np.zeros_like(a) for k, a in w.items()}, 0
    for epoch in range(epochs):
        order = rng.permutation(len(n))
        rate = RATE * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
        for i in range(0, len(order), BATCH):
            docs = order[i : i + BATCH]
            rows = x[ranges(first[docs], n[docs])]
            f = model.forward(rows, np.cumsum(n[docs]) - n[docs], n[docs])
            step += 1
            for k, g in gradients(w, rows, n[docs], f, y[docs]).items():
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                w[k] -= np.float32(rate) * (m[k] / (1 - 0.9**step) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8) + DECAY * w[k] * (k != "b"))
    return model


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id's text is a multiple of 5; a null id isn't held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _encoded(batches):
    """Inputs of each labelled text as float32 bytes."""
    for batch in batches:
        for part, text, at in text_batches(batch, "text"):
            x, n = encode(text, at)
            stop = np.cumsum(n)
            rows = [x[b - k : b].tobytes() for b, k in zip(stop, n, strict=True)]
            label = part.column(part.schema.get_field_index("quality"))
            yield pa.RecordBatch.from_arrays([label.cast(pa.float64()), pa.array(n.astype(np.int32)), pa.array(rows, pa.binary())], names=["y", "n", "x"])


def fit(docs: DataFrame, labels: DataFrame, max_documents: int = MOST_DOCUMENTS, max_passages: int = MOST_PASSAGES) -> Model | float:
    """Model of labelled documents that aren't held out; where they aren't of both classes, the score that all texts get.

    docs: (doc_id, text); labels: (doc_id, quality). Null labels are none. Of labels that disagree on an id, and of texts
    that share one, the least counts. The sample is in the module's docstring; texts of over MOST_IN_ONE passages aren't in
    it.
    """
    spark = docs.sparkSession
    known = labels.filter("quality is not null and doc_id is not null").filter(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min((F.col("quality") > 0).cast("int")).alias("quality"))
    place = F.xxhash64("doc_id", F.lit(SEED))
    drawn = F.broadcast(known.orderBy(place, "doc_id").limit(max_documents))
    texts = docs.select("doc_id", "text").join(drawn, "doc_id").groupBy("doc_id", "quality").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    passages = F.greatest(F.lit(1), F.ceil(F.regexp_count("text", F.lit(WORD)) / PASSAGE)).cast("long")
    texts, path = stored(texts.withColumns({"place": place, "passages": passages}))
    sizes = texts.filter(F.col("passages") <= MOST_IN_ONE).select("place", "doc_id", "passages").toArrow().sort_by([("place", "ascending"), ("doc_id", "ascending")])
    room = np.cumsum(sizes.column("passages").to_numpy())
    fits = int((room <= max_passages).sum())
    last = sizes.column("place")[fits - 1].as_py() if fits else None
    some = texts.filter((F.col("passages") <= MOST_IN_ONE) & (F.col("place") <= F.lit(last).cast("long")))
    found = some.orderBy("place", "doc_id").select("quality", "text").mapInArrow(_encoded, "y double, n int, x binary").toArrow()
    delete(spark, path)
    y, n = found.column("y").to_numpy(), found.column("n").to_numpy().astype(np.int64)
    if not len(y) or y.min() == y.max():
        return float(y[0]) if len(y) else 0.5
    x = np.frombuffer(b"".join(found.column("x").to_pylist()), np.float32).reshape(-1, N_INPUTS)
    return train(x, n, y)


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **bounds) -> DataFrame:
    """docs with held_out, score, predicted (1 where the score is at the threshold or above) and n_passages; no text.

    docs: (doc_id, text) and others, which stay but for those named like a result. Null and empty texts are one passage
    without words. Equal texts have equal scores. Without labels of both classes, all texts have the score of the one
    there is, or 0.5. An empty table gives an empty table.
    """
    keep = [c for c in docs.columns if c.lower() not in MADE and c != "text"]
    model = fit(docs, labels, **bounds)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kinds = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep), "__score double, __n long"])

    def score(batches):
        model = shared.value
        for batch in batches:
            for part, text, at in text_batches(batch, "text", 1 << 20):
                s, n = model.scores(text, at) if isinstance(model, Model) else (np.full(len(part), model), encode(text, at)[1])
                arrays = [part.column(part.schema.get_field_index(c)) for c in keep]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(s.astype(np.float64)), pa.array(n.astype(np.int64))], names=[*keep, "__score", "__n"])

    scored = docs.select(*keep, "text").mapInArrow(score, kinds)
    return scored.select(
        *keep,
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("__score").alias("score"),
        (F.col("__score") >= threshold).cast("int").alias("predicted"),
        F.col("__n").alias("n_passages"),
    )
