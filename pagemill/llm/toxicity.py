"""Toxicity by class-conditional Kneser-Ney models.

Two interpolated bigram models, one of toxic and one of ordinary labelled documents. What both have in common is shared:
the counts of frequent pairs, which explain the fixed expressions of either class, and the lowest level, which rare words
back off to. Counts n are of continuations: of the distinct texts in which an expression goes on with the word, so that
neither bursts within a text nor exact copies count twice. For a class c, a word w and the word v before it:

    P_c(w | v) = max(n(vw) - PAIRS, 0) / n(v) + back(v) * P_c(w)          n(vw): both classes' texts with the pair
    P_c(w)     = (1 - p) * (max(n_c(w) - D_c, 0) / N_c + back_c * S(w))   n_c(w): the class's texts with the word
    S(w)       = min(n(w), CAP) / their sum over all words                n(w): both classes' texts with the word

back() is the mass that discounting freed, so each model sums to 1. Words in fewer than LEAST texts are one unknown word,
of the probability p in both. Starts and ends of texts are words too. The toxic class, the smaller one, is discounted by
far more than the ordinary one: its own counts speak where they are solid, and else it is the mixture of both classes. CAP
is where S carries as large a share of all counts as the toxic class gives back; a word that both use alike then has
about the same probability in both, whatever its frequency.

A document's score is a logistic function of one number: its toxic minus its ordinary log-likelihood, per word. The function
is fitted on labelled documents that the counts have not seen.

All counting is a shuffle of (expression, counts) rows over all labelled documents. Log-likelihoods are sums over a
document's words and pairs, so the models are one table (want, tox, ord) of what an expression adds to either. Its rows of
most texts, up to max_rows, are broadcast; the others stay a table in which documents look up what they need by a join. A
broadcast filter of bounded size spares look-ups that would find nothing; it never changes a score.
"""

import functools
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import delete, key_filter, passes, row_key, run_hashes, stored, text_batches

#: Discounts of the toxic and of the ordinary class, and of pairs; texts below which a word is unknown.
DISCOUNT_TOXIC, DISCOUNT_ORDINARY, PAIRS, LEAST = 50.0, 0.05, 10, 3
#: Bound on CAP.
MOST_CAP = 1 << 16
#: Bound on the labelled documents that the logistic calibration is fitted on.
CALIBRATION_ROWS = 20_000
#: Bounds on the difference per word, so that a text of few words doesn't bend the fit.
CLIP = 3.0
#: Hashes of words are odd. Even ones are the start and end of a text, and what stands before a word by itself in a key.
START, ALONE, END = 0, 2, 4
MADE = ("__n_words", "__toxic_ll", "__ordinary_ll", "__score")
TABLE = "want long, tox double, ord double"


@functools.cache
def _inside() -> np.ndarray:
    word = np.zeros(256, bool)
    word[48:58] = word[97:123] = word[65:91] = word[128:] = True
    return word


def word_hashes(text: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """32-bit hashes of the words of concatenated texts in order, all odd, and how many words each text has.

    Words are maximal runs of ASCII letters, digits and bytes from 128, in lower case as far as ASCII goes.
    """
    h, per_text = run_hashes(text, at, _inside())
    return (h >> np.uint64(32)).astype(np.uint32) | np.uint32(1), per_text


def key(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return (before.astype(np.uint64) << np.uint64(32) | word.astype(np.uint64)).view(np.int64)


def expressions(text: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the words and of the pairs that end with them, and how many each text has: its words and its end."""
    words, per_text = word_hashes(text, at)
    stop = np.cumsum(per_text + 1)
    full = np.full(len(words) + len(per_text), END, np.uint32)
    inner = np.ones(len(full), bool)
    inner[stop - 1] = False
    full[inner] = words
    before = np.empty_like(full)
    before[1:] = full[:-1]
    before[stop - per_text - 1] = START
    return key(np.full_like(full, ALONE), full), key(before, full), per_text + 1


@dataclass
class Model:
    """What words and pairs add to the log-likelihoods besides log p for each word; sorted by key. START adds once a text.

    beyond has the rows that are not in the arrays, if any, and bits is its filter. weights: bias and slope of the score.
    """

    unknown: float
    start: float
    keys: np.ndarray
    adds: np.ndarray
    weights: tuple[float, float] = (-3.0, 10.0)
    bits: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    beyond: DataFrame | None = None

    def sums(self, keys: np.ndarray, at: np.ndarray, wants: np.ndarray, adds: np.ndarray) -> np.ndarray:
        """Sums for each text (of keys at[i]:at[i + 1]); wants (sorted) and adds are what was looked up."""
        total = np.zeros((len(keys) + 1, 2))
        for table, values in ((self.keys, self.adds), (wants, adds)):
            if len(table):
                i, found = _find(table, keys)
                total[1:][found] = values[i[found]]
        total = np.cumsum(total, 0)
        return total[at[1:]] - total[at[:-1]]

    def wanted(self, keys: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (text, key) of the keys that are not in the arrays and pass the filter."""
        asked = passes(self.bits, keys)
        if len(self.keys):
            asked &= ~_find(self.keys, keys)[1]
        of, want = text[asked], keys[asked]
        order = np.lexsort((want, of))
        of, want = of[order], want[order]
        new = np.ones(len(of), bool)
        new[1:] = (of[1:] != of[:-1]) | (want[1:] != want[:-1])
        return of[new], want[new]

    def likelihoods(self, text: np.ndarray, at: np.ndarray, wants: np.ndarray, adds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words of each text, its end counted, and log-likelihoods per word, toxic and ordinary."""
        words, pairs, n = expressions(text, at)
        cut = np.concatenate([[0], np.cumsum(n)])
        total = self.sums(words, cut, wants, adds) + self.sums(pairs, cut, wants, adds)
        return n, (total + self.start) / n[:, None] + self.unknown

    def probability(self, per_word: np.ndarray) -> np.ndarray:
        z = self.weights[0] + self.weights[1] * difference(per_word)
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def difference(per_word: np.ndarray) -> np.ndarray:
    return np.clip(per_word[:, 0] - per_word[:, 1], -CLIP, CLIP)


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    i = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return i, table[i] == keys


def fold(doc_id: Column) -> Column:
    """0 to 3: crc32 of the id's text modulo 4; fold 2 is held out. A null id is in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4, F.lit(0)).cast("int")


def _count(batches):
    """For each expression, the texts of a slice that have it: toxic and ordinary ones."""
    schema = pa.schema([("want", pa.int64()), ("tox", pa.int64()), ("ord", pa.int64())])
    for batch in batches:
        for part, text, at in text_batches(batch, "text", 4 << 20):
            toxic = part.column("toxic").to_numpy(zero_copy_only=False) > 0
            words, pairs, n = expressions(text, at)
            of = np.repeat(np.arange(len(n)), n)
            for keys in (words, pairs):
                order = np.lexsort((of, keys))
                k, o = keys[order], of[order]
                new = np.ones(len(k), bool)
                new[1:] = (k[1:] != k[:-1]) | (o[1:] != o[:-1])
                k, t = k[new], toxic[o[new]]
                first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
                both = np.diff(np.append(first, len(k)))
                tox = np.add.reduceat(t.astype(np.int64), first) if len(first) else both
                yield pa.RecordBatch.from_arrays([pa.array(k[first]), pa.array(tox), pa.array(both - tox)], schema=schema)


def _arrays(bounded: DataFrame, order: str | None = None) -> dict[str, np.ndarray]:
    """Columns of a bounded table as arrays, by way of Arrow."""
    t = bounded.toArrow()
    t = t.sort_by(order) if order else t
    return {c: t.column(c).to_numpy() for c in t.column_names}


def cap_for(counts: np.ndarray, words: np.ndarray, share: float) -> float:
    """Where counts must be capped for their sum to be a share of it, given how many words have each count."""
    low, high = 0.0, float(counts.max())
    for _ in range(60):
        cap = (low + high) / 2
        if (np.minimum(counts, cap) * words).sum() < share * (counts * words).sum():
            low = cap
        else:
            high = cap
    return max(high, 1e-9)


def count_model(labelled: DataFrame, max_rows: int = 1 << 20) -> Model:
    """Model from (text, toxic) rows. Without rows of both classes nothing adds anything."""
    spark = labelled.sparkSession
    counted = labelled.select("text", "toxic").mapInArrow(_count, "want long, tox long, ord long")
    counts, path = stored(counted.groupBy("want").agg(F.sum("tox").alias("tox"), F.sum("ord").alias("ord")))
    before, word = F.shiftrightunsigned("want", 32), F.col("want").bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))
    alone = counts.filter(before == ALONE).withColumn("n", F.col("tox") + F.col("ord"))
    known = alone.filter(F.col("n") >= LEAST)
    less = lambda c, d: F.sum(F.least(F.col(c).cast("double"), F.lit(d)))
    total = known.agg(F.sum("tox"), F.sum("ord"), less("tox", DISCOUNT_TOXIC), less("ord", DISCOUNT_ORDINARY)).first()
    n_tox, n_ord, low_tox, low_ord = (float(x or 0) for x in total)
    if not n_tox or not n_ord:
        delete(spark, path)
        return Model(0.0, 0.0, np.zeros(0, np.int64), np.zeros((0, 2)))
    rare = float(alone.filter(F.col("n") < LEAST).agg(F.sum("n")).first()[0] or 0)
    p = (rare + 1) / (rare + n_tox + n_ord + 1)
    # Counts up to MOST_CAP one by one; above it their sum is all that matters, as CAP stays below it.
    spread = _arrays(known.groupBy(F.least("n", F.lit(MOST_CAP)).alias("n")).agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("all")))
    back_tox, back_ord = low_tox / n_tox, low_ord / n_ord
    cap = cap_for(spread["all"] / spread["words"], spread["words"], back_tox)
    cap = min(cap, float(MOST_CAP))
    shared_sum = float((np.minimum(spread["n"], cap) * spread["words"]).sum())

    def log_p(count: str, discount: float, n: float, back: float) -> Column:
        own = F.greatest(F.col(count) - F.lit(discount), F.lit(0.0)) / F.lit(n)
        shared = F.least(F.col("n").cast("double"), F.lit(cap)) / F.lit(shared_sum)
        return F.log((own + F.lit(back) * shared) * F.lit(1 - p))

    words = known.select(
        word.alias("w"),
        "n",
        log_p("tox", DISCOUNT_TOXIC, n_tox, back_tox).alias("p_tox"),
        log_p("ord", DISCOUNT_ORDINARY, n_ord, back_ord).alias("p_ord"),
    )
    pairs = counts.filter(before != ALONE).select(before.alias("v"), word.alias("w"), (F.col("tox") + F.col("ord")).alias("n"))
    of_v = F.sum("n").alias("of_v"), F.sum(F.least("n", F.lit(PAIRS))).alias("low"), F.max("n").alias("most")
    contexts = pairs.groupBy("v").agg(*of_v).filter(F.col("most") > PAIRS)
    contexts = contexts.select("v", "of_v", (F.col("low") / F.col("of_v")).alias("back"))
    frequent = pairs.filter(F.col("n") > PAIRS).join(contexts, "v").join(words.drop("n"), "w")
    own = (F.col("n") - PAIRS) / F.col("of_v")
    adds = lambda c: (F.log(own + F.col("back") * F.exp(c)) - F.log("back") - F.col(c)).alias(c[2:])
    pair_rows = frequent.select(F.shiftleft("v", 32).bitwiseOR(F.col("w")).alias("want"), "n", adds("p_tox"), adds("p_ord"))
    # A word's own probability, and what it gives back as the context of the word after it.
    both = words.join(contexts.select(F.col("v").alias("w"), "back"), "w", "left")
    after = F.log(F.coalesce("back", F.lit(1.0))) - F.lit(np.log(p))
    word_rows = both.select(
        F.col("w").bitwiseOR(F.lit(ALONE << 32)).alias("want"), "n", (F.col("p_tox") + after).alias("tox"), (F.col("p_ord") + after).alias("ord")
    )
    start = contexts.filter(F.col("v") == START).first()
    rows, row_path = stored(word_rows.unionByName(pair_rows))
    delete(spark, path)
    least = _least_count(rows, max_rows)
    top = _arrays(rows.filter(F.col("n") >= least).select("want", "tox", "ord"), "want")
    values = np.stack([top["tox"], top["ord"]], 1)
    model = Model(float(np.log(p)), float(np.log(start["back"])) if start else 0.0, top["want"], values)
    beyond = rows.filter(F.col("n") < least).select("want", "tox", "ord")
    if n := beyond.count():
        model.bits, model.beyond = key_filter(beyond.select("want"), n), beyond
    else:
        delete(spark, row_path)
    return model


def _least_count(rows: DataFrame, most: int) -> int:
    """The least n down to which rows are at most so many."""
    spread = rows.groupBy(F.least("n", F.lit(1 << 20)).alias("n")).count().orderBy(F.desc("n")).toArrow()
    kept = np.cumsum(spread.column("count").to_numpy())
    fits = int((kept <= most).sum())
    return int(spread.column("n")[fits - 1].as_py()) if fits else (1 << 62)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Bias and slope by Newton's method with a small ridge."""
    x, w = np.column_stack([np.ones(len(x)), x]), np.zeros(2)
    for _ in range(50):
        prob = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (prob - y) + 1e-3 * w
        h = (x.T * np.maximum(prob * (1 - prob), 1e-9)) @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, g)
        w -= step * min(1.0, 10 / np.abs(step).max())
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(max(w[1], 1e-6))


def _looked_up(rows: DataFrame, beyond: DataFrame, shared) -> DataFrame:
    """(__key, __found): the rows that the texts of rows (__key, text) need besides the broadcast ones."""

    def ask(batches):
        model = shared.value
        for batch in batches:
            for part, text, at in text_batches(batch, "text"):
                words, pairs, n = expressions(text, at)
                of, want = model.wanted(np.concatenate([words, pairs]), np.tile(np.repeat(np.arange(len(n)), n), 2))
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(of)), pa.array(want)], names=["__key", "want"])

    asked = rows.select("__key", "text").mapInArrow(ask, "__key long, want long")
    return asked.join(beyond, "want").groupBy("__key").agg(F.collect_set(F.struct("want", "tox", "ord")).alias("__found"))


def _found(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All keys that were looked up for the texts of a slice, sorted, and what they add."""
    want, *adds = (x.to_numpy(zero_copy_only=False) for x in column.flatten().flatten())
    want, first = np.unique(want, return_index=True)
    return want, np.stack(adds, 1)[first]


def with_scores(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns in keep and MADE. docs needs doc_id and text.

    Rows are shuffled only if the model has rows beyond its broadcast arrays.
    """
    shared = docs.sparkSession.sparkContext.broadcast(replace(model, beyond=None))
    fields = [docs.schema[c] for c in keep]
    made = "__n_words int, __toxic_ll double, __ordinary_ll double, __score double"
    out_schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), made])
    rows = docs.select(*keep, *([] if "text" in keep else ["text"]), row_key(F.col("doc_id"), F.col("text")).alias("__key"))
    if model.beyond is None:
        rows = rows.drop("__key")
    else:
        rows = rows.join(_looked_up(rows, model.beyond, shared).hint("shuffle_hash"), "__key", "left")
    nothing = np.zeros(0, np.int64), np.zeros((0, 2))

    def score(batches):
        model = shared.value
        for batch in batches:
            for part, text, at in text_batches(batch, "text"):
                place = part.schema.get_field_index("__found")
                n, ll = model.likelihoods(text, at, *(_found(part.column(place)) if place >= 0 else nothing))
                arrays = [part.column(part.schema.get_field_index(c)) for c in keep]
                more = [pa.array((n - 1).astype(np.int32)), pa.array(ll[:, 0]), pa.array(ll[:, 1]), pa.array(model.probability(ll))]
                yield pa.RecordBatch.from_arrays([*arrays, *more], names=[*keep, *MADE])

    return rows.mapInArrow(score, out_schema)


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = 400_000, max_rows: int = 1 << 20) -> Model:
    """Fit on labelled documents outside fold 2: folds 0 and 1 are counted, fold 3 calibrates.

    docs: (doc_id, text); labels: (doc_id, toxic). Rows with a null label are not labelled. Labels that disagree on one
    id count as toxic, and so do those of documents with equal texts, of which one is counted. All labelled documents are
    counted. Up to max_labelled labels are broadcast; more meet their documents by a join that shuffles texts. About
    CALIBRATION_ROWS documents calibrate.
    """
    near = lambda t: F.broadcast(t) if t.count() <= max_labelled else t
    known = labels.filter("toxic is not null and doc_id is not null").withColumn("fold", fold(F.col("doc_id")))
    known = known.filter("fold <> 2").groupBy("doc_id", "fold").agg(F.max("toxic").alias("toxic"))
    hashed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"))
    counting = hashed.join(near(known.filter("fold in (0, 1)")), "doc_id")
    counting = counting.groupBy("text_hash", "doc_id").agg(F.count(F.lit(1)).alias("n"), F.max("toxic").alias("toxic"))
    one_each = counting.groupBy("text_hash").agg(F.min(F.struct("doc_id", "n")).alias("one"), F.max("toxic").alias("toxic"))
    one_each, path = stored(one_each.select("text_hash", "one.*", "toxic"))
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).join(near(one_each), ["doc_id", "text_hash"])
    if one_each.filter("n > 1").limit(1).count():  # only rows that repeat are shuffled to be one
        texts = texts.filter("n = 1").unionByName(texts.filter("n > 1").dropDuplicates(["text_hash"]))
    model = count_model(texts, max_rows)
    delete(docs.sparkSession, path)
    spare = known.filter("fold = 3")
    n = spare.count()
    if n > CALIBRATION_ROWS:
        spare = spare.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1e6 * CALIBRATION_ROWS / n))
    spare = docs.select("doc_id", "text").join(near(spare), "doc_id")
    seen = _arrays(with_scores(spare, model, ["toxic"]).limit(2 * CALIBRATION_ROWS))
    y = (seen["toxic"] > 0).astype(float)
    if 0 < y.sum() < len(y):
        model.weights = _logistic(difference(np.stack([seen["__toxic_ll"], seen["__ordinary_ll"]], 1)), y)
    return model


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **bounds) -> DataFrame:
    """docs with held_out, score, predicted, n_words, toxic_ll and ordinary_ll (per word); other columns stay but for text.

    Null and empty texts have no words but an end, and are scored by it. Columns of docs named like a result column are
    replaced. Repeated rows get equal scores. Without labels of both classes the models say nothing and scores are
    that of no evidence. An empty table gives an empty table.
    """
    made = {*(c[2:] for c in MADE), "predicted", "held_out"}
    keep = [c for c in docs.columns if c.lower() not in made and c != "text"]
    scored = with_scores(docs, fit(docs, labels, **bounds), keep)
    scored = scored.select(*keep, *(F.col(c).alias(c[2:]) for c in MADE))
    return scored.withColumns(
        {"held_out": fold(F.col("doc_id")) == 2, "predicted": (F.col("score") >= threshold).cast("int")}
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **bounds) -> DataFrame:
    """docs without the rows scored at the threshold or above; same columns."""
    scored = with_scores(docs, fit(docs, labels, **bounds), docs.columns)
    return scored.filter(F.col("__score") < threshold).select(*docs.columns)
