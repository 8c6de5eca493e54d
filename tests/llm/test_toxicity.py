import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagemill.llm import toxicity as T


def rows(n=900, seed=2):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "bcdfghklmn" for b in ("at", "en", "ing", "olo", "ur", "ise", "a")] + ["the"] * 20
    bad = ["vile", "scum", "trash"]
    docs, labels = [], []
    for i in range(n):
        toxic = i % 6 == 0
        w = rng.choices(words, k=rng.randint(15, 120))
        if toxic:
            for _ in range(rng.randint(2, 5)):
                w[rng.randrange(len(w))] = rng.choice(bad)
        docs.append((i, " ".join(w), "x", 1.0))
        if i % 3:
            labels.append((i, int(toxic), 0))
    labels += [(i, 1, 0) for i in range(0, n, 6)]
    docs += [(n, None, "x", 1.0), (n + 1, "", "x", 1.0), (n + 1, "", "x", 1.0), (None, "vile scum", "x", 1.0), (n + 2, "THE " * 50_000, "x", 1.0)]
    return docs, labels + [(n, None, 0), (None, 1, 0)]


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = rows()
    return (
        spark.createDataFrame(docs, "doc_id long, text string, score string, held_out double"),
        spark.createDataFrame(labels, "doc_id long, toxic int, quality int"),
    )


def test_held_out_accuracy(spark, tables):
    out = T.toxicity_scores(*tables).collect()
    assert len(out) == 905 and all(0 <= r.score <= 1 for r in out)
    held = [r for r in out if r.held_out and r.doc_id < 900]
    assert 150 < len(held) < 300
    right = [(r.predicted == 1) == (r.doc_id % 6 == 0) for r in held]
    assert np.mean(right) > 0.95
    empty = [r.score for r in out if r.doc_id in (900, 901)]
    assert len(empty) == 3 and len(set(empty)) == 1 and empty[0] < 0.3


def test_held_out_labels_are_not_read(spark, tables):
    docs, labels = tables
    flipped = labels.withColumn("toxic", F.when(T.fold(F.col("doc_id")) == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    scores = lambda l: sorted((r.doc_id or -1, r.score) for r in T.toxicity_scores(docs, l).collect())  # noqa: E731, E741
    assert scores(labels) == scores(flipped)


def test_drop_toxic_keeps_columns(spark, tables):
    docs, labels = tables
    out = T.drop_toxic(docs, labels)
    kept = {r.doc_id for r in out.collect()}
    assert out.columns == docs.columns and {900, 901, 902, 1, 2} <= kept
    assert sum(i % 6 == 0 for i in kept if i is not None and i < 900) < 15


def test_no_labels_and_no_rows(spark, tables):
    docs, labels = tables
    assert {r.predicted for r in T.toxicity_scores(docs, labels.limit(0)).collect()} == {0}
    assert T.toxicity_scores(docs.limit(0), labels).collect() == []


@pytest.mark.parametrize("bounds", [{"max_rows": 3}, {"max_rows": 60}, {"max_labelled": 10}])
def test_bounds_of_the_broadcast_do_not_change_scores(spark, tables, bounds):
    def scores(**bounds):
        return sorted((r.doc_id or -1, r.score) for r in T.toxicity_scores(*tables, **bounds).collect())

    whole, bounded = scores(), scores(**bounds)
    assert [i for i, _ in whole] == [i for i, _ in bounded]
    assert np.allclose([x for _, x in whole], [x for _, x in bounded], atol=1e-6)


def plain_models(texts):
    """P_c(w | v) of both classes as a plain function, and the vocabulary, from (text, toxic) of distinct texts."""
    split = [(["<s>", *re.findall(r"[0-9a-z\x80-\U0010ffff]+", (t or "").lower()), "</s>"], y) for t, y in texts]
    n = [Counter(w for t, y in split if y == c for w in set(t[1:])) for c in (1, 0)]
    pair = Counter(p for t, _ in split for p in set(zip(t, t[1:], strict=False)))
    both = n[0] + n[1]
    vocabulary = {w for w in both if both[w] >= T.LEAST}
    total = [sum(m[w] for w in vocabulary) for m in n]
    low = [sum(min(m[w], d) for w in vocabulary) for m, d in zip(n, (T.DISCOUNT_TOXIC, T.DISCOUNT_ORDINARY), strict=True)]
    rare = sum(c for w, c in both.items() if w not in vocabulary)
    p = (rare + 1) / (rare + sum(total) + 1)
    values = np.array([both[w] for w in vocabulary])
    cap = T.cap_for(values, np.ones(len(values)), low[0] / total[0])
    shared = {w: min(both[w], cap) / np.minimum(values, cap).sum() for w in vocabulary}
    of_v, back = Counter(), Counter()
    for (v, _), c in pair.items():
        of_v[v] += c
        back[v] += min(c, T.PAIRS)

    def prob(c, w, v):
        if w in vocabulary:
            own = max(n[c][w] - (T.DISCOUNT_TOXIC, T.DISCOUNT_ORDINARY)[c], 0) / total[c]
            alone = (1 - p) * (own + low[c] / total[c] * shared[w])
        else:
            alone = p
        if not of_v[v]:
            return alone
        return max(pair[v, w] - T.PAIRS, 0) / of_v[v] + back[v] / of_v[v] * alone

    return prob, vocabulary, split


@pytest.fixture(scope="module")
def counted():
    docs, labels = rows(400)
    toxic = {i: y for i, y, _ in labels if y is not None}
    text = {t: toxic[i] for i, t, *_ in docs if i in toxic}
    return [(None, 0), *text.items(), ("vile vile vile", 1), ("the the the the", 0)]


def test_models_sum_to_one(counted):
    prob, vocabulary, _ = plain_models(counted)
    for c in (0, 1):
        for v in ("the", "vile", "<s>", "never seen"):
            assert abs(sum(prob(c, w, v) for w in vocabulary) + prob(c, "unknown", v) - 1) < 1e-9


def test_likelihoods_against_plain_models(spark, counted):
    prob, _, split = plain_models(counted)
    model = T.count_model(spark.createDataFrame(counted, "text string, toxic int"))
    new = "scum the zzz vile vile trash unheard"
    raw = [(t or "").encode() for t, _ in counted] + [new.encode()]
    at = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    none = np.zeros(0, np.int64), np.zeros((0, 2))
    n, got = model.likelihoods(np.frombuffer(b"".join(raw), np.uint8), at, *none)
    texts = [t for t, _ in split] + [["<s>", *new.split(), "</s>"]]
    want = [[np.mean([np.log(prob(c, w, v)) for v, w in zip(t, t[1:], strict=False)]) for c in (0, 1)] for t in texts]
    assert n.tolist() == [len(t) - 1 for t in texts]
    assert np.allclose(got, want, atol=1e-9)
    assert got[-1, 0] > got[-1, 1]


def test_equal_texts_count_once(spark, tables):
    docs, labels = tables
    counted = [i for i in range(900) if zlib.crc32(str(i).encode()) % 4 < 2]
    ids = [next(i for i in counted if i % 6 == 0), next(i for i in counted if i % 6 == 1)]
    copies = docs.filter(F.col("doc_id").isin(ids)).crossJoin(spark.range(1, 40).withColumnRenamed("id", "k"))
    copies = copies.select((F.col("doc_id") + 10_000 * F.col("k")).alias("doc_id"), "text", "score", "held_out")
    toxic = (F.col("doc_id") % 10_000 == ids[0]).cast("int").alias("toxic")
    one, many = T.fit(docs, labels), T.fit(docs.unionByName(copies), labels.unionByName(copies.select("doc_id", toxic, F.lit(0).alias("quality"))))
    assert (one.keys == many.keys).all() and np.allclose(one.adds, many.adds)
    repeats = docs.filter(F.col("doc_id").isin(ids)).crossJoin(spark.range(50)).select(*docs.columns)
    many = T.fit(docs.unionByName(repeats), labels)
    assert (one.keys == many.keys).all() and np.allclose(one.adds, many.adds)


def test_words():
    raw = [b"The the", b"", b"x THE", "é".encode()]
    at = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    h, n = T.word_hashes(np.frombuffer(b"".join(raw), np.uint8), at)
    assert n.tolist() == [2, 0, 2, 1] and h[0] == h[1] == h[3] != h[2]
