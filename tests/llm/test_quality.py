import random
import re
import zlib
from collections import Counter

import numpy as np

from pagemill.llm import quality as Q
from pagemill.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def together(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])


def plain_inputs(text):
    """Inputs of a text's passages, one by one; without the slots of hashed words."""
    raw = text.encode()
    words = [(m.start(), m.group()) for m in re.finditer(rb"[^ \x09-\x0d]+", raw)]
    lower = [w.lower() for _, w in words]
    triples = Counter(zip(lower, lower[1:], lower[2:], strict=False))
    kind = lambda b: next((i for i, c in enumerate(Q.CLASSES) if b in c), len(Q.CLASSES))
    out = []
    n = max(1, -(-len(words) // Q.PASSAGE))
    for p in range(n):
        some = range(p * Q.PASSAGE, min(len(words), (p + 1) * Q.PASSAGE))
        begin = words[some[0]][0] if p else 0
        end = words[some[-1] + 1][0] if p + 1 < n else len(raw)
        pairs = Counter((kind(a), kind(b)) for a, b in zip(raw[begin:end], raw[begin + 1 : end], strict=False))
        x = [np.sqrt(pairs[i, j] / max(1, end - begin)) for i in range(Q.N_CLASSES) for j in range(Q.N_CLASSES)]
        size, k = [min(60, len(words[i][1])) for i in some] or [0], max(1, len(some))
        inside = Counter(lower[i] for i in some)
        x += [len(some) / Q.PASSAGE, sum(size) / k / 10, np.sqrt(max(0, sum(s * s for s in size) / k - (sum(size) / k) ** 2)) / 10]
        x += [sum(i > 0 and lower[i] == lower[i - 1] for i in some) / k, sum(inside[lower[i]] > 1 for i in some) / k]
        x += [sum(triples[tuple(lower[i : i + 3])] > 1 for i in some) / k, np.log1p((end - begin) / k) / 5, float(not words)]
        out.append(x)
    return out


def test_inputs_against_plain_counts():
    rng = random.Random(3)
    picks = ["a", "The", "THE!!", "$$$", "é", "中文", "x1", "a.b", "w" * 90, "\x01"]
    texts = ["", " \n", "one", " two ", *("".join(rng.choice(picks) + rng.choice([" ", "\n", "\t "]) for _ in range(rng.randint(1, 170))) for _ in range(40))]
    x, n = Q.encode(*together(texts))
    stop = np.cumsum(n)
    for t, b, k in zip(texts, stop, n, strict=True):
        want = np.array(plain_inputs(t))
        assert want.shape[0] == k and np.allclose(x[b - k : b, : want.shape[1]], want, atol=1e-5), t
        alone, _ = Q.encode(*together([t]))
        assert np.allclose(alone, x[b - k : b])  # whatever stands beside it


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    n, y = np.array([1, 4, 2, 7]), np.array([1.0, 0, 1, 0])
    x = rng.normal(size=(n.sum(), Q.N_INPUTS))
    model = Q.train(x, n, y, epochs=1)
    w = model.weights = {k: a.astype(float) for k, a in model.weights.items()}
    first = np.cumsum(n) - n

    def loss():
        p = Q._sigmoid(model.forward(x, first, n)["logit"])
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    found = Q.gradients(w, x, n, model.forward(x, first, n), y)
    for k, a in w.items():
        for _ in range(4):
            at = tuple(rng.integers(s) for s in a.shape)
            old, step = a[at], 1e-5
            a[at] = old + step
            up = loss()
            a[at] = old - step
            down = loss()
            a[at] = old
            assert abs((up - down) / (2 * step) - found[k][at]) < 1e-6, k
    f = model.forward(x, first, n)
    assert np.allclose(np.add.reduceat(f["a"], first), 1)  # attention is shared out within a document
    h = np.tanh(x[1:5] @ w["we"] + w["be"])
    e = np.exp((np.tanh(h @ w["v"]) / (1 + np.exp(-h @ w["g"]))) @ w["u"])
    assert np.isclose(f["logit"][1], ((e / e.sum()) @ h) @ w["c"] + w["b"][0])


def test_one_bad_passage_is_found(spark):
    rng = random.Random(5)
    prose = lambda k: " ".join(rng.choice("the of river stone walks over quiet morning".split()) for _ in range(k))
    rows = [(i, prose(300) + ("" if i % 3 else " " + "$$$ " * 45 + prose(200))) for i in range(300)]
    docs = spark.createDataFrame([*rows, (None, None), (1000, ""), (1, rows[1][1]), (1001, prose(60_000))], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i, _ in rows] + [(4, None), (None, 0), (7, 1)], "doc_id long, quality int")
    out = Q.quality_scores(docs.selectExpr("doc_id", "text", "1 as score", "'k' as other"), labels).collect()
    assert len(out) == len(rows) + 4 and {r.other for r in out} == {"k"}
    held = [r for r in out if r.held_out and r.doc_id < 300]
    assert len(held) > 40 and all(r.predicted == int(r.doc_id % 3 > 0) for r in held)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    assert len({r.score for r in out if r.doc_id == 1}) == 1 and all(0 <= r.score <= 1 for r in out)
    assert {r.doc_id: r.n_passages for r in out if r.doc_id in (None, 1000, 1001)} == {None: 1, 1000: 1, 1001: 1500}


def test_bounded_sample_and_labels_of_one_class(spark):
    docs = spark.createDataFrame([(i, "word " * (50 * (i % 9 + 1))) for i in range(100)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)], "doc_id long, quality int")
    assert isinstance(Q.fit(docs, labels, max_documents=20), Q.Model) and isinstance(Q.fit(docs, labels, max_passages=60), Q.Model)
    assert Q.fit(docs, labels.filter("quality = 1")) == 1.0 and Q.fit(docs, labels.limit(0)) == 0.5 and Q.fit(docs.limit(0), labels) == 0.5
    assert Q.fit(docs, labels, max_passages=0) == 0.5
    out = Q.quality_scores(docs, labels.filter("quality = 0")).collect()
    assert {(r.score, r.predicted) for r in out} == {(0.0, 0)}
    assert Q.quality_scores(docs.limit(0), labels).collect() == []


def test_held_out_accuracy(spark):
    out = QUERIES["op12_quality"](spark, SF).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(out) == spark.read.parquet(f"{SF}/documents.parquet").count()
    held = [(r.score, r.predicted, labels[r.doc_id]) for r in out if r.held_out and r.doc_id in labels]
    good, poor = [s for s, _, y in held if y], [s for s, _, y in held if not y]
    auc = np.mean([a > b for a in good for b in poor])
    assert auc > 0.98 and np.mean([p == y for _, p, y in held]) > 0.95
