import random

import numpy as np

from pagemill.llm import minhash as M


def sets(text, words):
    w = "".join(c.lower() if c.isascii() else c for c in text or "").replace("\x0b", " ").replace("\x0c", " ")
    w = [x for x in w.replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if x]
    if not w:
        return set()
    return {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))}


def brute(texts, words, percent):
    s = [sets(t, words) for t in texts]
    root = list(range(len(s)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(s)):
        for j in range(i):
            both = len(s[i] & s[j])
            if both and 100 * both >= percent * len(s[i] | s[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [(len(x), find(i)) for i, x in enumerate(s)]


def corpus(seed=4):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(500)]
    texts = [None, "", " \n ", "one", "ONE", "one two", "One\tTwo", "a b a b a b", "b a", "x\u00a0y z", "x\u00a0y z"]
    for size in (12, 60, 300):
        base = rng.choices(words, k=size)
        texts.append(" ".join(base))
        for _ in range(60):
            t = list(base)
            for _ in range(rng.randint(0, size // 8)):
                t[rng.randrange(len(t))] = rng.choice(words)
            texts.append(" ".join(t))
    return texts + [" ".join(rng.choices(words, k=rng.randint(1, 80))) for _ in range(60)]


def check(spark, words, texts):
    docs = spark.createDataFrame([(i, t, "k", 0) for i, t in enumerate(texts)], "doc_id long, text string, key string, n int")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in M.near_duplicates(docs, words, 80).collect()}
    want = brute(texts, words, 80)
    assert got == dict(enumerate(want))


def test_matches_brute_force_two_words(spark):
    check(spark, 2, corpus())


def test_blocks_and_five_words(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK", 7)
    check(spark, 5, corpus(9))


def test_circulant_signature_estimates_similarity():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 1 << 63, 1000).astype(np.uint64)
    a, b = np.unique(x[:900]), np.unique(x[100:])
    assert abs((M.signature(a) == M.signature(b)).mean() - 0.8) < 0.12
    row = M._circulant()
    assert (row[5][1:] == row[6][:-1]).all() and (row[M.SLOTS - 1][1:] == row[0][:-1]).all()


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (7, 7)]
    out = dict(map(tuple, M.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert out == {**dict.fromkeys(range(41), 0), **dict.fromkeys((100, 101, 103), 100)}
    assert M.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_nulls_repeats_and_empty(spark):
    docs = spark.createDataFrame([(None, "a b c"), (5, "a b c"), (5, "a b c"), (6, "A b C"), (7, None)], "doc_id long, text string")
    got = sorted(((r.doc_id or 0), r.n_shingles, r.component_id, r.kept) for r in M.near_duplicates(docs, 2).collect())
    assert got == [(0, 2, None, True), (5, 2, 5, True), (5, 2, 5, True), (6, 2, 5, False), (7, 0, 7, True)]
    assert M.near_duplicates(docs.limit(0)).collect() == []
    assert sorted(r.doc_id or 0 for r in M.keep_one(docs, 2).collect()) == [0, 5, 7]  # rows that repeat are one document


def test_long_text(spark):
    rng = random.Random(8)
    base = [f"w{rng.randrange(9000)}" for _ in range(400_000)]
    near = [w if rng.random() > 0.01 else "x" for w in base]
    docs = spark.createDataFrame([(4, " ".join(base)), (9, " ".join(near)), (11, " ".join(base[:300_000]))], "doc_id long, text string")
    assert sorted((r.doc_id, r.component_id) for r in M.near_duplicates(docs, 2).collect()) == [(4, 4), (9, 4), (11, 11)]


def test_similar_forms_that_are_no_links(spark, monkeypatch):
    """Texts that share two thirds of their shingles fall into common buckets without being links; some are links."""
    monkeypatch.setattr(M, "BLOCK", 5)
    rng = random.Random(6)
    form = [f"f{i}" for i in range(200)]
    texts = [" ".join([*form, *(f"v{rng.randrange(10**6)}" for _ in range(45 + k % 9))]) for k in range(60)]
    texts += [t + " end" for t in texts[::7]]
    check(spark, 2, texts)
