import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagemill.llm import collocations as C

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, least, most, covered, top):
    words, phrases, total = defaultdict(Counter), defaultdict(Counter), Counter()
    lower = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(lower)):
            w = [x for x in re.split("[ \t]+", piece) if x]
            total[lang] += len(w)
            for k in range(1, most + 1):
                for i in range(len(w) - k + 1):
                    phrases[lang][tuple(w[i : i + k])] += 1
    out = []
    for lang, f in phrases.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        dropped = set()
        for p, a in candidates.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p) and 100 * a >= covered * f[p[i:j]]:
                        dropped.add(p[i:j])
        scored = []
        for p, a in candidates.items():
            if p not in dropped:
                s, _, l, r = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                scored.append((-s, -a, " ".join(p).encode(), l, r))
        out += [(lang, i + 1, p.decode(), -a, l, r, total[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(scored)[:top])]
    return sorted(out)


def made(seed, n=400):
    rng = random.Random(seed)
    words = ["a", "b", "The", "the", "THE", "é", "É", "c d", "x-y", "中", "e" * 40, "\x01"]
    texts = []
    for _ in range(n):
        picks = [rng.choice(words[: rng.randint(1, len(words))]) for _ in range(rng.randint(0, 40))]
        texts.append("".join(w + rng.choice([" ", " ", "\t", "  ", ". ", ",", "\n", " \r\n", ";", " | "]) for w in picks))
    rows = [(t, rng.choice(["en", "en", "de", None, "und", ""])) for t in texts]
    return rows + [rows[3]] * 30 + [(None, "en"), ("", None), ("a b", "fr"), ("   \t", "en")]


def held_to(spark, rows, least, most, covered, top):
    df = spark.createDataFrame([(t, g, 1, "x") for t, g in rows], "text string, lang string, n int, words string")
    out = C.collocations(df, least, most, covered, top)
    assert out.columns == COLUMNS
    assert sorted(map(tuple, out.collect())) == brute(rows, least, most, covered, top)


def test_against_brute_force(spark):
    held_to(spark, made(1), 10, 3, 50, 2000)


def test_longer_phrases_and_first_ranks(spark):
    held_to(spark, made(2, 200), 5, 5, 70, 40)


def test_prefixes_in_parts_and_in_small_rows(spark, monkeypatch):
    monkeypatch.setattr(C, "SPLIT", 100)
    monkeypatch.setattr(C, "PACKED", 7)
    monkeypatch.setattr(C, "SLICE", 500)
    split = C._split(C.count_words(spark.createDataFrame(made(3), "text string, lang string").withColumn("lang", F.coalesce("lang", F.lit("und"))), 10)[0])
    assert any((parts > 2).any() for _, parts in split.values())
    held_to(spark, made(3), 10, 3, 50, 2000)
    held_to(spark, made(4, 150), 4, 4, 50, 2000)
    monkeypatch.setattr(C, "MOST_SPLIT", 2)  # the bound doubles
    held_to(spark, made(3), 10, 3, 50, 2000)


def test_words_that_share_a_hash(spark, monkeypatch):
    rows = [("ab ba ab", "en")] * 12 + [("ab dc", "en"), ("cd", "en")]
    texts = spark.createDataFrame(rows, "text string, lang string")
    one = np.uint64(1)  # under which words of the same letters share a hash
    monkeypatch.setattr(C, "BASES", (one, C.BASES[0]))
    assert C.count_words(texts, 10)[2] == C.BASES[1] and C.count_words(texts.filter("text = 'cd' or text = 'ab dc'"), 10)[2] == one
    held_to(spark, rows, 10, 3, 50, 2000)
    monkeypatch.setattr(C, "BASES", (one,))
    with pytest.raises(ValueError, match="share"):
        C.count_words(texts, 10)


def test_nothing_frequent(spark):
    for rows in ([], [(None, None)], [("", "en")], [("a b c", "en")]):
        df = spark.createDataFrame(rows, "text string, lang string")
        out = C.collocations(df)
        assert out.collect() == [] and out.columns == COLUMNS


def test_very_long_text(spark):
    text = "one two three, " * 300_000 + "w" * 3_000_000 + " one two"
    got = [tuple(r) for r in C.collocations(spark.createDataFrame([(text, "en")], "text string, lang string")).collect()]
    assert got == [("en", 1, "one two three", 300_000, 300_001, 300_000, 900_003, 999_996)]
