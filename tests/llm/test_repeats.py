import random
from collections import Counter

import numpy as np

from pagemill.llm import repeats


def brute(texts, length=repeats.LENGTH):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        cover = np.zeros(len(r), bool)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                cover[i : i + length] = True
        edge = np.diff(cover.astype(int), prepend=0, append=0)
        out.append((len(r), int(cover.sum()), int((edge == 1).sum()), np.frombuffer(r, np.uint8)[~cover].tobytes()))
    return out


def corpus():
    rng = random.Random(11)
    words = ["".join(rng.choices("abcdefghié ", k=rng.randint(1, 9))) for _ in range(400)]
    text = lambda n: " ".join(rng.choices(words, k=n))
    passage, other = text(120), text(60)
    rows = [None, "", "short", text(300), text(300)]
    rows += [rows[3], rows[4][:250] + "X" + rows[4][251:]]
    rows += [text(rng.randint(0, 60)) + passage + text(rng.randint(0, 60)) for _ in range(40)]
    rows += [text(5) + passage[50:300] + text(5) + other[:200] + text(3), other[:200], other[:199], text(30) + other[1:201]]
    rows += ["a" * 199, "b" * 200, "c" * 201, "d" * 1000, "ef" * 150, ("0123456789" * 21)[:205], passage + passage]
    edited = rows[3]
    for _ in range(6):
        i = rng.randrange(len(edited))
        edited = edited[:i] + rng.choice(["", "zz", "q"]) + edited[i + 1 :]
        rows.append(edited)
    return rows


def check(spark, texts):
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, key int")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in repeats.remove_repeats(docs).collect()}
    for i, want in enumerate(brute(texts)):
        assert got[i] == want, (i, got[i][:3], want[:3])


def test_matches_brute_force(spark):
    check(spark, corpus())


def test_hot_anchors_are_split(spark, monkeypatch):
    monkeypatch.setattr(repeats, "HOT", 5)
    check(spark, corpus())


def test_repeated_rows_and_empty(spark):
    docs = spark.createDataFrame([(1, "x y" * 100), (1, "x y" * 100), (None, None)], "doc_id long, text string")
    out = sorted((r.n_bytes, r.n_removed) for r in repeats.remove_repeats(docs).collect())
    assert out == [(0, 0), (300, 300), (300, 300)]
    assert repeats.remove_repeats(docs.limit(0)).collect() == []


def test_small_batches_meet_in_levels(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BATCH", 150)
    monkeypatch.setattr(repeats, "COMPARED", 32)
    check(spark, corpus())


def test_long_text(spark):
    rng = random.Random(3)
    long = "".join(rng.choices("abcdefgh \n", k=3_000_000))
    docs = spark.createDataFrame([(1, long), (2, long[500_000:500_400]), (3, "z")], "doc_id long, text string")
    out = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in repeats.remove_repeats(docs).collect()}
    assert out == {1: (3_000_000, 400, 1), 2: (400, 400, 1), 3: (1, 0, 0)}


def bytes_of(rng, n):
    return np.frombuffer(bytes(rng.choices(b"ab", weights=(9, 1), k=n)), np.uint8)


def test_family_against_plain_counts():
    rng, family, seen, found, texts = random.Random(1), repeats.IndexFamily(), Counter(), set(), []
    sizes = []
    for i in range(40):
        text = bytes_of(rng, 700) if i % 3 else np.concatenate([texts[-1][50:400], bytes_of(rng, 300)]) if texts else bytes_of(rng, 650)
        texts.append(text)
        n = len(text) - repeats.LENGTH + 1
        seen.update(text[j : j + repeats.LENGTH].tobytes() for j in range(n))
        owner = np.stack([np.full(n, i), np.arange(n), np.zeros(n, int)], 1)
        found |= {tuple(o[:2]) for o in family.insert(text, np.arange(n), owner).tolist()}
        sizes.append(len(family.levels))
        for level in family.levels:
            held = [w.tobytes() for w in level.windows(np.arange(len(level)))]
            assert held == sorted(set(held))
    want = {(i, j) for i, t in enumerate(texts) for j in range(len(t) - repeats.LENGTH + 1) if seen[t[j : j + repeats.LENGTH].tobytes()] > 1}
    assert found == want and max(sizes) > 2 and len(family.levels) <= 7
    assert sum(map(len, family.levels)) == len(seen)


def test_windows_are_in_order_of_their_bytes():
    text = bytes_of(random.Random(7), 3000)
    start = np.arange(len(text) - repeats.LENGTH + 1)
    rank = repeats.window_ranks(text, start)
    windows = [text[i : i + repeats.LENGTH].tobytes() for i in start]
    place = {w: i for i, w in enumerate(sorted(set(windows)))}
    assert rank.tolist() == [place[w] for w in windows]


def test_index_meets_later_batches(spark, tmp_path):
    """Five batches in two runs: what they reveal is what brute force finds in all texts at once, and levels merge."""
    texts, folder = corpus(), str(tmp_path / "index")
    rng, spans, levels = random.Random(2), {}, []
    batches = [[] for _ in range(5)]
    for i, t in enumerate(texts):
        batches[rng.randrange(5)].append((i, t))
    for run in (batches[:2], batches[2:]):
        index = repeats.RepeatIndex(spark, folder)
        for batch in run:
            docs = spark.createDataFrame(batch, "key long, text string")
            for r in index.add(docs).collect():
                spans.setdefault(r.key, []).extend((s["begin"], s["end"]) for s in r.spans)
            levels.append([n for _, n in index.levels])
    assert max(map(len, levels)) > 1 and any(len(b) <= len(a) for a, b in zip(levels, levels[1:], strict=False))
    for i, (_, removed, n_spans, _) in enumerate(brute(texts)):
        runs = repeats.merged_spans(spans.get(i, []))
        assert (sum(e - b for b, e in runs), len(runs)) == (removed, n_spans), i


def test_rows_that_repeat_cost_in_proportion(spark):
    rng = random.Random(3)
    text = "".join(rng.choice("abcdefgh ") for _ in range(5000))
    for n in (2, 300):
        docs = spark.createDataFrame([(1, text)] * n + [(2, "x" + text[:900]), (3, text[1000:1100])], "key long, text string")
        spans = {r.key: r.spans for r in repeats.repeated_spans(docs).collect()}
        assert repeats.merged_spans(spans[1]) == [(0, 5000)] and repeats.merged_spans(spans[2]) == [(1, 901)] and 3 not in spans
        assert len(spans[1]) < 200  # whatever the number of rows
