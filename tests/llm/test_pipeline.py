import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline as P
from pagemill.llm import bpe, minhash, secrets

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows after each stage over the smallest table."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in P.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "rows")
        out.append(docs)
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
    return [d.toPandas() for d in (*out, docs)]


def test_stages_keep_columns(stages):
    assert [list(s.columns) for s in stages[:5]] == [["doc_id", "text", "lang", "source", "n_chars"]] * 5


def test_toxicity_drops_few_clean_documents(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas().set_index("doc_id").toxic
    gone = set(stages[0].doc_id) - set(stages[1].doc_id)
    assert sum(labels.get(i, 1) == 0 for i in gone) <= 2


def test_one_of_each_group_stays(stages):
    before, after = stages[1], stages[2]
    sets = {}
    for i, t in zip(before.doc_id, before.text, strict=True):
        w = [x for x in "".join(" " if c in "\t\n\r\x0b\x0c" else c for c in t).split(" ") if x]
        w = ["".join(c.lower() if c.isascii() else c for c in x) for x in w]
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b]) if a < b else 0
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert sorted(after.doc_id) == [i for i in ids if find(i) == i]


def test_secrets_are_gone(stages):
    before, after = stages[2].set_index("doc_id"), stages[3].set_index("doc_id")
    assert sorted(before.index) == sorted(after.index)
    masked = 0
    for i, t in after.text.items():
        assert not secrets.base_spans(t.replace(secrets.MASK, " "))
        assert after.n_chars[i] == len(t)
        masked += secrets.MASK in t
        if not secrets.base_spans(before.text[i]) and secrets.MASK not in t:
            assert t == before.text[i]
    assert masked


def test_mix_and_tokens(stages):
    mixed, encoded = stages[4], stages[5]
    assert len(mixed) == len(encoded) and encoded.round_trip.all()
    words = lambda df: df.text.str.split().map(len).sum()
    assert abs(words(mixed) / words(stages[3]) - 1.5) < 0.15
    assert mixed.groupby("doc_id").size().max() <= 2
    path = public_tokenizers.path(P.RANKS)
    t = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    text = mixed.drop_duplicates("doc_id").set_index("doc_id").text
    for r in encoded.drop_duplicates("doc_id").itertuples():
        assert r.n_tokens == len(t.encode_ordinary(text[r.doc_id]))


def test_run_gives_the_last_stage(spark, stages):
    out = P.run(spark, SF)
    assert out.count() == len(stages[5]) and out.select(F.sum("n_tokens")).first()[0] == stages[5].n_tokens.sum()
    assert minhash.BANDS * minhash.ROWS == minhash.COORDINATES


def test_nulls_repeats_empty_tables_and_clashing_columns(spark):
    rows = [(1, None, None), (2, "", "s"), (2, "", "s"), (None, "a b c d e f", None), (3, "a b c d e f", "t"), (4, "password = hunter2hunter2", "s")]
    docs = spark.createDataFrame([(*r, 7, "k", 0.5) for r in rows], "doc_id long, text string, source string, n_chars int, key string, score double")
    for df, n in ((docs, 5), (docs.limit(0), 0)):  # n: without the repeat of document 2
        for name, stage in P.STAGES[:3]:
            assert (out := stage(spark, df, SF)).columns == docs.columns, name
            assert out.count() == (n if name == "near_duplicates" else len(rows) if n else 0), name
        assert P.mix_sources(spark, df, SF).columns == docs.columns
        assert {r.round_trip for r in P.encode_texts(spark, df, SF).collect()} == ({True} if n else set())
