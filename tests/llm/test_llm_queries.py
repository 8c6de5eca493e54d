"""The registered queries over the smallest tables: against their SQL, the public library, or brute force."""

import hashlib
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from test_repeats import brute as repeats_brute

from pagemill.llm import bpe, secrets
from pagemill.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text or "" for r in rows}


def run(spark, name):
    rows = QUERIES[name](spark, SF).collect()
    return {r.doc_id: r for r in rows}


def sha(raw):
    return hashlib.sha256(raw).hexdigest()


def plain(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    cur = con.execute(ORACLE_SQL[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted((tuple(plain(r[names.index(c)]) for c in df.columns) for r in cur.fetchall()), key=repr)
    assert sorted((tuple(map(plain, r)) for r in df.collect()), key=repr) == want


def test_op1_scores_every_document(spark, texts):
    rows = run(spark, "op1_toxicity")
    assert rows.keys() == texts.keys()
    for r in rows.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)


def test_op2_against_brute_force(spark, texts):
    rows, ids = run(spark, "op2_repeats"), list(texts)
    for i, (n, removed, spans, kept) in zip(ids, repeats_brute([texts[i] for i in ids]), strict=True):
        assert tuple(rows[i])[1:] == (n, removed, spans, sha(kept)), i


def test_op5_against_library(spark, texts):
    rows = run(spark, "op5_bpe")
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    t = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for i, text in texts.items():
        ids = t.encode_ordinary(text)
        assert tuple(rows[i])[1:] == (len(ids), sha(np.array(ids, "<u4").tobytes()), sha(text.encode()))


def test_op6_base_against_plain_expressions(spark, texts):
    assign = re.compile(r"""(?a:(?i:(password|passwd|secret|token|api_?key)))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    for i, r in run(spark, "op6_secrets").items():
        found = [(m.start(), 0, m.end()) for m in assign.finditer(texts[i]) if len(m[2]) >= 12]
        found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", texts[i]) if len(m[0]) >= 18]
        found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", texts[i]) if len(m[0]) >= 16]
        said = [f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in sorted(found)]
        assert r.base_sha256 == sha(",".join(said).encode())
        assert [sum(k == n for _, k, _ in found) for n in range(3)] == [r.n_assign, r.n_access, r.n_hex]
        assert set(said) <= set(r.spans.split(",")) | {""}


def test_op7_round_trip(spark, texts):
    for i, r in run(spark, "op7_flac").items():
        raw = texts[i].encode()
        payload = raw.ljust(max(1, -(-len(raw) // 192)) * 192)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256) == (len(raw), len(payload), sha(payload))
        assert r.tail_crc32 == zlib.crc32(payload[-16:]) and r.media_bytes > 42 and r.feature
