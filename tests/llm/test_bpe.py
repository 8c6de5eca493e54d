import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from pagemill.llm import bpe

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TEXTS = [
    "", " ", "  ", "\n", " \n x", "a", "it's we've they'll I'm he'd can't 're", "''s x's 's's'll'llx  'tis", "x!'s '!s",
    "a  b\t\tc \n\n d   ", "12 345abc6 ½ Ⅷ", "héé ñ ß 漢字かな 😀😀 é", "  x　 y\u0085z\x1c\x1d", "aaaa" * 300,
    " " * 700, "'", "'l", "'ll", "don'", "a'lL 'S 'RE", "x\r\n\r\ny", "<|endoftext|>", "﻿​ zero", "a" * 255 + "'s", "b" * 254 + "'ll z",
]


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})


def joined(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)


def test_matches_tiktoken(reference):
    rng = random.Random(5)
    alphabet = ["'", "s", "l", "re", "a", " ", "  ", "\n", "1", "é", "!", ".", "漢", "'ll", "\t", "ve", "D"]
    texts = TEXTS + ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(3000)]
    ids, counts = bpe.Encoder(RANKS).encode(*joined(texts))
    at = np.concatenate([[0], np.cumsum(counts)])
    for i, t in enumerate(texts):
        assert ids[at[i] : at[i + 1]].tolist() == reference.encode_ordinary(t), t


def test_classes_match_tiktoken():
    ranks = {bytes([i]): i for i in range(256)}
    table = bpe.class_table()
    for kind, pattern in ((bpe.LETTER, r"\p{L}"), (bpe.NUMBER, r"\p{N}"), (bpe.SPACE, r"\s")):
        t = tiktoken.Encoding("c", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        have = [i for i in range(0x30000) if not 0xD800 <= i < 0xE000 and t.encode_ordinary(chr(i))]
        mine = np.flatnonzero(table[:0x30000] == kind)
        assert sorted(set(have) ^ set(mine.tolist()))[:20] == []


def test_encode_decode_rows(spark, reference):
    rows = [(i, t, 1) for i, t in enumerate(TEXTS)] + [(99, None, 1), (99, None, 1), (None, "x y", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    out = bpe.decode(bpe.encode(docs, RANKS), RANKS).collect()
    assert len(out) == len(rows)
    texts = {(i, t) for i, t, _ in rows}
    for r in out:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        text = bytes(r.decoded).decode()
        assert (r.doc_id, text or None) in texts or (r.doc_id, text) in texts
        assert ids == reference.encode_ordinary(text)
        ends = np.frombuffer(r.ends, "<u4")
        assert len(ends) == len(ids) and (not len(ends) or ends[-1] == len(text.encode()))
    assert bpe.encode(docs.limit(0), RANKS).collect() == []
    plain = bpe.decode(bpe.encode(docs, RANKS, with_offsets=False), RANKS).collect()
    assert sorted(bytes(r.decoded) for r in plain) == sorted(bytes(r.decoded) for r in out)


def test_offsets_find_tokens(spark, reference):
    text = "héllo wörld, 漢字 and some more words"
    encoded = bpe.encode(spark.createDataFrame([(1, text), (2, "x"), (3, None)], "doc_id long, text string"), RANKS)
    rows = {r.doc_id: r for r in bpe.tokens_between(encoded, 9, 20).collect()}
    part = reference.decode_bytes(np.frombuffer(rows[1].part_ids, "<u4").tolist())
    raw, begin = text.encode(), rows[1].part_begin
    assert begin <= 9 and raw[begin : begin + len(part)] == part and begin + len(part) >= 20 and len(part) < 30
    assert bytes(rows[2].part_ids) == bytes(rows[3].part_ids) == b""


def test_scanner_is_built_for_the_pattern():
    assert public_tokenizers.PATTERN == bpe.PATTERN


def test_long_piece(reference):
    text = "ab" * 20000 + "zqj" * 3000
    ids, _ = bpe.Encoder(RANKS).encode(*joined([text]))
    assert ids.tolist() == reference.encode_ordinary(text)
    assert hashlib.sha256(text.encode()).digest()
