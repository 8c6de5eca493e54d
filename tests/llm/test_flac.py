import random

import numpy as np

from pyspark.sql import functions as F

from pagemill.llm import flac


def joined(raw):
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)


def payloads():
    rng = random.Random(3)
    texts = [b"", b"a", b"x" * 192, b"x" * 193, bytes(range(256)) * 3, "é漢字 wörd ".encode() * 400]
    texts += [bytes(rng.choices(range(256), k=rng.randint(0, 2000))) for _ in range(20)]
    texts += [" ".join(rng.choices(["the", "of", "lorem", "ipsum", "\n"], k=300)).encode() for _ in range(20)]
    texts += [bytes(128 + int(100 * np.sin(i / 9)) for i in range(5000)), b"ab" * 100_000]
    texts += [bytes([0xFF, 0xF8, 0x10, 0x02, 0, 0] * 200)]
    return texts


def test_round_trip_and_kinds():
    text, at = joined(payloads())
    payload, size = flac.padded(text, at)
    media, length = flac.encode_many(payload, size)
    cut = np.concatenate([[0], np.cumsum(length)])
    back, got, sound = flac.decode_many(media, cut)
    assert sound.all() and (got == size).all() and (back == payload).all()
    _, start, header, _ = flac._find_frames(media, cut[:-1])
    kinds = set((media[start + header] >> 1).tolist())
    assert {flac.CONSTANT, flac.VERBATIM, flac.FIXED + 1, flac.FIXED + 2, flac.LINEAR + 1} <= kinds


def test_damage_is_found():
    text, at = joined([b"hello world " * 80, b"another text " * 90])
    media, length = flac.encode_many(*flac.padded(text, at))
    cut = np.concatenate([[0], np.cumsum(length)])
    for spot in [0, 20, 30, 50, 60, 200, int(length[0]) - 1]:
        bad = media.copy()
        bad[spot] ^= 4
        _, size, sound = flac.decode_many(bad, cut)
        assert not sound[0] and size[0] == 0, spot
        assert sound[1]


def test_known_crcs():
    raw = np.frombuffer(b"123456789", np.uint8)
    one = np.array([0]), np.array([9])
    assert flac.crc8(raw, *one)[0] == 0xF4
    assert flac.crc16(raw, *one)[0] == 0xFEE8


def test_rows(spark):
    rows = [(1, None, 0), (2, "", 1), (2, "", 1), (None, "abc " * 5000, 2), (3, "x", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, media int")
    out = flac.decode(flac.encode(docs)).collect()
    assert len(out) == len(rows)
    for r in out:
        text = {None: "abc " * 5000, 1: "", 2: "", 3: "x"}[r.doc_id].encode()
        full = max(1, -(-len(text) // 192)) * 192
        assert r.sound and bytes(r.pcm) == text.ljust(full) and r.n_bytes == len(text)
    stored = flac.decode_blocks(flac.encode(docs), 2).withColumn("pcm", flac.joined_blocks(F.col("pcm_blocks")))
    assert sorted((r.doc_id or 0, bytes(r.pcm), r.feature) for r in stored.collect()) == sorted((r.doc_id or 0, bytes(r.pcm), r.feature) for r in out)
    mixed = stored.select("doc_id", flac.joined_blocks(F.reverse("pcm_blocks")).alias("again"), "pcm").filter("again <> pcm")
    assert mixed.collect() == []
    blocks = flac.pcm_blocks(stored).filter("doc_id is null").collect()
    whole = ("abc " * 5000).encode().ljust(20160)
    assert len(blocks) == -(-20160 // 384)
    assert all(bytes(r.samples) == whole[r.sample_offset : r.sample_offset + 384] for r in blocks)
    assert flac.decode_blocks(flac.encode(docs.limit(0))).collect() == []
    assert flac.decode(flac.encode(docs.limit(0))).collect() == []
    broken = spark.createDataFrame([(1, b"fLaC"), (2, None)], "doc_id long, media binary")
    assert [(r.sound, r.pcm) for r in flac.decode(broken).collect()] == [(False, None)] * 2
    assert [(r.sound, r.pcm_blocks) for r in flac.decode_blocks(broken).collect()] == [(False, None)] * 2
