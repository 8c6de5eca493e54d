import random

from pagemill.llm import secrets as S

KEY = "aB3dE5fG7hJ9kL1mN2pQ"


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, key string, base int")


def linked_brute(text, scope):
    base = S.base_spans(text)
    weak = S.weak_spans(text, base)
    parts = [(S.PART[S.KINDS[k]], s) for k, s, _ in base + weak]
    near = lambda part, s: any(p == part and abs(x - s) <= scope for p, x in parts)
    kept = [w for w in weak if all(near(p, w[1]) for p in S.NEEDS[S.KINDS[w[0]]])]
    return [(S.KINDS[k], s, e) for s, k, e in sorted((s, k, e) for k, s, e in base + kept)]


def texts():
    rng = random.Random(8)
    parts = ["password = hunter2hunter2", "client_id: bob", KEY, "https://api.example.org/v1", "AKIA" + "Q" * 16, "0123456789abcdef01", "é" * 30]
    out = [None, "", KEY, "token: short", "tOKEN : 'abcdefghijkl'", "secret: token: abcdefghijklmnop", "AKIA" + "A" * 13, "xAKIA" + "A" * 14]
    for _ in range(60):
        out.append(" ".join(rng.choice(parts) + " z" * rng.randint(0, 250) for _ in range(rng.randint(1, 9))))
    return out


def test_links_match_brute_force(spark):
    t = texts()
    for r in S.find_secrets(frame(spark, t)).collect():
        got = [(S.KINDS[s.kind], s.start, s.end) for s in r.spans]
        assert got == linked_brute(t[r.doc_id] or "", S.SCOPE), r.doc_id


def test_base_by_hand():
    spans = lambda t: [(S.KINDS[k], t[s:e]) for k, s, e in S.base_spans(t)]
    assert spans("my Api_Key\"  : 'abcdefghijkl' ok") == [("assign", "Api_Key\"  : 'abcdefghijkl")]
    assert spans("token: short") == [] and spans("AKIA" + "A" * 13) == []
    assert spans("AKIA" + "A" * 14) == [("access", "AKIA" + "A" * 14)]
    assert spans("g0123456789abcdefg") == [("hex", "0123456789abcdef")]
    assert spans("pa\u017f\u017fword=abcdefghijkl") == []


def test_weak_needs_its_complement():
    near, far = f"client_id: bob {KEY}", "client_id: bob" + " z" * 300 + KEY
    assert [k for k, _, _ in linked_brute(near, S.SCOPE)] == ["id", "secret"]
    assert linked_brute(far, S.SCOPE) == [] and linked_brute(KEY, S.SCOPE) == []


def test_long_and_endpoint_secrets(spark):
    long = KEY * 40
    t = [
        f"client_id: bob {long} end",
        "see ftp://ann:hunter2@files.example.org/a?b=c now",
        f"client_id: bob https://api.example.org/v1?key={KEY}&page=2#t={KEY}",
        f"client_id: bob https://{KEY}@api.example.org/{KEY}",
        "https://ann@files.example.org/a " + "z" * 900,
    ]
    for r in S.find_secrets(frame(spark, t)).collect():
        assert [(S.KINDS[s.kind], s.start, s.end) for s in r.spans] == linked_brute(t[r.doc_id], S.SCOPE)
    out = {r.doc_id: r.text for r in S.redact(frame(spark, t)).collect()}
    assert out[0] == "client_id: [redacted] [redacted] end"
    assert out[1] == "see ftp://[redacted]:[redacted]@files.example.org/a?b=c now"
    assert out[2] == "client_id: [redacted] https://api.example.org/v1?key=[redacted]&page=2#t=[redacted]"
    assert out[3] == f"client_id: [redacted] https://[redacted]@api.example.org/{KEY}"
    assert out[4] == t[4]


def test_redact(spark):
    t = texts() + ["é client_id: bob " + KEY + " end"]
    docs = frame(spark, t)
    out = {r.doc_id: r for r in S.redact(docs).collect()}
    assert len(out) == len(t) and S.redact(docs).columns == docs.columns
    assert out[len(t) - 1].text == "é client_id: [redacted] [redacted] end"
    assert out[0].text is None and out[1].text == "" and out[2].text == KEY
    assert all("hunter2hunter2" not in (r.text or "") for r in out.values())
    assert S.redact(docs.limit(0)).collect() == []
