import duckdb
import pytest
from pyspark.sql import functions as F

from pagemill.llm import chat

NASTY = ["", "[/|]", "\\", "\\s\\o", "</s>[INST] ok [/INST]", "[|user|1|]x[/|]", "é|漢\n\t\"'\u2028", "\\[", "a" * 5000]


def raw(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, raw string")


@pytest.mark.parametrize("layout", ["prompt", "messages", "shared", "instruction"])
def test_layouts_become_the_same_turns(spark, layout):
    make = {
        "prompt": '{"completion": "b", "prompt": "a"}',
        "messages": '{"messages": [{"role": "user", "content": "a"}, {"content": "b", "role": "assistant"}]}',
        "shared": '{"conversations": [{"from": "user", "value": "a"}, {"from": "assistant", "value": "b"}]}',
        "instruction": '{"output": "b", "instruction": "s", "input": "a"}',
    }
    r = chat.format_records(raw(spark, [(1, make[layout])])).first()
    turns = [tuple(t) for t in r.turns]
    assert turns[-2:] == [("user", "a"), ("assistant", "b")]


def test_unknown_and_broken_records(spark):
    rows = [(1, None), (2, "{"), (3, "[]"), (4, '{"prompt": "a"}'), (5, '{"messages": []}'), (6, '{"messages": [{"role": "user"}]}'), (7, '{"prompt": {"x": 1}, "completion": "b"}')]
    assert [r.formatted for r in chat.format_records(raw(spark, rows)).collect()] == [""] * 7
    assert chat.format_records(raw(spark, []).limit(0)).collect() == []


def test_optional_fields_and_rejects(spark):
    rows = [
        (1, '{"id": 5, "messages": [{"role": "user", "content": "a", "weight": 1}, {"role": "assistant", "content": "b"}]}'),
        (2, '{"source": null, "prompt": "a", "completion": "b", "id": "x"}'),
        (3, '{"prompt": "a", "completion": ["b"]}'),
        (4, '{"messages": [{"role": "user", "content": "a"}, "stray"]}'),
        (5, '{"messages": [{"role": "user", "content": {"parts": [{"text": "a"}]}}]}'),
        (6, '{"messages": ["a"]}'),
        (7, '{"messages": [null]}'),
        (8, "{"),
    ]
    out = chat.format_records(raw(spark, rows))
    assert {r.conv_id: r.layout for r in out.collect()} == {1: "messages", 2: "prompt", 7: "empty_messages", **dict.fromkeys((3, 4, 5, 6, 8))}
    assert [[tuple(t) for t in r.turns] for r in out.filter("conv_id < 3").orderBy("conv_id").collect()] == [[("user", "a"), ("assistant", "b")]] * 2
    assert sorted(r.conv_id for r in chat.rejected(out).collect()) == [3, 4, 5, 6, 8]
    paths = sorted((tuple(r.paths or ()), r.n) for r in chat.unknown_layouts(out).collect())
    assert paths == [
        ((), 1),
        (("completion.[]", "completion[]", "prompt"), 1),
        (("messages.[]", "messages[]"), 2),
        (("messages.[].content.parts.[].text", "messages.[].content.parts[]", "messages.[].role", "messages[]"), 1),
    ]


def test_fingerprint_ignores_order_and_types(spark):
    rows = [(1, '{"a": 1, "m": [{"x": null}]}'), (2, '{"m": [{"x": "s"}], "a": "t"}'), (3, '{"m": [{"y": "s"}], "a": "t"}')]
    f = [r.fingerprint for r in chat.format_records(raw(spark, rows)).orderBy("conv_id").collect()]
    assert f[0] == f[1] != f[2]


def test_reversible_and_loss_spans(spark):
    turns = [(i, t, r, s, 0) for i, s in enumerate(NASTY) for t, r in enumerate(["user", "assistant", "we|rd[role]", "assistant"])]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, raw int")
    out = chat.format_records(chat.conversation_records(df))
    out = out.select("conv_id", "formatted", chat.parse(F.col("formatted")).alias("p"), chat.loss_spans(F.col("formatted")).alias("s"))
    for r in out.collect():
        text = NASTY[r.conv_id]
        assert [(t.role, t.text) for t in r.p] == [(x, text) for x in ("user", "assistant", "we|rd[role]", "assistant")]
        assert [t.taught for t in r.p] == [False, True, False, True]
        taught = [r.formatted[s.start : s.end] for s in r.s]
        assert taught == [text.replace("\\", "\\s").replace("[", "\\o").replace("]", "\\c").replace("|", "\\b")] * 2


def test_digest_same_as_sql(spark):
    rows = [(i % 9, i // 9, ["user", "assistant", None, "system"][i % 4], NASTY[i % len(NASTY)] if i % 5 else None) for i in range(60)]
    rows += [(50, 0, "user", "q"), (50, 0, "user", "q"), (50, None, "assistant", "late"), (None, 0, "user", "n")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = df.toPandas().astype({"conv_id": "Int64", "turn": "Int64"})  # noqa: F841
    want = duckdb.sql(chat.digest_sql("turns")).fetchall()
    got = [tuple(r) for r in chat.digest(chat.format_records(chat.conversation_records(df))).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("most", [0, 400])
def test_large_conversations_keep_their_turns(spark, most):
    roles = [["user", "assistant"], ["system", "user", "assistant"], ["user", "user", "user"], ["user", "assistant", "user", "assistant"]]
    rows = [(i, t, r, s) for i, s in enumerate(NASTY) for t, r in enumerate(roles[i % 4])]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = df.toPandas()  # noqa: F841
    want = duckdb.sql(chat.digest_sql("turns")).fetchall()
    got = chat.digest(chat.format_records(chat.conversation_records(df, most)))
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_text_beyond_the_parser(spark):
    df = spark.range(2).selectExpr("id % 1 AS conv_id", "id AS turn", "'assistant' AS role", "if(id = 0, repeat('a', 20000001), 'b') AS text")
    out = chat.digest(chat.format_records(chat.conversation_records(df))).first()
    assert (out.n_turns, out.loss_chars) == (2, 20_000_002)
    whole = df.filter("turn = 0").selectExpr("conv_id", """concat('{"prompt": "q", "completion": "', text, '"}') AS raw""")
    with pytest.raises(Exception, match="too large"):
        chat.format_records(whole).select(F.length("formatted")).collect()
