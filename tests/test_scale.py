"""Stored layouts, filters, sketches, indexes of rules and nested blocks: results and plans."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagemill.functions import filters
from pagemill.jobs.queries import QUERIES
from pagemill.operators import blocks as B
from pagemill.operators import links as L
from pagemill.operators import pages as P
from pagemill.operators import rules as R
from pagemill.operators import sketches as K
from pagemill.operators import threads as T
from pagemill.sources import snapshots as S
from pagemill.sources.schemas import MESSAGES, PAGES


def pages(spark, rows):
    return spark.createDataFrame(rows, PAGES)


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


OLD = [(1, "http://h/a", "x"), (2, "http://h/b", "y"), (3, "http://h/c", None), (4, None, "n"), (5, None, "m"), (9, "http://h/a/", "x2"), (9, "http://h/a/", "x2")]
NEW = [(7, "http://h/a/", "x2"), (8, "http://h/b", "z"), (9, "http://h/d", "w"), (10, "http://h/c", None), (4, None, "n"), (6, None, "m")]


def test_stored_snapshots_are_compared_without_a_shuffle(spark, tmp_path):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        old = S.store_snapshot(pages(spark, OLD), "t_old", str(tmp_path / "old"), buckets=4)
        new = S.store_snapshot(pages(spark, NEW), "t_new", str(tmp_path / "new"), buckets=4)
        diff, latest = S.diff_stored(old, new), S.latest_stored(S.read_snapshot(spark, "t_old"))
        for out in (diff, latest):
            assert "Exchange" not in plan_of(out)
        assert sorted(map(repr, diff.collect())) == sorted(map(repr, P.diff_snapshots(pages(spark, OLD), pages(spark, NEW)).collect()))
        assert sorted((r.page_id, r.html) for r in latest.collect()) == [(2, "y"), (3, None), (4, "n"), (5, "m"), (9, "x2")]
        both = S.store_snapshot(pages(spark, NEW), "t_old", str(tmp_path / "old"), buckets=4, mode="append")
        out = S.latest_stored(both)
        assert "Exchange" not in plan_of(out) and sorted(r.page_id for r in out.collect()) == [4, 5, 6, 8, 9, 9, 10]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def linked(spark, n, seed=1):
    rng = random.Random(seed)
    rows = [(rng.randrange(50), i, "h", f"http://h/{int(rng.paretovariate(0.6)) if rng.random() < 0.9 else rng.randrange(10**6)}") for i in range(n)]
    return spark.createDataFrame([*rows, (1, 0, "m", None)], "page_id long, pos int, href string, target string")


def test_filtered_frontier_is_the_frontier(spark, monkeypatch):
    links, known = linked(spark, 3000), pages(spark, [(i, f"http://h/{i}", "") for i in range(0, 400, 2)] + [(9, None, "")])
    want = sorted(r.target for r in L.frontier(links, known).collect())
    assert sorted(r.target for r in L.filtered_frontier(links, known).collect()) == want
    for bits in (512, 64):  # filters that pass most keys, and none at all
        monkeypatch.setattr(filters, "MOST_BITS", bits)
        assert sorted(r.target for r in L.filtered_frontier(links, known).collect()) == want
    assert L.filtered_frontier(links, known.limit(0)).count() == len({r.target for r in links.collect() if r.target})
    assert L.filtered_frontier(links.limit(0), known).collect() == []


def test_new_targets_meet_no_known_page(spark):
    links = linked(spark, 3000)
    out = L.filtered_frontier(links, pages(spark, [(1, "http://elsewhere/x", ""), (2, "http://h/1", "")]))
    new = out._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
    assert "Aggregate" not in new and out.count() == len({r.target for r in links.collect() if r.target}) - 1


def test_filters_hold_all_their_keys(spark):
    keys = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("k"))
    assert [filters.bits_for(n) for n in (0, 8, 1 << 20, 1 << 27, 1 << 28)] == [64, 64, 1 << 23, 1 << 28, None]
    words = filters.key_filter(keys, "k", filters.bits_for(5000))
    assert keys.filter(~filters.may_hold(words, keys, "k")).count() == 0
    others = spark.range(5000, 25000).select(F.concat(F.lit("k"), "id").alias("k"))
    assert others.filter(filters.may_hold(words, others, "k")).count() < 0.06 * 20000


def test_frequent_targets_are_the_top_targets(spark):
    for seed in (1, 2):
        links = linked(spark, 4000, seed)
        for k, tracked in ((5, 1 << 16), (5, 2048), (40, 64), (10_000, 1 << 16), (1, 1024)):
            assert L.frequent_targets(links, k, tracked).collect() == L.top_targets(links, k).collect(), (k, tracked)
    assert L.frequent_targets(links.limit(0), 3).collect() == []
    out = L.frequent_targets(links, 3)
    assert "BroadcastHashJoin" in plan_of(out)  # links meet the candidates before they are shuffled


def test_merged_sketches(spark):
    events = spark.range(60_000).selectExpr("id % 30 as day", "pmod(xxhash64(id), 20000) as user", "case when id % 2 = 0 then 'a' else 'b' end as kind")
    stored = K.distinct_sketches(events, ["day", "kind"], "user")
    week = K.merge_sketches(stored, [F.floor(F.col("day") / 7).alias("week")])
    got = {r.week: (r.n, r.n_user) for r in K.distinct_counts(week).collect()}
    want = events.groupBy(F.floor(F.col("day") / 7).alias("week")).agg(F.count("*").alias("n"), F.count_distinct("user").alias("u"))
    for r in want.collect():
        assert got[r.week][0] == r.n and abs(got[r.week][1] - r.u) < 0.03 * r.u
    again = K.distinct_counts(K.merge_sketches(week, [])).first()
    assert again.n == 60_000 and abs(again.n_user - events.select("user").distinct().count()) < 600
    empty = K.distinct_counts(K.distinct_sketches(spark.createDataFrame([("a", None), ("a", 1)], "k string, user long"), ["k"], "user")).first()
    assert (empty.n, empty.n_user) == (2, 1)


def test_merged_values_are_exact(spark, tmp_path):
    day = "case when id % 1000 = 1 then null else timestamp'2024-01-01' + make_interval(0, 0, 0, id % 30) end as ts"
    user = "case when id % 1000 = 2 then null else pmod(xxhash64(id), 20000) end as user_id"
    kind = "case when id % 1000 = 3 then null when id % 2 = 0 then 'a' else 'b' end as event_type"
    spark.range(60_000).selectExpr("id as event_id", day, user, kind).write.parquet(str(tmp_path / "events.parquet"))
    got = QUERIES["ag_distinct_merged"](spark, str(tmp_path))
    events = spark.read.parquet(str(tmp_path / "events.parquet")).withColumn("week", F.to_date(F.date_trunc("week", "ts")))
    want = events.groupBy("event_type", "week").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("n_user_id"))
    assert got.columns == want.columns and sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    all_ = K.value_counts(K.merge_values(K.distinct_values(events, ["event_type", "week"], "user_id"), [], "user_id"), "user_id").first()
    assert (all_.n, all_.n_user_id) == (60_000, events.select("user_id").na.drop().distinct().count())


def test_very_many_rules_meet_by_equal_text(spark):
    n = 100_000
    rules = spark.range(n).selectExpr("cast(id % 7 as int) as prio", r"concat('^https?://x|^y') as pat", "'never' as kind").limit(1)
    many = spark.range(n).selectExpr("cast(2 + id % 7 as int) as prio", r"concat('^http://h\\.x/t', id, '(/|$)') as pat", "concat('k', id) as kind")
    rules = rules.unionByName(many).unionByName(spark.createDataFrame([(1, "special", "s"), (99, ".", "rest")], "prio int, pat string, kind string"))
    urls = ["http://h.x/t17", "http://h.x/t17/2", "http://h.x/t99999/a", "http://h.x/t17x", "http://h.x/t5/special", "http://hzx/t5", None, "http://h.x/t17"]
    p = pages(spark, [(i, u, "") for i, u in enumerate(urls)])
    out = P.classify_pages(p, rules)
    assert {r.page_id: r.kind for r in out.collect()} == dict(enumerate(["k17", "k17", "k99999", "rest", "s", "rest", None, "k17"]))
    assert "NestedLoop" not in plan_of(out)


def test_index_gives_what_the_plan_gives(spark, monkeypatch):
    rng = random.Random(2)
    patterns = [r"^http://a\.b/forum/", r"^http://a\.b/forum/x?y", "^http://a.b/fo", r"^http://a\.b/forum/(x|y)", "^http://a|^http://b", r"^(?:http)://a\.b", "forum", r"^http://a\.b/forum/[xy]+$",
                r"^http://a\.b/forum/xy{2}", "^HTTP://A", "^", "", r"^http://a\.b/forum\?p=1", r"^http://a\.b/forum/x$"]
    rules = spark.createDataFrame([(rng.randrange(4), p, f"k{i}") for i, p in enumerate(patterns)], "prio int, pat string, kind string")
    urls = ["http://a.b/forum/", "http://a.b/forum/x", "http://a.b/forum/y", "http://a.b/forum/xyy", "http://a.b/forum?p=1", "http://axb/forum/x", "http://b", "zzz", "", None]
    p = pages(spark, [(i, u, "") for i, u in enumerate(urls)])
    want = {r.page_id: r.kind for r in P.classify_pages(p, rules).collect()}
    monkeypatch.setattr(P, "MOST_RULES", 9)
    assert {r.page_id: r.kind for r in P.classify_pages(p, rules).collect()} == want
    known = {r.pat: r.literal for r in rules.select("pat", R.literal_beginning(F.col("pat")).alias("literal")).collect()}
    assert known[r"^http://a\.b/forum/x?y"] == "http://a.b/forum/" and known["^http://a|^http://b"] is None and known["forum"] is None
    assert known[r"^http://a\.b/forum\?p=1"] == "http://a.b/forum?p=1" and known[r"^http://a\.b/forum/(x|y)"] == "http://a.b/forum/" and known["^"] is None


def plain_blocks(page):
    """(name, depth, parent, closed, text) of blocks, by a plain loop."""
    import re

    page = re.sub(r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->", "", page)
    open_, found = [], []

    def end(k, stop, own):
        for j, pos in enumerate(open_[k:]):
            found[pos][3:] = [own and j == 0, page[found[pos][5] : stop]]
        del open_[k:]

    for m in re.finditer(B._tag(B.BLOCKS), page):
        name = m[1].lower().lstrip("/")
        if m[1].startswith("/"):
            at = [k for k, pos in enumerate(open_) if found[pos][0] == name]
            if at:
                end(at[-1], m.start(), True)
            continue
        if open_ and found[open_[-1]][0] == "p":
            end(len(open_) - 1, m.start(), False)
        found.append([name, len(open_), open_[-1] if open_ else None, None, None, m.end()])
        open_.append(len(found) - 1)
    end(0, len(page), False)
    text = lambda t: re.sub(r"[ \t\r\n]+", " ", re.sub(r"(?s)<[^>]*>", " ", t)).strip(" ")
    return [(i, *f[:4], text(f[4])) for i, f in enumerate(found)]


def test_nested_blocks(spark):
    html = '<body><div class="a">one<p>two<p>three</p><DIV>four<ul><li>five</ul>six</div>seven</span></section></div><pre>x</pre><p>eight<!-- <div> -->'
    rng = random.Random(8)
    bits = ["<div>", "</div>", "<p>", "</p>", "<ul><li>", "</li>", "</ul>", "<li a='b'>", "text ", "<b>é</b>", "<table><tr><td>", "</table>", "<br/>", "<h1>", "</h1>", "<pre/>"]
    made = ["".join(rng.choice(bits) for _ in range(rng.randrange(60))) for _ in range(60)]
    rows = [html, *made, "", "no tags", "</div></p>", "<p>" * 400]
    out = B.nested_blocks(pages(spark, [*((i, None, h) for i, h in enumerate(rows)), (-1, None, None)]))
    got = {}
    for r in out.collect():
        got.setdefault(r.page_id, []).append(tuple(r)[1:])
    for i, h in enumerate(rows):
        assert sorted(got.get(i, [])) == plain_blocks(h), h
    assert -1 not in got and "Exchange" not in plan_of(out)
    assert {(2, "p", 2, 1, False, "two"), (3, "p", 2, 1, True, "three"), (7, "pre", 1, 0, True, "x")} <= set(got[0])


def test_absurd_message_numbers_are_reported_as_ranges(spark):
    m = spark.createDataFrame([(1, 10**15, "a", ""), (1, 3, "a", ""), (2, 2**62, "a", ""), (3, 1, "a", ""), (4, 300_000, "a", "")], MESSAGES)
    listed = T.missing_messages(m).groupBy("thread_id").agg(F.count("*").alias("n"), F.min("seq").alias("low"), F.max("seq").alias("high"))
    assert sorted(map(tuple, listed.collect())) == [(1, 3, 0, 2), (3, 1, 0, 0), (4, 300_000, 0, 299_999)]
    rest = sorted(map(tuple, T.long_gaps(m).collect()))
    assert rest == [(1, 4, 10**15 - 1), (2, 0, 2**62 - 1)]
    assert sorted(r.seq for r in T.missing_messages(m, 10).filter("thread_id < 3").collect()) == sorted([0, 1, 2, *range(4, 11), *range(11)])
    assert T.long_gaps(m, 10).count() == 0 and T.missing_messages(m, longest=3).count() == 4


@pytest.mark.parametrize("gap", [1, 65_536, 65_537, 200_000])
def test_gaps_of_any_length(spark, gap):
    m = spark.createDataFrame([(1, 0, "a", ""), (1, gap + 1, "a", "")], MESSAGES)
    assert np.array_equal(np.sort(T.missing_messages(m).toPandas()["seq"].to_numpy()), np.arange(1, gap + 1))
