import html
import html.entities
import random

import pytest
from pyspark.sql import functions as F

from pagemill.functions import html as H
from pagemill.functions.urls import canonical_url, resolve_href, url_host
from pagemill.jobs import workflows as W
from pagemill.operators import links as L
from pagemill.operators import pages as P
from pagemill.sources.tables import read_pages, write_records


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def one(spark, column, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in df.select("i", column(F.col("v")).alias("x")).orderBy("i").collect()]


def test_canonical_url(spark):
    got = one(spark, canonical_url, "https://www.a.b/c.html?x=1#t", "http://m.a.b/c/", "http://a.b", None, "not a url/")
    assert got == ["a.b/c", "a.b/c", "a.b", None, "not a url"]


def test_canonical_url_keeps_named_parameters(spark):
    got = one(spark, lambda c: canonical_url(c, ("page", "sort")), "http://a/t?x=1&page=2&sort=z#f", "http://a/t?xpage=2", "http://a/t")
    assert got == ["a/t?page=2&sort=z", "a/t", "a/t"]


def test_host_of_bad_urls_is_null(spark):
    assert one(spark, url_host, "http://h.x:80/p", "http://[bad", "", None) == ["h.x", None, None, None]


def test_entities_decode_once(spark):
    assert one(spark, H.decode_entities, "&amp;lt; &lt; &quot;&amp;", None) == ["&lt; < \"&", None]
    assert one(spark, H.decode_all_entities, "&amp;lt; &eacute; &#233; &#x41;", None) == ["&lt; é é A", None]


def test_all_entities_as_the_standard_library(spark):
    rng = random.Random(4)
    names = [*html.entities.html5, "amp", "notit;", "nosuch;", "#65", "#x1F600;", "#128;", "#x9f", "#0;", "#xD800;", "#1114112;", "#13;", "#11;", "#xFFFE;",
             "#x1FFFF;", "#99999999999999999999;", "#;", "#x;", "#xg", "#000000000000065;", "#160", "#xfdd0;", "#12;", "#9;"]
    texts = ["", "&", "&&amp;&", "a & b;", "&amp;amp;lt;", "&ampx &notin; &notx &Not", *(f"x&{n} y&{n}z" for n in names[-24:])]
    texts += ["".join(f"{rng.choice(['', ' ', 'a', ';', '<'])}&{rng.choice(names)}" for _ in range(9)) for _ in range(400)]
    assert one(spark, H.decode_all_entities, *texts) == [html.unescape(t) for t in texts]


def test_title_and_text(spark):
    page = "<html><TITLE>a\nb</TITLE><script>x = '</p>'</script><!-- c --><p>one <b>two</b>\t\n</p>"
    assert one(spark, H.page_title, page, "<title></title>", "none", None) == ["a\nb", None, None, None]
    assert one(spark, H.page_text, page, "", None) == ["a b one two", "", None]


def test_blocks_swallow_unclosed_ones(spark):
    out = P.extract_blocks(pages(spark, [(1, "u", "<p>a<p>b</p><script>'</p>'</script><p>c</p><p>d"), (2, "u", None)]))
    assert [(r.pos, r.block) for r in out.orderBy("pos").collect()] == [(0, "a<p>b"), (1, "c")]


def test_truncated_pages_split_the_table(spark):
    p = pages(spark, [(1, "u", "<html></html>\n"), (2, "u", "<html>"), (3, "u", None), (4, "u", "")])
    assert sorted(r.page_id for r in P.truncated_pages(p).collect()) == [2, 3, 4]
    assert [r.page_id for r in P.truncated_pages(p, keep=False).collect()] == [1]


def test_links_resolve(spark):
    tags = """<a href="/a"><a class=x href = 'http://o/b'><a\tHREF="../c"><a href=d?e#f><a data-href="no" href="//e/f"><a name=q><abbr href="/no">
        <a href="mailto:x@y"><a href=""><a href="?p=2"><a href="#t"><a href="../../../g/./h/.."><a rel="x" href=" /i/../j ">"""
    out = L.extract_links(pages(spark, [(1, "https://h/x/y?q", tags), (2, None, tags), (3, "https://h", '<a href="k">')]))
    got = [(r.href, r.target) for r in out.filter("page_id = 1").orderBy("pos").collect()]
    assert got == [
        ("/a", "https://h/a"), ("http://o/b", "http://o/b"), ("../c", "https://h/c"), ("d?e#f", "https://h/x/d?e#f"), ("//e/f", "https://e/f"),
        ("mailto:x@y", None), ("", "https://h/x/y"), ("?p=2", "https://h/x/y?p=2"), ("#t", "https://h/x/y?q#t"), ("../../../g/./h/..", "https://h/g/"),
        (" /i/../j ", "https://h/j"),
    ]
    assert [r.target for r in out.filter("page_id = 2 and target is not null").collect()] == ["http://o/b"]
    assert [r.target for r in out.filter("page_id = 3").collect()] == ["https://h/k"]
    df = spark.createDataFrame([("bad", "/a")], "b string, h string")
    assert df.select(resolve_href(F.col("b"), F.col("h")).alias("x")).first().x is None


def test_blocks_and_titles_with_attributes(spark):
    out = P.extract_blocks(pages(spark, [(1, "u", '<P class="x">a</p ><pre>no</pre><p\nid=1>b</P><p>c</p>')]))
    assert [r.block for r in out.orderBy("pos").collect()] == ["a", "b", "c"]
    assert one(spark, H.page_title, '<title lang="en">t</title>') == ["t"]


def test_frontier_and_internal_links_part_the_targets(spark):
    p = pages(spark, [(1, "http://h/a.html", '<a href="/b"><a href="/c"><a href="/c?x=1">'), (2, "https://www.h/b/", '<a href="/a">')])
    links = L.extract_links(p)
    assert sorted(r.target for r in L.internal_links(links, p).collect()) == ["h/a", "h/b"]
    assert [r.target for r in L.frontier(links, p).collect()] == ["h/c"]
    counts = {r.target: (r.n_links, r.n_pages) for r in L.inlink_counts(links.unionByName(links)).collect()}
    assert counts["http://h/b"] == (2, 1)
    assert [r.target for r in L.top_targets(links, 2).collect()] == ["http://h/b", "http://h/c"]


def test_latest_pages_one_row_each(spark):
    p = pages(spark, [(1, "http://h/a", "old"), (5, "http://www.h/a/", "new"), (3, "http://h/a.html", "mid"), (2, "http://h/b", None), (4, None, "x")])
    out = {r.canon: (r.page_id, r.html) for r in P.latest_pages(p).collect()}
    assert out == {"h/a": (5, "new"), "h/b": (2, None), None: (4, "x")}
    assert [(r.page_id, r["rank"]) for r in P.recent_rank(p, 2).filter("canon = 'h/a'").orderBy("rank").collect()] == [(5, 1), (3, 2)]


def test_latest_pages_with_repeated_and_null_keys(spark):
    rows = [(1, "http://h/a", "x"), (1, "http://h/a/", "y"), (2, "http://h/b", "z"), (2, "http://h/b", "z"), (None, "http://h/c", "n"), (None, None, "p")]
    p = pages(spark, [*rows, (7, None, "q"), (7, None, "r"), (7, None, "r")])
    out = sorted(((r.canon or "", r.page_id or 0, r.html) for r in P.latest_pages(p).collect()))
    rank = {r.html: r.d for r in p.select("html", F.xxhash64("page_id", "url", "html", "page_id").alias("d")).collect()}
    assert out == [("", 0, "p"), ("", 7, "q"), ("", 7, "r"), ("h/a", 1, max("xy", key=rank.get)), ("h/b", 2, "z"), ("h/c", 0, "n")]
    fetched = p.withColumn("at", F.when(F.col("html") == "x", 9).otherwise(3))
    assert [r.html for r in P.latest_pages(fetched, order="at").filter("canon = 'h/a'").collect()] == ["x"]
    records = W.current_page_records(p, spark.createDataFrame([(1, "b$", "bee")], "prio int, pat string, kind string"))
    assert len(records.columns) == 7 and records.count() == 6 and [r.kind for r in records.filter("kind is not null").collect()] == ["bee"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def scans(df):
    return plan_of(df).count("FileScan parquet")


def test_bodies_are_read_once_and_not_sorted(spark, tmp_path, monkeypatch):
    pages(spark, [(1, "http://h/a", "x"), (2, "http://h/a/", "y"), (3, "http://h/b", "z")]).write.parquet(str(tmp_path / "p"))
    p = read_pages(spark, str(tmp_path / "p"))
    out = P.latest_pages(p)
    assert sorted(r.html for r in out.collect()) == ["y", "z"]
    plan = plan_of(out)
    assert scans(out) == 2 and "BroadcastHashJoin" in plan and "Sort" not in plan and "hashpartitioning" not in plan
    assert scans(W.current_page_records(p, spark.createDataFrame([(1, "b$", "bee")], "prio int, pat string, kind string"))) == 2
    monkeypatch.setattr(P, "MOST_WINNERS", 0)
    out = P.latest_pages(p)
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert sorted(r.html for r in out.collect()) == ["y", "z"] and "SortMergeJoin" not in plan and "ShuffledHashJoin" in plan


def test_pages_of_a_thread_stay_apart(spark):
    p = pages(spark, [(1, "http://h/t?page=1", "one"), (2, "http://h/t?page=2&x=1", "two"), (3, "http://h/t?page=2", "two again")])
    assert {(r.canon, r.html) for r in P.latest_pages(p, keep_params=("page",)).collect()} == {("h/t?page=1", "one"), ("h/t?page=2", "two again")}
    assert [r.html for r in P.latest_pages(p).collect()] == ["two again"]


def test_diff_snapshots_covers_all_keys(spark):
    old = pages(spark, [(1, "http://h/a", "x"), (2, "http://h/b", "y"), (3, "http://h/c", None), (4, None, "n"), (5, None, "m")])
    new = pages(spark, [(7, "http://h/a/", "x"), (8, "http://h/b", "z"), (9, "http://h/d", "w"), (10, "http://h/c", None), (4, None, "n"), (6, None, "m")])
    out = sorted((r.canon or "", r.old_id or r.new_id, r.state) for r in P.diff_snapshots(old, new).collect())
    assert out == [("", 4, "same"), ("", 5, "gone"), ("", 6, "new"), ("h/a", 1, "same"), ("h/b", 2, "changed"), ("h/c", 3, "same"), ("h/d", 9, "new")]
    assert {r.state for r in P.diff_snapshots(old, new.limit(0)).collect()} == {"gone"}


def test_rules(spark):
    p = pages(spark, [(1, "http://h/t.html", "<h1></h1><title>T</title>"), (2, "http://h/x", "<h1>H</h1>"), (3, None, "<h1>N</h1>"), (4, "ftp", "")])
    rules = spark.createDataFrame([(2, "http", "any"), (1, r"\.html$", "article")], "prio int, pat string, kind string")
    kinds = P.classify_pages(p, rules)
    assert {r.page_id: r.kind for r in kinds.collect()} == {1: "article", 2: "any", 3: None, 4: None}
    fields = spark.createDataFrame(
        [("article", "title", 1, "<h1>(.*?)</h1>"), ("article", "title", 2, "<title>(.*?)</title>"), ("any", "title", 1, "<h2>(.*?)</h2>")],
        "kind string, field string, prio int, pattern string",
    )
    out = P.extract_fields(P.with_kind(p, rules), fields)
    assert {r.page_id: (r.field, r.value) for r in out.collect()} == {1: ("title", "T"), 2: ("title", None)}
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        P.classify_pages(p, rules.crossJoin(spark.range(600)))


def test_write_and_read(spark, tmp_path):
    p = pages(spark, [(1, "http://h/a", "x"), (2, None, None)])
    write_records(p, str(tmp_path / "p"))
    assert sorted(map(tuple, read_pages(spark, str(tmp_path / "p")).collect())) == [(1, "http://h/a", "x"), (2, None, None)]
    p.write.json(str(tmp_path / "p.json"))
    assert read_pages(spark, str(tmp_path / "p.json")).count() == 2


def test_empty_tables(spark):
    p = pages(spark, [])
    for out in (P.page_records(p), P.latest_pages(p), L.extract_links(p), P.extract_blocks(p), P.page_cube(p).filter("level < 3"), P.diff_snapshots(p, p)):
        assert out.collect() == []
