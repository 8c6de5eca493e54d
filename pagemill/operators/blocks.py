"""Nested blocks of a page, by a fold over its tags with a stack."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions import html as H

#: Elements that are blocks.
BLOCKS = ("html", "body", "header", "nav", "main", "section", "article", "aside", "footer", "div", "ul", "ol", "li", "table", "tr", "td", "th",
          "blockquote", "pre", "form", "h1", "h2", "h3", "h4", "h5", "h6", "p")
#: A block of these ends where another block begins directly in it.
IMPLIED = "p"

_OPEN = "array<struct<pos:int,name:string>>"
_FOUND = "array<struct<pos:int,name:string,depth:int,parent:int,start:int>>"
_ENDED = "array<struct<pos:int,stop:int,closed:boolean>>"


def _tag(names: tuple[str, ...]) -> str:
    return rf"(?is)<(/?(?:{'|'.join(names)}))(?:\s[^>]*)?/?>"


def nested_blocks(pages: DataFrame, names: tuple[str, ...] = BLOCKS) -> DataFrame:
    """One row for each block of a page: (page_id, pos, name, depth, parent, closed, text).

    Blocks are numbered in the order in which they begin; depth is 0 for outermost ones, whose parent is null. An end tag
    ends the innermost open block of its name, and with it all that are open inside; one without such a block is ignored. A
    paragraph also ends where another block begins in it. What is open at the page's end, or is ended by another block's tag,
    isn't closed. text is the visible text from a block's tag to its end, blocks inside included. Scripts, styles and
    comments don't count. Null pages have no blocks.

    A row's tags are folded where the row is: nothing is shuffled. The fold's steps copy what was found before, so its cost
    grows with the square of a page's number of blocks; it is meant for pages of up to some thousands of blocks.
    """
    tag = _tag(names)
    t = pages.select("page_id", H.clean_html(F.col("html")).alias("page"))
    between = F.transform(F.split("page", tag, -1), F.length)
    t = t.select(
        "page_id",
        "page",
        F.transform(F.regexp_extract_all("page", F.lit(tag), F.lit(1)), F.lower).alias("tags"),
        F.transform(F.regexp_extract_all("page", F.lit(tag), F.lit(0)), F.length).alias("sizes"),
        between.alias("between"),
    )
    steps = F.zip_with(F.arrays_zip("tags", "sizes"), F.slice("between", F.lit(2), F.size("tags")), lambda a, b: F.struct(a["tags"].alias("tag"), a["sizes"].alias("size"), b.alias("after")))
    start = F.struct(F.array().cast(_OPEN).alias("open"), F.array().cast(_FOUND).alias("found"), F.array().cast(_ENDED).alias("ended"), F.get("between", F.lit(0)).alias("at"))
    t = t.select("page_id", "page", F.aggregate(steps, start, _step).alias("s"))
    left = _ends(F.col("s.open"), F.length("page"), F.lit(False))
    ended = F.array_sort(F.concat("s.ended", left))
    blocks = t.select("page_id", "page", F.inline(F.arrays_zip(F.col("s.found").alias("found"), ended.alias("ended"))))
    inner = F.substring("page", F.col("found.start") + 1, F.col("ended.stop") - F.col("found.start"))
    return blocks.select("page_id", "found.pos", "found.name", "found.depth", "found.parent", "ended.closed", H.page_text(inner).alias("text"))


def _ends(blocks: Column, stop: Column, first_closed: Column) -> Column:
    """Blocks that end at one place, of which the first may be closed by its own tag."""
    return F.transform(blocks, lambda b, i: F.struct(b["pos"].alias("pos"), stop.alias("stop"), (first_closed & (i == 0)).alias("closed"))).cast(_ENDED)


def _step(s: Column, step: Column) -> Column:
    """What is open, found and ended after a tag."""
    name, begins = F.ltrim(step["tag"], F.lit("/")), ~step["tag"].startswith("/")
    n, within = F.size(s["open"]), s["at"] + step["size"]
    implied = begins & F.coalesce(F.get(s["open"], n - 1)["name"] == IMPLIED, F.lit(False))
    # How many open blocks stay: all but a paragraph for a tag that begins, those before the last of its name for one that ends.
    last = F.size(s["open"]) - F.array_position(F.reverse(s["open"]["name"]), name)
    known = F.array_contains(s["open"]["name"], name)
    stay = F.when(implied, n - 1).when(begins | ~known, n).otherwise(last).cast("int")
    kept, gone = F.slice(s["open"], F.lit(1), stay), F.slice(s["open"], stay + 1, n)
    pos = F.size(s["found"])
    own = F.struct(pos.alias("pos"), name.alias("name"))
    new = F.struct(pos.alias("pos"), name.alias("name"), stay.alias("depth"), F.get(s["open"], stay - 1)["pos"].alias("parent"), within.alias("start"))
    return F.struct(
        F.when(begins, F.concat(kept, F.array(own))).otherwise(kept).cast(_OPEN).alias("open"),
        F.when(begins, F.concat(s["found"], F.array(new))).otherwise(s["found"]).cast(_FOUND).alias("found"),
        F.concat(s["ended"], _ends(gone, s["at"], ~begins)).cast(_ENDED).alias("ended"),
        (within + step["after"]).alias("at"),
    )


def nested_blocks_sql(clean: str, text: str, names: tuple[str, ...] = BLOCKS) -> str:
    """The same in DuckDB SQL. clean: SQL of a page without scripts, styles and comments; text: SQL of the visible text of a
    column ``html``."""
    tag = _tag(names)
    return rf"""
    WITH RECURSIVE page AS (SELECT page_id, {clean} AS page FROM pages),
    t AS (SELECT page_id, page, [lower(x) FOR x IN regexp_extract_all(page, '{tag}', 1)] AS tags,
        [length(x) FOR x IN regexp_extract_all(page, '{tag}', 0)] AS sizes, [length(x) FOR x IN regexp_split_to_array(page, '{tag}')] AS gaps FROM page),
    token AS (SELECT page_id, i, tags[i] AS tag, ltrim(tags[i], '/') AS name, tags[i] NOT LIKE '/%' AS begins,
        (list_sum(gaps[1:i]) + coalesce(list_sum(sizes[1:i - 1]), 0))::INT AS at, sizes[i] AS size FROM (SELECT *, unnest(range(1, len(tags) + 1)) AS i FROM t)),
    fold AS (SELECT page_id, 0::BIGINT AS i, []::VARCHAR[] AS names, []::BIGINT[] AS ids, 0::BIGINT AS stay FROM page
      UNION ALL
      SELECT page_id, i, CASE WHEN begins THEN list_append(names[1:stay], name) ELSE names[1:stay] END,
        CASE WHEN begins THEN list_append(ids[1:stay], i) ELSE ids[1:stay] END, stay
      FROM (SELECT f.page_id, k.i, k.name, k.begins, f.names, f.ids, CASE WHEN k.begins AND f.names[-1] = '{IMPLIED}' THEN len(f.names) - 1
              WHEN k.begins OR NOT list_contains(f.names, k.name) THEN len(f.names)
              ELSE len(f.names) - list_position(list_reverse(f.names), k.name) END AS stay
            FROM fold f JOIN token k ON k.page_id = f.page_id AND k.i = f.i + 1)),
    life AS (SELECT page_id, id, max(i) + 1 AS stop FROM (SELECT page_id, i, unnest(ids) AS id FROM fold) GROUP BY ALL),
    block AS (SELECT k.page_id, k.i, k.name, f.stay, CASE WHEN f.stay > 0 THEN f.ids[f.stay] END AS inside, coalesce(e.tag = '/' || k.name, false) AS closed,
        k.at + k.size AS start, e.at AS stop
      FROM token k JOIN fold f ON f.page_id = k.page_id AND f.i = k.i JOIN life l ON l.page_id = k.page_id AND l.id = k.i
      LEFT JOIN token e ON e.page_id = k.page_id AND e.i = l.stop WHERE k.begins),
    numbered AS (SELECT *, (row_number() OVER (PARTITION BY page_id ORDER BY i) - 1)::INT AS pos FROM block)
    SELECT page_id, pos, name, depth, parent, closed, {text} AS text FROM (
      SELECT b.page_id, b.pos, b.name, b.stay::INT AS depth, p.pos AS parent, b.closed,
        substr(page, b.start + 1, coalesce(b.stop, length(page)) - b.start) AS html
      FROM numbered b JOIN page USING (page_id) LEFT JOIN numbered p ON p.page_id = b.page_id AND p.i = b.inside)"""
