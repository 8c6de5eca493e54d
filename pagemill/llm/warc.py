"""WARC records of pages, and a Merkle audit of replicas, with SQL functions only.

Records are laid out one after the other in archives, each with its number in its record id. A leaf hashes a record's offset
range and digest; an inner node hashes the range and the hashes of its up to FANOUT children in order. An audit compares
the roots of two trees, then only the children of nodes that differ, down to the records. Hashing a tree costs one shuffle
of short rows a level. The levels are tables in order of archive: up to LISTED archives with differing roots, the reads of
the levels below are restricted to these by a filter that reaches the scan; beyond, levels are scanned and joined.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.llm.common import delete, durable, stored

FANOUT = 16
#: Pages of an archive: a range of page ids, so that an archive's records are bounded and in order of id.
PER_ARCHIVE = 1024
#: Archives over which pages without an id are dealt.
WITHOUT_ID = 4096
#: Archives with differing roots up to which scans of the other levels are filtered.
LISTED = 1000
#: Saved pages carry no fetch time; the format asks for one.
NO_DATE = "1970-01-01T00:00:00Z"
CRLF = "\r\n"


def record(archive: Column, number: Column, url: Column, html: Column) -> Column:
    """A response record as text; a null address or page is empty."""
    return F.concat(record_head(archive, number), record_body(url, html))


def record_head(archive: Column, number: Column) -> Column:
    name = F.concat(archive.cast("string"), F.lit(":"), number.cast("string"))
    return F.concat(F.lit(f"WARC/1.0{CRLF}WARC-Type: response{CRLF}WARC-Date: {NO_DATE}{CRLF}WARC-Record-ID: <urn:record:"), name, F.lit(f">{CRLF}"))


def record_body(url: Column, html: Column) -> Column:
    """All of a record after its id."""
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    length = F.octet_length(text(html)).cast("string")
    return F.concat(F.lit("WARC-Target-URI: "), text(url), F.lit(f"{CRLF}Content-Length: "), length, F.lit(CRLF * 2), text(html), F.lit(CRLF * 2))


def archive_of(page_id: Column, url: Column, digest: Column) -> Column:
    """Number of a page's archive; pages without an id are dealt over negative ones."""
    dealt = -1 - F.pmod(F.xxhash64(url, digest), F.lit(WITHOUT_ID))
    return F.coalesce(F.floor(page_id / PER_ARCHIVE), dealt).cast("long")


def numbered(pages: DataFrame, replica: Column | None = None) -> DataFrame:
    """(archive, record_no, page_id, size, digest) of each page's record, as replica (a column of html) has it, if given.

    Numbers are in order of page_id, address and digest of the original, so that repeated rows have records of their own.
    Bodies are hashed where they are read and not shuffled: a record's digest is that of its id and its body's digest.
    """
    body = record_body(F.col("url"), F.col("html"))
    read = body if replica is None else record_body(F.col("url"), replica)
    rows = pages.select("page_id", "url", F.sha2(body, 256).alias("own"), F.octet_length(read).cast("long").alias("size"), F.sha2(read, 256).alias("digest"))
    rows = rows.withColumn("archive", archive_of(F.col("page_id"), F.col("url"), F.col("own")))
    w = Window.partitionBy("archive").orderBy("page_id", "url", "own", "digest")
    rows = rows.withColumn("record_no", F.row_number().over(w).cast("long") - 1)
    head = record_head(F.col("archive"), F.col("record_no"))
    return rows.select(
        "archive",
        "record_no",
        "page_id",
        (F.col("size") + F.octet_length(head)).alias("size"),
        F.sha2(F.concat(head, "digest"), 256).alias("digest"),
    )


def laid_out(records: DataFrame) -> DataFrame:
    """(archive, record_no, page_id, start, end, digest) of (archive, record_no, page_id, size, digest): where records lie."""
    w = Window.partitionBy("archive").orderBy("record_no").rowsBetween(Window.unboundedPreceding, 0)
    at = records.withColumn("end", F.sum("size").over(w))
    return at.select("archive", "record_no", "page_id", (F.col("end") - F.col("size")).alias("start"), "end", "digest")


def manifest(pages: DataFrame) -> DataFrame:
    """(archive, record_no, page_id, start, end, digest) for each page. A null address or page is an empty one."""
    return laid_out(numbered(pages))


def leaves(records: DataFrame) -> DataFrame:
    """Level 0 of the trees of (archive, record_no, start, end, digest)."""
    h = F.sha2(F.concat_ws(":", F.lit("leaf"), "start", "end", "digest"), 256)
    return records.select("archive", F.col("record_no").alias("node"), "start", "end", h.alias("hash"))


def parents(nodes: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """The next level: a node for each run of fanout places. At most fanout short rows meet in a group."""
    child = F.struct("node", "start", "end", "hash")
    up = nodes.groupBy("archive", F.floor(F.col("node") / fanout).alias("node")).agg(F.array_sort(F.collect_list(child)).alias("c"))
    inner = F.array_join(F.transform("c", lambda x: F.concat_ws(":", x["node"], x["hash"])), ",")
    start, end = F.array_min(F.transform("c", lambda x: x["start"])), F.array_max(F.transform("c", lambda x: x["end"]))
    h = F.sha2(F.concat_ws(":", F.lit("node"), start, end, inner), 256)
    return up.select("archive", "node", start.alias("start"), end.alias("end"), h.alias("hash"))


def tree(records: DataFrame, depth: int, fanout: int = FANOUT) -> list[tuple[DataFrame, str]]:
    """Levels from the leaves to the roots, each stored in order of archive, with its path."""
    in_order = lambda nodes: stored(nodes.sortWithinPartitions("archive", "node"))
    levels = [in_order(leaves(records))]
    for _ in range(depth):
        levels.append(in_order(parents(levels[-1][0], fanout)))
    return levels


def depth_for(records: DataFrame, fanout: int = FANOUT) -> int:
    """Levels above the leaves so that each archive has one root."""
    most = records.agg(F.max("record_no")).first()[0] or 0
    depth = 0
    while most:
        most //= fanout
        depth += 1
    return max(depth, 1)


def mismatches(ours: list[DataFrame], theirs: list[DataFrame], fanout: int = FANOUT) -> DataFrame:
    """(archive, node) of the leaves that differ or that one side lacks, found from the roots down."""
    suspects, listed = None, None
    for a, b in zip(reversed(ours), reversed(theirs), strict=True):
        if suspects is not None:
            up = suspects.withColumnRenamed("node", "up")
            if listed is not None:
                a, b = (x.filter(F.col("archive").isin(listed)) for x in (a, b))
            a, b = (
                x.withColumn("up", F.floor(F.col("node") / fanout)).join(up, ["archive", "up"], "left_semi").drop("up") for x in (a, b)
            )
        a = a.select("archive", "node", F.col("hash").alias("h_a"))
        b = b.select("archive", "node", F.col("hash").alias("h_b"))
        both = a.join(b, ["archive", "node"], "full_outer")
        first = suspects is None
        suspects = durable(both.filter(~F.col("h_a").eqNullSafe(F.col("h_b"))).select("archive", "node"))
        if first:
            roots = suspects.select("archive").limit(LISTED + 1).toArrow().column(0).to_pylist()
            listed = roots if len(roots) <= LISTED else None
    return suspects


def audit(original: DataFrame, replica: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """(archive, record_no, page_id, start, end, state): records that are altered, moved, missing or extra in the replica.

    Both sides are (archive, record_no, page_id, start, end, digest), a replica's ranges being those at which its
    records were read. A moved record has its digest at another range, as all after one that was cut out have. Equal
    sides, and two empty ones, give no rows.
    """
    spark = original.sparkSession
    original, replica = durable(original), durable(replica)
    depth = max(depth_for(original, fanout), depth_for(replica, fanout))
    ours, theirs = tree(original, depth, fanout), tree(replica, depth, fanout)
    bad = mismatches([t for t, _ in ours], [t for t, _ in theirs], fanout).withColumnRenamed("node", "record_no")
    for _, path in (*ours, *theirs):
        delete(spark, path)
    keys = ["archive", "record_no"]
    a = original.join(bad, keys, "left_semi").select(*keys, F.struct("page_id", "start", "end", "digest").alias("a"))
    b = replica.join(bad, keys, "left_semi").select(*keys, F.struct("page_id", "start", "end", "digest").alias("b"))
    both = a.join(b, keys, "full_outer")
    at = F.coalesce("a", "b")
    state = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra")
    state = state.when(F.col("a.digest") == F.col("b.digest"), "moved").otherwise("altered")
    return both.select(*keys, at["page_id"].alias("page_id"), at["start"].alias("start"), at["end"].alias("end"), state.alias("state"))


def damaged(pages: DataFrame) -> DataFrame:
    """The manifest of a replica of the archives of pages in which some records have rotted, laid out by itself.

    Of the pages, one in 97 has another last character, and one in 389 keeps its place but can't be read. One archive in
    16 lost record 100, so that what comes after it lies elsewhere.
    """
    rotten = F.coalesce(F.col("page_id") % 97 == 13, F.lit(False)) & (F.length("html") > 0)
    html = F.when(rotten, F.concat(F.expr("left(html, length(html) - 1)"), F.lit("\u0001"))).otherwise(F.col("html"))
    held = numbered(pages, html).filter(~((F.col("archive") % 16 == 5) & (F.col("record_no") == 100)))
    return laid_out(held).filter(~F.coalesce(F.col("page_id") % 389 == 7, F.lit(False)))


def audit_sql() -> str:
    """audit(manifest, damaged) of the table pages as DuckDB SQL, for pages with ids, addresses and texts."""
    head = f"WARC/1.0{CRLF}WARC-Type: response{CRLF}WARC-Date: {NO_DATE}{CRLF}WARC-Record-ID: <urn:record:"
    size = lambda html: (
        f"strlen('{head}' || archive || ':' || record_no || '>{CRLF}WARC-Target-URI: ' || url || '{CRLF}Content-Length: ' "
        f"|| strlen({html}) || '{CRLF * 2}' || {html} || '{CRLF * 2}')"
    )
    rot = "CASE WHEN page_id % 97 = 13 AND length(html) > 0 THEN left(html, length(html) - 1) || chr(1) ELSE html END"
    so_far = "OVER (PARTITION BY archive ORDER BY record_no ROWS UNBOUNDED PRECEDING)"
    return f"""
    WITH p AS (SELECT page_id, url, html, {rot} AS rot, page_id // {PER_ARCHIVE} AS archive,
        row_number() OVER (PARTITION BY page_id // {PER_ARCHIVE} ORDER BY page_id, url, html) - 1 AS record_no FROM pages),
    r AS (SELECT page_id, archive, record_no, rot <> html AS rotten, archive % 16 = 5 AND record_no = 100 AS lost,
        {size('html')} AS size, {size('rot')} AS size_b FROM p),
    m AS (SELECT *, (sum(size) {so_far})::BIGINT AS "end", (sum(CASE WHEN lost THEN 0 ELSE size_b END) {so_far})::BIGINT AS end_b FROM r)
    SELECT archive, record_no, page_id, "end" - size AS start, "end",
      CASE WHEN lost OR page_id % 389 = 7 THEN 'missing' WHEN rotten THEN 'altered' ELSE 'moved' END AS state
    FROM m WHERE lost OR page_id % 389 = 7 OR rotten OR "end" <> end_b"""
