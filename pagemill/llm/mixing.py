"""Mixing sources to target weights, with DataFrame functions only.

Sizes are summed by source, each source gets a target and so a repetition rate, and a document is taken floor(rate)
times plus once more if a hash of its id and text, seeded, falls below the rate's fraction. Texts are part of the hash, so
that rows draw for themselves where ids are null or repeated; only rows that agree in both draw alike.

A single draw leaves a source of few documents far from its target: with ten of equal size at a rate of 1.5, every other
draw is off by a tenth or more. So SEEDS draws are added up for each source, in one pre-aggregated pass, and each source uses
the one whose total comes nearest; within it, each document's copies are that one Bernoulli draw.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.llm.common import WORD, durable

#: Weights of the sources in order of their names, repeating.
WEIGHTS = (3, 1, 2)
#: The mix as a share of all sizes, and the most that a source may repeat.
SHARE, MOST = 1.5, 2
SEEDS = 16
#: Sources up to which their rates are broadcast. More meet their documents by a join, whose hot sources Spark splits.
BROADCAST_SOURCES = 10_000


def _beside(by_source: DataFrame) -> DataFrame:
    """A stored table of sources, to be broadcast if it has few enough rows: texts then stay where they are."""
    return F.broadcast(by_source) if by_source.count() <= BROADCAST_SOURCES else by_source


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) from (source, size): targets by WEIGHTS, at most MOST times the size.

    Capping sources and resharing the excess by weight ends where target = min(MOST * size, rate * weight) for one
    rate. In order of size per weight, the capped sources are a prefix: source k is capped if its cap lies below what
    it gets with the sources before it capped. One row for each source is sorted in one task; the documents aren't.
    Sources are ordered by code point, null last. With nothing to take, targets are 0.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    w = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.row_number().over(w) - 1) % len(WEIGHTS) + 1)
    s = by_source.withColumn("weight", weight).withColumn("cap", MOST * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy())
    s = s.withColumns(
        {
            "free": SHARE * total - F.coalesce(F.sum("cap").over(before), F.lit(0)),
            "weights": F.sum("weight").over(rest),
            "place": F.row_number().over(order),
        }
    )
    # Of the first source that isn't capped, the free words and weights hold for all after it. First is by place: sources
    # of equal size per weight differ in what is free, as it leaves out the caps of those before.
    capped = F.col("cap") * F.col("weights") <= F.col("free") * F.col("weight")
    everyone = Window.partitionBy()
    first = F.min(F.when(~capped, F.struct("place", "free", "weights"))).over(everyone)
    s = s.withColumn("first", first)
    share = F.col("weight") * F.col("first.free") / F.col("first.weights")
    target = F.when(capped | F.col("first").isNull(), F.col("cap").cast("double")).otherwise(share)
    return s.select("source", "source_size", target.alias("target"))


def row_digest(text: Column) -> Column:
    """What of a text takes part in its row's draw; a null text is empty."""
    return F.md5(F.coalesce(text, F.lit("")))


def draw(doc_id: Column, digest: Column, seed: Column) -> Column:
    """Uniform number in [0, 1) from an id, its text's digest and a seed; a null id draws as an empty one."""
    text = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), digest, F.lit(":"), seed.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") / F.lit(2.0**32)


def mix(docs: DataFrame, size: Column | None = None) -> DataFrame:
    """docs with size, source_size, target, rate, copies and taken.

    docs needs doc_id, source and text (or a size column). Rows with the same id and text draw alike; null sources are one
    source. No document has more than MOST copies. Empty texts have size 0 and may be copied, taking nothing. Columns
    named like a result column are replaced. An empty table gives an empty table.
    """
    size = word_count(F.col("text")) if size is None else size
    kept = [c for c in docs.columns if c.lower() not in {"size", "source_size", "target", "rate", "copies", "taken"}]
    docs = docs.select(*kept)
    digest = row_digest(F.col("text")) if "text" in kept else F.lit("")
    sizes = durable(docs.select("doc_id", "source", size.alias("size"), digest.alias("digest")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    targets = durable(source_targets(sizes).withColumn("rate", rate))

    def extra(seed: Column, digest: Column) -> Column:
        return (draw(F.col("doc_id"), digest, seed) < F.col("rate") - F.floor("rate")).cast("long")

    t = targets.select(F.col("source").alias("of"), "source_size", "target", "rate")
    rated = sizes.join(_beside(t), F.col("source").eqNullSafe(F.col("of")))
    sums = [F.sum(F.col("size") * extra(F.lit(i), F.col("digest"))).alias(f"s{i}") for i in range(SEEDS)]
    drawn = rated.groupBy("of", "target", "rate").agg(F.sum("size").alias("source_size"), *sums)
    whole = F.floor("rate") * F.col("source_size")
    tries = [F.struct(F.abs(whole + F.col(f"s{i}") - F.col("target")).alias("off"), F.lit(i).alias("seed")) for i in range(SEEDS)]
    seed = F.array_min(F.array(*tries))["seed"].alias("__seed")
    best = durable(drawn.select(F.col("of").alias("__of"), "source_size", "target", "rate", seed))
    out = docs.withColumn("size", size).join(_beside(best), F.col("source").eqNullSafe(F.col("__of"))).drop("__of")
    copies = (F.floor("rate") + extra(F.col("__seed"), digest)).cast("int")
    out = out.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size"))
    return out.drop("__seed")


def repeat_rows(mixed: DataFrame) -> DataFrame:
    """One row for each copy."""
    copies = F.explode(F.array_repeat(F.lit(True), F.col("copies")))
    return mixed.filter("copies > 0").withColumn("copy", copies).drop("copy")


def mix_sql(documents: str = "documents") -> str:
    """mix() as DuckDB SQL: a query for doc_id, size, source_size, target, taken, copies."""
    draw_sql = "('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || digest || ':' || seed), 1, 8))::BIGINT / 4294967296.0::DOUBLE"
    return f"""
    WITH sizes AS (SELECT doc_id, source, md5(coalesce(text, '')) AS digest,
             coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM {documents}),
    s AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
    w AS (SELECT *, {MOST} * source_size AS cap,
            [{', '.join(map(str, WEIGHTS))}][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1] AS weight FROM s),
    f AS (SELECT *, {SHARE}::DOUBLE * sum(source_size) OVER ()
            - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS free,
            sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights,
            row_number() OVER (ORDER BY cap / weight, source NULLS LAST) AS place FROM w),
    u AS (SELECT arg_min(free, place) AS free, arg_min(weights, place) AS weights FROM f WHERE cap * weights > free * weight),
    t AS (SELECT source, source_size, CASE WHEN cap * f.weights <= f.free * weight OR u.free IS NULL THEN cap::DOUBLE
            ELSE weight * u.free / u.weights END AS target FROM f, u),
    r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM t),
    d AS (SELECT source, seed, sum(CASE WHEN {draw_sql} < rate - floor(rate) THEN size ELSE 0 END) AS extra
          FROM (SELECT sizes.*, rate FROM sizes JOIN r ON sizes.source IS NOT DISTINCT FROM r.source), range({SEEDS}) q(seed) GROUP BY ALL),
    b AS (SELECT r.*, (arg_min(seed, (abs(floor(rate) * source_size + extra - target), seed))) AS seed
          FROM r JOIN d ON r.source IS NOT DISTINCT FROM d.source GROUP BY ALL)
    SELECT doc_id, size, source_size, target,
      ((floor(rate) + CASE WHEN {draw_sql} < rate - floor(rate) THEN 1 ELSE 0 END) * size)::BIGINT AS taken
    FROM (SELECT sizes.*, source_size, target, rate, seed FROM sizes JOIN b ON sizes.source IS NOT DISTINCT FROM b.source)"""
