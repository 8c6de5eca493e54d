"""Very many rules over addresses, found by the text that their patterns begin with."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Lengths of the beginnings that rules are found by, and the rules up to which their index is broadcast.
LENGTHS = (8, 12, 16, 20, 24, 32, 40, 48, 64, 96)
MOST_BROADCAST = 1 << 18


def literal_beginning(pattern: Column) -> Column:
    """The text that everything a pattern matches begins with: what an anchored pattern has before its first special
    character. Null for patterns that aren't anchored, and for those with alternatives outside of groups.

    Letters, digits and escaped punctuation count as text; the last character before a quantifier doesn't.
    """
    plain = F.regexp_extract(pattern, r"^\^((?:[\w/:%~#=&,;@!\x20-]|\\[^A-Za-z0-9])*)(?![?*+{])", 1)
    rest = F.regexp_replace(F.regexp_replace(pattern, r"\\.", ""), r"\[[^\]]*\]", "")
    for _ in range(4):
        rest = F.regexp_replace(rest, r"\([^()]*\)", "")
    known = pattern.startswith("^") & ~rest.rlike(r"[|()]")
    return F.when(known, F.nullif(F.regexp_replace(plain, r"\\(.)", "$1"), F.lit("")))


def indexed_rules(rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rules ``(prio, pat, kind)`` with the beginning that they are found by, ``(size, start)``, and the rules that have
    none of the least length, as they came."""
    known = rules.select("prio", "pat", "kind", literal_beginning(F.col("pat")).alias("literal"))
    lengths = F.array(*map(F.lit, LENGTHS))
    known = known.withColumn("size", F.array_max(F.filter(lengths, lambda n: n <= F.length("literal"))))
    found = known.filter("size is not null").withColumn("start", F.expr("left(literal, size)"))
    return found.drop("literal"), known.filter("size is null").select("prio", "pat", "kind")


def kinds_of_urls(urls: DataFrame, indexed: DataFrame) -> DataFrame:
    """(url, best) of the distinct URLs that an indexed rule matches, best being the first of (prio, pat, kind).

    A URL meets the rules that begin as it does by equal text, and only their patterns are run on it.
    """
    starts = F.array(*(F.when(F.length("url") >= n, F.struct(F.lit(n).alias("size"), F.left("url", F.lit(n)).alias("start"))) for n in LENGTHS))
    probes = urls.filter("url is not null").select("url").distinct().select("url", F.inline(F.array_compact(starts)))
    near = F.broadcast(indexed) if indexed.count() <= MOST_BROADCAST else indexed
    met = probes.join(near, ["size", "start"]).filter(F.expr("url rlike pat"))
    return met.groupBy("url").agg(F.min(F.struct("prio", "pat", "kind")).alias("best"))
