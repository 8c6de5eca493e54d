"""Secret scans with multipart credential linking.

Base spans are certain by themselves: assignments to password-like names, access identifiers and long hex runs. Weak
candidates are not: names of accounts, random-looking strings, endpoints. They are reported only where the parts that
complete a credential start within SCOPE code points of their own start. That is an interval join of the parts of each text, made as an
equality join on cells of SCOPE code points: a cell's parts of one kind are first reduced to their least and greatest
start, which decide for every candidate in it and in the two cells beside it. The work is linear in the parts.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import MOST_KEYS, durable, row_key, runs, text_batches

#: Kinds of spans in their order; the first three are the base.
KINDS = ("assign", "access", "hex", "id", "secret", "endpoint")
#: Part of a credential that each kind is, and the parts that a weak kind needs within the scope.
PART = {"assign": "secret", "access": "id", "hex": "secret", "id": "id", "secret": "secret", "endpoint": "endpoint"}
NEEDS = {"id": ("secret",), "secret": ("id",), "endpoint": ("id", "secret")}
SCOPE = 400
PARTS = ("id", "secret", "endpoint")


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


ASSIGNED = "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key")))
VALUE = r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN = re.compile(f"({ASSIGNED}){VALUE}")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
LONG_HEX = re.compile(r"[0-9a-f]{16,}")  # maximal runs, as of [0-9a-f]+, of which the short ones fail
NAMED = "|".join(map(_either_case, ("client_id", "account_id", "access_key_id", "user_?name", "login")))
ID = re.compile(f"({NAMED}){VALUE}")
RANDOM = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}(?![A-Za-z0-9+/_-])")
ENDPOINT = re.compile(r"""[a-z][a-z0-9+.-]{1,15}://[^\x00-\x20"'<>]+""")
AUTHORITY = re.compile("://([^/?#]*)")
BEHIND = re.compile("[?#]")
LEAST_VALUE, LEAST_ACCESS, LEAST_RUN = 12, 18, 16


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the certain spans, leftmost and not overlapping within a kind."""
    out = []
    if ":" in text or "=" in text:
        out += [(0, *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if "AKIA" in text:
        out += [(1, *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    out += [(2, *m.span()) for m in LONG_HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], s[0]))


def weak_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the candidates, none of which lies in a base span but for names of accounts.

    Of an endpoint, the user is a name, and the password and random-looking values behind ``?`` or ``#`` are secrets; a
    user without password that looks random is a secret too. Its other parts are no candidates.
    """
    out = []
    if ":" in text or "=" in text:
        out += [(3, *m.span(2)) for m in ID.finditer(text)]
    taken = np.zeros(len(text) + 1, bool)
    for _, start, end in base:
        taken[start:end] = True
    if "://" in text:
        for m in ENDPOINT.finditer(text):
            out += [(5, *m.span()), *(s for s in _in_endpoint(text, *m.span()) if s[0] == 3 or not taken[s[1] : s[2]].any())]
        for kind, start, end in out:
            if kind == 5:
                taken[start:end] = True
    for m in RANDOM.finditer(text):
        if _mixed(m[0]) and not taken[m.start() : m.end()].any():
            out.append((4, *m.span()))
    return sorted(set(out), key=lambda s: (s[1], s[0], s[2]))


def _mixed(word: str) -> bool:
    return any(c.isdigit() for c in word) and any(c.isupper() for c in word) and any(c.islower() for c in word)


def _in_endpoint(text: str, start: int, end: int) -> list[tuple[int, int, int]]:
    """Names and secrets inside the endpoint at start to end."""
    out = []
    authority = AUTHORITY.search(text, start, end)
    user, at, _ = authority[1].rpartition("@")
    if at:
        name, colon, password = user.partition(":")
        begin = authority.start(1)
        if name:
            out.append((4 if not password and _mixed(name) and RANDOM.fullmatch(name) else 3, begin, begin + len(name)))
        if password:
            out.append((4, begin + len(name) + len(colon), begin + len(user)))
    if behind := BEHIND.search(text, start, end):
        out += [(4, *m.span()) for m in RANDOM.finditer(text, behind.start(), end) if _mixed(m[0])]
    return out


def _run_table(chars: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[[ord(c) for c in chars]] = True
    return table


_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
IN_RANDOM = _run_table(_DIGITS + _LOWER + _LOWER.upper() + "+/_-")
MARK = _run_table(":=")


def _texts_with_runs(inside: np.ndarray, at: np.ndarray, least: int) -> np.ndarray:
    """Which texts have a run of at least so many bytes inside."""
    start, end = runs(inside, at)
    out = np.zeros(len(at) - 1, bool)
    out[np.searchsorted(at, start[end - start >= least], "right") - 1] = True
    return out


def _spans_array(rows: list[list[tuple[int, int, int]]]) -> pa.Array:
    flat = [s for row in rows for s in row]
    columns = list(zip(*flat, strict=True)) or [(), (), ()]
    struct = pa.StructArray.from_arrays([pa.array(c, pa.int32()) for c in columns], names=["kind", "start", "end"])
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(r) for r in rows])]), pa.int32()), struct)


SPANS = "array<struct<kind:int,start:int,end:int>>"


def _scan(keep: list[str]):
    names = [*keep, "base", "weak"]

    def run(batches):
        for batch in batches:
            for part, text, at in text_batches(batch, "__text"):
                look = _texts_with_runs(IN_RANDOM[text], at, LEAST_RUN)
                marks = np.concatenate([[0], np.cumsum(MARK[text])])
                look |= marks[at[1:]] > marks[at[:-1]]
                bases, weaks = [], []
                for i, wanted in enumerate(look.tolist()):
                    if not wanted:
                        bases.append([])
                        weaks.append([])
                        continue
                    t = text[at[i] : at[i + 1]].tobytes().decode("utf-8", "replace")
                    bases.append(base_spans(t))
                    weaks.append(weak_spans(t, bases[-1]))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in range(len(keep))), _spans_array(bases), _spans_array(weaks)], names=names
                )

    return run


def _part(kind: Column) -> Column:
    return F.element_at(F.array(*(F.lit(PARTS.index(PART[k])) for k in KINDS)), kind + 1)


def link(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(key, linked): the weak spans of each key whose complementary parts lie within the scope, by their starts.

    found: (key, base, weak). Keys without a linked span are left out.
    """
    found = found.filter(F.size("weak") > 0).dropDuplicates(["key"])
    weak = found.select("key", F.inline("weak"))
    every = found.select("key", F.inline(F.concat("base", "weak")))
    cell = F.floor(F.col("start") / scope)
    parts = every.groupBy("key", cell.alias("cell"), _part(F.col("kind")).alias("part")).agg(
        F.min("start").alias("first"), F.max("start").alias("last")
    )
    asked = weak.select("key", "kind", "start", "end", F.explode(F.array(cell - 1, cell, cell + 1)).alias("cell"))
    near = [F.abs(F.col(c) - F.col("start")) <= scope for c in ("first", "last")]
    met = asked.join(parts, ["key", "cell"]).filter(near[0] | near[1])
    seen = met.groupBy("key", "kind", "start", "end").agg(*(F.bool_or(F.col("part") == i).alias(p) for i, p in enumerate(PARTS)))
    complete = F.lit(False)
    for kind, needs in NEEDS.items():
        enough = F.lit(True)
        for p in needs:
            enough = enough & F.col(p)
        complete = complete | ((F.col("kind") == KINDS.index(kind)) & enough)
    return seen.filter(complete).groupBy("key").agg(F.collect_list(F.struct("kind", "start", "end")).alias("linked"))


def find_secrets(docs: DataFrame, scope: int = SCOPE, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep, key, base and spans: arrays of (kind, start, end), code points, by start, then kind.

    Null and empty texts have none. Rows that agree in doc_id and text share a key and get the same spans; a null id is
    an id like others. Columns of docs other than keep are not read. The scan is stored before it is linked, as it
    feeds both sides of the join.
    """
    key = row_key(F.col("doc_id"), F.col("text")).alias("key")
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    rows = docs.select(*keep, key, F.col("text").alias("__text"))
    found = durable(rows.mapInArrow(_scan([*keep, "key"]), f"{fields}, key long, base {SPANS}, weak {SPANS}"))
    out = found.drop("weak").join(link(found, scope), "key", "left")
    by_start = lambda x: F.struct(x["start"], x["kind"], x["end"])
    spans = F.transform(
        F.array_sort(F.transform(F.concat("base", F.coalesce("linked", F.array().cast(SPANS))), by_start)),
        lambda x: F.struct(x["kind"], x["start"], x["end"]),
    )
    return out.select(*keep, "key", "base", spans.alias("spans"))


def spans_text(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ","
    )


MASK = "[redacted]"


def redact_text(text: str, spans: list[tuple[int, int]]) -> str:
    """text with MASK for every maximal run of covered code points."""
    out, at = [], 0
    end_of_mask = -1
    for start, end in sorted(spans):
        if start > end_of_mask:
            out += [text[at:start], MASK]
        at = end_of_mask = max(end_of_mask, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """docs with secrets masked in text: base spans and linked ids and secrets; endpoints stay. Same columns.

    Only rows that have such a span go through Python; the others pass as they are. Texts stay where they are if all
    spans are few enough to be broadcast; else rows are shuffled by key.
    """
    hidden = F.filter("spans", lambda s: s["kind"] != KINDS.index("endpoint"))
    found = find_secrets(docs, scope).select("key", hidden.alias("__spans")).filter(F.size("__spans") > 0)
    found = durable(found.dropDuplicates(["key"]).withColumnRenamed("key", "__key"))
    n_spans = found.agg(F.sum(F.size("__spans") + 1)).first()[0] or 0
    found = F.broadcast(found) if n_spans <= MOST_KEYS else found.hint("shuffle_hash")
    keyed = docs.withColumn("__key", row_key(F.col("doc_id"), F.col("text")))
    clean = keyed.join(found.select("__key"), "__key", "left_anti").select(*docs.columns)
    joined = keyed.join(found, "__key").select(*docs.columns, "__spans")
    names = docs.columns
    place = names.index("text")

    def run(batches):
        for batch in batches:
            texts = batch.column(place).to_pylist()
            spans = batch.column(len(names)).to_pylist()
            new = [t if not s else redact_text(t, [(x["start"], x["end"]) for x in s]) for t, s in zip(texts, spans, strict=True)]
            columns = [batch.column(i) for i in range(len(names))]
            columns[place] = pa.array(new, batch.column(place).type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return clean.unionByName(joined.mapInArrow(run, docs.schema))
