"""Chat formatting by schema fingerprints, with SQL functions only.

Records are JSON of unknown layout. The nested field paths of a record, hashed, pick a declarative mapping, which lists
where the turns' roles and texts are. All layouts thus become the same canonical turns, which a template renders.

Template: a turn is ``[|`` role ``|`` flag ``|]`` text ``[/|]``; flag is 1 where the text counts for the loss. Texts
and roles are escaped so that no control string can occur in them: backslash, ``[``, ``]`` and ``|`` become a
backslash and a letter, and back.
"""

import hashlib
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, BAR, CLOSE, END = "[|", "|", "|]", "[/|]"
# Escapes in the order of writing; reading undoes them in the reverse order.
ESCAPES = (("\\", "\\s"), ("[", "\\o"), ("]", "\\c"), ("|", "\\b"))
#: Role whose texts count for the loss.
TAUGHT = "assistant"
TURN = "array<struct<role:string,text:string>>"
#: Bytes of a record up to which it surely parses: a variant has 128 MiB, a text in it 20,000,000 characters.
PARSED = 16 << 20


@dataclass(frozen=True)
class Layout:
    """A layout: the field paths of its records, and its turns.

    paths: of all leaves as ``a.b`` and ``a.[].b``, and of all arrays as ``a[]``, in any order. optional: paths that records
    of the layout may have besides. turns: (role, path) for each turn of records with fixed turns; or one (role path,
    text path) below an array, given by array.
    """

    name: str
    paths: tuple[str, ...]
    turns: tuple[tuple[str, str], ...]
    array: str | None = None
    optional: tuple[str, ...] = ()

    def fits(self, print_: Column) -> Column:
        """Whether a fingerprint is that of the layout's paths with some of the optional ones."""
        chosen = (c for k in range(len(self.optional) + 1) for c in combinations(self.optional, k))
        return print_.isin([_hash_paths(self.paths + c) for c in chosen])


def _hash_paths(paths: tuple[str, ...]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


#: Paths that any layout may have besides its own.
EXTRAS = ("id", "source")
_OF_TURNS = lambda array: tuple(f"{array}.[].{k}" for k in ("weight", "name"))
#: Known layouts. A record with another set of paths is rejected.
LAYOUTS = (
    Layout("prompt", ("completion", "prompt"), (("user", "prompt"), ("assistant", "completion")), optional=EXTRAS),
    Layout(
        "instruction",
        ("input", "instruction", "output"),
        (("system", "instruction"), ("user", "input"), ("assistant", "output")),
        optional=EXTRAS,
    ),
    Layout(
        "messages",
        ("messages[]", "messages.[].content", "messages.[].role"),
        (("role", "content"),),
        "messages",
        EXTRAS + _OF_TURNS("messages"),
    ),
    Layout("empty_messages", ("messages[]",), (), None, EXTRAS),
    Layout(
        "shared",
        ("conversations[]", "conversations.[].from", "conversations.[].value"),
        (("from", "value"),),
        "conversations",
        EXTRAS + _OF_TURNS("conversations"),
    ),
)


def field_paths(record: Column) -> Column:
    """Sorted paths of a JSON variant's leaves and arrays, at any depth.

    The variant's schema, as OBJECT<a: STRING, m: ARRAY<OBJECT<b: VOID>>>, is read token by token with the path that is open. A
    leaf's type doesn't matter, but an array of nothing or of nulls has no leaf.
    """
    tokens = F.regexp_extract_all(F.schema_of_variant(record), F.lit(r"(OBJECT<|ARRAY<|>|[^<>,: ][^<>,:]*: |[A-Z][A-Z0-9_]*(?:\([0-9]+,[0-9]+\))?)"), F.lit(1))
    texts = F.array().cast("array<string>")

    def read(state: Column, token: Column) -> Column:
        open_, paths = state["open"], state["paths"]
        but_last = F.slice(open_, F.lit(1), F.greatest(F.size(open_) - 1, F.lit(0)))
        path = F.array_join(open_, ".")
        is_name, is_array, is_object = token.endswith(": "), token == "ARRAY<", token == "OBJECT<"
        now_open = (
            F.when(is_array, F.concat(open_, F.array(F.lit("[]"))))
            .when(is_object, F.concat(open_, F.array(F.lit(""))))
            .when(is_name, F.concat(but_last, F.array(F.substring(token, F.lit(1), F.length(token) - 2))))
            .when(token == ">", but_last)
            .otherwise(open_)
        )
        in_array = F.try_element_at(open_, F.lit(-1)) == "[]"
        leaf = ~(is_name | is_object | (token == ">") | ((token == "VOID") & F.coalesce(in_array, F.lit(False))))
        found = F.when(is_array, F.concat(path, F.lit("[]"))).when(leaf, path)
        return F.struct(now_open.alias("open"), F.when(found.isNotNull(), F.concat(paths, F.array(found))).otherwise(paths).alias("paths"))

    end = F.aggregate(tokens, F.struct(texts.alias("open"), texts.alias("paths")), read)
    return F.array_sort(F.array_distinct(end["paths"]))


def fingerprint(record: Column) -> Column:
    """Hash of the nested field paths of a JSON variant."""
    return F.sha2(F.concat_ws("\n", field_paths(record)), 256)


def layout_of(print_: Column, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """Name of the layout that a fingerprint picks, null if none does."""
    out = F.lit(None).cast("string")
    for layout in layouts:
        out = F.when(layout.fits(print_), layout.name).otherwise(out)
    return out


def canonical_turns(record: Column, layout_name: Column, layouts: tuple[Layout, ...] = LAYOUTS, typed: bool = False) -> Column:
    """Turns of a variant by the mapping of its layout; an empty array if it has none.

    With typed, record is a struct that has the fields of all layouts with turns.
    """
    get = (lambda path, kind: record[path]) if typed else (lambda path, kind: F.variant_get(record, f"$.{path}", kind))
    out = F.lit(None).cast(TURN)
    for layout in layouts:
        if layout.array:
            role, text = layout.turns[0]
            items = get(layout.array, f"array<struct<`{role}`:string,`{text}`:string>>")
            turns = F.transform(items, lambda x: F.struct(x[role].alias("role"), x[text].alias("text")))  # noqa: B023
        else:
            turns = F.array(
                *(
                    F.struct(F.lit(role).alias("role"), get(path, "string").alias("text"))
                    for role, path in layout.turns
                )
            ).cast(TURN)
        out = F.when(layout_name == layout.name, turns).otherwise(out)
    return F.coalesce(out, F.array().cast(TURN))


def escape(text: Column) -> Column:
    """Text without control characters; null becomes empty."""
    text = F.coalesce(text, F.lit(""))
    for plain, coded in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    for plain, coded in reversed(ESCAPES):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def render(turns: Column) -> Column:
    """Formatted text of canonical turns."""

    def one(t: Column) -> Column:
        flag = F.when(F.coalesce(t["role"], F.lit("")) == TAUGHT, "1").otherwise("0")
        return F.concat(F.lit(OPEN), escape(t["role"]), F.lit(BAR), flag, F.lit(CLOSE), escape(t["text"]), F.lit(END))

    return F.array_join(F.transform(turns, one), "")


def parse(formatted: Column) -> Column:
    """Turns (role, text, taught) read back from formatted text."""
    parts = F.filter(F.split(formatted, r"\[/\|\]"), lambda p: p != "")

    def one(p: Column) -> Column:
        head = F.substring_index(p, CLOSE, 1)
        role = F.substring_index(F.substring(head, len(OPEN) + 1, 1 << 30), BAR, 1)
        text = F.substring(p, F.length(head) + len(CLOSE) + 1, F.length(p))
        return F.struct(
            unescape(role).alias("role"), unescape(text).alias("text"), F.endswith(head, F.lit(f"{BAR}1")).alias("taught")
        )

    return F.transform(parts, one)


def loss_spans(formatted: Column) -> Column:
    """Where the loss counts: (start, end) code points of taught texts in formatted, end exclusive."""
    parts = F.filter(F.split(formatted, r"\[/\|\]"), lambda p: p != "")
    sized = F.transform(
        parts,
        lambda p: F.struct(
            F.length(p).cast("long").alias("n"),
            (F.length(F.substring_index(p, CLOSE, 1)) + len(CLOSE)).cast("long").alias("head"),
            F.endswith(F.substring_index(p, CLOSE, 1), F.lit(f"{BAR}1")).alias("taught"),
        ),
    )
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))

    def add(acc: Column, p: Column) -> Column:
        span = F.array(F.struct((acc["at"] + p["head"]).alias("start"), (acc["at"] + p["n"]).alias("end")))
        return F.struct(
            (acc["at"] + p["n"] + len(END)).alias("at"),
            F.when(p["taught"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"),
        )

    return F.aggregate(sized, zero, add)["spans"]


def format_records(records: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """records with fingerprint, layout, turns and formatted, from a JSON text column raw.

    Null, malformed and unknown records have no layout and no turns and format to the empty text; rejected gives them. A
    record of more than PARSED bytes that can't be parsed may be beyond the parser's limits and is an error. Where a
    struct column __record of conversation_records is not null, turns come from it, and raw has only the layout. Every
    row is formatted for itself: ties and repeated rows don't matter. Columns of records named like a result column are
    replaced.
    """
    kept = [c for c in records.columns if c.lower() not in {"fingerprint", "layout", "turns", "formatted", "__v"}]
    v = F.try_parse_json("raw")
    lost = v.isNull() & (F.octet_length("raw") > PARSED)
    r = records.select(*kept, F.when(lost, F.raise_error("a record is too large to be parsed")).otherwise(v).alias("__v"))
    r = r.withColumn("fingerprint", fingerprint(F.col("__v")))
    r = r.withColumn("layout", layout_of(F.col("fingerprint"), layouts))
    turns = canonical_turns(F.col("__v"), F.col("layout"), layouts)
    if "__record" in kept:
        typed = canonical_turns(F.col("__record"), F.col("layout"), LAYOUTS, typed=True)
        turns = F.when(F.col("__record").isNull(), turns).otherwise(typed)
    r = r.withColumn("turns", turns)
    return r.withColumn("formatted", render(F.col("turns"))).drop("__v", "__record")


def rejected(formatted: DataFrame) -> DataFrame:
    """The rows of format_records that no layout fits: null and malformed records, and unknown fingerprints."""
    return formatted.filter("layout is null").drop("turns", "formatted")


def unknown_layouts(formatted: DataFrame) -> DataFrame:
    """(fingerprint, paths, n): the field paths of what was rejected, and how many records have them; null if malformed."""
    r = rejected(formatted).select("fingerprint", field_paths(F.try_parse_json("raw")).alias("paths"))
    return r.groupBy("fingerprint").agg(F.max("paths").alias("paths"), F.count(F.lit(1)).alias("n"))


def digest(formatted: DataFrame) -> DataFrame:
    """conv_id and digests of what is read back from formatted text: turns, text under the loss mask, length."""
    r = formatted.select("conv_id", "formatted", parse(F.col("formatted")).alias("p"))
    said = F.transform("p", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    taught = F.transform(F.filter("p", lambda t: t["taught"]), lambda t: t["text"])
    r = r.select("conv_id", "formatted", "p", F.array_join(said, "").alias("said"), F.array_join(taught, "").alias("loss"))
    return r.select(
        "conv_id",
        F.size("p").cast("long").alias("n_turns"),
        F.sha2("said", 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def digest_sql(turns: str) -> str:
    """The digests of all conversations of a DuckDB relation (conv_id, turn, role, text)."""
    size = lambda c: f"(length({c}) + length(regexp_replace({c}, '[^\\\\\\[\\]|]', '', 'g')))"
    fixed = len(OPEN) + len(BAR) + 1 + len(CLOSE) + len(END)
    order = "ORDER BY turn NULLS LAST, role, text"
    taught = f"coalesce(string_agg(text, '' {order}) FILTER (WHERE role = '{TAUGHT}'), '')"
    return f"""
    WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM {turns})
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' {order})) AS turns_sha256,
      length({taught}) AS loss_chars, sha256({taught}) AS loss_sha256,
      sum({fixed} + {size('role')} + {size('text')})::BIGINT AS formatted_chars
    FROM t GROUP BY conv_id"""


def conversation_records(turns: DataFrame, most: int = PARSED) -> DataFrame:
    """(conv_id, raw, __record): conversations as JSON in the layout that their roles allow.

    A user and an assistant turn make a prompt record; system, user and assistant an instruction record; an odd
    number of turns a message list, an even one the shared layout. Turns are in order of turn, then role, then text.
    A conversation is one record, so its turns meet in one row. One of more than most bytes could not be parsed: its raw
    has the fields of its layout without roles and texts, which are in the struct __record, null for the others.
    """
    one = F.struct(
        F.col("turn").isNull().alias("no_turn"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    c = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(one)).alias("t"))
    roles = F.transform("t", lambda x: x["role"])
    at = lambda i: F.col("t")[i]["text"]
    is_ = lambda *r: roles == F.array(*map(F.lit, r))
    messages = F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("content")))
    shared = F.transform("t", lambda x: F.struct(x["role"].alias("from"), x["text"].alias("value")))
    no = F.lit("")
    #: Fields of each layout, the same without roles and texts, and where the layout holds.
    cases = (
        ({"prompt": at(0), "completion": at(1)}, {"prompt": no, "completion": no}, is_("user", "assistant")),
        (
            {"instruction": at(0), "input": at(1), "output": at(2)},
            {"instruction": no, "input": no, "output": no},
            is_("system", "user", "assistant"),
        ),
        ({"messages": messages}, {"messages": F.array(F.struct(no.alias("role"), no.alias("content")))}, F.size("t") % 2 == 1),
        ({"conversations": shared}, {"conversations": F.array(F.struct(no.alias("from"), no.alias("value")))}, F.lit(True)),
    )
    # Names of fields and punctuation take less than 64 bytes a turn.
    add = lambda n, x: n + F.octet_length(x["role"]) + F.octet_length(x["text"]) + 64
    large = F.aggregate("t", F.lit(0).cast("long"), add) > most
    raw = record = None
    for fields, bare, holds in reversed(cases):
        struct = lambda of: F.struct(*(x.alias(name) for name, x in of.items()))
        json = F.when(large, F.to_json(struct(bare))).otherwise(F.to_json(struct(fields)))
        every = F.struct(
            *(
                (fields[name] if name in fields else F.lit(None).cast(_FIELDS[name])).cast(_FIELDS[name]).alias(name)
                for name in _FIELDS
            )
        )
        raw = json if raw is None else F.when(holds, json).otherwise(raw)
        record = every if record is None else F.when(holds, every).otherwise(record)
    return c.select("conv_id", raw.alias("raw"), F.when(large, record).alias("__record"))


#: Fields of the layouts that conversation_records makes.
_FIELDS = dict.fromkeys(("prompt", "completion", "instruction", "input", "output"), "string") | {
    "messages": "array<struct<role:string,content:string>>",
    "conversations": "array<struct<from:string,value:string>>",
}
