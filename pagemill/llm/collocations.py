"""Phrases whose words occur together more often than their parts' counts suggest, by pattern growth.

Contiguous phrases grow to the right, prefix by prefix, as in PrefixSpan. A first pass counts words; a word in fewer than
least places begins and ends no frequent phrase. A second pass projects: each place where a frequent word goes on becomes an
occurrence pointer of that word, with the frequent words that follow it within its piece. Pointers of a slice of texts that
go on alike are one pointer with a count, and a slice's pointers of one prefix travel as one packed row. They meet at their
prefix: one task grows a prefix depth-first, extending it by each word that follows in enough places and descending into
that word's pointers alone, so no candidate is made that doesn't occur.

A prefix with over SPLIT pointers is dealt in parts by the two words that follow. Counts of phrases of three words and more
are whole in one part; those of two are added up afterwards. So no task holds more than a part, whatever a word's share of
the corpus, and one prefix's pointers are in memory at a time.

Words travel as 64-bit hashes. Hashes shared by two words, one of them frequent, are looked for in the table of all words of
a language; if there are any, the counting starts again with another base, so equal hashes mean equal words.

Null texts are empty and null languages are ``und``. Repeated rows count each time. Words keep whatever bytes they have but
for A-Z in lower case, and phrases are compared by their UTF-8 bytes. An empty table, or one without frequent phrases, gives
an empty table. Other columns are not read.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.llm.common import BASE, data, delete, key_filter, mixed, offsets, passes, ranges, run_hashes, runs, stored, text_batches

#: Bytes that end a piece, and bytes that part words within one.
ENDS, SPACES = b".,;:!?\x0a\x0b\x0c\x0d", b"\x20\x09"
#: Pointers from which a prefix is dealt in parts. It doubles until at most MOST_SPLIT prefixes are, whose list is broadcast.
SPLIT, MOST_SPLIT = 1 << 18, 1 << 17
#: Pointers in one packed row, and bytes of text in a slice.
PACKED, SLICE = 1 << 10, 4 << 20
#: Parts of each language that are ranked by themselves before the first ones of all parts are.
RANKED = 64
#: Bases of the hash, tried in turn.
BASES = tuple(np.uint64(int(BASE) + 2 * i * 0x632BE5AB) for i in range(4))


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each byte: whether it is in a word, whether it ends a piece, and its lower case."""
    word, ends, low = np.ones(256, bool), np.zeros(256, bool), np.arange(256, dtype=np.uint8)
    ends[list(ENDS)] = True
    word[list(ENDS + SPACES)] = False
    low[65:91] += 32
    return word, ends, low


WORD, END, LOW = _tables()


def _languages(part: pa.RecordBatch) -> tuple[pa.Array, np.ndarray]:
    """The distinct languages of a slice, and each text's place among them."""
    column = pc.dictionary_encode(part.column(part.schema.get_field_index("lang")))
    return column.dictionary, column.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _words(text: np.ndarray, at: np.ndarray, base: np.uint64) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the words of parted texts: hashes (never 0), first bytes, texts, and whether the next word goes on in the same
    piece."""
    hashes, per_text = run_hashes(text, at, WORD, base)
    begin = runs(WORD[text], at)[0] if len(text) else np.zeros(0, np.int64)
    of = np.repeat(np.arange(len(per_text)), per_text)
    ended = np.concatenate([[0], np.cumsum(END[text])])[begin]
    goes_on = np.zeros(len(begin), bool)
    goes_on[:-1] = (of[1:] == of[:-1]) & (ended[1:] == ended[:-1])
    return np.maximum(hashes, np.uint64(1)), begin, of, goes_on


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where sorted rows differ from the one before."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def _sizes(text: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Bytes of the words of parted texts."""
    stop = np.flatnonzero(~WORD[text])
    return stop[np.searchsorted(stop, begin)] - begin


def _spelled(text: np.ndarray, begin: np.ndarray, size: np.ndarray) -> pa.Array:
    """Words in lower case."""
    to = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    spelled = LOW[text[ranges(begin, size)]]
    return pa.Array.from_buffers(pa.large_string(), len(begin), [None, pa.py_buffer(to), pa.py_buffer(spelled)])


def _unlike(text: np.ndarray, begin: np.ndarray, size: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Which words differ from the first of their group; groups follow each other."""
    first = np.flatnonzero(_changes(group))
    like = np.repeat(first, np.diff(np.append(first, len(group))))
    unlike = size != size[like]
    same = np.flatnonzero(~unlike)
    differ = LOW[text[ranges(begin[same], size[same])]] != LOW[text[ranges(begin[like][same], size[same])]]
    at = np.repeat(same, size[same])
    unlike[at[differ]] = True
    return unlike


def _count(base: np.uint64):
    """The words of each slice of texts with their languages and counts."""

    def run(batches):
        for batch in batches:
            for part, text, at in text_batches(batch, "text", SLICE):
                names, lang_of = _languages(part)
                text, at = _parted(text, at)
                h, begin, of, _ = _words(text, at, base)
                lang = lang_of[of]
                order = np.argsort(h ^ mixed(lang.astype(np.uint64)), kind="stable")
                h, lang, begin = h[order], lang[order], begin[order]
                size, new = _sizes(text, begin), _changes(h, lang)
                # Another word of the same hash stands by itself, and so does what follows it, so that both are seen.
                unlike = _unlike(text, begin, size, np.cumsum(new))
                new |= unlike
                new[1:] |= unlike[:-1]
                first = np.flatnonzero(new)
                n = np.diff(np.append(first, len(h)))
                spelled = _spelled(text, begin[first], size[first]).cast(pa.string())
                arrays = [names.take(pa.array(lang[first])), pa.array(h[first].view(np.int64)), spelled, pa.array(n)]
                yield pa.RecordBatch.from_arrays(arrays, names=["lang", "h", "word", "n"])

    return run


def _parted(text: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same texts, each followed by the end of a piece, so that words end where their texts do."""
    n = len(at) - 1
    out = np.full(len(text) + n, ENDS[0], np.uint8)
    inner = np.ones(len(out), bool)
    inner[at[1:] + np.arange(n)] = False
    out[inner] = text
    return out, at + np.arange(n + 1)


def _project(base: np.uint64, most: int, shared):
    """The pointers of each slice of texts, packed by language, prefix and part: the words that follow (0 where the phrase
    ends) and in how many places."""
    kind = np.dtype([("next", "<u8", (most - 1,)), ("n", "<u4")])

    def run(batches):
        bits, split = shared.value
        for batch in batches:
            for part, text, at in text_batches(batch, "text", SLICE):
                names, lang_of = _languages(part)
                h, _, of, link = _words(*_parted(text, at), base)
                known = passes(bits, h.view(np.int64))
                link &= known
                link[:-1] &= known[1:]
                place = np.flatnonzero(link)
                follows = np.zeros((len(place), most - 1), np.uint64)
                going = np.ones(len(place), bool)
                for j in range(most - 1):
                    there = np.minimum(place + j, len(h) - 1)
                    going &= link[there] & (place + j < len(h) - 1)
                    follows[going, j] = h[place[going] + j + 1]
                prefix, lang = h[place], lang_of[of[place]]
                into = _part(names, lang, prefix, follows, split)
                group = mixed(prefix + mixed(lang.astype(np.uint64) * np.uint64(1 << 32) + into.astype(np.uint64)))
                whole = group
                for j in range(most - 1):
                    whole = mixed(whole + follows[:, j])
                # Only what is next to each other depends on this order, not what counts as equal.
                order = np.argsort((group & np.uint64(0xFFFFFFFF << 32)) | (whole >> np.uint64(32)))
                prefix, lang, into, follows = prefix[order], lang[order], into[order], follows[order]
                row = _changes(prefix, lang, into)
                first = np.flatnonzero(row | _changes(*follows.T))
                packed = np.zeros(len(first), kind)
                packed["next"], packed["n"] = follows[first], np.diff(np.append(first, len(order)))
                starts = np.flatnonzero(row[first])
                length = np.diff(np.append(starts, len(first)))
                pieces = -(-length // PACKED)
                cut = np.repeat(starts, pieces) + ranges(np.zeros(len(starts), np.int64), pieces) * PACKED
                to = (np.append(cut, len(first)) * kind.itemsize).astype(np.int64)
                rows = first[cut]
                blobs = pa.Array.from_buffers(pa.large_binary(), len(cut), [None, pa.py_buffer(to), pa.py_buffer(packed.tobytes())])
                arrays = [names.take(pa.array(lang[rows])), pa.array(prefix[rows].view(np.int64)), pa.array(into[rows].astype(np.int32)), blobs.cast(pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["lang", "prefix", "part", "pointers"])

    return run


def _part(names: pa.Array, lang: np.ndarray, prefix: np.ndarray, follows: np.ndarray, split: dict) -> np.ndarray:
    """-1, or of a prefix that is dealt in parts, the part by the two words that follow."""
    out = np.full(len(prefix), -1, np.int64)
    for code, name in enumerate(names.to_pylist()):
        if name in split:
            keys, parts = split[name]
            mine = np.flatnonzero(lang == code)
            i = np.minimum(np.searchsorted(keys, prefix[mine]), len(keys) - 1)
            found = keys[i] == prefix[mine]
            mine, i = mine[found], i[found]
            two = mixed(follows[mine, 0] + np.uint64(1))
            if follows.shape[1] > 1:
                two = mixed(two + follows[mine, 1])
            out[mine] = (two % parts[i].astype(np.uint64)).astype(np.int64)
    return out


def grow(prefix: tuple[int, ...], follows: np.ndarray, n: np.ndarray, least: int, emit, partial: bool = False) -> None:
    """Extend a prefix by each word that follows in at least so many places, depth-first.

    follows: the words after each pointer, n: in how many places. partial: other parts have pointers of the same prefix, so
    its extensions are all given, whatever their counts; but only those that may have frequent extensions are descended into.
    """
    order = np.argsort(follows[:, 0], kind="stable")
    words, n = follows[order, 0], n[order]
    first = np.flatnonzero(_changes(words))
    total = np.add.reduceat(n, first)
    stop = np.append(first[1:], len(words))
    there = words[first] > 0
    given = there if partial else there & (total >= least)
    emit(prefix, words[first[given]], total[given])
    if follows.shape[1] > 1:
        for i in np.flatnonzero(there & (total >= least)):
            rows = slice(first[i], stop[i])
            grow((*prefix, int(words[first[i]])), follows[order[rows], 1:], n[rows], least, emit)


def _grow(most: int, least: int):
    """Frequent phrases of every prefix of sorted packed rows; a prefix's rows may lie in several batches."""
    kind = np.dtype([("next", "<u8", (most - 1,)), ("n", "<u4")])
    schema = pa.schema([("lang", pa.string()), ("words", pa.list_(pa.int64())), ("n", pa.int64())])

    def run(batches):
        held, key = [], None
        out: list[tuple[str, tuple[int, ...], np.ndarray, np.ndarray]] = []

        def finish():
            pointers = (held[0] if len(held) == 1 else np.concatenate(held)).view(kind)
            lang, prefix, part = key
            n = pointers["n"].astype(np.int64)
            if part >= 0 or n.sum() >= least:
                grow((prefix & 0xFFFFFFFFFFFFFFFF,), pointers["next"], n, least, lambda p, w, c: out.append((lang, p, w, c)) if len(w) else None, part >= 0)

        def given():
            langs = [o[0] for o in out for _ in range(len(o[2]))]
            size = [len(o[1]) + 1 for o in out for _ in range(len(o[2]))]
            rows = [np.column_stack([np.tile(np.array(p, np.uint64), (len(w), 1)), w]).ravel() for _, p, w, _ in out]
            words = np.concatenate([*rows, np.zeros(0, np.uint64)]).view(np.int64)
            to = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
            counts = np.concatenate([*(o[3] for o in out), np.zeros(0, np.int64)])
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.ListArray.from_arrays(pa.array(to), pa.array(words)), pa.array(counts)], schema=schema)

        for batch in batches:
            lang = pc.dictionary_encode(batch.column(0))
            code, prefix, part = lang.indices.to_numpy(zero_copy_only=False), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            first = np.flatnonzero(_changes(code, prefix, part))
            at, raw = offsets(batch.column(3)), data(batch.column(3))
            cut = at[np.append(first, len(batch))]
            for i, row in enumerate(zip(lang.dictionary.take(pa.array(code[first])).to_pylist(), prefix[first].tolist(), part[first].tolist(), strict=True)):
                if row != key:
                    if held:
                        finish()
                    held, key = [], row
                held.append(raw[cut[i] : cut[i + 1]])
            if out:
                yield given()
        if held:
            finish()
        if out:
            yield given()

    return run


def count_words(texts: DataFrame, least: int) -> tuple[DataFrame, str, np.uint64]:
    """The table (lang, h, word, n) of all words, its path, and the base under which frequent words' hashes are their own."""
    for base in BASES:
        counted = texts.mapInArrow(_count(base), "lang string, h long, word string, n long")
        words, path = stored(counted.groupBy("lang", "h", "word").agg(F.sum("n").alias("n")))
        shared = words.groupBy("lang", "h").agg(F.count(F.lit(1)).alias("words"), F.max("n").alias("n"))
        if not shared.filter((F.col("words") > 1) & (F.col("n") >= least)).limit(1).count():
            return words, path, base
        delete(texts.sparkSession, path)
    raise ValueError("words share hashes under every base")


def _split(words: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Of each language, the sorted hashes of words whose pointers are dealt in parts, and into how many."""
    split = SPLIT
    while (large := words.filter(F.col("n") > split)).count() > MOST_SPLIT:
        split *= 2
    found: dict[str, list] = {}
    for r in large.select("lang", "h", "n").collect():
        found.setdefault(r.lang, []).append((r.h & 0xFFFFFFFFFFFFFFFF, -(-r.n // split)))
    arrays = {k: (np.array([h for h, _ in v], np.uint64), np.array([n for _, n in v], np.int64)) for k, v in found.items()}
    return {k: (h[o], n[o]) for k, (h, n) in arrays.items() for o in [np.argsort(h)]}


def frequent_phrases(texts: DataFrame, words: DataFrame, base: np.uint64, least: int, most: int) -> DataFrame:
    """(lang, words, a): the hashes of phrases of 2 to most words that occur in at least so many places."""
    frequent = words.filter(F.col("n") >= least)
    bits = key_filter(frequent.select("h"), frequent.count())
    shared = texts.sparkSession.sparkContext.broadcast((bits, _split(words)))
    pointers = texts.mapInArrow(_project(base, most, shared), "lang string, prefix long, part int, pointers binary")
    dealt = pointers.repartition("lang", "prefix", "part").sortWithinPartitions("lang", "prefix", "part")
    grown = dealt.mapInArrow(_grow(most, least), "lang string, words array<long>, n long")
    return grown.groupBy("lang", "words").agg(F.sum("n").alias("a")).filter(F.col("a") >= least)


def _score() -> Column:
    """floor(1000000 a a / (l r)), exact in 38 digits; at most 1000000, as a phrase is no more frequent than its parts."""
    exact = lambda c: f"cast({c} as decimal(15,0))"
    return F.expr(f"(1000000bd * ({exact('a')} * {exact('a')})) div ({exact('l')} * {exact('r')})")


def collocations(docs: DataFrame, least: int = 10, most: int = 3, covered: int = 50, top: int = 2000) -> DataFrame:
    """The first phrases of each language: (lang, rank, phrase, a, l, r, n, score).

    docs: (text, lang). Phrases have 2 to most words and occur in a >= least places. A cut parts a phrase in two, of counts l
    and r; the phrase's score is that of its lowest cut, ties to the shortest first part. A phrase is left out where a longer
    frequent one contains it and has at least covered percent of its count. Ranks are by score, then a, both falling, then
    by the phrase's bytes; n is the number of the language's words.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    words, word_path, base = count_words(texts, least)
    phrases, phrase_path = stored(frequent_phrases(texts, words, base, least, most))
    frequent = words.filter(F.col("n") >= least)
    size = F.size("words")

    longer = phrases.filter(size > 2).select("lang", "a", "words", F.explode(F.sequence(F.lit(2), size - 1)).alias("k"))
    longer = longer.select("lang", "a", "words", "k", F.explode(F.sequence(F.lit(1), size - F.col("k") + 1)).alias("i"))
    inner = longer.groupBy("lang", F.slice("words", F.col("i"), F.col("k")).alias("words")).agg(F.max("a").alias("around"))
    kept = phrases.join(inner, ["lang", "words"], "left").filter(F.coalesce(100 * F.col("around") < covered * F.col("a"), F.lit(True)))

    counts = phrases.unionByName(frequent.select("lang", F.array("h").alias("words"), F.col("n").alias("a")))
    part = lambda name, n: counts.select("lang", F.col("words").alias(name), F.col("a").alias(n))
    cuts = kept.select("lang", "words", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.withColumns({"left": F.slice("words", F.lit(1), F.col("k")), "right": F.slice("words", F.col("k") + 1, size)})
    cuts = cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"])
    best = F.min(F.struct(_score().alias("score"), "k", "l", "r")).alias("best")
    scored = cuts.groupBy("lang", "words").agg(F.first("a").alias("a"), best).select("lang", "words", "a", "best.l", "best.r", "best.score")

    spelled = kept.select("lang", "words", F.posexplode("words").alias("i", "h")).join(frequent.select("lang", "h", "word"), ["lang", "h"])
    spelled = spelled.groupBy("lang", "words").agg(F.sort_array(F.collect_list(F.struct("i", "word"))).alias("in_order"))
    spelled = spelled.select("lang", "words", F.array_join(F.col("in_order.word"), " ").alias("phrase"))
    rows = scored.join(spelled, ["lang", "words"]).drop("words")

    order = F.desc("score"), F.desc("a"), F.asc("phrase")
    some = rows.withColumn("__part", F.pmod(F.xxhash64("phrase"), F.lit(RANKED)))
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "__part").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    first, _ = stored(ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
    delete(spark, word_path)
    delete(spark, phrase_path)
    return first



def collocations_sql(least: int = 10, covered: int = 50, top: int = 2000) -> str:
    """The same in DuckDB SQL, for phrases of two and three words."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    cut = "(1000000::HUGEINT * a * a // (l::HUGEINT * r))::BIGINT"
    return rf"""
    WITH pieces AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM (
      SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{upper}', '{lower}'), '[.,;:!?\x0A-\x0D]')) AS piece
      FROM documents)),
    f1 AS (SELECT lang, w, count(*) AS n FROM (SELECT lang, unnest(ws) AS w FROM pieces) GROUP BY ALL),
    total AS (SELECT lang, sum(n)::BIGINT AS n FROM f1 GROUP BY lang),
    f2 AS (SELECT lang, ws[i] AS x, ws[i + 1] AS y, count(*) AS a
      FROM (SELECT lang, ws, unnest(range(1, len(ws))) AS i FROM pieces) GROUP BY ALL HAVING a >= {least}),
    f3 AS (SELECT lang, ws[i] AS x, ws[i + 1] AS y, ws[i + 2] AS z, count(*) AS a
      FROM (SELECT lang, ws, unnest(range(1, len(ws) - 1)) AS i FROM pieces) GROUP BY ALL HAVING a >= {least}),
    around AS (SELECT lang, x, y, max(a) AS around
      FROM (SELECT lang, x, y, a FROM f3 UNION ALL SELECT lang, y, z, a FROM f3) GROUP BY ALL),
    cuts AS (
      SELECT f2.lang, f2.x || ' ' || f2.y AS phrase, 1 AS k, f2.a, p.n AS l, q.n AS r
      FROM f2 JOIN f1 p ON p.lang = f2.lang AND p.w = f2.x JOIN f1 q ON q.lang = f2.lang AND q.w = f2.y
      LEFT JOIN around o ON o.lang = f2.lang AND o.x = f2.x AND o.y = f2.y WHERE coalesce(100 * around < {covered} * f2.a, true)
      UNION ALL
      SELECT f3.lang, f3.x || ' ' || f3.y || ' ' || z, 1, f3.a, p.n, q.a
      FROM f3 JOIN f1 p ON p.lang = f3.lang AND p.w = f3.x JOIN f2 q ON q.lang = f3.lang AND q.x = f3.y AND q.y = f3.z
      UNION ALL
      SELECT f3.lang, f3.x || ' ' || f3.y || ' ' || z, 2, f3.a, p.a, q.n
      FROM f3 JOIN f2 p ON p.lang = f3.lang AND p.x = f3.x AND p.y = f3.y JOIN f1 q ON q.lang = f3.lang AND q.w = z),
    best AS (SELECT *, {cut} AS score, row_number() OVER (PARTITION BY lang, phrase ORDER BY {cut}, k) AS place FROM cuts),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best WHERE place = 1)
    SELECT ranked.lang, rank, phrase, a, l, r, total.n AS n, score FROM ranked JOIN total USING (lang) WHERE rank <= {top}"""
