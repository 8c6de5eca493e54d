"""Byte-level BPE encoding and decoding.

Pre-tokenisation uses no regular expression. A table gives each code point a class; the class, with a look at the next
characters, picks one of a few transition functions over eight scanner states. Functions compose associatively, so the
text is cut into rows of equal length: each row's functions are composed, the row results are scanned by doubling,
and one more pass with the known row states marks the boundaries, all in NumPy over a few MB of text at a time.

The slices between boundaries become an Arrow binary array without a copy. Its distinct values are looked up in a
cache of merged pieces, kept by each Python worker; only values not met before are merged pair by pair.
Token ids are kept as little-endian 32-bit integers in a binary column, with each token's byte offset for decoding.
"""

import base64
import functools
import heapq
import sys

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import data, offsets, ranges, text_batches

# Classes of code points.
LETTER, NUMBER, OTHER, SPACE = range(4)
# Symbols of the scanner: the three classes; a space character that more of its kind or the end follow; a blank and
# another space character that are last of their run; an apostrophe that can open a contraction of one or two letters.
L, N, O, RUN, BLANK, LAST, APOS1, APOS2 = range(8)
# States: no open token, open runs of each kind, a blank waiting for its word, letters that a contraction still takes.
NONE, IN_L, IN_N, IN_O, IN_SPACE, WAITING, NEED1, NEED2 = range(8)
#: The pattern that the scanner stands for.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The letters that follow the apostrophe in a contraction.
ONE_LETTER, TWO_LETTERS = ("s", "t", "m", "d"), ("re", "ve", "ll")
#: Characters composed one by one within a row of the scan.
ROW = 256
#: Pieces that a worker's cache holds before it starts anew.
CACHE = 200_000
#: Bytes of text handled at once.
SLICE = 1 << 20


@functools.cache
def class_table() -> np.ndarray:
    """Class of each code point, as the Unicode version of the tokenizer library has it.

    Python's own tables are of another version. With bytes as tokens, encoding all characters by a class returns the
    bytes of its members.
    """
    everything = "".join(map(chr, (*range(0xD800), *range(0xE000, sys.maxunicode + 1))))
    single = {bytes([i]): i for i in range(256)}
    table = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        of_kind = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        members = bytes(of_kind.encode_ordinary(everything)).decode()
        table[np.frombuffer(members.encode("utf-32-le"), np.uint32)] = kind
    return table


@functools.cache
def machine() -> tuple[np.ndarray, np.ndarray]:
    """Next state and whether a token starts, by symbol * 8 + state; symbols from 8 on are the first of a text."""

    def step(symbol: int, state: int) -> tuple[int, bool]:
        if symbol == L and state in (NEED1, NEED2):
            return (NONE if state == NEED1 else NEED1), False
        if symbol in (APOS1, APOS2):
            return (IN_O, False) if state in (IN_O, WAITING) else (NEED1 if symbol == APOS1 else NEED2, True)
        if symbol in (L, N, O):
            run = {L: IN_L, N: IN_N, O: IN_O}[symbol]
            return run, state not in (run, WAITING)
        if symbol == RUN:
            return IN_SPACE, state != IN_SPACE
        return (WAITING if symbol == BLANK else NONE), True

    pairs = [step(s % 8, state if s < 8 else NONE) for s in range(16) for state in range(8)]
    return np.array([p[0] for p in pairs], np.uint8), np.array([p[1] for p in pairs])


def symbols(code: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Scanner symbols of code points; first: indices at which texts start."""
    kind = class_table()[code]
    ends = np.zeros(len(code) + 1, bool)
    ends[first] = ends[-1] = True
    word_next = np.zeros(len(code), bool)
    word_next[:-1] = kind[1:] != SPACE
    word_next[ends[1:]] = False
    last = (kind == SPACE) & word_next
    out = kind.copy()
    out[last] = np.where(code[last] == 32, BLANK, LAST)
    apostrophes = np.flatnonzero(code == 39)
    if len(apostrophes):
        pad = np.concatenate([code, np.zeros(2, code.dtype)])
        a, b = pad[apostrophes + 1], pad[apostrophes + 2]
        open1, open2 = ~ends[apostrophes + 1], ~ends[apostrophes + 1] & ~ends[np.minimum(apostrophes + 2, len(code))]
        one = open1 & np.isin(a, [ord(c) for c in ONE_LETTER])
        two = open2 & np.logical_or.reduce([(a == ord(x)) & (b == ord(y)) for x, y in TWO_LETTERS])
        out[apostrophes[one]], out[apostrophes[two]] = APOS1, APOS2
    out[first[first < len(code)]] += 8
    return out


def boundaries(code: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Indices of code points at which tokens start."""
    n = len(code)
    if not n:
        return np.zeros(0, np.int64)
    to, opens = machine()
    rows = -(-n // ROW)
    grid = np.full(rows * ROW, 8 + O, np.uint8)
    grid[:n] = symbols(code, first)
    columns = np.ascontiguousarray(grid.reshape(rows, ROW).T).astype(np.int16) * 8
    row = np.tile(np.arange(8, dtype=np.uint8), (rows, 1))
    for c in columns:
        row = to[c[:, None] + row]
    reach = 1
    while reach < rows:  # each row's function after all rows before it, by doubling
        row[reach:] = np.take_along_axis(row[reach:], row[:-reach].copy(), 1)
        reach *= 2
    state = np.zeros(rows, np.uint8)
    state[1:] = row[:-1, NONE]
    starts = np.empty((ROW, rows), bool)
    for k, c in enumerate(columns):
        at = c + state
        starts[k], state = opens[at], to[at]
    return np.flatnonzero(starts.T.ravel()[:n])


def pieces(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Byte offsets of the pieces of concatenated UTF-8 texts, with the end."""
    raw = text.tobytes()
    code = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
    if len(code) == len(text):
        starts = boundaries(code, at[:-1])
    else:
        lead = np.flatnonzero((text & 0xC0) != 0x80)
        starts = lead[boundaries(code, np.searchsorted(lead, at[:-1]))]
    return np.append(starts, len(text))


@functools.cache
def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks from a file of base64 token and rank lines."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: adjacent parts of the lowest rank merge first, leftmost first among equals."""
    if piece in ranks:
        return [ranks[piece]]
    ends = list(range(1, len(piece) + 1))  # end of the part that starts here
    back = list(range(-1, len(piece) - 1))  # start of the part before
    size = len(piece)
    heap = []

    def offer(i: int) -> None:
        j = ends[i]
        if j < size and (rank := ranks.get(piece[i : ends[j]])) is not None:
            heap.append((rank, i, ends[j]))

    for i in range(size - 1):
        offer(i)
    heapq.heapify(heap)
    gone = bytearray(size)
    while heap:
        rank, i, end = heapq.heappop(heap)
        j = ends[i]
        if gone[i] or j >= size or ends[j] != end:
            continue
        gone[j], ends[i] = 1, end
        if end < size:
            back[end] = i
        for k in (back[i], i):
            if k >= 0 and (j := ends[k]) < size and (rank := ranks.get(piece[k : ends[j]])) is not None:
                heapq.heappush(heap, (rank, k, ends[j]))
    out, i = [], 0
    while i < size:
        out.append(ranks[piece[i : ends[i]]])
        i = ends[i]
    return out


@functools.cache
def pair_table(path: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys left * 2**32 + right of the pairs of tokens that join to a token, and that token."""
    ranks = load_ranks(path)
    found = {}
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            left, right = ranks.get(token[:i]), ranks.get(token[i:])
            if left is not None and right is not None:
                found[left << 32 | right] = rank
    keys = np.array(sorted(found), np.int64)
    return keys, np.array([found[k] for k in keys.tolist()], np.int64)


#: No pair: above every rank.
NO_RANK = np.int64(1) << 40
#: Longer pieces are merged by a heap, one by one.
SHORT = 48


def merge_many(text: np.ndarray, at: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of many short pieces at once, and the number of ids of each.

    In each round every piece merges its pair of lowest rank, leftmost first; only the pairs beside a merge are looked
    up again. Pieces without a pair leave the rounds.
    """
    keys, joined = pair_table(path)
    ranks = load_ranks(path)
    single = np.array([ranks[bytes([i])] for i in range(256)], np.int64)

    def look(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pair = left << 32 | right
        i = np.minimum(np.searchsorted(keys, pair), len(keys) - 1)
        return np.where(keys[i] == pair, joined[i], NO_RANK)

    token, first = single[text], at[:-1].astype(np.int64)
    n = len(first)
    which = np.arange(n)
    done_token, done_which = [], []
    last = np.zeros(len(token), bool)
    last[at[1:] - 1] = True
    rank = np.full(len(token), NO_RANK)
    inner = np.flatnonzero(~last)
    rank[inner] = look(token[inner], token[inner + 1])
    while len(first):
        size = np.diff(np.append(first, len(token)))
        place = np.arange(len(token)) - np.repeat(first, size)
        best = np.minimum.reduceat(rank * 64 + place, first)
        open_ = best < NO_RANK * 64
        if not open_.all():
            keep = np.repeat(open_, size)
            done_token.append(token[~keep])
            done_which.append(np.repeat(which[~open_], size[~open_]))
            token, rank, last, size, which, best = token[keep], rank[keep], last[keep], size[open_], which[open_], best[open_]
            if not len(size):
                break
            first = np.cumsum(size) - size
        i = first + best % 64
        token[i], last[i] = best // 64, last[i + 1]
        stay = np.ones(len(token), bool)
        stay[i + 1] = False
        token, rank, last = token[stay], rank[stay], last[stay]
        i -= np.arange(len(i))
        first = first - np.arange(len(first))
        ends = last[i]
        rank[i[ends]] = NO_RANK
        rank[i[~ends]] = look(token[i[~ends]], token[i[~ends] + 1])
        before = i[i > first] - 1
        rank[before] = look(token[before], token[before + 1])
    token, which = np.concatenate([*done_token, np.zeros(0, np.int64)]), np.concatenate([*done_which, np.zeros(0, np.int64)])
    order = np.argsort(which, kind="stable")
    return token[order], np.bincount(which, minlength=n)


class Encoder:
    """Ranks with a bounded cache of merged pieces."""

    def __init__(self, path: str):
        self.path = path
        self.clear()

    def clear(self) -> None:
        self.slots: dict[bytes, int] = {}
        self.ids = np.zeros(0, np.uint32)
        self.starts = np.zeros(1, np.int64)

    def _learn(self, new: list[bytes]) -> None:
        short = [p for p in new if len(p) <= SHORT]
        raw = np.frombuffer(b"".join(short), np.uint8)
        ids, counts = merge_many(raw, np.concatenate([[0], np.cumsum([len(p) for p in short])]).astype(np.int64), self.path)
        ranks = load_ranks(self.path)
        long = [p for p in new if len(p) > SHORT]
        more = [merge(p, ranks) for p in long]
        ids = np.concatenate([ids, *map(np.array, more)]).astype(np.uint32)
        counts = np.concatenate([counts, [len(m) for m in more]]).astype(np.int64)
        for p in (*short, *long):
            self.slots[p] = len(self.slots)
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(counts)])
        self.ids = np.concatenate([self.ids, ids])

    def encode(self, text: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of concatenated texts, and the number of ids of each."""
        if len(self.slots) > CACHE:
            self.clear()
        cut = pieces(text, at)
        buffers = [None, pa.py_buffer(cut.astype(np.int32)), pa.py_buffer(text)]
        coded = pa.Array.from_buffers(pa.binary(), len(cut) - 1, buffers).dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if new := [p for p in distinct if p not in self.slots]:
            self._learn(new)
        slot = np.array([self.slots[p] for p in distinct], np.int64)[coded.indices.to_numpy()]
        counts = self.starts[slot + 1] - self.starts[slot]
        ids = self.ids[ranges(self.starts[slot], counts)]
        before = np.concatenate([[0], np.cumsum(counts)])
        return ids, np.diff(before[np.searchsorted(cut[:-1], at)])


@functools.cache
def token_table(path: str) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all tokens in order of rank, and their offsets."""
    ranks = load_ranks(path)
    tokens = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return np.frombuffer(b"".join(tokens), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in tokens])])


@functools.cache
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def _binary(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Binary array of consecutive slices of values."""
    at = np.concatenate([[0], np.cumsum(counts)]) * values.itemsize
    return pa.Array.from_buffers(
        pa.binary(), len(counts), [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))]
    )


def valid_text(column: str = "text"):
    """Text with bytes that aren't UTF-8 replaced, as Spark may hold such strings; null stays null."""
    return F.when(F.is_valid_utf8(column), F.col(column)).otherwise(F.make_valid_utf8(column))


def decoded_bytes(ids: np.ndarray, counts: np.ndarray, path: str, ends: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of concatenated id lists, and the number of bytes of each list. With ends, the end offsets of the tokens in
    their texts, each token's bytes are put where its offset says."""
    table, at = token_table(path)
    lengths = np.diff(at)[ids]
    cut = np.concatenate([[0], np.cumsum(counts)])
    if ends is None:
        ends = np.cumsum(lengths) - np.repeat(np.concatenate([[0], np.cumsum(lengths)])[cut[:-1]], counts)
    ends = ends.astype(np.int64)
    size = np.zeros(len(counts), np.int64)
    size[counts > 0] = ends[cut[1:][counts > 0] - 1]
    first = np.repeat(np.cumsum(size) - size, counts) + ends - lengths
    out = np.zeros(int(size.sum()), np.uint8)
    out[ranges(first, lengths)] = table[ranges(at[ids], lengths)]
    return out, size


def _same(text: np.ndarray, at: np.ndarray, back: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Which texts equal their decoded forms."""
    cut = np.concatenate([[0], np.cumsum(size)])
    raw, other = text.tobytes(), back.tobytes()
    return np.array([raw[at[i] : at[i + 1]] == other[cut[i] : cut[i + 1]] for i in range(len(size))], bool)


def encode(
    docs: DataFrame, ranks: str, keep: tuple[str, ...] = ("doc_id",), with_offsets: bool = True, verify: bool = False
) -> DataFrame:
    """keep, ids and (with_offsets) ends: token ids and end byte offsets as little-endian 32-bit integers.

    With verify, round_trip says whether decoding, by the offsets, gave the text back. ranks: path of a rank file that
    every executor can read. Null and empty texts give no ids. Every row is encoded for itself, so ties and repeated rows
    don't matter; columns of docs other than keep are not read.
    """
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches):
        encoder = _encoder(ranks)
        lengths = np.diff(token_table(ranks)[1])
        for batch in batches:
            for part, text, at in text_batches(batch, "__text", SLICE):
                ids, counts = encoder.encode(text, at)
                out = [part.column(i) for i in range(len(keep))] + [_binary(ids.astype("<u4"), counts)]
                so_far = np.concatenate([[0], np.cumsum(lengths[ids])])
                first = np.concatenate([[0], np.cumsum(counts)])[:-1]
                ends = (so_far[1:] - np.repeat(so_far[first], counts)).astype("<u4")
                if with_offsets:
                    out.append(_binary(ends, counts))
                if verify:
                    out.append(pa.array(_same(text, at, *decoded_bytes(ids, counts, ranks, ends))))
                yield pa.RecordBatch.from_arrays(out, names=[*keep, "ids", *["ends"] * with_offsets, *["round_trip"] * verify])

    more = (", ends binary" if with_offsets else "") + (", round_trip boolean" if verify else "")
    return docs.select(*keep, valid_text().alias("__text")).mapInArrow(run, f"{fields}, ids binary{more}")


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """encoded with decoded: the bytes that the ids stand for, each token's where its offset in ends says, or one after the
    other where there is no column ends; null ids are none."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    names = [*encoded.columns, "decoded"]

    def run(batches):
        for batch in batches:
            for part, raw, cut in text_batches(batch, "ids", SLICE):
                ids, ends = np.frombuffer(raw.tobytes(), "<u4"), None
                if "ends" in names[:-1]:
                    column = part.column(names.index("ends"))
                    at = offsets(column)
                    ends = np.frombuffer(data(column)[at[0] : at[-1]].tobytes(), "<u4")
                decoded = _binary(*decoded_bytes(ids, np.diff(cut // 4), ranks, ends))
                yield pa.RecordBatch.from_arrays([*part.columns, decoded], names=names)

    return encoded.mapInArrow(run, f"{fields}, decoded binary")


def tokens_between(encoded: DataFrame, begin: int, end: int) -> DataFrame:
    """encoded with part_ids and part_begin: the tokens that cover bytes begin to end of each text, found by their offsets,
    and where the first of them begins. Rows without such tokens have none."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    names = [*encoded.columns, "part_ids", "part_begin"]

    def run(batches):
        for batch in batches:
            ids, ends = (batch.column(names.index(c)).to_pylist() for c in ("ids", "ends"))
            parts, begins = [], []
            for i, e in zip(ids, ends, strict=True):
                at = np.frombuffer(e or b"", "<u4")
                first, last = np.searchsorted(at, begin, "right"), np.searchsorted(at, end, "left") + 1
                parts.append((i or b"")[4 * first : 4 * last])
                begins.append(int(at[first - 1]) if first else 0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(parts, pa.binary()), pa.array(begins, pa.int64())], names=names)

    return encoded.mapInArrow(run, f"{fields}, part_ids binary, part_begin long")
