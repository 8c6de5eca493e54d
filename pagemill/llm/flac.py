"""FLAC media columns: bytes as 8-bit mono samples, encoded and decoded losslessly.

The bit streams of many frames are written and read in lockstep: NumPy handles the same sample of all frames of a few
MB of media at once, so no loop runs over samples of one stream. Streams are complete FLAC files with STREAMINFO and
its MD5, frames of BLOCK samples with CRC-8 headers and CRC-16 footers, and constant, verbatim, fixed and linear-predictor
subframes with Rice residuals. What is read is this subset: mono, 8 bits, blocks of BLOCK samples, 4-bit Rice parameters.

Frames are found by their sync codes and accepted if the header's CRC holds and the frame numbers run on; a stream with
a missing frame, a wrong CRC or a wrong MD5 is reported as damaged and yields no samples.
"""

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm.bpe import _binary
from pagemill.llm.common import ranges, text_batches

BLOCK = 192
RATE = 8000
PAD = 32
HEADER = 42
#: Bytes of media or payload handled at once.
SLICE = 1 << 20
# Kinds of subframes; fixed and linear ones differ from FIXED and LINEAR on by their order.
CONSTANT, VERBATIM, FIXED, LINEAR = 0, 1, 8, 32
#: Linear prediction as encoded: order, bits of a coefficient, and the shift of a prediction.
ORDER, PRECISION, SHIFT = 2, 8, 6
# Predictors of the fixed subframes by order.
FIXED_TAPS = ((), (1,), (2, -1), (3, -3, 1), (4, -6, 4, -1))
#: Sync code with fixed block size, 192 samples, the stream's rate, one channel, 8 bits.
SYNC = (0xFF, 0xF8, 0x10, 0x02)


@functools.cache
def crc_table(poly: int, bits: int) -> np.ndarray:
    out = np.arange(256, dtype=np.uint32) << (bits - 8)
    for _ in range(8):
        out = np.where(out >> (bits - 1) & 1, out << 1 ^ poly, out << 1) & ((1 << bits) - 1)
    return out.astype(np.uint16)


def crcs(raw: np.ndarray, start: np.ndarray, end: np.ndarray, poly: int, bits: int) -> np.ndarray:
    """CRC of each raw[start:end]. Slices are aligned at their ends: zeros before a slice leave a CRC at 0."""
    table, out = crc_table(poly, bits), np.zeros(len(start), np.uint16)
    longest = int((end - start).max(initial=0))
    high, mask = np.uint16(bits - 8), np.uint16((1 << bits) - 1)
    for i in range(longest, 0, -1):
        at = end - i
        byte = np.where(at >= start, raw[np.maximum(at, 0)], 0)
        out = (table[(out >> high) ^ byte] ^ (out << np.uint16(8))) & mask
    return out


def crc8(raw, start, end):
    return crcs(raw, start, end, 0x07, 8)


def crc16(raw, start, end):
    return crcs(raw, start, end, 0x8005, 16)


def _number_bytes(number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Frame numbers coded like UTF-8, as rows of 6 bytes, and their lengths."""
    n = number.astype(np.int64)
    size = 1 + (n >= 1 << 7) + (n >= 1 << 11) + (n >= 1 << 16) + (n >= 1 << 21) + (n >= 1 << 26)
    lead = np.array([0, 0x00, 0xC0, 0xE0, 0xF0, 0xF8, 0xFC])
    out = np.zeros((len(n), 6), np.uint8)
    for i in range(6):
        shift = 6 * np.maximum(size - 1 - i, 0)
        out[:, i] = np.where(i == 0, lead[size] | n >> shift, 0x80 | (n >> shift & 63))
    return out, size


def _residuals(x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Linear coefficients, and the residuals of frames x by the four predictors with the warm-up samples zeroed."""
    zero = x.copy()
    one = np.zeros_like(x)
    one[:, 1:] = x[:, 1:] - x[:, :-1]
    two = np.zeros_like(x)
    two[:, 2:] = one[:, 2:] - one[:, 1:-1]
    f = x.astype(np.float32)
    r0, r1, r2 = ((f[:, i:] * f[:, : BLOCK - i]).sum(1) for i in range(3))
    det = r0 * r0 - r1 * r1
    det = np.where(det > 0, det, 1)
    taps = np.stack([r1 * (r0 - r2), r0 * r2 - r1 * r1], 1) / det[:, None]
    taps = np.clip(np.rint(taps * (1 << SHIFT)), -128, 127).astype(np.int32)
    linear = np.zeros_like(x)
    guess = (taps[:, :1] * x[:, 1:-1] + taps[:, 1:] * x[:, :-2]) >> SHIFT
    linear[:, 2:] = x[:, 2:] - guess
    return taps, [zero, one, two, linear]


def encode_frames(samples: np.ndarray, number: np.ndarray, lead: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Frames (n, BLOCK) of signed samples as bytes, each preceded by lead zero bytes, and the end of each frame."""
    x = samples.astype(np.int16)
    n = len(x)
    taps, all_ = _residuals(x)
    orders = np.array([0, 1, 2, ORDER])
    weight = np.stack([np.abs(r).sum(1, dtype=np.int64) for r in all_], 1)
    best = weight.argmin(1)
    res = np.stack(all_)[best, np.arange(n)]
    order = orders[best]
    coded = ((res << 1) ^ (res >> 15)).view(np.uint16)
    inner = np.arange(BLOCK) >= order[:, None]
    costs = np.stack([(coded >> k).sum(1, dtype=np.int64) + (1 + k) * (BLOCK - order) for k in range(9)], 1)
    rice = costs.argmin(1)
    head_bits = 8 * order + np.where(best == 3, 9 + ORDER * PRECISION, 0) + 10
    body = np.minimum(head_bits + costs.min(1), 8 * BLOCK)
    verbatim = body == 8 * BLOCK
    constant = (x == x[:, :1]).all(1)
    body = np.where(constant, 8, body)
    predicted = ~(verbatim | constant)
    numbers, size = _number_bytes(number)
    header = 4 + size + 1
    length = header + 1 + (body + 7) // 8 + 2
    end = np.cumsum(lead + length)
    start = end - length
    bits = np.zeros(int(end[-1]) * 8 if n else 0, np.uint8)
    # residuals of the predicted frames
    p = np.flatnonzero(predicted)
    at_body = (start + header + 1) * 8
    u, k = coded[p].astype(np.int64), rice[p]
    sizes = np.where(inner[p], (u >> k[:, None]) + 1 + k[:, None], 0)
    pos = (at_body + head_bits)[p][:, None] + np.cumsum(sizes, 1) - sizes
    live = inner[p]
    stop = (pos + (u >> k[:, None]))[live]
    bits[stop] = 1
    k_of, u_of = np.broadcast_to(k[:, None], u.shape)[live], u[live]
    for j in range(int(k.max(initial=0))):
        use = k_of > j if j >= int(k.min(initial=0)) else slice(None)
        bits[stop[use] + 1 + j] = u_of[use] >> (k_of[use] - 1 - j) & 1

    def put(where: np.ndarray, value: np.ndarray, width: int) -> None:
        for j in range(width):
            bits[where + j] = value >> (width - 1 - j) & 1

    put((at_body + head_bits)[p] - 4, k, 4)
    lpc = np.flatnonzero(predicted & (best == 3))
    at = at_body[lpc] + 8 * ORDER
    put(at, np.full(len(lpc), PRECISION - 1), 4)
    put(at + 4, np.full(len(lpc), SHIFT), 5)
    for t in range(ORDER):
        put(at + 9 + t * PRECISION, taps[lpc, t] & 0xFF, PRECISION)
    out = np.packbits(bits)
    # whole bytes: headers, warm-up, verbatim and constant samples
    for i, b in enumerate(SYNC):
        out[start + i] = b
    for i in range(6):
        use = size > i
        out[(start + 4 + i)[use]] = numbers[use, i]
    out[start + header - 1] = crc8(out, start, start + header - 1)
    kind = np.where(best == 3, LINEAR + ORDER - 1, FIXED + order)
    kind = np.where(constant, CONSTANT, np.where(verbatim, VERBATIM, kind))
    out[start + header] = kind << 1
    byte = x.astype(np.int8).view(np.uint8)
    for i in range(2):
        use = predicted & (order > i)
        out[(start + header + 1 + i)[use]] = byte[use, i]
    out[(start + header + 1)[constant]] = byte[constant, 0]
    whole = np.flatnonzero(verbatim & ~constant)
    out[(start + header + 1)[whole][:, None] + np.arange(BLOCK)] = byte[whole]
    crc = crc16(out, start, end - 2)
    out[end - 2], out[end - 1] = crc >> 8, crc & 0xFF
    return out, end


def stream_header(n: int, least: int, most: int, md5: bytes) -> bytes:
    """Signature and STREAMINFO of n samples with frames of so many bytes."""
    info = BLOCK.to_bytes(2) * 2 + least.to_bytes(3) + most.to_bytes(3)
    return b"fLaC\x80\x00\x00\x22" + info + (RATE << 44 | 0 << 41 | 7 << 36 | n).to_bytes(8) + md5


def padded(text: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with spaces up to a positive multiple of BLOCK bytes, and their sizes."""
    size = np.diff(at)
    full = np.maximum(-(-size // BLOCK), 1) * BLOCK
    out = np.full(int(full.sum()), PAD, np.uint8)
    out[ranges(np.cumsum(full) - full, size)] = text
    return out, full


def encode_many(payload: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Streams of concatenated payloads, and the size of each."""
    samples = payload ^ 0x80
    frames = size // BLOCK
    first = np.cumsum(frames) - frames
    number = ranges(np.zeros(len(size), np.int64), frames)
    lead = np.zeros(len(number), np.int64)
    lead[first] = HEADER
    out, end = encode_frames(samples.view(np.int8).reshape(-1, BLOCK), number, lead)
    start = np.concatenate([[0], end[first[1:] - 1]]) if len(size) else end
    stop = end[first + frames - 1]
    sample_at = np.concatenate([[0], np.cumsum(size)])
    raw = samples.tobytes()
    frame_size = np.diff(end, prepend=0) - lead
    for i in range(len(size)):
        own = frame_size[first[i] : first[i] + frames[i]]
        md5 = hashlib.md5(raw[sample_at[i] : sample_at[i + 1]]).digest()
        head = stream_header(int(size[i]), int(own.min()), int(own.max()), md5)
        out[start[i] : start[i] + HEADER] = np.frombuffer(head, np.uint8)
    return out, stop - start


def _find_frames(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(stream, start, header size, number) of the frames whose header CRC holds."""
    tail = np.concatenate([raw, np.zeros(8, np.uint8)])
    hit = np.flatnonzero(raw == SYNC[0])
    for i in range(1, 4):
        hit = hit[tail[hit + i] == SYNC[i]]
    lead = tail[hit + 4]
    size = np.select([lead < 0x80, lead < 0xC0, lead < 0xE0, lead < 0xF0, lead < 0xF8, lead < 0xFC], [1, 0, 2, 3, 4, 5], 6)
    number = np.where(size == 1, lead, lead & (0xFF >> np.minimum(size + 1, 7))).astype(np.int64)
    for i in range(1, 6):
        use = size > i
        number[use] = number[use] << 6 | (tail[hit[use] + 4 + i] & 63)
    good = (size > 0) & (crc8(tail, hit, hit + 4 + size) == tail[hit + 4 + size])
    return np.searchsorted(at, hit[good], "right") - 1, hit[good], size[good] + 5, number[good]


def _read_frames(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signed samples (n, BLOCK) of frames whose subframes lie in raw[start:end], and which of them could be read."""
    n = len(start)
    out = np.zeros((BLOCK, n), np.int32)
    tail = np.concatenate([raw, np.zeros(BLOCK + 8, np.uint8)])
    kind = tail[start] >> 1
    constant, verbatim = kind == CONSTANT, kind == VERBATIM
    out[:, constant] = tail[start[constant] + 1].view(np.int8)
    at = start[verbatim] + 1
    out[:, verbatim] = tail[at[:, None] + np.arange(BLOCK)].view(np.int8).T
    fixed = (kind >= FIXED) & (kind < FIXED + len(FIXED_TAPS))
    linear = kind >= LINEAR
    good = constant | verbatim | fixed | linear
    p = np.flatnonzero(fixed | linear)
    if not len(p):
        return out.T, good
    order = np.where(fixed, kind - FIXED, kind - LINEAR + 1)[p].astype(np.int64)
    lin = linear[p]
    bits = np.unpackbits(tail)
    word = tail[:-4].astype(np.int64) << 24 | tail[1:-3].astype(np.int64) << 16 | tail[2:-2].astype(np.int64) << 8 | tail[3:-1]
    limit = len(word) * 8 - 64

    def take(where: np.ndarray, width) -> np.ndarray:
        where = np.minimum(where, limit)
        return word[where >> 3] >> (32 - width - (where & 7)) & ((1 << width) - 1)

    most = int(order.max())
    taps, shift = np.zeros((most, len(p)), np.int32), np.zeros(len(p), np.int64)
    for o, values in enumerate(FIXED_TAPS):
        for t, v in enumerate(values[:most]):
            taps[t, ~lin & (order == o)] = v
    pos = (start[p] + 1 + order) * 8
    width = take(pos, 4) + 1
    shift[lin] = take(pos + 4, 5)[lin]
    for t in range(most):
        use = lin & (order > t)
        value = take(pos + 9 + t * width, width)
        taps[t, use] = (value - (value >> (width - 1) << width))[use]
    pos = pos + np.where(lin, 9 + order * width, 0)
    rice = take(pos + 6, 4)
    good[p] &= (take(pos, 6) == 0) & (rice < 15) & (shift < 16)
    pos = pos + 10
    one = np.where(bits, np.arange(len(bits), dtype=np.int32), np.int32(len(bits) - 1))
    next_one = np.minimum.accumulate(one[::-1])[::-1]
    x = np.zeros((BLOCK, len(p)), np.int32)
    low = (1 << rice) - 1
    last_bit = len(bits) - 1
    for i in range(BLOCK):
        live = i >= order
        stop = next_one[np.minimum(pos, last_bit)]
        u = (stop - pos) << rice | (take(stop + 1, rice) & low)
        value = u >> 1 ^ -(u & 1)
        if i >= most:
            pos = stop + 1 + rice
        else:
            pos = np.where(live, stop + 1 + rice, pos)
            value = np.where(live, value, tail[start[p] + 1 + i].view(np.int8))
        guess = np.zeros(len(p), np.int32)
        for t in range(min(most, i)):
            guess += taps[t] * x[i - 1 - t]
        x[i] = value + (guess >> shift) if i >= most else np.where(live, value + (guess >> shift), value)
    good[p] &= pos <= (end[p] * 8)
    out[:, p] = x
    return out.T, good


def decode_many(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Payload bytes of concatenated streams, the size of each, and which are sound. A damaged stream has no bytes."""
    n = len(at) - 1
    media = raw.tobytes()
    samples, md5s = np.zeros(n, np.int64), []
    sound = np.zeros(n, bool)
    for i in range(n):
        head = media[at[i] : at[i] + HEADER]
        sound[i] = len(head) == HEADER and head[:8] == b"fLaC\x80\x00\x00\x22" and head[8:12] == BLOCK.to_bytes(2) * 2
        info = int.from_bytes(head[18:26])
        sound[i] &= info >> 36 == RATE << 8 | 7
        samples[i] = info & ((1 << 36) - 1) if sound[i] else 0
        md5s.append(head[26:])
    sound &= (samples % BLOCK == 0) & (samples <= len(raw) * BLOCK)
    frames = np.where(sound, samples // BLOCK, 0)
    stream, start, header, number = _find_frames(raw, at[:-1])
    # of the hits in a stream, its frames are those whose numbers count up from 0
    order = np.lexsort((start, number, stream))
    key = stream[order] << 40 | number[order]
    wanted = np.repeat(np.arange(n), frames) << 40 | ranges(np.zeros(n, np.int64), frames)
    i = np.minimum(np.searchsorted(key, wanted), max(len(key) - 1, 0))
    found = (key[i] == wanted) if len(key) else np.zeros(len(wanted), bool)
    of = np.repeat(np.arange(n), frames)
    sound[of[~found]] = False
    f = order[i][sound[of]] if len(key) else np.zeros(0, np.int64)
    of = of[sound[of]]
    begin = start[f]
    last = np.append(of[1:] != of[:-1], True) if len(of) else np.zeros(0, bool)
    end = np.where(last, at[of + 1], np.append(begin[1:], 0)) if len(of) else begin
    proper = end - begin >= 10
    crc = crc16(raw, begin, np.maximum(end - 2, begin))
    proper &= crc == (raw[np.maximum(end - 2, 0)].astype(np.uint16) << 8 | raw[np.maximum(end - 1, 0)])
    values, good = _read_frames(raw, begin + header[f], end - 2)
    sound[of[~(proper & good)]] = False
    values = values[sound[of]].astype(np.int8).view(np.uint8).ravel()
    size = np.where(sound, samples, 0)
    cut = np.concatenate([[0], np.cumsum(size)])
    flat = values.tobytes()
    for j in np.flatnonzero(sound):
        if hashlib.md5(flat[cut[j] : cut[j + 1]]).digest() != md5s[j]:
            sound[j] = False
    keep = np.repeat(sound, size)
    return (values ^ 0x80)[keep], np.where(sound, size, 0), sound


def features(payload: np.ndarray, size: np.ndarray) -> list[str]:
    """peak, mean absolute sample and sign changes of each payload's samples; empty without samples."""
    x = (payload ^ 0x80).view(np.int8).astype(np.int64)
    full = size > 0
    first = (np.cumsum(size) - size)[full]
    change = np.concatenate([[False], (x[1:] < 0) != (x[:-1] < 0)]) if len(x) else np.zeros(0, bool)
    change[first] = False
    out = np.full(len(size), "", object)
    if len(first):
        peak, total = np.maximum.reduceat(np.abs(x), first), np.add.reduceat(np.abs(x), first)
        flips = np.add.reduceat(change.astype(np.int64), first)
        out[full] = [f"peak={a};sum={b};flips={c}" for a, b, c in zip(peak.tolist(), total.tolist(), flips.tolist(), strict=True)]
    return out.tolist()


def encode(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep, n_bytes and media: each text's bytes, padded with spaces to a positive multiple of BLOCK, as a stream.

    Null texts are empty; empty texts give a block of spaces. Rows are handled for themselves; equal texts give equal
    media. Columns of docs other than keep are not read.
    """
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    names = [*keep, "n_bytes", "media"]

    def run(batches):
        for batch in batches:
            for part, text, at in text_batches(batch, "__text", SLICE):
                payload, size = padded(text, at)
                media, length = encode_many(payload, size)
                columns = [*(part.column(i) for i in range(len(keep))), pa.array(np.diff(at), pa.int64()), _binary(media, length)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(*keep, F.col("text").alias("__text")).mapInArrow(run, f"{fields}, n_bytes long, media binary")


def decode(media: DataFrame) -> DataFrame:
    """media with sound, pcm (unsigned 8-bit samples; null if damaged or null) and feature."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in media.schema)
    names = [*media.columns, "sound", "pcm", "feature"]

    def run(batches):
        for batch in batches:
            for part, raw, at in text_batches(batch, "media", SLICE):
                payload, size, sound = decode_many(raw, at)
                pcm = _binary(payload, size)
                pcm = pa.compute.if_else(pa.array(sound), pcm, pa.scalar(None, pa.binary()))
                columns = [*part.columns, pa.array(sound), pcm, pa.array(features(payload, size), pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return media.mapInArrow(run, f"{fields}, sound boolean, pcm binary, feature string")


PCM_BLOCKS = "array<struct<sample_offset:bigint,samples:binary>>"


def decode_blocks(media: DataFrame, blocks: int = 64) -> DataFrame:
    """media with sound, pcm_blocks and feature: the samples as an array of (sample_offset, samples), of so many blocks each.

    A reader seeks by sample_offset. The array is null for damaged and null media.
    """
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in media.schema)
    names, span = [*media.columns, "sound", "pcm_blocks", "feature"], blocks * BLOCK

    def run(batches):
        for batch in batches:
            for part, raw, at in text_batches(batch, "media", SLICE):
                payload, size, sound = decode_many(raw, at)
                n = -(-size // span)
                offset = ranges(np.zeros(len(n), np.int64), n) * span
                own = np.minimum(np.repeat(size, n) - offset, span)
                samples = pa.StructArray.from_arrays([pa.array(offset), _binary(payload, own)], names=["sample_offset", "samples"])
                cut = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
                lists = pa.ListArray.from_arrays(cut, samples, mask=pa.array(~sound))
                columns = [*part.columns, pa.array(sound), lists, pa.array(features(payload, size), pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return media.mapInArrow(run, f"{fields}, sound boolean, pcm_blocks {PCM_BLOCKS}, feature string")


def joined_blocks(blocks: Column) -> Column:
    """The samples of blocks in order of their offsets, as one binary. Bytes are joined as text, which Spark doesn't check."""
    in_order = F.array_sort(blocks, lambda a, b: F.when(a["sample_offset"] < b["sample_offset"], -1).otherwise(1))
    return F.array_join(F.transform(in_order, lambda b: b["samples"].cast("string")), "").cast("binary")


def pcm_blocks(decoded: DataFrame) -> DataFrame:
    """One row for each block: the columns of decode_blocks but media and pcm_blocks, and sample_offset and samples."""
    kept = [c for c in decoded.columns if c not in ("media", "pcm_blocks")]
    return decoded.select(*kept, F.inline("pcm_blocks"))
