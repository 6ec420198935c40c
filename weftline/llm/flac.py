"""FLAC for one channel of 8-bit samples: encoder, decoder, seek table, and PCM blocks with sample offsets.

Both directions work on all frames of a slice at once. The encoder takes for each frame the fixed linear predictor
of order 0 to 4 with the smallest residual (or given coefficients), Rice-codes it, and falls back to verbatim or
constant frames. Every frame has a seek point, so the decoder reads one sample of every frame per step, and any samples
can be read from the frames that hold them. It checks the 8-bit checksum of each header, the 16-bit checksum of each
frame and the MD5 of the samples, and raises on a mismatch. Streams that other encoders wrote, without such seek points
or with several Rice partitions, are read frame by frame (``flac_frames``).
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import flac_frames
from . import textkernel as K

BLOCK = 256
RATE = 8000
#: Seek points that one metadata block can hold, and the name of a block with more of them.
POINTS, OWN = ((1 << 24) - 1) // 18, b"more"


def _crc_table(poly: int, bits: int) -> np.ndarray:
    out = []
    for v in range(256):
        c = v << (bits - 8)
        for _ in range(8):
            c = (c << 1) ^ (poly if c >> (bits - 1) & 1 else 0)
        out.append(c & ((1 << bits) - 1))
    return np.array(out, np.uint32)


_CRC8, _CRC16 = _crc_table(0x07, 8), _crc_table(0x8005, 16)


def _crc(buf: np.ndarray, start: np.ndarray, length: np.ndarray, table: np.ndarray, bits: int) -> np.ndarray:
    """The checksum of each span, a byte of every span per step."""
    order = np.argsort(-length, kind="stable")
    s, n = start[order], length[order]
    crc = np.zeros(len(s), np.uint32)
    live = len(s)
    for i in range(int(n[0]) if len(n) else 0):
        while live and n[live - 1] <= i:
            live -= 1
        c = crc[:live]
        crc[:live] = table[(c >> np.uint32(bits - 8)) ^ buf[s[:live] + i]] ^ ((c << np.uint32(8)) & np.uint32((1 << bits) - 1))
    out = np.empty_like(crc)
    out[order] = crc
    return out


def _coded_number(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Frame numbers in the extended UTF-8 form: bytes (7 columns) and lengths."""
    out, size = np.zeros((len(n), 7), np.uint8), np.ones(len(n), np.int64)
    for k, most in ((2, 1 << 11), (3, 1 << 16), (4, 1 << 21), (5, 1 << 26), (6, 1 << 31)):
        size[n >= (1 << 7 if k == 2 else {3: 1 << 11, 4: 1 << 16, 5: 1 << 21, 6: 1 << 26}[k])] = k
    out[size == 1, 0] = n[size == 1]
    for k in range(2, 7):
        at = np.flatnonzero(size == k)
        if len(at):
            out[at, 0] = ((0xFF << (8 - k)) & 0xFF) | (n[at] >> (6 * (k - 1)))
            for j in range(1, k):
                out[at, j] = 0x80 | ((n[at] >> (6 * (k - 1 - j))) & 0x3F)
    return out, size


def _residuals(x: np.ndarray, n: np.ndarray, lpc: tuple[int, list[int]] | None) -> tuple[np.ndarray, np.ndarray]:
    """Residual of each frame under the chosen predictor, and the predictor's order."""
    inside = np.arange(BLOCK) < n[:, None]
    if lpc:
        shift, coef = lpc
        r, order = x.copy(), len(coef)
        pred = sum(c * x[:, order - 1 - j : BLOCK - 1 - j].astype(np.int64) for j, c in enumerate(coef))
        r[:, order:] -= (pred >> shift).astype(np.int32)
        return r * inside, np.full(len(x), order)
    x = x.astype(np.int16)  # differences up to the fourth stay below 2 ** 12
    total = lambda v: np.abs(v).sum(axis=1, dtype=np.int32)
    best, order, low, r = x * inside, np.zeros(len(x), np.int64), total(x * inside), x
    for o in range(1, 5):
        r = r.copy()
        r[:, 1:] -= r[:, :-1].copy()
        full = r * inside
        cost = total(full[:, o:]) + total(x[:, :o])
        better = np.flatnonzero((cost < low) & (n > o))
        best[better], order[better], low[better] = full[better], o, cost[better]
    return best.astype(np.int32), order


def _put(buf_len: int, pos: np.ndarray, value: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """A buffer with value in `bits` (at most 16) bits from each bit position on; nothing overlaps."""
    word = value.astype(np.int64) << (24 - bits - (pos & 7))
    out = np.zeros(buf_len + 3)
    for k in range(3):
        out += np.bincount((pos >> 3) + k, (word >> (16 - 8 * k)) & 0xFF, buf_len + 3)
    return out[:buf_len].astype(np.uint8)


def encode(payloads: list[bytes], lpc: tuple[int, list[int]] | None = None) -> list[bytes]:
    """A FLAC stream of each payload, a byte b as the sample b - 128. lpc: a shift and coefficients for all frames."""
    size = np.array([len(p) for p in payloads], np.int64)
    frames = -(-size // BLOCK)
    if not frames.sum():
        return [_file(p, b"", np.zeros(0, np.int64), np.zeros(0, np.int64)) for p in payloads]
    doc = np.repeat(np.arange(len(size)), frames)
    number = np.arange(len(doc)) - np.repeat(np.cumsum(frames) - frames, frames)
    n = np.minimum(BLOCK, size[doc] - number * BLOCK)
    x = np.zeros((len(doc), BLOCK), np.int32)
    inside = np.arange(BLOCK) < n[:, None]
    x[inside] = np.frombuffer(b"".join(payloads), np.uint8).astype(np.int32) - 128
    r, order = _residuals(x, n, lpc)
    coded = inside & (np.arange(BLOCK) >= order[:, None])
    u = np.where(coded, (r << 1) ^ (r >> 31), 0).astype(np.int32)
    count, total = coded.sum(axis=1), u.sum(axis=1, dtype=np.int64)
    rice = np.stack([(total >> k) + count * (k + 1) for k in range(15)]).argmin(axis=0).astype(np.int32)
    bits = (u >> rice[:, None]).sum(axis=1, dtype=np.int64) + count * (rice + 1)
    extra = 10 + (9 + 14 * len(lpc[1]) if lpc else 0)
    verbatim = (bits + 8 * order + extra >= 8 * n) | (n <= order)
    constant = (np.where(inside, x, x[:, :1]) == x[:, :1]).all(axis=1)
    verbatim &= ~constant
    predicted = ~verbatim & ~constant
    kind = np.where(constant, 0, np.where(verbatim, 1, (31 + order) if lpc else (8 + order)))

    first = np.arange(BLOCK) < order[:, None]
    plain = np.where(predicted[:, None], first, np.where(constant[:, None], np.arange(BLOCK) == 0, True)) & inside
    riced = coded & predicted[:, None]
    q = np.where(riced, u >> rice[:, None], 0).astype(np.int32)
    length = np.where(plain, np.int32(8), np.where(riced, rice[:, None] + 1, np.int32(0)))
    value = np.where(plain, x & 0xFF, (u & ((np.int32(1) << rice[:, None]) - 1)) | (np.int32(1) << rice[:, None]))

    head = np.zeros((len(doc), 12), np.uint8)
    head[:, 0], head[:, 1] = 0xFF, 0xF8
    head[:, 2] = np.where(n == BLOCK, 8, 6) << 4
    head[:, 3] = 1 << 1
    coded_no, no_len = _coded_number(number)
    for k in range(6):
        head[:, 4 + k] = coded_no[:, k]
    hlen = 4 + no_len
    short = np.flatnonzero(n != BLOCK)
    head[short, hlen[short]] = n[short] - 1
    hlen = hlen + (n != BLOCK)
    flat = head.ravel()
    base = np.arange(len(doc)) * head.shape[1]
    flat[base + hlen] = _crc(flat, base, hlen, _CRC8, 8)
    hlen = hlen + 1

    body = 8 + (q + length).sum(axis=1) + np.where(predicted, extra, 0)
    flen = hlen + -(-body // 8) + 2
    start = np.cumsum(flen) - flen
    at = ((start + hlen) * 8 + 8)[:, None] + np.cumsum(q + length, axis=1, dtype=np.int32) - length
    at += np.where(predicted[:, None] & ~first, extra, 0)
    some = length > 0
    pos, val, num = [at[some], (start + hlen) * 8], [value[some], kind << 1], [length[some], np.full(len(doc), 8)]
    p = np.flatnonzero(predicted)
    rice_at = (start + hlen)[p] * 8 + 8 + 8 * order[p] + extra - 10
    pos, val, num = [*pos, rice_at], [*val, rice[p]], [*num, np.full(len(p), 10)]
    if lpc:
        lead = (start + hlen)[p] * 8 + 8 + 8 * order[p]
        fields = [(13, 4, 0), (lpc[0], 5, 4), *((c & 0x3FFF, 14, 9 + 14 * j) for j, c in enumerate(lpc[1]))]
        for v, width, off in fields:
            pos, val, num = [*pos, lead + off], [*val, np.full(len(p), v)], [*num, np.full(len(p), width)]
    total = int(flen.sum())
    buf = _put(total, np.concatenate(pos), np.concatenate(val), np.concatenate(num))
    for k in range(head.shape[1]):
        has = hlen > k
        buf[start[has] + k] = head[has, k]
    crc = _crc(buf, start, flen - 2, _CRC16, 16)
    buf[start + flen - 2], buf[start + flen - 1] = crc >> 8, crc & 0xFF
    data, out, f = buf.tobytes(), [], 0
    for d, p in enumerate(payloads):
        k = int(frames[d])
        if not k:
            out.append(_file(p, b"", start[:0], n[:0]))
            continue
        a, b = int(start[f]), int(start[f + k - 1] + flen[f + k - 1])
        out.append(_file(p, data[a:b], start[f : f + k] - a, n[f : f + k]))
        f += k
    return out


def _file(payload: bytes, frames: bytes, offsets: np.ndarray, n: np.ndarray) -> bytes:
    """Marker, stream description, seek table and frames."""
    samples = (np.frombuffer(payload, np.uint8) - np.uint8(128)).tobytes()
    info = struct.pack(">HH", BLOCK, BLOCK) + bytes(6) + ((RATE << 44) | (7 << 36) | len(payload)).to_bytes(8, "big") + hashlib.md5(samples).digest()
    points = np.zeros(len(offsets), np.dtype([("sample", ">u8"), ("offset", ">u8"), ("n", ">u2")]))
    points["sample"], points["offset"], points["n"] = np.arange(len(offsets)) * BLOCK, offsets, n
    blocks = [(0, info), (3, points[:POINTS].tobytes())]
    # A seek table has a limit; the points beyond it follow in blocks of our own, which other decoders skip.
    blocks += [(2, OWN + points[k : k + POINTS - 1].tobytes()) for k in range(POINTS, len(points), POINTS - 1)]
    out = [bytes([kind | (0x80 if k == len(blocks) - 1 else 0)]) + len(data).to_bytes(3, "big") + data for k, (kind, data) in enumerate(blocks)]
    return b"".join([b"fLaC", *out, frames])


class Stream:
    """What a stream's metadata say: number of samples, MD5, seek points, where frames begin; plain if it has a seek
    point for every frame of BLOCK samples."""

    def __init__(self, data: bytes):
        if data[:4] != b"fLaC":
            raise ValueError("not a FLAC stream")
        kind_of = np.dtype([("sample", ">u8"), ("offset", ">u8"), ("n", ">u2")])
        at, last, points = 4, False, []
        self.total, self.md5, self.plain = 0, b"", False
        while not last:
            kind, size = data[at] & 0x7F, int.from_bytes(data[at + 1 : at + 4], "big")
            last, at = bool(data[at] & 0x80), at + 4
            if kind == 0:
                self.block = struct.unpack(">HH", data[at : at + 4])
                shape = int.from_bytes(data[at + 10 : at + 18], "big")
                self.channels, self.bits, self.total, self.md5 = (shape >> 41 & 7) + 1, (shape >> 36 & 31) + 1, shape & ((1 << 36) - 1), data[at + 18 : at + 34]
            elif kind == 3:
                points.append(np.frombuffer(data, kind_of, size // 18, at))
            elif kind == 2 and data[at : at + 4] == OWN:
                points.append(np.frombuffer(data, kind_of, (size - 4) // 18, at + 4))
            at += size
        if (self.channels, self.bits) != (1, 8):
            raise ValueError("one channel of 8-bit samples is expected")
        self.frames = at
        self.points = np.concatenate(points) if points else np.zeros(0, kind_of)
        self.plain = self.block == (BLOCK, BLOCK) and len(self.points) == -(-self.total // BLOCK) and bool((self.points["sample"] == np.arange(len(self.points)) * BLOCK).all())


def _read(buf: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The samples of the frames at these places, and how many each has, after both checksums."""
    if ((buf[start] != 0xFF) | (buf[start + 1] != 0xF8)).any():
        raise ValueError("no frame at a seek point")
    if not np.isin(buf[start + 2] >> 4, (6, 8)).all():
        raise OtherShape
    lead = buf[start + 4]
    number = np.select([lead < 0x80, lead < 0xE0, lead < 0xF0, lead < 0xF8, lead < 0xFC], [1, 2, 3, 4, 5], 6)
    after = start + 4 + number
    n = np.where(buf[start + 2] >> 4 == 8, BLOCK, buf[after].astype(np.int64) + 1)
    after += n != BLOCK
    if (_crc(buf, start, after - start, _CRC8, 8) != buf[after]).any():
        raise ValueError("a frame header fails its checksum")
    if (_crc(buf, start, stop - start - 2, _CRC16, 16) != (buf[stop - 2].astype(np.uint32) << 8 | buf[stop - 1])).any():
        raise ValueError("a frame fails its checksum")
    return _samples(buf, after + 1, n), n


def _places(opened: list[Stream], streams: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All streams as one buffer, and where each of their frames starts and stops in it."""
    base = np.cumsum([0, *map(len, streams)])
    offset = [o.points["offset"].astype(np.int64) + o.frames + b for o, b in zip(opened, base)]
    start = np.concatenate([np.zeros(0, np.int64), *offset])
    stop = np.concatenate([np.zeros(0, np.int64), *(np.append(x[1:], b) for x, b in zip(offset, base[1:]) if len(x))])
    return np.frombuffer(b"".join(streams) + bytes(8), np.uint8), start, stop


def decode(streams: list[bytes]) -> list[bytes]:
    """The payloads. ValueError where a header, a frame or the samples of a stream fail their checksum."""
    opened = [Stream(s) for s in streams]
    if not all(o.plain for o in opened):
        return [decode([s])[0] if o.plain else flac_frames.payload(s, o) for o, s in zip(opened, streams)]
    buf, start, stop = _places(opened, streams)
    try:
        x, n = _read(buf, start, stop) if len(start) else (np.zeros((0, BLOCK), np.int64), start)
    except OtherShape:
        return [flac_frames.payload(s, o) for o, s in zip(opened, streams)]
    flat = (x[np.arange(BLOCK) < n[:, None]] & 0xFF).astype(np.uint8)
    out, at = [], 0
    for o in opened:
        part = flat[at : at + o.total]
        if hashlib.md5(part.tobytes()).digest() != o.md5:
            raise ValueError("the samples of a stream fail their checksum")
        out.append((part + np.uint8(128)).tobytes())
        at += o.total
    return out


def read_at(streams: list[bytes], first: list[int], count: int) -> list[bytes]:
    """``count`` bytes of each payload from a sample on, or as many as there are, read from the frames that hold them."""
    opened = [Stream(s) for s in streams]
    if not all(o.plain for o in opened):
        return [p[f : f + count] for p, f in zip(decode(streams), first)]
    buf, start, stop = _places(opened, streams)
    ahead = np.cumsum([0, *(len(o.points) for o in opened)])
    low, high = [f // BLOCK for f in first], [-(-min(o.total, f + count) // BLOCK) for o, f in zip(opened, first)]
    chosen = np.concatenate([np.zeros(0, np.int64), *(np.arange(a + l, a + max(l, h)) for a, l, h in zip(ahead, low, high))])
    try:
        x, n = _read(buf, start[chosen], stop[chosen]) if len(chosen) else (np.zeros((0, BLOCK), np.int64), chosen)
    except OtherShape:
        return [p[f : f + count] for p, f in zip(decode(streams), first)]
    flat = ((x[np.arange(BLOCK) < n[:, None]] & 0xFF).astype(np.uint8) + np.uint8(128)).tobytes()
    out, at = [], 0
    for f, l, h in zip(first, low, high):
        size = int(n[: max(0, h - l)].sum())
        n = n[max(0, h - l) :]
        out.append(flat[at : at + size][f - l * BLOCK :][:count])
        at += size
    return out


class OtherShape(Exception):
    """A frame has a form that is not written here, such as several Rice partitions; frames are then read one by one."""


def _samples(buf: np.ndarray, body: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The samples of every frame; body: the byte of its subframe header."""
    view = np.ndarray((len(buf) - 7,), ">u8", buf.data, strides=(1,))
    peek = lambda p: view[p >> 3].astype(np.uint64) << (p & 7).astype(np.uint64)  # noqa: E731  57 bits at least
    field = lambda p, w: (peek(p) >> np.uint64(64 - w)).astype(np.int64)
    kind, p = buf[body] >> 1, (body + 1) * 8
    x = np.zeros((len(body), BLOCK), np.int64)
    signed = lambda b: b.astype(np.int8).astype(np.int64)
    at = np.flatnonzero(kind == 0)
    x[at] = signed(buf[body[at] + 1])[:, None]
    at = np.flatnonzero(kind == 1)
    if len(at):
        x[at] = signed(buf[np.minimum(body[at, None] + 1 + np.arange(BLOCK), len(buf) - 1)])
    at = np.flatnonzero(kind >= 8)
    at = at[np.argsort(-n[at], kind="stable")]
    if not len(at):
        return x
    order = np.where(kind[at] >= 32, kind[at].astype(np.int64) - 31, kind[at].astype(np.int64) - 8)
    pos = p[at]
    r = np.zeros((len(at), BLOCK), np.int64)
    for i in range(int(order.max())):
        warm = order > i
        r[warm, i] = signed(field(pos[warm], 8))
        pos = pos + 8 * warm
    by_lpc = kind[at] >= 32
    shift, coef = np.zeros(len(at), np.int64), np.zeros((len(at), 32), np.int64)
    if by_lpc.any():
        precision = field(pos, 4) + 1
        shift = np.where(by_lpc, field(pos + 4, 5), 0)
        pos = pos + 9 * by_lpc
        for j in range(int(order[by_lpc].max())):
            has = np.flatnonzero(by_lpc & (order > j))
            c = (peek(pos[has]) >> (64 - precision[has]).astype(np.uint64)).astype(np.int64)
            coef[has, j] = c - (c >> (precision[has] - 1) << precision[has])
            pos[has] += precision[has]
    if field(pos, 6).any():
        raise OtherShape
    rice = field(pos + 6, 4)
    pos = pos + 10
    left, low = (64 - rice).astype(np.uint64), (1 << rice) - 1
    live = n[at]
    for i in range(int(order.min()), BLOCK):
        k = int(np.searchsorted(-live, -i, "left"))  # frames with more than i samples
        if not k:
            break
        do = np.arange(k) if i >= order[:k].max() else np.flatnonzero(order[:k] <= i)
        if len(do) == 0:
            continue
        pp, q = pos[do], np.zeros(len(do), np.int64)
        w = peek(pp)
        zeros = 53 - np.frexp((w >> np.uint64(11)).astype(np.float64))[1].astype(np.int64)
        while (far := zeros > 30).any():  # a long run of zeros: move on by 30 bits and look again
            q[far] += 30
            pp = pp + 30 * far
            w = peek(pp)
            zeros = 53 - np.frexp((w >> np.uint64(11)).astype(np.float64))[1].astype(np.int64)
        tail = (w << (zeros + 1).astype(np.uint64)) >> np.uint64(1)  # one bit less, as a shift by 64 is undefined
        u = ((q + zeros) << rice[do]) | ((tail >> (left[do] - np.uint64(1))).astype(np.int64) & low[do])
        r[do, i] = (u >> 1) ^ -(u & 1)
        pos[do] = pp + zeros + 1 + rice[do]
    for o in range(1, 5):
        g = np.flatnonzero(~by_lpc & (order == o))
        if len(g):
            warm = r[g, :o].copy()
            for _ in range(o):
                warm[:, 1:] -= warm[:, :-1].copy()
            part = r[g]
            part[:, :o] = warm
            for _ in range(o):
                np.cumsum(part, axis=1, out=part)
            r[g] = part
    for o in np.unique(order[by_lpc]):
        g = np.flatnonzero(by_lpc & (order == o))
        part, back = r[g], coef[g, :o][:, ::-1]
        for i in range(int(o), BLOCK):
            part[:, i] += (part[:, i - o : i] * back).sum(axis=1) >> shift[g]
        r[g] = part
    x[at] = r
    return x


def payload_of(text: bytes) -> bytes:
    """The text and zero bytes up to the next positive multiple of 64."""
    return text + bytes(-len(text) % 64 or (0 if text else 64))


def feature_of(payload: bytes) -> str:
    """Blocks, peak, energy and sign changes of the samples."""
    s = np.frombuffer(payload, np.uint8).astype(np.int64) - 128
    return f"blocks={-(-len(s) // BLOCK)};peak={int(np.abs(s).max())};energy={int((s * s).sum())};turns={int((np.diff(s < 0)).sum())}"


def media_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, media): each text's payload as a FLAC stream. Null text is empty: 64 zero bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in K.slices(batches, "text", 1 << 19):
            texts = [(t or "").encode() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array([len(t) for t in texts], pa.int64()), pa.array(encode([payload_of(t) for t in texts]), pa.binary())], names=["id", "n_bytes", "media"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n_bytes long, media binary")


def pcm_blocks(media: DataFrame) -> DataFrame:
    """(id, block, sample_offset, pcm): the decoded blocks, each with the offset of its first sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in K.slices(batches, "media", 1 << 19):
            for i, p in zip(b.column("id"), decode(b.column("media").to_pylist())):
                at = list(range(0, len(p), BLOCK))
                yield pa.RecordBatch.from_arrays([pa.array([i.as_py()] * len(at), b.schema.field("id").type), pa.array(range(len(at)), pa.int64()), pa.array(at, pa.int64()), pa.array([p[a : a + BLOCK] for a in at], pa.binary())], names=["id", "block", "sample_offset", "pcm"])

    return media.mapInArrow(run, f"id {media.schema['id'].dataType.simpleString()}, block long, sample_offset long, pcm binary")


def media_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text stored as FLAC, read back from the stored bytes, and described; the tail is read through seek points.

    Equal texts give equal values; null counts as empty; an empty table gives no rows; ids and other columns don't
    matter. Memory follows the longest text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha = lambda x: hashlib.sha256(x).hexdigest()
        for b in K.slices(batches, "text", 1 << 19):
            texts = [(t or "").encode() for t in b.column("text").to_pylist()]
            media = encode([payload_of(t) for t in texts])
            back = decode(media)
            tail = read_at(media, [len(p) - 64 for p in back], 64)
            columns = {
                "id": b.column("id"), "n_bytes": pa.array([len(t) for t in texts], pa.int64()), "payload_bytes": pa.array([len(p) for p in back], pa.int64()), "payload_sha256": pa.array([sha(p) for p in back], pa.string()),
                "tail_crc32": pa.array([zlib.crc32(x) for x in tail], pa.int64()), "media_bytes": pa.array([len(m) for m in media], pa.int64()), "media_sha256": pa.array([sha(m) for m in media], pa.string()), "feature": pa.array([feature_of(p) for p in back], pa.string()),
            }
            yield pa.RecordBatch.from_arrays([*columns.values()], names=[*columns])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
