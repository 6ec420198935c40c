"""Reads FLAC streams frame by frame, without seek points: any block sizes, Rice partitions, escapes and wasted bits."""

from __future__ import annotations

import hashlib


class Bits:
    """A reader of bits, most significant first."""

    def __init__(self, data: bytes, at: int):
        self.data, self.pos = data, 8 * at

    def take(self, n: int) -> int:
        end = self.pos + n
        a, z = self.pos >> 3, (end + 7) >> 3
        if z > len(self.data):
            raise ValueError("the stream ends within a frame")
        self.pos = end
        return int.from_bytes(self.data[a:z], "big") >> (8 * z - end) & ((1 << n) - 1)

    def signed(self, n: int) -> int:
        v = self.take(n)
        return v - (1 << n) if n and v >> (n - 1) else v

    def zeros(self) -> int:
        """Zero bits up to the next one, which is taken too."""
        n = 0
        while not self.take(1):
            n += 1
        return n

    def byte(self) -> int:
        """The number of the byte at which the next whole one begins."""
        self.pos = (self.pos + 7) & ~7
        return self.pos >> 3


def checksum(data: bytes, poly: int, bits: int) -> int:
    c = 0
    for byte in data:
        c ^= byte << (bits - 8)
        for _ in range(8):
            c = (c << 1) ^ (poly if c >> (bits - 1) & 1 else 0)
        c &= (1 << bits) - 1
    return c


#: Fixed values of the format: coefficients of the fixed predictors, the nearest sample first.
FIXED = [[], [1], [2, -1], [3, -3, 1], [4, -6, 4, -1]]


def _residual(b: Bits, block: int, order: int) -> list[int]:
    width = 4 + b.take(2)
    if width > 5:
        raise ValueError("unknown residual coding")
    parts, out = b.take(4), []
    for k in range(1 << parts):
        count, rice = (block >> parts) - (0 if k else order), b.take(width)
        if rice == (1 << width) - 1:
            raw = b.take(5)
            out += [b.signed(raw) for _ in range(count)]
        else:
            for _ in range(count):
                u = b.zeros() << rice | b.take(rice)
                out.append(u >> 1 ^ -(u & 1))
    return out


def _subframe(b: Bits, block: int, bits: int) -> list[int]:
    b.take(1)
    kind, wasted = b.take(6), 0
    if b.take(1):
        wasted = b.zeros() + 1
        bits -= wasted
    if kind == 0:
        x = [b.signed(bits)] * block
    elif kind == 1:
        x = [b.signed(bits) for _ in range(block)]
    elif 8 <= kind <= 12 or kind >= 32:
        order = kind - 31 if kind >= 32 else kind - 8
        x = [b.signed(bits) for _ in range(order)]
        shift, coef = 0, FIXED[order] if kind < 32 else []
        if kind >= 32:
            width = b.take(4) + 1
            shift = b.signed(5)
            coef = [b.signed(width) for _ in range(order)]
        for r in _residual(b, block, order):
            x.append(r + (sum(c * v for c, v in zip(coef, reversed(x))) >> shift))
    else:
        raise ValueError("unknown kind of subframe")
    return [v << wasted for v in x]


def frame(data: bytes, at: int) -> tuple[list[int], int]:
    """The samples of the frame at a byte, and the byte after it."""
    b = Bits(data, at)
    if b.take(15) != 0x7FFC:
        raise ValueError("no frame where one is expected")
    b.take(1)
    size, rate = b.take(4), b.take(4)
    if b.take(4):
        raise ValueError("one channel is expected")
    b.take(4)
    lead = b.take(8)
    for _ in range(max(0, 8 - (lead ^ 0xFF).bit_length() - 1) if lead >= 0x80 else 0):
        b.take(8)
    if not size:
        raise ValueError("unknown block size")
    block = 192 if size == 1 else 576 << (size - 2) if size < 6 else b.take(8) + 1 if size == 6 else b.take(16) + 1 if size == 7 else 256 << (size - 8)
    b.take({12: 8, 13: 16, 14: 16}.get(rate, 0))
    head = b.byte()
    if checksum(data[at:head], 0x07, 8) != b.take(8):
        raise ValueError("a frame header fails its checksum")
    x = _subframe(b, block, 8)
    end = b.byte()
    if checksum(data[at:end], 0x8005, 16) != b.take(16):
        raise ValueError("a frame fails its checksum")
    return x, end + 2


def payload(data: bytes, stream) -> bytes:
    """The payload of a stream whose metadata are read. The MD5 counts where the stream has one."""
    out, at = bytearray(), stream.frames
    while at < len(data) and (len(out) < stream.total or not stream.total):
        x, at = frame(data, at)
        out += bytes(v & 0xFF for v in x)
    if (stream.total and len(out) != stream.total) or (any(stream.md5) and hashlib.md5(out).digest() != stream.md5):
        raise ValueError("the samples of a stream fail their checksum")
    return bytes((v + 128) & 0xFF for v in out)
