"""Vectorised byte kernels over Arrow string columns: words, shingle sets and MinHash signatures.

Batches are cut into slices of bounded bytes, so memory follows the longest single text and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_RNG = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | U(1)
_FOLD = _BYTE.copy()
_FOLD[65:91] = _BYTE[97:123]
_BASE = U(0x9E3779B97F4A7C15 | 5)
_UNBASE = U(pow(int(_BASE), -1, 1 << 64))
#: Space and the controls tab to carriage return separate words.
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Bytes that are hashed at a time.
SEGMENT = 1 << 20


def fresh(names: list[str], name: str) -> str:
    """A column name like ``name`` that is not among the names."""
    taken = {n.lower() for n in names}
    while name.lower() in taken:
        name = "_" + name
    return name


def slices(batches, column: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Row slices whose texts hold about ``most`` bytes; a longer text comes alone."""
    for b in batches:
        if not b.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        cut, total = 0, 0
        for i, n in enumerate(size):
            if total and total + n > most:
                yield b.slice(cut, i - cut)
                cut, total = i, 0
            total += int(n)
        yield b.slice(cut)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and where each row starts and ends (n + 1 offsets). Null is empty."""
    a = pc.fill_null(column.cast(pa.large_string()), "")
    n, at = len(a), a.offset
    _, off, data = a.buffers()
    offsets = np.frombuffer(off, np.int64)[at : at + n + 1] if off is not None and off.size else np.zeros(n + 1, np.int64)
    first, last = (int(offsets[0]), int(offsets[-1])) if n else (0, 0)
    raw = np.frombuffer(data, np.uint8)[first:last] if data is not None and last > first else np.zeros(0, np.uint8)
    return raw, offsets - first


@lru_cache(1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE, np.uint64), np.full(n, _UNBASE, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finisher of 64 bits."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True) -> np.ndarray:
    """A 64-bit hash of each byte span, in order and apart from each other; with fold, A-Z count as a-z.

    Sums run over segments, so memory beyond the input is that of a segment.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _powers(SEGMENT)
    code, out = _FOLD if fold else _BYTE, np.empty(len(starts), np.uint64)
    for a in range(0, len(raw), SEGMENT):
        part = raw[a : a + SEGMENT]
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(code[part] * up[: len(part)], out=total[1:])
        lo, hi = np.searchsorted(starts, (a, a + SEGMENT))
        s = starts[lo:hi] - a
        out[lo:hi] = (total[np.minimum(ends[lo:hi] - a, len(part))] - total[s]) * down[s]
    for k in np.flatnonzero(starts // SEGMENT != (ends - 1) // SEGMENT) if len(raw) > SEGMENT else ():
        s, e = int(starts[k]), int(ends[k])
        for a in range((s // SEGMENT + 1) * SEGMENT, e, SEGMENT):
            part = raw[a : min(e, a + SEGMENT)]
            more = int((code[part] * up[: len(part)]).sum(dtype=np.uint64)) * pow(int(_BASE), a - s, 1 << 64)
            out[k] = (int(out[k]) + more) % (1 << 64)
    return mix(out + (ends - starts).astype(np.uint64))


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word; words never cross rows."""
    if not len(raw):
        z = np.zeros(0, np.int64)
        return z, z, z
    ink = ~SPACE[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets[offsets <= len(raw)]] = True
    before = np.empty(len(raw), bool)
    before[0], before[1:] = False, ink[:-1]
    starts = np.flatnonzero(ink & (~before | edge[:-1]))
    after = np.empty(len(raw), bool)
    after[-1], after[:-1] = False, ink[1:]
    ends = np.flatnonzero(ink & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def shingles(hashes: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every run of n words; a row of fewer words gives its whole sequence as one."""
    if not len(hashes):
        return hashes, rows
    k = len(hashes) - n + 1
    parts_h, parts_r = [], []
    if k > 0:
        full = rows[:k] == rows[n - 1 :]
        acc = np.zeros(k, np.uint64)
        for a in range(0, k, 1 << 16):
            part = acc[a : a + (1 << 16)]
            for i in range(n):
                part[:] = mix(part * U(0xD6E8FEB86659FD93) + hashes[a + i : a + i + len(part)] + U(n))
        parts_h.append(acc[full])
        parts_r.append(rows[:k][full])
    ids, first, count = np.unique(rows, return_index=True, return_counts=True)
    for r, f, c in zip(ids[count < n], first[count < n], count[count < n]):
        acc = np.zeros(1, np.uint64)
        for h in hashes[f : f + c]:
            acc = mix(acc * U(0xD6E8FEB86659FD93) + h + U(c))
        parts_h.append(acc)
        parts_r.append(np.array([r]))
    h, r = np.concatenate(parts_h), np.concatenate(parts_r)
    order = np.argsort(r, kind="stable")
    return h[order], r[order]


def sets_of(column: pa.Array, n: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each row; empty without words."""
    raw, offsets = utf8(column)
    s, e, r = words(raw, offsets)
    h, r = shingles(spans(raw, s, e), r, n)
    at = np.searchsorted(r, np.arange(len(column) + 1))
    return [np.unique(h[at[i] : at[i + 1]]) for i in range(len(column))]


@lru_cache(4)
def _seeds(k: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(7))
    return rng.integers(0, 1 << 63, k, dtype=np.uint64), rng.integers(0, 1 << 63, k, dtype=np.uint64) * U(2) + U(1)


def signature(items: np.ndarray, k: int) -> np.ndarray:
    """k minima, one per seeded permutation of 64-bit values, each given as 32 mixed bits."""
    salt, by = _seeds(k)
    low = np.full(k, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(items), 2048):
        low = np.minimum(low, ((items[i : i + 2048, None] ^ salt) * by).min(axis=0))
    return (mix(low) & U(0xFFFFFFFF)).astype(np.uint32)
