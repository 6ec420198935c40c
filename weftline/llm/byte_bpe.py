"""Byte-level BPE encoding and decoding in two tiers.

Each match of the splitting pattern is one pre-token. A minimal perfect hash over the vocabulary resolves pre-tokens
that are one token; others go through merges: a heap of adjacent pairs by rank over a doubly linked list of pieces,
the leftmost pair first among equal ranks. Resolved pre-tokens are remembered up to a bound, as words repeat.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkernel as K

_MASK, _ODD, _STEP = (1 << 64) - 1, 0x9E3779B97F4A7C15, 0xD1B54A32D192ED03


class MinimalPerfectHash:
    """Maps each of n known keys to its own number below n, in levels of collision-free bits and their ranks.

    Keys that collide on one level go on to the next. A strange key gets some number or None; the caller compares.
    """

    def __init__(self, keys: list[bytes], spread: float = 2.0):
        left = np.array([xxhash.xxh3_64_intdigest(k) for k in keys], np.uint64)
        self.levels: list[tuple[int, int, bytes, list[int]]] = []
        before, level = 0, 0
        while len(left):
            size = max(1, int(len(left) * spread))
            salt = (level * _STEP) & _MASK
            at = (((left + np.uint64(salt)) * np.uint64(_ODD)) >> np.uint64(33)) % np.uint64(size)
            once = np.bincount(at.astype(np.int64), minlength=size) == 1
            rank = before + np.cumsum(once) - once
            self.levels.append((salt, size, once.tobytes(), rank.tolist()))
            before += int(once.sum())
            left = left[~once[at.astype(np.int64)]]
            level += 1
            if level > 200:
                raise ValueError("keys with equal hashes")
        self.size = before

    def __call__(self, key: bytes) -> int | None:
        h = xxhash.xxh3_64_intdigest(key)
        for salt, size, once, rank in self.levels:
            at = ((((h + salt) & _MASK) * _ODD & _MASK) >> 33) % size
            if once[at]:
                return rank[at]
        return None


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class Codec(dict):
    """Pre-token to its ids, written in decimal and joined by commas; filled as pre-tokens come."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, remember: int = 400_000):
        super().__init__()
        self.ranks, self.remember = ranks, remember
        self.split = regex.compile(pattern).findall
        tokens = list(ranks)
        self.whole = MinimalPerfectHash(tokens)
        self.keys_, self.ids_ = [b""] * len(tokens), [0] * len(tokens)
        for t in tokens:
            at = self.whole(t)
            self.keys_[at], self.ids_[at] = t, ranks[t]
        self.token = {b"%d" % rank: token for token, rank in ranks.items()}
        self.decimal = {rank: b"%d" % rank for rank in ranks.values()}
        self.single = [ranks[bytes([b])] for b in range(256)]

    def __missing__(self, pre: str) -> bytes:
        word = pre.encode()
        at = self.whole(word)
        if at is not None and self.keys_[at] == word:
            out = b"%d" % self.ids_[at]
        else:
            out = b",".join([self.decimal[i] for i in self.merged(word)])
        if len(self) >= self.remember:
            self.clear()
        self[pre] = out
        return out

    def merged(self, word: bytes) -> list[int]:
        """Ids of a pre-token that is no token itself."""
        n, rank, push, pop = len(word), self.ranks.get, heappush, heappop
        bits = n.bit_length()
        here = (1 << bits) - 1
        # The piece at a position has an id, the position after it, the one before it, and the rank of its pair.
        ids = [self.single[b] for b in word]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pair = [rank(word[i : i + 2], -1) for i in range(n - 1)]
        pair.append(-1)
        heap = [r << bits | i for i, r in enumerate(pair) if r >= 0]
        heapify(heap)
        while heap:
            top = pop(heap)
            i = top & here
            r = top >> bits
            if pair[i] != r:  # the piece has gone or grown since
                continue
            ids[i] = r
            j = after[i]
            pair[j] = -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                pair[i] = r = rank(word[i : after[k]], -1)
                if r >= 0:
                    push(heap, r << bits | i)
            else:
                pair[i] = -1
            p = before[i]
            if p >= 0:
                pair[p] = r = rank(word[p:k], -1)
                if r >= 0:
                    push(heap, r << bits | p)
        out, i = [], 0
        while i < n:
            out.append(ids[i])
            i = after[i]
        return out

    def encode(self, text: str) -> bytes:
        """The ids of the text, in decimal, joined by commas."""
        return b",".join(map(self.__getitem__, self.split(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, ids.split(b","))) if ids else b""


@lru_cache(2)
def codec(path: str, pattern: str) -> Codec:
    """The codec of a rank file, once in each worker."""
    return Codec(read_ranks(path), pattern)


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): the ids as an array of int. Null text: an empty array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for b in K.slices(batches, "text"):
            got = [np.array(c.encode(t).split(b",") if t else [], np.int32) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(got, pa.list_(pa.int32()))], names=["id", "ids"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, ids array<int>")


def decode_documents(coded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(id, text) of the rows of encode_documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for b in batches:
            texts = [c.decode(b",".join(b"%d" % i for i in ids or ())).decode() for ids in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(texts, pa.string())], names=["id", "text"])

    return coded.mapInArrow(run, f"id {coded.schema['id'].dataType.simpleString()}, text string")


def round_trips(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every row.

    Null and empty texts: no tokens, and the digest of nothing twice. Repeated rows and ids each keep their row; an
    empty table gives none; other columns are ignored. Memory follows the longest text and the remembered words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, last = codec(path, pattern), ""
        for b in K.slices(batches, "text"):
            n, sha, back = [], [], []
            for text in b.column("text").to_pylist():
                if n and (text or "") == last:  # copies of one document often follow each other
                    for column in (n, sha, back):
                        column.append(column[-1])
                    continue
                last = text or ""
                ids = c.encode(last)
                n.append(ids.count(b",") + 1 if ids else 0)
                sha.append(hashlib.sha256(ids).hexdigest())
                back.append(hashlib.sha256(c.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.array(back, pa.string())], names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")
