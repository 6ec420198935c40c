"""Token counts of whole texts, huge ones by overlapping chunks that are spliced where both agree for certain.

A text longer than a chunk is cut into chunks that overlap. Within an overlap both chunks know the boundaries of
pre-tokens; one is proven stable where a visible character, a space and a visible character meet, since no
pre-token of the splitting pattern reaches over such a place whatever stands around it. The count takes the left
chunk's tokens up to a stable boundary common to both and the right chunk's from there. Where an overlap has none,
it is doubled, up to the rest of the text.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkernel as K
from .byte_bpe import Codec


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files: printable ones for themselves, others from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Counter(Codec):
    """Pre-token to its number of tokens, for a vocabulary whose merges are ranked by their ids."""

    def __init__(self, path: str, pattern: str, remember: int = 400_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab = {bytes(letters[c] for c in word): i for word, i in spec["model"]["vocab"].items() if word not in added}
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in spec["model"]["merges"]]
        ranked = [vocab[bytes(letters[c] for c in a + b)] for a, b in merges]
        if any(x >= y for x, y in zip(ranked, ranked[1:])):
            raise ValueError("merges are not in the order of their ids")
        super().__init__(vocab, pattern, remember)
        self.special = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True)))) if added else None

    def __missing__(self, pre: str) -> int:
        word = pre.encode()
        at = self.whole(word)
        out = 1 if at is not None and self.keys_[at] == word else len(self.merged(word))
        if len(self) >= self.remember:
            self.clear()
        self[pre] = out
        return out

    def plain(self, text: str) -> int:
        return sum(map(self.__getitem__, self.split(text)))

    def count(self, text: str, chunk: int = 1 << 14, overlap: int = 256) -> int:
        """Tokens of a text; a special string in it is one token."""
        if self.special is None or not (found := len(self.special.findall(text))):
            return self.spliced(text, chunk, overlap)
        return found + sum(self.spliced(part, chunk, overlap) for part in self.special.split(text))

    def spliced(self, text: str, chunk: int, overlap: int) -> int:
        if len(text) <= chunk + overlap:
            return self.plain(text)
        total, start, skip = 0, 0, 0  # skip: pre-tokens at this chunk's start that the one before has counted
        while start + chunk + overlap < len(text):
            inner, wide, joint = start + chunk, overlap, None
            while joint is None and inner + wide < len(text):
                left = self.split(text[start : inner + wide])
                joint = joined(text, left, self.split(text[inner : inner + wide]), start, inner)
                wide *= 2
            if joint is None:
                break
            total += sum(map(self.__getitem__, left[skip : joint[0]]))
            start, skip = inner, joint[1]
        return total + sum(map(self.__getitem__, self.split(text[start:])[skip:]))


def stable(text: str, at: int) -> bool:
    """Whether every splitting of the text, from wherever it starts, has a boundary here."""
    return 0 < at < len(text) - 1 and text[at] == " " and not text[at - 1].isspace() and not text[at + 1].isspace()


def joined(text: str, left: list[str], right: list[str], start: int, inner: int) -> tuple[int, int] | None:
    """The number of left and of right pre-tokens before the first stable boundary that both have, or None.

    The right chunk's first and last pre-tokens may be cut, so only places inside the overlap count.
    """
    ends = {at: i for i, at in enumerate(accumulate(map(len, left), initial=start)) if at > inner}
    for i, at in enumerate(accumulate(map(len, right[:-1]), initial=inner)):
        if i and at in ends and stable(text, at) and at + 1 < inner + sum(map(len, right)):
            return ends[at], i
    return None


@lru_cache(2)
def counter(path: str, pattern: str) -> Counter:
    """The counter of a vocabulary file, once in each worker."""
    return Counter(path, pattern)


def token_counts(docs: DataFrame, path: str, pattern: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row; over_limit: more tokens than limit.

    Null counts as empty: no bytes, no tokens. Repeated rows keep a row each, an empty table gives none, and other
    columns are ignored. Memory follows the longest text and the remembered words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path, pattern)
        for b in K.slices(batches, "text"):
            n = [c.count(t) if t else 0 for t in b.column("text").to_pylist()]
            size = pc.fill_null(pc.binary_length(b.column("text")), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("id"), size, pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())], names=["id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean")
