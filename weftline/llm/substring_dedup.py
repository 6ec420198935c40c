"""Repeated passages inside documents, by MinHash banding of content-defined paragraphs.

Passages are copied into the middle of other texts, so paragraphs can't come from line breaks. A paragraph starts at
a word whose pair hash is the least among those of the ``REACH`` words on either side; such places depend on nearby
words alone, so a copied passage is cut the same wherever it stands, but for its ends. A passage of 51 words has
about five of them.

A paragraph's set is its five-word shingles. Unrelated paragraphs share none, so a band has one row, and the number
of bands follows from the wanted recall at the threshold similarity. Band values that two documents share are found
first; only paragraphs that have one go on. Equal paragraphs are one class, so a passage in thousands of documents is
a few rows; classes that collide are verified by exact Jaccard similarity of their sets, and linked classes are
clustered by connected components. Of a cluster, the occurrence in the smallest document (then the first in it)
stays. Other occurrences count as removable where they form a run of at least ``min_words`` words.

One changed word spoils the whole paragraph around it. So wherever paragraphs follow each other in a document as they
do where they are kept, the ``CONTEXT`` words on both sides are aligned with those of the kept place, over changed
places, and the longest window of at least ``min_words`` words whose five-word shingles have the threshold similarity
is removable too. Passages that overlap or touch are one. What is not found: a near copy without one whole paragraph
that equals its kept one, and the far side of a place where over ``CONTEXT`` words in a row were changed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import staging
from ..operators.components import connected_components
from . import textkernel as K
from .skew import join_heavy

REACH = 4
SHINGLE = 5
#: Words aligned on each side of equal paragraphs, and words that a changed place may have.
CONTEXT = 48
CHANGED = 16


def bands_for(recall: float, similarity: float) -> int:
    """Bands of one row that find a pair of this similarity with this probability."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - similarity) - 1e-9))


class Paragraphs:
    """The paragraphs of a column of texts, as arrays: row, word number in the row, words, shingles, band values."""

    def __init__(self, column: pa.Array, bands: int):
        raw, offsets = K.utf8(column)
        s, e, r = K.words(raw, offsets)
        h = K.spans(raw, s, e)
        n = len(h)
        pair = h.copy()
        if n:
            pair[1:] = np.where(r[1:] == r[:-1], K.mix(h[1:] + h[:-1] * np.uint64(0x9E3779B97F4A7C15)), h[1:])
        begins = np.ones(n, bool)
        for j in range(1, REACH + 1):
            if n > j:
                same = r[j:] == r[:-j]
                begins[j:] &= ~same | (pair[j:] < pair[:-j])
                begins[:-j] &= ~same | (pair[:-j] <= pair[j:])
        if n:
            begins[0] = True
            begins[1:] |= r[1:] != r[:-1]
        first = np.flatnonzero(begins)
        last = np.append(first[1:], n) - 1 if n else first
        self.row = r[first]
        self.at_word = first - np.searchsorted(r, self.row)
        self.words = last - first + 1
        self.items, owner = K.shingles(h, np.cumsum(begins) - 1, SHINGLE)
        self.at = np.searchsorted(owner, np.arange(len(first) + 1))
        salts = np.random.Generator(np.random.PCG64(11)).integers(0, 1 << 63, bands, dtype=np.uint64)
        if len(first):
            self.keys = [np.minimum.reduceat(K.mix(self.items ^ x), self.at[:-1]).view(np.int64) for x in salts]
        else:
            self.keys = [np.zeros(0, np.int64)] * bands

    def sets(self) -> pa.Array:
        """The distinct shingles of each paragraph, as sorted 32-bit values."""
        n = np.uint64(32)
        owner = np.repeat(np.arange(len(self.row), dtype=np.uint64), np.diff(self.at))
        both = np.unique(owner << n | self.items >> n)
        at = 4 * np.searchsorted(both >> n, np.arange(len(self.row) + 1, dtype=np.uint64))
        data = (both & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        return pa.Array.from_buffers(pa.binary(), len(self.row), [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data)])


def digest(text_col: str) -> F.Column:
    """With the id, what names a row: rows that repeat an id with another text are parted by it."""
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def _paragraphs(rows: DataFrame, bands: int) -> DataFrame:
    """(id, digest, at, words, items, k0, k1 ..., kind) of every paragraph; kind, the class, is a digest of the items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in K.slices(batches, "text", 1 << 18):
            p = Paragraphs(b.column("text"), bands)
            own = pa.array(p.row)
            yield pa.RecordBatch.from_arrays([b.column("id").take(own), b.column("digest").take(own), pa.array(p.at_word, pa.int32()), pa.array(p.words, pa.int32()), p.sets(), *map(pa.array, p.keys)], names=names)

    keys = [f"k{i}" for i in range(bands)]
    names = ["id", "digest", "at", "words", "items", *keys]
    kind = rows.schema["id"].dataType.simpleString()
    made = rows.mapInArrow(run, f"id {kind}, digest long, at int, words int, items binary, " + ", ".join(f"{k} long" for k in keys))
    return made.withColumn("kind", F.xxhash64("items"))


def _similar(pairs: DataFrame, similarity: float) -> DataFrame:
    """Pairs of classes whose sets have at least this Jaccard similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good = []
            for x, y in zip(b.column("xa"), b.column("xb")):
                x, y = np.frombuffer(x.as_buffer(), np.uint32), np.frombuffer(y.as_buffer(), np.uint32)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(both >= similarity * (len(x) + len(y) - both) - 1e-9)
            yield b.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return pairs.mapInArrow(run, "a long, b long")


def _open(lists: DataFrame, by: str, comp: DataFrame) -> DataFrame:
    """Members of the lists that still hold more than one component, with their component."""
    named = lists.join(comp.select(F.col("node").alias("kind"), F.col("component").alias("c")), "kind", "left").withColumn("comp", F.coalesce("c", "kind")).drop("c")
    apart = named.groupBy(by).agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x != y").select(by)
    return named.join(apart, by)


def _prefixes(kinds: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(item, kind, n, s, sketch) of the classes that may still link two components.

    A link shares this much of the union, so of n items all but that share, and one more, must hold a common item;
    items are ordered by how many of the classes have them, and an item of one class alone needs no list. s counts
    the items that another class has, sketch is their parity in 64 bins.
    """

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [np.frombuffer(x.as_buffer(), np.uint32) for x in b.column("items")]
            n = np.array([len(x) for x in sets], np.int32)
            item = np.concatenate(sets).astype(np.int64) if sets else np.zeros(0, np.int64)
            bit = K.mix(item.view(np.uint64)) & np.uint64(63)
            sketch = np.array([np.bitwise_xor.reduce(np.uint64(1) << x) for x in np.split(bit, np.cumsum(n)[:-1])], np.uint64) if sets else np.zeros(0, np.uint64)
            at = np.repeat(np.arange(len(n)), n)
            yield pa.RecordBatch.from_arrays([b.column("kind").take(pa.array(at)), pa.array(n[at], pa.int32()), pa.array(sketch.view(np.int64)[at]), pa.array(item)], names=["kind", "n", "sketch", "item"])

    items = staging.put(sets.join(kinds, "kind", "left_semi").mapInArrow(unpack, "kind long, n int, sketch long, item long"), "items")
    shared = items.groupBy("item").agg(F.count("*").alias("df")).where("df > 1")
    ranked = items.join(shared, "item").groupBy("kind", "n", "sketch").agg(F.sort_array(F.collect_list(F.struct("df", "item"))).alias("e"))
    keep = F.size("e") - F.ceil(F.col("n") * F.lit(similarity) - 1e-9).cast("int") + 1
    return ranked.where(keep > 0).select("kind", "n", "sketch", F.size("e").alias("s"), F.explode(F.slice("e", 1, keep)).alias("x")).select(F.col("x.item").alias("item"), "kind", "n", "s", "sketch")


def _able(x: str, y: str, similarity: float) -> F.Column:
    """Whether a link is possible by the items that another class has and by the parities; no link fails these bounds."""
    most, both = F.least(f"{x}.s", f"{y}.s"), F.col(f"{x}.n") + F.col(f"{y}.n")
    differ = F.bit_count(F.col(f"{x}.sketch").bitwiseXOR(F.col(f"{y}.sketch")))
    return (most >= similarity * (both - most) - 1e-9) & ((1 + similarity) * differ <= (1 - similarity) * both + 1e-9)


def _pair(x: str, y: str) -> list[F.Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _star(lists: DataFrame, comp: DataFrame, similarity: float) -> DataFrame:
    """Each class with one pivot of its list."""
    members = _open(lists, "item", comp)
    order = F.struct(F.xxhash64("kind", "item").alias("h"), "kind", "comp", "n", "s", "sketch")
    met = members.alias("x").join(members.groupBy("item").agg(F.min(order).alias("y")), "item").where((F.col("x.comp") != F.col("y.comp")) & _able("x", "y", similarity))
    return met.select(*_pair("x.kind", "y.kind")).distinct()


def _rest(lists: DataFrame, comp: DataFrame, similarity: float) -> DataFrame:
    """Pairs of one list that lie in different components and that the bounds let pass."""
    members = _open(lists, "item", comp)
    x, y = members.alias("x"), members.alias("y")
    met = x.join(y, (F.col("x.item") == F.col("y.item")) & (F.col("x.kind") < F.col("y.kind")) & (F.col("x.comp") != F.col("y.comp")) & _able("x", "y", similarity))
    return met.select(*_pair("x.kind", "y.kind")).distinct()


def _clusters(classes: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(node, component) of the classes (key, kind) under shared band values: ends first, then all that are still apart.

    sets: (kind, items) of the classes whose band value has another one.
    """

    def links(pairs: DataFrame) -> DataFrame:
        x, y = (sets.select(F.col("kind").alias(c), F.col("items").alias(f"x{c}")) for c in "ab")
        return staging.put(_similar(pairs.join(x, "a").join(y, "b"), similarity), "links")

    ends = classes.groupBy("key").agg(F.min("kind").alias("low"), F.max("kind").alias("high")).where("low != high")
    near = staging.put(classes.join(ends, "key"), "colliding")
    first = near.select("kind", F.explode(F.array("low", "high")).alias("end")).where("kind != end").select(*_pair("kind", "end")).distinct()
    comp = staging.put(connected_components(links(first), "a", "b"), "components")
    staging.release(classes.sparkSession)
    lists = staging.put(_prefixes(_open(near.select("key", "kind"), "key", comp).select("kind").distinct(), sets, similarity), "prefixes")
    for met in (_star, _rest):
        more = links(met(lists, comp, similarity))
        comp = staging.put(connected_components(comp.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more), "a", "b"), "components")
        staging.release(classes.sparkSession)
    return comp


def _sets(found: DataFrame, classes: DataFrame) -> DataFrame:
    """(kind, items) of the classes whose band value has another one, read from one place of each."""
    several = classes.groupBy("key").agg(F.min("kind").alias("low"), F.max("kind").alias("high")).where("low != high").select("key")
    kinds = classes.join(several, "key", "left_semi").select("kind").distinct()
    place = F.xxhash64("id", "digest", "at").alias("place")
    one = found.groupBy("kind").agg(F.min(place).alias("place")).join(kinds, "kind", "left_semi")
    return found.select("kind", place, "items").join(one, ["kind", "place"], "left_semi").select("kind", "items").dropDuplicates(["kind"])


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = 0.8, recall: float = 0.95, min_words: int = 24) -> DataFrame:
    """(id, digest, start, size, words, cluster, kept_id): byte spans of passages that repeat one of a smaller document.

    digest parts rows that repeat an id with different texts: each has its own spans, while their repeats of each
    other are repeats within one document, which stay. cluster is the smallest class of the passage's first paragraph,
    kept_id the document that keeps the passage's first paragraph. Ties of ids are resolved by digest, then place. Null
    and empty texts and null ids have no passages; an empty table gives none; other columns are ignored. Repeats of
    fewer than ``min_words`` words stay. No passage, document or partner is capped: classes are first linked to the
    smallest and the largest under each of their band values; those under a band value that are still apart are then
    compared by the prefix rule, until every similar pair shares a component.
    """
    bands = bands_for(recall, similarity)
    rows = docs.select(F.col(id_col).alias("id"), digest(text_col).alias("digest"), F.col(text_col).alias("text")).where("id is not null")
    start, spark = staging.mark(), docs.sparkSession
    every = staging.put(_paragraphs(rows, bands), "paragraphs")
    key = F.explode(F.array(*[f"k{i}" for i in range(bands)])).alias("key")
    keys = staging.put(every.select("id", key).groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a < b").select("key"), "keys")
    staging.release(spark)
    # Stored before it is made distinct, so that the join may be split where one band value has many rows.
    shared = staging.put(every.select("kind", key).join(keys.hint("shuffle_hash"), "key", "left_semi"), "shared")
    staging.release(spark)
    classes = staging.put(shared.distinct(), "classes")
    kinds = classes.select("kind").distinct()
    found = staging.put(every.drop(*[f"k{i}" for i in range(bands)]).join(kinds.hint("shuffle_hash"), "kind", "left_semi"), "found")
    staging.drop_since(start, keep=(classes, found))
    staging.release(spark)
    sets = staging.put(_sets(found, classes), "sets")
    comp = _clusters(classes, sets, similarity)
    named = found.drop("items").join(comp.select(F.col("node").alias("kind"), "component"), "kind", "left").withColumn("cluster", F.coalesce("component", "kind")).drop("component")
    named = staging.put(named, "occurrences")
    staging.drop_since(start, keep=(named,))
    staging.release(spark)
    k = F.min(F.struct("id", "digest", "at", "words", "kind")).alias("k")
    kept = named.groupBy("cluster").agg(k, F.max("id").alias("most")).where("k.id < most").select("cluster", *[F.col(f"k.{c}").alias(f"kept_{c}") for c in ("id", "digest", "at", "words", "kind")])
    again = join_heavy(named, staging.put(kept, "kept"), ["cluster"]).where(F.col("id") != F.col("kept_id"))
    runs = staging.put(_runs(again, min_words), "runs")
    staging.drop_since(start, keep=(runs,))
    staging.release(spark)
    out = staging.put(_passages(rows, runs, similarity, min_words), "passages")
    staging.drop_since(start, keep=(out,))
    staging.release(spark)
    return out


def _arrow(kind: T.DataType) -> pa.DataType:
    return pa.int64() if isinstance(kind, T.LongType) else pa.int32() if isinstance(kind, T.IntegerType) else pa.string()


def _flat(lists: pa.Array) -> tuple[np.ndarray, pa.StructArray]:
    """The members of a column of lists, and the row of each."""
    size = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.repeat(np.arange(len(lists)), size), lists.flatten()


def _column(members: pa.StructArray, name: str) -> np.ndarray:
    return members.field(name).to_numpy(zero_copy_only=False)


def _runs(again: DataFrame, min_words: int) -> DataFrame:
    """(id, digest, at, words, cluster, kept_id, kept_digest, first, last, whole) of paragraphs that follow each other.

    whole: a run of at least min_words words, wherever its paragraphs are kept. Not whole: paragraphs that equal their
    kept ones and follow each other there too, as the words first to last.
    """
    exact = (F.col("kind") == F.col("kept_kind")) & (F.col("words") == F.col("kept_words"))
    # A document's repeated paragraphs are bounded by its own length.
    lists = again.groupBy("id", "digest").agg(F.collect_list(F.struct("at", "words", "cluster", "kept_id", "kept_digest", "kept_at", exact.alias("exact"))).alias("p"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, members = _flat(b.column("p"))
            at = _column(members, "at")
            order = np.lexsort((at, row))
            row, at = row[order], at[order]
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (at[1:] != at[:-1])  # equal rows repeat their places
            order, row, at = order[new], row[new], at[new].astype(np.int64)
            if not len(row):
                continue
            words, exact, there, home = (_column(members, c)[order] for c in ("words", "exact", "kept_at", "kept_digest"))
            owner = members.field("kept_id").take(pa.array(order))
            apart = np.ones(len(row), bool)
            apart[1:] = (row[1:] != row[:-1]) | (at[1:] != at[:-1] + words[:-1])
            starts = np.flatnonzero(apart)
            total = np.add.reduceat(words.astype(np.int64), starts)
            yield made(b, members, order, row, starts[total >= min_words], total[total >= min_words], at, home, there, there, True)
            mine = np.flatnonzero(exact)
            if len(mine):
                row2, at2, words2, there2 = row[mine], at[mine], words[mine].astype(np.int64), there[mine].astype(np.int64)
                owner2 = owner.take(pa.array(mine))
                cut = np.ones(len(mine), bool)
                moved = pc.not_equal(owner2[1:], owner2[:-1]).to_numpy(zero_copy_only=False)
                cut[1:] = (row2[1:] != row2[:-1]) | (at2[1:] != at2[:-1] + words2[:-1]) | (there2[1:] != there2[:-1] + words2[:-1]) | (home[mine][1:] != home[mine][:-1]) | moved
                starts = np.flatnonzero(cut)
                total = np.add.reduceat(words2, starts)
                yield made(b, members, order, row, mine[starts], total, at, home, there, there.astype(np.int64), False)

    def made(b, members, order, row, pick, total, at, home, first, last, whole) -> pa.RecordBatch:
        source = pa.array(order[pick])
        own = pa.array(row[pick])
        columns = [b.column("id").take(own), b.column("digest").take(own), pa.array(at[pick], pa.int32()), pa.array(total, pa.int32()), members.field("cluster").take(source), members.field("kept_id").take(source)]
        columns += [pa.array(home[pick], pa.int64()), pa.array(first[pick], pa.int32()), pa.array(last[pick] + total, pa.int32()), pa.array(np.full(len(pick), whole))]
        return pa.RecordBatch.from_arrays(columns, names=["id", "digest", "at", "words", "cluster", "kept_id", "kept_digest", "first", "last", "whole"])

    kind = again.schema["id"].dataType.simpleString()
    return lists.mapInArrow(run, f"id {kind}, digest long, at int, words int, cluster long, kept_id {kind}, kept_digest long, first int, last int, whole boolean")


def _hashes(b: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """32-bit word hashes of all texts, the first word of each text, and the words' byte spans within their texts."""
    raw, offsets = K.utf8(b.column("text"))
    s, e, r = K.words(raw, offsets)
    first = np.searchsorted(r, np.arange(b.num_rows + 1))
    return (K.spans(raw, s, e) >> np.uint64(32)).astype(np.uint32), first, s - offsets[r], e - offsets[r]


def _contexts(rows: DataFrame, places: DataFrame) -> DataFrame:
    """(id, digest, w, before, words): hashes of the CONTEXT words before word w, from it backwards, or from w on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in K.slices(batches, "text"):
            h, first, _, _ = _hashes(b)
            row, members = _flat(b.column("wanted"))
            w, before = _column(members, "w"), _column(members, "before")
            out = []
            for lo, hi, k, back in zip(first[row].tolist(), first[row + 1].tolist(), w.tolist(), before.tolist()):
                out.append(h[max(lo, lo + k - CONTEXT) : lo + k][::-1].tobytes() if back else h[lo + k : min(hi, lo + k + CONTEXT)].tobytes())
            own = pa.array(row)
            yield pa.RecordBatch.from_arrays([b.column("id").take(own), b.column("digest").take(own), members.field("w"), members.field("before"), pa.array(out, pa.binary())], names=["id", "digest", "w", "before", "words"])

    kind = rows.schema["id"].dataType.simpleString()
    # A document's places are bounded by its own length.
    lists = places.distinct().groupBy("id", "digest").agg(F.collect_list(F.struct("w", "before")).alias("wanted"))
    return rows.join(lists, ["id", "digest"]).mapInArrow(run, f"id {kind}, digest long, w int, before boolean, words binary")


def _padded(words: pa.Array, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Contexts as rows of equal length, and the length of each."""
    size = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64) // 4
    out = np.full((len(words), 2 * CONTEXT), pad, np.int64)
    out[np.arange(2 * CONTEXT) < size[:, None]] = np.frombuffer(b"".join(words.to_pylist()), np.uint32)
    return out, size


def _triples(x: np.ndarray, size: np.ndarray, none: int) -> np.ndarray:
    """A hash of the three words from each place on; ``none`` where fewer are left."""
    u = x.view(np.uint64)
    out = np.full(x.shape, none, np.uint64)
    out[:, :-2] = K.mix(K.mix(u[:, :-2]) * np.uint64(3) + K.mix(u[:, 1:-1]) * np.uint64(5) + u[:, 2:])
    out[np.arange(x.shape[1]) > size[:, None] - 3] = none
    return out


def aligned(x: np.ndarray, nx: np.ndarray, y: np.ndarray, ny: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row by row, where stretches of equal words end, from the start on, over at most so many changed places.

    x and y: padded rows and their lengths. Given are the ends in x, those in y, the stretches' lengths, and how many
    there are. A changed place ends at the nearest three equal words, at most CHANGED words on in either row.
    """
    n = len(x)
    ends_x, ends_y, length = (np.zeros((n, most + 1), np.int64) for _ in range(3))
    count = np.zeros(n, np.int64)
    i, j, live = np.zeros(n, np.int64), np.zeros(n, np.int64), np.arange(n)
    tx, ty = _triples(x, nx, 1), _triples(y, ny, 2)
    k, d = np.arange(CONTEXT), np.arange(CHANGED + 1)
    cost = ((d[:, None] + d) * (CHANGED + 1) + d[:, None]).ravel()
    for step in range(most + 1):
        if not len(live):
            break
        same = np.take_along_axis(x[live], i[live, None] + k, 1) == np.take_along_axis(y[live], j[live, None] + k, 1)
        far = np.where(same.all(axis=1), CONTEXT, same.argmin(axis=1))
        i[live] += far
        j[live] += far
        ends_x[live, step], ends_y[live, step], length[live, step], count[live] = i[live], j[live], far, step + 1
        live = live[(i[live] < nx[live]) & (j[live] < ny[live])]
        met = np.take_along_axis(tx[live], i[live, None] + d, 1)[:, :, None] == np.take_along_axis(ty[live], j[live, None] + d, 1)[:, None, :]
        met = met.reshape(len(live), len(cost))
        best = np.where(met, cost, cost[-1] + 1).argmin(axis=1)
        some = met.any(axis=1)
        live, best = live[some], best[some]
        i[live] += best // (CHANGED + 1)
        j[live] += best % (CHANGED + 1)
    return ends_x, ends_y, length, count


def _grams(words: np.ndarray) -> np.ndarray:
    """The distinct five-word shingles of a sequence; the whole of a shorter one is one."""
    n = min(SHINGLE, len(words))
    out = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        out = K.mix(out * np.uint64(0xD6E8FEB86659FD93) + words[k : k + len(out)])
    return np.unique(out)


def similar(x: np.ndarray, y: np.ndarray, similarity: float) -> bool:
    """Whether the five-word shingles of two sequences of word hashes have this Jaccard similarity."""
    u, v = _grams(x.astype(np.uint64)), _grams(y.astype(np.uint64))
    both = len(np.intersect1d(u, v, assume_unique=True))
    return both >= similarity * (len(u) + len(v) - both) - 1e-9


def _passages(rows: DataFrame, runs: DataFrame, similarity: float, min_words: int) -> DataFrame:
    """(id, digest, start, size, words, cluster, kept_id): whole runs and the windows around equal paragraphs, as one where they touch."""
    units = staging.put(runs.where("NOT whole"), "units")
    ends = [units.select(F.col("kept_id").alias("id"), F.col("kept_digest").alias("digest"), F.col(c).alias("w"), F.lit(c == "first").alias("before")) for c in ("first", "last")]
    near = staging.put(_contexts(rows, ends[0].unionByName(ends[1])), "contexts")
    staging.release(rows.sparkSession)
    for c, words in (("first", "yl"), ("last", "yr")):
        theirs = near.where(F.col("before") == F.lit(c == "first")).select(F.col("id").alias("kept_id"), F.col("digest").alias("kept_digest"), F.col("w").alias(c), F.col("words").alias(words))
        units = staging.put(join_heavy(units, theirs, ["kept_id", "kept_digest", c]), "units")
        staging.release(rows.sparkSession)
    none = F.lit(None).cast("binary")
    parts = units.unionByName(runs.where("whole").withColumns({"yl": none, "yr": none}))
    lists = parts.groupBy("id", "digest").agg(F.collect_list(F.struct("at", "words", "cluster", "kept_id", "whole", "yl", "yr")).alias("parts"))
    # A changed word alone costs one in (1 - similarity) / (1 + similarity) of the shingles.
    most = math.ceil(2 * CONTEXT * (1 - similarity) / (1 + similarity) / SHINGLE)

    def windows(h: np.ndarray, lo: np.ndarray, hi: np.ndarray, at: np.ndarray, words: np.ndarray, yl: pa.Array, yr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Words before and after each unit that belong to its longest window; -1 where no window is long enough."""
        back, on = at[:, None] - 1 - np.arange(2 * CONTEXT), at[:, None] + words[:, None] + np.arange(2 * CONTEXT)
        (l, nl), (r, nr) = _padded(yl, -2), _padded(yr, -2)
        ml, mr = np.minimum(at - lo, CONTEXT), np.minimum(hi - at - words, CONTEXT)
        k = np.arange(2 * CONTEXT)
        xl = np.where(k < ml[:, None], h[np.clip(back, 0, len(h) - 1)], -1).astype(np.int64)
        xr = np.where(k < mr[:, None], h[np.clip(on, 0, len(h) - 1)], -1).astype(np.int64)
        (a, c, el, na), (b, d, er, nb) = aligned(xl, ml, l, nl, most), aligned(xr, mr, r, nr, most)
        left, right = a[:, 0].copy(), b[:, 0].copy()
        # Only the stretches' shingles count as common here; what passes is verified on the sets of both sequences.
        more = np.flatnonzero((na > 1) | (nb > 1))
        pick = lambda v, w: (v[more][:, :, None], w[more][:, None, :])
        inner = words[more][:, None, None]
        (a2, b2), (c2, d2) = pick(a, b), pick(c, d)
        gain = [np.cumsum(np.where(np.arange(most + 1) > 0, np.maximum(v[more] - SHINGLE + 1, 0), 0), axis=1) for v in (el, er)]
        common = np.maximum(a2[:, :1] + inner + b2[:, :, :1] - SHINGLE + 1, 0) + gain[0][:, :, None] + gain[1][:, None, :]
        size = a2 + b2 + c2 + d2 + 2 * (inner - SHINGLE + 1)
        there = (np.arange(most + 1)[:, None] < na[more][:, None, None]) & (np.arange(most + 1) < nb[more][:, None, None])
        there &= (common >= similarity * (size - common) - 1e-9) & (a2 + b2 + inner >= min_words)
        there[:, 0, 0] = False
        for k, s, t in np.argwhere(there)[np.argsort(-(a2 + b2)[there], kind="stable")].tolist():
            u = int(more[k])
            if a[u, s] + b[u, t] <= left[u] + right[u]:
                continue
            p, q = int(at[u]), int(at[u] + words[u])
            if similar(h[p - a[u, s] : q + b[u, t]], np.concatenate([l[u, : c[u, s]][::-1], h[p:q], r[u, : d[u, t]]]), similarity):
                left[u], right[u] = a[u, s], b[u, t]
        short = left + right + words < min_words
        left[short] = right[short] = -1
        return left, right

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in K.slices(batches, "text"):
            h, first, s, e = _hashes(batch)
            row, members = _flat(batch.column("parts"))
            at, words = (_column(members, c).astype(np.int64) for c in ("at", "words"))
            unit = np.flatnonzero(~_column(members, "whole").astype(bool))
            begin, end = at.copy(), at + words
            if len(unit):
                pick = pa.array(unit)
                lo = first[row[unit]]
                left, right = windows(h, lo, first[row[unit] + 1], lo + at[unit], words[unit], members.field("yl").take(pick), members.field("yr").take(pick))
                begin[unit] -= np.maximum(left, 0)
                end[unit] += np.maximum(right, 0)
                end[unit[left < 0]] = -1
            # Spans in order; one that touches what comes before it belongs to it.
            order = np.lexsort((end, begin, row))
            order = order[end[order] >= 0]
            own, last, stop = [], -1, 0
            for i, doc, b, z in zip(order.tolist(), row[order].tolist(), begin[order].tolist(), end[order].tolist()):
                if doc == last and b <= stop:
                    if z > stop:
                        own[-1][2] = stop = z
                else:
                    own.append([i, b, z])
                    last, stop = doc, z
            pick = np.array([o[0] for o in own], np.int64)
            b, z = (np.array([o[k] for o in own], np.int64) for k in (1, 2))
            base = first[row[pick]]
            start = s[base + b] if len(pick) else pick
            size = e[base + z - 1] - start if len(pick) else pick
            docs, source = pa.array(row[pick]), pa.array(pick)
            yield pa.RecordBatch.from_arrays([batch.column("id").take(docs), batch.column("digest").take(docs), pa.array(start, pa.int32()), pa.array(size, pa.int32()), pa.array(z - b, pa.int32()), members.field("cluster").take(source), members.field("kept_id").take(source)], names=["id", "digest", "start", "size", "words", "cluster", "kept_id"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.join(lists, ["id", "digest"]).mapInArrow(run, f"id {kind}, digest long, start int, size int, words int, cluster long, kept_id {kind}")


def without_passages(docs: DataFrame, passages: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with the passages cut out of their texts, and n_chars (if there) brought up to date.

    Spans belong to rows by id and digest of the text, so a row that repeats an id with another text keeps its own. A
    document of which nothing visible is left goes; one without passages keeps its text as it is, whatever it is.
    """
    names, schema = docs.columns, docs.schema
    cut, of, by = (K.fresh(names, c) for c in ("spans", "id", "digest"))
    spans = passages.groupBy(F.col("id").alias(of), F.col("digest").alias(by)).agg(F.sort_array(F.collect_list(F.struct("start", "size"))).alias(cut))
    joined = docs.join(spans, (docs[id_col] == F.col(of)) & (digest(text_col) == F.col(by)), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in K.slices(batches, text_col):
            texts, sizes, keep = [], [], []
            for text, spans in zip(b.column(text_col).to_pylist(), b.column(cut).to_pylist()):
                if spans and text is not None:
                    data, parts, at = text.encode(), [], 0
                    for s in spans:
                        parts.append(data[at : s["start"]])
                        at = max(at, s["start"] + s["size"])
                    text = b"".join([*parts, data[at:]]).decode()
                keep.append(not spans or bool(text and text.strip()))
                texts.append(text)
                sizes.append(len(text or "") if spans else None)
            columns = {c: b.column(c) for c in names}
            columns[text_col] = pa.array(texts, pa.string())
            if "n_chars" in columns:
                old = columns["n_chars"]
                columns["n_chars"] = pa.array([o if n is None else n for n, o in zip(sizes, old.to_pylist())], old.type)
            yield pa.RecordBatch.from_arrays([*columns.values()], names=names).filter(pa.array(keep, pa.bool_()))

    return joined.select(*names, cut).mapInArrow(run, schema)
