"""MinHash near-duplicate groups by an inverted join over signature coordinates.

A text's set is its distinct word shingles; its signature has ``coords`` minima, and every (coordinate, value) is
one element. Texts with equal sets are one class, so thousands of copies travel as one row. Two classes can only
share ``match`` of the ``coords`` elements if they meet within the ``coords - match + 1`` rarest elements of each
(the prefix, in one global order by frequency), so only those are posted; the long lists of frequent elements are
skipped. Collisions of a candidate pair are then counted over both whole signatures, pairs with at least ``match``
go on, and every link is confirmed on the two full sets.

Links are found in rounds over these lists: each list first pairs its members with one pivot; once linked classes
share a component, only members of different components still have to meet. They carry parity sketches of their
sets, whose difference is a lower bound of the sets' difference; a pair that fails this exact bound can't link and
never leaves the join. A second round draws other pivots, the last one takes the pairs that are left. The list of a
frequent element is dealt to several tasks. No list, class or partner is capped.

Loss: at the threshold similarity 0.85 a pair shares 54 of 64 elements on average and falls below 40 about once in
a million times; everything after that is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import staging
from ..operators.components import connected_components
from . import textkernel as K
from .skew import join_heavy

SKETCH = 1024
WORDS = [f"w{k}" for k in range(SKETCH // 64)]
#: Classes of a list that go to one part of it.
PART = 1024


def digest(text_col: str) -> Column:
    """With the id, what names a row: rows that repeat an id with another text are parted by it."""
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def signatures(docs: DataFrame, id_col: str, text_col: str, shingle: int, coords: int) -> DataFrame:
    """(id, digest, n_shingles, class, sig): class is a 128-bit digest of the set, null where the set is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in K.slices(batches, "text"):
            n, cls, sig = [], [], []
            for items in K.sets_of(b.column("text"), shingle):
                n.append(len(items))
                cls.append(xxhash.xxh3_128_digest(items.tobytes()) if len(items) else None)
                sig.append(K.signature(items, coords).tobytes() if len(items) else None)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("digest"), pa.array(n, pa.int64()), pa.array(cls, pa.binary()), pa.array(sig, pa.binary())], names=["id", "digest", "n_shingles", "class", "sig"])

    rows = docs.select(F.col(id_col).alias("id"), digest(text_col).alias("digest"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, digest long, n_shingles long, class binary, sig binary")


def postings(classes: DataFrame, coords: int, match: int) -> DataFrame:
    """(element, df, class): the prefix elements of each class that another class has too; df classes have it."""

    def elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = np.arange(coords, dtype=np.uint64) << np.uint64(32)
        for b in batches:
            rows = np.repeat(np.arange(b.num_rows), coords)
            sig = np.frombuffer(b"".join(b.column("sig").to_pylist()), np.uint32).reshape(-1, coords)
            yield pa.RecordBatch.from_arrays([pa.array((sig + at).ravel().view(np.int64)), b.column("class").take(pa.array(rows))], names=["element", "class"])

    posted = classes.select("class", "sig").mapInArrow(elements, "element long, class binary")
    shared = posted.groupBy("element").agg(F.count("*").alias("df")).where("df > 1")
    common = posted.join(shared, "element").groupBy("class").agg(F.sort_array(F.collect_list(F.struct("df", "element"))).alias("e"))
    # Elements of frequency one come first in the order and need no list.
    keep = F.lit(coords - match + 1) - (F.lit(coords) - F.size("e"))
    return common.where(keep > 0).select("class", F.explode(F.slice("e", 1, keep)).alias("x")).select("x.element", "x.df", "class")


def _collide(pairs: DataFrame, classes: DataFrame, match: int) -> DataFrame:
    """Pairs whose signatures agree in at least match coordinates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint32).reshape(b.num_rows, -1) for c in ("sa", "sb"))
                yield b.select(["a", "b"]).filter(pa.array((x == y).sum(axis=1) >= match))

    left = classes.select(F.col("class").alias("a"), F.col("sig").alias("sa"))
    right = classes.select(F.col("class").alias("b"), F.col("sig").alias("sb"))
    return join_heavy(pairs, right, ["b"]).join(left, "a").mapInArrow(run, "a binary, b binary")


def _confirm(pairs: DataFrame, sets: DataFrame, at_least: tuple[int, int]) -> DataFrame:
    """Pairs with share of the union of at_least[0] / at_least[1], counted on the full sets."""
    num, den = at_least

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good = []
            for x, y in zip(b.column("xa"), b.column("xb")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                short, long = (x, y) if len(x) <= len(y) else (y, x)
                if den * len(short) < num * len(long):
                    good.append(False)
                    continue
                at = np.searchsorted(long, short)
                both = int((long[np.minimum(at, len(long) - 1)] == short).sum())
                good.append(den * both >= num * (len(x) + len(y) - both))
            yield b.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    left = sets.select(F.col("class").alias("a"), F.col("items").alias("xa"))
    right = sets.select(F.col("class").alias("b"), F.col("items").alias("xb"))
    return join_heavy(pairs, right, ["b"]).join(left, "a").mapInArrow(run, "a binary, b binary")


def _full_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(class, items) of the rows (id, digest) that stand for the wanted classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in K.slices(batches, "text"):
            found = [(xxhash.xxh3_128_digest(x.tobytes()), x.tobytes()) for x in K.sets_of(b.column("text"), shingle) if len(x)]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.binary())], names=["class", "items"])

    texts = docs.select(F.col(id_col).alias("id"), digest(text_col).alias("digest"), F.col(text_col).alias("text"))
    names = wanted.select(F.col("id").alias("own"), F.col("digest").alias("by")).hint("shuffle_hash")
    chosen = texts.join(names, texts["id"].eqNullSafe(F.col("own")) & (F.col("digest") == F.col("by")), "left_semi")
    return chosen.select("text").mapInArrow(run, "class binary, items binary").dropDuplicates(["class"])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, at_least: tuple[int, int] = (85, 100), coords: int = 64, match: int = 40) -> DataFrame:
    """(id, digest, n_shingles, component_id, kept, stays) of every row.

    kept: the row's id names its component. stays: of each component, the rows of one id and one text, the smallest
    (null ids come last); digest tells apart texts under one id. Null, empty or blank text: no shingles, linked with
    nothing, a component of its own that stays. Rows that repeat an id are judged by their own texts and may differ. A
    null id never names a component that has another id. An empty table gives an empty result; other columns are
    ignored. Ties of frequency are resolved by the element, so results don't depend on the partitioning.
    """
    start = staging.mark()
    sigs = staging.put(signatures(docs, id_col, text_col, shingle, coords), "signatures")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "digest")).alias("f")
    classes = staging.put(sigs.where("class is not null").groupBy("class", "sig").agg(first).select("class", "sig", "f.id", "f.digest"), "classes")
    lists = staging.put(postings(classes, coords, match), "postings")
    wanted = classes.select("class", "id", "digest").join(lists.select("class").distinct(), "class", "left_semi")
    sets = staging.put(_full_sets(docs, wanted, id_col, text_col, shingle), "sets")
    staging.release(docs.sparkSession)
    comp = None
    for pairs in (_pivots, _others, _rest):
        members = lists if comp is None else staging.put(_sketched(_open(lists, comp), sets), "members") if pairs is _others else _open(members, comp)
        close = staging.put(_collide(staging.put(pairs(members, at_least), "candidates"), classes, match), "pairs")
        links = staging.put(_confirm(close, sets, at_least), "links")
        if comp is not None:
            links = links.unionByName(comp.select(F.col("node").alias("a"), F.col("component").alias("b")))
        comp = staging.put(connected_components(links, "a", "b"), "components")
        staging.release(docs.sparkSession)
    out = staging.put(_verdicts(sigs.drop("sig"), classes.drop("sig"), comp), "verdicts")
    staging.drop_since(start, keep=(out,))
    staging.release(docs.sparkSession)
    return out


def _parts(size: str) -> Column:
    return F.greatest(F.ceil(F.col(size) / PART).cast("int"), F.lit(1))


def _dealt(members: DataFrame, size: str = "df") -> DataFrame:
    """Members with the part of their list that they go to."""
    return members.withColumn("part", F.pmod(F.xxhash64("class"), _parts(size)).cast("int"))


def _copied(rows: DataFrame, size: str = "df") -> DataFrame:
    """Rows for every part of their list."""
    return rows.withColumn("part", F.explode(F.sequence(F.lit(0), _parts(size) - 1)))


def _open(lists: DataFrame, comp: DataFrame) -> DataFrame:
    """Members of the lists that still hold more than one component, with their component."""
    named = lists.drop("comp").join(comp.select(F.col("node").alias("class"), F.col("component").alias("c")), "class", "left").withColumn("comp", F.coalesce("c", "class")).drop("c")
    apart = named.groupBy("element", "df").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x != y").select("element", "df")
    return _dealt(named).join(_copied(apart).drop("df"), ["element", "part"], "left_semi").drop("part")


def _sketched(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Members with the size and the sketch of their sets."""
    marks = sets.join(members.select("class").distinct(), "class", "left_semi").mapInArrow(_sketch, "class binary, n int, " + ", ".join(f"{w} long" for w in WORDS))
    return members.join(marks, "class")


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The size of a set and, for each of SKETCH bins, the parity of its items in it.

    Each bin in which two sets differ holds an item that only one of them has, so the number of such bins is a lower
    bound of their difference, whatever their size.
    """
    for b in batches:
        words, n = np.zeros((b.num_rows, SKETCH // 64), np.uint64), np.zeros(b.num_rows, np.int32)
        for i, x in enumerate(b.column("items")):
            x = K.mix(np.frombuffer(x.as_buffer(), np.uint64))
            odd = np.bincount((x % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH) & 1
            words[i], n[i] = np.packbits(odd.astype(np.uint8)).view(np.uint64), len(x)
        yield pa.RecordBatch.from_arrays([b.column("class"), pa.array(n), *(pa.array(words[:, k].copy().view(np.int64)) for k in range(words.shape[1]))], names=["class", "n", *WORDS])


def _able(x: str, y: str, at_least: tuple[int, int]) -> Column:
    """Whether a link is possible by the sizes of two sets and the difference of their sketches; no link fails these bounds."""
    num, den = at_least
    nx, ny = F.col(f"{x}.n"), F.col(f"{y}.n")
    differ = sum((F.bit_count(F.col(f"{x}.{w}").bitwiseXOR(F.col(f"{y}.{w}"))) for w in WORDS), F.lit(0))
    return (F.lit(den) * F.least(nx, ny) >= F.lit(num) * F.greatest(nx, ny)) & (F.lit(den + num) * differ <= F.lit(den - num) * (nx + ny))


def _pivots(members: DataFrame, at_least: tuple[int, int]) -> DataFrame:
    """Each member with its list's smallest class, so that lists agree on their pivots."""
    least = members.groupBy("element", "df").agg(F.min("class").alias("b"))
    return _dealt(members).withColumnRenamed("class", "a").join(_copied(least).drop("df"), ["element", "part"]).where("a != b").select("a", "b").distinct()


def _others(members: DataFrame, at_least: tuple[int, int]) -> DataFrame:
    """Each member with a pivot that its list draws for itself."""
    rest = ["class", "comp", "n", *WORDS]
    drawn = members.groupBy("element", "df").agg(F.min(F.struct(F.xxhash64("class", "element").alias("h"), *rest)).alias("y"))
    met = _dealt(members).alias("x").join(_copied(drawn).drop("df"), ["element", "part"]).where((F.col("x.comp") != F.col("y.comp")) & _able("x", "y", at_least))
    return met.select(F.col("x.class").alias("a"), F.col("y.class").alias("b")).distinct()


def _rest(members: DataFrame, at_least: tuple[int, int]) -> DataFrame:
    """The pairs of one list that lie in different components and may link by the bounds.

    One of two such members is outside the list's main component, the one with most members: only those outside go to
    every part of the list.
    """
    by = members.groupBy("element", "df", "comp").agg(F.count("*").alias("size")).groupBy("element", "df").agg(F.sum("size").alias("size"), F.max(F.struct("size", "comp")).alias("m"))
    led = _dealt(members).join(_copied(by.select("element", "df", "size", F.col("m.comp").alias("main"))).drop("df"), ["element", "part"]).drop("part")
    x, y = _dealt(led, "size").alias("x"), _copied(led.where("comp != main"), "size").alias("y")
    once = (F.col("x.comp") == F.col("x.main")) | (F.col("x.class") < F.col("y.class"))
    met = x.join(y, (F.col("x.element") == F.col("y.element")) & (F.col("x.part") == F.col("y.part")) & (F.col("x.comp") != F.col("y.comp")) & once & _able("x", "y", at_least))
    return met.select(F.least("x.class", "y.class").alias("a"), F.greatest("x.class", "y.class").alias("b")).distinct()


def _verdicts(sigs: DataFrame, classes: DataFrame, comp: DataFrame) -> DataFrame:
    named = classes.join(comp.select(F.col("node").alias("class"), "component"), "class", "left")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "digest")
    least = named.where("component is not null").groupBy("component").agg(F.min(order).alias("low"))
    low = named.join(least, "component", "left").select("class", F.coalesce("low", order).alias("low"))
    alone = sigs.where("class is null").select("id", "digest", "n_shingles", F.col("id").alias("component_id"), F.lit(True).alias("kept"), F.lit(True).alias("stays"))
    mine = F.col("id").eqNullSafe(F.col("low.id"))
    grouped = join_heavy(sigs.where("class is not null"), low, ["class"])
    return grouped.select("id", "digest", "n_shingles", F.col("low.id").alias("component_id"), mine.alias("kept"), (mine & (F.col("digest") == F.col("low.digest"))).alias("stays")).unionByName(alone)


def without_duplicates(docs: DataFrame, verdicts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each component of near_duplicates; texts without words all stay.

    Of rows with the stay's id and text the one with the least digest of all its columns stays (none may be a map).
    """
    names = docs.columns
    of, by = (K.fresh(names, c) for c in ("id", "digest"))
    is_it = docs[id_col].eqNullSafe(F.col(of)) & (digest(text_col) == F.col(by))
    key = [F.col("id").alias(of), F.col("digest").alias(by)]
    rest = docs.join(verdicts.where("NOT stays").select(*key).distinct().hint("shuffle_hash"), is_it, "left_anti")
    again = staging.put(verdicts.where("stays AND n_shingles > 0").groupBy("id", "digest").count().where("count > 1").select(*key), "repeated")
    if again.isEmpty():
        return rest
    several = rest.join(again, is_it)
    one = several.groupBy(of, by).agg(F.min_by(F.struct(*names), F.xxhash64(*names)).alias(K.fresh([of, by], "row")))
    return rest.join(again, is_it, "left_anti").unionByName(one.select(f"{K.fresh([of, by], 'row')}.*"))
