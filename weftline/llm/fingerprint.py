"""Document fingerprints from content-defined chunks.

A gear hash of the last 16 bytes marks possible boundaries. Chunking is normalised: up to the normal length a
boundary needs more mask bits than beyond it, so lengths gather around the normal one, between a least and a most.
As a boundary depends on nearby bytes only, an edit changes the chunks it touches and chunks after it fall into step
again. A fingerprint is the set of (48-bit digest, length) of the chunks; containment is the share of the bytes of
one set's chunks that the other set holds too.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkernel as K

LEAST, NORMAL, MOST = 16, 48, 192
_GEAR = np.random.Generator(np.random.PCG64(41)).integers(0, 1 << 32, 256, dtype=np.uint32)
_HARD, _EASY = np.uint32(0xFE000000), np.uint32(0xF0000000)


def _gear(raw: np.ndarray) -> np.ndarray:
    """The gear hash over the 16 bytes up to each position, by doubling."""
    h = _GEAR[raw]
    for step in (1, 2, 4, 8):
        h[step:] += h[:-step].copy() << np.uint32(step)
    return h


def cuts(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts, and start, end and row of every chunk. Boundaries are looked for in one segment at a time."""
    raw, offsets = K.utf8(column)
    begins, stops = offsets[:-1].tolist(), offsets[1:].tolist()
    out, row, at = [], 0, 0
    for low in range(0, len(raw), K.SEGMENT):
        high, base = min(len(raw), low + K.SEGMENT), max(0, low - 16)
        h = _gear(raw[base : high + MOST])
        hard, easy = ([*(np.flatnonzero((h & m) == 0) + base).tolist(), 1 << 62] for m in (_HARD, _EASY))
        s, e, r = [], [], []
        while row < len(stops):
            if at >= stops[row]:
                row += 1
                at = begins[row] if row < len(stops) else at
                continue
            if at >= high:
                break
            end = hard[bisect_left(hard, at + LEAST - 1)] + 1
            if end > at + NORMAL:
                end = min(easy[bisect_left(easy, at + NORMAL)] + 1, at + MOST)
            end = min(end, stops[row])
            s.append(at)
            e.append(end)
            r.append(row)
            at = end
        out.append(np.array([s, e, r], np.int64))
    return raw, *(np.hstack(out) if out else np.zeros((3, 0), np.int64))


def chunk_sets(column: pa.Array) -> list[np.ndarray]:
    """For each text the sorted distinct values digest << 16 | length of its chunks."""
    raw, s, e, r = cuts(column)
    item = (K.spans(raw, s, e, fold=False) & np.uint64(0xFFFFFFFFFFFF0000)) | (e - s).astype(np.uint64)
    at = np.searchsorted(r, np.arange(len(column) + 1))
    return [np.unique(item[at[i] : at[i + 1]]) for i in range(len(column))]


def containment(x: np.ndarray, y: np.ndarray) -> float:
    """The share of the bytes of x's chunks that y has; 1 for two empty sets, 0 if one is empty."""
    if not len(x) or not len(y):
        return float(len(x) == len(y))
    size = (x & np.uint64(0xFFFF)).astype(np.int64)
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    return float(size[y[at] == x].sum() / size.sum())


def encoded(items: np.ndarray) -> str:
    return base64.b64encode(items.astype(">u8").tobytes()).decode()


def decoded(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), ">u8").astype(np.uint64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint) of every row. Null text: the fingerprint of an empty one, which is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in K.slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array([encoded(x) for x in chunk_sets(b.column("text"))], pa.string())], names=["id", "fingerprint"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, fingerprint string")


def _in_order(docs: DataFrame, id_col: str, text_col: str, parts: int) -> DataFrame:
    """(bucket, guard, id, text): ranges of ids; each begins with a guard, the last row of the range below.

    Rows come sorted by range, then id from low to high, so the next document of a row is that of the id before. The
    lowest range begins with the highest id of all. Ranges are 64 quantiles, each split evenly; null ids come first.
    Only one id of each range reaches the driver.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    marks = sorted(set(rows.select("id").where("id is not null").approxQuantile("id", [i / 64 for i in range(65)], 0.002)) or {0.0})
    fine = max(1, -(-4 * parts // max(1, len(marks) - 1)))
    low = F.array(*[F.lit(int(m)) for m in marks])
    q = F.greatest(F.size(F.filter(low, lambda m: m <= F.col("id"))) - 1, F.lit(0))
    at, to = F.element_at(low, q + 1), F.coalesce(F.try_element_at(low, q + 2), F.element_at(low, -1) + 1)
    inner = F.least(F.greatest(((F.col("id") - at) * fine / F.greatest(to - at, F.lit(1))).cast("long"), F.lit(0)), F.lit(fine - 1))
    bucket = F.coalesce(q * fine + inner + 1, F.lit(0)).cast("int")
    rows = rows.withColumn("bucket", bucket)
    heads = sorted((r.bucket, r.id) for r in rows.groupBy("bucket").agg(F.max("id").alias("id")).collect())
    # Each range's highest id also goes to the range above; the highest of all goes to the lowest range.
    above = {b: heads[(i + 1) % len(heads)][0] for i, (b, _) in enumerate(heads)} if heads else {}
    if not above:
        return rows.select("bucket", F.lit(False).alias("guard"), "id", "text")
    # A few hundred rows for any size of documents: four ranges for each task.
    spark = docs.sparkSession
    table = F.broadcast(spark.createDataFrame([(b, i, above[b]) for b, i in heads], "bucket int, head long, above int"))
    led = rows.join(table, "bucket")
    homes = F.array(F.struct("bucket", F.lit(False).alias("guard")))
    both = F.concat(homes, F.array(F.struct(F.col("above").alias("bucket"), F.lit(True).alias("guard"))))
    out = led.select(F.explode(F.when(F.col("id").eqNullSafe(F.col("head")), both).otherwise(homes)).alias("h"), "id", "text").select("h.bucket", "h.guard", "id", "text")
    return out.repartition(parts, "bucket").sortWithinPartitions("bucket", F.desc("guard"), F.asc_nulls_first("id"), "text")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text's fingerprint, that of its edited form, and its containment in that and in the next document.

    The edited form ends with the start of the next document instead of its own last half (code points). Documents
    follow each other by descending id, the first follows the last, and null ids come last. Rows that repeat an id
    have the same next document; as a next document such an id stands for its smallest text. A single document is
    its own next. Null text is empty. No rows for an empty table. Other columns are ignored. A task holds two texts
    besides those that it works on, however often an id repeats; the rows of one id go to one task.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = ["doc_id", "n_chars", "text_sha256", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def done(rows: list[tuple]) -> pa.RecordBatch:
        texts = [t for _, t, _ in rows]
        edited = [t[: len(t) - len(t) // 2] + n[: len(t) // 2] for _, t, n in rows]
        own = chunk_sets(pa.array(texts, pa.large_string()))
        new = chunk_sets(pa.array(edited, pa.large_string()))
        # The next document is mostly the row before.
        after = [own[i - 1] if i and rows[i - 1][1] == n else None for i, (_, _, n) in enumerate(rows)]
        if missing := [i for i, x in enumerate(after) if x is None]:
            for i, x in zip(missing, chunk_sets(pa.array([rows[i][2] for i in missing], pa.large_string()))):
                after[i] = x
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        return pa.RecordBatch.from_arrays([
            pa.array([i for i, _, _ in rows], pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.array(map(sha, texts), pa.string()), pa.array(map(sha, edited), pa.string()),
            pa.array(map(encoded, own), pa.string()), pa.array(map(encoded, new), pa.string()), pa.array([containment(x, y) for x, y in zip(own, new)], pa.float64()), pa.array([containment(x, y) for x, y in zip(own, after)], pa.float64()),
        ], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready, size = [], 0
        place, before, now = None, "", ""  # range and id of the last row; the smallest texts of the id before and of this one
        for b in K.slices(batches, "text"):
            for bucket, guard, i, text in zip(*(b.column(c).to_pylist() for c in ("bucket", "guard", "id", "text"))):
                here = (bucket, guard, i)
                if here != place:
                    place, before, now = here, now, text
                if guard:
                    continue
                ready.append((i, text, before))
                size += len(text) + len(before)
                if size > 1 << 19:
                    yield done(ready)
                    ready, size = [], 0
        if ready:
            yield done(ready)

    schema = "doc_id long, n_chars long, text_sha256 string, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return _in_order(docs, id_col, text_col, parts).mapInArrow(run, schema)
