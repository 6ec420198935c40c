"""A quality classifier by co-training over two views of a document.

One classifier sees the content: what its words and characters are. The other sees page metadata: language, source,
length and the layout of lines. Both start from the labelled rows. In each round each one scores all other documents
and labels some of those that it is sure of, drawn from all of them alike, and the other learns from these. Each view
is then calibrated on labelled rows that it did not learn from, and a last model combines the two calibrated log-odds
into the score of every document.

The fit uses a bounded sample of ``sample`` labelled rows, chosen by a hash of the id, and ``give`` pseudo-labelled
documents for each round, view and label. Which documents these are is decided over the whole table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .. import staging
from . import linear
from . import textkernel as K

LANGS, SOURCES = 16, 32
_CLASS = np.zeros(256, np.int64)
for _k, _bytes in enumerate((range(65, 91), range(97, 123), range(48, 58), b"#$%&*@^~<>{}[]\\=+", b"|", b"!?", b".,;:", b"\n\r", range(128, 256)), 1):
    _CLASS[list(_bytes)] = _k
CLASSES = 10
CONTENT, METADATA = 14, 6 + LANGS + SOURCES


def content_view(column: pa.Array) -> np.ndarray:
    """Per text: number and length of words, repetition, and shares of character classes."""
    raw, offsets = K.utf8(column)
    n = len(column)
    size = np.diff(offsets)
    share = np.zeros((n, CLASSES))
    for i, (a, z) in enumerate(zip(offsets.tolist(), offsets[1:].tolist())):
        for k in range(a, z, K.SEGMENT):
            share[i] += np.bincount(_CLASS, np.bincount(raw[k : min(z, k + K.SEGMENT)], minlength=256), CLASSES)
    share /= np.maximum(size, 1)[:, None]
    s, e, r = K.words(raw, offsets)
    h = K.spans(raw, s, e)
    words = np.bincount(r, minlength=n)
    order = np.lexsort((h, r))
    new = np.ones(len(h), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (r[order][1:] != r[order][:-1])
    distinct = np.bincount(r[order][new], minlength=n)
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (r[1:] == r[:-1])
    runs = np.bincount(r[again], minlength=n)
    length = np.bincount(r, e - s, n) / np.maximum(words, 1)
    some = np.maximum(words, 1)
    letters = share[:, 1] + share[:, 2] + share[:, 9]
    extra = np.stack([np.log1p(words), distinct / some, runs / some, np.log1p(length), share[:, 1] / np.maximum(letters, 1e-9), np.minimum(1, (share[:, 4] + share[:, 5]) * 20)], axis=1)
    return np.hstack([extra, np.log1p(100 * share[:, [1, 3, 4, 5, 6, 7, 8, 9]])])


def metadata_view(column: pa.Array, lang: list, source: list, n_chars: list) -> np.ndarray:
    """Per text: length, number and evenness of its lines, and hashed language and source."""
    raw, offsets = K.utf8(column)
    n, size = len(column), np.diff(offsets)
    ends = np.flatnonzero(raw == 10)
    lines = np.bincount(np.searchsorted(offsets, ends, "right") - 1, minlength=n) + 1
    out = np.zeros((n, METADATA))
    length = np.array([size[i] if c is None else max(0, c) for i, c in enumerate(n_chars)], float)
    out[:, 0], out[:, 1], out[:, 2] = np.log1p(length), np.log1p(lines), np.log1p(size / lines)
    inner = np.bincount(np.searchsorted(offsets, np.flatnonzero((raw[:-1] == 10) & (raw[1:] == 10)), "right") - 1, minlength=n) if len(raw) else np.zeros(n)
    out[:, 3] = inner / lines
    out[:, 4] = size / np.maximum(length, 1)
    last = np.array([raw[b - 1] if b > a else 0 for a, b in zip(offsets, offsets[1:])])
    out[:, 5] = np.isin(last, [46, 33, 63])
    for i in range(n):
        out[i, 6 + hash_of(lang[i], LANGS)] = 1
        out[i, 6 + LANGS + hash_of(source[i], SOURCES)] = 1
    return out


def hash_of(value: str | None, buckets: int) -> int:
    import zlib

    return zlib.crc32((value or "").encode()) % buckets


@dataclass(frozen=True)
class Views:
    """The two fitted views, their calibrations (a model of one log-odds each), and their combination."""

    content: linear.Logistic
    metadata: linear.Logistic
    content_fit: linear.Logistic
    metadata_fit: linear.Logistic
    both: linear.Logistic

    def __call__(self, content: np.ndarray, metadata: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a = self.content_fit.logit(self.content.logit(content)[:, None])
        b = self.metadata_fit.logit(self.metadata.logit(metadata)[:, None])
        p = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return p(a), p(b), self.both(np.stack([a, b], axis=1))


#: From models of both views and the number of the round: for each view, content and metadata rows and their labels,
#: of documents that the view is sure of.
Teach = Callable[[list[linear.Logistic], int], list[tuple[np.ndarray, np.ndarray, np.ndarray]]]


def co_train(content: np.ndarray, metadata: np.ndarray, y: np.ndarray, teach: Teach, rounds: int = 5) -> Views:
    """Rounds of mutual teaching: what one view is sure of, the other one learns. A third of the labelled rows is kept
    for calibration."""
    keep = np.arange(len(y)) % 3 == 0
    x = [content[~keep], metadata[~keep]]
    target = [y[~keep], y[~keep]]
    models = [linear.fit(x[v], target[v]) for v in (0, 1)]
    for r in range(rounds):
        for v, (c, m, label) in enumerate(teach(models, r)):
            x[1 - v] = np.vstack([x[1 - v], (m, c)[v]])
            target[1 - v] = np.append(target[1 - v], label)
        models = [linear.fit(x[v], target[v]) for v in (0, 1)]
    z = [models[0].logit(content[keep])[:, None], models[1].logit(metadata[keep])[:, None]]
    fits = [linear.fit(z[v], y[keep]) for v in (0, 1)]
    return Views(*models, *fits, linear.fit(np.hstack([fits[v].logit(z[v])[:, None] for v in (0, 1)]), y[keep]))


def drawn(models: list[linear.Logistic], rows: np.ndarray, order: np.ndarray, sure: float, give: int) -> dict[tuple[int, int], np.ndarray]:
    """By view and label, the numbers of the rows (content, then metadata) that the view gives to the other one: of
    those that it is sure of, the ``give`` first in the given order."""
    out = {}
    for v, x in ((0, rows[:, :CONTENT]), (1, rows[:, CONTENT:])):
        p = models[v](x)
        for label, certainty in ((1, p), (0, 1 - p)):
            sure_of = np.flatnonzero(certainty >= sure)
            out[v, label] = sure_of[np.argsort(order[sure_of], kind="stable")[:give]]
    return out


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    have = lambda c, kind: (F.col(c) if c in docs.columns else F.lit(None)).cast(kind)
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), have("lang", "string").alias("lang"), have("source", "string").alias("source"), have("n_chars", "long").alias("n_chars"))


def _views_of(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    text = b.column("text")
    return content_view(text), metadata_view(text, *(b.column(c).to_pylist() for c in ("lang", "source", "n_chars")))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = 10_000, give: int = 500, sure: float = 0.95) -> Views:
    """The fitted views. Labels that repeat an id count once, by their smallest, and so do documents that repeat one;
    null labels don't count."""
    own = labels.where("quality is not null").groupBy(F.col(id_col).alias("id")).agg(F.min("quality").cast("int").alias("label"))
    n, start = own.count(), staging.mark()
    # A share of a million by a hash of the id; bounded by ``sample`` within its spread.
    of = F.pmod(F.xxhash64("id", F.lit("quality")), F.lit(1_000_000))
    chosen = own.where(of < 1_000_000 if n <= sample else of < int(1_000_000 * sample / n))
    rows = _rows(docs, id_col, text_col)
    seen = ["text", "lang", "source", "n_chars"]
    labelled = rows.join(F.broadcast(chosen), "id").groupBy("id", "label").agg(F.min(F.struct(*seen)).alias("d")).select("label", "d.*")

    def measured(b: pa.RecordBatch) -> pa.Array:
        x = np.hstack(_views_of(b)).astype(np.float32)
        return pa.array([r.tobytes() for r in x], pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in K.slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([measured(b), b.column("label")], names=["x", "label"])

    got = labelled.mapInArrow(run, "x binary, label int").toPandas()
    x, y = _matrix(got.x.tolist()), got.label.to_numpy(float)
    # The order in which rows arrive may differ between runs; the fit must not.
    order = np.lexsort(np.column_stack([x, y]).T[::-1])
    x, y = x[order], y[order]

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in K.slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([b.column("key"), measured(b)], names=["key", "x"])

    rest = rows.join(F.broadcast(chosen.select("id")), "id", "left_anti").withColumn("key", F.xxhash64("id", "text"))
    pool = staging.put(rest.select("key", *seen).mapInArrow(others, "key long, x binary"), "views")

    def teach(models: list[linear.Logistic], r: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best: dict[tuple[int, int], list[tuple[int, bytes]]] = {}
            for b in batches:
                data = b.column("x").to_pylist()
                place = K.mix(b.column("key").to_numpy().view(np.uint64) + np.uint64(r + 1))
                for k, at in drawn(models, _matrix(data), place, sure, give).items():
                    best[k] = sorted([*best.get(k, ()), *((int(place[i] >> np.uint64(1)), data[i]) for i in at)])[:give]
            for (v, label), found in best.items():
                yield pa.RecordBatch.from_arrays([pa.array([v] * len(found), pa.int32()), pa.array([label] * len(found), pa.int32()), pa.array([p for p, _ in found], pa.int64()), pa.array([d for _, d in found], pa.binary())], names=["view", "label", "place", "x"])

        # At most ``give`` rows of each task for each view and label, and then of all.
        first = Window.partitionBy("view", "label").orderBy("place", "x")
        found = pool.mapInArrow(pick, "view int, label int, place long, x binary").withColumn("n", F.row_number().over(first)).where(F.col("n") <= give).orderBy("view", "label", "n").collect()
        out = []
        for v in (0, 1):
            mine = [f for f in found if f.view == v]
            views = _matrix([bytes(f.x) for f in mine])
            out.append((views[:, :CONTENT], views[:, CONTENT:], np.array([f.label for f in mine], float)))
        return out

    views = co_train(x[:, :CONTENT], x[:, CONTENT:], y, teach)
    staging.drop_since(start)
    return views


def _matrix(rows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(rows), np.float32).reshape(len(rows), CONTENT + METADATA).astype(float)


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_from: float = 0.5, sample: int = 10_000, give: int = 500) -> DataFrame:
    """All columns of docs, with content_score, metadata_score, quality_score and quality_kept (score >= keep_from).

    Null and empty texts are scored by their other columns and as a text without words. Missing metadata columns
    count as null. Without labels, or with one class of them, every score is that class's smoothed share. Repeated
    rows keep a row each; equal rows have equal scores; an empty table gives none. Columns of docs named like the four
    added ones are replaced, all others are kept.
    """
    model = learn(docs, labels, id_col, text_col, sample, give)
    scores = ["content_score", "metadata_score", "quality_score"]
    plain = docs.drop(*scores, "quality_kept")
    names, seen = plain.columns, K.fresh([*plain.columns, *scores], "seen")
    have = lambda c, kind: (F.col(c) if c in names else F.lit(None)).cast(kind).alias(c)
    view = plain.withColumn(seen, F.struct(have("lang", "string"), have("source", "string"), have("n_chars", "long")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in K.slices(batches, text_col):
            text, own = b.column(text_col), b.select(names)
            content, metadata = content_view(text), metadata_view(text, *(b.column(seen).field(c).to_pylist() for c in ("lang", "source", "n_chars")))
            got = model(*(x.astype(np.float32).astype(float) for x in (content, metadata)))
            yield pa.RecordBatch.from_arrays([*own.columns, *(pa.array(np.round(g, 9), pa.float64()) for g in got)], names=[*own.schema.names, *scores])

    schema = T.StructType([*plain.schema.fields, *(T.StructField(c, T.DoubleType()) for c in scores)])
    out = view.mapInArrow(run, schema)
    return out.withColumn("quality_kept", F.col("quality_score") >= keep_from)
