"""Toxicity scores from a lexicon that catches misspellings and tells quotation from abuse.

The lexicon holds the words that labelled toxic documents have far more often than clean ones, counted by documents
after near copies are set aside, and stems (written ``stem*``) that say more than any one word with them. Its words are
a trie, and the trie's intersection with the Levenshtein automata of all words is one
automaton over the trie's nodes: a state holds the nodes that the letters so far reach, with the fewest edits. States
are made when a word first leads to them and kept, so words share the work of their common beginnings, and a word
ends where no node is left: none is followed beyond the longest term and its edits.

Each hit is scored by its term's weight, its edits against the term's length, and a window of words around it: words
that report someone's speech, quotation marks, and words that the labels tell apart make a context score, which splits
the hit between abuse and quotation. A logistic model over the summed hits gives the document's score.

The fit uses a bounded sample of labelled rows (``sample``), one row for each of its ids, chosen by a hash of the id.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import staging
from . import linear
from . import textkernel as K

WORD = re.compile(r"[^\W_]+")
GAP = re.compile(r"\s")
QUOTES = frozenset("\"“”„«»‹›")
#: Verbs that report someone's words, in the languages of the corpus: what is known of contexts before any label.
REPORTING = frozenset("said says wrote quoted quote called reported sagte schrieb zitat nannte dit écrit citation dijo escribió cita llamó".split())
#: Context scores of these and of quotation marks, and the score at which a hit is half a quotation.
REPORTED, MARKED, HALF = -5.0, -6.0, -3.0
WINDOW = 4
FEATURES = 7
#: Letters of a stem, longer ones first.
STEM = (8, 7, 6, 5, 4)
MARK = '"'


def allowed(length: int) -> int:
    """Edits that a term of this length may have: none below four letters, two from eight on."""
    return 0 if length < 4 else 1 if length < 8 else 2


class Automaton:
    """Finds the nearest term of a word: the fewest edits, then the largest weight, then the first."""

    def __init__(self, terms: dict[str, float], remember: int = 20_000):
        self.terms, self.weight, self.remember = list(terms), list(terms.values()), remember
        self.child: list[dict[str, int]] = [{}]
        self.term: list[int | None] = [None]
        self.most = [0]  # edits that some term below a node may have
        self.longest = max((len(t) + allowed(len(t)) for t in self.terms), default=0)
        for i, t in enumerate(self.terms):
            node, most = 0, allowed(len(t))
            self.most[0] = max(self.most[0], most)
            for letter in t:
                if letter not in self.child[node]:
                    self.child[node][letter] = len(self.child)
                    self.child.append({})
                    self.term.append(None)
                    self.most.append(0)
                node = self.child[node][letter]
                self.most[node] = max(self.most[node], most)
            self.term[node] = i
        self._reset()

    def _reset(self) -> None:
        self.states: dict[tuple, list] = {}
        self.begin = self._state({0: 0})

    def _state(self, reached: dict[int, int]) -> list | None:
        """[moves by letter, what is found if the word ends here, nodes with their edits] of the nodes reached."""
        queue = list(reached.items())
        for node, e in queue:  # letters of a term that the word leaves out
            for n in self.child[node].values():
                if e + 1 <= self.most[n] and e + 1 < reached.get(n, 99):
                    reached[n] = e + 1
                    queue.append((n, e + 1))
        if not reached:
            return None
        key = tuple(sorted(reached.items()))
        if (state := self.states.get(key)) is None:
            ends = [(e, -self.weight[i], i) for n, e in key if (i := self.term[n]) is not None and e <= allowed(len(self.terms[i]))]
            best = min(ends, default=None)
            state = self.states[key] = [{}, best and (best[2], best[0]), key]
        return state

    def _move(self, state: list, letter: str) -> list | None:
        reached: dict[int, int] = {}
        for node, e in state[2]:
            child = self.child[node]
            if (n := child.get(letter)) is not None and e <= self.most[n] and e < reached.get(n, 99):
                reached[n] = e
            if e < self.most[node] and e + 1 < reached.get(node, 99):  # a letter that the term has not
                reached[node] = e + 1
            for n in child.values():  # another letter than the term's
                if e < self.most[n] and e + 1 < reached.get(n, 99):
                    reached[n] = e + 1
        state[0][letter] = after = self._state(reached)
        return after

    def find(self, word: str) -> tuple[int, int] | None:
        """The number of the nearest term and its edits, or None."""
        if len(word) > self.longest:
            return None
        if len(self.states) > self.remember:
            self._reset()
        state = self.begin
        for letter in word:
            after = state[0].get(letter, 0)
            if after == 0:
                after = self._move(state, letter)
            if after is None:
                return None
            state = after
        return state[1]


class Lexicon(dict):
    """Word to (number of the nearest term, edits), or None; a stem counts without edits. Remembers words up to a bound."""

    def __init__(self, terms: dict[str, float], benign: frozenset[str] = frozenset(), remember: int = 500_000):
        super().__init__()
        words = {t: w for t, w in terms.items() if not t.endswith("*")}
        stems = {t[:-1]: w for t, w in terms.items() if t.endswith("*")}
        self.terms, self.weight = [*words, *stems], [*words.values(), *stems.values()]
        self.automaton, self.benign, self.remember = Automaton(words), benign, remember
        self.stems = {s: len(words) + i for i, s in enumerate(stems)}
        self.longest = max(self.automaton.longest, max(STEM) + 1)

    def __missing__(self, word: str) -> tuple[int, int] | None:
        found = self.automaton.find(word)
        if found and found[1] and word in self.benign:
            found = None
        if (not found or found[1]) and self.stems:
            found = next(((i, 0) for k in STEM if (i := self.stems.get(word[:k])) is not None), found)
        if len(word) <= self.longest:
            if len(self) >= self.remember:
                self.clear()
            self[word] = found
        return found


@dataclass(frozen=True)
class Hit:
    word: str
    term: int
    edits: int
    around: tuple[str, ...]
    marked: bool


def _pieces(text: str, most: int = 1 << 16) -> Iterator[tuple[int, int]]:
    """Stretches of about so many characters that end at white space."""
    at = 0
    while at < len(text):
        gap = GAP.search(text, at + most)
        end = gap.end() if gap else len(text)
        yield at, end
        at = end


def _last(text: str, at: int, end: int) -> list[re.Match]:
    """The last words of a stretch, as many as a window has."""
    reach = 256
    while True:
        found = [*WORD.finditer(text, max(at, end - reach), end)]
        if len(found) > WINDOW or end - reach <= at:  # the first one may have begun before
            return found[-WINDOW:]
        reach *= 8


def _folded(text: str, longest: int) -> Iterator[str]:
    """Words with symbols inside, without the symbols; those that may be in reach of a term."""
    for c in text.split():
        if not c.isalnum() and not c[:-1].isalnum() and len(parts := WORD.findall(c)) > 1 and sum(map(len, parts)) <= longest:
            yield "".join(parts)


def hits(low: str, lexicon: Lexicon) -> Iterator[Hit]:
    """Hits in a lower-case text. A word with symbols inside counts as a whole if none of its parts is a hit."""
    longest, before = lexicon.longest, []
    for at, end in _pieces(low):
        words = WORD.findall(low, at, end)
        if not any(map(lexicon.__getitem__, words)) and not any(map(lexicon.__getitem__, _folded(low[at:end], longest))):
            before = [*before, *_last(low, at, end)][-WINDOW:]
            continue
        found = [*WORD.finditer(low, at, end)]
        n = len(found)
        all_ = [*before, *found, *islice(WORD.finditer(low, end), WINDOW)]
        first = k = len(before)
        while k < first + n:
            j = k + 1
            while j < first + n and not GAP.search(low, all_[j - 1].end(), all_[j].start()):
                j += 1
            alone = [(i, i + 1, lexicon[all_[i].group()]) for i in range(k, j)]
            if j - k > 1 and not any(h for *_, h in alone) and sum(all_[i].end() - all_[i].start() for i in range(k, j)) <= longest:
                alone = [(k, j, lexicon["".join(all_[i].group() for i in range(k, j))])]
            for a, b, hit in alone:
                if hit:
                    left, right = all_[max(0, a - WINDOW) : a], all_[b : b + WINDOW]
                    s, e = all_[a].start(), all_[b - 1].end()
                    open_ = low[max(0, left[0].start() - 1) if left else max(0, s - 1) : s]
                    close = low[e : right[-1].end() + 1 if right else e + 1]
                    word = all_[a].group() if b == a + 1 else low[s:e]
                    yield Hit(word, *hit, tuple(m.group() for m in left + right), not QUOTES.isdisjoint(open_) and not QUOTES.isdisjoint(close))
            k = j
        before = all_[: first + n][-WINDOW:]


def features(low: str, lexicon: Lexicon, context: dict[str, float]) -> np.ndarray:
    """Of a lower-case text. Of abuse: summed weight, most, exact hits, near and far misspellings, hits per 100 words; hits in quotation."""
    out = np.zeros(FEATURES)
    for h in hits(low, lexicon):
        score = sum(context.get(w, 0.0) for w in h.around) + (context.get(MARK, MARKED) if h.marked else 0.0)
        abuse = 1 / (1 + math.exp(min(30.0, max(-30.0, HALF - score))))
        close = 1 - 2 * h.edits / len(lexicon.terms[h.term])
        weight = lexicon.weight[h.term] * close * abuse
        out[0] += weight
        out[1] = max(out[1], weight)
        out[2 if h.edits == 0 else 3 if close >= 0.6 else 4] += abuse
        out[6] += 1 - abuse
    if out.any():
        out[5] = 100 * out[2:5].sum() / max(1, sum(len(WORD.findall(low, a, z)) for a, z in _pieces(low)))
    return np.log1p(out)


@dataclass(frozen=True)
class Learned:
    """Terms with their weights, misspelled forms that clean texts use, scores of context words, and the model over features."""

    terms: dict[str, float]
    benign: frozenset[str]
    context: dict[str, float]
    model: linear.Logistic = field(repr=False)


def held_out(id_col: str) -> F.Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, most: int) -> DataFrame:
    """(id, text, label) of labelled ids that are not held out, about ``most`` of them by a hash; an id that repeats counts by its smallest text."""
    own = labels.where(~held_out(id_col)).where("toxic is not null").groupBy(F.col(id_col).alias("id")).agg(F.max("toxic").cast("int").alias("label"))
    n = own.count()
    if n > most:
        own = own.where(F.pmod(F.xxhash64(F.col("id"), F.lit("sample")), F.lit(1_000_000)) < int(1_000_000 * most / n))
    # Bounded by ``most`` (within the spread of a hash), so it may be broadcast.
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return texts.join(F.broadcast(own), "id").groupBy("id", "label").agg(F.min("text").alias("text"))


def _without_copies(rows: DataFrame) -> DataFrame:
    """The rows but for those that share a band of MinHash values with one of a smaller id: near copies of one text are one piece of evidence."""

    def bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in K.slices(batches, "text"):
            at, values = [], []
            for i, items in enumerate(K.sets_of(b.column("text"), 3)):
                if len(items):
                    pairs = K.signature(items, 16).astype(np.uint64)
                    at += [i] * 8
                    values.append(K.mix(pairs[0::2] << np.uint64(32) | pairs[1::2]) + np.arange(8, dtype=np.uint64))
            yield pa.RecordBatch.from_arrays([b.column("id").take(pa.array(at, pa.int64())), pa.array(np.concatenate(values).view(np.int64) if values else [], pa.int64())], names=["id", "band"])

    posted = staging.put(rows.select("id", "text").mapInArrow(bands, f"id {rows.schema['id'].dataType.simpleString()}, band long"), "bands")
    first = posted.groupBy("band").agg(F.min("id").alias("low"))
    return rows.join(posted.join(first, "band").where("id > low").select("id").distinct(), "id", "left_anti")


def _evidence(t: F.Column, c: F.Column, bad: int, clean: int) -> tuple[F.Column, F.Column]:
    """The likelihood-ratio statistic and the log ratio of shares, for counts among toxic and among clean documents."""
    rate = (t + c) / F.lit(max(1, bad + clean))
    part = lambda k, total: F.when(k > 0, k * F.log(k / (rate * max(1, total)))).otherwise(0.0)
    against = lambda k, total: F.when(F.lit(total) - k > 0, (F.lit(total) - k) * F.log((F.lit(total) - k) / F.greatest((1 - rate) * max(1, total), F.lit(1e-9)))).otherwise(0.0)
    g = 2 * (part(t, bad) + part(c, clean) + against(t, bad) + against(c, clean))
    return g, F.log((t + 0.5) / (bad + 1)) - F.log((c + 0.5) / (clean + 1))


def _counted(rows: DataFrame, of_text) -> DataFrame:
    """(word, t, c): the toxic and the clean documents that have each of the words that of_text finds in a lower-case text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = of_text()
        for b in K.slices(batches, "text"):
            words, labels = [], []
            for text, label in zip(b.column("text").to_pylist(), b.column("label").to_pylist()):
                own = find(text.lower())
                words += own
                labels += [int(label > 0)] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(labels, pa.int64())], names=["word", "label"])

    return rows.mapInArrow(run, "word string, label long").groupBy("word").agg(F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("c"))


def _chosen(found: dict[str, tuple[float, float]]) -> dict[str, float]:
    """Words and stems with their weights, those with most evidence first: none that another one, with more, includes
    or is included by. With equal evidence a word goes before a stem, and a longer stem before a shorter one."""
    out: dict[str, float] = {}
    covered: set[str] = set()  # the stems that some chosen entry has
    for t, (_, weight) in sorted(found.items(), key=lambda e: (-round(e[1][0], 6), e[0].endswith("*"), -len(e[0]), e[0])):
        stems = [f"{t[:k]}*" for k in STEM if len(t) > k]
        if t in covered or any(s in out for s in stems):
            continue
        out[t] = weight
        covered.update(stems)
    return out


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = 20_000, evidence: float = 24.0) -> Learned:
    """Everything that is learned, from the sample.

    A term needs ``evidence`` of the likelihood-ratio test for being commoner in toxic documents, so it stands in
    several of them; their number is bounded by the sample, not by a parameter, as is that of stems. A misspelled form is benign if two
    clean documents have it and toxic ones have it no more often. A context word needs the same evidence as a term, for
    one side or the other, among the documents with a hit.
    """
    start = staging.mark()
    rows = staging.put(_sample(docs, labels, id_col, text_col, sample), "labelled")
    own = staging.put(_without_copies(rows), "distinct")
    size = own.agg(F.count_if(F.col("label") > 0).alias("bad"), F.count("*").alias("n")).first()
    bad, clean = size.bad, size.n - size.bad
    t, c = F.col("t"), F.col("c")
    g, weight = _evidence(t, c, bad, clean)

    def entries(low: str) -> set[str]:
        words = {w for a, z in _pieces(low) for w in WORD.findall(low, a, z)}
        return words | {w[:k] + "*" for w in words for k in STEM if len(w) > k}

    found = _counted(own, lambda: entries).select("word", g.alias("g"), weight.alias("weight")).where((F.col("g") >= evidence) & (F.col("weight") >= 2))
    terms = _chosen({r.word: (r.g, float(r.weight)) for r in found.collect()})

    def near() -> object:
        lexicon = Lexicon(terms)
        return lambda low: {("~" if h.edits else "=") + w for h in hits(low, lexicon) for w in ((h.word,) if h.edits else (MARK, *h.around) if h.marked else ("", *h.around))}

    seen = staging.put(_counted(own, near), "near")
    benign = frozenset(r.word[1:] for r in seen.where(F.col("word").startswith("~") & (c >= 2) & ((c + 0.5) / (clean + 1) >= (t + 0.5) / (bad + 1))).collect())
    # Documents with an exact hit, by their marked and unmarked ones; a document with both counts for both.
    around = seen.where(F.col("word").startswith("="))
    total = around.agg(F.max("t").alias("t"), F.max("c").alias("c")).first()
    g, weight = _evidence(t, c, total.t or 0, total.c or 0)
    told = around.where("word NOT IN ('=')").select("word", weight.alias("weight"), g.alias("g")).where(F.col("g") >= evidence)
    context = dict.fromkeys(REPORTING, REPORTED) | {MARK: MARKED} | ({r.word[1:]: float(r.weight) for r in told.collect()} if total.t and total.c else {})

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(terms, benign)
        for b in K.slices(batches, "text"):
            x = [features(text.lower(), lexicon, context).tolist() for text in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), b.column("label").cast(pa.int32())], names=["x", "label"])

    # About ``sample`` rows of seven numbers, in an order that does not depend on how they arrive.
    fitted = rows.mapInArrow(measured, "x array<double>, label int").toPandas()
    x, y = np.array(fitted.x.tolist(), float).reshape(len(fitted), FEATURES), (fitted.label.to_numpy() > 0).astype(float)
    order = np.lexsort(np.column_stack([x, y]).T[::-1])
    staging.drop_since(start)
    return Learned(terms, benign, context, linear.fit(x[order], y[order]))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = 20_000) -> DataFrame:
    """(id, held_out, score, predicted) of every row; only its text counts for the score.

    Null and empty texts get the score of a text without hits. Without labels, or with one class of them, all rows
    get that class's smoothed share. Repeated rows keep a row each; an empty table gives none; a null id is held out
    never (its checksum is null: false). Ties between terms go to the heavier, then to the one with more evidence. Other
    columns are ignored. Memory follows the longest text; a word of any length costs no more than the longest term.
    """
    got = learn(docs, labels, id_col, text_col, sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(got.terms, got.benign)
        for b in K.slices(batches, "text"):
            x = np.array([features((t or "").lower(), lexicon, got.context) for t in b.column("text").to_pylist()]).reshape(-1, FEATURES)
            p = got.model(x)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("held_out"), pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32), pa.int32())], names=["id", "held_out", "score", "predicted"])

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(held_out(id_col), F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, held_out boolean, score double, predicted int")
