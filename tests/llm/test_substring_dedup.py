import random

import numpy as np
import pyarrow as pa

from weftline.llm import substring_dedup as S

SCHEMA = "doc_id long, text string, source string, id string, n_chars long"


def corpus(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 8)))
    prose = lambda n: " ".join(word() + ("\n" if rng.random() < 0.05 else "") for _ in range(n))
    passages = [prose(n) for n in (51, 60, 120)]
    rows, planted = [], {}
    for i in range(120):
        text = prose(rng.randint(40, 300))
        if i % 3 == 0:
            k = i // 3 % 3
            at = text.split(" ")
            cut = rng.randint(0, len(at))
            text = " ".join([*at[:cut], passages[k], *at[cut:]])
            planted.setdefault(k, []).append(i)
        rows.append((i, text, "s", "x", len(text)))
    rows += [(200, rows[7][1], "s", "x", rows[7][4]), (201, None, "s", "x", None), (202, "", None, None, 0), (None, rows[8][1], "s", None, 1), (203, "two words", "s", "x", 9), (203, "two words", "s", "x", 9)]
    return spark.createDataFrame(rows, SCHEMA), planted, rows


def test_planted_passages_are_found_and_others_left_alone(spark):
    docs, planted, rows = corpus(spark)
    got = S.repeated_passages(docs).collect()
    want = {i for ids in planted.values() for i in ids[1:]} | {200}
    assert {r.id for r in got} == want
    for ids in planted.values():
        # A paragraph at a passage's end takes words from around it, which two later documents may share.
        kept = {r.kept_id for r in got if r.id in ids}
        assert ids[0] in kept and kept <= set(ids)
    text = {r[0]: r[1] for r in rows}
    for r in got:
        part, kept = (text[k].encode() for k in (r.id, r.kept_id))
        assert sum(w in kept.decode().split() for w in part[r.start : r.start + r.size].decode().split()) >= 0.8 * r.words


def test_cutting(spark):
    docs, planted, rows = corpus(spark)
    passages = S.repeated_passages(docs)
    out = {(r.doc_id, r.text): r for r in S.without_passages(docs, passages).collect()}
    ids = {i for i, _ in out}
    assert 200 not in ids and {201, 202, 203, None} <= ids and set(range(120)) <= ids
    text = {r[0]: r[1] for r in rows}
    for (i, t), r in out.items():
        if i in {x for v in planted.values() for x in v[1:]}:
            assert len(t) < len(text[i]) and r.n_chars == len(t)
        elif i is not None and t is not None:
            assert t == text[i]


def test_near_paragraphs_are_linked(spark):
    rng = random.Random(10)
    w = ["".join(rng.choice("abcdefghijkl") for _ in range(5)) for _ in range(400)]
    rows = [(1, " ".join(w), "s", "", 0), (2, " ".join([*w[:100], "changed", *w[101:]]), "s", "", 0)]
    got = S.repeated_passages(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.id for r in got} == {2} and sum(r.words for r in got) > 350


def test_paragraphs_do_not_depend_on_neighbours():
    rng = random.Random(11)
    texts = [" ".join(rng.choice("abcdefgh") + rng.choice("xyz") for _ in range(n)) for n in (0, 1, 3, 4, 5, 30, 300)]
    both = S.Paragraphs(pa.array(texts), 2)
    for i, t in enumerate(texts):
        one = S.Paragraphs(pa.array([t]), 2)
        mine = both.row == i
        assert one.sets().to_pylist() == [s for s, m in zip(both.sets().to_pylist(), mine) if m] and np.array_equal(one.at_word, both.at_word[mine]) and np.array_equal(one.keys[1], both.keys[1][mine])
        assert one.words.sum() == len(t.split())


def test_bands_and_empty_table(spark):
    assert S.bands_for(0.95, 0.8) == 2 and S.bands_for(0.999, 0.8) == 5
    docs, _, _ = corpus(spark)
    assert S.repeated_passages(docs.where("false")).collect() == []


def shingles(words):
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def test_near_copied_passages_of_51_to_75_words_are_found(spark):
    rng = random.Random(12)
    prose = lambda n: ["".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(n)]
    rows, want = [], {}
    for k in range(300):
        n = 51 + k % 25
        one = prose(n)
        at = rng.randint(n // 3, 2 * n // 3)
        two = [*one[:at], *prose(1), *one[at + 1 :]]
        a, b = shingles(one), shingles(two)
        if len(a & b) >= 0.8 * len(a | b):
            want[2 * k + 1] = set(two)
        rows += [(2 * k, " ".join([*prose(40), *one, *prose(40)]), "s", "", 0), (2 * k + 1, " ".join([*prose(40), *two, *prose(40)]), "s", "", 0)]
    got = S.repeated_passages(spark.createDataFrame(rows, SCHEMA)).collect()
    text = {r[0]: r[1] for r in rows}
    part = {}
    for r in got:
        words = text[r.id].encode()[r.start : r.start + r.size].decode().split()
        assert len(words) == r.words and r.kept_id == r.id - 1 and r.id in want
        part.setdefault(r.id, set()).update(words)
    whole = [i for i in want if len(want[i] & part.get(i, set())) >= 0.95 * len(want[i])]
    assert len(want) == 300 and len(whole) >= 0.95 * len(want)


def test_similar_classes_under_one_band_value_share_a_component(spark):
    rng = random.Random(13)
    rows, sets = [], {}
    for key in range(60):
        bases = [[rng.randrange(1 << 32) for _ in range(rng.randint(5, 14))] for _ in range(4)]
        for k in range(16):
            base = bases[k % 4]
            items = sorted({key, *base, *(rng.randrange(1 << 32) for _ in range(rng.randint(0, 1)))} - {rng.choice(base) for _ in range(rng.randint(0, 1))})
            kind = rng.randrange(-(1 << 63), 1 << 63)
            sets[kind] = (key, set(items))
            rows.append((key, kind, bytearray(np.array(items, np.uint32).tobytes())))
    classes = spark.createDataFrame([r[:2] for r in rows], "key long, kind long")
    items = spark.createDataFrame([r[1:] for r in rows], "kind long, items binary")
    got = {r.node: r.component for r in S._clusters(classes, items, 0.8).collect()}
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (ka, xa) in sets.items():
        for b, (kb, xb) in sets.items():
            if a < b and ka == kb and 5 * len(xa & xb) >= 4 * len(xa | xb):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    assert {k: got.get(k, k) for k in sets} == {k: find(k) for k in sets}
    assert len({find(k) for k in sets}) < len(sets) - 200


def test_rows_that_repeat_an_id_have_their_own_spans(spark):
    rng = random.Random(15)
    prose = lambda n: " ".join("".join(rng.choice("abcdefghéüñ") for _ in range(6)) for _ in range(n))
    shared, other = prose(60), prose(60)
    rows = [(1, f"{prose(30)} {shared} {prose(20)}"), (1, f"{prose(44)} {other}"), (2, f"{prose(9)} {shared} {prose(50)}"), (2, f"{prose(70)} {other} {prose(5)}"), (2, prose(90)), (2, f"{prose(9)} {shared}")]
    rows.append(rows[2])
    docs = spark.createDataFrame([(i, t, "a", i, t) for i, t in rows], "doc_id long, text string, spans string, id long, digest string")
    got = S.repeated_passages(docs)
    out = S.without_passages(docs, got)
    assert out.columns == docs.columns
    left = sorted((r.digest, r.text) for r in out.collect() if r.text != r.digest)
    assert sorted({t for t, _ in left}) == sorted({rows[2][1], rows[3][1], rows[5][1]}) and len(left) == 4
    for before, after in left:
        assert set(after.split()) <= set(before.split()) and 55 <= len(before.split()) - len(after.split()) <= 62


def plain_aligned(x, y, most):
    """Where stretches of equal words end, over at most so many changed places."""
    i = j = 0
    ends = []
    while True:
        while i < len(x) and j < len(y) and x[i] == y[j]:
            i, j = i + 1, j + 1
        ends.append((i, j))
        if i == len(x) or j == len(y) or len(ends) > most:
            return ends
        met = [(d + e, d, e) for d in range(S.CHANGED + 1) for e in range(S.CHANGED + 1) if len(x[i + d : i + d + 3]) == 3 and x[i + d : i + d + 3] == y[j + e : j + e + 3]]
        if not met:
            return ends
        i, j = i + min(met)[1], j + min(met)[2]


def test_alignment_equals_the_plain_one():
    rng = random.Random(16)
    xs, ys = [], []
    for _ in range(400):
        x = [rng.randrange(2, 2 + rng.choice([3, 1000])) for _ in range(rng.randint(0, S.CONTEXT))]
        y = list(x)
        for _ in range(rng.randint(0, 4)):
            at = rng.randint(0, len(y))
            y[at : at + rng.randint(0, 5)] = [rng.randrange(2, 1000) for _ in range(rng.randint(0, 5))]
        xs.append(x)
        ys.append(y[: S.CONTEXT])
    pad = lambda rows, v: S._padded(pa.array([np.array(r, np.uint32).tobytes() for r in rows], pa.binary()), v)
    (x, nx), (y, ny) = pad(xs, -1), pad(ys, -2)
    a, b, _, n = S.aligned(x, nx, y, ny, 3)
    for k in range(len(xs)):
        assert [(int(a[k, i]), int(b[k, i])) for i in range(n[k])] == plain_aligned(xs[k], ys[k], 3)


def test_jaccard_of_sequences_equals_that_of_sets():
    rng = random.Random(17)
    for _ in range(300):
        x = [rng.randrange(5) for _ in range(rng.randint(1, 40))]
        y = list(x)
        y[rng.randrange(len(y))] = 9
        u, v = ({tuple(s[i : i + 5]) for i in range(max(1, len(s) - 4))} for s in (x, y))
        assert S.similar(np.array(x, np.uint32), np.array(y, np.uint32), 0.8) == (5 * len(u & v) >= 4 * len(u | v))


def test_passages_that_many_documents_share(spark):
    """One passage in a third of all documents, kept once; texts around it stay."""
    rng = random.Random(18)
    prose = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    passage = prose(64)
    rows = [(i, f"{prose(30)} {passage} {prose(30)}" if i % 3 == 0 else prose(80), "s", "", 0) for i in range(600)]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = {r.doc_id: r.text for r in S.without_passages(docs, S.repeated_passages(docs)).collect()}
    for i, text, *_ in rows:
        words = len(out[i].split())
        assert out[i] == text if i % 3 or i == 0 else 58 <= words <= 64
