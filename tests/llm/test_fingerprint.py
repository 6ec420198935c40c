import hashlib
import random

import numpy as np
import pyarrow as pa

from weftline.llm import fingerprint as fp


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")


def test_edited_text_is_the_next_documents_start(spark):
    rng = random.Random(1)
    rows = [(i * 3, "".join(rng.choice("abc dé\n漢") for _ in range(rng.randint(0, 400))), "x") for i in range(57)] + [(1000, None, "x"), (1001, "", None)]
    out = {r.doc_id: r for r in fp.edited_fingerprints(docs_of(spark, rows)).collect()}
    assert len(out) == len(rows)
    order = sorted(rows, reverse=True)
    for k, (i, text, _) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        edited = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        assert out[i].n_chars == len(text)
        assert out[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= out[i].near_edited <= 1 and 0 <= out[i].near_next <= 1


def test_empty_table_single_row_and_repeated_ids(spark):
    assert fp.edited_fingerprints(docs_of(spark, [])).collect() == []
    (one,) = fp.edited_fingerprints(docs_of(spark, [(5, "abcdef", None)])).collect()
    assert one.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest() and one.near_next == 1
    out = fp.edited_fingerprints(docs_of(spark, [(5, "bbbb", None), (5, "aaaa", None), (4, "cccc", None), (None, "dd", None)])).collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert sorted(r.edited_sha256 for r in out) == sorted([sha("bbcc"), sha("aacc"), sha("ccdd"), sha("da")])


def test_chunks_cover_texts_and_ignore_neighbours():
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(n)) for n in (0, 1, 15, 16, 17, 500, 20000)]
    raw, s, e, r = fp.cuts(pa.array(texts))
    for i, t in enumerate(texts):
        assert b"".join(raw[a:b].tobytes() for a, b in zip(s[r == i], e[r == i])) == t.encode()
    assert (e - s <= fp.MOST).all()
    together, alone = fp.chunk_sets(pa.array(texts)), [fp.chunk_sets(pa.array([t]))[0] for t in texts]
    assert all(np.array_equal(x, y) for x, y in zip(together, alone))


def test_containment_survives_a_shift():
    rng = random.Random(3)
    text = "".join(rng.choice("abcdefghijklmnop ") for _ in range(20000))
    x, y = fp.chunk_sets(pa.array([text, "some words before " + text]))
    assert fp.containment(x, y) > 0.98
    assert np.array_equal(fp.decoded(fp.encoded(x)), x)


def test_cuts_do_not_depend_on_segments(monkeypatch):
    rng = random.Random(4)
    texts = pa.array(["".join(rng.choice("abcdefgh é") for _ in range(rng.randint(0, 900))) for _ in range(40)])
    whole = fp.cuts(texts)
    plain = []
    for row, t in enumerate(texts.to_pylist()):  # the rule, byte by byte
        raw, at = t.encode(), 0
        while at < len(raw):
            end = at
            while end < len(raw):
                end += 1
                h = sum(int(fp._GEAR[raw[end - 1 - k]]) << k for k in range(min(16, end))) & 0xFFFFFFFF
                n = end - at
                if n == fp.MOST or (fp.LEAST <= n <= fp.NORMAL and not h & int(fp._HARD)) or (n > fp.NORMAL and not h & int(fp._EASY)):
                    break
            plain.append((row, at, end))
            at = end
    offset = np.cumsum([0, *(len(t.encode()) for t in texts.to_pylist())])
    assert [(r, s - offset[r], e - offset[r]) for s, e, r in zip(*whole[1:])] == plain
    monkeypatch.setattr(fp.K, "SEGMENT", 512)
    fp.K._powers.cache_clear()
    assert all(np.array_equal(x, y) for x, y in zip(whole, fp.cuts(texts)))
    fp.K._powers.cache_clear()


def test_an_id_that_repeats_often_and_a_long_text(spark):
    rows = [(7, f"text {i:05d} of one id", None) for i in range(3000)] + [(3, "x" * 3_000_000 + " end", None), (9, "last", None)]
    out = fp.edited_fingerprints(docs_of(spark, rows)).collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    edit = lambda t, n: sha(t[: len(t) - len(t) // 2] + n[: len(t) // 2])
    assert sorted(r.edited_sha256 for r in out) == sorted([*(edit(t, rows[3000][1]) for i, t, _ in rows if i == 7), edit(rows[3000][1], "last"), edit("last", rows[0][1])])
