import random

import numpy as np
import pyarrow as pa

from weftline.llm import linear, quality


def corpus(spark, n=400):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(n):
        good = i % 4 != 0
        words = [rng.choice("the of and to in is house river table green walks".split()) for _ in range(rng.randint(30, 90))]
        text = ". ".join(" ".join(words[k : k + 9]) for k in range(0, len(words), 9)) + "." if good else " ".join(w + "$$$" for w in words[:30])
        rows.append((i, text, "en", f"src{i % 5}", len(text), "x", True))
        if i % 2 == 0:
            labels.append((i, int(good), 0))
    rows += [(900, None, None, None, None, None, None), (901, "", "en", "src1", 0, "y", None), (901, "", "en", "src1", 0, "y", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, extra string, quality_kept boolean")
    return docs, spark.createDataFrame([*labels, (None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")


def test_scores_and_columns(spark):
    docs, labels = corpus(spark)
    out = quality.quality(docs, labels)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "extra", "content_score", "metadata_score", "quality_score", "quality_kept"]
    got = out.collect()
    assert len(got) == 403
    by = {r.doc_id: r for r in got if r.doc_id < 400}
    assert np.mean([by[i].quality_kept == (i % 4 != 0) for i in by]) > 0.99
    assert all(0 <= r.quality_score <= 1 for r in got)
    twins = [r.quality_score for r in got if r.doc_id == 901]
    assert twins[0] == twins[1]


def test_empty_tables_and_missing_metadata(spark):
    docs, labels = corpus(spark, 40)
    assert quality.quality(docs.where("false"), labels).collect() == []
    assert quality.quality(docs, labels.where("false")).count() == 43
    assert quality.quality(docs.select("doc_id", "text"), labels).count() == 43


def test_views_do_not_depend_on_neighbours():
    texts = ["one two two. THREE\n\nfour | 5", "", "é è ~~ ??", "a\n"]
    together = quality.content_view(pa.array(texts))
    assert together.shape == (4, quality.CONTENT)
    for i, t in enumerate(texts):
        assert np.allclose(quality.content_view(pa.array([t])), together[i])
    m = quality.metadata_view(pa.array(texts), ["en"] * 4, ["s"] * 4, [None] * 4)
    for i, t in enumerate(texts):
        assert np.allclose(quality.metadata_view(pa.array([t]), ["en"], ["s"], [None]), m[i])


def test_views_teach_each_other():
    rng = np.random.default_rng(1)
    truth = rng.integers(0, 2, 3000).astype(float)
    strong = truth[:, None] * 4 + rng.normal(size=(3000, 3))
    weak = truth[:, None] * 1.5 + rng.normal(size=(3000, 2))
    few = slice(0, 24)

    def teach(models, r):
        out = []
        for v, x in ((0, strong[24:]), (1, weak[24:])):
            p = models[v](x)
            mine = np.flatnonzero((np.maximum(p, 1 - p) >= 0.95) & (np.arange(len(p)) % 5 == r))
            out.append((strong[24:][mine], weak[24:][mine], (p[mine] > 0.5).astype(float)))
        return out

    views = quality.co_train(strong[few], weak[few], truth[few], teach)
    alone = linear.fit(weak[few], truth[few])
    right = lambda p: np.mean((p > 0.5) == truth[24:])
    assert right(views(strong[24:], weak[24:])[2]) > 0.95
    assert right(views.metadata(weak[24:])) >= right(alone(weak[24:]))


def test_pseudo_labels_are_those_of_plain_choice():
    rng = np.random.default_rng(2)
    rows = rng.normal(size=(500, quality.CONTENT + quality.METADATA))
    y = (rows[:, 0] > 0).astype(float)
    models = [linear.fit(rows[:, : quality.CONTENT], y), linear.fit(rows[:, quality.CONTENT :], y)]
    order = rng.permutation(500)
    got = quality.drawn(models, rows, order, 0.9, 20)
    for (v, label), at in got.items():
        p = models[v](rows[:, : quality.CONTENT] if v == 0 else rows[:, quality.CONTENT :])
        want = sorted((i for i in range(500) if (p[i] if label else 1 - p[i]) >= 0.9), key=lambda i: order[i])[:20]
        assert at.tolist() == want
    assert len(got[0, 1]) == 20


def test_columns_keep_their_values_and_a_repeated_id_is_one_sample(spark):
    docs, labels = corpus(spark, 60)
    own = {"extra": "seen", "lang": "_lang"}
    wide = docs.withColumnsRenamed(own).withColumn("_text", docs["text"]).withColumn("_source", docs["source"])
    out = quality.quality(wide.unionByName(wide.where("doc_id = 2")), labels)
    assert {"seen", "_lang", "_text", "_source"} <= set(out.columns)
    for r in out.collect():
        assert r._text == r.text and r._source == r.source and r.seen in ("x", "y", None) and r._lang in ("en", None)
    assert out.count() == docs.count() + 1
