import hashlib
import random

import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_stages_work_on_what_is_left(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        if name == "encoding":
            break
        assert out.columns == columns
        out = spark.createDataFrame(out.collect(), docs.schema)
        now = {r.doc_id for r in out.select("doc_id").collect()}
        assert now <= ids
        if name == "quality":
            assert not [i for i in ids - now if labels.get(i) == 1]
        if name == "mixing":
            assert now == ids
        docs, ids = out, now
    texts = sorted(hashlib.sha256((r.text or "").encode()).hexdigest() for r in docs.collect())
    assert sorted(r.decoded_sha256 for r in out.collect()) == texts


def test_run(spark):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 100


def test_near_dedup_stage_equals_brute_force_on_five_words(spark):
    rng = random.Random(14)
    prose = lambda n: ["".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(n)]
    texts = []
    for k in range(30):
        one, two = prose(100), prose(200)
        texts += [one, [*one, *prose(15 + k % 15)]]
        changed = list(two)
        for at in range(20, 20 + 40 * (3 + k % 3), 40):
            changed[at] = prose(1)[0]
        texts += [two, changed]
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in texts]
    want = {i for i in range(len(texts)) if not any(5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) for j in range(i))}
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id for r in corpus_pipeline.near_dedup_stage(spark, docs, "").collect()}
    assert got == want and 60 < len(want) < 120


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n))


def odd_rows():
    """Nulls in any column, empty and long texts, repeated rows, ids with several texts, and columns with clashing names."""
    rng = random.Random(21)
    shared = prose(rng, 70)
    rows = [(1, prose(rng, 60)), (2, prose(rng, 80)), (2, prose(rng, 90)), (None, prose(rng, 50)), (4, None), (5, ""), (6, " \n"), (7, f"{prose(rng, 30)} {shared} {prose(rng, 30)}")]
    rows += [(7, f"{shared} {prose(rng, 60)}"), (8, f"{prose(rng, 50)} {shared}"), (9, prose(rng, 30_000)), (10, "é" * 50_000)]
    rows += [(3, rows[1][1]), (2, rows[1][1]), (None, rows[3][1]), (11, rows[2][1])]
    columns = ["of", "digest", "id", "spans", "quality_score", "mix_epoch", "seen"]
    return [(i, t, None if n % 5 == 0 else "en", None if n % 4 == 0 else f"s{n % 3}", None if n % 6 == 0 else len(t or ""), *[f"{c}{n}" for c in columns]) for n, (i, t) in enumerate(rows)], columns


def test_stages_on_odd_rows(spark):
    rows, extra = odd_rows()
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in extra)
    docs = spark.createDataFrame(rows, schema)
    stage = dict(corpus_pipeline.STAGES)
    out = stage["quality"](spark, docs, SF)
    assert out.columns == docs.columns and {tuple(r) for r in out.collect()} <= {tuple(r) for r in docs.collect()}
    out = stage["near_dedup"](spark, docs, SF)
    assert out.columns == docs.columns
    left = [tuple(r) for r in out.collect()]
    # Row 1 under its smallest id, once; row 2's other text; the null id's text once; texts without words all.
    text = [r[1] for r in rows]
    assert sorted((i or 0, t or "") for i, t, *_ in left) == sorted([(1, text[0]), (2, text[1]), (2, text[2]), (0, text[3]), (4, ""), (5, ""), (6, text[6]), (7, text[7]), (7, text[8]), (8, text[9]), (9, text[10]), (10, text[11])])
    assert set(left) <= {tuple(r) for r in docs.collect()}
    cut = stage["substring_dedup"](spark, out, SF)
    assert cut.columns == docs.columns
    after = {(r.doc_id, r.digest): r for r in cut.collect()}
    before = {(r[0], r[6]): r for r in left}
    assert set(after) == set(before)
    assert {k for k in before if before[k][1] != after[k].text} == {k for k in before if k[0] == 8}
    mixed = stage["mixing"](spark, out, SF)
    assert mixed.columns == docs.columns and {tuple(r) for r in mixed.collect()} == set(left)
    coded = stage["encoding"](spark, docs, SF).collect()
    assert sorted(r.decoded_sha256 for r in coded) == sorted(hashlib.sha256((t or "").encode()).hexdigest() for t in text)


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).collect() == []
