import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from weftline.llm import mixing


def corpus(spark, n=2000):
    rng = random.Random(8)
    rows = [(i, "w " * rng.randint(1, 40), rng.choice(["hot"] * 8 + ["a", "b", None]), "x", 5) for i in range(n)]
    rows += [(n, None, "a", None, None), (n + 1, "", "b", None, 1), (n + 2, "same", "hot", None, 1), (n + 2, "same", "hot", None, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, cut_doc string, mix_epoch int")


def reference(shares, repeats):
    """The smallest exponent that keeps within the limit, by plain bisection."""
    low, high = 0.0, 1.0
    for _ in range(60):
        a = (low + high) / 2
        r = [s ** (a - 1) for s in shares]
        low, high = (low, a) if max(r) / min(r) <= repeats else (a, high)
    return high


def test_weights_repeats_and_budget(spark):
    docs = corpus(spark)
    out = mixing.mix(docs, repeats=2.5).withColumn("tokens", mixing.words_of("text")).cache()
    assert out.columns[:5] == ["doc_id", "text", "source", "cut_doc", "mix_epoch"]
    tokens = {r.s: r.t for r in docs.groupBy(F.coalesce("source", F.lit("")).alias("s")).agg(F.sum(mixing.words_of("text")).alias("t")).collect()}
    whole = sum(tokens.values())
    a = reference([t / whole for t in tokens.values()], 2.5)
    z = sum((t / whole) ** a for t in tokens.values())
    got = {r.s: r for r in out.groupBy(F.coalesce("source", F.lit("")).alias("s")).agg(F.sum("tokens").alias("t"), F.max("mix_weight").alias("w")).collect()}
    total = sum(r.t for r in got.values())
    for s, t in tokens.items():
        weight = (t / whole) ** a / z
        assert got[s].w == pytest.approx(weight, abs=1e-6)
        assert got[s].t / total == pytest.approx(weight, abs=0.005)
    copies = Counter(r.doc_id for r in out.select("doc_id").collect())
    assert set(range(2000)) <= set(copies)  # at the least budget every document stays
    assert 1 <= min(copies.values()) and max(v for k, v in copies.items() if k != 2002) <= 3
    by_source = {}
    for r in docs.where("doc_id < 2000").collect():
        by_source.setdefault(r.source, set()).add(copies[r.doc_id])
    assert all(max(v) - min(v) <= 1 for v in by_source.values())
    assert got["hot"].t == tokens["hot"]


def test_entropy_target(spark):
    docs = corpus(spark)
    target = 1.3
    w = [r.w for r in mixing.mix(docs, entropy=target, repeats=None).groupBy("source").agg(F.max("mix_weight").alias("w")).collect()]
    assert -sum(x * math.log(x) for x in w) == pytest.approx(target, abs=1e-4)


def test_small_budget_cuts_each_source_to_its_weight(spark):
    docs = corpus(spark)
    out = mixing.mix(docs, repeats=2.0, budget=5000).withColumn("tokens", mixing.words_of("text"))
    got = {r.source: r for r in out.groupBy("source").agg(F.sum("tokens").alias("t"), F.max("mix_weight").alias("w")).collect()}
    for r in got.values():
        assert r.w * 5000 <= r.t + 1 and r.t <= r.w * 5000 + 45


def test_positions_mix_evenly_and_repeat(spark):
    docs = corpus(spark)
    out = mixing.mix(docs, repeats=2.0).select("doc_id", "source", "mix_position").cache()
    assert out.where("mix_position < 0 or mix_position >= 1").count() == 0
    half = {r.source: r.n for r in out.where("mix_position < 0.5").groupBy("source").agg(F.count("*").alias("n")).collect()}
    full = {r.source: r.n for r in out.groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert all(abs(half[s] / full[s] - 0.5) < 0.1 for s in full)
    again = mixing.mix(docs, repeats=2.0).select("doc_id", "source", "mix_position")
    assert sorted(map(str, out.collect())) == sorted(map(str, again.collect()))


def test_empty_and_single_source(spark):
    docs = corpus(spark)
    assert mixing.mix(docs.where("false")).collect() == []
    assert mixing.mix(docs.where("source = 'a'")).count() == docs.where("source = 'a'").count()


def test_inner_columns_leave_those_of_the_documents_alone(spark):
    names = ["of", "doc", "block", "epochs", "repeats", "cut_block", "cut_doc", "copies", "_of"]
    rows = [(i, f"word {i} " * (1 + i % 4), f"s{i % 3}", *[f"{n}{i}" for n in names]) for i in range(60)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", "source", *names])
    out = mixing.mix(docs, repeats=1.5)
    assert out.columns[: len(docs.columns)] == docs.columns
    got = out.collect()
    assert {r.doc_id for r in got} == set(range(60)) and all(r[n] == f"{n}{r.doc_id}" for r in got for n in names)
