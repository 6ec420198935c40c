"""The micro-fixtures of FIXTURES.md: small inputs with results worked out by hand from the rules."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from weftline.functions import scalars as X
from weftline.operators import analysis as A
from weftline.operators import merge as M
from weftline.operators import metagraph as G
from weftline.operators import resolve as R
from weftline.operators import validate as V
from weftline.sources import spec


def node(phase, i, ids, name=None, rank=0, categories=("C",), synonyms=None):
    return {"id": i, "name": name, "categories": list(categories), "provided_by": ["s"], "synonyms": synonyms, "equivalent_ids": list(ids), "description": None, "phase": phase, "source_rank": rank, "ordinal": i}


def folded(*nodes):
    return R.fold_component(pd.DataFrame(nodes))


def test_m1_dominance():
    f = folded(node(0, "a1", ["a1", "a2"], "Alpha"), node(1, "b1", ["b1", "a2", "b3"], "Beta"))
    (n,) = f.canonical.values()
    assert (n["id"], n["name"], n["equivalent_ids"]) == ("b1", "Beta", ["a1", "a2", "b1", "b3"])
    assert set(f.index.values()) == {"b1"}


def test_m2_tie_keeps_the_first():
    (n,) = folded(node(0, "a1", ["a1", "a2"]), node(1, "b1", ["b1", "a2"])).canonical.values()
    assert (n["id"], n["equivalent_ids"]) == ("a1", ["a1", "a2", "b1"])


def test_m3_one_to_many_and_accumulated_size():
    (n,) = folded(node(0, "a1", ["a1", "a2"]), node(0, "c1", ["c1"]), node(1, "n1", ["n1", "a1", "a2", "c1"])).canonical.values()
    assert (n["id"], n["equivalent_ids"]) == ("n1", ["a1", "a2", "c1", "n1"])
    (n,) = folded(node(0, "a1", ["a1", "a2"]), node(0, "c1", ["c1", "c2", "c3", "c4", "c5"]), node(1, "n1", ["n1", "a1", "a2", "c1"])).canonical.values()
    assert n["id"] == "c1" and len(n["equivalent_ids"]) == 8


def test_m4_vote_without_merging():
    primary = [node(0, "a1", ["a1", "a2"], synonyms=["p"]), node(0, "c1", ["c1", "c2", "c3"])]
    f = folded(*primary, node(2, "a1", ["a1", "c1", "c2", "x"], synonyms=["q"]))
    assert f.canonical["a1"]["equivalent_ids"] == ["a1", "a2", "x"] and f.canonical["a1"]["synonyms"] == ["p"]
    assert f.canonical["c1"]["equivalent_ids"] == ["c1", "c2", "c3"]
    f = folded(*primary, node(2, "a1", ["a1", "c1"], synonyms=["q"]))
    assert f.canonical["a1"]["equivalent_ids"] == ["a1", "a2"] and f.canonical["a1"]["synonyms"] == ["p", "q"]


def test_m5_the_outvoted_stays():
    y = [f"y{i}" for i in range(11)]
    f = folded(node(0, "x0", ["x0", "x1"]), node(0, "y0", y), node(2, "x0", ["x0", *y]))
    assert set(f.canonical) == {"x0", "y0"}


def test_m6_edge_key(spark):
    df = spark.sql("SELECT 'A:1' subject, 'biolink:affects' predicate, 'B:2' object, map('object_direction_qualifier','increased','object_aspect_qualifier','activity') qualifiers, 'infores:x' primary_knowledge_source UNION ALL SELECT 'A:1','biolink:affects','B:2', NULL, 'infores:x'")
    got = {r.k for r in df.select(X.edge_key().alias("k")).collect()}
    assert got == {"A:1---biolink:affects---B:2---object_aspect_qualifier:activity__object_direction_qualifier:increased---infores:x", "A:1---biolink:affects---B:2---|---infores:x"}


EDGE = "subject string, object string, predicate string, qualifiers map<string,string>, primary_knowledge_source string, aggregator_knowledge_source array<string>, supporting_data_sources array<string>, knowledge_level string, agent_type string, publications array<string>, publications_info string, attributes map<string,map<string,string>>, source_rank int, ordinal string"


def test_m7_edge_merge(spark):
    e1 = ("a", "b", "p", {"q": "1"}, "s", ["k1"], None, "not_provided", "manual_agent", ["p1"], None, {"k1": {"score": "1"}}, 0, "1")
    e2 = ("a", "b", "p", {"q": "1"}, "s", ["k2"], None, "prediction", "text_mining_agent", ["p1", "p2"], None, {"k1": {"score": "1", "x": '"y"'}}, 1, "1")
    (r,) = M.merge_edges(spark.createDataFrame([e1, e2], EDGE)).collect()
    assert (r.knowledge_level, r.agent_type, r.aggregator_knowledge_source, r.publications, r.supporting_data_sources) == ("prediction", "manual_agent", ["k1", "k2"], ["p1", "p2"], None)
    assert r.attributes == {"k1": {"score": "[1]", "x": '["y"]'}} and r.merged_rows == 2
    assert M.merge_edges(spark.createDataFrame([], EDGE)).collect() == []


def test_m8_both_ends_or_neither(spark):
    index = spark.createDataFrame([("a1", "A"), ("b1", "B")], "equiv_id string, canonical_id string")
    edges = spark.createDataFrame([("a1", "b1"), ("a1", "zz")], "subject string, object string")
    assert {tuple(r) for r in M.canonical_endpoints(edges, index).collect()} == {("A", "B"), ("a1", "zz")}


def test_m9_m10_m14_strings(spark):
    one = spark.range(1)
    assert one.select(X.clean_text(F.lit("  Tom &amp;\n Jerry  é ")).alias("x")).first().x == "Tom & Jerry é"
    values = spark.createDataFrame([("N/A",), ("-",), ("",), ("none ",), (None,), ("0",)], "v string")
    assert [r.x for r in values.select(X.is_empty_string("v").alias("x")).collect()] == [True, True, True, True, True, False]
    fixed = spark.createDataFrame([("biolink:biolink:related_to",), ("a:b:c:d",), ("A::1",), ("A:1:2",)], "v string").select(X.single_prefix("v").alias("f"), X.curie_parts("v").alias("p")).collect()
    assert [fixed[0].f, fixed[1].f] == ["biolink:related_to", "a:d"]
    assert tuple(fixed[2].p) == ("A", "1") and fixed[3].p is None


def test_m11_leaves(spark):
    closure = spark.createDataFrame([("C", "B"), ("C", "A"), ("B", "A"), ("A", "A")], "category string, ancestor string")
    rows = spark.createDataFrame([("x", ["A", "C"]), ("y", ["B", "D"])], "id string, categories array<string>")
    assert {r.id: r.categories for r in R.leaf_categories(rows, closure).collect()} == {"x": ["C"], "y": ["B", "D"]}


def test_m12_exclusion(spark):
    rows = spark.createDataFrame([(1, ["u"]), (2, ["u", "v"]), (3, None)], "i int, p array<string>")
    kept = lambda s: [r.i for r in rows.where(~spec.excluded(F.col("p"), s)).collect()]
    assert kept(spec.SourceSpec("t", excluded_primaries=("u",))) == [2]
    assert kept(spec.SourceSpec("t", excluded_primaries=("u",), missing_is_excluded=False)) == [2, 3]
    assert kept(spec.SourceSpec("t")) == [1, 2, 3]


SOURCES = "subject string, object string, predicate string, sources array<struct<resource_id:string,resource_role:string>>"


def test_m13_roled_sources(spark):
    role = lambda x: f"{x}_knowledge_source" if x != "supporting" else "supporting_data_source"
    good = [("p", role("primary")), ("q", role("aggregator")), ("s", role("supporting")), ("t", "unknown")]
    s = spec.SourceSpec("me")
    (r,) = spec.edges(s, spark.createDataFrame([("a", "b", "x", good)], SOURCES)).collect()
    assert (r.primary_knowledge_source, sorted(r.aggregator_knowledge_source), r.supporting_data_sources) == ("p", ["infores:me", "q"], ["s"])
    for bad in ([("p", role("primary")), ("r", role("primary"))], [("q", role("aggregator"))]):
        with pytest.raises(Exception, match="primary sources"):
            spec.edges(s, spark.createDataFrame([("a", "b", "x", bad)], SOURCES)).collect()


def test_m15_metagraph(spark):
    nodes = spark.createDataFrame([("n1", ["Gene", "Protein"]), ("n2", ["Disease"])], "id string, categories array<string>")
    edges = spark.createDataFrame([("n1", "p", "n2"), ("n1", "p", "zz")], "subject string, predicate string, object string")
    got = {(r.subject_category, r.object_category): r.edge_count for r in G.meta_doubles(edges, nodes).collect()}
    assert got == {("Gene", "Disease"): 1, ("Protein", "Disease"): 1}


def test_m16_handoff(spark):
    touch = spark.createDataFrame([("n", "s1", 2), ("n", "s2", 3)], "node string, source string, n long")
    fam = spark.createDataFrame([("n", "f"), ("n", "g")], "node string, family string")
    got = {r.family: (r.volume, r.nodes) for r in A.handoff_pairs(touch, fam).collect()}
    assert got == {"f": (3.0, 0.5), "g": (3.0, 0.5)}


@pytest.mark.parametrize("width", [1, 5, 1000])
def test_m17_range_join(spark, width):
    genes = spark.createDataFrame([("c", 10, 20, "g")], "contig string, start long, end long, gene string")
    points = spark.createDataFrame([("c", p) for p in (9, 10, 20, 21)] + [("d", 15)], "contig string, at long")
    assert sorted(r.at for r in A.range_join(points, genes, "contig", "at", "start", "end", width).collect()) == [10, 20]


def test_m18_gate_m19_variance(spark):
    rows = spark.createDataFrame([("t", "p1", 7), ("t", "p2", 7), ("t", "p3", 4)], "trait string, p string, n int").where("n >= 5")
    assert [r.p for r in A.first_per_key(rows, ["trait"], [F.desc("n"), F.col("p")]).collect()] == ["p1"]
    v = spark.createDataFrame([(2.0, 0.25), (2.0, None), (2.0, 1.0)], "w double, f double").select(X.variance_share("w", "f").alias("v"))
    assert [r.v for r in v.collect()] == [1.5, 2.0, 2.0]


def test_m21_shuffle_keeps_degrees(spark):
    nodes = spark.range(500).selectExpr("CAST(id AS STRING) AS id", "CAST(id % 3 AS STRING) AS category")
    ids = A.shuffled_ids(nodes, "seed").cache()
    assert ids.count() == 500 and ids.select("new_id").distinct().count() == 500
    assert ids.where("CAST(id AS INT) % 3 != CAST(new_id AS INT) % 3").count() == 0
    edges = spark.range(300).selectExpr("CAST(id % 7 AS STRING) AS subject", "CAST(id AS STRING) AS object")
    degrees = lambda df: sorted(r["count"] for r in df.groupBy("subject").count().collect())
    assert degrees(edges) == degrees(A.shuffled_edges(edges, ids))


def test_m22_overlap(spark):
    nodes = spark.createDataFrame([("n1", ["a", "b"]), ("n2", ["b", "c"])], "id string, equivalent_ids array<string>")
    (e,) = V.overlap_errors(nodes, F.col("id")).collect()
    assert (e.error_type, e.item) == ("overlapping_equiv_ids", "n2")


def test_fold_by_component_equals_the_sequential_fold(spark):
    import random

    rng = random.Random(12)
    rows = []
    ids = [f"i{k}" for k in range(60)]
    rng.shuffle(ids)
    for k in range(12):
        rows.append(node(0, f"p{k}", [f"p{k}", *ids[3 * k : 3 * k + 3]], f"n{k}"))
    for k in range(25):
        i = f"m{k}"
        rows.append(node(1, i, [i, *rng.sample(ids, rng.randint(0, 3))], f"m{k}", rank=1))
    for k in range(15):
        i = f"j{k}"
        rows.append(node(2, i, [i, *rng.sample(ids, rng.randint(0, 3))], f"j{k}", rank=2))
    whole = folded(*rows)
    schema = "id string, name string, categories array<string>, provided_by array<string>, synonyms array<string>, equivalent_ids array<string>, description string, phase int, source_rank int, ordinal string"
    nodes, index = R.canonical_nodes(spark.createDataFrame([tuple(r[c] for c in ("id", "name", "categories", "provided_by", "synonyms", "equivalent_ids", "description", "phase", "source_rank", "ordinal")) for r in rows], schema))
    assert {r.id: r.name for r in nodes.collect()} == {i: n["name"] for i, n in whole.canonical.items()}
    assert {r.equiv_id: r.canonical_id for r in index.collect()} == whole.index


def test_validation_table(spark):
    nodes = spark.createDataFrame([("n1", ["bad"], ["s"], ["n1"]), ("n2", [], None, ["x"])], "id string, categories array<string>, provided_by array<string>, equivalent_ids array<string>")
    got = {(r.error_type, r.subtype) for r in V.node_errors(nodes, source="s").collect()}
    assert got == {("invalid_category_format", "bad"), ("empty_required_field", "categories"), ("missing_required_field", "provided_by"), ("id_not_in_equivalent_ids", None)}
    with pytest.raises(ValueError, match="overlapping_equiv_ids"):
        V.require_valid(V.overlap_errors(spark.createDataFrame([("n1", ["a"]), ("n2", ["a"])], "id string, equivalent_ids array<string>"), F.col("id")))


def test_other_scalars(spark):
    df = spark.createDataFrame([("MONDO_1|EFO:2", "one|two"), ("MONDO_1,EFO:2", "only")], "i string, l string")
    rows = [[tuple(t) for t in r.t] for r in df.select(X.trait_ids("i", "l").alias("t")).collect()]
    assert rows == [[("MONDO", "1", "one"), ("EFO", "2", "two")], [("MONDO", "1", "only"), ("EFO", "2", "only")]]
    p = spark.createDataFrame([(["123", "10.1/x", "zz", None, "123"],)], "p array<string>").select(X.publication_ids("p").alias("p")).first().p
    assert p == ["PMID:123", "doi:10.1/x"]
    s = spark.createDataFrame([("a / b / c",), ("alone",)], "v string").select(X.pair_split("v").alias("s")).collect()
    assert tuple(s[0].s) == ("a", "b / c") and tuple(s[1].s) == ("alone", None)
    assert spark.createDataFrame([(["aa", "bbb", "ccc", None],)], "v array<string>").select(X.longest("v").alias("x")).first().x == "bbb"
    assert [r.x for r in spark.createDataFrame([("1,234",), ("x",), (None,)], "v string").select(X.to_int("v").alias("x")).collect()] == [1234, None, None]


def test_human_counts_round_the_exact_quotient(spark):
    counts = [50_000 * (2 * i + 1) + d for i in range(10, 4000) for d in (-1, 0, 1)] + [977 * k for k in (50_000, 150_000, 350_000, 850_000, 1_150_000)] + [9_221_138_141_828_039_343]
    small = [(0, "0"), (999, "999"), (1_500, "2K"), (2_500, "2K"), (999_500, "1000K"), (-7, "-7"), (None, None)]
    rows = spark.createDataFrame([(n, f"{n / 1e6:.1f}M") for n in counts] + small, "n long, want string")
    assert rows.where(~X.human_count("n").eqNullSafe(F.col("want"))).collect() == []


def test_levels(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c"), ("c", "d")], "src string, dst string")
    assert {r.node: r.level for r in A.levels(edges).collect()} == {"a": 0, "b": 1, "c": 2, "d": 3}


def test_levels_of_a_long_path_and_a_cycle(spark):
    path = spark.createDataFrame([(i, i + 1) for i in range(70)], "src int, dst int")
    assert {r.node: r.level for r in A.levels(path).collect()} == {i: i for i in range(71)}
    with pytest.raises(ValueError, match="cycle"):
        A.levels(spark.createDataFrame([("a", "b"), ("b", "a")], "src string, dst string"))


def test_fold_of_a_component_over_many_batches(spark):
    """One component whose rows come in batches of ten, beside small ones."""
    rows = [node(0, "p", ["p", "x0"], "p")] + [node(1, f"m{k:03}", [f"m{k:03}", f"x{k}", f"x{k + 1}"], f"m{k}", rank=1) for k in range(45)] + [node(0, f"q{k}", [f"q{k}", f"y{k}"], "q") for k in range(5)] + [node(2, f"r{k}", [f"r{k}", f"y{k}"], "r", rank=2) for k in range(5)]
    whole = folded(*rows)
    names = ("id", "name", "categories", "provided_by", "synonyms", "equivalent_ids", "description", "phase", "source_rank", "ordinal")
    schema = "id string, name string, categories array<string>, provided_by array<string>, synonyms array<string>, equivalent_ids array<string>, description string, phase int, source_rank int, ordinal string"
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        nodes, index = R.canonical_nodes(spark.createDataFrame([tuple(r[c] for c in names) for r in rows], schema))
        assert {r.id: r.name for r in nodes.collect()} == {i: n["name"] for i, n in whole.canonical.items()}
        assert {r.equiv_id: r.canonical_id for r in index.collect()} == whole.index
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_edge_checks_in_one_table(spark):
    """Null and unknown ends, a known and an unknown predicate, one of bad form; a node id that repeats counts once."""
    nodes = spark.createDataFrame([("a",), ("a",), ("b",)], "id string")
    rows = [("a", "rel:has", "b", None, "s", "k", "t"), ("a", "rel:other", "zz", {"q": "v"}, "s", "k", "t"), (None, "Bad", "b", None, "s", "k", "t")]
    edges = spark.createDataFrame(rows, "subject string, predicate string, object string, qualifiers map<string,string>, primary_knowledge_source string, knowledge_level string, agent_type string")
    predicates = spark.createDataFrame([("rel:has",), ("rel:has",)], "predicate string")
    got = sorted((r.error_type, r.subtype or "", r.message, r.item) for r in V.edge_errors(edges, nodes, predicates, scheme="rel").collect())
    assert got == [
        ("invalid_predicate", "rel:other", "", "a---rel:other---zz---q:v---s"), ("invalid_predicate_format", "Bad", "", "Bad---b---|---s"), ("missing_required_field", "subject", "", "Bad---b---|---s"),
        ("orphan_edge", "object", "zz", "a---rel:other---zz---q:v---s"), ("orphan_edge", "subject", None, "Bad---b---|---s"),
    ]


def test_attributes_merge_by_source_and_property(spark):
    """Values unite by source and property; a null value gives its property without values, no attributes give null."""
    rows = [("a", "b", {"s": {"p": "1", "q": "x"}}, ["l2"], 1), ("a", "b", {"s": {"p": "2"}, "t": {"p": "1"}}, ["l1", "l2"], 2), ("a", "b", None, None, 3), ("c", "d", None, None, 4), ("e", "f", {"s": {"p": None}}, None, 5)]
    edges = spark.createDataFrame(rows, "subject string, object string, attributes map<string,map<string,string>>, publications array<string>, ordinal int")
    none = F.lit(None)
    edges = edges.withColumns({"predicate": F.lit("rel:has"), "qualifiers": none.cast("map<string,string>"), "primary_knowledge_source": F.lit("s"), "aggregator_knowledge_source": none.cast("array<string>"), "supporting_data_sources": none.cast("array<string>"), "knowledge_level": none.cast("string"), "agent_type": none.cast("string"), "publications_info": none.cast("string"), "source_rank": F.lit(0)})
    got = {r.subject: (r.attributes, r.publications, r.merged_rows) for r in M.merge_edges(edges).collect()}
    assert got == {"a": ({"s": {"p": "[1,2]", "q": "[x]"}, "t": {"p": "[1]"}}, ["l1", "l2"], 3), "c": (None, None, 1), "e": ({"s": {"p": "[]"}}, None, 1)}
    own = {r.subject: r.attributes for r in M.merge_attributes(edges, ["subject"]).collect()}
    assert own == {k: v[0] for k, v in got.items() if v[0]}
