import json

import pytest

from weftline.plans.build import BuildConfig, Source, build
from weftline.sources.spec import SourceSpec


def source(name, nodes, edges, **kw):
    def read(spark):
        n = spark.createDataFrame(nodes, "id string, name string, category string, xref array<string>, weight int")
        e = spark.createDataFrame(edges, "subject string, object string, predicate string, primary_knowledge_source string, knowledge_level string, agent_type string, score int")
        return n, e

    return Source(SourceSpec(name, equivalents="xref"), read, **kw)


def sources(predicate="biolink:affects"):
    edge = lambda s, o, n: (s, o, predicate, "infores:p", "prediction", "manual_agent", n)
    return {
        "a": source("a", [("G:1", "one", "biolink:Gene", ["E:1"], 5), ("D:1", "ill", "biolink:Disease", [], None)], [edge("G:1", "D:1", 1)]),
        "b": source("b", [("E:1", "uno", "biolink:Gene", ["E:1", "X:1", "X:2"], 7), ("D:1", "ill", "biolink:Disease", [], None)], [edge("E:1", "D:1", 2)]),
    }


def test_build(spark, tmp_path):
    graph, record = build(spark, BuildConfig(str(tmp_path), "a", "toy", "1", sample=1), sources())
    nodes = {r.id: r for r in graph.nodes.collect()}
    assert set(nodes) == {"E:1", "D:1"}  # the larger set dominates
    assert nodes["E:1"].equivalent_ids == ["E:1", "G:1", "X:1", "X:2"] and nodes["E:1"].provided_by == ["infores:a", "infores:b"]
    assert nodes["E:1"].attributes == {"infores:a": {"weight": "[5]"}, "infores:b": {"weight": "[7]"}}
    (edge,) = graph.edges.collect()
    assert (edge.subject, edge.object, edge.aggregator_knowledge_source, edge.merged_rows) == ("E:1", "D:1", ["infores:a", "infores:b"], 2)
    assert record["node_count"] == 2 and record["edge_count"] == 1 and record["sources"] == ["a", "b"]
    meta = json.loads((tmp_path / "toy-1_metagraph.json").read_text())
    assert meta["meta_triples"] == {"biolink:Gene": {"biolink:affects": {"biolink:Disease": 1}}}


def test_a_bad_source_stops_the_build(spark, tmp_path):
    with pytest.raises(ValueError, match="invalid_predicate_format"):
        build(spark, BuildConfig(str(tmp_path), "a"), sources("affects"))
