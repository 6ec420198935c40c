"""A whole build: harmonize each source, validate it, integrate all, describe and sample the graph, record the build.

Stages are Parquet tables under the output folder, one folder per source, so a stage can be rerun from its
predecessor. JSON Lines are written once, at the end.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import analysis as A
from ..operators import merge as M
from ..operators import metagraph as G
from ..operators import resolve as R
from ..operators import validate as V
from ..sources import sinks, spec


@dataclass(frozen=True)
class Source:
    """One source of a build: its specification, its raw tables, and whether its nodes may unite others."""

    spec: spec.SourceSpec
    read: Callable[[SparkSession], tuple[DataFrame, DataFrame]]
    merging: bool = True


@dataclass(frozen=True)
class BuildConfig:
    folder: str
    primary: str
    graph: str = "graph"
    version: str = "0"
    include: set[str] | None = None
    exclude: set[str] | None = None
    scheme: str = "biolink"
    sample: int = 0
    seed: str = ""
    fail_on_error: bool = True
    ancestors: dict[str, frozenset[str]] = field(default_factory=dict)


@dataclass(frozen=True)
class Graph:
    nodes: DataFrame
    edges: DataFrame
    errors: DataFrame


def _stage(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def harmonize_source(spark: SparkSession, config: BuildConfig, source: Source, rank: int) -> Graph:
    """One source's tables, written, with its errors."""
    nodes, edges = spec.harmonize(source.spec, *source.read(spark))
    at = f"{config.folder}/harmonized/{source.spec.name}"
    nodes = _stage(spec.ordered(nodes, rank, "id"), f"{at}/nodes")
    edges = _stage(spec.ordered(edges, rank), f"{at}/edges")
    errors = V.node_errors(nodes.drop("source_rank", "ordinal"), source.spec.aggregator, scheme=config.scheme).unionByName(V.edge_errors(edges.drop("source_rank", "ordinal"), nodes, scheme=config.scheme))
    return Graph(nodes, edges, errors.withColumn("source", F.lit(source.spec.name)))


def integrate(config: BuildConfig, parts: list[tuple[Source, Graph]]) -> Graph:
    """Canonical nodes and merged edges of all sources; the first source is the primary one."""
    phase = lambda i, s: F.lit(0 if i == 0 else 1 if s.merging else 2)
    union = lambda dfs: reduce(lambda x, y: x.unionByName(y), dfs)
    rows = union([g.nodes.withColumn("phase", phase(i, s)) for i, (s, g) in enumerate(parts)])
    nodes, index = R.canonical_nodes(rows, config.ancestors)
    at = f"{config.folder}/integrated"
    nodes, index = _stage(nodes, f"{at}/nodes"), _stage(index, f"{at}/index")
    edges = _stage(M.merge_edges(M.canonical_endpoints(union([g.edges for _, g in parts]), index)), f"{at}/edges")
    plain = edges.drop("edge_key", "merged_rows")
    errors = V.node_errors(nodes, scheme=config.scheme).unionByName(V.overlap_errors(nodes, F.col("id"))).unionByName(V.edge_errors(plain, nodes, scheme=config.scheme)).unionByName(V.integration_errors(nodes, plain))
    return Graph(nodes, edges, errors.withColumn("source", F.lit(config.graph)))


def describe(config: BuildConfig, graph: Graph) -> dict:
    """The metagraph document, written beside the graph."""
    triples = G.meta_edges(graph.edges, graph.nodes)
    document = {
        "graph": config.graph, "version": config.version, "summary": {r.measure: r.value for r in G.graph_summary(graph.nodes, graph.edges).collect()}, "node_categories": sinks.nested_counts(G.category_counts(graph.nodes), ["category"], "count"),
        "node_prefixes": sinks.nested_counts(G.prefix_counts(graph.nodes), ["prefix"], "count"), "sources": sinks.nested_counts(G.source_counts(graph.edges), ["role", "source"], "edge_count"), "klat_joint": sinks.nested_counts(G.klat_counts(graph.edges), ["knowledge_level", "agent_type"], "edge_count"),
        "meta_triples": sinks.nested_counts(triples, ["subject_category", "predicate", "object_category"], "edge_count"),
    }
    sinks.metagraph(document, config.folder, config.graph, config.version)
    return document


def build(spark: SparkSession, config: BuildConfig, sources: dict[str, Source], commit: str = "unknown", package: str = "0") -> tuple[Graph, dict]:
    """The integrated graph and its build record."""
    began = time.time()
    names = spec.select_sources([*sources], config.primary, config.include, config.exclude)
    parts = [(sources[n], harmonize_source(spark, config, sources[n], i)) for i, n in enumerate(names)]
    if config.fail_on_error:
        for _, part in parts:
            V.require_valid(part.errors)
    graph = integrate(config, parts)
    if config.fail_on_error:
        V.require_valid(graph.errors)
    document = describe(config, graph)
    sinks.jsonl(graph.nodes, f"{config.folder}/{config.graph}_nodes", "overwrite")
    sinks.jsonl(graph.edges.drop("merged_rows", "edge_key"), f"{config.folder}/{config.graph}_edges", "overwrite")
    if config.sample:
        nodes, edges = A.sample_graph(graph.nodes, graph.edges, config.sample, config.seed)
        sinks.jsonl(nodes, f"{config.folder}/{config.graph}_sample_nodes", "overwrite")
        sinks.jsonl(edges, f"{config.folder}/{config.graph}_sample_edges", "overwrite")
    record = sinks.build_record(
        f"{config.folder}/build_record.json", kg_version=config.version, package_version=package, biolink_version=config.scheme, git_commit=commit, sources=sorted(names), steps_run={"harmonize": True, "integrate": True, "postprocess": bool(config.sample)},
        build_duration_minutes=(time.time() - began) / 60, kg_label=config.graph, node_count=document["summary"]["nodes"], edge_count=document["summary"]["edges"],
    )
    return graph, record
