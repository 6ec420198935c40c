"""Counts that describe a graph: by category, prefix, predicate, source and provenance, and meta-edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import staging
from ..functions import scalars as X


def counted(df: DataFrame, *by: str, name: str = "count") -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias(name))


def category_counts(nodes: DataFrame) -> DataFrame:
    return counted(nodes.select(F.explode("categories").alias("category")), "category")


def prefix_counts(nodes: DataFrame) -> DataFrame:
    """By prefix of equivalent ids: each id counts, not each node."""
    return counted(nodes.select(F.explode("equivalent_ids").alias("e")).select(X.prefix("e").alias("prefix")), "prefix")


def with_categories(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with the categories of both ends; an orphan edge drops out. A repeated node id has one of its rows."""
    once = nodes.groupBy("id").agg(F.max("categories").alias("categories"))
    s = once.select(F.col("id").alias("subject"), F.col("categories").alias("subject_categories"))
    o = once.select(F.col("id").alias("object"), F.col("categories").alias("object_categories"))
    return edges.join(s, "subject").join(o, "object")


def meta_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(subject_category, predicate, object_category, edge_count): every pair of the ends' categories counts.

    Edges combine by the category lists of their ends before the lists are exploded.
    """
    lists = counted(with_categories(edges, nodes), "subject_categories", "predicate", "object_categories", name="n")
    flat = lists.select(F.explode("subject_categories").alias("subject_category"), "predicate", "object_categories", "n").select("subject_category", "predicate", F.explode("object_categories").alias("object_category"), "n")
    return flat.groupBy("subject_category", "predicate", "object_category").agg(F.sum("n").alias("edge_count"))


def meta_doubles(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    return meta_edges(edges, nodes).groupBy("subject_category", "object_category").agg(F.sum("edge_count").alias("edge_count"))


def nested_order(triples: DataFrame) -> DataFrame:
    """Triples with the totals of their subject, and of subject and predicate, by which a nested listing is ordered."""
    s, sp = Window.partitionBy("subject_category"), Window.partitionBy("subject_category", "predicate")
    return triples.withColumn("subject_total", F.sum("edge_count").over(s)).withColumn("predicate_total", F.sum("edge_count").over(sp))


def source_counts(edges: DataFrame) -> DataFrame:
    """(role, source, edge_count) for primary, aggregating and supporting sources."""
    out = counted(edges.select(F.lit("primary").alias("role"), F.coalesce("primary_knowledge_source", F.lit("unknown")).alias("source")), "role", "source", name="edge_count")
    for role, c in (("aggregator", "aggregator_knowledge_source"), ("supporting", "supporting_data_sources")):
        out = out.unionByName(counted(edges.select(F.lit(role).alias("role"), F.explode(c).alias("source")), "role", "source", name="edge_count"))
    return out


def klat_counts(edges: DataFrame) -> DataFrame:
    """(knowledge_level, agent_type, edge_count); what is missing counts as not provided."""
    of = lambda c: F.coalesce(c, F.lit("not_provided")).alias(c)
    return counted(edges.select(of("knowledge_level"), of("agent_type")), "knowledge_level", "agent_type", name="edge_count")


def merged_counts(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(item, merged): nodes of several providers and edges of several aggregators."""
    of = lambda df, c, name: df.agg(F.count_if(F.size(c) > 1).alias("merged")).select(F.lit(name).alias("item"), "merged")
    return of(nodes, "provided_by", "nodes").unionByName(of(edges, "aggregator_knowledge_source", "edges"))


def graph_summary(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(measure, value): rows, and the number of different values of each count table."""
    combined = ["subject_categories", "predicate", "object_categories", "knowledge_level", "agent_type"]
    # One join of the edges serves four measures, which then read the few combinations that occur.
    known = staging.put(counted(with_categories(edges, nodes), *combined, name="n"), "summary")
    triples = known.select(F.explode("subject_categories").alias("subject_category"), "predicate", "object_categories").select("subject_category", "predicate", F.explode("object_categories").alias("object_category")).distinct()
    size = lambda df, name: df.agg(F.count("*").alias("value")).select(F.lit(name).alias("measure"), "value")
    parts = [
        size(nodes, "nodes"), size(edges, "edges"), size(category_counts(nodes), "node_categories"), size(prefix_counts(nodes), "node_prefixes"), size(known.select("predicate").distinct(), "edge_predicates"), size(klat_counts(known), "klat_pairs"),
        size(edges.select("primary_knowledge_source").distinct(), "primary_sources"), size(triples.select("subject_category", "object_category").distinct(), "meta_doubles"), size(triples, "meta_triples"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
