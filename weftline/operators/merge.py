"""Edge merge: one edge for all assertions with the same key.

Rows are grouped by the key columns themselves, in one aggregation for scalars, lists and attributes; hot keys combine
before the shuffle. "First" is by (source_rank, ordinal).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as X
from ..functions import schema as S


def first_provided(c: str, order: Column) -> Column:
    """The first value of a group that says something, else not_provided."""
    return F.coalesce(F.min_by(F.col(c), F.when(F.coalesce(F.col(c), F.lit(S.NOT_PROVIDED)) != S.NOT_PROVIDED, order)), F.lit(S.NOT_PROVIDED))


def list_union(c: str) -> Column:
    """The sorted distinct members of a group's lists, a null one first; null where there are none.

    Lists are gathered as sets, so repeated lists (the common case of copies) are held once.
    """
    return X.absent_if_empty(F.sort_array(F.array_distinct(F.flatten(F.collect_set(F.col(c))))))


def attribute_values(c: str) -> Column:
    """The values of a map of maps, as an array of (source, property, value)."""
    of = lambda s, p: F.struct(s["key"].alias("source"), p["key"].alias("property"), p["value"].alias("value"))
    return F.flatten(F.transform(F.map_entries(c), lambda s: F.transform(F.map_entries(s["value"]), lambda p: of(s, p))))


def attribute_map(c: str) -> Column:
    """Of sorted distinct (source, property, value), per source and property the values as a JSON list; null of none."""

    def of_property(rows: Column, p: Column) -> Column:
        held = F.filter(rows, lambda v: (v["property"] == p) & v["value"].isNotNull())
        return F.concat(F.lit("["), F.array_join(F.transform(held, lambda v: v["value"]), ","), F.lit("]"))

    def of_source(s: Column) -> Column:
        rows = F.filter(c, lambda v: v["source"] == s)
        properties = F.array_distinct(F.transform(rows, lambda v: v["property"]))
        return F.map_from_arrays(properties, F.transform(properties, lambda p: of_property(rows, p)))

    sources = F.array_distinct(F.transform(c, lambda v: v["source"]))
    return F.when(F.size(c) > 0, F.map_from_arrays(sources, F.transform(sources, of_source)))


def merge_edges(edges: DataFrame, with_attributes: bool = True) -> DataFrame:
    """Edges with source_rank and ordinal, merged by key, with edge_key and the number of merged rows.

    One shuffle. Lists and attributes of a group are gathered as sets of rows' arrays, so what copies repeat is held once.
    """
    order = F.struct("source_rank", "ordinal")
    # A map can't be grouped by; its sorted entries can.
    keyed = edges.withColumn("_q", F.sort_array(F.map_entries(F.coalesce("qualifiers", F.create_map().cast(S.MAP)))))
    key = ["subject", "predicate", "object", "_q", "primary_knowledge_source"]
    merged = [
        list_union("aggregator_knowledge_source").alias("aggregator_knowledge_source"), list_union("supporting_data_sources").alias("supporting_data_sources"), first_provided("knowledge_level", order).alias("knowledge_level"),
        first_provided("agent_type", order).alias("agent_type"), list_union("publications").alias("publications"), F.min_by("publications_info", F.when(F.col("publications_info").isNotNull(), order)).alias("publications_info"), F.count("*").alias("merged_rows"),
    ]
    if with_attributes:
        keyed = keyed.withColumn("_values", attribute_values("attributes"))
        merged.append(F.sort_array(F.array_distinct(F.flatten(F.collect_set("_values")))).alias("_values"))
    out = keyed.groupBy(*key).agg(*merged).withColumn("qualifiers", F.when(F.size("_q") > 0, F.map_from_entries("_q")))
    if with_attributes:
        out = out.withColumn("attributes", attribute_map("_values")).drop("_values")
    return out.drop("_q").withColumn("edge_key", X.edge_key())


def merge_attributes(rows: DataFrame, key: list[str]) -> DataFrame:
    """Attributes by key, as attribute_map gives them; values combine one by one, in one shuffle. Keys without any have no row."""
    flat = rows.select(*key, F.explode(attribute_values("attributes")).alias("_value"))
    return flat.groupBy(*key).agg(F.sort_array(F.collect_set("_value")).alias("_values")).select(*key, attribute_map("_values").alias("attributes"))


def canonical_endpoints(edges: DataFrame, index: DataFrame) -> DataFrame:
    """Subject and object as canonical ids where both are known; otherwise the edge stays as it is.

    index: (equiv_id, canonical_id), one row per equiv_id.
    """
    s = index.select(F.col("equiv_id").alias("subject"), F.col("canonical_id").alias("_s"))
    o = index.select(F.col("equiv_id").alias("object"), F.col("canonical_id").alias("_o"))
    known = F.col("_s").isNotNull() & F.col("_o").isNotNull()
    joined = edges.join(s, "subject", "left").join(o, "object", "left")
    moved = joined.withColumns({"subject": F.when(known, F.col("_s")).otherwise(F.col("subject")), "object": F.when(known, F.col("_o")).otherwise(F.col("object"))})
    return moved.select(*edges.columns)


def orphans(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(subtype, id, edge columns) of edges with an endpoint that is no node."""
    out = [edges.join(nodes.select(F.col("id").alias(side)), side, "left_anti").select(F.lit(side).alias("subtype"), F.col(side).alias("id"), *edges.columns) for side in ("subject", "object")]
    return out[0].unionByName(out[1])


def stubs(edges: DataFrame, names: dict[str, str], category: str) -> DataFrame:
    """(id, name, categories): a minimal node for each endpoint; of several names the smallest.

    names: the column that names the endpoint, by side.
    """
    ends = [edges.select(F.col(side).alias("id"), F.col(name).alias("name")) for side, name in names.items()]
    both = ends[0]
    for e in ends[1:]:
        both = both.unionByName(e)
    return both.where("id IS NOT NULL").groupBy("id").agg(F.min("name").alias("name")).withColumn("categories", F.array(F.lit(category)))
