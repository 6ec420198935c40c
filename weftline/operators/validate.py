"""Validation as an error table: (entity, error_type, subtype, message, item).

Row checks are one pass over each table: every check is a nullable struct and the non-null ones are exploded.
Checks that need another table are left joins to its distinct keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as X
from ..functions import schema as S

#: What an edge's key is made of, but for its predicate.
EDGE_ITEM = ["subject", "object", "qualifiers", "primary_knowledge_source"]
ERROR = "struct<error_type:string,subtype:string,message:string>"


def problem(when: Column, kind: str, subtype: Column | str | None = None, message: Column | str = "") -> Column:
    text = lambda x: x if isinstance(x, Column) else F.lit(x).cast("string")
    return F.when(when, F.struct(F.lit(kind).alias("error_type"), text(subtype).alias("subtype"), text(message).alias("message")))


def _table(df: DataFrame, entity: str, item: Column, checks: list[Column]) -> DataFrame:
    found = F.filter(F.array(*[c.cast(ERROR) for c in checks]), lambda x: x.isNotNull())
    return df.select(item.alias("item"), F.explode(found).alias("e")).select(F.lit(entity).alias("entity"), "e.error_type", "e.subtype", "e.message", "item")


def required(df: DataFrame, names: list[str]) -> list[Column]:
    out = []
    for c in names:
        if c not in df.columns:
            out.append(problem(F.lit(True), "missing_required_field", c))
            continue
        empty = F.size(c) == 0 if isinstance(df.schema[c].dataType, T.ArrayType) else F.col(c) == "" if isinstance(df.schema[c].dataType, T.StringType) else F.lit(False)
        out += [problem(F.col(c).isNull(), "missing_required_field", c), problem(F.col(c).isNotNull() & empty, "empty_required_field", c)]
    return out


def typed(df: DataFrame, model: T.StructType) -> list[Column]:
    """Columns of another type than the model's, and columns that it doesn't have."""
    out = []
    for f in df.schema.fields:
        if f.name not in model.names:
            out.append(problem(F.lit(True), "unexpected_property", f.name))
            continue
        want = model[f.name].dataType
        if type(f.dataType) is not type(want):
            out.append(problem(F.col(f.name).isNotNull(), "invalid_type", f.name, f"{f.dataType.simpleString()}, not {want.simpleString()}"))
        elif isinstance(want, T.ArrayType) and type(f.dataType.elementType) is not type(want.elementType):
            out.append(problem(F.size(f.name) > 0, "invalid_inner_type", f.name, f.dataType.elementType.simpleString()))
    return out


def node_errors(nodes: DataFrame, source: str | None = None, categories: DataFrame | None = None, scheme: str = "biolink", model: T.StructType = S.NODE) -> DataFrame:
    """categories: (category), the known ones. source: the provider that every node must name."""
    checks = required(nodes, S.REQUIRED_NODE) + typed(nodes, model)
    checks.append(problem(~F.array_contains("equivalent_ids", F.col("id")), "id_not_in_equivalent_ids", None, F.col("id")))
    if source:
        checks.append(problem(~F.array_contains("provided_by", F.lit(source)), "missing_source_provenance", source))
    out = _table(nodes, "node", F.col("id"), checks)
    named, known = X.category_format("category", scheme), F.lit(True)
    flat = nodes.select("id", F.explode("categories").alias("category"))
    if categories is not None:
        flat = flat.join(categories.select("category", F.lit(True).alias("_known")).distinct(), "category", "left")
        known = F.col("_known").isNotNull()
    kind = F.when(~named, "invalid_category_format").when(named & ~known, "invalid_category")
    bad = flat.select(F.lit("node").alias("entity"), kind.alias("error_type"), F.col("category").alias("subtype"), F.lit("").alias("message"), F.col("id").alias("item"))
    return out.unionByName(bad.where("error_type IS NOT NULL"))


def overlap_errors(nodes: DataFrame, order: Column) -> DataFrame:
    """One error for each node that has an equivalent id of an earlier node; subtype: the prefixes of its shared ids."""
    held = nodes.select("id", order.alias("_o"), F.explode(F.array_distinct("equivalent_ids")).alias("equiv_id"))
    first = held.groupBy("equiv_id").agg(F.min(F.struct("_o", "id")).alias("first"), F.count_distinct("id").alias("n")).where("n > 1")
    later = held.join(first, "equiv_id").where(F.col("id") != F.col("first.id"))
    shared = later.groupBy("id").agg(F.array_join(F.sort_array(F.collect_set(X.prefix("equiv_id"))), "|").alias("subtype"))
    return shared.select(F.lit("node").alias("entity"), F.lit("overlapping_equiv_ids").alias("error_type"), "subtype", F.lit("").alias("message"), F.col("id").alias("item"))


def edge_errors(edges: DataFrame, nodes: DataFrame, predicates: DataFrame | None = None, knowledge_levels: list[str] = (), agent_types: list[str] = (), scheme: str = "biolink", model: T.StructType = S.EDGE) -> DataFrame:
    """predicates: (predicate), the known ones.

    Row checks come first, so that the joins to known ids and predicates carry only an edge's key, ends and errors.
    """
    checks = required(edges, S.REQUIRED_EDGE) + typed(edges, model)
    checks.append(problem(~X.predicate_format("predicate", scheme), "invalid_predicate_format", F.col("predicate")))
    if knowledge_levels:
        checks.append(problem(~F.col("knowledge_level").isin(*knowledge_levels), "invalid_knowledge_level", F.col("knowledge_level")))
    if agent_types:
        checks.append(problem(~F.col("agent_type").isin(*agent_types), "invalid_agent_type", F.concat_ws(" from ", "agent_type", "primary_knowledge_source")))
    rows = edges.select(*EDGE_ITEM, "predicate", F.array(*[c.cast(ERROR) for c in checks]).alias("_found"))
    ids, late = nodes.select("id").distinct(), []
    for side in ("subject", "object"):
        rows = rows.join(ids.select(F.col("id").alias(side), F.lit(True).alias(f"_{side}")), side, "left")
        late.append(problem(F.col(f"_{side}").isNull(), "orphan_edge", side, F.col(side)))
    if predicates is not None:
        rows = rows.join(predicates.select("predicate", F.lit(True).alias("_predicate")).distinct(), "predicate", "left")
        late.append(problem(F.col("_predicate").isNull() & X.predicate_format("predicate", scheme), "invalid_predicate", F.col("predicate")))
    found = F.filter(F.concat("_found", F.array(*[c.cast(ERROR) for c in late])), lambda x: x.isNotNull())
    faulty = rows.select(*EDGE_ITEM, "predicate", F.explode(found).alias("e"))
    return faulty.select(F.lit("edge").alias("entity"), "e.error_type", "e.subtype", "e.message", X.edge_key().alias("item"))


def integration_errors(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """An integrated graph must have nodes of several providers and edges of several aggregators."""
    of = lambda df, c, entity: df.agg(F.count_if(F.size(c) > 1).alias("n")).where("n = 0").select(F.lit(entity).alias("entity"), F.lit(f"no_merged_{entity}s").alias("error_type"), F.lit(None).cast("string").alias("subtype"), F.lit("").alias("message"), F.lit(None).cast("string").alias("item"))
    return of(nodes, "provided_by", "node").unionByName(of(edges, "aggregator_knowledge_source", "edge"))


def summary(errors: DataFrame, examples: int = 1) -> DataFrame:
    """Count and the smallest examples of each type and subtype; an example list never grows beyond its bound."""
    ranked = errors.groupBy("error_type", "subtype").agg(F.count("*").alias("errors"), F.min("item").alias("example"))
    if examples <= 1:
        return ranked
    from pyspark.sql.window import Window

    place = F.row_number().over(Window.partitionBy("error_type", "subtype").orderBy("item"))
    some = errors.select("error_type", "subtype", "item").distinct().withColumn("place", place).where(F.col("place") <= examples)
    lists = some.groupBy("error_type", "subtype").agg(F.sort_array(F.collect_list("item")).alias("examples"))
    return ranked.join(lists, F.struct(ranked.error_type, ranked.subtype).eqNullSafe(F.struct(lists.error_type, lists.subtype)), "left").select(ranked["*"], "examples")


def require_valid(errors: DataFrame) -> None:
    """Raise with a summary if there is any error."""
    rows = summary(errors).orderBy(F.desc("errors"), "error_type", "subtype").limit(50).collect()
    if rows:
        raise ValueError("; ".join(f"{r.error_type} ({r.subtype}): {r.errors}, as {r.example}" for r in rows))
