"""Declarative source specifications and their plans: raw rows to the node and edge schemas.

A specification names columns; the plan is one projection (and a filter) per table, so Catalyst prunes and pushes
down as if it were written by hand. Steps that a declaration can't express are callables over DataFrames.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as X
from ..functions import schema as S


@dataclass(frozen=True)
class SourceSpec:
    """How one source's columns become nodes and edges. A column may be None where the source has none."""

    name: str
    id: str = "id"
    node_name: str | None = "name"
    category: str | None = "category"
    equivalents: str | None = None
    synonyms: tuple[str, ...] = ()
    taxa: tuple[str, ...] = ()
    url: str | None = None
    description: str | None = "description"
    formula: str | None = None
    mass: str | None = None
    node_publications: str | None = None
    #: Columns that are dropped before anything else, of nodes and of edges.
    ignored: tuple[str, ...] = ()
    ignored_edges: tuple[str, ...] = ()
    edge_publications: str = "publications"
    publications_info: str = "publications_info"
    #: The separator of lists in text columns, and the columns that hold it as a letter.
    delimiter: str | None = None
    whole: tuple[str, ...] = ()
    #: Where it is not "infores:" and the name.
    source: str | None = None
    #: Whether the source repeats what others assert, so that it stands on edges as their aggregator.
    aggregates: bool = True
    category_overrides: dict[str, str] = field(default_factory=dict)
    predicate_overrides: dict[str, str] = field(default_factory=dict)
    #: By (agent type, primary source): the agent type to use.
    agent_overrides: dict[tuple[str, str], str] = field(default_factory=dict)
    negated: str | None = "negated"
    excluded_primaries: tuple[str, ...] = ()
    #: With this, an edge without any primary source counts as excluded wherever exclusions are set.
    missing_is_excluded: bool = True
    default_primary: str | None = None
    default_supporting: tuple[str, ...] = ()
    unreliable: tuple[str, ...] = ()
    renamed: dict[str, str] = field(default_factory=dict)
    after: Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]] | None = None

    @property
    def aggregator(self) -> str:
        return self.source or f"infores:{self.name}"


def as_list(df: DataFrame, c: str | None) -> Column:
    """A column as a list of strings, whatever it is; a missing one is empty."""
    if c is None or c not in df.columns:
        return F.array().cast("array<string>")
    kind = df.schema[c].dataType
    return X.nonempty(F.col(c).cast("array<string>")) if isinstance(kind, T.ArrayType) else X.nonempty(X.to_list(F.col(c).cast("string")))


def as_text(df: DataFrame, c: str | None) -> Column:
    """A column as one string: a list's first member."""
    if c is None or c not in df.columns:
        return F.lit(None).cast("string")
    kind = df.schema[c].dataType
    text = F.get(F.col(c), F.lit(0)) if isinstance(kind, T.ArrayType) else F.col(c)
    return F.when(~X.is_empty_string(text.cast("string")), text.cast("string"))


def json_value(df: DataFrame, c: str) -> Column:
    """JSON text of a value, null where it counts as empty. Zero and false are values."""
    kind = df.schema[c].dataType
    if isinstance(kind, T.StringType):
        return F.when(~X.is_empty_string(F.col(c)), F.regexp_replace(F.to_json(F.array(c)), r"(?s)^\[(.*)\]$", "$1"))
    if isinstance(kind, T.ArrayType | T.MapType):
        return F.when(F.size(c) > 0, F.to_json(c))
    return F.when(F.col(c).isNotNull(), F.to_json(c) if isinstance(kind, T.StructType) else F.col(c).cast("string"))


def property_map(df: DataFrame, columns: list[str], renamed: dict[str, str], lower: bool = False) -> Column:
    """A map of the non-empty columns, by their new names, or null if all are empty."""
    if not columns:
        return F.lit(None).cast(S.MAP)
    name = lambda c: renamed.get(c, c).lower() if lower else renamed.get(c, c)
    entries = F.array(*[F.struct(F.lit(name(c)).alias("key"), json_value(df, c).alias("value")) for c in columns])
    kept = F.filter(entries, lambda e: e["value"].isNotNull())
    return F.when(F.size(kept) > 0, F.map_from_entries(kept))


def split_columns(df: DataFrame, core: set[str], ignored: tuple[str, ...], renamed: dict[str, str]) -> tuple[list[str], list[str]]:
    """The columns beyond the core: those that become attributes, and those that become qualifiers."""
    rest = [c for c in df.columns if c not in core and c not in ignored]
    is_qualifier = lambda c: "qualifie" in renamed.get(c, c).lower()
    return [c for c in rest if not is_qualifier(c)], [c for c in rest if is_qualifier(c)]


def _split(spec: SourceSpec, df: DataFrame) -> DataFrame:
    """Text columns that hold the separator of the source as lists; a text without it is a list of one."""
    if not spec.delimiter:
        return df
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in (*spec.whole, spec.id, spec.node_name, spec.description, spec.negated, "subject", "object", "predicate")]
    return df.withColumns({c: F.split(F.col(c), f"\\Q{spec.delimiter}\\E") for c in texts})


def unreliable_counts(spec: SourceSpec, df: DataFrame) -> DataFrame:
    """(primary, edges): how many edges lose their publications because of their primary source."""
    primary = F.explode(as_list(df, "primary_knowledge_source")).alias("primary")
    return df.where(F.size(as_list(df, spec.edge_publications)) > 0).select(primary).where(F.col("primary").isin(*spec.unreliable) if spec.unreliable else F.lit(False)).groupBy("primary").agg(F.count("*").alias("edges"))


def unknown_roles(df: DataFrame) -> DataFrame:
    """(role, entries): entries of roled sources whose role is none of the three, which take no part."""
    roles = df.select(F.explode("sources").alias("s")).select(F.col("s.resource_role").alias("role"))
    return roles.where("role IS NULL OR role NOT IN ('primary_knowledge_source', 'aggregator_knowledge_source', 'supporting_data_source')").groupBy("role").agg(F.count("*").alias("entries"))


def nodes(spec: SourceSpec, df: DataFrame) -> DataFrame:
    """The node table of a source. Rows without an id or categories are errors at run time."""
    df = _split(spec, df.drop(*spec.ignored))
    core = {spec.id, spec.node_name, spec.category, spec.equivalents, *spec.synonyms, *spec.taxa, spec.url, spec.description, spec.formula, spec.mass, spec.node_publications}
    attributes, _ = split_columns(df, core, spec.ignored, spec.renamed)
    name = X.clean_text(as_text(df, spec.node_name))
    synonyms = X.union_lists(*[as_list(df, c) for c in spec.synonyms], X.to_list(as_text(df, spec.node_name)))
    equivalents = F.filter(as_list(df, spec.equivalents), lambda x: ~F.startswith(x, F.lit("INCHI:")))
    formula, more = X.first_and_rest(as_list(df, spec.formula))
    own = property_map(df, attributes, spec.renamed)
    extra = F.when(F.size(more) > 0, F.create_map(F.lit("additional_chemical_formulas"), F.to_json(more)))
    own = F.when(own.isNull() & extra.isNull(), F.lit(None)).otherwise(F.map_concat(F.coalesce(own, F.create_map().cast(S.MAP)), F.coalesce(extra, F.create_map().cast(S.MAP))))
    fixed = X.mapped_list(F.transform(as_list(df, spec.category), X.single_prefix), spec.category_overrides)
    node_id = X.single_prefix(spec.id)
    return df.select(
        F.coalesce(node_id, F.raise_error(F.lit(f"{spec.name}: a node without an id"))).alias("id"), name.alias("name"), X.absent_if_empty(as_list(df, spec.url)).alias("urls"),
        F.when(F.size(fixed) > 0, F.array_sort(F.array_distinct(fixed))).otherwise(F.raise_error(F.lit(f"{spec.name}: a node without categories"))).alias("categories"),
        F.array(F.lit(spec.aggregator)).alias("provided_by"), X.absent_if_empty(synonyms).alias("synonyms"), X.union_lists(equivalents, F.array(node_id)).alias("equivalent_ids"),
        X.absent_if_empty(X.union_lists(*[as_list(df, c) for c in spec.taxa])).alias("taxa") if spec.taxa else F.lit(None).cast(S.LIST).alias("taxa"),
        X.clean_text(as_text(df, spec.description)).alias("description"), formula.alias("chemical_formula"), X.to_float(as_text(df, spec.mass)).alias("exact_mass"),
        X.absent_if_empty(as_list(df, spec.node_publications)).alias("publications"), F.when(own.isNotNull(), F.create_map(F.lit(spec.aggregator), own)).alias("attributes"),
    )


EDGE_CORE = {"subject", "object", "predicate", "primary_knowledge_source", "aggregator_knowledge_source", "supporting_data_sources", "knowledge_level", "agent_type", "publications", "publications_info", "sources"}


def provenance(df: DataFrame, spec: SourceSpec) -> dict[str, Column]:
    """primaries, aggregators and supporting sources, from flat columns and from a list of roled sources."""
    out = {"primaries": as_list(df, "primary_knowledge_source"), "aggregators": as_list(df, "aggregator_knowledge_source"), "supporting": as_list(df, "supporting_data_sources")}
    if "sources" in df.columns and isinstance(df.schema["sources"].dataType, T.ArrayType):
        of = lambda role: F.transform(F.filter(F.coalesce(F.col("sources"), F.array().cast(df.schema["sources"].dataType)), lambda s: s["resource_role"] == role), lambda s: s["resource_id"])
        roled = of("primary_knowledge_source")
        one = F.when(F.col("sources").isNull() | (F.size(roled) == 1), roled).otherwise(F.raise_error(F.concat(F.lit(f"{spec.name}: primary sources of an edge: "), F.size(roled).cast("string"))))
        out = {"primaries": F.concat(out["primaries"], one), "aggregators": F.concat(out["aggregators"], of("aggregator_knowledge_source")), "supporting": F.concat(out["supporting"], of("supporting_data_source"))}
    return out


def excluded(primaries: Column, spec: SourceSpec) -> Column:
    """Whether all primaries of an edge are excluded; none at all counts by the specification."""
    if not spec.excluded_primaries:
        return F.lit(False)
    left = F.array_except(F.coalesce(primaries, F.array().cast(S.LIST)), F.array(*map(F.lit, spec.excluded_primaries)))
    out = F.size(left) == 0
    return out if spec.missing_is_excluded else out & (F.coalesce(F.size(primaries), F.lit(0)) > 0)


def edges(spec: SourceSpec, df: DataFrame) -> DataFrame:
    """The edge table of a source: negated and excluded edges go first."""
    if spec.negated and spec.negated in df.columns:
        kind = df.schema[spec.negated].dataType
        flag = F.coalesce(F.col(spec.negated), F.lit(False)) if isinstance(kind, T.BooleanType) else X.truthy_string(F.col(spec.negated).cast("string"))
        df = df.where(~flag)
    flat = as_list(df, "primary_knowledge_source")
    df = _split(spec, df.where(~excluded(flat, spec)).drop(*spec.ignored_edges))
    core = (EDGE_CORE - {"publications", "publications_info"}) | {spec.negated, spec.edge_publications, spec.publications_info}
    attributes, qualifiers = split_columns(df, core, spec.ignored_edges, spec.renamed)
    from_ = provenance(df, spec)
    primaries = F.array_distinct(from_["primaries"])
    primary, more = X.first_and_rest(primaries)
    default = F.lit(spec.default_primary) if spec.default_primary else F.lit(None).cast("string")
    supporting = X.union_lists(from_["supporting"], more)
    if spec.default_supporting:
        supporting = F.when(F.size(supporting) > 0, supporting).otherwise(F.array(*map(F.lit, spec.default_supporting)))
    types = as_list(df, "agent_type")
    # A column of its own: inside a lambda the name of the result would be taken for the column it is made from.
    df = df.withColumn("_primary", X.coalesce_text(primary, default))
    primary = F.col("_primary")
    if spec.agent_overrides:
        table = F.create_map(*[x for (a, p), v in spec.agent_overrides.items() for x in (F.lit(f"{a}\t{p}"), F.lit(v))])
        types = F.array_distinct(F.transform(types, lambda a: F.coalesce(F.try_element_at(table, F.concat_ws("\t", a, primary)), a)))
    agent, agents = X.first_and_rest(types)
    cleaned = lambda c: F.when(F.coalesce(c, F.lit(S.UNSPECIFIED)) == S.UNSPECIFIED, S.NOT_PROVIDED).otherwise(c)
    publications = X.absent_if_empty(as_list(df, spec.edge_publications))
    info = json_value(df, spec.publications_info) if spec.publications_info in df.columns else F.lit(None).cast("string")
    distrust = F.coalesce(primary.isin(*spec.unreliable), F.lit(False)) if spec.unreliable else F.lit(False)
    own = property_map(df, attributes, spec.renamed)
    extra = F.when(F.size(agents) > 0, F.create_map(F.lit("additional_agent_types"), F.to_json(agents)))
    empty = F.create_map().cast(S.MAP)
    own = F.when(own.isNull() & extra.isNull(), F.lit(None)).otherwise(F.map_concat(F.coalesce(own, empty), F.coalesce(extra, empty)))
    quals = property_map(df, qualifiers, spec.renamed, lower=True)
    plain = F.transform_values(quals, lambda _, v: F.coalesce(F.get_json_object(F.concat(F.lit('{"v":'), v, F.lit("}")), "$.v"), v))
    must = lambda c, name: F.coalesce(F.nullif(c, F.lit("")), F.raise_error(F.lit(f"{spec.name}: an edge without {name}"))).alias(name)
    return df.select(
        must(X.single_prefix("subject"), "subject"), must(X.single_prefix("object"), "object"), must(X.mapped(X.single_prefix("predicate"), spec.predicate_overrides), "predicate"), plain.alias("qualifiers"),
        must(primary, "primary_knowledge_source"), X.union_lists(from_["aggregators"], *([F.array(F.lit(spec.aggregator))] if spec.aggregates else [])).alias("aggregator_knowledge_source"), X.absent_if_empty(supporting).alias("supporting_data_sources"),
        cleaned(as_text(df, "knowledge_level")).alias("knowledge_level"), cleaned(agent).alias("agent_type"), F.when(~distrust, publications).alias("publications"), F.when(~distrust, info).alias("publications_info"),
        F.when(own.isNotNull(), F.create_map(F.lit(spec.aggregator), own)).alias("attributes"),
    )


def harmonize(spec: SourceSpec, raw_nodes: DataFrame, raw_edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of a source, by its specification and then by its own step, if it has one."""
    out = nodes(spec, raw_nodes), edges(spec, raw_edges)
    return spec.after(*out) if spec.after else out


def ordered(df: DataFrame, source_rank: int, *by: str) -> DataFrame:
    """source_rank and ordinal, the order in which first and last are meant; by: columns that order the source's rows.

    The ordinal is a digest of the row's own values, so it is the same however the rows are partitioned.
    """
    keys = [F.to_json(c) if isinstance(df.schema[c].dataType, T.ArrayType | T.MapType | T.StructType) else F.col(c).cast("string") for c in (by or df.columns)]
    return df.withColumn("source_rank", F.lit(source_rank)).withColumn("ordinal", F.md5(F.concat_ws("\x1f", *keys)) if not by else F.concat_ws("\x1f", *keys))


def select_sources(known: list[str], primary: str, include: set[str] | None = None, exclude: set[str] | None = None) -> list[str]:
    """The sources of a build, the primary first and the others in the order they are known."""
    if include and exclude:
        raise ValueError("name sources to include or to exclude, not both")
    for s in (include or set()) | (exclude or set()) | {primary}:
        if s not in known:
            raise ValueError(f"unknown source {s}")
    pool = [s for s in known if (not include or s in include) and s not in (exclude or set())]
    return [primary, *[s for s in pool if s != primary]]
