"""Ordered and cut reports over counts: top lists that say what they leave out, comparisons of graphs, and orders by family."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def top_of(counts: DataFrame, name: str, value: str, n: int) -> DataFrame:
    """The n largest rows, ties by name, with how many are shown of how many: ``shown`` and ``total``."""
    total = counts.agg(F.count("*")).scalar()
    return counts.orderBy(F.desc(value), name).limit(n).withColumn("total", total).withColumn("shown", F.least(F.lit(n).cast("bigint"), F.col("total")))


def top_by_most(long: DataFrame, name: str, graph: str, value: str, n: int) -> DataFrame:
    """(name, most): the n names whose largest count over the graphs is highest, ties by name."""
    totals = long.groupBy(name, graph).agg(F.sum(value).alias(value))
    return totals.groupBy(name).agg(F.max(value).alias("most")).orderBy(F.desc("most"), name).limit(n)


def top_unique(long: DataFrame, name: str, graph: str, value: str, n: int) -> DataFrame:
    """(graph, name, value, rank): for each graph the n largest names that no other graph has."""
    totals = long.groupBy(name, graph).agg(F.sum(value).alias(value))
    alone = totals.groupBy(name).agg(F.count("*").alias("graphs"), F.min(graph).alias(graph), F.min(value).alias(value)).where("graphs = 1").drop("graphs")
    rank = F.row_number().over(Window.partitionBy(graph).orderBy(F.desc(value), name))
    return alone.withColumn("rank", rank).where(F.col("rank") <= n).select(graph, name, value, "rank")


def by_family(involved: DataFrame, category: str, value: str, family: Column, order: list[str], n: int | None = None) -> DataFrame:
    """(category, family, value, place): categories in the order of their families, within one by falling value, ties by
    name; of the n largest ones only, if n is given."""
    best = involved.orderBy(F.desc(value), category).limit(n) if n else involved
    named = best.withColumn("family", family)
    at = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, order)), F.col("family")), F.lit(0)), F.lit(len(order) + 1))
    # One row for each category of the vocabulary: as many as a figure can show.
    place = F.row_number().over(Window.orderBy(at, F.desc(value), category))
    return named.withColumn("place", place.cast("bigint")).select(category, "family", value, "place")


def without_names(df: DataFrame, columns: list[str], parts: list[str]) -> DataFrame:
    """The rows none of whose names holds one of the parts."""
    for c in columns:
        for p in filter(None, map(str.strip, parts)):
            df = df.where(~F.contains(F.col(c), F.lit(p)))
    return df


def triples_of(documents: DataFrame, c: str = "value") -> DataFrame:
    """(subject, predicate, object) of the meta-triples of metagraph documents, given as the JSON text of that block.

    Either subject, predicate and object are nested, or one key holds all three, parted by two underscores.
    """
    outer = documents.select(F.explode(F.from_json(c, "map<string,string>")).alias("key", "rest"))
    nested = outer.where(F.startswith("rest", F.lit("{"))).select(F.col("key").alias("subject"), F.explode(F.from_json("rest", "map<string,string>")).alias("predicate", "objects"))
    nested = nested.select("subject", "predicate", F.explode(F.map_keys(F.from_json("objects", "map<string,string>"))).alias("object"))
    flat = outer.where(~F.startswith("rest", F.lit("{"))).select(F.split("key", "__").alias("p")).where(F.size("p") == 3)
    return nested.unionByName(flat.select(F.col("p")[0].alias("subject"), F.col("p")[1].alias("predicate"), F.col("p")[2].alias("object")))


def known_candidates(nodes: DataFrame, candidates: DataFrame) -> DataFrame:
    """(curie, categories): the candidates that some node has as its id or an equivalent one, with all their categories."""
    held = nodes.select(F.explode(F.array_union("equivalent_ids", F.array("id"))).alias("curie"), "categories")
    return held.join(candidates.select("curie").distinct(), "curie", "left_semi").select("curie", F.explode("categories").alias("category")).groupBy("curie").agg(F.sort_array(F.collect_set("category")).alias("categories"))
