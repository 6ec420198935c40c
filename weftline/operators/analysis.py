"""Analyses over graphs: ranges, ranks, handoffs, comparison, sampling, shuffling, subgraphs and profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import scalars as X


def range_join(points: DataFrame, intervals: DataFrame, key: str, at: str, start: str, end: str, width: int) -> DataFrame:
    """Points with the intervals that hold them, ends included, by an equi-join on (key, bin).

    An interval goes to each bin it touches, a point to its one, so a pair meets once. The result doesn't depend on
    the width; about the median length of an interval is a good one.
    """
    of = lambda c: F.floor(F.col(c) / F.lit(width)).cast("long")
    spread = intervals.where(F.col(start) <= F.col(end)).withColumn("_bin", F.explode(F.sequence(of(start), of(end))))
    return points.withColumn("_bin", of(at)).join(spread, [key, "_bin"]).where(F.col(at).between(F.col(start), F.col(end))).drop("_bin")


def top_per_group(df: DataFrame, group: list[str], order: list[Column], n: int) -> DataFrame:
    """The first n rows of each group; the plan keeps n per group and task before the shuffle."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("rank") <= n)


def first_per_key(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    return top_per_group(df, key, order, 1).drop("rank")


def handoff_pairs(touches: DataFrame, families: DataFrame) -> DataFrame:
    """(source_a, source_b, family, volume, nodes): sources that meet at nodes.

    touches: (node, source, n), already summed, so a hub costs the square of its sources and not of its edges.
    families: (node, family); a node's weight is split evenly over its families.
    """
    weights = families.distinct().withColumn("w", 1 / F.count("*").over(Window.partitionBy("node")))
    a, b = touches.alias("a"), touches.alias("b")
    met = a.join(b, (F.col("a.node") == F.col("b.node")) & (F.col("a.source") < F.col("b.source"))).select(F.col("a.node").alias("node"), F.col("a.source").alias("source_a"), F.col("b.source").alias("source_b"), (F.col("a.n") * F.col("b.n")).alias("product"))
    return met.join(weights, "node").groupBy("source_a", "source_b", "family").agg(F.sum(F.col("product") * F.col("w")).alias("volume"), F.sum("w").alias("nodes"))


def backbone(pairs: DataFrame, weight: str, k: int) -> DataFrame:
    """The pairs that are among the k heaviest of either side."""
    sides = pairs.select(F.explode(F.array("source_a", "source_b")).alias("source"), "source_a", "source_b", weight)
    best = top_per_group(sides, ["source"], [F.desc(weight), F.col("source_a"), F.col("source_b")], k)
    return best.select("source_a", "source_b", weight).distinct()


def symmetric(df: DataFrame, a: str, b: str, value: str, least: float = 0) -> DataFrame:
    """Sums of both directions, without the diagonal and what stays under the cut-off."""
    both = df.where(F.col(a) != F.col(b)).groupBy(F.least(a, b).alias(a), F.greatest(a, b).alias(b)).agg(F.sum(value).alias(value))
    return both.where(F.col(value) >= least)


def held_by(long: DataFrame, key: list[str], graph: str = "graph") -> DataFrame:
    """For each key, the sorted graphs that have it: shared, unique and pairwise sets are filters of this."""
    return long.groupBy(*key).agg(F.sort_array(F.collect_set(graph)).alias("graphs"))


def margins(df: DataFrame, row: str, column: str, value: str, least: int, least_column: int | None = None) -> DataFrame:
    """Cells whose row and column both total at least so much; totals are of all cells."""
    total = lambda c: F.sum(value).over(Window.partitionBy(c))
    return df.withColumn("_r", total(row)).withColumn("_c", total(column)).where((F.col("_r") >= least) & (F.col("_c") >= (least if least_column is None else least_column))).drop("_r", "_c")


def sample_keys(df: DataFrame, key: str, n: int, seed: str = "") -> DataFrame:
    """n keys without replacement, the same ones every time: the smallest digests of seed and key."""
    return df.select(key).distinct().withColumn("_d", F.md5(F.concat(F.lit(seed), F.col(key).cast("string")))).orderBy("_d", key).limit(n).drop("_d")


def sample_graph(nodes: DataFrame, edges: DataFrame, n: int, seed: str = "") -> tuple[DataFrame, DataFrame]:
    """n edges and the nodes on them. An error if there are fewer edges."""
    keyed = edges.withColumn("_k", X.edge_key())
    some = keyed.join(sample_keys(keyed, "_k", n, seed), "_k", "left_semi").drop("_k")
    if (found := some.count()) < n:
        raise ValueError(f"{found} edges, not {n}")
    return nodes_of(nodes, some), some


def endpoints(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("subject", "object")).alias("id")).distinct()


def nodes_of(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    return nodes.join(endpoints(edges), "id", "left_semi")


def edges_from(edges: DataFrame, sources: list[str]) -> DataFrame:
    """Edges with a primary or a supporting source among these; all edges for none."""
    if not sources:
        return edges
    return edges.where(F.col("primary_knowledge_source").isin(*sources) | F.coalesce(F.arrays_overlap("supporting_data_sources", F.array(*map(F.lit, sources))), F.lit(False)))


def nodes_with_prefix(nodes: DataFrame, prefixes: list[str]) -> DataFrame:
    return nodes.where(F.exists("equivalent_ids", lambda e: X.prefix(e).isin(*prefixes)))


def shuffled_ids(nodes: DataFrame, seed: str, category: str = "category") -> DataFrame:
    """(category, id, new_id): a bijection within each category, set by the seed.

    Ranks of a category are counted in 256 parts by digest, so that a large one is no single task: a part's rank is
    its offset plus the rank within it.
    """
    parts = 256
    rank = _ranked(nodes.select(category, "id", F.md5(F.concat(F.lit("id"), "id")).alias("d")), category, parts).select(category, "id", "rank")
    image = _ranked(nodes.select(category, "id", F.md5(F.concat(F.lit(seed), "id")).alias("d")), category, parts).select(category, F.col("id").alias("new_id"), "rank")
    return rank.join(image, [category, "rank"]).select(category, "id", "new_id")


def _ranked(df: DataFrame, category: str, parts: int) -> DataFrame:
    part = F.conv(F.substring("d", 1, 2), 16, 10).cast("int")
    own = df.withColumn("part", part)
    sizes = own.groupBy(category, "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy(category).orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    inner = F.row_number().over(Window.partitionBy(category, "part").orderBy("d", "id"))
    return own.withColumn("_i", inner).join(sizes.select(category, "part", before.alias("_b")), [category, "part"]).withColumn("rank", F.col("_i") + F.col("_b")).drop("_i", "_b", "part", "d")


def shuffled_edges(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """Edges whose ends are replaced; an end without a replacement is an error."""
    s, o = (ids.select(F.col("id").alias(side), F.col("new_id").alias(f"_{side}")) for side in ("subject", "object"))
    moved = edges.join(s, "subject", "left").join(o, "object", "left")
    of = lambda side: F.coalesce(f"_{side}", F.raise_error(F.concat(F.lit("no replacement for "), F.col(side)))).alias(side)
    return moved.select(of("subject"), of("object"), *[c for c in edges.columns if c not in ("subject", "object")])


def property_profile(df: DataFrame, kind: str, properties: str, order: str) -> DataFrame:
    """(kind, property, rows, example): how many rows of a kind have a property, and its first value."""
    flat = df.select(kind, order, F.explode(properties).alias("property", "value"))
    return flat.groupBy(kind, "property").agg(F.count("*").alias("rows"), F.min_by("value", order).alias("example"))


def levels(edges: DataFrame) -> DataFrame:
    """(node, level): the longest path from a root of an acyclic graph, by relaxing its edges as often as it has steps.

    A cycle is an error: no path has as many steps as there are nodes.
    """
    from .. import staging

    nodes = edges.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
    now = staging.put(nodes.withColumn("level", F.lit(0)), "levels")
    for _ in range(now.count() + 1):
        up = edges.join(now.withColumnRenamed("node", "src"), "src").groupBy(F.col("dst").alias("node")).agg((F.max("level") + 1).alias("up"))
        new = staging.put(now.join(up, "node", "left").select("node", F.greatest("level", F.coalesce("up", F.lit(0))).alias("level"), (F.coalesce("up", F.lit(0)) > F.col("level")).alias("_moved")), "levels")
        staging.drop(now)
        now = new
        if now.where("_moved").isEmpty():
            return now.drop("_moved")
        now = now.drop("_moved")
        now._staged = new._staged
    raise ValueError("the graph has a cycle")


def remapped(df: DataFrame, c: str, least: float, name: str) -> DataFrame:
    """df with a column's values moved linearly into [least, 1]; all 1 where there is a single value."""
    low, high = df.agg(F.min(c)).scalar(), df.agg(F.max(c)).scalar()
    place = F.when(high == low, F.lit(1.0)).otherwise(F.lit(least) + (F.col(c) - low) / (high - low) * (1 - least))
    return df.withColumn(name, place)
