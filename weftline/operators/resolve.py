"""Entity resolution: sources' nodes become canonical nodes by their equivalence sets.

Components of nodes that share an id come from distributed star rounds. Within a component the order of sources
decides which node dominates, and that fold is sequential by its rules, so it runs in Python; a node alone in its
component skips it. Rows come to the fold sorted, batch by batch, so a component of any size takes only the memory of
its canonical nodes, which merging has made fewer than its rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .components import connected_components
from .merge import merge_attributes

OWN_VOTE = 9


def entity_components(nodes: DataFrame, id_col: str = "id", equivalents: str = "equivalent_ids") -> DataFrame:
    """(id, component): nodes that share equivalent ids, directly or over others, have one component."""
    pairs = nodes.select(F.col(id_col).alias("id"), F.explode(equivalents).alias("equiv_id"))
    links = pairs.select(F.concat(F.lit("n:"), "id").alias("src"), F.concat(F.lit("e:"), "equiv_id").alias("dst"))
    comp = connected_components(links)
    own = comp.where(F.startswith("node", F.lit("n:"))).select(F.substring("node", 3, 1 << 30).alias("id"), F.col("component").alias("root"))
    named = own.groupBy("root").agg(F.min("id").alias("component"))
    out = own.join(named, "root").select("id", "component")
    alone = nodes.select(F.col(id_col).alias("id")).distinct().join(out, "id", "left_anti").select("id", F.col("id").alias("component"))
    return out.unionByName(alone)


def shared_key_components(rows: DataFrame, id_col: str, keys: list[str]) -> DataFrame:
    """(id, component) of rows that agree in any of the key columns; component is the smallest id."""
    links = None
    for k in keys:
        part = rows.select(F.col(id_col).alias("id"), F.concat(F.lit(f"{k}:"), F.col(k)).alias("key"))
        links = part if links is None else links.unionByName(part)
    star = links.join(links.groupBy("key").agg(F.min("id").alias("hub")), "key").select(F.col("id").alias("src"), F.col("hub").alias("dst"))
    comp = connected_components(star).withColumnsRenamed({"node": "id"})
    alone = rows.select(F.col(id_col).alias("id")).distinct().join(comp, "id", "left_anti").select("id", F.col("id").alias("component"))
    return comp.unionByName(alone)


def majority(nodes: DataFrame, index: DataFrame, own_vote: int = OWN_VOTE) -> DataFrame:
    """(id, canonical_id, votes): the canonical node that most of a node's equivalent ids belong to.

    The node's own id counts ``own_vote`` more; of equal votes the one seen first in its list wins, then the smallest.
    """
    seen = nodes.select("id", F.posexplode("equivalent_ids").alias("position", "equiv_id")).join(index, "equiv_id")
    vote = F.sum(F.lit(1) + F.when(F.col("equiv_id") == F.col("id"), own_vote).otherwise(0))
    votes = seen.groupBy("id", "canonical_id").agg(vote.alias("votes"), F.min("position").alias("first"))
    best = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("votes"), "first", "canonical_id"))
    return votes.withColumn("place", best).where("place = 1").select("id", "canonical_id", "votes")


class Fold:
    """The ordered fold of one component: canonical nodes, and the canonical id of every equivalent id."""

    def __init__(self, ancestors: dict[str, frozenset[str]] | None = None):
        self.canonical: dict[str, dict] = {}
        self.index: dict[str, str] = {}
        self.log: list[tuple[str, str, str]] = []
        self.ancestors = ancestors or {}

    def seed(self, node: dict) -> None:
        """A node of the primary source; of an id in two of them, the later one has it."""
        self.canonical[node["id"]] = node
        for e in node["equivalent_ids"]:
            self.index[e] = node["id"]

    def merging(self, node: dict) -> None:
        """A node of a source that may unite canonical nodes."""
        hits = [self.index[e] for e in node["equivalent_ids"] if e in self.index]
        if not hits:
            self.log.append(("one_to_zero", node["id"], ""))
            self.seed(node)
            return
        counts = Counter(hits)
        target = counts.most_common(1)[0][0]
        if len(counts) > 1:
            self.log.append(("one_to_many", node["id"], "|".join(sorted(counts))))
        target = self._merge(target, node, may_dominate=True)
        for other in counts:
            if other in self.canonical and other != target:
                target = self._merge(target, self.canonical.pop(other), may_dominate=True)

    def joining(self, node: dict) -> None:
        """A node of a source that may only add to the canonical node that its ids vote for."""
        votes: dict[str, int] = {}
        for e in node["equivalent_ids"]:
            if (c := self.index.get(e)) is not None:
                votes[c] = votes.get(c, 0) + 1 + (OWN_VOTE if e == node["id"] else 0)
        if not votes:
            self.log.append(("one_to_zero", node["id"], ""))
            self.seed(node)
            return
        new = [e for e in node["equivalent_ids"] if e not in self.index]
        # A canonical node that loses the vote stays.
        self._merge(max(votes, key=votes.__getitem__), node, may_dominate=False, new_ids=new)

    def _merge(self, target: str, new: dict, may_dominate: bool, new_ids: list[str] | None = None) -> str:
        old = self.canonical[target]
        dominates = may_dominate and len(new["equivalent_ids"]) > len(old["equivalent_ids"])
        strong, weak = (new, old) if dominates else (old, new)
        ids = sorted(set(old["equivalent_ids"]) | set(new["equivalent_ids"] if new_ids is None else new_ids))
        with_synonyms = not new_ids or set(new_ids) == set(new["equivalent_ids"])
        out = dict(strong)
        for k, v in strong.items():
            w = weak.get(k)
            if k == "equivalent_ids":
                out[k] = ids
            elif k == "synonyms":
                out[k] = sorted({*(v or ()), *(w or ())}) if with_synonyms else old.get(k)
            elif isinstance(v, list) or isinstance(w, list):
                out[k] = sorted({*(v or ()), *(w or ())})
            elif v is None:
                out[k] = w
        out["categories"] = self.leaves(out["categories"])
        del self.canonical[target]
        self.canonical[out["id"]] = out
        for e in ids:
            self.index[e] = out["id"]
        return out["id"]

    def leaves(self, categories: list[str]) -> list[str]:
        return [c for c in categories if not any(c in self.ancestors.get(d, ()) for d in categories if d != c)]


#: Columns that steer the fold and are no part of a node.
CONTROL = ("phase", "source_rank", "ordinal", "component", "count")


def fold_row(fold: Fold, r: dict, columns: list[str]) -> None:
    """The next row of a component: node columns, and phase (0 primary, 1 merging, 2 joining)."""
    is_list = lambda v: hasattr(v, "__len__") and not isinstance(v, str)
    node = {c: list(r[c]) if is_list(r[c]) else None if r[c] is None or r[c] != r[c] else r[c] for c in columns}
    (fold.seed, fold.merging, fold.joining)[int(r["phase"])](node)


def fold_component(rows: pd.DataFrame, ancestors: dict[str, frozenset[str]] | None = None) -> Fold:
    """One component in memory: rows as fold_row takes them, with source_rank and ordinal."""
    fold, columns = Fold(ancestors), [c for c in rows.columns if c not in CONTROL]
    for r in rows.sort_values(["phase", "source_rank", "ordinal"], kind="stable").to_dict("records"):
        fold_row(fold, r, columns)
    return fold


def fold_output(fold: Fold) -> list[dict]:
    """A component's canonical nodes with the ids that lead to each, and the fold's log on the first."""
    held: dict[str, list[str]] = {}
    for e, c in fold.index.items():
        held.setdefault(c, []).append(e)
    log = [{"kind": k, "id": i, "others": o} for k, i, o in fold.log]
    return [{**n, "indexed": sorted(held.get(i, [])), "log": None if k else log} for k, (i, n) in enumerate(fold.canonical.items())]


class Resolved(NamedTuple):
    nodes: DataFrame
    #: (equiv_id, canonical_id)
    index: DataFrame
    #: (kind, id, others): nodes that met no canonical node, or that united several of them.
    log: DataFrame


def canonical_nodes(nodes: DataFrame, ancestors: dict[str, frozenset[str]] | None = None) -> tuple[DataFrame, DataFrame]:
    """Canonical nodes, and the index (equiv_id, canonical_id)."""
    return resolved(nodes, ancestors)[:2]


def resolved(nodes: DataFrame, ancestors: dict[str, frozenset[str]] | None = None) -> Resolved:
    """Canonical nodes, the index of equivalent ids, and the log of the fold.

    nodes: scalar and list columns of nodes, phase, source_rank and ordinal; attributes, if there, are merged by
    source and property in a plan of their own.
    """
    columns = [c for c in nodes.columns if c not in (*CONTROL, "attributes")]
    comp = entity_components(nodes)
    sizes = nodes.join(comp.dropDuplicates(["id"]), "id").groupBy("component").count()
    placed = nodes.drop("attributes").join(comp.dropDuplicates(["id"]), "id").join(sizes, "component")
    entry = "array<struct<kind:string,id:string,others:string>>"
    alone_log = F.when(F.col("phase") > 0, F.array(F.struct(F.lit("one_to_zero").alias("kind"), F.col("id").alias("id"), F.lit("").alias("others")))).cast(entry)
    alone = placed.where("count = 1").select(*columns, F.lit(None).cast("array<string>").alias("indexed"), alone_log.alias("log"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fold, component = Fold(ancestors), None
        table = lambda done: pd.DataFrame(done, columns=[*columns, "indexed", "log"])
        for rows in batches:
            done = []
            for r in rows.to_dict("records"):
                if r["component"] != component:
                    done += fold_output(fold)
                    fold, component = Fold(ancestors), r["component"]
                fold_row(fold, r, columns)
            if done:
                yield table(done)
        if component is not None:
            yield table(fold_output(fold))

    sorted_rows = placed.where("count > 1").repartition("component").sortWithinPartitions("component", "phase", "source_rank", "ordinal")
    folded = sorted_rows.mapInPandas(run, alone.schema)
    out = alone.unionByName(folded)
    index = out.select(F.explode(F.coalesce("indexed", "equivalent_ids")).alias("equiv_id"), F.col("id").alias("canonical_id"))
    log = out.select(F.explode("log").alias("l")).select("l.*")
    out = out.drop("indexed", "log")
    if "attributes" in nodes.columns:
        owned = nodes.select(F.col("id").alias("equiv_id"), "attributes").join(index, "equiv_id")
        out = out.join(merge_attributes(owned, ["canonical_id"]).withColumnRenamed("canonical_id", "id"), "id", "left")
    return Resolved(out, index, log)


def overlapping_ids(nodes: DataFrame) -> DataFrame:
    """(equiv_id, nodes): equivalent ids that more than one node has."""
    held = nodes.select("id", F.explode(F.array_distinct("equivalent_ids")).alias("equiv_id"))
    return held.groupBy("equiv_id").agg(F.count_distinct("id").alias("nodes")).where("nodes > 1")


def leaf_categories(rows: DataFrame, closure: DataFrame, key: str = "id", categories: str = "categories") -> DataFrame:
    """(key, categories) without categories that are proper ancestors of another one of the row.

    closure: (category, ancestor). Rows without any category stay out.
    """
    flat = rows.select(key, F.explode(categories).alias("category")).distinct()
    above = flat.join(closure, "category").where("category != ancestor").select(key, F.col("ancestor").alias("category")).distinct()
    return flat.join(above, [key, "category"], "left_anti").groupBy(key).agg(F.sort_array(F.collect_list("category")).alias(categories))
