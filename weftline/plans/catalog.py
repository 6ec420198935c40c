"""All queries over the driver's tables, by name, and the SQL that each must equal.

Lists come out as sorted strings, counts as bigint, and every window and limit has a total order, so that two engines
can be compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import scalars as X
from ..operators import analysis as A
from ..operators import merge as M
from ..operators import metagraph as G
from ..operators import resolve as R
from ..operators import validate as V
from ..sources import readers, sinks, spec
from . import toy

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
GRAPH = toy.GRAPH_SQL


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def joined(c) -> F.Column:
    return F.array_join(F.sort_array(F.array_distinct(c)), ",")


# Edges: keys and merging


@query(GRAPH + "SELECT subject || '---' || predicate || '---' || object || '---' || q || '---' || prim AS edge_key, count(*) AS n FROM edges GROUP BY 1")
def edge_key_build(spark, d):
    return toy.edges(spark, d).groupBy(X.edge_key().alias("edge_key")).agg(F.count("*").alias("n"))


LIST = "array_to_string(list_sort(list_distinct(list({c}) FILTER (WHERE {c} IS NOT NULL))), ',')"
KEY = "subject || '---' || predicate || '---' || object || '---' || q || '---' || prim"


@query(GRAPH + f"SELECT {KEY} AS edge_key, {LIST.format(c='agg')} AS aggregators, nullif({LIST.format(c='sup')}, '') AS supporting, nullif({LIST.format(c='pub')}, '') AS publications, count(*) AS merged_rows FROM edges GROUP BY 1")
def edge_merge_lists(spark, d):
    m = M.merge_edges(toy.edges(spark, d), with_attributes=False)
    return m.select("edge_key", joined("aggregator_knowledge_source").alias("aggregators"), joined("supporting_data_sources").alias("supporting"), joined("publications").alias("publications"), "merged_rows")


@query(GRAPH + f"SELECT {KEY} AS edge_key, coalesce(arg_min(kl, ord) FILTER (WHERE kl <> 'not_provided'), 'not_provided') AS knowledge_level, coalesce(arg_min(agent, ord) FILTER (WHERE agent <> 'not_provided'), 'not_provided') AS agent_type FROM edges GROUP BY 1")
def edge_merge_klat(spark, d):
    return M.merge_edges(toy.edges(spark, d), with_attributes=False).select("edge_key", "knowledge_level", "agent_type")


@query(GRAPH + f"SELECT edge_key, agg AS source, '[' || array_to_string(list_sort(list(quantity)), ',') || ']' AS quantities FROM (SELECT DISTINCT {KEY} AS edge_key, agg, quantity FROM edges WHERE quantity IS NOT NULL) GROUP BY 1, 2")
def attribute_merge(spark, d):
    m = M.merge_edges(toy.supplied(spark, d))
    return m.select("edge_key", F.explode("attributes").alias("source", "p")).select("edge_key", "source", F.col("p")["quantity"].alias("quantities"))


@query("SELECT event_type, user_id % 3 AS source, '[' || array_to_string(list_sort(list(DISTINCT json_extract_string(props, '$.k'))), ',') || ']' AS k FROM events GROUP BY 1, 2")
def event_attribute_merge(spark, d):
    e = toy.table(spark, d, "events").select("event_type", F.create_map((F.col("user_id") % 3).cast("string"), F.from_json("props", "map<string,string>")).alias("attributes"))
    m = M.merge_attributes(e, ["event_type"])
    return m.select("event_type", F.explode("attributes").alias("source", "p")).select("event_type", F.col("source").cast("bigint").alias("source"), F.col("p")["k"].alias("k"))


@query(GRAPH + """, idx AS (SELECT 'PART:' || p_partkey AS e, 'CANON:' || (p_partkey % 100) AS c FROM part WHERE p_partkey % 7 <> 0 UNION ALL SELECT 'SUPP:' || s_suppkey, 'SUPPC:' || (s_suppkey % 10) FROM supplier WHERE s_suppkey % 5 <> 0)
SELECT CASE WHEN s.c IS NOT NULL AND o.c IS NOT NULL THEN s.c ELSE subject END AS subject, CASE WHEN s.c IS NOT NULL AND o.c IS NOT NULL THEN o.c ELSE object END AS object, count(*) AS n FROM edges LEFT JOIN idx s ON s.e = subject LEFT JOIN idx o ON o.e = object WHERE predicate = 'rel:supplied_by' GROUP BY 1, 2""")
def canonicalize_endpoints(spark, d):
    p = toy.table(spark, d, "part").where("p_partkey % 7 != 0").select(toy.curie("PART", "p_partkey").alias("equiv_id"), F.concat(F.lit("CANON:"), (F.col("p_partkey") % 100).cast("string")).alias("canonical_id"))
    s = toy.table(spark, d, "supplier").where("s_suppkey % 5 != 0").select(toy.curie("SUPP", "s_suppkey").alias("equiv_id"), F.concat(F.lit("SUPPC:"), (F.col("s_suppkey") % 10).cast("string")).alias("canonical_id"))
    return M.canonical_endpoints(toy.supplied(spark, d).select("subject", "object"), p.unionByName(s)).groupBy("subject", "object").agg(F.count("*").alias("n"))


@query(GRAPH + "SELECT id, min(name) AS name FROM (SELECT subject AS id, 'part of ' || prim AS name FROM edges UNION ALL SELECT object, 'end of ' || predicate FROM edges) GROUP BY 1")
def stub_nodes(spark, d):
    e = toy.edges(spark, d).withColumn("a", F.concat(F.lit("part of "), "primary_knowledge_source")).withColumn("b", F.concat(F.lit("end of "), "predicate"))
    return M.stubs(e, {"subject": "a", "object": "b"}, "Thing").select("id", "name")


# Statistics

META = GRAPH + ", known AS (SELECT s.categories AS sc, e.*, o.categories AS oc FROM edges e JOIN nodes s ON s.id = e.subject JOIN nodes o ON o.id = e.object), triples AS (SELECT a AS subject_category, predicate, b AS object_category, count(*) AS edge_count FROM (SELECT unnest(sc) AS a, predicate, oc FROM known) x, unnest(oc) AS t(b) GROUP BY ALL) "


@query(META + "SELECT * FROM triples")
def meta_triples(spark, d):
    return G.meta_edges(toy.edges(spark, d), toy.nodes(spark, d))


@query(GRAPH + ", merged AS (SELECT DISTINCT subject, predicate, object, q, prim FROM edges) SELECT a AS subject_category, predicate, b AS object_category, count(*) AS edge_count FROM (SELECT unnest(s.categories) AS a, e.predicate, o.categories AS oc FROM merged e JOIN nodes s ON s.id = e.subject JOIN nodes o ON o.id = e.object) x, unnest(oc) AS t(b) GROUP BY ALL")
def merged_meta_triples(spark, d):
    """Duplicate edges merged, then pairs of categories counted; merged edges count once."""
    return G.meta_edges(M.merge_edges(toy.edges(spark, d), with_attributes=False), toy.nodes(spark, d))


@query(META + "SELECT subject_category, object_category, CAST(sum(edge_count) AS BIGINT) AS edge_count FROM triples GROUP BY ALL")
def meta_doubles(spark, d):
    return G.meta_doubles(toy.edges(spark, d), toy.nodes(spark, d))


@query(META + "SELECT *, CAST(sum(edge_count) OVER (PARTITION BY subject_category) AS BIGINT) AS subject_total, CAST(sum(edge_count) OVER (PARTITION BY subject_category, predicate) AS BIGINT) AS predicate_total FROM triples")
def meta_nested_order(spark, d):
    return G.nested_order(G.meta_edges(toy.edges(spark, d), toy.nodes(spark, d)))


@query(f"WITH {toy.NODES_SQL} SELECT c AS category, count(*) AS count FROM nodes, unnest(categories) AS t(c) GROUP BY 1")
def category_counts(spark, d):
    return G.category_counts(toy.nodes(spark, d))


@query(f"WITH {toy.NODES_SQL} SELECT split_part(e, ':', 1) AS prefix, count(*) AS count FROM nodes, unnest(equivalent_ids) AS t(e) GROUP BY 1")
def prefix_counts(spark, d):
    return G.prefix_counts(toy.nodes(spark, d))


@query(META + "SELECT predicate, count(*) AS count FROM known GROUP BY 1")
def predicate_counts(spark, d):
    return G.counted(G.with_categories(toy.edges(spark, d), toy.nodes(spark, d)), "predicate")


@query(GRAPH + "SELECT 'primary' AS role, prim AS source, count(*) AS edge_count FROM edges GROUP BY ALL UNION ALL SELECT 'aggregator', agg, count(*) FROM edges GROUP BY ALL UNION ALL SELECT 'supporting', sup, count(*) FROM edges WHERE sup IS NOT NULL GROUP BY ALL")
def source_counts(spark, d):
    return G.source_counts(toy.edges(spark, d))


@query(GRAPH + "SELECT kl AS knowledge_level, agent AS agent_type, count(*) AS edge_count FROM edges GROUP BY ALL")
def klat_joint(spark, d):
    return G.klat_counts(toy.edges(spark, d))


@query(GRAPH + "SELECT kl AS knowledge_level, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 4) AS share, round(sum(CASE kl WHEN 'knowledge_assertion' THEN 1.0 WHEN 'prediction' THEN 0.6 ELSE 0.5 END * CASE agent WHEN 'manual_agent' THEN 1.0 WHEN 'automated_agent' THEN 0.8 WHEN 'text_mining_agent' THEN 0.6 ELSE 0.5 END) / count(*), 6) AS confidence FROM edges GROUP BY 1")
def klat_confidence(spark, d):
    weight = lambda c, table: F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), F.col(c)), F.lit(0.5))
    level, agent = weight("knowledge_level", {"knowledge_assertion": 1.0, "prediction": 0.6}), weight("agent_type", {"manual_agent": 1.0, "automated_agent": 0.8, "text_mining_agent": 0.6})
    pairs = G.klat_counts(toy.edges(spark, d))
    by = pairs.groupBy("knowledge_level").agg(F.sum("edge_count").alias("n"), F.sum(F.col("edge_count") * level * agent).alias("w"))
    return by.select("knowledge_level", "n", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1))), 4).alias("share"), F.round(F.col("w") / F.col("n"), 6).alias("confidence"))


@query(META + """SELECT 'nodes' AS measure, count(*) AS value FROM nodes UNION ALL SELECT 'edges', count(*) FROM edges UNION ALL SELECT 'node_categories', count(DISTINCT c) FROM nodes, unnest(categories) AS t(c)
UNION ALL SELECT 'node_prefixes', count(DISTINCT split_part(e, ':', 1)) FROM nodes, unnest(equivalent_ids) AS t(e) UNION ALL SELECT 'edge_predicates', count(DISTINCT predicate) FROM known UNION ALL SELECT 'klat_pairs', count(*) FROM (SELECT DISTINCT kl, agent FROM known)
UNION ALL SELECT 'primary_sources', count(DISTINCT prim) FROM edges UNION ALL SELECT 'meta_doubles', count(*) FROM (SELECT DISTINCT subject_category, object_category FROM triples) UNION ALL SELECT 'meta_triples', count(*) FROM triples""")
def graph_summary(spark, d):
    return G.graph_summary(toy.nodes(spark, d), toy.edges(spark, d))


@query(GRAPH + f"SELECT 'nodes' AS item, CAST(0 AS BIGINT) AS merged UNION ALL SELECT 'edges', count(*) FROM (SELECT {KEY} FROM edges GROUP BY 1 HAVING count(DISTINCT agg) > 1)")
def merged_counts(spark, d):
    return G.merged_counts(toy.nodes(spark, d), M.merge_edges(toy.edges(spark, d), with_attributes=False))


# Entity resolution

ER_SQL = """WITH RECURSIVE k AS (SELECT p_partkey AS id, 'a:' || p_name || '|' || p_brand || '|' || p_type AS key FROM part UNION ALL SELECT p_partkey, 'b:' || p_brand || '|' || p_type || '|' || p_size FROM part),
hub AS (SELECT k.id, h.hub FROM k JOIN (SELECT key, min(id) AS hub FROM k GROUP BY key) h USING (key)), e AS (SELECT id AS x, hub AS y FROM hub UNION SELECT hub, id FROM hub),
reach(id, component) AS (SELECT p_partkey, p_partkey FROM part UNION SELECT e.y, r.component FROM reach r JOIN e ON e.x = r.id) SELECT id, min(component) AS component FROM reach GROUP BY id"""


@query(ER_SQL)
def er_components(spark, d):
    p = toy.table(spark, d, "part")
    keys = p.select(F.col("p_partkey").alias("id"), F.concat_ws("|", "p_name", "p_brand", "p_type").alias("a"), F.concat_ws("|", "p_brand", "p_type", F.col("p_size").cast("string")).alias("b"))
    return R.shared_key_components(keys, "id", ["a", "b"])


def _ranked_parts(spark, d):
    n = toy.part_nodes(spark, d).withColumn("key", F.substring_index("id", ":", -1).cast("int"))
    return n.withColumn("phase", F.lit(1)).withColumn("source_rank", F.col("key") % 2).withColumn("ordinal", F.lpad(F.col("key").cast("string"), 12, "0"))


@query()
def er_canonical(spark, d):
    """The ordered fold; held against a sequential model in tests."""
    nodes, _ = R.canonical_nodes(_ranked_parts(spark, d))
    return nodes.select("id", "name", joined("categories").alias("categories"), F.size("equivalent_ids").alias("ids"))


@query("""WITH v AS (SELECT l_partkey AS part, r_name AS canonical, count(*) + CASE WHEN min(l_suppkey) % 10 = 0 THEN 9 ELSE 0 END AS votes, min(lpad(CAST(l_orderkey AS VARCHAR), 12, '0') || lpad(CAST(l_linenumber AS VARCHAR), 3, '0')) AS first
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY ALL)
SELECT part, canonical, votes FROM (SELECT *, row_number() OVER (PARTITION BY part ORDER BY votes DESC, first, canonical) AS place FROM v) WHERE place = 1""")
def majority_vote(spark, d):
    region = toy.table(spark, d, "supplier").join(toy.table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(toy.table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    seen = toy.table(spark, d, "lineitem").join(region.select("s_suppkey", "r_name"), F.col("l_suppkey") == F.col("s_suppkey"))
    first = F.concat(F.lpad(F.col("l_orderkey").cast("string"), 12, "0"), F.lpad(F.col("l_linenumber").cast("string"), 3, "0"))
    votes = seen.groupBy(F.col("l_partkey").alias("part"), F.col("r_name").alias("canonical")).agg((F.count("*") + F.when(F.min("l_suppkey") % 10 == 0, 9).otherwise(0)).alias("votes"), F.min(first).alias("first"))
    return A.first_per_key(votes, ["part"], [F.desc("votes"), F.col("first"), F.col("canonical")]).select("part", "canonical", "votes")


@query("""WITH n AS (SELECT 'PART:' || p_partkey AS id, ['PART:' || p_partkey, 'A:' || p_name || '|' || p_brand || '|' || p_type, 'B:' || p_brand || '|' || p_type || '|' || p_size] AS eq FROM part),
idx AS (SELECT 'A:' || p_name || '|' || p_brand || '|' || p_type AS e, 'NAME:' || p_name AS c FROM part GROUP BY ALL UNION ALL SELECT 'B:' || p_brand || '|' || p_type || '|' || p_size, 'SIZE:' || p_size FROM part GROUP BY ALL UNION ALL SELECT 'PART:' || p_partkey, 'SELF:' || (p_partkey % 50) FROM part WHERE p_partkey % 3 = 0),
v AS (SELECT id, c, sum(1 + CASE WHEN e = id THEN 9 ELSE 0 END) AS votes, min(pos) AS first FROM (SELECT id, unnest(eq) AS e, generate_subscripts(eq, 1) - 1 AS pos FROM n) x JOIN idx USING (e) GROUP BY ALL)
SELECT id, c AS canonical_id, CAST(votes AS BIGINT) AS votes FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY votes DESC, first, c) AS place FROM v) WHERE place = 1""")
def majority_canonical(spark, d):
    n, p = toy.part_nodes(spark, d), toy.table(spark, d, "part")
    a = p.select(F.concat(F.lit("A:"), F.concat_ws("|", "p_name", "p_brand", "p_type")).alias("equiv_id"), F.concat(F.lit("NAME:"), "p_name").alias("canonical_id")).distinct()
    b = p.select(F.concat(F.lit("B:"), F.concat_ws("|", "p_brand", "p_type", F.col("p_size").cast("string"))).alias("equiv_id"), F.concat(F.lit("SIZE:"), F.col("p_size").cast("string")).alias("canonical_id")).distinct()
    own = p.where("p_partkey % 3 = 0").select(toy.curie("PART", "p_partkey").alias("equiv_id"), F.concat(F.lit("SELF:"), (F.col("p_partkey") % 50).cast("string")).alias("canonical_id"))
    return R.majority(n, a.unionByName(b).unionByName(own))


@query("WITH e AS (SELECT 'A:' || p_name || '|' || p_brand || '|' || p_type AS equiv_id, p_partkey FROM part UNION ALL SELECT 'B:' || p_brand || '|' || p_type || '|' || p_size, p_partkey FROM part) SELECT equiv_id, count(DISTINCT p_partkey) AS nodes FROM e GROUP BY 1 HAVING count(DISTINCT p_partkey) > 1")
def equiv_overlap(spark, d):
    return R.overlapping_ids(toy.part_nodes(spark, d))


CLOSURE = "(SELECT DISTINCT 'n:' || n_name AS category, 'r:' || r_name AS ancestor FROM nation JOIN region ON r_regionkey = n_regionkey)"


@query(f"""WITH closure AS {CLOSURE}, cats AS (SELECT c_custkey, 'n:' || n_name AS c FROM customer JOIN nation ON n_nationkey = c_nationkey UNION SELECT c_custkey, 'r:' || r.r_name FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region r ON r.r_regionkey = CASE WHEN c_custkey % 2 = 0 THEN n_regionkey ELSE (n_regionkey + 1) % 5 END)
SELECT c_custkey AS id, array_to_string(list_sort(list(c)), ',') AS categories FROM cats x WHERE NOT EXISTS (SELECT 1 FROM cats y JOIN closure ON y.c = closure.category WHERE y.c_custkey = x.c_custkey AND closure.ancestor = x.c) GROUP BY 1""")
def leaf_categories(spark, d):
    nation, region = toy.table(spark, d, "nation"), toy.table(spark, d, "region")
    closure = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.concat(F.lit("n:"), "n_name").alias("category"), F.concat(F.lit("r:"), "r_name").alias("ancestor"))
    c = toy.table(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    c = c.withColumn("r", F.when(F.col("c_custkey") % 2 == 0, F.col("n_regionkey")).otherwise((F.col("n_regionkey") + 1) % 5)).join(region, F.col("r") == F.col("r_regionkey"))
    rows = c.select(F.col("c_custkey").alias("id"), F.array(F.concat(F.lit("n:"), "n_name"), F.concat(F.lit("r:"), "r_name")).alias("categories"))
    return R.leaf_categories(rows, closure).select("id", F.array_join("categories", ",").alias("categories"))


# Validation


@query(GRAPH + ", kept AS (SELECT * FROM nodes WHERE NOT (provider = 'part' AND CAST(split_part(id, ':', 2) AS INT) % 10 = 3)) SELECT side AS subtype, id, count(*) AS n FROM (SELECT 'subject' AS side, subject AS id FROM edges WHERE subject NOT IN (SELECT id FROM kept) UNION ALL SELECT 'object', object FROM edges WHERE object NOT IN (SELECT id FROM kept)) GROUP BY ALL")
def orphan_edges(spark, d):
    kept = toy.nodes(spark, d).where("NOT (provided_by[0] = 'part' AND CAST(substring_index(id, ':', -1) AS INT) % 10 = 3)")
    return M.orphans(toy.edges(spark, d).select("subject", "object"), kept).groupBy("subtype", "id").agg(F.count("*").alias("n"))


@query(GRAPH + """, known AS (SELECT * FROM nodes WHERE id NOT LIKE 'SUPP:%7'), errors AS (
 SELECT 'orphan_edge' AS error_type, 'subject' AS subtype FROM edges WHERE subject NOT IN (SELECT id FROM known) UNION ALL SELECT 'orphan_edge', 'object' FROM edges WHERE object NOT IN (SELECT id FROM known)
 UNION ALL SELECT 'invalid_knowledge_level', NULL FROM edges WHERE kl NOT IN ('not_provided', 'prediction') UNION ALL SELECT 'invalid_agent_type', NULL FROM edges WHERE agent = 'text_mining_agent'
 UNION ALL SELECT 'invalid_predicate', predicate FROM edges WHERE predicate <> 'rel:placed'
 UNION ALL SELECT 'invalid_category_format', c FROM known, unnest(categories) AS t(c) WHERE NOT regexp_matches(c, '^rel:[A-Z][a-zA-Z]*$')
 UNION ALL SELECT 'overlapping_equiv_ids', NULL FROM (SELECT DISTINCT x.id FROM (SELECT id, unnest(equivalent_ids) AS e FROM nodes) x JOIN (SELECT id, unnest(equivalent_ids) AS e FROM nodes) y ON x.e = y.e AND y.id < x.id))
SELECT error_type, subtype, count(*) AS errors FROM errors GROUP BY ALL""")
def validation_errors(spark, d):
    nodes, edges = toy.nodes(spark, d), toy.edges(spark, d)
    known = nodes.where("id NOT LIKE 'SUPP:%7'")
    predicates = spark.createDataFrame([("rel:placed",)], "predicate string")
    agents = ["not_provided", "manual_agent", "automated_agent", "1-urgent", "2-high", "3-medium", "4-not_specified", "5-low"]
    out = V.edge_errors(edges.drop("source_rank", "ordinal"), known, predicates, ["not_provided", "prediction"], agents, scheme="rel").unionByName(V.node_errors(known, scheme="rel")).unionByName(V.overlap_errors(nodes, F.col("id")))
    plain = F.when(~F.col("error_type").isin("invalid_knowledge_level", "invalid_agent_type", "overlapping_equiv_ids"), F.col("subtype")).alias("subtype")
    return out.groupBy("error_type", plain).agg(F.count("*").alias("errors"))


# Filters and projections


@query("SELECT o_orderkey FROM orders WHERE NOT (CASE WHEN o_orderkey % 4 = 0 THEN 'False' WHEN o_orderkey % 4 = 1 THEN 'true' WHEN o_orderkey % 4 = 2 THEN NULL ELSE ' Yes ' END IN ('true', ' Yes ')) OR o_orderkey % 4 = 2")
def negated_filter(spark, d):
    n = F.col("o_orderkey") % 4
    flag = F.when(n == 0, "False").when(n == 1, "true").when(n == 2, F.lit(None)).otherwise(" Yes ")
    return toy.table(spark, d, "orders").withColumn("negated", flag).where(~X.truthy_string("negated")).select("o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE NOT (o_orderkey % 5 = 0 OR o_orderkey % 5 = 1)")
def source_exclusion(spark, d):
    """0: no primary source, 1: the excluded one, 2: it and another, others: another."""
    n = F.col("o_orderkey") % 5
    lists = F.when(n == 0, F.lit(None).cast("array<string>")).when(n == 1, F.array(F.lit("u"))).when(n == 2, F.array(F.lit("u"), F.lit("v"))).otherwise(F.array(F.lit("w")))
    s = spec.SourceSpec("toy", excluded_primaries=("u",))
    return toy.table(spark, d, "orders").withColumn("p", lists).where(~spec.excluded(F.col("p"), s)).select("o_orderkey")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k, 'event_type' AS attribute, event_type AS attribute_value, lower('Value_Qualifier') AS qualifier, CAST(user_id AS VARCHAR) AS qualifier_value FROM events")
def attr_split(spark, d):
    e = toy.table(spark, d, "events").select("event_id", "props", "event_type", F.col("user_id").cast("string").alias("Value_Qualifier"))
    attributes, qualifiers = spec.split_columns(e, {"event_id", "props"}, (), {})
    a, q = spec.property_map(e, attributes, {}), spec.property_map(e, qualifiers, {}, lower=True)
    value = lambda m: F.get_json_object(F.concat(F.lit('{"v":'), F.map_values(m)[0], F.lit("}")), "$.v")
    out = e.withColumn("a", a).withColumn("q", q)
    return out.select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"), F.map_keys("a")[0].alias("attribute"), value(F.col("a")).alias("attribute_value"), F.map_keys("q")[0].alias("qualifier"), value(F.col("q")).alias("qualifier_value"))


@query("SELECT p_partkey, len(string_split(p_name, ' ')) AS words, string_split(p_name, ' ')[1] AS first, string_split(p_name, ' ')[-1] AS last FROM part")
def list_split_tsv(spark, d):
    p = readers.split_lists(toy.table(spark, d, "part").select("p_partkey", "p_name", "p_brand"), " ", ("p_brand",))
    return p.select("p_partkey", F.size("p_name").cast("bigint").alias("words"), F.element_at("p_name", 1).alias("first"), F.element_at("p_name", -1).alias("last"))


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'filled' ELSE o_orderstatus END AS status, CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN 'rush' ELSE o_orderpriority END AS priority FROM orders")
def override_map(spark, d):
    pair = F.when((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F"), "rush").otherwise(F.col("o_orderpriority"))
    return toy.table(spark, d, "orders").select("o_orderkey", X.mapped("o_orderstatus", {"O": "open", "F": "filled"}).alias("status"), pair.alias("priority"))


@query(GRAPH + "SELECT subject, object, prim AS primary_knowledge_source, 'infores:toy' AS aggregator, 'infores:default' AS supporting, CASE WHEN kl = 'not_provided' THEN 'not_provided' ELSE kl END AS knowledge_level, CASE WHEN prim = 'src:1' THEN NULL ELSE pub END AS publications FROM edges WHERE predicate = 'rel:supplied_by' AND prim <> 'src:none'")
def harmonized_edges(spark, d):
    raw = toy.supplied(spark, d).select("subject", "object", "predicate", "primary_knowledge_source", F.replace("knowledge_level", F.lit("not_provided"), F.lit("unspecified")).alias("knowledge_level"), "agent_type", "publications")
    s = spec.SourceSpec("toy", default_supporting=("infores:default",), unreliable=("src:1",), excluded_primaries=("src:none",))
    e = spec.edges(s, raw)
    return e.select("subject", "object", "primary_knowledge_source", joined("aggregator_knowledge_source").alias("aggregator"), joined("supporting_data_sources").alias("supporting"), "knowledge_level", F.array_join("publications", ",").alias("publications"))


@query("SELECT 'PART:' || p_partkey AS id, p_name AS name, CASE p_type WHEN 'PROMO' THEN 'Promotion' ELSE p_type END AS categories, array_to_string(list_sort(list_distinct([p_brand, p_name])), ',') AS synonyms, array_to_string(list_sort(['PART:' || p_partkey, 'X:' || p_size]), ',') AS equivalent_ids, p_retailprice AS exact_mass FROM part")
def harmonized_nodes(spark, d):
    p = toy.table(spark, d, "part").select(toy.curie("PART", "p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_type").alias("category"), F.array(F.concat(F.lit("X:"), F.col("p_size").cast("string")), F.lit("INCHI:dropped")).alias("xref"), F.col("p_brand").alias("synonym"), F.col("p_retailprice").alias("mass"))
    n = spec.nodes(spec.SourceSpec("toy", equivalents="xref", synonyms=("synonym",), mass="mass", description=None, category_overrides={"PROMO": "Promotion"}), p)
    return n.select("id", "name", joined("categories").alias("categories"), joined("synonyms").alias("synonyms"), joined("equivalent_ids").alias("equivalent_ids"), "exact_mass")


@query("SELECT o_orderkey, 'p' || (o_orderkey % 3) AS primary_source, array_to_string(list_sort(['infores:toy', 'q' || (o_orderkey % 2)]), ',') AS aggregators, 's' AS supporting FROM orders")
def trapi_sources(spark, d):
    one = lambda i, r: F.struct(i.alias("resource_id"), F.lit(r).alias("resource_role"))
    n = F.col("o_orderkey")
    roled = F.array(one(F.concat(F.lit("p"), (n % 3).cast("string")), "primary_knowledge_source"), one(F.concat(F.lit("q"), (n % 2).cast("string")), "aggregator_knowledge_source"), one(F.lit("s"), "supporting_data_source"), one(F.lit("t"), "unknown_role"))
    raw = toy.table(spark, d, "orders").select(n.cast("string").alias("subject"), F.lit("x").alias("object"), F.lit("rel:y").alias("predicate"), roled.alias("sources"))
    e = spec.edges(spec.SourceSpec("toy"), raw)
    return e.select(F.col("subject").cast("bigint").alias("o_orderkey"), F.col("primary_knowledge_source").alias("primary_source"), joined("aggregator_knowledge_source").alias("aggregators"), joined("supporting_data_sources").alias("supporting"))


# Windows, ranks and ranges


@query("SELECT l_partkey, l_orderkey, l_linenumber, l_extendedprice, rank FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_suppkey) AS rank FROM lineitem) WHERE rank <= 3")
def top_n_per_group(spark, d):
    t = A.top_per_group(toy.table(spark, d, "lineitem"), ["l_partkey"], [F.desc("l_extendedprice"), F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_suppkey")], 3)
    return t.select("l_partkey", "l_orderkey", "l_linenumber", "l_extendedprice", F.col("rank").cast("bigint").alias("rank"))


@query("WITH g AS (SELECT l_suppkey AS trait, l_partkey AS score, count(*) AS n FROM lineitem GROUP BY ALL) SELECT trait, score, n FROM (SELECT *, row_number() OVER (PARTITION BY trait ORDER BY n DESC, score) AS place FROM g WHERE n >= 2) WHERE place = 1")
def gated_top_one(spark, d):
    g = toy.table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("trait"), F.col("l_partkey").alias("score")).agg(F.count("*").alias("n")).where("n >= 2")
    return A.first_per_key(g, ["trait"], [F.desc("n"), F.col("score")])


@query("SELECT l_suppkey, count(*) FILTER (WHERE rank <= 100) AS edges, count(*) AS genes FROM (SELECT l_suppkey, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey) AS rank FROM lineitem) WHERE rank <= 300 GROUP BY 1")
def rank_cutoff(spark, d):
    t = A.top_per_group(toy.table(spark, d, "lineitem"), ["l_suppkey"], [F.desc("l_extendedprice"), F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")], 300)
    return t.groupBy("l_suppkey").agg(F.count_if(F.col("rank") <= 100).alias("edges"), F.count("*").alias("genes"))


@query("WITH g AS (SELECT l_suppkey, l_partkey, count(*) AS n, round(sum(l_quantity), 4) AS total FROM lineitem GROUP BY ALL) SELECT l_suppkey, l_partkey, n, total FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY total DESC, l_partkey) AS place FROM g) WHERE place <= 5")
def top_groups_by_sum(spark, d):
    g = toy.table(spark, d, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 4).alias("total"))
    return A.top_per_group(g, ["l_suppkey"], [F.desc("total"), F.col("l_partkey")], 5).drop("rank")


@query("SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey FROM orders GROUP BY 1")
def first_wins(spark, d):
    return A.first_per_key(toy.table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")]).select("o_custkey", "o_orderkey")


@query("SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey FROM orders GROUP BY 1")
def last_wins(spark, d):
    return A.first_per_key(toy.table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]).select("o_custkey", "o_orderkey")


@query("""WITH iv AS (SELECT user_id, event_id AS iv, epoch(ts)::BIGINT AS a, epoch(ts)::BIGINT + 3600 * (1 + event_id % 48) AS b FROM events WHERE event_type = 'purchase')
SELECT e.event_id, iv.iv FROM (SELECT *, epoch(ts)::BIGINT AS t FROM events) e JOIN iv ON e.user_id = iv.user_id AND e.t BETWEEN iv.a AND iv.b""")
def range_join(spark, d):
    e = toy.table(spark, d, "events").withColumn("t", F.floor(F.round(F.unix_micros(F.col("ts").cast("timestamp")) / 1e6)).cast("long"))
    iv = e.where("event_type = 'purchase'").select("user_id", F.col("event_id").alias("iv"), F.col("t").alias("a"), (F.col("t") + 3600 * (1 + F.col("event_id") % 48)).alias("b"))
    return A.range_join(e.select("user_id", "event_id", "t"), iv, "user_id", "t", "a", "b", 86400).select("event_id", "iv")


@query("WITH v AS (SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, round(l_quantity * l_quantity * 2 * f * (1 - f), 6) AS variance FROM (SELECT *, CASE WHEN l_discount > 0 AND l_discount < 1 THEN l_discount ELSE 0.5 END AS f FROM lineitem)) SELECT l_suppkey, l_orderkey, l_linenumber, variance FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY variance DESC, l_orderkey, l_linenumber, l_partkey) AS place FROM v) WHERE place <= 10")
def variance_rank(spark, d):
    v = toy.table(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", F.round(X.variance_share("l_quantity", "l_discount"), 6).alias("variance"))
    return A.top_per_group(v, ["l_suppkey"], [F.desc("variance"), F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")], 10).select("l_suppkey", "l_orderkey", "l_linenumber", "variance")


@query("SELECT p_type, n, round(CASE WHEN hi = lo THEN 1.0 ELSE 0.25 + (n - lo) / (hi - lo) * 0.75 END, 6) AS weight FROM (SELECT p_type, CAST(count(*) AS DOUBLE) AS n, CAST(min(count(*)) OVER () AS DOUBLE) AS lo, CAST(max(count(*)) OVER () AS DOUBLE) AS hi FROM part GROUP BY 1)")
def weight_remap(spark, d):
    c = toy.table(spark, d, "part").groupBy("p_type").agg(F.count("*").cast("double").alias("n"))
    return A.remapped(c, "n", 0.25, "weight").withColumn("weight", F.round("weight", 6))


@query("SELECT l_suppkey, l_linenumber, n FROM (SELECT l_suppkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL) ORDER BY n DESC, l_suppkey, l_linenumber LIMIT 20")
def top_k_counts(spark, d):
    return toy.table(spark, d, "lineitem").groupBy("l_suppkey", "l_linenumber").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "l_suppkey", "l_linenumber").limit(20)


@query("SELECT l_suppkey, round(quantile_cont(l_quantity, 0.9), 6) AS p90 FROM lineitem GROUP BY 1")
def weight_percentile(spark, d):
    return toy.table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.round(F.percentile("l_quantity", 0.9), 6).alias("p90"))


# Handoffs and families

HANDOFF = """WITH touch AS (SELECT l_partkey AS node, 's' || lpad(CAST(l_suppkey % 25 AS VARCHAR), 2, '0') AS source, count(*) AS n FROM lineitem GROUP BY ALL), fam AS (SELECT p_partkey AS node, p_type AS family FROM part UNION SELECT p_partkey, p_brand FROM part WHERE p_size > 25),
w AS (SELECT node, family, 1.0 / count(*) OVER (PARTITION BY node) AS w FROM fam), pairs AS (SELECT a.source AS source_a, b.source AS source_b, family, sum(a.n * b.n * w) AS volume, sum(w) AS nodes FROM touch a JOIN touch b ON a.node = b.node AND a.source < b.source JOIN w ON w.node = a.node GROUP BY ALL) """


def _pairs(spark, d):
    source = F.concat(F.lit("s"), F.lpad((F.col("l_suppkey") % 25).cast("string"), 2, "0"))
    touch = toy.table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("node"), source.alias("source")).agg(F.count("*").alias("n"))
    p = toy.table(spark, d, "part")
    fam = p.select(F.col("p_partkey").alias("node"), F.col("p_type").alias("family")).unionByName(p.where("p_size > 25").select(F.col("p_partkey").alias("node"), F.col("p_brand").alias("family")))
    return A.handoff_pairs(touch, fam)


@query(HANDOFF + "SELECT source_a, source_b, family, round(CAST(volume AS DOUBLE), 3) AS volume, round(CAST(nodes AS DOUBLE), 3) AS nodes FROM pairs")
def handoff_pairs(spark, d):
    return _pairs(spark, d).select("source_a", "source_b", "family", F.round("volume", 3).alias("volume"), F.round("nodes", 3).alias("nodes"))


@query(HANDOFF + """, total AS (SELECT source_a, source_b, round(CAST(sum(volume) AS DOUBLE), 3) AS volume FROM pairs GROUP BY ALL), sides AS (SELECT source_a AS source, * FROM total UNION ALL SELECT source_b, * FROM total)
SELECT DISTINCT source_a, source_b, volume FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY volume DESC, source_a, source_b) AS place FROM sides) WHERE place <= 2""")
def handoff_backbone(spark, d):
    total = _pairs(spark, d).groupBy("source_a", "source_b").agg(F.round(F.sum("volume"), 3).alias("volume"))
    return A.backbone(total, "volume", 2)


@query(HANDOFF + "SELECT source_a, source_b, family FROM (SELECT *, row_number() OVER (PARTITION BY source_a, source_b ORDER BY round(CAST(volume AS DOUBLE), 3) DESC, family) AS place FROM pairs) WHERE place = 1")
def dominant_family(spark, d):
    return A.first_per_key(_pairs(spark, d).withColumn("v", F.round("volume", 3)), ["source_a", "source_b"], [F.desc("v"), F.col("family")]).select("source_a", "source_b", "family")


FAMILY = "CASE WHEN lower({c}) LIKE '%product%' OR lower({c}) LIKE '%supplier%' THEN 'trade' WHEN regexp_matches(lower({c}), 'organization|building|machinery|household|furniture|automobile') THEN 'party' WHEN lower({c}) LIKE '%event%' THEN 'activity' ELSE 'other' END"


@query(META + f", f AS (SELECT {FAMILY.format(c='subject_category')} AS a, {FAMILY.format(c='object_category')} AS b, edge_count FROM triples) SELECT CASE WHEN a = b THEN 'within' ELSE 'cross' END AS kind, CAST(sum(edge_count) AS BIGINT) AS instances, count(*) AS triples, round(100.0 * sum(edge_count) / sum(sum(edge_count)) OVER (), 4) AS share FROM f GROUP BY 1")
def cross_family(spark, d):
    t = G.meta_edges(toy.edges(spark, d), toy.nodes(spark, d))
    of = lambda c: X.classified(c, toy.FAMILIES, "other")
    kind = F.when(of("subject_category") == of("object_category"), "within").otherwise("cross")
    g = t.groupBy(kind.alias("kind")).agg(F.sum("edge_count").alias("instances"), F.count("*").alias("triples"))
    return g.withColumn("share", F.round(100.0 * F.col("instances") / F.sum("instances").over(Window.partitionBy(F.lit(1))), 4))


@query(META + "SELECT category, CAST(sum(edge_count) AS BIGINT) AS involvement FROM (SELECT subject_category AS category, edge_count FROM triples UNION ALL SELECT object_category, edge_count FROM triples) GROUP BY 1")
def category_involvement(spark, d):
    t = G.meta_doubles(toy.edges(spark, d), toy.nodes(spark, d))
    return t.select(F.explode(F.array("subject_category", "object_category")).alias("category"), "edge_count").groupBy("category").agg(F.sum("edge_count").alias("involvement"))


MATRIX = "SELECT c.n_name AS a, s.n_name AS b, count(*) AS n FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey JOIN supplier ON s_suppkey = l_suppkey JOIN nation c ON c.n_nationkey = c_nationkey JOIN nation s ON s.n_nationkey = s_nationkey GROUP BY ALL"


@query(f"SELECT least(a, b) AS a, greatest(a, b) AS b, CAST(sum(n) AS BIGINT) AS n FROM ({MATRIX}) WHERE a <> b GROUP BY 1, 2 HAVING sum(n) >= 20")
def symmetric_matrix(spark, d):
    t = lambda n: toy.table(spark, d, n)
    c = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("n_name").alias("a"))
    s = t("supplier").join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.col("n_name").alias("b"))
    o = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey")).join(s, F.col("l_suppkey") == F.col("s_suppkey"))
    return A.symmetric(o.groupBy("a", "b").agg(F.count("*").alias("n")), "a", "b", "n", 20)


VOCAB = f"WITH {toy.NODES_SQL}, vc AS (SELECT v AS vocabulary, c AS category, count(*) AS n FROM (SELECT list_distinct(list_transform(equivalent_ids, lambda e: split_part(e, ':', 1))) AS vs, categories FROM nodes) x, unnest(vs) AS t(v), unnest(categories) AS u(c) GROUP BY ALL) "


def _vocabularies(spark, d):
    n = toy.nodes(spark, d).select(F.array_distinct(F.transform("equivalent_ids", X.prefix_or_unknown)).alias("v"), "categories")
    return n.select(F.explode("v").alias("vocabulary"), "categories").select("vocabulary", F.explode("categories").alias("category")).groupBy("vocabulary", "category").agg(F.count("*").alias("n"))


@query(VOCAB + "SELECT * FROM vc")
def vocab_category(spark, d):
    return _vocabularies(spark, d)


@query(VOCAB + "SELECT vocabulary, category, n FROM (SELECT *, sum(n) OVER (PARTITION BY vocabulary) AS r, sum(n) OVER (PARTITION BY category) AS c FROM vc) WHERE r >= 500 AND c >= 700")
def margin_filter(spark, d):
    return A.margins(_vocabularies(spark, d), "vocabulary", "category", "n", 500, 700)


@query(VOCAB + "SELECT vocabulary, CAST(sum(n) AS BIGINT) AS total, count(DISTINCT category) AS categories, sum(n) >= 1000 AS large FROM vc GROUP BY 1")
def vocab_totals(spark, d):
    return _vocabularies(spark, d).groupBy("vocabulary").agg(F.sum("n").alias("total"), F.count_distinct("category").alias("categories"), (F.sum("n") >= 1000).alias("large"))


@query(VOCAB + f"SELECT {FAMILY.format(c='category')} AS theme, CAST(sum(n) AS BIGINT) AS total, round(ln(1 + sum(n)), 6) AS height FROM vc GROUP BY 1")
def theme_totals(spark, d):
    g = _vocabularies(spark, d).groupBy(X.classified("category", toy.FAMILIES, "other").alias("theme")).agg(F.sum("n").alias("total"))
    return g.withColumn("height", F.round(X.scaled("total", "log"), 6))


# Comparison of graphs: events of four quarters of a month stand for graphs

LONG = "WITH long AS (SELECT 'g' || CAST(floor((day(ts) - 1) / 8) AS INT) AS graph, user_id, event_type AS kind, count(*) AS n FROM events GROUP BY ALL) "


def _long(spark, d):
    graph = F.concat(F.lit("g"), F.floor((F.dayofmonth("ts") - 1) / 8).cast("int").cast("string"))
    return toy.table(spark, d, "events").groupBy(graph.alias("graph"), "user_id", F.col("event_type").alias("kind")).agg(F.count("*").alias("n"))


@query(LONG + "SELECT user_id, kind FROM long GROUP BY ALL HAVING count(DISTINCT graph) = (SELECT count(DISTINCT graph) FROM long)")
def compare_shared(spark, d):
    long = _long(spark, d)
    all_graphs = long.select(F.count_distinct("graph")).scalar()
    return A.held_by(long, ["user_id", "kind"]).where(F.size("graphs") == all_graphs).select("user_id", "kind")


@query(LONG + ", h AS (SELECT user_id, kind, array_to_string(list_sort(list(DISTINCT graph)), ',') AS graphs FROM long GROUP BY ALL) SELECT graphs, count(*) AS keys FROM h GROUP BY 1")
def compare_pairs(spark, d):
    return A.held_by(_long(spark, d), ["user_id", "kind"]).groupBy(F.array_join("graphs", ",").alias("graphs")).agg(F.count("*").alias("keys"))


@query(LONG + "SELECT kind, " + ", ".join(f"CAST(coalesce(sum(n) FILTER (WHERE graph = 'g{i}'), 0) AS BIGINT) AS g{i}" for i in range(4)) + " FROM long GROUP BY 1")
def compare_matrix(spark, d):
    return sinks.tsv_matrix(_long(spark, d), "kind", "graph", "n")


@query(LONG + ", t AS (SELECT kind, graph, sum(n) AS n FROM long GROUP BY ALL) SELECT kind, arg_max(graph, (n, -CAST(substr(graph, 2) AS INT))) AS best, CAST(max(n) AS BIGINT) AS n FROM t GROUP BY 1")
def best_graph(spark, d):
    t = _long(spark, d).groupBy("kind", "graph").agg(F.sum("n").alias("n"))
    return A.first_per_key(t, ["kind"], [F.desc("n"), F.col("graph")]).select("kind", F.col("graph").alias("best"), "n")


# Subgraphs, samples and shuffles


@query(GRAPH + "SELECT id FROM nodes WHERE id IN (SELECT subject FROM edges WHERE sup = 'sup:1' UNION SELECT object FROM edges WHERE sup = 'sup:1')")
def semi_nodes(spark, d):
    return A.nodes_of(toy.nodes(spark, d), A.edges_from(toy.edges(spark, d), ["sup:1"])).select("id")


@query(GRAPH + "SELECT prim, sup, count(*) AS n FROM edges WHERE prim = 'src:orders' OR sup = 'sup:2' GROUP BY ALL")
def subgraph_edges(spark, d):
    e = A.edges_from(toy.edges(spark, d), ["src:orders", "sup:2"])
    return e.groupBy(F.col("primary_knowledge_source").alias("prim"), F.get("supporting_data_sources", F.lit(0)).alias("sup")).agg(F.count("*").alias("n"))


@query(f"WITH {toy.NODES_SQL} SELECT id FROM nodes WHERE len(list_filter(equivalent_ids, lambda e: split_part(e, ':', 1) IN ('B', 'SUPP'))) > 0")
def subgraph_nodes(spark, d):
    return A.nodes_with_prefix(toy.nodes(spark, d), ["B", "SUPP"]).select("id")


@query(GRAPH + f"SELECT DISTINCT k AS edge_key FROM (SELECT {KEY} AS k FROM edges GROUP BY 1 ORDER BY md5('7' || k), k LIMIT 100)")
def sample_edges(spark, d):
    e = toy.edges(spark, d).withColumn("edge_key", X.edge_key())
    return A.sample_keys(e, "edge_key", 100, "7")


@query("""WITH r AS (SELECT p_type AS category, 'PART:' || p_partkey AS id, row_number() OVER (PARTITION BY p_type ORDER BY md5('id' || 'PART:' || p_partkey), 'PART:' || p_partkey) AS k, row_number() OVER (PARTITION BY p_type ORDER BY md5('5' || 'PART:' || p_partkey), 'PART:' || p_partkey) AS j FROM part)
SELECT a.category, a.id, b.id AS new_id FROM r a JOIN r b ON a.category = b.category AND a.k = b.j""")
def shuffle_nodes(spark, d):
    n = toy.table(spark, d, "part").select(F.col("p_type").alias("category"), toy.curie("PART", "p_partkey").alias("id"))
    return A.shuffled_ids(n, "5")


# Text and web pages

CLEAN = "trim(regexp_replace(replace(replace(replace(replace({c}, '&middot;', '·'), '&copy;', '©'), '&quot;', '\"'), '&amp;', '&'), '\\s+', ' ', 'g'))"


@query(f"SELECT doc_id, nfc_normalize({CLEAN.format(c='text')}) AS text FROM documents")
def clean_text(spark, d):
    return toy.table(spark, d, "documents").select("doc_id", X.clean_text("text").alias("text"))


ENTITIES = {"&middot;": "·", "&copy;": "©", "&quot;": '"', "&amp;": "&"}


@query(f"SELECT page_id, {CLEAN.format(c='title')} AS title FROM (SELECT page_id, regexp_extract(html, '<title[^>]*>(.*?)</title>', 1) AS title FROM pages)")
def html_title(spark, d):
    return toy.table(spark, d, "pages").select("page_id", X.clean_plain_text(readers.html_title("html"), ENTITIES).alias("title"))


@query("SELECT page_id, count(*) AS links, count(DISTINCT l) AS distinct_links FROM (SELECT page_id, unnest(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)) AS l FROM pages) GROUP BY 1")
def html_links(spark, d):
    return toy.table(spark, d, "pages").select("page_id", F.explode(readers.html_links("html")).alias("l")).groupBy("page_id").agg(F.count("*").alias("links"), F.count_distinct("l").alias("distinct_links"))


@query("SELECT page_id, length(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '<script.*?</script>', ' ', 'gs'), '<style.*?</style>', ' ', 'gs'), '<[^>]*>', ' ', 'gs'), '\\s+', ' ', 'g'))) AS n FROM pages")
def html_text_length(spark, d):
    return toy.table(spark, d, "pages").select("page_id", F.length(readers.html_text("html")).cast("bigint").alias("n"))


@query("SELECT conv_id, role, text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY length(text) DESC, turn) AS place FROM conversations) WHERE place = 1")
def longest_text(spark, d):
    said = F.transform(F.sort_array(F.collect_list(F.struct("turn", "text"))), lambda s: s["text"])
    return toy.table(spark, d, "conversations").groupBy("conv_id", "role").agg(X.longest(said).alias("text"))


@query("SELECT event_type, k AS property, count(*) AS rows, arg_min(json_extract_string(props, '$.' || k), event_id) AS example FROM (SELECT *, unnest(json_keys(props)) AS k FROM events) GROUP BY ALL")
def property_profile(spark, d):
    e = toy.table(spark, d, "events").withColumn("p", F.from_json("props", "map<string,string>"))
    return A.property_profile(e, "event_type", "p", "event_id")


@query("SELECT split_part(url, '://', 1) AS scheme, regexp_replace(split_part(split_part(url, '://', 2), '/', 1), '^m\\.', '') AS host, count(*) AS n FROM pages GROUP BY ALL")
def prefix_strip(spark, d):
    u = toy.table(spark, d, "pages").select(F.substring_index("url", "://", 1).alias("scheme"), X.without_scheme(F.substring_index(F.substring_index("url", "://", -1), "/", 1), "m.").alias("host"))
    return u.groupBy("scheme", "host").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, x AS curie, CASE WHEN parts > 2 THEN 'a:' || o_orderkey ELSE x END AS fixed, parts = 2 AS valid FROM (SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'a:b:' || o_orderkey WHEN 1 THEN 'a:' || o_orderkey ELSE 'a' || o_orderkey END AS x, CASE o_orderkey % 3 WHEN 0 THEN 3 WHEN 1 THEN 2 ELSE 1 END AS parts FROM orders)")
def curie_repair(spark, d):
    n, key = F.col("o_orderkey") % 3, F.col("o_orderkey").cast("string")
    x = F.when(n == 0, F.concat(F.lit("a:b:"), key)).when(n == 1, F.concat(F.lit("a:"), key)).otherwise(F.concat(F.lit("a"), key))
    return toy.table(spark, d, "orders").select("o_orderkey", x.alias("curie"), X.single_prefix(x).alias("fixed"), X.curie_parts(x).isNotNull().alias("valid"))


@query("SELECT p_partkey, CASE WHEN v >= 1e6 THEN printf('%.1f', v / 1e6) || 'M' WHEN v >= 1e3 THEN printf('%.0f', v / 1e3) || 'K' ELSE CAST(v AS VARCHAR) END AS human FROM (SELECT p_partkey, p_partkey * 977 AS v FROM part)")
def human_counts(spark, d):
    return toy.table(spark, d, "part").select("p_partkey", X.human_count(F.col("p_partkey") * 977).alias("human"))


from . import source_queries  # noqa: E402, F401  registers its queries
