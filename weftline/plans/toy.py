"""The driver's tables as a property graph, in the engine's schemas, and the same graph in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import schema as S

FAMILIES = [("trade", ["product", "supplier"]), ("party", ["organization", "building", "machinery", "household", "furniture", "automobile"]), ("activity", ["event"])]


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _node(df: DataFrame, id_, name, categories, equivalents, provider: str) -> DataFrame:
    none = lambda t: F.lit(None).cast(t)
    return df.select(id_.alias("id"), name.alias("name"), none(S.LIST).alias("urls"), categories.alias("categories"), F.array(F.lit(provider)).alias("provided_by"), none(S.LIST).alias("synonyms"), F.array(id_, *equivalents).alias("equivalent_ids"), none(S.LIST).alias("taxa"),
                     none("string").alias("description"), none("string").alias("chemical_formula"), none("double").alias("exact_mass"), none(S.LIST).alias("publications"), none(S.ATTRIBUTES).alias("attributes"))


def curie(prefix: str, key: str):
    return F.concat(F.lit(f"{prefix}:"), F.col(key).cast("string"))


def part_nodes(spark: SparkSession, d: str) -> DataFrame:
    a = F.concat(F.lit("A:"), F.concat_ws("|", "p_name", "p_brand", "p_type"))
    b = F.concat(F.lit("B:"), F.concat_ws("|", "p_brand", "p_type", F.col("p_size").cast("string")))
    return _node(table(spark, d, "part"), curie("PART", "p_partkey"), F.col("p_name"), F.array(F.lit("Product"), "p_type"), [a, b], "part")


def nodes(spark: SparkSession, d: str) -> DataFrame:
    supplier = _node(table(spark, d, "supplier"), curie("SUPP", "s_suppkey"), F.col("s_name"), F.array(F.lit("Organization"), F.lit("Supplier")), [], "supplier")
    customer = _node(table(spark, d, "customer"), curie("CUST", "c_custkey"), F.col("c_name"), F.array(F.lit("Organization"), F.col("c_mktsegment")), [], "customer")
    order = _node(table(spark, d, "orders"), curie("ORDER", "o_orderkey"), F.lit(None).cast("string"), F.array(F.lit("Event")), [], "orders")
    return part_nodes(spark, d).unionByName(supplier).unionByName(customer).unionByName(order)


def _edge(df: DataFrame, subject, predicate, object_, qualifiers, primary, aggregators, supporting, level, agent, publications, attributes, ordinal) -> DataFrame:
    none = F.lit(None).cast("string")
    return df.select(subject.alias("subject"), object_.alias("object"), F.lit(predicate).alias("predicate"), qualifiers.alias("qualifiers"), primary.alias("primary_knowledge_source"), aggregators.alias("aggregator_knowledge_source"), supporting.alias("supporting_data_sources"),
                     level.alias("knowledge_level"), agent.alias("agent_type"), publications.alias("publications"), none.alias("publications_info"), attributes.alias("attributes"), F.lit(0).alias("source_rank"), ordinal.alias("ordinal"))


def supplied(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("l_linenumber")
    level = F.when(n % 3 == 0, "not_provided").when(n % 3 == 1, "prediction").otherwise("knowledge_assertion")
    agent = F.when(n % 4 == 0, "not_provided").when(n % 4 == 1, "manual_agent").when(n % 4 == 2, "text_mining_agent").otherwise("automated_agent")
    text = lambda p, e: F.concat(F.lit(p), e.cast("string"))
    ordinal = F.concat_ws("-", *[F.lpad(F.col(c).cast("string"), 12, "0") for c in ("l_orderkey", "l_linenumber")], F.col("l_extendedprice").cast("decimal(18,4)").cast("string"))
    attributes = F.create_map(text("agg:", n % 3), F.create_map(F.lit("quantity"), F.col("l_quantity").cast("int").cast("string")))
    return _edge(table(spark, d, "lineitem"), curie("PART", "l_partkey"), "rel:supplied_by", curie("SUPP", "l_suppkey"), F.create_map(F.lit("return_flag"), "l_returnflag", F.lit("line_status"), "l_linestatus"), text("src:", n % 2), F.array(text("agg:", n % 3)),
                 F.array(text("sup:", F.col("l_suppkey") % 3)), level, agent, F.array(F.year("l_shipdate").cast("string")), attributes, ordinal)


def placed(spark: SparkSession, d: str) -> DataFrame:
    level = F.when(F.col("o_orderstatus") == "P", "not_provided").when(F.col("o_orderstatus") == "F", "knowledge_assertion").otherwise("prediction")
    return _edge(table(spark, d, "orders"), curie("CUST", "o_custkey"), "rel:placed", curie("ORDER", "o_orderkey"), F.lit(None).cast(S.MAP), F.lit("src:orders"), F.array(F.lit("agg:orders")), F.lit(None).cast(S.LIST), level,
                 F.lower(F.replace("o_orderpriority", F.lit(" "), F.lit("_"))), F.lit(None).cast(S.LIST), F.lit(None).cast(S.ATTRIBUTES), F.lpad(F.col("o_orderkey").cast("string"), 12, "0"))


def edges(spark: SparkSession, d: str) -> DataFrame:
    return supplied(spark, d).unionByName(placed(spark, d))


NODES_SQL = """nodes AS (
 SELECT 'PART:' || p_partkey AS id, p_name AS name, ['Product', p_type] AS categories, ['PART:' || p_partkey, 'A:' || p_name || '|' || p_brand || '|' || p_type, 'B:' || p_brand || '|' || p_type || '|' || p_size] AS equivalent_ids, 'part' AS provider FROM part
 UNION ALL SELECT 'SUPP:' || s_suppkey, s_name, ['Organization', 'Supplier'], ['SUPP:' || s_suppkey], 'supplier' FROM supplier
 UNION ALL SELECT 'CUST:' || c_custkey, c_name, ['Organization', c_mktsegment], ['CUST:' || c_custkey], 'customer' FROM customer
 UNION ALL SELECT 'ORDER:' || o_orderkey, NULL, ['Event'], ['ORDER:' || o_orderkey], 'orders' FROM orders)"""

EDGES_SQL = """edges AS (
 SELECT 'PART:' || l_partkey AS subject, 'rel:supplied_by' AS predicate, 'SUPP:' || l_suppkey AS object, l_returnflag AS rf, l_linestatus AS ls, 'src:' || (l_linenumber % 2) AS prim, 'agg:' || (l_linenumber % 3) AS agg, 'sup:' || (l_suppkey % 3) AS sup,
  CASE l_linenumber % 3 WHEN 0 THEN 'not_provided' WHEN 1 THEN 'prediction' ELSE 'knowledge_assertion' END AS kl,
  CASE l_linenumber % 4 WHEN 0 THEN 'not_provided' WHEN 1 THEN 'manual_agent' WHEN 2 THEN 'text_mining_agent' ELSE 'automated_agent' END AS agent,
  CAST(year(l_shipdate) AS VARCHAR) AS pub, CAST(CAST(l_quantity AS INT) AS VARCHAR) AS quantity,
  lpad(CAST(l_orderkey AS VARCHAR), 12, '0') || '-' || lpad(CAST(l_linenumber AS VARCHAR), 12, '0') || '-' || CAST(CAST(l_extendedprice AS DECIMAL(18,4)) AS VARCHAR) AS ord,
  'line_status:' || l_linestatus || '__return_flag:' || l_returnflag AS q FROM lineitem
 UNION ALL SELECT 'CUST:' || o_custkey, 'rel:placed', 'ORDER:' || o_orderkey, NULL, NULL, 'src:orders', 'agg:orders', NULL,
  CASE o_orderstatus WHEN 'P' THEN 'not_provided' WHEN 'F' THEN 'knowledge_assertion' ELSE 'prediction' END, lower(replace(o_orderpriority, ' ', '_')), NULL, NULL, lpad(CAST(o_orderkey AS VARCHAR), 12, '0'), '|' FROM orders)"""

GRAPH_SQL = f"WITH {NODES_SQL}, {EDGES_SQL} "
