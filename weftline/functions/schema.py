"""The node and edge schemas, and the vocabulary they use."""

from pyspark.sql import types as T

S, LIST, MAP = T.StringType(), T.ArrayType(T.StringType()), T.MapType(T.StringType(), T.StringType())
#: Attributes: by source, then by property, with JSON text as the innermost value.
ATTRIBUTES = T.MapType(T.StringType(), MAP)

NODE = T.StructType([
    T.StructField("id", S, False), T.StructField("name", S), T.StructField("urls", LIST), T.StructField("categories", LIST), T.StructField("provided_by", LIST), T.StructField("synonyms", LIST),
    T.StructField("equivalent_ids", LIST), T.StructField("taxa", LIST), T.StructField("description", S), T.StructField("chemical_formula", S), T.StructField("exact_mass", T.DoubleType()), T.StructField("publications", LIST), T.StructField("attributes", ATTRIBUTES),
])
EDGE = T.StructType([
    T.StructField("subject", S, False), T.StructField("object", S, False), T.StructField("predicate", S, False), T.StructField("qualifiers", MAP), T.StructField("primary_knowledge_source", S), T.StructField("aggregator_knowledge_source", LIST),
    T.StructField("supporting_data_sources", LIST), T.StructField("knowledge_level", S), T.StructField("agent_type", S), T.StructField("publications", LIST), T.StructField("publications_info", S), T.StructField("attributes", ATTRIBUTES),
])

REQUIRED_NODE = ["id", "categories", "provided_by"]
REQUIRED_EDGE = ["subject", "object", "predicate", "primary_knowledge_source", "knowledge_level", "agent_type"]
#: What makes two edges the same. Aggregators and supporting sources stay out, so their assertions merge.
EDGE_KEY = ["subject", "predicate", "object", "qualifiers", "primary_knowledge_source"]
NOT_PROVIDED = "not_provided"
UNSPECIFIED = "unspecified"
