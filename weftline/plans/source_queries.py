"""Catalogue queries over the sources' own plans and the reports, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import identifiers as I
from ..operators import analysis as A
from ..operators import reports as R
from ..sources import registry, spec
from . import biomedical as B
from . import mixed_graph as MG
from . import toy
from .catalog import joined, query

# A mixed graph of parts, suppliers and line items


def mixed_items(spark, d):
    """Parts as genes and proteins, suppliers as diseases, line items as relationships between them."""
    text = lambda c: F.col(c).cast("string")
    as_map = lambda **kv: F.create_map(*[x for k, v in kv.items() for x in (F.lit(k), v.cast("string") if not isinstance(v, str) else F.lit(v))])
    none = F.lit(None).cast("string")
    end = "struct<id:string>"
    protein = F.col("p_partkey") % 10 == 0
    name = F.when(F.col("p_partkey") % 20 == 0, F.concat(F.lit("PRO_"), text("p_partkey"))).when(protein, F.concat(F.lit("P"), text("p_partkey"))).otherwise(text("p_partkey"))
    listed = F.concat(F.lit('["CHEMBL'), text("p_size"), F.lit('","none"]'))
    parts = toy.table(spark, d, "part").select(
        F.lit("node").alias("type"), F.concat(F.lit("p"), "p_partkey").alias("id"), F.array(F.when(protein, "Protein").otherwise("Gene")).alias("labels"), none.alias("label"), F.lit(None).cast(end).alias("start"), F.lit(None).cast(end).alias("end"),
        as_map(identifier=name, source=F.when(protein, "UniProt").otherwise("Entrez Gene"), name=F.col("p_name"), chembl_id=listed, weight=text("p_size"), license="free", note="").alias("properties"),
    )
    disease = F.when(F.col("s_suppkey") % 5 == 0, "-").otherwise(F.concat(F.lit("DOID:"), text("s_suppkey")))
    suppliers = toy.table(spark, d, "supplier").select(
        F.lit("node").alias("type"), F.concat(F.lit("s"), "s_suppkey").alias("id"), F.array(F.lit("Disease")).alias("labels"), none.alias("label"), F.lit(None).cast(end).alias("start"), F.lit(None).cast(end).alias("end"),
        as_map(identifier=disease, sources='["Disease Ontology"]', name=F.col("s_name")).alias("properties"),
    )
    n = F.col("l_linenumber") % 4
    label = F.when(n == 0, "ASSOCIATES_GaD").when(n == 1, "DOWNREGULATES_GdG").when(n == 2, "EXPRESSES_XeY").otherwise("NOPE_XyZ")
    source = F.when(F.col("l_returnflag") == "A", "DISEASES").when(F.col("l_returnflag") == "R", "Mystery")
    items = toy.table(spark, d, "lineitem").select(
        F.lit("relationship").alias("type"), F.concat_ws("-", text("l_orderkey"), text("l_linenumber")).alias("id"), F.lit(None).cast("array<string>").alias("labels"), label.alias("label"),
        F.struct(F.concat(F.lit("p"), "l_partkey").alias("id")).alias("start"), F.struct(F.concat(F.lit("s"), "l_suppkey").alias("id")).alias("end"),
        as_map(source=source, sources=F.when(F.col("l_linestatus") == "O", '["CTKP","Reactome"]'), pubmedIDs='["12","10.1/x","bad"]').alias("properties"),
    )
    return parts.unionByName(suppliers).unionByName(items)


def mixed(spark, d):
    levels = spark.sql("SELECT 'infores:diseases' AS infores, 'prediction' AS knowledge_level, 'text_mining_agent' AS agent_type")
    return MG.mixed_graph(mixed_items(spark, d), levels=levels)


@query("""SELECT CASE WHEN p_partkey % 20 = 0 THEN 'UNIPROTKB:PRO_' || p_partkey WHEN p_partkey % 10 = 0 THEN 'UNIPROTKB:P' || p_partkey ELSE 'NCBIGENE:' || p_partkey END AS id, p_name AS name,
CASE WHEN p_partkey % 20 = 0 THEN 'biolink:Polypeptide' WHEN p_partkey % 10 = 0 THEN 'biolink:Protein' ELSE 'biolink:Gene' END AS categories, 'CHEMBL.TARGET:CHEMBL' || p_size AS other_ids, 'spoke_id,weight' AS attributes FROM part
UNION ALL SELECT 'DOID:' || s_suppkey, s_name, 'biolink:Disease', '', 'spoke_id' FROM supplier WHERE s_suppkey % 5 <> 0""")
def mixed_nodes(spark, d):
    n = mixed(spark, d).nodes
    return n.select("id", "name", joined("categories").alias("categories"), joined(F.array_remove("equivalent_ids", F.col("id"))).alias("other_ids"), joined(F.map_keys(F.try_element_at("attributes", F.lit("infores:spoke")))).alias("attributes"))


MIXED = """WITH e AS (SELECT *, CASE WHEN l_partkey % 20 = 0 THEN 'UNIPROTKB:PRO_' || l_partkey WHEN l_partkey % 10 = 0 THEN 'UNIPROTKB:P' || l_partkey ELSE 'NCBIGENE:' || l_partkey END AS p, 'DOID:' || l_suppkey AS s, l_linenumber % 4 AS k FROM lineitem) """


@query(MIXED + """SELECT CASE k WHEN 2 THEN s ELSE p END AS subject, CASE k WHEN 0 THEN 'biolink:associated_with' WHEN 1 THEN 'biolink:regulates' ELSE 'biolink:expressed_in' END AS predicate, CASE k WHEN 2 THEN p ELSE s END AS object,
CASE k WHEN 1 THEN 'object_direction_qualifier:downregulated' ELSE '|' END AS qualifiers, CASE WHEN l_returnflag = 'A' THEN 'infores:diseases' WHEN l_linestatus = 'O' THEN 'infores:multiomics-clinicaltrials' ELSE 'infores:spoke' END AS primary_source,
CASE WHEN l_linestatus <> 'O' THEN NULL WHEN l_returnflag = 'A' THEN 'infores:multiomics-clinicaltrials,infores:reactome' ELSE 'infores:reactome' END AS supporting, CASE WHEN l_returnflag = 'A' THEN 'prediction' ELSE 'not_provided' END AS knowledge_level,
CASE WHEN l_returnflag = 'A' THEN 'text_mining_agent' ELSE 'not_provided' END AS agent_type, 'PMID:12,doi:10.1/x' AS publications, count(*) AS n FROM e WHERE k <> 3 AND l_returnflag <> 'R' AND l_suppkey % 5 <> 0 GROUP BY ALL""")
def mixed_edges(spark, d):
    from ..functions import scalars as X

    e = mixed(spark, d).edges
    flat = e.select("subject", "predicate", "object", X.qualifier_text("qualifiers").alias("qualifiers"), F.col("primary_knowledge_source").alias("primary_source"), joined("supporting_data_sources").alias("supporting"), "knowledge_level", "agent_type", joined("publications").alias("publications"))
    return flat.groupBy(*flat.columns).agg(F.count("*").alias("n"))


@query(MIXED + """SELECT 'node' AS entity, 'known_invalid' AS reason, 'Disease Disease Ontology' AS value, count(*) AS n FROM supplier WHERE s_suppkey % 5 = 0 HAVING count(*) > 0
UNION ALL SELECT 'edge', CASE WHEN k = 3 THEN 'unmapped_label' WHEN l_returnflag = 'R' THEN 'unmapped_source' ELSE 'unknown_endpoint' END, CASE k WHEN 0 THEN 'ASSOCIATES_GaD' WHEN 1 THEN 'DOWNREGULATES_GdG' WHEN 2 THEN 'EXPRESSES_XeY' ELSE 'NOPE_XyZ' END, count(*) FROM e WHERE k = 3 OR l_returnflag = 'R' OR l_suppkey % 5 = 0 GROUP BY ALL""")
def mixed_rejects(spark, d):
    return mixed(spark, d).rejects


# Declarative sources, by the specifications of the registry


def _orders(spark, d):
    key = F.col("o_orderkey")
    agent = F.when(key % 3 == 0, "experimental_agent").when(key % 3 == 1, "manual_validation_of_experimental_agent").otherwise("manual_agent")
    source = F.when(key % 4 == 0, "infores:chembl").when(key % 4 == 1, "infores:ki-database").when(key % 4 == 2, "infores:ubergraph").otherwise("infores:hmdb")
    return toy.table(spark, d, "orders").select(
        F.concat(F.lit("O:"), key.cast("string")).alias("subject"), F.concat(F.lit("C:"), F.col("o_custkey").cast("string")).alias("object"), F.when(key % 2 == 0, "biolink:has_variant").otherwise("biolink:affects").alias("predicate"), source.alias("primary_knowledge_source"),
        agent.alias("agent_type"), F.lit("unspecified").alias("knowledge_level"), F.lit("PMID:1|PMID:2").alias("publications"), F.lit("x|y").alias("aggregator_knowledge_source"), F.lit("{}").alias("attributes"), F.lit("z").alias("note"),
    )


@query("""SELECT 'O:' || o_orderkey AS subject, CASE o_orderkey % 2 WHEN 0 THEN 'biolink:related_to_at_concept_level' ELSE 'biolink:affects' END AS predicate, CASE o_orderkey % 4 WHEN 0 THEN 'infores:chembl' WHEN 1 THEN 'infores:ki-database' WHEN 2 THEN 'infores:ubergraph' ELSE 'infores:hmdb' END AS primary_source,
CASE WHEN o_orderkey % 3 < 2 AND o_orderkey % 4 = 0 THEN 'manual_agent' WHEN o_orderkey % 3 = 0 AND o_orderkey % 4 = 1 THEN 'not_provided' WHEN o_orderkey % 3 = 0 THEN 'experimental_agent' WHEN o_orderkey % 3 = 1 THEN 'manual_validation_of_experimental_agent' ELSE 'manual_agent' END AS agent_type,
'infores:molepro' AS aggregators, 'not_provided' AS knowledge_level, CASE o_orderkey % 4 WHEN 3 THEN NULL ELSE 'PMID:1,PMID:2' END AS publications, 'note' AS attributes FROM orders""")
def registry_molepro_edges(spark, d):
    e = spec.edges(registry.SPECS["molepro"], _orders(spark, d))
    return e.select("subject", "predicate", F.col("primary_knowledge_source").alias("primary_source"), "agent_type", joined("aggregator_knowledge_source").alias("aggregators"), "knowledge_level", joined("publications").alias("publications"), joined(F.map_keys(F.try_element_at("attributes", F.lit("infores:molepro")))).alias("attributes"))


@query("SELECT CASE o_orderkey % 4 WHEN 0 THEN 'infores:chembl' WHEN 1 THEN 'infores:ki-database' ELSE 'infores:hmdb' END AS primary_source, count(*) AS n, count(*) FILTER (WHERE o_orderkey % 4 <> 3) AS with_publications, count(*) AS with_sentences FROM orders WHERE o_orderkey % 4 <> 2 GROUP BY 1")
def registry_robokop_edges(spark, d):
    raw = _orders(spark, d).withColumnRenamed("note", "sentences").drop("aggregator_knowledge_source")
    e = spec.edges(registry.SPECS["robokop"], raw)
    kept = (F.col("primary_knowledge_source") != "infores:hmdb") & F.col("publications_info").isNotNull() | (F.col("primary_knowledge_source") == "infores:hmdb")
    return e.groupBy(F.col("primary_knowledge_source").alias("primary_source")).agg(F.count("*").alias("n"), F.count("publications").alias("with_publications"), F.count_if(kept).alias("with_sentences"))


@query("SELECT 'infores:multiomics-microbiome' AS primary_source, NULL AS aggregators, 'infores:pubmed-central' AS supporting, 'PMID:7' AS publications, count(*) AS n FROM orders")
def registry_microbiome_edges(spark, d):
    raw = _orders(spark, d).select("subject", "object", "predicate", F.lit("PMID:7").alias("publication"))
    e = spec.edges(registry.SPECS["microbiome-kg"], raw)
    flat = e.select(F.col("primary_knowledge_source").alias("primary_source"), F.nullif(joined("aggregator_knowledge_source"), F.lit("")).alias("aggregators"), joined("supporting_data_sources").alias("supporting"), joined("publications").alias("publications"))
    return flat.groupBy(*flat.columns).agg(F.count("*").alias("n"))


def _parts(spark, d):
    return toy.table(spark, d, "part").select(toy.curie("PART", "p_partkey").alias("id"), F.col("p_name").alias("name"), F.array(F.lit("biolink:Organism"), F.lit("biolink:Gene")).alias("all_categories"), F.lit("biolink:Gene").alias("category"), F.array(F.concat(F.lit("E:"), F.col("p_size").cast("string"))).alias("equivalent_curies"),
                                              F.array("p_brand").alias("all_names"), F.concat(F.lit("http://x/"), F.col("p_partkey").cast("string")).alias("iri"), F.array(F.lit("PMID:9")).alias("publications"), F.lit("t").alias("taxon"), F.array(F.lit("u")).alias("in_taxon"))


@query("SELECT 'PART:' || p_partkey AS id, 'biolink:Gene,biolink:Organism' AS categories, array_to_string(list_sort(['E:' || p_size, 'PART:' || p_partkey]), ',') AS equivalent_ids, array_to_string(list_sort(list_distinct([p_brand, p_name])), ',') AS synonyms, 'http://x/' || p_partkey AS urls, 'canonical_category,in_taxon,taxon' AS attributes, TRUE AS no_publications FROM part")
def registry_kg2_nodes(spark, d):
    n = spec.nodes(registry.SPECS["kg2"], _parts(spark, d))
    return n.select("id", joined("categories").alias("categories"), joined("equivalent_ids").alias("equivalent_ids"), joined("synonyms").alias("synonyms"), joined("urls").alias("urls"), joined(F.map_keys(F.try_element_at("attributes", F.lit("infores:rtx-kg2")))).alias("attributes"), F.col("publications").isNull().alias("no_publications"))


@query("SELECT 'PART:' || p_partkey AS id, 'PART:' || p_partkey AS equivalent_ids, 't,u' AS taxa, 'translator-kg-open' AS provided_by FROM part")
def registry_translator_nodes(spark, d):
    n = spec.nodes(registry.SPECS["translator-kg-open"], _parts(spark, d).drop("all_categories", "publications"))
    return n.select("id", joined("equivalent_ids").alias("equivalent_ids"), joined("taxa").alias("taxa"), joined("provided_by").alias("provided_by"))


# Identifiers

RULES = {"kegg.compound": ("KEGG.COMPOUND", r"^C\d+$"), "chembl.compound": ("CHEMBL.COMPOUND", r"^CHEMBL\d+$"), "unii": ("UNII", r"^[A-Z0-9]{10}$")}


def _curies(spark, d):
    n, key = F.col("o_orderkey") % 5, F.col("o_orderkey").cast("string")
    c = F.when(n == 0, F.concat(F.lit("KEGG:C"), key)).when(n == 1, F.concat(F.lit("chembl.compound:CHEMBL"), key)).when(n == 2, F.concat(F.lit("UNII:bad"), key)).when(n == 3, F.concat(F.lit("KEGG:D"), key)).otherwise(F.concat(F.lit("X:"), key))
    return toy.table(spark, d, "orders").select("o_orderkey", c.alias("c"))


@query("SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'KEGG.COMPOUND:C' || o_orderkey WHEN 1 THEN 'CHEMBL.COMPOUND:CHEMBL' || o_orderkey WHEN 2 THEN 'UNII:bad' || o_orderkey WHEN 3 THEN 'KEGG:D' || o_orderkey ELSE 'X:' || o_orderkey END AS curie, o_orderkey % 5 IN (0, 1, 4) AS valid FROM orders")
def gated_curies(spark, d):
    return _curies(spark, d).select("o_orderkey", I.gated_curie("c", RULES).alias("g")).select("o_orderkey", "g.curie", "g.valid")


@query("SELECT CASE o_orderkey % 5 WHEN 2 THEN 'unii' ELSE 'kegg' END AS vocabulary, TRUE AS known, count(*) AS n FROM orders WHERE o_orderkey % 5 IN (2, 3) GROUP BY 1")
def invalid_id_counts(spark, d):
    return I.invalid_counts(_curies(spark, d), "c", RULES)


# Single sources


@query("SELECT p_partkey, CASE WHEN p_size % 6 IN (3, 4) OR p_size % 5 = 1 THEN 'biolink:InformationContentEntity' WHEN p_size % 5 IN (0, 2) THEN 'biolink:ClinicalMeasurement' ELSE 'biolink:NamedThing' END AS category FROM part")
def scale_categories(spark, d):
    n = F.col("p_size") % 5
    p = toy.table(spark, d, "part").select("p_partkey", F.when(n == 0, "Qn").when(n == 1, "Doc").when(n == 2, " Ord ").when(n == 3, "-").alias("SCALE_TYP"), (F.col("p_size") % 6).cast("string").alias("CLASSTYPE"))
    return p.select("p_partkey", B.scale_category().alias("category"))


@query("SELECT CASE WHEN c_acctbal > 0 THEN 'biolink:positively_correlated_with' ELSE 'biolink:negatively_correlated_with' END AS predicate, count(*) AS n FROM customer WHERE (c_custkey % 100) / 1000.0 < 0.05 AND c_acctbal <> 0 GROUP BY 1")
def sign_predicates(spark, d):
    c = toy.table(spark, d, "customer").select(F.col("c_acctbal").cast("string").alias("v"), ((F.col("c_custkey") % 100) / 1000.0).cast("string").alias("p"))
    return c.select(B.sign_predicate("v", "p").alias("predicate")).where("predicate IS NOT NULL").groupBy("predicate").agg(F.count("*").alias("n"))


@query("SELECT n AS trait, s AS score, e AS evaluations FROM (SELECT n, s, e, row_number() OVER (PARTITION BY n ORDER BY e DESC, s) AS place FROM (SELECT s_nationkey AS n, s_suppkey AS s, count(DISTINCT l_orderkey) AS e FROM supplier JOIN lineitem ON l_suppkey = s_suppkey GROUP BY ALL) WHERE e >= 5) WHERE place <= 2")
def selected_score_ids(spark, d):
    scores = toy.table(spark, d, "supplier").select(F.col("s_nationkey").alias("trait"), F.col("s_suppkey").alias("score"), F.col("s_suppkey").alias("position"))
    samples = toy.table(spark, d, "lineitem").select(F.col("l_suppkey").alias("score"), F.col("l_orderkey").alias("sample_set"))
    return B.selected_scores(scores, samples, 5, 2).select("trait", "score", "evaluations")


def _scores(spark, d):
    p = toy.table(spark, d, "part")
    key = F.col("p_partkey").cast("string")
    scores = p.select(key.alias("score"), F.col("p_brand").alias("name"), F.when(F.col("p_partkey") % 2 == 0, key).alias("pmid"), F.when(F.col("p_partkey") % 3 != 0, F.col("p_name")).alias("reported_trait"), F.col("p_type").alias("mapped_trait_label"), F.lit("").alias("weight_type"))
    traits = p.select(key.alias("score"), F.concat(F.lit("T:"), "p_type").alias("trait"), F.col("p_type").alias("label"), (F.col("p_size") % 3).alias("evaluations"))
    return B.score_graph(scores, traits, "pgs-catalog")


@query("""SELECT 'PGS:' || p_partkey AS id, CASE WHEN p_partkey % 3 <> 0 THEN p_name ELSE p_type END || ' PGS' AS name, p_brand AS synonyms, CASE WHEN p_partkey % 3 <> 0 THEN 'Polygenic score for ' || p_name END AS description, CASE WHEN p_partkey % 2 = 0 THEN 'PMID:' || p_partkey END AS publications,
CASE WHEN p_partkey % 3 <> 0 THEN 'mapped_trait_label,pgs_catalog_id,reported_trait' ELSE 'mapped_trait_label,pgs_catalog_id' END AS attributes FROM part UNION ALL SELECT DISTINCT 'T:' || p_type, p_type, NULL, NULL, NULL, NULL FROM part""")
def score_nodes(spark, d):
    n, _ = _scores(spark, d)
    return n.select("id", "name", joined("synonyms").alias("synonyms"), "description", joined("publications").alias("publications"), joined(F.map_keys(F.try_element_at("attributes", F.lit("pgs-catalog")))).alias("attributes"))


@query("SELECT 'PGS:' || p_partkey AS subject, 'T:' || p_type AS object, 'statistical_association' AS knowledge_level, CASE WHEN p_size % 3 > 0 THEN CAST(p_size % 3 AS VARCHAR) END AS evaluations FROM part")
def score_edges(spark, d):
    _, e = _scores(spark, d)
    return e.select("subject", "object", "knowledge_level", F.try_element_at(F.try_element_at("attributes", F.lit("pgs-catalog")), F.lit("num_evaluation_sample_sets")).alias("evaluations"))


@query(f"WITH {toy.NODES_SQL} SELECT e AS curie, array_to_string(list_sort(list(DISTINCT c)), ',') AS categories FROM (SELECT unnest(list_distinct(list_append(equivalent_ids, id))) AS e, categories FROM nodes) x, unnest(categories) AS t(c) WHERE e IN (SELECT 'PART:' || p_partkey FROM part WHERE p_partkey % 9 = 0) GROUP BY 1")
def known_candidate_categories(spark, d):
    candidates = toy.table(spark, d, "part").where("p_partkey % 9 = 0").select(toy.curie("PART", "p_partkey").alias("curie")).unionByName(spark.sql("SELECT 'NOPE:1' AS curie"))
    return R.known_candidates(toy.nodes(spark, d), candidates).select("curie", joined("categories").alias("categories"))


# Reports


@query("SELECT l_suppkey, n, total, least(7, total) AS shown FROM (SELECT l_suppkey, count(*) AS n, count(*) OVER () AS total FROM lineitem GROUP BY 1) ORDER BY n DESC, l_suppkey LIMIT 7")
def top_shown_of_all(spark, d):
    return R.top_of(toy.table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("n")), "l_suppkey", "n", 7)


PAIRS = "WITH c AS (SELECT l_partkey || '-' || l_suppkey AS pair, l_returnflag AS graph, count(*) AS n FROM lineitem GROUP BY ALL) "


def _pairs(spark, d):
    return toy.table(spark, d, "lineitem").groupBy(F.concat_ws("-", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")).alias("pair"), F.col("l_returnflag").alias("graph")).agg(F.count("*").alias("n"))


@query(PAIRS + "SELECT pair, max(n) AS most FROM c GROUP BY 1 ORDER BY most DESC, pair LIMIT 20")
def top_by_most(spark, d):
    return R.top_by_most(_pairs(spark, d), "pair", "graph", "n", 20)


@query(PAIRS + "SELECT graph, pair, CAST(n AS BIGINT) AS n, rank FROM (SELECT graph, pair, n, row_number() OVER (PARTITION BY graph ORDER BY n DESC, pair) AS rank FROM (SELECT pair, min(graph) AS graph, min(n) AS n FROM c GROUP BY 1 HAVING count(*) = 1)) WHERE rank <= 15")
def top_unique(spark, d):
    return R.top_unique(_pairs(spark, d), "pair", "graph", "n", 15).withColumn("rank", F.col("rank").cast("bigint"))


@query("SELECT p_type, family, n, row_number() OVER (ORDER BY CASE family WHEN 'small' THEN 1 WHEN 'large' THEN 2 ELSE 3 END, n DESC, p_type) AS place FROM (SELECT p_type, count(*) AS n, CASE p_type WHEN 'SMALL' THEN 'small' WHEN 'LARGE' THEN 'large' ELSE 'other' END AS family FROM part GROUP BY 1)")
def categories_by_family(spark, d):
    family = F.when(F.col("p_type") == "SMALL", "small").when(F.col("p_type") == "LARGE", "large").otherwise("other")
    return R.by_family(toy.table(spark, d, "part").groupBy("p_type").agg(F.count("*").alias("n")), "p_type", "n", family, ["small", "large", "other"])


@query("SELECT s_suppkey, s_name FROM supplier WHERE NOT contains(s_name, '7') AND NOT contains(s_name, '13')")
def names_without_parts(spark, d):
    return R.without_names(toy.table(spark, d, "supplier").select("s_suppkey", "s_name"), ["s_name"], ["7", " 13", ""])


@query("SELECT p_type AS subject, 'rel' AS predicate, p_brand AS object, count(*) AS n FROM part GROUP BY ALL UNION ALL SELECT p_brand, 'has', p_type, count(*) FROM part GROUP BY ALL")
def parsed_triples(spark, d):
    n = F.lit('": ')
    nested = F.concat(F.lit('{"'), "p_type", n, F.lit('{"rel": {"'), "p_brand", n, F.lit("1}}, "))
    flat = F.concat(F.lit('"'), "p_brand", F.lit("__has__"), "p_type", n, F.lit('2, "odd__key": 3}'))
    return R.triples_of(toy.table(spark, d, "part").select(F.concat(nested, flat).alias("value"))).groupBy("subject", "predicate", "object").agg(F.count("*").alias("n"))


@query("WITH c AS (SELECT l_partkey, l_suppkey, l_returnflag AS graph FROM lineitem GROUP BY ALL) SELECT l_partkey, l_suppkey, min(graph) AS graph FROM c GROUP BY ALL HAVING count(*) = 1")
def compare_unique(spark, d):
    held = A.held_by(toy.table(spark, d, "lineitem").withColumnRenamed("l_returnflag", "graph"), ["l_partkey", "l_suppkey"])
    return held.where(F.size("graphs") == 1).select("l_partkey", "l_suppkey", F.element_at("graphs", 1).alias("graph"))
