"""Plans for single sources whose shape a column mapping can't express.

Vocabulary mappings are tables that the caller gives, so a new release of a source changes data and not plans. Rows
that don't fit come out in a reject table instead of ending the build.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as X
from ..functions import schema as S
from ..operators import analysis as A
from ..sources import spec

LIST = "array<string>"


def _nodes(df: DataFrame, provider: str, **columns: Column) -> DataFrame:
    """The node schema with the given columns; the others are null."""
    own = {"provided_by": F.array(F.lit(provider))} | columns
    return df.select(*[(own[f.name] if f.name in own else F.lit(None).cast(f.dataType)).alias(f.name) for f in S.NODE.fields])


def _edges(df: DataFrame, source: str, **columns: Column) -> DataFrame:
    own = {"primary_knowledge_source": F.lit(source), "knowledge_level": F.lit("knowledge_assertion"), "agent_type": F.lit("manual_agent")} | columns
    return df.select(*[(own[f.name] if f.name in own else F.lit(None).cast(f.dataType)).alias(f.name) for f in S.EDGE.fields])


def property_graph(nodes: DataFrame, relations: DataFrame, categories: DataFrame, predicates: DataFrame, sources: DataFrame, provider: str, default_category: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Nodes, edges and rejects of a property graph with numeric ids.

    nodes: (id, labels, identifier, name, equivalents). relations: (label, start, end, source). categories:
    (label, category). predicates: (label, predicate, flip): a label as a whole goes before the label without its
    last part. sources: (source, infores), by name in lower case without spaces.
    """
    typed = nodes.withColumn("label", F.get("labels", F.lit(0))).join(categories, "label", "left")
    typed = typed.withColumn("category", F.coalesce("category", F.lit(default_category)))
    good = typed.where("category IS NOT NULL AND identifier IS NOT NULL")
    out = _nodes(good, provider, id=F.col("identifier"), name=X.clean_text("name"), categories=F.array("category"), equivalent_ids=X.union_lists("equivalents", F.array("identifier")))
    ids = good.select("id", "identifier")
    shorter = F.regexp_replace("label", "_[^_]*$", "")
    short = predicates.select(F.col("label").alias("short"), F.col("predicate").alias("p2"), F.col("flip").alias("f2"))
    told = relations.withColumn("short", shorter).join(predicates, "label", "left").join(short, "short", "left")
    told = told.withColumn("key", F.lower(F.replace("source", F.lit(" "), F.lit("")))).join(sources.select(F.col("source").alias("key"), "infores"), "key", "left")
    told = told.join(ids.select(F.col("id").alias("start"), F.col("identifier").alias("s")), "start", "left").join(ids.select(F.col("id").alias("end"), F.col("identifier").alias("o")), "end", "left")
    told = told.withColumns({"p": F.coalesce("predicate", "p2"), "f": F.coalesce("flip", "f2", F.lit(False))})
    reason = F.when(F.col("p").isNull(), "unmapped_label").when(F.col("infores").isNull(), "unmapped_source").when(F.col("s").isNull() | F.col("o").isNull(), "unknown_endpoint")
    told = told.withColumn("reason", reason)
    kept = told.where("reason IS NULL")
    edges = _edges(kept, provider, subject=F.when(F.col("f"), F.col("o")).otherwise(F.col("s")), object=F.when(F.col("f"), F.col("s")).otherwise(F.col("o")), predicate=F.col("p"), primary_knowledge_source=F.col("infores"), aggregator_knowledge_source=F.array(F.lit(provider)), knowledge_level=F.lit(S.NOT_PROVIDED), agent_type=F.lit(S.NOT_PROVIDED))
    lost = typed.where("category IS NULL OR identifier IS NULL").select(F.lit("node").alias("entity"), F.lit("unmapped_label").alias("reason"), F.col("label").alias("value"))
    return out, edges, lost.unionByName(told.where("reason IS NOT NULL").select(F.lit("edge").alias("entity"), "reason", F.coalesce("label", F.lit("")).alias("value")))


# Tables of terms


def part_links(rows: DataFrame, provider: str) -> tuple[DataFrame, DataFrame]:
    """rows: (observable, part, concept). A node for each observable and concept, an edge for each row.

    Only the first part of a concept, here the smallest, is equivalent to it.
    """
    o = F.concat(F.lit("LOINC:"), "observable")
    observables = _nodes(rows.select(o.alias("id")).distinct(), provider, id=F.col("id"), categories=F.array(F.lit("biolink:ClinicalFinding")), equivalent_ids=F.array("id"))
    first = rows.groupBy("concept").agg(F.min("part").alias("part"))
    c = F.concat(F.lit("UMLS:"), "concept")
    concepts = _nodes(first, provider, id=c, categories=F.array(F.lit("biolink:NamedThing")), equivalent_ids=F.array(c, F.concat(F.lit("LOINC:"), "part")))
    edges = _edges(rows, provider, subject=o, object=c, predicate=F.lit("biolink:related_to"))
    return observables.unionByName(concepts), edges


def molecules(rows: DataFrame, provider: str, prefix: str, id_col: str, name: str, xrefs: dict[str, str], synonyms: tuple[str, ...] = (), listed: str | None = None, formula: str = "formula", mass: str = "exactmass", attributes: tuple[str, ...] = (), order: str | None = None) -> DataFrame:
    """Small molecules of a table, one per id: the last row by ``order`` wins. xrefs: column to prefix.

    listed: a column with names parted by semicolons.
    """
    last = A.first_per_key(rows, [id_col], [F.col(order).desc()]) if order else rows.dropDuplicates([id_col])
    eq = [F.when(~X.is_empty_string(f"`{c}`"), F.concat(F.lit(f"{p}:"), F.col(f"`{c}`"))) for c, p in xrefs.items()]
    own = F.concat(F.lit(f"{prefix}:"), F.trim(F.col(f"`{id_col}`")))
    names = [X.to_list(F.trim(F.col(c))) for c in (name, *synonyms)]
    if listed:
        names.append(F.transform(F.split(F.coalesce(F.col(listed), F.lit("")), ";"), F.trim))
    props = spec.property_map(last, list(attributes), {})
    return _nodes(last, provider, id=own, name=F.col(name), categories=F.array(F.lit("biolink:SmallMolecule")), equivalent_ids=X.union_lists(F.array_compact(F.array(own, *eq))), synonyms=X.absent_if_empty(X.nonempty(X.union_lists(*names))), chemical_formula=F.col(formula), exact_mass=X.to_float(F.col(mass).cast("string")), attributes=F.when(props.isNotNull(), F.create_map(F.lit(provider), props)))


# Scales that denote a measurement, scales of documents, and class types of information.
MEASUREMENT_SCALES, NARRATIVE_SCALES, INFORMATION_CLASSES = ["Qn", "SemiQn", "OrdQn", "Nom", "Ord"], ["Doc", "Nar"], ["3", "4"]


def scale_category(scale: str = "SCALE_TYP", kind: str = "CLASSTYPE") -> Column:
    s, k = F.trim(F.coalesce(scale, F.lit(""))), F.trim(F.coalesce(kind, F.lit("")))
    information = k.isin(INFORMATION_CLASSES) | s.isin(NARRATIVE_SCALES)
    return F.when(information, "biolink:InformationContentEntity").when(s.isin(MEASUREMENT_SCALES), "biolink:ClinicalMeasurement").otherwise("biolink:NamedThing")


# Data elements


def preferred_name(designations: str | Column, priority: list[str], generic: list[str]) -> Column:
    """The name under the best tag (an untagged one has the tag "<untagged>").

    If that is a generic word, a longer and not generic one of the others takes its place, if there is any.
    """
    d = X.col(designations)
    tag = lambda x: F.when(F.size(x["tags"]) > 0, F.get(x["tags"], F.lit(0))).otherwise("<untagged>")
    place = lambda x: F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, priority)), tag(x)), F.lit(0)), F.lit(len(priority) + 1))
    ranked = F.array_sort(F.transform(F.filter(d, lambda x: ~X.is_empty_string(x["designation"])), lambda x, i: F.struct(place(x).alias("p"), i.alias("i"), F.trim(x["designation"]).alias("name"))))
    best = F.get(ranked, F.lit(0))["name"]
    is_generic = lambda n: F.lower(n).isin(*generic) if generic else F.lit(False)
    better = F.get(F.filter(ranked, lambda x: (F.length(x["name"]) > F.length(best)) & ~is_generic(x["name"])), F.lit(0))["name"]
    return F.when(is_generic(best), F.coalesce(better, best)).otherwise(best)


def code_curies(origin: Column, code: Column, vocabularies: dict[str, str]) -> Column:
    """CURIEs of a code, whose parts are split at colons; none for an unknown vocabulary."""
    table = F.create_map(*[F.lit(x) for kv in vocabularies.items() for x in kv])
    prefix = F.try_element_at(table, F.lower(F.trim(origin)))
    parts = F.filter(F.transform(F.split(code, ":"), F.trim), lambda p: p != "")
    return F.when(prefix.isNotNull() & code.isNotNull(), F.transform(parts, lambda p: F.concat(F.upper(prefix), F.lit(":"), p))).otherwise(F.array().cast(LIST))


def data_element_edges(concepts: DataFrame, provider: str, blocked: DataFrame) -> DataFrame:
    """concepts: (element, curie, kind, position); kind assesses goes before related_to for the same object.

    blocked: (curie) of concepts too general for an edge.
    """
    kind = F.when(F.col("kind") == "assesses", 0).otherwise(1)
    once = A.first_per_key(concepts.join(blocked, "curie", "left_anti"), ["element", "curie"], [kind, F.col("position")])
    return _edges(once, provider, subject=F.col("element"), object=F.col("curie"), predicate=F.concat(F.lit("biolink:"), "kind"))


# Scores over variants and genes


def selected_scores(scores: DataFrame, samples: DataFrame, least: int = 5, per_trait: int = 1) -> DataFrame:
    """The scores of each trait with most evaluations. scores: (trait, score, position); samples: (score, sample_set)."""
    n = samples.groupBy("score").agg(F.count_distinct("sample_set").alias("evaluations"))
    counted = scores.join(n, "score", "left").withColumn("evaluations", F.coalesce("evaluations", F.lit(0))).where(F.col("evaluations") >= least)
    return A.top_per_group(counted, ["trait"], [F.desc("evaluations"), F.col("position")], per_trait).drop("rank")


def score_genes(variants: DataFrame, genes: DataFrame, most_variants: int = 100_000, most_genes: int = 500, bin_width: int = 1 << 17) -> DataFrame:
    """(score, gene_id, variants, variance): genes that hold a score's heaviest variants, by summed variance.

    variants: (score, contig, at, weight, frequency); genes: (contig, start, end, gene_id).
    """
    v = variants.withColumn("share", X.variance_share("weight", "frequency"))
    top = A.top_per_group(v, ["score"], [F.desc("share"), F.col("contig"), F.col("at")], most_variants).drop("rank")
    held = A.range_join(top, genes, "contig", "at", "start", "end", bin_width).groupBy("score", "gene_id").agg(F.count("*").alias("variants"), F.sum("share").alias("variance"))
    return A.top_per_group(held, ["score"], [F.desc("variance"), F.col("gene_id")], most_genes).drop("rank")


# Correlates of one minted node


def correlates(rows: DataFrame, centre: str, provider: str, curie: str, predicate: Column, attributes: dict[str, Column], publications: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """A star around ``centre``: an edge for each row whose predicate and CURIE are known, and nodes for the ends.

    attributes: name to value; values are rounded to six places by the caller where they should be.
    """
    kept = rows.withColumn("_p", predicate).where(F.col("_p").isNotNull() & X.curie_parts(F.col(curie)).isNotNull())
    entries = F.filter(F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in attributes.items()]), lambda e: e["value"].isNotNull()) if attributes else None
    props = F.when(F.size(entries) > 0, F.create_map(F.lit(provider), F.map_from_entries(entries))) if attributes else F.lit(None).cast(S.ATTRIBUTES)
    pubs = F.array(*map(F.lit, publications)) if publications else F.lit(None).cast(S.LIST)
    edges = _edges(kept, provider, subject=F.lit(centre), object=F.col(curie), predicate=F.col("_p"), knowledge_level=F.lit("statistical_association"), agent_type=F.lit("data_analysis_pipeline"), publications=pubs, attributes=props)
    ends = kept.select(F.col(curie).alias("id")).distinct()
    nodes = _nodes(ends, provider, id=F.col("id"), categories=F.array(F.lit("biolink:NamedThing")), equivalent_ids=F.array("id"))
    hub = _nodes(rows.sparkSession.range(1), provider, id=F.lit(centre), categories=F.array(F.lit("biolink:NamedThing")), equivalent_ids=F.array(F.lit(centre)))
    return hub.unionByName(nodes), edges


def direction_predicate(c: str | Column, up: str = "biolink:positively_correlated_with", down: str = "biolink:negatively_correlated_with") -> Column:
    d = F.lower(F.trim(X.col(c)))
    return F.when(d == "increased", up).when(d == "decreased", down)


def sign_predicate(value: str | Column, p_value: str | Column, below: float = 0.05, up: str = "biolink:positively_correlated_with", down: str = "biolink:negatively_correlated_with") -> Column:
    v, p = X.to_float(value), X.to_float(p_value)
    return F.when((p < below) & (v > 0), up).when((p < below) & (v < 0), down)


# Categories, predicate and texts of scores.
SCORE_CATEGORY, TRAIT_CATEGORY, SCORE_TRAIT = "biolink:InformationContentEntity", "biolink:DiseaseOrPhenotypicFeature", "biolink:related_to"


def score_graph(scores: DataFrame, traits: DataFrame, provider: str, prefix: str = "PGS", category: str = SCORE_CATEGORY, trait_category: str = TRAIT_CATEGORY, predicate: str = SCORE_TRAIT) -> tuple[DataFrame, DataFrame]:
    """Nodes of scores and of the traits they predict, and an edge for each of their pairs.

    scores: (score, name, pmid, reported_trait, mapped_trait_label) and other columns, which become attributes where
    they are not empty. traits: (score, trait, label, evaluations); a trait's name is its smallest label.
    """
    core = {"score", "name", "pmid"}
    label = F.coalesce(F.nullif("reported_trait", F.lit("")), F.nullif("mapped_trait_label", F.lit("")))
    own = spec.property_map(scores, [c for c in scores.columns if c not in core], {})
    accession = F.create_map(F.lit("pgs_catalog_id"), F.to_json(F.array("score")))
    accession = F.transform_values(accession, lambda _, v: F.substring(v, F.lit(2), F.length(v) - 2))
    curie = F.concat(F.lit(f"{prefix}:"), "score")
    given = lambda c: ~X.is_empty_string(c)
    nodes = _nodes(
        scores, provider, id=curie, name=F.coalesce(F.concat(label, F.lit(" PGS")), F.col("name")), categories=F.array(F.lit(category)), equivalent_ids=F.array(curie), synonyms=F.when(given("name"), F.array("name")),
        description=F.when(F.nullif("reported_trait", F.lit("")).isNotNull(), F.concat(F.lit("Polygenic score for "), "reported_trait")), publications=F.when(given("pmid"), F.array(F.concat(F.lit("PMID:"), "pmid"))),
        attributes=F.create_map(F.lit(provider), F.map_concat(accession, F.coalesce(own, F.create_map().cast(S.MAP)))),
    )
    stubs = traits.groupBy("trait").agg(F.min("label").alias("label"))
    known = _nodes(stubs, provider, id=F.col("trait"), name=F.col("label"), categories=F.array(F.lit(trait_category)), equivalent_ids=F.array("trait"))
    told = F.when(F.col("evaluations") > 0, F.create_map(F.lit(provider), F.create_map(F.lit("num_evaluation_sample_sets"), F.col("evaluations").cast("string"))))
    edges = _edges(traits.join(scores.select("score"), "score", "left_semi"), provider, subject=curie, object=F.col("trait"), predicate=F.lit(predicate), knowledge_level=F.lit("statistical_association"), agent_type=F.lit("data_analysis_pipeline"), attributes=told)
    return nodes.unionByName(known), edges


# Actionability records


def actionable(records: DataFrame) -> DataFrame:
    """(doc, gene, gene_omim, disease): gene-disease pairs of adult records that are complete."""
    adult = records.select(F.col("docId").alias("doc"), F.col("context.Adult").alias("a")).where("a IS NOT NULL AND lower(coalesce(a.status.stg2, '')) != 'incomplete'")
    genes = adult.select("doc", F.explode("a.genes").alias("g"))
    return genes.select("doc", F.col("g.gene").alias("gene"), F.col("g.geneOmim").alias("gene_omim"), F.explode("g.diseases").alias("disease"))


def assertion_of(pairs: DataFrame, assertions: DataFrame) -> DataFrame:
    """Each pair with the first assertion of its gene that names the disease's whole id; null if there is none.

    pairs: (gene, disease_id); assertions: (gene, position, assertion).
    """
    whole = F.concat(F.lit(r"(^|[^A-Za-z0-9])\Q"), F.col("disease_id"), F.lit(r"\E($|[^A-Za-z0-9])"))
    met = pairs.join(assertions, "gene").where(F.rlike("assertion", whole))
    first = A.first_per_key(met, ["gene", "disease_id"], [F.col("position")]).select("gene", "disease_id", "assertion")
    return pairs.join(first, ["gene", "disease_id"], "left")
