"""The plan for a mixed property graph: one stream of nodes and relationships with labels, numeric ids and free properties.

Node ids become CURIEs by their type and by the word that tells their vocabulary; relationships are mapped by label and
source, turned round where the vocabulary wants it, and joined to the CURIEs of their ends. What fits no table comes out
as a reject instead of ending the build.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import identifiers as I
from ..functions import scalars as X
from ..functions import schema as S

# Label, or label and source, to category.
CATEGORIES = """
Compound ChemicalEntity
Variant SequenceVariant
Organism--ncbi-taxonomy OrganismTaxon
Organism--BV-BRC OrganismalEntity
Protein Protein
Location GeographicLocation
ClinicalLab ClinicalFinding
Reaction MolecularActivity
Gene Gene
ProteinDomain ProteinDomain
DietarySupplement Food
Anatomy AnatomicalEntity
BiologicalProcess BiologicalProcess
CellLine CellLine
Disease Disease
EC BiologicalEntity
PwGroup MacromolecularComplex
Pathway Pathway
SideEffect DiseaseOrPhenotypicFeature
Blend ChemicalMixture
MolecularFunction MolecularActivity
CellType Cell
MiRNA MicroRNA
Complex MacromolecularComplex
Symptom PhenotypicFeature
Haplotype Haplotype
CellularComponent CellularComponent
ExtracellularParticle CellularComponent
SDoH SocioeconomicExposure
Cytoband GenomicEntity
ProteinFamily ProteinFamily
PharmacologicClass Drug
Environment EnvironmentalFeature
"""

# The category of proteins under ids that hold this.
FEATURE_ID, FEATURE_CATEGORY = "PRO_", "Polypeptide"

# Relationship label, or the label without its last part, to predicate; then "flip" where the ends change
# places, "direction=" and "aspect=" where the object is qualified.
PREDICATES = """
PREVALENCEIN associated_with
INTERACTS interacts_with
INTERACTS_as_LR physically_interacts_with
MAPS is_sequence_variant_of
TARGETS regulates
EXPRESSES expressed_in flip
DOWNREGULATES regulates direction=downregulated
BINDS binds
UPREGULATES regulates direction=upregulated
REGULATES regulates
EXPRESSEDIN expressed_in
EXPRESSEDIN_GeiD gene_associated_with_condition
PARTICIPATES has_participant flip
BELONGS related_to
ASSOCIATES associated_with
ISA subclass_of
PARTOF has_part flip
ENCODES_GeP gene_product_of flip
ENCODES_GeM gene_product_of flip
ENCODES_OeP produces
HAS related_to
PREVALENCE associated_with
ISOLATEDIN located_in
RESPONDS_TO affects flip
CAUSES causes
CONTAINS has_part
FOUNDIN located_in
PRESENTS has_phenotype
RESEMBLES similar_to
MEASURESIN related_to
LOCALIZES disease_has_location
PRODUCES produces
MEASURES assesses
TREATS treats
CONSUMES consumes
HASROLE has_chemical_role
MENTIONED_CLINICAL_TRIALS_FOR mentioned_in_clinical_trials_for
IN_CLINICAL_TRIALS_FOR in_clinical_trials_for
CATALYZES catalyzes
MARKER_NEG exacerbates_condition
MARKER_POS ameliorates_condition
AFFECTS affects
INCREASEDIN has_increased_amount flip
CONTRAINDICATES contraindicated_in
MORTALITY occurs_in
MEMBEROF has_member flip
INCLUDES has_member
AFFECT affects_response_to
TRANSPORTS affects aspect=transport
DERIVES_FROM derives_from
CLEAVESTO affects aspect=cleavage
RESPONSE_TO affects_response_to
SAME same_as
RESISTANT_TO associated_with_resistance_to
DECREASEDIN has_decreased_amount flip
ADVRESPONSE_TO contraindicated_in flip
REDUCES_SEN decreases_response_to
"""

# Source, in lower case without spaces, to the name of its information resource.
SOURCES = """
ahrqsdohdatabase ahrq-sdoh
bgee infores:bgee
mirdb mirdb
opentargets infores:open-targets
string infores:string
stitch infores:stitch
humanproteinatlas infores:hpa
ncbigene2go ncbi-gene2go
bindingdb infores:bindingdb
cmap/lincscompound(trt_cp) infores:lincs
bv-brc bv-brc
uniprot infores:uniprot
intact infores:intact
cmap/lincsknockdown(trt_xrt,trt_sh) infores:lincs
clinvar infores:clinvar
interpro infores:interpro
chebi infores:chebi
hpo infores:hpo
places cdc-places
cancercelllineencyclopedia ccle
nhanes nhanes
countyhealthrankings chr-r
loinc infores:loinc
ncbipubmed infores:pubmed
sider4.1 infores:sider
unitedstateszipcode_database us-zipcode
protcid prot-cid
metacyc infores:metacyc
cmap/lincsoverexpression(trt_oe) infores:lincs
wikipathways infores:wikipathways
ctkp infores:multiomics-clinicaltrials
diseases infores:diseases
chembl infores:chembl
kegg infores:kegg
drugcentral infores:drugcentral
celltaxonomy cell-taxonomy
bioplex(pharos) infores:pharos
tflink tf-link
tri tri
ucmr5 ucmr
superfund epa-superfund
reactome infores:reactome
uberon infores:uberon
gwascatalog infores:gwas-catalog
ensemblhg38 infores:ensembl-gene
cmap/lincsligand(trt_lig) infores:lincs
ucmr4 ucmr
diseaseontology infores:disease-ontology
cancerrx infores:gdsc
ncbi-taxonomy infores:ncbi-taxonomy
worldhealthorganization who
worldhealhorganization who
celllineontology clo
pfam infores:pfam
gwas infores:gwas-catalog
pharmvar pharmvar
explorenz explor-enz
complexportal infores:complex-portal
2020nationalemissionsinventory(nei)data epa-nei
cellontology infores:cl
whoambientairqualitydatabase who-air-quality
geonames geonames
cdc/atsdrsocialvulnerabilityindex svi
pharmgkb infores:pharmgkb
cellosaurus cellosaurus
tcdb tcdb
mirbase infores:mirbase
eqtlcatalogue eqtl-catalogue
cellphonedb cellphone-db
civic infores:civic
nationalcenterforhealthstatistics.u.s.censusbureau,householdpulsesurvey,2024.lackofsocialconnection4.2 pulse-survey
pathophenodb infores:path-pheno-db
airqualitystatisticsreport epa-air-quality-stats
https://github.com/hadlock_lab/recover/ hadlock-recover
https://github.com/hadlock_lab/incov/ hadlock-incov
"""

# Node type and source or property, in lower case without spaces, to the vocabularies of its local names.
VOCABULARIES = """
Anatomy mesh_id mesh
Anatomy uberon uberon
BiologicalProcess go go
Blend nhanes nhanes
CellLine celllineontology clo
CellLine clo clo
CellLine cvcl cvcl
CellType cl cl
CellularComponent go go
ClinicalLab unknown loinc,umls
Complex complexportal complexportal
Compound chebi chebi
Compound chembl_ids chembl.compound
Compound chembl.compound chembl.compound
Compound drugbank_ids drugbank
Compound inchikey inchikey
Compound kegg_compound_ids kegg.compound
Compound kegg_drug_ids kegg.drug
Compound pubchem_compound_ids pubchem.compound
Cytoband unknown cytoband
DietarySupplement nhanes nhanes
Disease doid doid
Disease icd9 icd9
Disease icd10 icd10
Disease mesh_list mesh
Disease omim_list omim
Disease snomedct snomedct
EC explorenz ec
EC metacyc metacyc.ec
Environment bfo bfo
Environment envo envo
ExtracellularParticle vesiclepedia vesiclepedia
Gene accession mirbase
Gene chembl_id chembl.target
Gene entrezgene ncbigene
Gene mirbase ncbigene
Haplotype unknown pharmvar,dbsnp
Location geonames geonames
Location unitedstateszipcode_database uszipcode,fips.place,fips.state
MiRNA accession mirbase
MiRNA mirdb mirdb
MolecularFunction go go
Organism bv-brc bvbrc
Organism ncbi-taxonomy ncbitaxon
Pathway reactome react
Pathway unknown metacyc.pathway
Pathway wikipathways wikipathways
PharmacologicClass fdaviadrugcentral ndfrt,mesh
Protein chembl_id chembl.target
Protein uniprot uniprotkb
ProteinDomain pfam pfam
ProteinFamily pfam pfam
PwGroup reactome react
Reaction kegg kegg.reaction
Reaction metacyc metacyc.reaction
Reaction reactome react
SDoH ahrqsdohdatabase ahrq
SDoH cdc/atsdrsocialvulnerabilityindex cdcsvi
SDoH chr chr
SDoH hps hps
SDoH mesh_ids mesh
SDoH snomed snomedct
SideEffect sider4.1 umls
Symptom hpo mesh
Symptom icd9 icd9
Symptom icd10 icd10
Symptom mesh mesh
Symptom snomedct snomedct
Variant dbsnp dbsnp
Variant unknown dbsnp
"""

# Properties that don't become attributes, besides those that hold identifiers.
PLAIN = "identifier mate_version name sources smiles standardized_smiles synonyms description license reverse_degrees forward_degrees source database".split()

#: Of a line of the stream; properties are kept as their JSON text, so a list and a scalar can share a name.
ITEM = "type string, id string, labels array<string>, label string, start struct<id:string>, end struct<id:string>, properties map<string,string>"
NO_SOURCE = "unknown"


class Graph(NamedTuple):
    nodes: DataFrame
    edges: DataFrame
    #: (entity, reason, value, n)
    rejects: DataFrame


def _lines(text: str) -> list[list[str]]:
    return [line.split() for line in text.strip().splitlines()]


def _map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def items_of(lines: DataFrame, c: str = "value") -> DataFrame:
    """The items of JSON lines."""
    return lines.select(F.from_json(c, ITEM).alias("i")).select("i.*")


def clean_word(c: Column) -> Column:
    return F.lower(F.replace(c, F.lit(" "), F.lit("")))


def listed(c: Column) -> Column:
    """A property as a list of strings, whether its text is a JSON list or a scalar."""
    given = F.when(F.startswith(F.trim(c), F.lit("[")), F.from_json(c, "array<string>")).otherwise(F.array(c))
    return F.filter(F.coalesce(given, F.array().cast(S.LIST)), lambda x: F.coalesce(F.trim(x) != "", F.lit(False)))


def _sources() -> Column:
    p = F.col("properties")
    return F.concat(listed(F.try_element_at(p, F.lit("source"))), listed(F.try_element_at(p, F.lit("sources"))))


def identified(kind: Column, word: Column, raw: Column, rules: I.Rules | None) -> Column:
    """struct(curie, invalid): the CURIE of an identifier of a node type. Its own prefix goes before the given word."""
    parts = I.id_parts(raw)
    said = clean_word(F.when(parts["prefix"] != "", parts["prefix"]).otherwise(word))
    vocabularies = F.split(F.try_element_at(_map({f"{k} {w}": v for k, w, v in _lines(VOCABULARIES)}), F.concat_ws(" ", kind, said)), ",")
    wrong = I.known_invalid(parts["local"], vocabularies)
    return F.struct(F.when(~wrong & (parts["local"] != ""), I.curie_of(vocabularies, parts["local"], rules)).alias("curie"), F.coalesce(wrong, F.lit(False)).alias("invalid"))


def _category(label: Column, source: Column, curie: Column) -> Column:
    table = _map({k: f"biolink:{v}" for k, v in _lines(CATEGORIES)})
    found = F.coalesce(F.try_element_at(table, label), F.try_element_at(table, F.concat_ws("--", label, source)))
    return F.when((label == "Protein") & F.contains(curie, F.lit(FEATURE_ID)), f"biolink:{FEATURE_CATEGORY}").otherwise(found)


def attributes(own_id: Column, provider: str) -> Column:
    """What is left of the properties, and the id in the stream, by the provider."""
    aside = F.array(*[F.lit(w) for w in sorted({*PLAIN, *(w for _, w, _ in _lines(VOCABULARIES))})])
    kept = F.map_filter(F.col("properties"), lambda k, v: ~F.array_contains(aside, clean_word(k)) & ~I.is_id_property(k) & ~v.isin("", "[]", "{}") & v.isNotNull())
    return F.create_map(F.lit(provider), F.map_concat(F.create_map(F.lit("spoke_id"), own_id), F.coalesce(kept, F.create_map().cast(S.MAP))))


def _placed(items: DataFrame, rules: I.Rules | None) -> DataFrame:
    """Nodes with their type, source, CURIE and equivalents; reason says why one is rejected."""
    p = F.col("properties")
    get = lambda name: F.try_element_at(p, F.lit(name))
    df = items.where("type = 'node'").withColumns({"kind": F.get("labels", F.lit(0)), "word": F.coalesce(F.get(_sources(), F.lit(0)), F.lit(NO_SOURCE))})
    complex_ = (F.col("word") == "Complex Portal") & (F.col("kind") == "Complex")
    df = df.withColumn("found", identified(F.col("kind"), F.col("word"), F.when(complex_, get("complex_portal")).otherwise(F.coalesce(get("identifier"), F.col("id"))), rules))
    named = F.filter(F.map_entries(F.coalesce(p, F.create_map().cast(S.MAP))), lambda e: I.is_id_property(e["key"]))
    members = F.flatten(F.transform(named, lambda e: F.transform(X.nonempty(F.filter(listed(e["value"]), lambda x: F.lower(x) != "nan")), lambda x: identified(F.col("kind"), e["key"], x, rules)["curie"])))
    df = df.withColumns({"curie": F.col("found.curie"), "more": F.array_compact(members)})
    df = df.withColumn("categories", F.transform("labels", lambda x: _category(x, F.col("word"), F.col("curie"))))
    reason = F.when(F.coalesce(F.size("labels"), F.lit(0)) <= 0, "no_label").when(F.col("found.invalid"), "known_invalid").when(F.col("curie").isNull(), "unmapped_id")
    return df.withColumn("reason", reason.when(F.exists("categories", lambda c: c.isNull()), "unmapped_label"))


def _told(items: DataFrame) -> DataFrame:
    """Relationships with predicate, sources, and which ends are subject and object."""
    table, source = {k: rest for k, *rest in _lines(PREDICATES)}, _map(dict(_lines(SOURCES)) | {NO_SOURCE: NO_SOURCE})
    exact, core = F.col("label"), F.regexp_replace("label", "_?[^_]*$", "")
    known = F.array(*map(F.lit, table))
    key = F.when(F.array_contains(known, exact), exact).when(F.array_contains(known, core), core)
    part = lambda of: F.try_element_at(_map({k: v for k, rest in table.items() if (v := of(rest)) is not None}), F.col("key"))
    after = lambda rest, name: next((x.removeprefix(name) for x in rest if x.startswith(name)), None)
    df = items.where("type = 'relationship'").withColumn("key", key).withColumn("all", _sources())
    df = df.withColumns({
        "predicate": part(lambda rest: f"biolink:{rest[0]}"), "flip": part(lambda rest: "flip" if "flip" in rest else None).isNotNull(), "direction": part(lambda rest: after(rest, "direction=")), "aspect": part(lambda rest: after(rest, "aspect=")),
        "primary": F.try_element_at(source, clean_word(F.coalesce(F.get("all", F.lit(0)), F.lit(NO_SOURCE)))), "others": F.transform(F.slice("all", 2, 1 << 30), lambda x: F.coalesce(F.try_element_at(source, clean_word(x)), F.concat(F.lit("?"), x))),
    })
    return df.withColumns({"from": F.when(F.col("flip"), F.col("end.id")).otherwise(F.col("start.id")), "to": F.when(F.col("flip"), F.col("start.id")).otherwise(F.col("end.id"))})


def mixed_graph(items: DataFrame, provider: str = "infores:spoke", levels: DataFrame | None = None, rules: I.Rules | None = None) -> Graph:
    """Nodes, edges and counted rejects of the items (see ITEM).

    levels: (infores, knowledge_level, agent_type) of information resources; one that is not among them is not provided.
    rules: what CURIEs and local names of the vocabularies look like; without them every name fits its first vocabulary.
    """
    placed, told = _placed(items, rules), _told(items)
    good = placed.where("reason IS NULL")
    get = lambda name: F.try_element_at(F.col("properties"), F.lit(name))
    own = {
        "id": F.col("curie"), "name": X.clean_text(get("name")), "categories": F.array_sort(F.array_distinct("categories")), "provided_by": F.array(F.lit(provider)), "synonyms": X.absent_if_empty(X.union_lists(X.nonempty(listed(get("synonyms"))), X.to_list(get("name")))),
        "equivalent_ids": X.union_lists(F.array("curie"), F.col("more")), "description": X.clean_text(get("description")), "attributes": attributes(F.col("id"), provider),
    }
    nodes = good.select(*[(own[f.name] if f.name in own else F.lit(None).cast(f.dataType)).alias(f.name) for f in S.NODE.fields])
    ends = good.select("id", "curie")
    met = told.join(ends.select(F.col("id").alias("from"), F.col("curie").alias("subject")), "from", "left").join(ends.select(F.col("id").alias("to"), F.col("curie").alias("object")), "to", "left")
    met = met.withColumn("primary", F.when(F.col("primary") == NO_SOURCE, provider).otherwise(F.col("primary")))
    none = F.lit(S.NOT_PROVIDED)
    if levels is None:
        met = met.withColumns({"level": none, "agent": none})
    else:
        met = met.join(levels.select(F.col("infores").alias("primary"), F.col("knowledge_level").alias("level"), F.col("agent_type").alias("agent")), "primary", "left").withColumns({"level": F.coalesce("level", none), "agent": F.coalesce("agent", none)})
    unknown = F.exists("others", lambda x: F.startswith(x, F.lit("?")))
    reason = F.when(F.col("predicate").isNull(), "unmapped_label").when(F.col("primary").isNull() | unknown, "unmapped_source").when(F.col("subject").isNull() | F.col("object").isNull(), "unknown_endpoint")
    met = met.withColumn("reason", reason)
    said = F.map_filter(F.create_map(F.lit("object_direction_qualifier"), "direction", F.lit("object_aspect_qualifier"), "aspect"), lambda _, v: v.isNotNull())
    own = {
        "subject": F.col("subject"), "object": F.col("object"), "predicate": F.col("predicate"), "qualifiers": F.when(F.size(said) > 0, said), "primary_knowledge_source": F.col("primary"), "aggregator_knowledge_source": F.array(F.lit(provider)),
        "supporting_data_sources": X.absent_if_empty(F.array_sort(F.array_distinct("others"))), "knowledge_level": F.col("level"), "agent_type": F.col("agent"), "publications": X.absent_if_empty(F.array_sort(X.publication_ids(listed(get("pubmedIDs"))))), "attributes": attributes(F.col("id"), provider),
    }
    edges = met.where("reason IS NULL").select(*[(own[f.name] if f.name in own else F.lit(None).cast(f.dataType)).alias(f.name) for f in S.EDGE.fields])
    lost = placed.where("reason IS NOT NULL").select(F.lit("node").alias("entity"), "reason", F.concat_ws(" ", "kind", "word").alias("value"))
    lost = lost.unionByName(met.where("reason IS NOT NULL").select(F.lit("edge").alias("entity"), "reason", F.coalesce("label", F.lit("")).alias("value")))
    return Graph(nodes, edges, lost.groupBy("entity", "reason", "value").agg(F.count("*").alias("n")))


def infores_levels(catalog: DataFrame) -> DataFrame:
    """(infores, knowledge_level, agent_type) of a catalog of information resources, read as one JSON document."""
    rows = catalog.select(F.explode("information_resources").alias("r"))
    have = {f.name for f in rows.schema["r"].dataType.fields}
    of = lambda c: F.coalesce(F.col(f"r.{c}"), F.lit(S.NOT_PROVIDED)) if c in have else F.lit(S.NOT_PROVIDED)
    return rows.select(F.col("r.id").alias("infores"), of("knowledge_level").alias("knowledge_level"), of("agent_type").alias("agent_type")).dropDuplicates(["infores"])
