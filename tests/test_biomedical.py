from pyspark.sql import functions as F

from weftline.functions import identifiers as I
from weftline.operators import resolve
from weftline.plans import biomedical as B
from weftline.plans import mixed_graph as MG
from weftline.sources import readers, registry


def test_identifier_rules(spark):
    rows = spark.createDataFrame([("SNOMED_12",), ("x12 ",), ("CHEBI: 7",), ("http://a",), ("a:b:c",), ("x_1",)], "v string").select(I.id_parts("v").alias("p")).collect()
    assert [tuple(r.p) if r.p else None for r in rows] == [("SNOMED", "12"), ("", "x12"), ("CHEBI", "7"), ("", "http://a"), None, ("", "x_1")]
    names = ["KEGG_id", "icd10", "name_id", "mesh_list", "mesh", "kegg_compound_ids", "omim_list", "chembl"]
    assert [r.b for r in spark.createDataFrame([(n,) for n in names], "n string").select(I.is_id_property("n").alias("b")).collect()] == [True, True, False, True, False, True, True, False]
    bad = spark.createDataFrame([("-", "x"), ("Glycan", "metacyc.pathway"), ("PWY-1", "metacyc.pathway"), ("12", "metacyc.pathway"), ("1e+5", "snomedct"), ("root", "chebi"), ("7", "chebi"), ("1,2", "dbsnp"), ("http://c", "clo")], "l string, v string")
    assert [r.b for r in bad.select(I.known_invalid(F.col("l"), F.array("v")).alias("b")).collect()] == [True, True, False, True, True, True, False, True, True]


def test_property_graph(spark):
    nodes = spark.createDataFrame([(1, ["Gene"], "G:1", "g", ["E:1"]), (2, ["Disease"], "D:2", "d", None), (3, ["Odd"], "O:3", "o", None)], "id int, labels array<string>, identifier string, name string, equivalents array<string>")
    rel = spark.createDataFrame([("ASSOCIATES_GaD", 1, 2, "Dis GeNet"), ("TREATS", 1, 2, "disgenet"), ("NOPE", 1, 2, "disgenet"), ("TREATS", 1, 9, "disgenet"), ("TREATS", 1, 2, "?")], "label string, start int, end int, source string")
    n, e, lost = B.property_graph(nodes, rel, spark.createDataFrame([("Gene", "C:G"), ("Disease", "C:D")], "label string, category string"), spark.createDataFrame([("ASSOCIATES", "p:a", False), ("TREATS", "p:t", True)], "label string, predicate string, flip boolean"), spark.createDataFrame([("disgenet", "infores:d")], "source string, infores string"), "infores:s")
    assert {r.id: r.equivalent_ids for r in n.collect()} == {"G:1": ["E:1", "G:1"], "D:2": ["D:2"]}
    assert {(r.subject, r.predicate, r.object) for r in e.collect()} == {("G:1", "p:a", "D:2"), ("D:2", "p:t", "G:1")}
    assert sorted(r.reason for r in lost.collect()) == ["unknown_endpoint", "unmapped_label", "unmapped_label", "unmapped_source"]


def test_part_links_and_molecules(spark):
    n, e = B.part_links(spark.createDataFrame([("1-1", "LP2", "C9"), ("1-2", "LP1", "C9")], "observable string, part string, concept string"), "infores:u")
    assert {r.id: r.equivalent_ids for r in n.collect()} == {"LOINC:1-1": ["LOINC:1-1"], "LOINC:1-2": ["LOINC:1-2"], "UMLS:C9": ["UMLS:C9", "LOINC:LP1"]} and e.count() == 2
    rows = spark.createDataFrame([("RM1", "old", "C6", "1.5", "", 1), ("RM1", "new", "C6", "2.5", "77", 2)], "` refmet_id` string, refmet_name string, formula string, exactmass string, chebi_id string, line int")
    (m,) = B.molecules(rows, "infores:r", "RM", " refmet_id", "refmet_name", {"chebi_id": "CHEBI"}, order="line").collect()
    assert (m.id, m.name, m.exact_mass, m.equivalent_ids) == ("RM:RM1", "new", 2.5, ["CHEBI:77", "RM:RM1"])


def test_scale_category_and_names(spark):
    rows = spark.createDataFrame([("Qn", "1"), ("Qn", "3"), ("Doc", "1"), (None, None)], "SCALE_TYP string, CLASSTYPE string")
    assert [r.c.split(":")[1] for r in rows.select(B.scale_category().alias("c")).collect()] == ["ClinicalMeasurement", "InformationContentEntity", "InformationContentEntity", "NamedThing"]
    schema = "d array<struct<designation:string,tags:array<string>>>"
    names = spark.createDataFrame([([("Etiology", []), ("Etiology liver abnormality", ["Question Text"])],), ([("Diagnosis", []), ("Dx", ["Question Text"])],), ([("q", ["Question Text"]), ("Full", ["Full Name"])],)], schema)
    got = [r.n for r in names.select(B.preferred_name("d", ["Full Name", "<untagged>", "Question Text"], ["etiology", "diagnosis"]).alias("n")).collect()]
    assert got == ["Etiology liver abnormality", "Diagnosis", "Full"]


def test_data_elements(spark):
    c = spark.createDataFrame([("NCI Thesaurus", "C1:C2"), ("other", "C3")], "o string, c string").select(B.code_curies(F.col("o"), F.col("c"), {"nci thesaurus": "ncit"}).alias("x")).collect()
    assert [r.x for r in c] == [["NCIT:C1", "NCIT:C2"], []]
    concepts = spark.createDataFrame([("e", "N:1", "related_to", 0), ("e", "N:1", "assesses", 5), ("e", "N:2", "related_to", 1), ("e", "N:9", "assesses", 2)], "element string, curie string, kind string, position int")
    e = B.data_element_edges(concepts, "infores:c", spark.createDataFrame([("N:9",)], "curie string"))
    assert {(r.object, r.predicate) for r in e.collect()} == {("N:1", "biolink:assesses"), ("N:2", "biolink:related_to")}


def test_scores_and_genes(spark):
    scores = spark.createDataFrame([("t", "p1", 1), ("t", "p2", 2), ("u", "p3", 3)], "trait string, score string, position int")
    samples = spark.createDataFrame([(s, i) for s, n in (("p1", 5), ("p2", 6), ("p3", 4)) for i in range(n)], "score string, sample_set int")
    assert [r.score for r in B.selected_scores(scores, samples).collect()] == ["p2"]
    v = spark.createDataFrame([("p", "1", 15, 2.0, 0.5), ("p", "1", 16, 1.0, None), ("p", "1", 99, 9.0, 0.5)], "score string, contig string, at long, weight double, frequency double")
    g = spark.createDataFrame([("1", 10, 20, "g")], "contig string, start long, end long, gene_id string")
    assert [tuple(r) for r in B.score_genes(v, g).collect()] == [("p", "g", 2, 2.5)]


def test_correlates(spark):
    rows = spark.createDataFrame([("A:1", "0.12345678", "0.01"), ("A:2", "-2", "0.01"), ("A:3", "1", "0.5"), ("bad", "1", "0.01"), ("A:4", "x", None)], "curie string, b string, p string")
    n, e = B.correlates(rows, "X:0", "infores:x", "curie", B.sign_predicate("b", "p"), {"b": F.bround(F.col("b").try_cast("double"), 6)}, ("PMID:1",))
    assert {(r.object, r.predicate.split("_")[0]) for r in e.collect()} == {("A:1", "biolink:positively"), ("A:2", "biolink:negatively")}
    assert {r.id for r in n.collect()} == {"X:0", "A:1", "A:2"}
    assert {r.attributes["infores:x"]["b"] for r in e.collect()} == {"0.123457", "-2.0"}


def test_actionability(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"docId":"D1","context":{"Adult":{"status":{"stg2":"Complete"},"genes":[{"gene":"G","geneOmim":"1","diseases":[{"label":"x","omim":"12"}]}]}}},{"docId":"D2","context":{"Adult":{"status":{"stg2":"Incomplete"},"genes":[{"gene":"H","geneOmim":"2","diseases":[{"label":"y","omim":"3"}]}]}}}]')
    got = B.actionable(spark.read.option("multiLine", True).json(str(tmp_path / "a.json"))).collect()
    assert [(r.doc, r.gene, r.disease.omim) for r in got] == [("D1", "G", "12")]
    pairs = spark.createDataFrame([("G", "12"), ("G", "1")], "gene string, disease_id string")
    a = spark.createDataFrame([("G", 1, "about OMIM:123"), ("G", 2, "about OMIM:12."), ("G", 3, "OMIM:12 too")], "gene string, position int, assertion string")
    assert {r.disease_id: r.assertion for r in B.assertion_of(pairs, a).collect()} == {"12": "about OMIM:12.", "1": None}


def test_lines_of_a_mixed_graph(spark):
    lines = ['{"type": "node", "id": "1", "labels": ["Complex"], "properties": {"identifier": "zz", "source": "Complex Portal", "complex_portal": "CPX-1", "name": "a &amp; b"}}', '{"type": "node", "id": 2, "labels": ["Organism"], "properties": {"identifier": 7, "source": "BV-BRC"}}']
    lines += ['{"type": "node", "id": "3", "labels": ["Odd"], "properties": {"identifier": "x", "source": "s"}}', '{"type": "node", "id": "4", "labels": [], "properties": {}}', '{"type": "relationship", "id": "9", "label": "PARTOF_CpO", "start": {"id": "1"}, "end": {"id": "2"}, "properties": {"source": "Reactome", "score": 0.5}}']
    g = MG.mixed_graph(MG.items_of(spark.createDataFrame([(x,) for x in lines], "value string")))
    assert {(r.id, r.name, tuple(r.categories)) for r in g.nodes.collect()} == {("COMPLEXPORTAL:CPX-1", "a & b", ("biolink:MacromolecularComplex",)), ("BVBRC:7", None, ("biolink:OrganismalEntity",))}
    (e,) = g.edges.collect()
    assert (e.subject, e.predicate, e.object, e.primary_knowledge_source) == ("BVBRC:7", "biolink:has_part", "COMPLEXPORTAL:CPX-1", "infores:reactome")
    assert e.attributes["infores:spoke"] == {"spoke_id": "9", "score": "0.5"}
    assert sorted(r.reason for r in g.rejects.collect()) == ["no_label", "unmapped_id"]


def test_levels_of_a_catalog_and_the_registry(spark, tmp_path):
    path = tmp_path / "c.json"
    path.write_text('{"information_resources": [{"id": "infores:a", "knowledge_level": "prediction"}, {"id": "infores:b", "agent_type": "manual_agent"}]}')
    got = {tuple(r) for r in MG.infores_levels(spark.read.option("multiLine", True).json(str(path))).collect()}
    assert got == {("infores:a", "prediction", "not_provided"), ("infores:b", "not_provided", "manual_agent")}
    assert set(registry.NAMES) == set(registry.SPECS) | set(registry.PLANS) and len(registry.NAMES) == 16


def test_repeated_data_items_of_a_molecule(spark):
    text = "x\n> <NAME>\na\n\n> <NAME>\nb\n\n> <MASS>\n1.5\n\n"
    (r,) = spark.createDataFrame([(text,)], "value string").select(readers.sdf_properties("value").alias("p")).collect()
    assert r.p == {"NAME": "a", "MASS": "1.5"}


def test_the_log_of_the_fold(spark):
    rows = [("A:1", ["A:1", "X:1"], 0, 0, "a"), ("A:2", ["A:2", "X:2"], 0, 0, "b"), ("B:1", ["B:1", "X:1", "X:2"], 1, 1, "a"), ("B:9", ["B:9"], 1, 1, "b"), ("C:9", ["C:9"], 0, 0, "c")]
    nodes = spark.createDataFrame([(i, [f"cat:{i}"], e, p, r, o) for i, e, p, r, o in rows], "id string, categories array<string>, equivalent_ids array<string>, phase int, source_rank int, ordinal string")
    log = {tuple(r) for r in resolve.resolved(nodes).log.collect()}
    assert log == {("one_to_many", "B:1", "A:1|A:2"), ("one_to_zero", "B:9", "")}
