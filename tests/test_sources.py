import gzip
import json
from pathlib import Path

import pytest

from weftline.sources import readers, sinks, spec


def write(path, text):
    if str(path).endswith(".gz"):
        with gzip.open(path, "wt") as f:
            f.write(text)
    else:
        Path(path).write_text(text)
    return str(path)


def test_jsonl_and_suffix(spark, tmp_path):
    p = write(tmp_path / "n.jsonl", '{"id":"a","biolink:category":["X"]}\n{"id":"b"}\n')
    df = readers.by_suffix(spark, p)
    assert df.columns == ["category", "id"] and df.count() == 2
    with pytest.raises(ValueError):
        readers.by_suffix(spark, "x.doc")


def test_tsv_lists_and_blank_rows(spark, tmp_path):
    p = write(tmp_path / "n.tsv", "id\tname\txref\na\tA|B\tx|y\n\t\t\nb\tC\t\n")
    rows = readers.tsv(spark, p, "|", ("id", "name")).orderBy("id").collect()
    assert [(r.id, r.name, r.xref) for r in rows] == [("a", "A|B", ["x", "y"]), ("b", "C", None)]


def test_mixed_positional_and_nested(spark, tmp_path):
    p = write(tmp_path / "m.jsonl", '{"type":"relationship","id":"r"}\n{"type":"node","id":"n"}\n')
    n, r = readers.mixed_jsonl(spark, p)
    assert [x.id for x in n.collect()] == ["n"] and [x.id for x in r.collect()] == ["r"]
    p = write(tmp_path / "p.tsv", "h1\th2\n1\t2\n")
    assert [tuple(x) for x in readers.positional_tsv(spark, p, ["a", "b"]).collect()] == [("1", "2")]
    with pytest.raises(ValueError):
        readers.positional_tsv(spark, p, ["a"])
    p = write(tmp_path / "x.json", '[{"a": {"b": [1]}},\n {"a": null}]')
    assert readers.nested_json(spark, p).count() == 2


def test_genes_scores_and_molecules(spark, tmp_path):
    gtf = '#!c\n1\te\tgene\t10\t20\t.\t+\t.\tgene_id "G1"; gene_name "N"; gene_biotype "protein_coding";\n1\te\tgene\t1\t2\t.\t+\t.\tgene_id "G2"; gene_biotype "lncRNA";\n1\te\texon\t1\t2\t.\t+\t.\tgene_id "G3"; gene_biotype "protein_coding";\n'
    assert [tuple(r) for r in readers.gene_table(spark, write(tmp_path / "g.gtf", gtf)).collect()] == [("1", 10, 20, "G1", "N")]
    score = "#comment\n#more\nrsID\teffect_weight\nrs1\t0.5\n"
    assert [tuple(r) for r in readers.scoring_file(spark, write(tmp_path / "s.txt.gz", score)).collect()] == [("rs1", "0.5")]
    sdf = "mol\n  x\nM  END\n> <LM_ID>\nL1\n\n> <SYNONYMS>\na; b\nc\n\n$$$$\nmol2\n> <LM_ID>\nL2\n\n$$$$\n"
    got = sorted((r.properties["LM_ID"], r.properties.get("SYNONYMS")) for r in readers.sdf_molecules(spark, write(tmp_path / "m.sdf", sdf)).collect())
    assert got == [("L1", "a; b\nc"), ("L2", None)]


def test_ingest_and_html(spark, tmp_path):
    a, b = write(tmp_path / "a.csv", 'id,n,s\n1,"x,y",z\n'), write(tmp_path / "b.csv", "k,m\n2,q\n")
    got = readers.ingest(spark, [{"path": a, "id": "id", "name": "n", "synonyms": ["s"], "category": "C"}, {"path": b, "id": "k", "name": "m", "category": "D"}])
    assert sorted((r.id, r.name, r.synonyms, r.category) for r in got.collect()) == [("1", "x,y", ["z"], "C"), ("2", "q", [], "D")]
    df = spark.createDataFrame([("<title>T</title><h2>One</h2><p>a <b>b</b></p><h2 id=x>Two</h2>c<script>no</script>",)], "h string")
    assert [tuple(s) for s in df.select(readers.html_sections("h").alias("s")).first().s] == [("One", "a b"), ("Two", "c")]


def test_jsonl_sink_leaves_out_nulls(spark, tmp_path):
    sinks.jsonl(spark.createDataFrame([("a", None)], "id string, name string").coalesce(1), str(tmp_path / "out"))
    (part,) = (tmp_path / "out").glob("part-*.json")
    assert json.loads(part.read_text()) == {"id": "a"}


def test_nested_counts_put_larger_subtrees_first(spark):
    df = spark.createDataFrame([("a", "p", 1), ("b", "p", 5), ("b", "q", 9)], "s string, p string, n long")
    got = sinks.nested_counts(df, ["s", "p"], "n")
    assert list(got) == ["b", "a"] and list(got["b"]) == ["q", "p"]


BUILD = {"kg_version": "1", "package_version": "0", "biolink_version": "4", "git_commit": "abc", "sources": {"b", "a"}, "steps_run": {"harmonize": True}, "build_duration_minutes": 42.0}


def test_build_record(tmp_path):
    path = tmp_path / "build_info.json"
    sinks.build_record(str(path), **BUILD)
    assert json.loads(path.read_text())["sources"] == ["a", "b"]
    with pytest.raises(ValueError, match="missing: kg_version"):
        sinks.build_record(str(path), **{k: v for k, v in BUILD.items() if k != "kg_version"})
    with pytest.raises(ValueError, match="unknown"):
        sinks.build_record(str(path), **BUILD, other=1)


def test_build_schema_has_not_drifted():
    committed = json.loads((Path(__file__).parent.parent / "build_record.schema.json").read_text())
    assert committed == sinks.build_schema()


def test_file_helpers(tmp_path):
    a, b = write(tmp_path / "kg_nodes.jsonl", "x"), write(tmp_path / "kg_edges.jsonl", "y")
    assert sinks.tarball([a, b], str(tmp_path)).endswith("kg.tar.gz")
    path = str(tmp_path / "v.json")
    assert sinks.load_or_fetch(path, lambda: [1]) == [1] and sinks.load_or_fetch(path, lambda: [2]) == [1]


def test_select_sources():
    known = ["a", "b", "c"]
    assert spec.select_sources(known, "b") == ["b", "a", "c"]
    assert spec.select_sources(known, "b", exclude={"c"}) == ["b", "a"]
    with pytest.raises(ValueError):
        spec.select_sources(known, "a", {"a"}, {"b"})
    with pytest.raises(ValueError):
        spec.select_sources(known, "z")
