import gzip

import pytest
import yaml
from pyspark.sql import functions as F

from sampleloom.operators.curation import CurationRules
from sampleloom.plans import extraction as E
from sampleloom.plans import seeds
from sampleloom.plans.relational_queries import CURATION
from sampleloom.run.manifest import check_bundle
from sampleloom.sources import dimensions as D
from sampleloom.sources import xml


def _sample(acc, attrs, links=()):
    inner = "".join(f'<Attribute attribute="{a}">{v}</Attribute>' for a, v in attrs)
    return f'<BioSample accession="{acc}"><Attributes>{inner}</Attributes><Links>' + "".join(f'<Link target="bioproject">{x}</Link>' for x in links) + "</Links></BioSample>"


def _project(i, acc, title):
    return f'<Package><Project><Project><ProjectID><ArchiveID accession="{acc}" id="{i}"/></ProjectID><ProjectDescr><Title>{title}</Title></ProjectDescr></Project></Project></Package>'


SAMPLES = [
    _sample("S1", [("host", "Ursina fulva"), ("collection_date", "2019"), ("host", "n/a"), ("host colour", "grey")], ["12", "9", "12"]), _sample("S2", [("x", "y")], ["77"]), _sample("S3", [("x", "y")]), _sample("S4", [("host", "hare"), ("host colour", "red")], ["9"]),
    _sample("S5", [("host", "ox"), ("host colour", "red")], ["12"]),
]
PROJECTS = [_project(12, "PRJB", "b"), _project(9, "PRJA", "a &lt;i&gt;x&lt;/i&gt;"), _project(50, "PRJZ", "not linked")]


def _run(spark, tmp_path, samples=SAMPLES, projects=PROJECTS, names=()):
    (tmp_path / "s.xml.gz").write_bytes(gzip.compress(("<Set>" + "\n".join(samples) + "</Set>").encode()))
    (tmp_path / "p.xml").write_text("<Set>" + "\n".join(projects) + "</Set>")
    index = spark.createDataFrame([("S1", "q_lutea", 1), ("S1", "q_varensis", 2), ("S2", "q_lutea", 3), ("S3", "q_lutea", 4), ("S4", "b_oxalis", 5)], "accession string, pathogen_biosample string, seq long")
    return E.extract(xml.scan_samples(spark, str(tmp_path / "s.xml.gz")), xml.scan_projects(spark, str(tmp_path / "p.xml"), ("Package",)), index, CurationRules.of(CURATION), names)


def test_extract(spark, tmp_path):
    e = _run(spark, tmp_path)
    got = {r["accession"]: r for r in e.candidates.collect()}
    assert set(got) == {"S1", "S2", "S4"} and e.candidates.columns == list(E.COLUMNS)
    assert (got["S1"]["bioproject_id"], got["S1"]["bioproject_accession"], got["S1"]["pathogen"], got["S1"]["date_category"], got["S1"]["host_val_orig"]) == ("12||9", "PRJA||PRJB", "q_varensis", "s", "Ursina fulva")
    assert got["S2"]["bioproject_accession"] == "" and got["S2"]["host_val_orig"] == ""
    assert [tuple(r) for r in e.unresolved.collect()] == [("77", 1, "S2")]
    assert sorted((r["accession"], r["title"]) for r in e.catalog.collect()) == [("PRJA", "a x"), ("PRJB", "b")]
    assert e.unreviewed.first()["n"] == 3  # S5 is not in the index but is reviewed
    long = {(r["record"], r["target"]): (r["attribute"], r["value"], r["category"]) for r in E.long_candidates(e.candidates).collect()}
    assert long == {("S1", "host"): ("host", "Ursina fulva", ""), ("S1", "date"): ("collection_date", "2019", "s"), ("S4", "host"): ("host", "hare", "")}
    assert {r["accession"] for r in _run(spark, tmp_path, names=["b_oxalis"]).candidates.collect()} == {"S4"}


def test_order_does_not_matter(spark, tmp_path):
    a = sorted(map(tuple, _run(spark, tmp_path).candidates.collect()))
    assert a == sorted(map(tuple, _run(spark, tmp_path, SAMPLES[::-1], PROJECTS[::-1]).candidates.collect()))


def test_bad_inputs(spark, tmp_path):
    with pytest.raises(ValueError, match="accession PRJB"):
        _run(spark, tmp_path, projects=[*PROJECTS[:1], _project(9, "PRJB", "again")])
    with pytest.raises(Exception, match="not numeric"):
        _run(spark, tmp_path, samples=[_sample("S1", [("host", "ox")], ["P9"])]).candidates.collect()
    with pytest.raises(Exception, match="malformed host candidates of r"):
        E.long_candidates(spark.createDataFrame([("r", "", "", "a||b", "x")], "accession string, date_category string, loc_attr_orig string, host_attr_orig string, host_val_orig string").withColumns({c: F.lit("") for c in ("loc_val_orig", "date_attr_orig", "date_val_orig", "iso_attr_orig", "iso_val_orig")})).collect()


def test_bundle(spark, tmp_path):
    manifest = tmp_path / "m.yaml"
    manifest.write_text("x: 1")
    E.write_bundle(_run(spark, tmp_path), str(tmp_path / "out"), str(tmp_path / "stage"), {"samples": ("s", str(manifest))})
    doc = yaml.safe_load((tmp_path / "out/provenance.yaml").read_text())
    check_bundle(doc, tmp_path / "out", {"samples": manifest})
    assert (tmp_path / "out/unresolved_bioproject_links.tsv").exists()
    lines = next((tmp_path / "out/bioproject_context.jsonl").glob("part-*")).read_text().splitlines()
    assert lines[0] == '{"id":"9","accession":"PRJA","title":"a x","description":"","relevance":[]}'


def test_dimensions(spark, tmp_path):
    (tmp_path / "taxa.tsv").write_text("taxid\trank\tscientific_name\tsynonym\tgenbank_common_name\tcommon_name\tcomments\n9\tspecies\tB b\t\t\tx;y\t\n5\tspecies\tA a\t\t\t\t\n")
    assert [r["taxid"] for r in D.scan_taxa(spark, str(tmp_path / "taxa.tsv")).orderBy("table_priority").collect()] == [9, 5]
    (tmp_path / "onto.tsv").write_text("term\tdisplay_term\tontology_link\tcrosslink_term\tsynonyms\tcomment\nb\t\t\t\t\tn\na\tA\tO:1\t\t\t\n")
    assert [r["term"] for r in D.scan_ontology(spark, str(tmp_path / "onto.tsv")).orderBy("ordinal").collect()] == ["b", "a"]
    (tmp_path / "names.txt").write_text(" A \n\nB\n")
    assert {r["name"] for r in D.scan_names(spark, str(tmp_path / "names.txt")).collect()} == {"A", "B"}
    lists = tmp_path / "lists"
    lists.mkdir()
    (lists / "b.tsv").write_text("accession\ttaxid\torganism\nS1\t1\tx\nS2\t2\ty\n")
    (lists / "a.tsv").write_text("accession\ttaxid\torganism\nS1\t7\tz\n")
    (lists / "manifest.tsv").write_text("pathogen_key\n")
    (lists / "empty.tsv").write_text("accession\ttaxid\torganism\n")
    rows = D.scan_id_lists(spark, str(lists))
    assert rows.count() == 3 and {r["accession"]: r["pathogen"] for r in D.first_listed(rows).collect()} == {"S1": "a", "S2": "b"}
    m = {r["pathogen"]: (r["rows"], r["status"]) for r in D.list_manifest(rows.withColumn("pathogen", F.lit("q_lutea")), seeds.frame(spark, seeds.REGISTRY, seeds.REGISTRY_COLUMNS)).collect()}
    assert m["q_lutea"] == (3, "ok") and m["b_oxalis"] == (0, "empty")
    index = spark.createDataFrame([("B", *"x" * 6), ("A", *"y" * 6)], ", ".join(f"{c} string" for c in D.INDEX))
    D.write_index(index, str(tmp_path / "index.tsv"))
    D.write_index(index.limit(1), str(tmp_path / "index.tsv"))
    assert (tmp_path / "index_old.tsv").exists() and next((tmp_path / "index_old.tsv").glob("part-*")).read_text().splitlines()[1].startswith("A")
    (tmp_path / "c.yaml").write_text("- 1")
    with pytest.raises(ValueError):
        D.load_config(tmp_path / "c.yaml")
    D.write_id_lists(rows, str(tmp_path / "by_key"))
    assert (tmp_path / "by_key/pathogen=a").exists()
