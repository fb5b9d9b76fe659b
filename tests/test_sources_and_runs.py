import datetime as dt
import gzip
import json

import pytest
from pyspark.sql import functions as F

from sampleloom.plans.relational_queries import CURATION
from sampleloom.operators.curation import CurationRules
from sampleloom.run import cli, manifest, outputs
from sampleloom.run.registry import Registry
from sampleloom.sources import projects, tables, xml
from sampleloom.streaming import ingest

SAMPLES = """<BioSampleSet>
<BioSample accession="S1" submission_date="2020-01-02T03:04:05.000" access="public"><Attributes><Attribute attribute="host" harmonized_name="host_name"> Ox </Attribute><Attribute attribute="x">1 &lt; 2</Attribute><Attribute attribute="e"></Attribute></Attributes>
<Links><Link target="bioproject"> 12 </Link><Link target="bioproject">9</Link><Link target="bioproject">12</Link><Link target="other">7</Link></Links></BioSample>
<BioSample><Attributes/></BioSample></BioSampleSet>"""
PROJECTS = """<PackageSet><Package><Project><Project><ProjectID><ArchiveID accession="PRJ1" id="12"/></ProjectID><ProjectDescr><Title>A &lt;i&gt;b&lt;/i&gt;</Title><Description>x &lt;p&gt;y&lt;/p&gt;</Description><Relevance><Veterinary>Yes</Veterinary><Agricultural>no</Agricultural></Relevance></ProjectDescr></Project></Project></Package></PackageSet>"""


@pytest.mark.parametrize("packed", [False, True])
def test_xml_samples(spark, tmp_path, packed):
    path = tmp_path / ("s.xml.gz" if packed else "s.xml")
    path.write_bytes(gzip.compress(SAMPLES.encode()) if packed else SAMPLES.encode())
    got = {r["accession"]: r for r in xml.scan_samples(spark, str(path)).collect()}
    assert set(got) == {"S1", "unknown"} and got["S1"]["project_ids"] == ["12", "9"]
    assert [tuple(c) for c in got["S1"]["candidates"]] == [("submission_date", "2020-01-02T03:04:05.000", "biosample_root"), ("host_name", " Ox ", "attribute"), ("x", "1 < 2", "attribute")]
    assert got["unknown"]["candidates"] == [] and got["unknown"]["project_ids"] == []


def test_xml_projects(spark, tmp_path):
    (tmp_path / "p.xml").write_text(PROJECTS)
    got = projects.resolve_contexts(xml.scan_projects(spark, str(tmp_path / "p.xml"), ("Package",)), spark.createDataFrame([("12",)], "id string")).first()
    assert (got["id"], got["accession"], got["title"], got["description"], got["relevance"]) == ("12", "PRJ1", "A b", "x y", ["Veterinary"])
    with pytest.raises(Exception, match="not numeric"):
        spark.range(1).select(xml.require_numeric(F.array(F.lit("1"), F.lit("x")))).collect()


GOOD = {"id": "1", "accession": "A1", "title": "t", "description": "", "relevance": ["Veterinary"]}
BAD = [({**GOOD, "id": 1}, "id"), ({**GOOD, "id": "١"}, "id"), ({**GOOD, "accession": " "}, "accession"), ({**GOOD, "title": None}, "title"), ({**GOOD, "description": None}, "description"), ({**GOOD, "relevance": ["x"]}, "relevance"), ({**GOOD, "relevance": None}, "relevance"), ({"id": "1"}, "fields"), ({**GOOD, "more": 1}, "fields"), ([], "fields")]


def test_catalog(spark):
    lines = [(0, json.dumps(GOOD))] + [(i, json.dumps(b)) for i, (b, _) in enumerate(BAD, 1)] + [(50, "no json"), (51, json.dumps({**GOOD, "accession": "A2"})), (52, json.dumps({**GOOD, "id": "2"}))]
    got = {r["line_no"]: r["problem"] for r in projects.validate_catalog(spark.createDataFrame(lines, "line_no long, line string")).collect()}
    assert got == {i: p for i, (_, p) in enumerate(BAD, 1)} | {50: "fields", 51: "duplicate id", 52: "duplicate accession"}


def test_tables(spark, tmp_path):
    df = spark.createDataFrame([("a", 'q"x', True), ("b", "", None), ("c", "two\twords", False)], "k string, v string, f boolean")
    tables.write_tsv(df, str(tmp_path / "t"), ["k"])
    text = next((tmp_path / "t").glob("part-*")).read_text()
    assert text.split("\n")[0] == "k\tv\tf" and text.split("\n")[1].endswith("True")
    got = tables.scan_tsv(spark, str(tmp_path / "t"), "k string, v string, f string").orderBy("k").collect()
    assert [r["v"] for r in got] == ['q"x', "", "two\twords"]
    with pytest.raises(ValueError, match="missing columns: z"):
        tables.require_columns(df, ["k", "z"])


def test_taxonomy(spark, tmp_path):
    (tmp_path / "nodes.dmp").write_text("1\t|\t1\t|\tno rank\t|\n5\t|\t1\t|\tgenus\t|\nx\t|\t1\t|\ty\t|\nshort\n")
    (tmp_path / "names.dmp").write_text("5\t|\tAlpha\t|\t\t|\tscientific name\t|\n5\t|\tBeta\t|\t\t|\tscientific name\t|\n5\t|\tb\t|\t\t|\tcommon name\t|\n5\t|\ta\t|\t\t|\tgenbank common name\t|\n")
    nodes, names = tables.scan_taxonomy(spark, str(tmp_path / "nodes.dmp"), str(tmp_path / "names.dmp"))
    assert sorted(map(tuple, nodes.collect())) == [(1, 1, "no rank"), (5, 1, "genus")]
    assert [tuple(r) for r in names.collect()] == [(5, "Alpha", ["b", "a"])]


def test_registry(spark):
    r = Registry({"a": {"scientific_name": "A b", "ncbi_taxid": 5, "rank": "species", "also_taxids": [7]}, "g": {"x": {"scientific_name": "X", "ncbi_taxid": 8, "rank": "genus"}, "y": {"scientific_name": "Y", "ncbi_taxid": 9, "rank": "genus"}}})
    assert r.expand(["g", "a", "x"]) == ["x", "y", "a"] and r.scientific_name("zz") == "" and r.leaves["a"].taxids == (5, 7)
    assert [row["key"] for row in r.frame(spark).orderBy("ordinal").collect()] == ["a", "x", "y"] and r.seeds(spark).count() == 4
    with pytest.raises(ValueError):
        r.expand(["nope"])


def test_manifests(tmp_path):
    data = tmp_path / "in.xml"
    data.write_text("x")
    doc = {"manifest_version": 1, "snapshot_id": "s", "provider": "p", "retrieved_on": "2026-07-09", "metadata_reference_date": "2026-07-09", "files": [{"name": "in.xml", "sha256": manifest.sha256_of(data)}]}
    manifest.Snapshot.of(doc).check_inputs([data])
    for change in ({"extra": 1}, {"metadata_reference_date": "2026-07-08"}, {"files": []}, {"files": doc["files"] * 2}):
        with pytest.raises(ValueError):
            manifest.Snapshot.of(doc | change)
    snapshot = manifest.Snapshot.of(doc)
    data.write_text("y")
    with pytest.raises(ValueError, match="another hash"):
        snapshot.check_inputs([data])
    with pytest.raises(ValueError, match="missing"):
        snapshot.check_inputs([])
    staged = {}
    for n in ("data.tsv", "catalog.jsonl", "provenance.yaml"):
        (tmp_path / f"{n}.new").write_text(n)
        staged[n] = tmp_path / f"{n}.new"
    bundle = manifest.provenance({"m": ("s", data)}, {"data": staged["data.tsv"]})
    manifest.publish(staged, tmp_path / "out", "provenance.yaml")
    bundle["artifacts"]["data"]["path"] = "data.tsv"
    manifest.check_bundle(bundle, tmp_path / "out", {"m": data})
    (tmp_path / "out/data.tsv").write_text("changed")
    with pytest.raises(ValueError, match="changed"):
        manifest.check_bundle(bundle, tmp_path / "out", {"m": data})
    with pytest.raises(FileNotFoundError):
        manifest.publish({"a": tmp_path / "none", "provenance.yaml": tmp_path / "none"}, tmp_path / "out", "provenance.yaml")
    assert not (tmp_path / "out/provenance.yaml").exists()


def test_outputs(tmp_path):
    o = outputs.Outputs.plan(tmp_path, "r", ("date", "iso"), True)
    assert [p.name for p in o.paths()] == ["r.tsv", "r_reasoning.jsonl", "r_prompts.txt", "r.log", "r_diagnostics.json"]
    o.check()
    o.log.write_text("")
    with pytest.raises(FileExistsError):
        o.check()
    with pytest.raises(ValueError):
        o.check([o.log], force=True)
    d = outputs.Diagnostics(o.diagnostics, b=1, a=dt.date(2020, 1, 1))
    d.phase("x")
    d.finish("failed", ValueError("api_key=abc at https://u:p@h/"))
    doc = json.loads(o.diagnostics.read_text())
    assert doc["status"] == "failed" and doc["a"] == "2020-01-01" and "abc" not in doc["error"]["message"] and "u:p" not in doc["error"]["message"]
    assert "(3 characters)" in outputs.prompt_snapshot([("loc", "m", None, {"system": "abc"})])


def test_cli(spark, tmp_path):
    from sampleloom.plans import pipeline_queries as Q

    d = "/root/testdata/sf0.001"
    dims = Q.dimensions(spark, d)
    for n in cli.TABLES:
        getattr(dims, n).write.parquet(str(tmp_path / "dims" / n))
    Q.records(spark, d).write.parquet(str(tmp_path / "records"))
    Q.candidates(spark, d).write.parquet(str(tmp_path / "cands"))
    args = ["q_lutea", "--output-dir", str(tmp_path / "out"), "--records", str(tmp_path / "records"), "--candidates", str(tmp_path / "cands"), "--dimensions", str(tmp_path / "dims"), "--attribute", "date", "--attribute", "loc", "--reference-date", "2025-06-30"]
    assert cli.main(args) == 0
    doc = json.loads((tmp_path / "out/run_diagnostics.json").read_text())
    assert doc["status"] == "succeeded" and doc["rows"] > 0
    header = next((tmp_path / "out/run.tsv").glob("part-*")).read_text().split("\n")[0].split("\t")
    assert header[:5] == ["accession", "pathogen", "in_ATB", "bioproject", "date_attr_orig"] and "host_taxid" not in header
    assert cli.main([*args[1:], "--force", "nope"]) == 1


def test_stream(spark, tmp_path):
    d = "/root/testdata/sf0.001/curation_decisions.parquet"
    batch = spark.read.parquet(d).select("decision_id", "accession", F.col("attr_name").alias("attribute"), F.col("attr_value").alias("value"), F.col("loaded_at").cast("timestamp").alias("loaded_at"))
    batch.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = ingest.write_batches(ingest.curate_stream(stream, CurationRules.of(CURATION), late="3650 days"), str(tmp_path / "out"), str(tmp_path / "ckpt"))
    q.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == batch.select("decision_id").distinct().count()
    counts = ingest.event_counts(got.withColumn("loaded_at", F.col("loaded_at")))
    assert counts.agg(F.sum("n")).first()[0] == got.select(F.sum(F.size("events"))).first()[0]
