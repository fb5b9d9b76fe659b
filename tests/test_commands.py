"""The command lines from XML dumps to the standardised table, and what they write beside it."""

import datetime as dt
import json
import logging

import pytest
import yaml
from pyspark.sql import functions as F

from sampleloom.operators import model_requests as M
from sampleloom.operators.host_policy import HostPolicy
from sampleloom.plans import entity_queries as E
from sampleloom.plans.model_stage import Model, Prompts, filled
from sampleloom.plans.pipeline import Request
from sampleloom.run import cli, extract_cli, files, logs, outputs, runtime

SAMPLES = """<?xml version="1.0"?>
<BioSampleSet>
<BioSample accession="S1" submission_date="2020-01-02T00:00:00"><Description><Organism taxonomy_id="12" taxonomy_name="Quorella &amp; co"/></Description><Attributes><Attribute attribute_name="collection date" harmonized_name="collection_date">2019-05</Attribute><Attribute attribute_name="host" harmonized_name="host">brindle ox</Attribute></Attributes><Links><Link target="bioproject">77</Link></Links></BioSample>
<BioSample accession="S2"><Description><Organism taxonomy_id="99" taxonomy_name="Other"/></Description><Attributes><Attribute attribute="geo_loc_name">Norvelia: Dahl</Attribute></Attributes></BioSample>
<BioSample accession="S3"><Description><Organism taxonomy_id="50" taxonomy_name="Old"/></Description><Attributes><Attribute attribute="isolation_source">unheard of</Attribute></Attributes></BioSample>
<BioSample><Description><Organism taxonomy_id="12"/></Description></BioSample>
<BioSample accession="S4"><Description><Organism taxonomy_id="7" taxonomy_name="Far"/></Description></BioSample>
</BioSampleSet>
"""
PROJECTS = '<Set><Package><Project><Project><ProjectID><ArchiveID accession="PR77" id="77"/></ProjectID><ProjectDescr><Title>A &lt;b&gt;title&lt;/b&gt;</Title><Description>text</Description><Relevance><Veterinary>yes</Veterinary></Relevance></ProjectDescr></Project></Project></Package></Set>'
REGISTRY = {"q_varensis": {"scientific_name": "Quorella varensis", "ncbi_taxid": 10, "rank": "species"}, "q_lutea": {"scientific_name": "Quorella lutea", "ncbi_taxid": 20, "rank": "species"}}
RULES = {"universal_missing": {"exact": ["na"]}, "targets": {"date": {"accepted": {"collection_date": "s"}}, "host": {"accepted": {"host": ""}}, "loc": {"accepted": {"geo_loc_name": ""}}, "iso": {"accepted": {"isolation_source": ""}}}}


@pytest.fixture(scope="module")
def place(tmp_path_factory):
    d = tmp_path_factory.mktemp("commands")
    (d / "samples.xml").write_text(SAMPLES)
    (d / "projects.xml").write_text(PROJECTS)
    (d / "nodes.dmp").write_text("1\t|\t1\t|\tno rank\t|\n10\t|\t1\t|\tspecies\t|\n12\t|\t10\t|\tstrain\t|\n20\t|\t1\t|\tspecies\t|\n99\t|\t1\t|\tspecies\t|\n")
    (d / "merged.dmp").write_text("50\t|\t12\t|\n")
    (d / "catalog.tsv").write_text("accession\tosf_tarball_filename\tsylph_species\nS2\tt2\tQuorella lutea\nS4\tt4\tFar away\n")
    (d / "registry.yaml").write_text(yaml.safe_dump(REGISTRY, sort_keys=False))
    (d / "rules.yaml").write_text(yaml.safe_dump(RULES))
    return d


def test_lists_index_and_extraction(spark, place):
    lists, subset = place / "lists", place / "subset"
    assert extract_cli.main(["id-lists", f"{place}/samples.xml", "--registry", f"{place}/registry.yaml", "--catalog", f"{place}/catalog.tsv", "--nodes-dmp", f"{place}/nodes.dmp", "--merged-dmp", f"{place}/merged.dmp", "--id-lists-dir", str(lists), "--subset", str(subset), "--quiet"]) == 0
    manifest = [r.split("\t") for r in (lists / "manifest.tsv").read_text().splitlines()]
    assert manifest[0][0] == "pathogen" and {r[0]: (r[4], r[5], len(r[6])) for r in manifest[1:]} == {"q_varensis": ("2", "ok", 64), "q_lutea": ("0", "empty", 0)}
    from sampleloom.sources.xml import scan_samples

    assert {r["accession"] for r in scan_samples(spark, str(subset)).collect()} == {"S1", "S2", "S3"}
    index = str(place / "index.tsv")
    for _ in range(2):  # the second run keeps the first as the old one
        assert extract_cli.main(["index", f"{place}/catalog.tsv", "--registry", f"{place}/registry.yaml", "--id-lists-dir", str(lists), "--output", index, "--quiet"]) == 0
    assert files.Store(spark).exists(str(place / "index_old.tsv"))
    from sampleloom.sources.tables import scan_tsv

    rows = {r["accession"]: (r["pathogen_biosample"], r["pathogen_atb"], r["in_atb"]) for r in scan_tsv(spark, index, "accession string, in_atb string, pathogen_biosample string, pathogen_atb string, taxid string, organism_value string, osf_tarball_filename string").collect()}
    assert rows == {"S1": ("q_varensis", "NA", "False"), "S2": ("NA", "q_lutea", "True"), "S3": ("q_varensis", "NA", "False")}
    (place / "keys.tsv").write_text("accession\tpathogen_biosample\nS1\tq_varensis\nS2\tq_lutea\nS3\tq_varensis\n")
    manifest = {"manifest_version": 1, "snapshot_id": "s", "provider": "p", "retrieved_on": "2026-07-09", "metadata_reference_date": "2026-07-09", "files": [{"name": n, "sha256": cli.sha256_of(place / n)} for n in ("samples.xml", "projects.xml")]}
    (place / "snapshot.yaml").write_text(yaml.safe_dump(manifest))
    bundle = place / "bundle"
    args = ["extract", "--output", str(bundle), "--samples", f"{place}/samples.xml", "--projects", f"{place}/projects.xml", "--index", f"{place}/keys.tsv", "--rules", f"{place}/rules.yaml", "--manifest", f"{place}/snapshot.yaml", "--quiet"]
    assert extract_cli.main(args) == 0
    assert extract_cli.main([*args[:4], f"{place}/projects.xml", *args[5:]]) == 1
    doc = yaml.safe_load((bundle / "provenance.yaml").read_text())
    assert doc["artifacts"].keys() == {"extracted_metadata.tsv", "bioproject_context.jsonl"} and doc["source_manifests"]["source"]["snapshot_id"] == "s"
    cli.check_bundle(doc, bundle, {"source": place / "snapshot.yaml"}, files.Store(spark).sha256)


def reply(request):
    if '"response_schema_id":"location' in request:
        return '{"country": "Norvelia"}', {"input_tokens": 3}
    return json.dumps({"terms": [], "reasoning": "nothing fits", "evidence_level": "none"}), {"output_tokens": 2}


def test_whole_run(spark, place):
    from sampleloom.plans import pipeline_queries as Q

    dims = Q.dimensions(spark, "/root/testdata/sf0.001")
    for n in cli.TABLES:
        getattr(dims, n).write.mode("overwrite").parquet(str(place / "dims" / n))
    config = place / "config"
    config.mkdir()
    (config / "pathogens.yaml").write_text(yaml.safe_dump(REGISTRY, sort_keys=False))
    (config / "host.yaml").write_text(yaml.safe_dump({"schema_version": 2, "normalization": {"ignored_substrings": []}, "routing": {"isolation_source_keywords": ["meat"]}, "value_rejections": {"exact": ["none"]}, "curated_taxa": {"91001": {"scientific_name": "Ursina fulva", "match_terms": {"exact": ["hill ox"]}}}}))
    (config / "isolation.yaml").write_text(yaml.safe_dump({"system_prompt": "Tree:\n{ontology_tree}", "user_prompt": "{metadata}"}))
    args = ["--output-dir", str(place / "out"), "--extracted-metadata", str(place / "bundle/extracted_metadata.tsv"), "--dimensions", str(place / "dims"), "--config-dir", str(config), "--snapshot", str(place / "snapshot.yaml"), "--model", "m-1", "--model-client", "test_commands:reply", "--single-file", "--quiet"]
    assert cli.main(args) == 0
    doc = json.loads((place / "out/run_diagnostics.json").read_text())
    assert (doc["status"], doc["rows"], doc["processed_rows"]) == ("succeeded", 3, 3) and doc["counters"]["date"]["all"]["standardized"] == 1
    assert doc["runtime"]["pyspark"] and len(doc["runtime"]["configuration"]) == 3 and doc["cache_hits"] == {"loc": 0, "iso": 0}
    assert {(c["target"], c["attempts"]) for c in doc["model_calls"] if c["target"]} == {("isolation", 1)}
    part = next((place / "out/run.tsv").glob("part-*")).read_text().splitlines()
    head = part[0].split("\t")
    rows = {r.split("\t")[0]: dict(zip(head, r.split("\t"))) for r in part[1:]}
    assert "source_position" not in head and (rows["S1"]["host_taxid"], rows["S1"]["date_start"], rows["S2"]["loc_country"], rows["S1"]["bioproject"]) == ("91001", "2019-05-01", "Norvelia", "PR77")
    lines = [json.loads(x) for p in (place / "out/run_reasoning.jsonl").glob("part-*") for x in p.read_text().splitlines()]
    assert {x["accession"]: (x["diagnostics"], x["reasoning"]) for x in lines}["S3"] == (["llm_call", "unspecified"], ["nothing fits"])
    assert "## Tree" in (place / "out/run_prompts.txt").read_text() and "3 rows" in (place / "out/run.log").read_text()
    assert cli.main([*args[:2], "--run-name", "again", *args[2:-6], "--skip-llm", "--quiet"]) == 0
    assert not (place / "out/again_prompts.txt").exists()
    (place / "samples.xml").write_text("changed")
    assert cli.main([*args, "--force", "nobody"]) == 1 and json.loads((place / "out/run_diagnostics.json").read_text())["status"] == "failed"


def test_policy(spark):
    assert [tuple(r) for r in HostPolicy.of(E.POLICY).problems(spark, E.taxa(spark)).orderBy("taxid", "problem").collect()] == [(91003, "name", "Velumia agrestis"), (91003, "term", "ovis dentata"), (99999, "absent", ""), (99999, "term", "pelagoma vasta")]
    good = HostPolicy.of(E.POLICY)
    assert {tuple(r) for r in good.preempt(spark).collect()} == {("grey hen", 91001), ("not a host", None)}
    with pytest.raises(ValueError, match="91003"):
        good.require(spark, E.taxa(spark))
    term = lambda **m: {"scientific_name": "x", "match_terms": m}
    for change in ({"schema_version": 1}, {"more": 1}, {"normalization": {}}, {"routing": {"isolation_source_keywords": [" "]}}, {"curated_taxa": {"07": term()}}, {"curated_taxa": {5: term()}}, {"curated_taxa": {"5": term(exact=["a"], force=["A"])}}, {"curated_taxa": {"5": term(exact=["a"]), "6": term(subset=["a"])}}, {"curated_taxa": {"5": term(exact=["Not-a host"])}}, {"curated_taxa": {"5": {"scientific_name": " ", "match_terms": {}}}}):
        with pytest.raises(ValueError):
            HostPolicy.of(E.POLICY | change)


def test_stages(spark):
    with pytest.raises(ValueError, match="unknown stages"):
        Request(["a"], stages={"locations": print})
    from sampleloom.plans import pipeline as PL
    from sampleloom.plans import pipeline_queries as Q

    d = "/root/testdata/sf0.001"
    date = lambda c, day: c.select("record").distinct().withColumns({"date_attr_orig": F.lit("a"), "date_val_orig": F.lit("v"), "date_start": F.lit("1900-01-01"), "date_end": F.lit("1900-01-01"), "date_score": F.lit(1.0), "diagnostics": F.array(F.lit("made"))})
    host = lambda c, dims, kw: c.select("record").distinct().withColumns({"host_attr_orig": F.lit("h"), "host_val_orig": F.lit("v"), "host_taxid": F.lit(5).cast("long"), "host_scientific_name": F.lit("n"), "host_score": F.lit(1.0), "host_low_conf": F.lit(False), "overflow": F.lit(False), "diagnostics": F.array(F.lit("made"))})
    line = lambda found, dims: found.withColumns({"host_common_names": F.lit("c"), "host_lineage_names": F.lit("l"), "host_lineage_taxids": F.lit("t")})
    rows = PL.harmonize(Q.records(spark, d), Q.candidates(spark, d), Q.dimensions(spark, d), PL.Request(["q_lutea"], ("date", "host"), dt.date(2026, 1, 1), {"date": date, "host": host, "lineage": line})).collect()
    assert {r["date_start"] for r in rows} <= {None, "1900-01-01"} and {r["host_lineage_names"] for r in rows} <= {None, "l"} and rows


def test_observed_client(spark):
    seen = []

    def send(method, url, headers, body):
        seen.append(url)
        return (200 if "ok" in body else 504), {"Set-Cookie": "s", "X": "1"}, {"text": "r", "n": 4}

    client = M.Observed(send, lambda r: ("POST", "https://u:p@h/x?api_key=k&a=1", {"Authorization": "Bearer t", "A": "b"}, r), lambda a: (a["text"], {"input_tokens": a["n"]}))
    text, used = client("ok")
    trace = json.loads(used["trace"])[0]
    assert text == "r" and used["input_tokens"] == 4 and trace["url"] == "https://h/x?api_key=[removed]&a=1"
    assert trace["request_headers"] == {"a": "b", "authorization": "[removed]"} and trace["response_headers"]["set-cookie"] == "[removed]"
    with pytest.raises(TimeoutError):
        client("bad")
    df = spark.createDataFrame([("f1", "ok"), ("f1", "ok"), ("f2", "no")], "fingerprint string, request string")
    calls = {r["fingerprint"]: r for r in M.call_model(df, lambda r: ("x", {"trace": "[]"}) if r == "ok" else 1 / 0).collect()}
    assert calls["f1"]["trace"] == "[]" and calls["f2"]["status"] == "failed" and "ZeroDivisionError" in calls["f2"]["error"]


def test_prompts_logs_and_runtime(spark, tmp_path):
    p = Prompts.of({"llm_system_prompt": "s"}, {"system_prompt": "a {ontology_tree} b"}, "TREE")
    assert p.isolation_system == "a TREE b" and p.location_user == "" and p.sections("m")[0][0] == "location"
    got = spark.range(1).select(filled("x {metadata} y", "{metadata}", F.lit("1")).alias("a"), filled("x", "{metadata}", F.lit("1")).alias("b"), filled("", "{metadata}", F.lit("1")).alias("c")).first()
    assert tuple(got) == ("x 1 y", "x\n1", "1")
    log = logs.setup(tmp_path / "l.log", "INFO", True)
    log.info("token=%s at https://u:p@h/", "abc")
    logging.shutdown([__import__("weakref").ref(h) for h in log.handlers])
    text = (tmp_path / "l.log").read_text()
    assert "abc" not in text and "u:p" not in text and "[removed]" in text
    about = runtime.describe([tmp_path / "none.yaml", tmp_path / "l.log"])
    assert about["configuration"][str(tmp_path / "none.yaml")] is None and len(about["configuration"][str(tmp_path / "l.log")]) == 64
    assert outputs.sanitize_url("https://h/?q=1&token=zz") == "https://h/?q=1&token=[removed]" and runtime.Places().index.name == "index.tsv"


def test_model_without_client(spark):
    """Without a client earlier answers count and the rest is disabled."""
    from sampleloom.plans.model_stage import location_answers
    from sampleloom.plans import seeds

    f = lambda rows, cols: seeds.frame(spark, rows, cols)
    cols = "record string, country string, un_region string, sublocation string, diagnostic string, request string"
    outcomes = spark.createDataFrame([("a", None, None, None, "model_request", "g=here"), ("b", None, None, None, "model_request", "g=there"), ("c", "Peskar", "Boreas", None, "direct_resolution", None)], cols)
    key = spark.range(1).select(M.fingerprint(M.request_json("m", Model("m").parameters, "location_country:1", None, F.lit("g=here"))).alias("f")).first()[0]
    model = Model("m", cache=spark.createDataFrame([(key, '{"country": "Ilvan Republic"}')], "fingerprint string, reply string"))
    got = location_answers(outcomes, model, f(seeds.COUNTRIES, seeds.COUNTRY_COLUMNS), f(seeds.REMAP, seeds.REMAP_COLUMNS), f(seeds.OFFICIAL_NAMES, "name string"))
    rows = {r["record"]: (r["country"], r["un_region"], r["diagnostic"]) for r in got.outcomes.collect()}
    assert rows == {"a": ("Ilvania", "Inner Oceana", "cache_resolution"), "b": (None, None, "llm_disabled"), "c": ("Peskar", "Boreas", "direct_resolution")} and got.calls is None
