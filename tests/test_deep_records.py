"""Payloads whose projects sit below several wrappers or very deep."""

from sampleloom.operators.nested_records import flatten_records

ONE = '<{0}><ArchiveID accession="{1}"/><BioSample accession="S"><Decisions><Decision xml_source="q"/></Decisions></BioSample></{0}>'


def _projects(spark, payload):
    got = flatten_records(spark.createDataFrame([(1, payload)], "record_id long, payload string")).collect()
    return sorted((r["parent_accession"], r["project_accession"]) for r in got)


def test_projects_below_wrappers(spark):
    a, b, c = ONE.format("Package", "P1"), ONE.format("Package", "P2"), ONE.format("Package", "P3")
    assert _projects(spark, f"<Set><Part><Row>{a}</Row><Row>{b}</Row></Part>{c}</Set>") == [("", "P1"), ("", "P2"), ("", "P3")]


def test_deep_json(spark):
    n = 20_000
    deep = '{"accession": "P", "sub_projects": [' * n + '{"accession": "Q", "samples": [{"accession": "S", "decisions": [{"attribute": "a"}]}]}' + "]}" * n
    assert _projects(spark, deep) == [("P", "Q")]
    assert _projects(spark, deep[:-1]) == []


def test_text_of_an_entity(spark):
    x = ONE.format("Package", "P1")
    assert _projects(spark, f"<Set><Note><![CDATA[<!ENTITY a]]></Note>{x}</Set>") == [("", "P1")]
    # a well-formed payload counts whether or not it declares an entity; one that it uses is resolved, an unknown one is malformed
    assert _projects(spark, f'<!DOCTYPE x [<!ENTITY a "b">]><Set>{x}</Set>') == [("", "P1")]
    assert _projects(spark, '<!DOCTYPE x [<!ENTITY a "b">]>' + ONE.format("Package", "P&a;")) == [("", "Pb")]
    assert _projects(spark, ONE.format("Package", "P&a;")) == []


def test_two_lists_of_one_kind(spark):
    payload = '{"accession": "P", "samples": [{"accession": "S", "decisions": [{"match": {"a": 1}, "matches": [{"a": 2}, {"a": 3}]}]}], "sample": {"accession": "T", "decisions": [{}]}}'
    got = flatten_records(spark.createDataFrame([(1, payload)], "record_id long, payload string")).collect()
    assert sorted((r["sample_accession"], r["child_kind"], r["child_pos"]) for r in got) == [("S", "match", 0), ("S", "match", 1), ("T", "none", -1)]
