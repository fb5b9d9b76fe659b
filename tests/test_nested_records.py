import json
import random

import pyarrow as pa
from walk_records import walk

from sampleloom.operators import nested_records as N
from sampleloom.operators.nested_records import flatten_records

D1 = {"attribute": "a", "xml_source": "attribute", "matches": [{"target": "x"}, {"target": "y"}], "events": {"kind": "k"}}
D2 = {"attribute": "b", "xmlSource": None, "matches": None, "trace": {"xml_source": "no", "matches": [{"target": "none"}]}}
S = {"accession": "S1", "decisions": [D1, json.dumps(D2)]}
P = {"accession": "P1", "samples": [S, json.dumps({"accession": None, "decisions": D1})], "sub_projects": {"accession": "P2", "samples": {"accession": "S2", "decisions": json.dumps([D2])}, "subProjects": [{"id": "1", "samples": [{"accession": "S3", "decisions": [D2]}]}]}}
XML = """<?xml version="1.0" encoding="UTF-8"?>
<Package><ArchiveID accession="P1" id="1"/><BioSample accession="S1"><Decisions><Decision xml_source="attribute"><Value>a &lt; b</Value><Matches><Match/><Match/></Matches><Events><Event/></Events></Decision>
<Decision><Trace xml_source="no"><Match/></Trace></Decision></Decisions></BioSample><SubProjects><Package><ArchiveID id="2"/><BioSample><Decisions><Decision xml_source="q"/></Decisions></BioSample></Package></SubProjects></Package>"""
BASE = [("P1", "S1", 0, "attribute", "match", 0), ("P1", "S1", 0, "attribute", "match", 1), ("P1", "S1", 0, "attribute", "event", 0), ("P1", "S1", 1, "", "none", -1)]


def test_shapes(spark):
    expected = {("", *x) for x in BASE} | {("", "P1", "", 0, "attribute", "match", 0), ("", "P1", "", 0, "attribute", "match", 1), ("", "P1", "", 0, "attribute", "event", 0), ("P1", "P2", "S2", 0, "", "none", -1), ("P2", "", "S3", 0, "", "none", -1)}
    rows = []
    for i, wrap in enumerate((P, [P], {"Package": P}, {"DocumentSummary": {"Project": P, "uid": "1"}})):
        rows += [(i, json.dumps(wrap)), (i, json.dumps(wrap))]
    rows += [(10, json.dumps(P)[:-5]), (11, ""), (12, None), (13, "null"), (14, "[]"), (15, "{}"), (16, "<Package>"), (17, "plain"), (18, '<!DOCTYPE x [<!ENTITY a "b">]><Package/>'), (19, '{"accession": "P", "samples": "{"}'), (None, XML), (20, XML)]
    df = spark.createDataFrame(rows, "record_id long, payload string")
    got = {}
    for r in flatten_records(df).collect():
        got.setdefault(r[0], []).append(tuple(r)[1:])
    for i in range(4):
        assert len(got[i]) == len(set(got[i])) and set(got[i]) == expected
    assert set(got) == {0, 1, 2, 3, 20, None}
    assert set(got[20]) == {("", *x) for x in BASE} | {("P1", "", "", 0, "q", "none", -1)}
    assert flatten_records(df.limit(0)).count() == 0


def test_deep_and_long(spark):
    deep = {"accession": "P0", "samples": [{"accession": "S", "decisions": [D2] * 5000}]}
    for i in range(1, 200):
        deep = {"accession": f"P{i}", "sub_projects": [deep]}
    got = flatten_records(spark.createDataFrame([(1, json.dumps(deep))], "record_id long, payload string")).collect()
    assert len(got) == 5000 and {r["parent_accession"] for r in got} == {"P1"} and sorted(r["decision_pos"] for r in got) == list(range(5000))


def _flat(payloads):
    got = [set() for _ in payloads]
    for b in N.flatten_batch(pa.record_batch([pa.array(range(len(payloads)), pa.int64()), pa.array(payloads, pa.string())], names=["record_id", "payload"])):
        for r in b.to_pylist():
            got[r["record_id"]].add(tuple(r.values())[1:])
    return got


def test_brute_force_of_damaged_payloads(monkeypatch):
    """Payloads with a character taken out, put in or replaced: the same rows, and none of the malformed ones."""
    monkeypatch.setattr(N, "SLICE_BYTES", 9_000)
    monkeypatch.setattr(N, "OUTPUT_ROWS", 7)
    pick = random.Random(5)
    odd = json.dumps(P).replace("P1", "P\\u00e9 \\\\").replace("S3", "\\ud83d\\ude00")
    whole = [json.dumps(P), json.dumps([{"Package": P}, json.dumps(P)]), json.dumps({"DocumentSummary": {"Project": [P]}}), odd, XML, XML.replace("<Value>", "<!-- <BioSample/> --><Value a='>' b=\"it's\">")]
    texts = list(whole)
    for _ in range(3000):
        p, c = pick.choice(whole), pick.choice("{}[],:\"\\ \n\t<>/='&;x0-!")
        k = pick.randrange(len(p))
        texts.append(pick.choice([p[:k] + p[k + 1 :], p[:k] + c + p[k:], p[:k] + c + p[k + 1 :]]))
    assert _flat(texts) == [walk(t) for t in texts]
