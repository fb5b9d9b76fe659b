import math
import random

import pytest
from pyspark.sql import functions as F

from sampleloom.operators import hosts as H
from sampleloom.operators import index as X
from sampleloom.operators import isolation as I
from sampleloom.operators import lineage as L
from sampleloom.operators import model_requests as M
from sampleloom.operators import places as G
from sampleloom.plans import seeds

HOSTS = [  # attribute, value, taxid, score, low confidence
    ("host_taxid", "91001", 91001, 1.0, False), ("host", "91001", None, None, False), ("host", "Ursina fulva", 91001, 1.0, False), ("host", "ursa_fulva", 91001, 1.0, False), ("host", "Brindle  Ox", 91001, 0.9, False), ("host", "hare", 91007, 0.7, False),
    ("host", "wild Ovilla dentata herd", 91002, 0.7, True), ("host", "two ducks and a duck1", 91004, 0.5, True), ("host", "healthy marsh goat, adult", 91003, 0.9, False), ("host", "reed duck meat", None, None, False), ("host", "Grey hen", 91004, 1.0, False),
    ("host", "n/a", None, None, False), ("host", "Tarsula minor minor", 91008, 1.0, False), ("host", "Tarsula minor", 91007, 1.0, False), ("host", "goat and carp", 91003, 0.5, True), ("host", "", None, None, False), ("host", None, None, None, False), ("host", "zebra", None, None, False),
]


def _hosts(spark, rows, keywords=seeds.ISOLATION_KEYWORDS):
    df = spark.createDataFrame(rows, "record string, pos long, attribute string, value string")
    return {r["record"]: r for r in H.standardize_hosts(df, seeds.frame(spark, seeds.TAXA, seeds.TAXA_COLUMNS), seeds.frame(spark, seeds.PREEMPT, seeds.PREEMPT_COLUMNS), seeds.IGNORED_SUBSTRINGS, keywords).collect()}


def test_hosts(spark):
    got = _hosts(spark, [(str(i), 0, a, v) for i, (a, v, *_) in enumerate(HOSTS)])
    for i, (_, v, taxid, score, low) in enumerate(HOSTS):
        r = got[str(i)]
        assert (r["taxid"], r["score"], r["low_confidence"]) == (taxid, score, low), (v, r)
        assert r["overflow"] == (taxid is None and bool((v or "").strip()))


def test_host_records(spark):
    rows = [("a", 0, "host", "Pelagoma vasta"), ("a", 1, "host_taxid", "91001"), ("b", 0, "x", "hare"), ("b", 1, "host", "hare"), ("c", 0, "host", "grey hen"), ("c", 1, "host", "not applicable"), ("d", 0, "food_source", "marsh goat meat")]
    got = _hosts(spark, rows)
    assert (got["a"]["taxid"], got["a"]["low_confidence"], got["a"]["attribute"]) == (91001, True, "host_taxid") and "attribute_disagreement" in got["a"]["diagnostics"]
    assert got["b"]["attribute"] == "host" and got["c"]["diagnostics"] == ["override_rejection"] and got["d"]["diagnostics"] == ["iso_keyword_preemption"]
    assert _hosts(spark, rows, [])["d"]["taxid"] == 91003


COORDS = [("51.9194 N 19.1451 E", 51.9194, 19.1451, True), ("34.6 s, 58.3 w", -34.6, -58.3, True), ("-34.6037, -58.3816", -34.6037, -58.3816, True), ("43.51/16.44", 43.51, 16.44, True), ("999, 999", 999.0, 999.0, False), ("lot 3/4", 3.0, 4.0, True), ("Norvelia", None, None, False), (None, None, None, False)]


def test_coordinates(spark):
    df = spark.createDataFrame(list(enumerate(c[0] for c in COORDS)), "i int, v string")
    for r in G.with_coordinates(df, "v").collect():
        _, lat, lon, ok = COORDS[r["i"]]
        assert (r["lat"], r["lon"], r["valid"]) == (lat, lon, ok)


def _arc(a, b, c, d):
    h = math.sin(math.radians(c - a) / 2) ** 2 + math.cos(math.radians(a)) * math.cos(math.radians(c)) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * math.degrees(math.asin(min(1, math.sqrt(h))))


@pytest.mark.parametrize("n_places", [0, 3, 600])
def test_nearest_place(spark, n_places):
    r = random.Random(n_places)
    places = [(f"p{i}", "c", r.uniform(-60, 75), r.uniform(-180, 180)) for i in range(n_places)]
    points = [(r.uniform(-90, 90), r.uniform(-180, 180)) for _ in range(80)] + [(89.9, 0.0), (0.0, 180.0), (0.0, -180.0), (-90.0, 10.0)] + [(p[2], p[3]) for p in places[:20]]
    got = G.nearest_place(spark.createDataFrame(points + points[:5], "lat double, lon double"), spark.createDataFrame(places, "place string, country string, lat double, lon double")).collect()
    assert len(got) == (len(set(points)) if n_places else 0)
    for x in got:
        assert x["degrees"] == pytest.approx(min(_arc(x["lat"], x["lon"], p[2], p[3]) for p in places), abs=1e-6)


def test_places(spark):
    rows = [("a", 0, "g", "Norvelia"), ("a", 1, "g", "Ostrany: Lake Veth"), ("b", 0, "g", "Ilvan Republic: Corr"), ("c", 0, "g", "Zuberland"), ("d", 0, "g", "near the pond"), ("d", 1, "h", "by the barn"), ("e", 0, "g", "999, 999"), ("f", 0, "g", "  "), ("g", 0, "ll", "61.0 N 7.4 E"), ("h", 0, "lat", "north")]
    df = spark.createDataFrame(rows, "record string, pos long, attribute string, value string")
    f = lambda x, c: seeds.frame(spark, x, c)
    got = {r["record"]: r for r in G.standardize_places(df, f(seeds.COUNTRIES, seeds.COUNTRY_COLUMNS), f(seeds.GAZETTEER, seeds.GAZETTEER_COLUMNS), f(seeds.REMAP, seeds.REMAP_COLUMNS), f(seeds.OFFICIAL_NAMES, "name string"), ["lat"]).collect()}
    assert (got["a"]["country"], got["a"]["sublocation"], got["a"]["un_region"]) == ("Ostrany", "Lake Veth", "Eastern Aldera")
    assert got["b"]["country"] == "Ilvania" and got["c"]["diagnostic"] == "unmappable_result" and got["d"]["request"] == "g=near the pond h=by the barn"
    assert [got[k]["diagnostic"] for k in "efgh"] == ["unresolved_place", "unresolved_place", "coordinate_resolution", "unresolved_place"] and got["g"]["sublocation"] == "Port Astrin"


ONTOLOGY = [("env", "env", None, None, None, "level"), ("env:soil", "soil", "O:1;O:2", None, "dirt;earth", None), ("env:root zone", None, "O:3", "soil; O:9", "rhizosphere", "near roots."), ("food", "food", None, None, None, None), ("food:soil", "soil", "O:9", None, None, None)]


def test_isolation(spark):
    nodes_df = spark.createDataFrame(ONTOLOGY, "term string, display_term string, ontology_link string, crosslink_term string, synonyms string, term_comment string")
    rows = [("a", 0, "x", "Rhizosphere"), ("b", 0, "x", "from o:2 and O:9"), ("c", 0, "x", "soil"), ("c", 1, "x", "unknown thing"), ("d", 0, "x", " "), ("e", 0, "x", None)]
    got = {r["record"]: r for r in I.standardize_isolation(spark.createDataFrame(rows, "record string, pos long, attribute string, value string"), nodes_df).collect()}
    assert got["a"]["term_paths"] == "env:root zone||env:soil||food:soil" and got["a"]["ontology_links"] == "O:3||O:1;O:2||O:9" and got["a"]["categories"] == "env||food"
    assert got["b"]["term_paths"] == "env:soil" and got["c"]["term_paths"] == "env:soil" and not got["c"]["covered"] and got["c"]["request_mode"] == "sample_only"
    assert [got[k]["display_terms"] for k in "de"] == ["unspecified"] * 2 and got["d"]["evidence_level"] == "none"
    text, paths = I.render_tree([(r[0], r[1], r[5]) for r in ONTOLOGY], ("food",))
    assert paths == ["food", "food:soil", "env", "env:soil", "env:root zone"] and text.startswith("## Tree\n- food\n  - soil\n- env") and '- "root zone": near roots.' in text


def test_evidence_claims(spark):
    df = spark.createDataFrame([(True, True, "sample"), (True, True, "project"), (False, True, "project"), (False, False, "project"), (True, False, "none")], "d boolean, m boolean, c string")
    assert [r[0] for r in df.select(I.evidence_level(F.col("d"), F.col("m"), F.col("c"))).collect()] == ["sample", "sample_and_project", "project", "none", "sample"]
    with pytest.raises(Exception, match="evidence"):
        df.limit(1).select(I.evidence_level(F.lit(False), F.lit(True), F.lit("none"))).collect()


def test_lineage_loops_and_depth(spark):
    chain = [(i, i - 1, "genus") for i in range(2, 300)] + [(1, 1, "no rank"), (900, 901, "x"), (901, 900, "x"), (950, 949, "species"), (None, 1, "x")]
    nodes = spark.createDataFrame(chain + chain[:2], "taxid long, parent long, rank string")
    paths = {r["taxid"]: r["path"] for r in L.ancestor_paths(nodes, 10).collect()}
    assert paths[299] == list(range(299, 1, -1)) and paths[950] == [950] and sorted(paths[900]) == [900, 901] and 1 not in paths
    closed = L.closure(nodes, spark.createDataFrame([(290, "deep", 1), (280, "high", 0)], "taxid long, key string, ordinal int"))
    assert {r["taxid"]: r["key"] for r in closed.collect()} == {i: "high" for i in range(280, 300)}


def test_labels(spark):
    labels = spark.createDataFrame([("Quorella_A lutea_BC",), ("Pelagoma xyz",), ("Quorella",), ("",), (None,)], "label string")
    got = {r["label"]: r["key"] for r in X.map_labels(labels, seeds.frame(spark, seeds.REGISTRY, seeds.REGISTRY_COLUMNS)).collect()}
    assert got == {"Quorella_A lutea_BC": "q_lutea", "Pelagoma xyz": "p_fulva", "Quorella": "NA", "": "NA", None: "NA"}


def test_requests(spark):
    text = M.request_json("m", {"b": 1, "a": 0.5}, "s:1", "sys", F.col("u"))
    df = spark.createDataFrame([('say "é"\n',), ("x",), ("x",)], "u string").select("u", text.alias("request")).withColumn("fingerprint", M.fingerprint(F.col("request")))
    want = M.canonical_json({"model": "m", "parameters": {"a": 0.5, "b": 1}, "response_schema_id": "s:1", "messages": [{"role": "system", "content": "sys"}, {"role": "user", "content": 'say "é"\n'}]})
    assert df.first()["request"] == want
    calls = M.call_model(df, lambda r: "ok")
    assert calls.count() == 2
    cache = M.remember(spark.createDataFrame([("f", "old")], "fingerprint string, reply string"), calls)
    assert cache.count() == 3
    hit, miss = M.lookup(df, calls)
    assert (hit.count(), miss.count()) == (3, 0)
    with pytest.raises(ValueError):
        M.canonical_json(float("nan"))


@pytest.mark.parametrize("reply,ok", [('{"country": " X "}', "X"), ('{"country": ""}', None), ('{"country": 7}', None), ('{"country": null}', None), ("[]", None), ("x", None), ("", None), (None, None), ('{"country": "X", "a": 1}', None), ('{"Country": "X"}', None)])
def test_replies(spark, reply, ok):
    assert spark.createDataFrame([(reply,)], "r string").select(M.valid_country(F.col("r"))).first()[0] == ok


def test_model_fallback_of_places(spark):
    asked = [("a", "pond"), ("b", "pond"), ("c", "barn"), ("d", "lake"), ("e", "bad"), ("f", "down")]
    text = M.request_json("m", {}, "s", None, F.col("u"))
    requests = spark.createDataFrame(asked, "record string, u string").select("record", text.alias("request")).withColumn("fingerprint", M.fingerprint(F.col("request")))
    old = requests.filter("record = 'd'").select("fingerprint", F.lit('{"country": "Norvelia"}').alias("reply"))

    def client(request):
        if "down" in request:
            raise TimeoutError
        return '{"country": "NA"}' if "barn" in request else "nothing" if "bad" in request else '{"country": "ilvan republic"}'

    f = lambda x, c: seeds.frame(spark, x, c)
    place = lambda answers: {r["record"]: (r["country"], r["diagnostic"]) for r in G.place_replies(answers, f(seeds.COUNTRIES, seeds.COUNTRY_COLUMNS), f(seeds.REMAP, seeds.REMAP_COLUMNS), f(seeds.OFFICIAL_NAMES, "name string")).collect()}
    answers, cache = M.ask(requests, old, client)
    assert place(answers) == {
        "a": ("Ilvania", "llm_resolution"), "b": ("Ilvania", "cache_resolution"), "c": (None, "unmappable_result"), "d": ("Norvelia", "cache_resolution"),
        "e": (None, "invalid_llm_response"), "f": (None, "recoverable_llm_failure"),
    }
    assert cache.count() == 4
    answers, same = M.ask(requests, old, None)
    assert place(answers)["d"] == ("Norvelia", "cache_resolution") and place(answers)["a"] == (None, "llm_disabled") and same.count() == 1


def test_model_fallback_of_isolation(spark):
    nodes = I.nodes_of(spark.createDataFrame(ONTOLOGY, "term string, display_term string, ontology_link string, crosslink_term string, synonyms string, term_comment string"))
    reply = lambda terms, level: '{"terms": [' + ", ".join(f'"{t}"' for t in terms) + f'], "reasoning": "r", "evidence_level": "{level}"}}'
    rows = [("a", "combined", reply(["Root Zone"], "project")), ("b", "sample_only", reply([], "none")), ("c", "sample_only", reply(["food"], "project")), ("d", "combined", reply(["moon"], "sample")), ("e", "combined", "no json"), ("f", "project_only", reply(["food"], "project"))]
    read = I.read_replies(spark.createDataFrame(rows, "record string, request_mode string, reply string"), nodes)
    assert {r["record"]: r["problem"] for r in read.collect()} == {"a": None, "b": None, "c": "evidence", "d": "terms", "e": "reply", "f": None}
    direct = spark.createDataFrame([("a", "env:soil"), ("c", "food")], "record string, term string")
    got = {r["record"]: r for r in I.with_replies(direct, read, nodes, strict=False).collect()}
    assert got["a"]["term_paths"] == "env:root zone||env:soil||food:soil" and got["a"]["evidence_level"] == "sample_and_project"
    assert (got["b"]["display_terms"], got["b"]["evidence_level"]) == ("unspecified", "none") and (got["c"]["term_paths"], got["c"]["evidence_level"]) == ("food", "sample")
    assert got["f"]["evidence_level"] == "project" and got["d"]["term_paths"] == ""
    with pytest.raises(Exception, match="bad isolation reply"):
        I.with_replies(direct, read, nodes).collect()
