"""Queries of host, location, isolation and model-request operators, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from sampleloom.functions import strings as S
from sampleloom.functions.text import full, full_col
from sampleloom.operators import curation as C
from sampleloom.operators import hosts as H
from sampleloom.operators import isolation as I
from sampleloom.operators import model_requests as M
from sampleloom.operators import places as G
from sampleloom.plans import seeds
from sampleloom.plans.folding import NAME_FORMS, SPACE, simple_form, strip
from sampleloom.plans.relational_queries import CURATION
from sampleloom.session import spread, table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


# ---- hosts -----------------------------------------------------------------------------------------------------------

TAXA = seeds.values(seeds.TAXA, seeds.TAXA_COLUMNS, "taxa")
PREEMPT = seeds.values(seeds.PREEMPT, seeds.PREEMPT_COLUMNS, "preempt")


def taxa(spark):
    return seeds.frame(spark, seeds.TAXA, seeds.TAXA_COLUMNS)


def preempt_table(spark):
    return seeds.frame(spark, seeds.PREEMPT, seeds.PREEMPT_COLUMNS)


def _norm(c: str) -> str:
    return f"trim(regexp_replace(regexp_replace(replace(replace(lower({c}), '_', ' '), '-', ' '), '[[:punct:]]', '', 'g'), '{SPACE}+', ' ', 'g'))"


def _stripped(c: str) -> str:
    for s in seeds.IGNORED_SUBSTRINGS:
        esc = "".join("\\" + ch if not (ch.isalnum() or ch.isspace()) else ch for ch in s)
        c = f"regexp_replace({c}, '(?i){esc}', '', 'g')"
    return c


HOST = ("host", "host_common_name", "host_taxid", "host organism", "common name of host", "host common name")
PLACE = ("geo_loc_name", "geographic location", "place name", "latitude_only")
ISO = ("isolation_source", "env_medium", "env_local_scale", "food_source", "source_type")
_LISTED = {"host": HOST, "loc": PLACE, "iso": ISO}
#: Full forms of names that the operators know, given as these.
_KNOWN = ("host", "host taxid", "latitude only")


def _candidates_sql(target: str, name: str, value: str = "attr_value") -> str:
    """CTEs up to ``name (record, pos, attribute, value)``: the rows of a target's attributes, in any spelling."""
    listed = ", ".join(f"'{full(n)}'" for n in _LISTED[target])
    wanted = f"SELECT unnest([{listed}]) AS form UNION SELECT {simple_form('x')} FROM (SELECT attr_name AS x FROM attribute_types WHERE match_target = '{target}' UNION SELECT unnest(string_split(aliases, ';')) FROM attribute_types WHERE match_target = '{target}')"
    known = ", ".join(f"'{n}'" for n in _KNOWN)
    return f"{NAME_FORMS}, {name} AS (SELECT DISTINCT accession AS record, decision_id AS pos, CASE WHEN form IN ({known}) THEN replace(form, ' ', '_') ELSE lower({strip('attr_name')}) END AS attribute, {value} AS value FROM curation_decisions JOIN nf ON v = attr_name WHERE accession IS NOT NULL AND form IN ({wanted}))"


_HOSTS = _candidates_sql("host", "hosts", "coalesce(attr_value, '')")
_TERMS = (
    "raw AS (SELECT scientific_name AS term, 1 AS tier, 1.0 AS score, 0 AS p, * FROM taxa UNION ALL SELECT trim(x), 2, 1.0, i, * EXCLUDE (x, i) FROM (SELECT *, unnest(string_split(synonym, ';')) AS x, generate_subscripts(string_split(synonym, ';'), 1) AS i FROM taxa) "
    "UNION ALL SELECT trim(x), 4, 0.9, i, * EXCLUDE (x, i) FROM (SELECT *, unnest(string_split(genbank_common_name, ';')) AS x, generate_subscripts(string_split(genbank_common_name, ';'), 1) AS i FROM taxa) "
    "UNION ALL SELECT trim(x), 5, 0.7, i, * EXCLUDE (x, i) FROM (SELECT *, unnest(string_split(common_name, ';')) AS x, generate_subscripts(string_split(common_name, ';'), 1) AS i FROM taxa)), "
    "terms AS (SELECT lower(term) AS norm_term, tier, CAST(score AS DOUBLE) AS score, taxid, scientific_name, table_priority, p, lower(rank) <> 'subspecies' AS sub FROM raw), "
    "best AS (SELECT DISTINCT ON (norm_term) * FROM terms ORDER BY norm_term, tier, table_priority, p), inside AS (SELECT DISTINCT ON (norm_term) *, len(list_distinct(string_split(norm_term, ' '))) AS nw, len(string_split(norm_term, ' ')) AS nr FROM terms WHERE sub ORDER BY norm_term, tier, table_priority, p)"
)
_VALS = f"vals AS (SELECT pos, record, attribute, value, attribute = 'host_taxid' AS by_taxid, {_norm(_stripped(strip('value')))} AS norm FROM hosts)"
_SUBSET = (
    "keys AS (SELECT DISTINCT norm, by_taxid FROM vals WHERE norm <> ''), w AS (SELECT DISTINCT norm, len(string_split(norm, ' ')) AS nv, unnest(list_distinct(list_concat(string_split(norm, ' '), list_filter(list_transform(string_split(norm, ' '), lambda x: regexp_replace(x, '^[0-9]+|[0-9]+$', '', 'g')), lambda x: x <> '')))) AS word "
    "FROM keys WHERE NOT regexp_full_match(norm, '[0-9]+') AND norm NOT IN (SELECT norm_term FROM best)), hit AS (SELECT w.norm, i.norm_term, i.nr, i.taxid, i.scientific_name, i.table_priority FROM w JOIN inside i ON list_contains(string_split(i.norm_term, ' '), w.word) WHERE i.nr = 1 OR i.nr <= w.nv "
    "GROUP BY ALL HAVING count(DISTINCT w.word) = any_value(i.nw)), lev AS (SELECT norm, max(CAST(nr > 1 AS INTEGER)) AS multi FROM hit GROUP BY norm), "
    "sub AS (SELECT h.norm, any_value(CASE WHEN multi = 1 THEN 0.7 ELSE 0.5 END) AS score, any_value(CASE WHEN multi = 1 THEN 'multi-word' ELSE 'single-word' END) AS match_tier, arg_min(taxid, table_priority) AS taxid, arg_min(scientific_name, table_priority) AS scientific_name, min(table_priority) AS table_priority, "
    "CASE WHEN count(DISTINCT taxid) > 1 THEN array_to_string(list_sort(list(DISTINCT scientific_name)), '|') ELSE '' END AS names FROM hit h JOIN lev USING (norm) WHERE (nr > 1) = (multi = 1) GROUP BY h.norm), "
    "matched AS (SELECT k.norm, k.by_taxid, t.taxid, t.scientific_name, t.table_priority, CAST(1.0 AS DOUBLE) AS score, '' AS match_tier, '' AS names FROM keys k JOIN taxa t ON k.by_taxid AND CAST(t.taxid AS VARCHAR) = k.norm "
    "UNION ALL SELECT k.norm, k.by_taxid, b.taxid, b.scientific_name, b.table_priority, b.score, '', '' FROM keys k JOIN best b ON b.norm_term = k.norm WHERE NOT regexp_full_match(k.norm, '[0-9]+') UNION ALL SELECT k.norm, k.by_taxid, s.taxid, s.scientific_name, s.table_priority, CAST(s.score AS DOUBLE), s.match_tier, s.names FROM keys k JOIN sub s ON s.norm = k.norm)"
)
_HOST_SQL = f"WITH {TAXA}, {PREEMPT}, {_TERMS}, {_HOSTS}, {_VALS}, {_SUBSET}"


def target_names(spark, d, target):
    """Full forms of the names of a target: those listed here and those of the table of attributes, aliases included."""
    found = {full(n) for n in _LISTED[target]}
    for r in table(spark, d, "attribute_types").filter(F.col("match_target") == target).collect():
        found |= {full(n) for n in [r["attr_name"] or "", *(r["aliases"] or "").split(";")] if n.strip()}
    return sorted(found)


def listed(spark, d, target):
    """``(record, pos, attribute, value)`` of the rows of a target's attributes in any spelling, values as they stand, copies once."""
    t = table(spark, d, "curation_decisions").filter("accession is not null and attr_name is not null").select(F.col("accession").alias("record"), F.col("decision_id").alias("pos"), "attr_name", F.col("attr_value").alias("value"), full_col(F.col("attr_name")).alias("full"))
    attribute = F.when(F.col("full").isin(*_KNOWN), F.translate("full", " ", "_")).otherwise(F.lower(S.strip(F.col("attr_name"))))
    return spread(t.filter(F.col("full").isin(target_names(spark, d, target))).select("record", "pos", attribute.alias("attribute"), "value"), "record", "pos").distinct()


def curation_rules(spark, d):
    """The rule set of ``curate`` with the names and aliases of the table of attributes and the names listed here."""
    accepted = {t: dict(x.get("accepted", {})) for t, x in CURATION["targets"].items()}
    for t, names in (("host", HOST), ("loc", PLACE), ("iso", ISO)):
        accepted[t] |= dict.fromkeys(names, "")
    for r in table(spark, d, "attribute_types").filter("match_target in ('host', 'loc', 'iso')").collect():
        accepted[r["match_target"]] |= dict.fromkeys([r["attr_name"], *[a for a in (r["aliases"] or "").split(";") if a.strip()]], "")
    return C.CurationRules.of(CURATION | {"targets": {t: x | {"accepted": accepted[t]} for t, x in CURATION["targets"].items()}})


def curated(spark, d):
    """``(record, pos, target, attribute, value, full)`` of the rows that curation gives to the host, place and isolation targets, copies once.

    Names that the operators know are given as these; the others stay as written, in lower case.
    """
    t = table(spark, d, "curation_decisions").filter("accession is not null").select(F.col("accession").alias("record"), F.col("decision_id").alias("pos"), F.col("attr_name").alias("attribute"), F.col("attr_value").alias("value"))
    t = spread(t, "record", "pos").distinct()
    got = C.curate(t, curation_rules(spark, d)).select("record", "pos", F.explode("matches.target").alias("target"), "attribute", "value", F.col("normalized_attribute").alias("full")).filter("target <> 'date'")
    known = F.col("full").isin(*_KNOWN)
    return got.withColumn("attribute", F.when(known, F.translate("full", " ", "_")).otherwise(F.lower(S.strip(F.coalesce("attribute", F.lit(""))))))


def host_candidates(spark, d):
    return listed(spark, d, "host")


def _keys(spark, d):
    c = host_candidates(spark, d)
    return c.withColumn("norm", H.normal_value(F.col("value"), seeds.IGNORED_SUBSTRINGS)).withColumn("by_taxid", F.col("attribute") == "host_taxid")


@query(f"WITH {TAXA}, {_TERMS} SELECT norm_term, CAST(tier AS INTEGER) AS tier, score, taxid, scientific_name FROM best")
def term_precedence(spark, d):
    return H.exact_terms(H.term_table(taxa(spark))).select("norm_term", "tier", "score", "taxid", "scientific_name")


@query(_HOST_SQL + " SELECT norm, taxid, score FROM matched WHERE match_tier = '' AND NOT regexp_full_match(norm, '[0-9]+') GROUP BY ALL")
def host_exact(spark, d):
    m = H.match_values(_keys(spark, d).select("norm", "by_taxid"), taxa(spark), H.term_table(taxa(spark)))
    return m.filter("match_tier = '' and not norm rlike '^[0-9]+$'").select("norm", "taxid", "score").distinct()


_AROUND = _HOST_SQL.replace(_stripped(strip("value")), _stripped(strip("'young ' || value || ' herd1'")))


@query(_AROUND + " SELECT norm, score, match_tier, taxid, scientific_name, names FROM matched WHERE match_tier <> '' GROUP BY ALL")
def host_subset(spark, d):
    """Terms inside longer values: the host values with words around them."""
    c = host_candidates(spark, d).withColumn("value", F.concat(F.lit("young "), F.coalesce("value", F.lit("")), F.lit(" herd1")))
    keys = c.select(H.normal_value(F.col("value"), seeds.IGNORED_SUBSTRINGS).alias("norm"), (F.col("attribute") == "host_taxid").alias("by_taxid"))
    m = H.match_values(keys, taxa(spark), H.term_table(taxa(spark)))
    return m.filter("match_tier <> ''").select("norm", "score", "match_tier", "taxid", "scientific_name", F.array_join("names", "|").alias("names")).distinct()


@query(f"WITH {TAXA} SELECT o_orderkey, taxid, scientific_name FROM orders JOIN taxa ON taxid = 90990 + o_orderkey % 25 WHERE o_orderkey % 2 = 0")
def host_taxid(spark, d):
    """Numbers are taxids only under the attribute that says so: here for even order keys."""
    v = table(spark, d, "orders").select("o_orderkey", (90990 + F.col("o_orderkey") % 25).cast("string").alias("norm"), (F.col("o_orderkey") % 2 == 0).alias("by_taxid"))
    m = H.match_values(v.select("norm", "by_taxid"), taxa(spark), H.term_table(taxa(spark)))
    return v.join(m, ["norm", "by_taxid"]).select("o_orderkey", "taxid", "scientific_name")


@query(f"SELECT DISTINCT value, kw FROM (SELECT attr_value AS value, CASE {' '.join('WHEN list_has_all(string_split(' + _norm('attr_value') + ', chr(32)), [' + ', '.join(repr(w) for w in k.split()) + ']) THEN ' + repr(k) for k in seeds.ISOLATION_KEYWORDS)} END AS kw FROM curation_decisions WHERE attr_value IS NOT NULL) WHERE kw IS NOT NULL")
def keyword_preempt(spark, d):
    return _values(spark, d).withColumn("kw", H.keyword_hit(F.array("value"), seeds.ISOLATION_KEYWORDS)).filter("kw is not null")


_DECIDED = f"hits AS (SELECT record, pos, taxid FROM (SELECT record, pos, {_norm('value')} AS norm_value FROM hosts) h JOIN preempt USING (norm_value)), decided AS (SELECT record, bool_or(taxid IS NULL) AS rejected, arg_min(taxid, pos) FILTER (WHERE taxid IS NOT NULL) AS forced, min(pos) FILTER (WHERE taxid IS NOT NULL) AS forced_pos FROM hits GROUP BY record)"


@query(f"WITH {PREEMPT}, {_HOSTS}, {_DECIDED} SELECT record, CASE WHEN rejected THEN 'reject' ELSE 'force' END AS decision, CASE WHEN NOT rejected THEN forced END AS taxid FROM decided")
def preempt(spark, d):
    got = H.decisions(host_candidates(spark, d), preempt_table(spark))
    return got.select("record", F.when(F.col("rejected"), "reject").otherwise("force").alias("decision"), F.when(~F.col("rejected"), F.col("forced")).alias("taxid"))


_RANKED = "cand AS (SELECT v.*, m.* EXCLUDE (norm, by_taxid) FROM vals v JOIN matched m ON m.norm = v.norm AND m.by_taxid = v.by_taxid), ranked AS (SELECT *, row_number() OVER (PARTITION BY record ORDER BY score DESC, table_priority, CASE attribute WHEN 'host_taxid' THEN 1 WHEN 'host' THEN 2 ELSE 3 END, pos) AS r FROM cand), several AS (SELECT record, count(DISTINCT taxid) > 1 AS several FROM cand GROUP BY record)"


def _best(spark, d):
    k = _keys(spark, d)
    m = H.match_values(k.select("norm", "by_taxid"), taxa(spark), H.term_table(taxa(spark)))
    return H.best_candidate(k.join(m, ["norm", "by_taxid"]))


@query(f"{_HOST_SQL}, {_RANKED} SELECT record, taxid, score, pos, attribute FROM ranked WHERE r = 1")
def host_rank(spark, d):
    return _best(spark, d).select("record", "taxid", "score", "pos", "attribute")


@query(f"{_HOST_SQL}, {_RANKED} SELECT record, match_tier <> '' AS subset_match, names <> '' AS ambiguous_subset, several AS attribute_disagreement, match_tier <> '' OR names <> '' OR several AS low_confidence FROM ranked JOIN several USING (record) WHERE r = 1")
def host_flags(spark, d):
    has = lambda f: F.array_contains("flags", f).alias(f)
    return _best(spark, d).select("record", has("subset_match"), has("ambiguous_subset"), has("attribute_disagreement"), "low_confidence")


_KW_EXISTS = " OR ".join(f"list_has_all(string_split({_norm('value')}, chr(32)), [{', '.join(repr(w) for w in k.split())}])" for k in seeds.ISOLATION_KEYWORDS)
_STD_HOST = (
    f"{_HOST_SQL}, {_RANKED}, {_DECIDED}, kw AS (SELECT DISTINCT record FROM hosts WHERE {_KW_EXISTS}), ids AS (SELECT record, bool_or({strip('value')} <> '') AS has_value FROM hosts GROUP BY record), "
    "pick AS (SELECT i.record, i.has_value, k.record IS NOT NULL AS kw, coalesce(d.rejected, false) AS rejected, d.forced, d.forced_pos, r.taxid, r.scientific_name, r.score FROM ids i LEFT JOIN kw k USING (record) LEFT JOIN decided d USING (record) LEFT JOIN (SELECT * FROM ranked WHERE r = 1) r USING (record)), "
    "std AS (SELECT record, has_value, CASE WHEN kw THEN 'iso_keyword_preemption' WHEN rejected THEN 'override_rejection' WHEN forced IS NOT NULL THEN 'forced_override' WHEN taxid IS NOT NULL THEN 'matched' ELSE 'unmatched' END AS how, forced, taxid, score FROM pick)"
)


def hosts_of(spark, d, keywords=None, cands=None):
    return H.standardize_hosts(host_candidates(spark, d) if cands is None else cands, taxa(spark), preempt_table(spark), seeds.IGNORED_SUBSTRINGS, seeds.ISOLATION_KEYWORDS if keywords is None else keywords)


@query(_STD_HOST + " SELECT record, how, CASE how WHEN 'forced_override' THEN forced WHEN 'matched' THEN taxid END AS taxid, CASE how WHEN 'forced_override' THEN CAST(1.0 AS DOUBLE) WHEN 'matched' THEN score END AS score, has_value AND how NOT IN ('forced_override', 'matched') AS overflow FROM std")
def std_host(spark, d):
    """Standardised host of every record."""
    return hosts_of(spark, d).select("record", F.col("diagnostics")[0].alias("how"), "taxid", "score", "overflow")


@query(_STD_HOST.replace(f"WHERE {_KW_EXISTS})", "WHERE false)") + " SELECT record, how, CASE how WHEN 'forced_override' THEN forced WHEN 'matched' THEN taxid END AS taxid FROM std")
def host_retry(spark, d):
    """The retry reads the values again without keyword preemption."""
    return hosts_of(spark, d, []).select("record", F.col("diagnostics")[0].alias("how"), "taxid")


# ---- places ----------------------------------------------------------------------------------------------------------

COUNTRIES = seeds.values(seeds.COUNTRIES, seeds.COUNTRY_COLUMNS, "aliases")
REMAP = seeds.values(seeds.REMAP, seeds.REMAP_COLUMNS, "remap")
OFFICIAL = seeds.values(seeds.OFFICIAL_NAMES, "name string", "official")
GAZ = seeds.values(seeds.GAZETTEER, seeds.GAZETTEER_COLUMNS, "gaz")


def countries(spark):
    return seeds.frame(spark, seeds.COUNTRIES, seeds.COUNTRY_COLUMNS)


_COORD = "CASE o_orderkey % 4 WHEN 0 THEN (o_orderkey % 90) || '.25 N ' || (o_orderkey % 170) || '.5 W' WHEN 1 THEN (o_orderkey % 95) || '.5 S, ' || (o_orderkey % 170) || ' E' WHEN 2 THEN '-' || (o_orderkey % 90) || '.125, ' || (o_orderkey % 200) ELSE 'lot ' || o_orderkey END"
_N = "(-?[0-9]+\\.?[0-9]*)"
_HEMI, _PAIR = f"(?i){_N}{SPACE}*([NS]){SPACE}*(?:[,/]|{SPACE})*{SPACE}*{_N}{SPACE}*([EW])", f"{_N}{SPACE}*[,/]{SPACE}*{_N}"
_XY = (
    f"txt AS (SELECT o_orderkey, {_COORD} AS v FROM orders), xy AS (SELECT o_orderkey, v, CASE WHEN regexp_matches(v, '{_HEMI}') THEN CAST(regexp_extract(v, '{_HEMI}', 1) AS DOUBLE) * CASE WHEN upper(regexp_extract(v, '{_HEMI}', 2)) = 'S' THEN -1 ELSE 1 END WHEN regexp_matches(v, '{_PAIR}') THEN CAST(regexp_extract(v, '{_PAIR}', 1) AS DOUBLE) END AS lat, "
    f"CASE WHEN regexp_matches(v, '{_HEMI}') THEN CAST(regexp_extract(v, '{_HEMI}', 3) AS DOUBLE) * CASE WHEN upper(regexp_extract(v, '{_HEMI}', 4)) = 'W' THEN -1 ELSE 1 END WHEN regexp_matches(v, '{_PAIR}') THEN CAST(regexp_extract(v, '{_PAIR}', 2) AS DOUBLE) END AS lon FROM txt)"
)


def _coords(spark, d):
    k = F.col("o_orderkey")
    s = lambda n: (k % n).cast("string")
    v = (
        F.when(k % 4 == 0, F.concat(s(90), F.lit(".25 N "), s(170), F.lit(".5 W"))).when(k % 4 == 1, F.concat(s(95), F.lit(".5 S, "), s(170), F.lit(" E")))
        .when(k % 4 == 2, F.concat(F.lit("-"), s(90), F.lit(".125, "), s(200))).otherwise(F.concat(F.lit("lot "), k.cast("string")))
    )
    return G.with_coordinates(table(spark, d, "orders").select("o_orderkey", v.alias("v")), "v")


@query(f"WITH {_XY} SELECT o_orderkey, lat, lon, coalesce(lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180, false) AS valid FROM xy")
def coord_parse(spark, d):
    return _coords(spark, d).select("o_orderkey", "lat", "lon", "valid")


@query(
    f"WITH {GAZ}, {_XY}, p AS (SELECT DISTINCT lat, lon FROM xy WHERE lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180), dist AS (SELECT p.lat, p.lon, g.place, g.country, pow(sin(radians(g.lat - p.lat) / 2), 2) + cos(radians(p.lat)) * cos(radians(g.lat)) * pow(sin(radians(g.lon - p.lon) / 2), 2) AS h FROM p, gaz g) "
    "SELECT lat, lon, arg_min(place, h) AS place, arg_min(country, h) AS country FROM dist GROUP BY lat, lon"
)
def nearest_place(spark, d):
    points = _coords(spark, d).filter("valid").select("lat", "lon")
    return G.nearest_place(points, seeds.frame(spark, seeds.GAZETTEER, seeds.GAZETTEER_COLUMNS)).select("lat", "lon", "place", "country")


_MANY = "gaz AS (SELECT 'p' || p_partkey AS place, 'c' || (p_partkey % 50) AS country, -85 + ((p_partkey * 7919) % 16999) / 100.0 AS lat, -180 + ((p_partkey * 104729) % 35999) / 100.0 AS lon FROM part)"


@query(
    f"WITH {_MANY}, {_XY}, p AS (SELECT DISTINCT lat, lon FROM xy WHERE lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180), dist AS (SELECT p.lat, p.lon, g.place, g.country, pow(sin(radians(g.lat - p.lat) / 2), 2) + cos(radians(p.lat)) * cos(radians(g.lat)) * pow(sin(radians(g.lon - p.lon) / 2), 2) AS h FROM p, gaz g) "
    "SELECT lat, lon, arg_min(place, h) AS place, arg_min(country, h) AS country FROM dist GROUP BY lat, lon"
)
def nearest_of_many(spark, d):
    """The nearest of thousands of places, one for each part."""
    points = _coords(spark, d).filter("valid").select("lat", "lon")
    k = F.col("p_partkey")
    places = table(spark, d, "part").select(F.concat(F.lit("p"), k.cast("string")).alias("place"), F.concat(F.lit("c"), (k % 50).cast("string")).alias("country"), (F.lit(-85) + ((k * 7919) % 16999) / F.lit(100.0)).alias("lat"), (F.lit(-180) + ((k * 104729) % 35999) / F.lit(100.0)).alias("lon"))
    return G.nearest_place(points, places).select("lat", "lon", "place", "country")


_TOKENS = (
    "vals AS (SELECT DISTINCT attr_value AS value FROM curation_decisions WHERE attr_value IS NOT NULL), tok AS (SELECT value, trim(unnest(regexp_split_to_array(regexp_replace(value, '" + SPACE + "+', ' ', 'g'), '[:;,]'))) AS t, generate_subscripts(regexp_split_to_array(regexp_replace(value, '" + SPACE + "+', ' ', 'g'), '[:;,]'), 1) AS i FROM vals), "
    "ctry AS (SELECT value, arg_min(country, i) AS country, arg_min(continent, i) AS continent, arg_min(un_region, i) AS un_region FROM tok JOIN aliases ON alias = lower(t) GROUP BY value)"
)


def _values(spark, d):
    return table(spark, d, "curation_decisions").filter("attr_value is not null").select(F.col("attr_value").alias("value")).distinct()


@query(f"WITH {COUNTRIES}, {_TOKENS} SELECT * FROM ctry")
def country_lookup(spark, d):
    return G.lookup_countries(_values(spark, d), countries(spark))


@query(f"WITH {COUNTRIES}, {REMAP}, {OFFICIAL}, {_TOKENS}, m AS (SELECT value, c.country, coalesce(r.mapped, c.country) AS m FROM ctry c LEFT JOIN remap r ON r.country = c.country) SELECT value, country, o.name AS official, o.name IS NULL AS unmappable FROM m LEFT JOIN official o ON o.name = m.m")
def country_remap(spark, d):
    got = G.lookup_countries(_values(spark, d), countries(spark)).select("value", "country")
    return G.to_official(got, seeds.frame(spark, seeds.REMAP, seeds.REMAP_COLUMNS), seeds.frame(spark, seeds.OFFICIAL_NAMES, "name string"))


# decimal digits of all scripts count as 0-9 in coordinates
_LOCS = _candidates_sql("loc", "locs0") + f", locs AS (SELECT record, pos, attribute, {strip('value')} AS value, translate({strip('value')}, '{G.DIGITS}', '{'0123456789' * (len(G.DIGITS) // 10)}') AS num FROM locs0)"
_PLACES = (
    f"{_LOCS}, cl AS (SELECT *, regexp_matches(num, '{_HEMI}') OR regexp_matches(num, '{_PAIR}') OR attribute = 'latitude_only' AS pt, CASE WHEN contains(value, ':') THEN {strip("split_part(value, ':', 1)")} ELSE value END AS name, CASE WHEN contains(value, ':') THEN nullif({strip("substr(value, instr(value, ':') + 1)")}, '') END AS sub FROM locs WHERE value <> ''), "
    f"tok AS (SELECT name, trim(unnest(regexp_split_to_array(regexp_replace(name, '{SPACE}+', ' ', 'g'), '[:;,]'))) AS t, generate_subscripts(regexp_split_to_array(regexp_replace(name, '{SPACE}+', ' ', 'g'), '[:;,]'), 1) AS i FROM (SELECT DISTINCT name FROM cl WHERE NOT pt)), ctry AS (SELECT name, arg_min(country, i) AS country FROM tok JOIN aliases ON alias = lower(t) GROUP BY name), "
    "named AS (SELECT c.record, c.pos, c.sub, y.country, c.attribute || '=' || c.value AS pair FROM cl c LEFT JOIN ctry y ON y.name = c.name WHERE NOT c.pt), pick AS (SELECT record, arg_min(country, (sub IS NULL, pos)) AS country, arg_min(coalesce(sub, ''), (sub IS NULL, pos)) AS sub FROM named WHERE country IS NOT NULL GROUP BY record), "
    f"pt AS (SELECT record, pos, CASE WHEN regexp_matches(num, '{_HEMI}') THEN CAST(regexp_extract(num, '{_HEMI}', 1) AS DOUBLE) * CASE WHEN upper(regexp_extract(num, '{_HEMI}', 2)) = 'S' THEN -1 ELSE 1 END WHEN regexp_matches(num, '{_PAIR}') THEN CAST(regexp_extract(num, '{_PAIR}', 1) AS DOUBLE) END AS la, "
    f"CASE WHEN regexp_matches(num, '{_HEMI}') THEN CAST(regexp_extract(num, '{_HEMI}', 3) AS DOUBLE) * CASE WHEN upper(regexp_extract(num, '{_HEMI}', 4)) = 'W' THEN -1 ELSE 1 END WHEN regexp_matches(num, '{_PAIR}') THEN CAST(regexp_extract(num, '{_PAIR}', 2) AS DOUBLE) END AS lo FROM cl WHERE pt), "
    "near AS (SELECT record, pos, arg_min(place, h) AS sub, arg_min(country, h) AS country FROM (SELECT record, pos, place, country, pow(sin(radians(g.lat - la) / 2), 2) + cos(radians(la)) * cos(radians(g.lat)) * pow(sin(radians(g.lon - lo) / 2), 2) AS h FROM pt, gaz g WHERE la BETWEEN -90 AND 90 AND lo BETWEEN -180 AND 180) GROUP BY record, pos), "
    "every AS (SELECT record, pos, sub, country, 'direct_resolution' AS how FROM named WHERE country IS NOT NULL UNION ALL SELECT record, pos, sub, country, 'coordinate_resolution' FROM near), pick2 AS (SELECT record, arg_min(country, (sub IS NULL, pos)) AS country, arg_min(coalesce(sub, ''), (sub IS NULL, pos)) AS sub, arg_min(how, (sub IS NULL, pos)) AS how FROM every GROUP BY record), "
    "req AS (SELECT record, string_agg(pair, ' ' ORDER BY pos) AS pairs FROM named WHERE country IS NULL GROUP BY record)"
)


def place_candidates(spark, d):
    return listed(spark, d, "loc").withColumn("value", S.strip(F.col("value")))


def places_of(spark, d, cands=None):
    return G.standardize_places(place_candidates(spark, d) if cands is None else cands, countries(spark), seeds.frame(spark, seeds.GAZETTEER, seeds.GAZETTEER_COLUMNS), seeds.frame(spark, seeds.REMAP, seeds.REMAP_COLUMNS), seeds.frame(spark, seeds.OFFICIAL_NAMES, "name string"), ["latitude_only"])


_STD_LOC = f"WITH {COUNTRIES}, {REMAP}, {OFFICIAL}, {GAZ}, {_PLACES}"


@query(f"{_STD_LOC} SELECT record, country, nullif(sub, '') AS sublocation FROM pick")
def loc_pick(spark, d):
    c = place_candidates(spark, d).filter("value <> ''")
    c = G.with_coordinates(c, "value").filter("not looks and attribute <> 'latitude_only'").withColumn("part", S.split_place(F.col("value")))
    named = c.select("record", "pos", F.col("part.country_part").alias("name"), F.col("part.sublocation").alias("sublocation"))
    hit = named.join(G.lookup_countries(named, countries(spark), "name"), "name")
    return hit.groupBy("record").agg(F.min(F.struct(F.col("sublocation").isNull().alias("n"), "pos", "country", "sublocation")).alias("b")).select("record", "b.country", "b.sublocation")


@query(
    f"{_STD_LOC} SELECT i.record, o.name AS country, nullif(p.sub, '') AS sublocation, CASE WHEN p.country IS NOT NULL AND o.name IS NULL THEN 'unmappable_result' WHEN p.country IS NOT NULL THEN p.how WHEN q.pairs IS NOT NULL THEN 'model_request' ELSE 'unresolved_place' END AS diagnostic, "
    "CASE WHEN p.country IS NULL THEN q.pairs END AS request FROM (SELECT DISTINCT record FROM locs) i LEFT JOIN pick2 p USING (record) LEFT JOIN req q USING (record) LEFT JOIN remap r ON r.country = p.country LEFT JOIN official o ON o.name = coalesce(r.mapped, p.country)"
)
def std_location(spark, d):
    """Standardised location of every record."""
    return places_of(spark, d).select("record", "country", "sublocation", "diagnostic", "request")


# ---- isolation -------------------------------------------------------------------------------------------------------

_ISO = _candidates_sql("iso", "iso", strip("attr_value"))
_KW = "replace(replace(lower({}), ' ', '_'), '-', '_')"
_ONTO = (
    "nodes AS (SELECT row_number() OVER (ORDER BY term) AS o, term, coalesce(nullif(trim(display_term), ''), string_split(term, ':')[-1]) AS shown, coalesce(ontology_link, '') AS links, list_filter(list_transform(string_split(coalesce(synonyms, ''), ';'), lambda x: trim(x)), lambda x: x <> '') AS syn, crosslink_term AS x FROM ontology_terms), "
    f"nm AS (SELECT o, term, 0 AS p, {_KW.format('shown')} AS norm FROM nodes UNION ALL SELECT o, term, i, {_KW.format('s')} FROM (SELECT o, term, unnest(syn) AS s, generate_subscripts(syn, 1) AS i FROM nodes)), by_term AS (SELECT norm, arg_min(term, (o, p)) AS term FROM nm WHERE norm <> '' GROUP BY norm), "
    "by_id AS (SELECT upper(trim(l)) AS id, arg_min(term, o) AS term FROM (SELECT o, term, unnest(string_split(links, ';')) AS l FROM nodes WHERE links <> '') GROUP BY 1)"
)
_DIRECT = (
    f"v AS (SELECT DISTINCT value FROM iso WHERE value <> ''), ids AS (SELECT value, unnest(f) AS id, generate_subscripts(f, 1) AS i FROM (SELECT value, regexp_extract_all(upper(value), '\\b([A-Z]+:[0-9]+)\\b', 1) AS f FROM v)), vi AS (SELECT value, arg_min(term, i) AS term FROM ids JOIN by_id USING (id) GROUP BY value), "
    f"direct AS (SELECT v.value, coalesce(vi.term, b.term) AS term FROM v LEFT JOIN vi USING (value) LEFT JOIN by_term b ON b.norm = {_KW.format('v.value')} WHERE coalesce(vi.term, b.term) IS NOT NULL)"
)
_LINKED = (
    f"edges AS (SELECT DISTINCT n.term, coalesce(t.term, i.term) AS target FROM (SELECT term, trim(unnest(string_split(x, ';'))) AS c FROM nodes WHERE x IS NOT NULL) n LEFT JOIN by_term t ON t.norm = {_KW.format('n.c')} LEFT JOIN by_id i ON i.id = upper(n.c) WHERE coalesce(t.term, i.term) IS NOT NULL), "
    "sel AS (SELECT DISTINCT record, term FROM iso JOIN direct USING (value)), linked AS (SELECT record, term, false AS crosslinked FROM sel UNION ALL SELECT DISTINCT s.record, e.target, true FROM sel s JOIN edges e USING (term) WHERE NOT EXISTS (SELECT 1 FROM sel z WHERE z.record = s.record AND z.term = e.target))"
)
_ISO_SQL = f"WITH {_ISO}, {_ONTO}, {_DIRECT}, {_LINKED}"


def iso_candidates(spark, d):
    return listed(spark, d, "iso").withColumn("value", S.strip(F.col("value")))


def _selected(spark, d):
    c = iso_candidates(spark, d).filter("value <> ''")
    nodes = I.nodes_of(table(spark, d, "ontology_terms"))
    return c.join(I.direct_matches(c, nodes), "value").select("record", "term").distinct(), nodes


@query(f"WITH {_ISO}, {_ONTO}, {_DIRECT} SELECT value, term FROM direct")
def iso_direct(spark, d):
    return I.direct_matches(iso_candidates(spark, d).filter("value <> ''"), I.nodes_of(table(spark, d, "ontology_terms")))


@query(_ISO_SQL + " SELECT record, term, crosslinked FROM linked")
def crosslink(spark, d):
    chosen, nodes = _selected(spark, d)
    return I.with_crosslinks(chosen, I.crosslink_edges(nodes), "record")


_RENDER = (
    "rend AS (SELECT record, array_to_string(list_sort(list(DISTINCT split_part(n.term, ':', 1))), '||') AS categories, string_agg(n.shown, '||' ORDER BY n.term) AS display_terms, string_agg(coalesce(nullif(n.links, ''), 'NA'), '||' ORDER BY n.term) AS ontology_links, string_agg(n.term, '||' ORDER BY n.term) AS term_paths FROM linked l JOIN nodes n ON n.term = l.term GROUP BY record)"
)


@query(f"{_ISO_SQL}, {_RENDER} SELECT * FROM rend")
def iso_render(spark, d):
    chosen, nodes = _selected(spark, d)
    return I.render_nodes(I.with_crosslinks(chosen, I.crosslink_edges(nodes), "record"), nodes, "record")


@query(
    f"{_ISO_SQL}, {_RENDER}, cnt AS (SELECT record, count(*) FILTER (WHERE value <> '') AS n, count(*) FILTER (WHERE value IN (SELECT value FROM direct)) AS h FROM iso GROUP BY record) SELECT c.record, coalesce(categories, 'unspecified') AS categories, coalesce(display_terms, 'unspecified') AS display_terms, coalesce(term_paths, '') AS term_paths, "
    "CASE WHEN h > 0 THEN 'sample' ELSE 'none' END AS evidence_level, n > 0 AND n = h AS covered FROM cnt c LEFT JOIN rend USING (record)"
)
def std_isolation(spark, d):
    """Standardised isolation source of every record, without a model."""
    return I.standardize_isolation(iso_candidates(spark, d), table(spark, d, "ontology_terms")).select("record", "categories", "display_terms", "term_paths", "evidence_level", "covered")


_LEVELS = ("none", "sample", "project", "sample_and_project")


@query(
    "WITH t AS (SELECT o_orderkey, o_orderkey % 2 = 0 AS d, o_orderkey % 3 = 0 AS m, (['none', 'sample', 'project', 'sample_and_project'])[1 + CASE WHEN o_orderkey % 3 = 0 THEN 1 + o_orderkey % 3 ELSE o_orderkey % 4 END] AS c FROM orders) "
    "SELECT o_orderkey, CASE WHEN NOT d AND NOT m THEN 'none' WHEN d AND NOT m THEN 'sample' WHEN d AND c IN ('project', 'sample_and_project') THEN 'sample_and_project' ELSE c END AS level FROM t"
)
def evidence_level(spark, d):
    k = F.col("o_orderkey")
    claimed = F.element_at(F.array(*[F.lit(x) for x in _LEVELS]), (1 + F.when(k % 3 == 0, 1 + k % 3).otherwise(k % 4)).cast("int"))
    return table(spark, d, "orders").select("o_orderkey", I.evidence_level(k % 2 == 0, k % 3 == 0, claimed).alias("level"))


@query()
def tree_render(spark, d):
    """Markdown of the ontology, one row per line; the ontology is a list of fixed size."""
    rows = [(r["term"], r["display_term"], r["term_comment"]) for r in table(spark, d, "ontology_terms").orderBy("term").collect()]
    lines = I.render_tree(rows, ("outdoor", "organism"))[0].split("\n")
    return spark.createDataFrame(list(enumerate(lines)), "line_no long, line string")


# ---- model requests --------------------------------------------------------------------------------------------------

_REQ = "SELECT o_orderkey, '{\"messages\":[{\"content\":\"Name one country.\",\"role\":\"system\"},{\"content\":\"priority=' || o_orderpriority || '\",\"role\":\"user\"}],\"model\":\"m-1\",\"parameters\":{\"seed\":100,\"temperature\":0},\"response_schema_id\":\"country:1\"}' AS request FROM orders"


def _requests(spark, d):
    text = M.request_json("m-1", {"temperature": 0, "seed": 100}, "country:1", "Name one country.", F.concat(F.lit("priority="), F.col("o_orderpriority")))
    return table(spark, d, "orders").select("o_orderkey", text.alias("request")).withColumn("fingerprint", M.fingerprint(F.col("request")))


@query(f"SELECT o_orderkey, sha256(request) AS fingerprint FROM ({_REQ})")
def fingerprint(spark, d):
    return _requests(spark, d).select("o_orderkey", "fingerprint")


@query(f"WITH r AS (SELECT o_orderkey, sha256(request) AS f FROM ({_REQ})) SELECT o_orderkey, row_number() OVER (PARTITION BY f ORDER BY o_orderkey) = 1 AS first_call FROM r")
def request_dedupe(spark, d):
    return M.mark_repeats(_requests(spark, d), ["o_orderkey"]).select("o_orderkey", "first_call")


@query(f"WITH r AS (SELECT o_orderkey, sha256(request) AS f, request FROM ({_REQ})), c AS (SELECT DISTINCT f FROM r WHERE contains(request, 'URGENT') OR contains(request, 'LOW')) SELECT o_orderkey, f IN (SELECT f FROM c) AS cached FROM r")
def cache_lookup(spark, d):
    r = _requests(spark, d)
    cache = r.filter(F.col("request").contains("URGENT") | F.col("request").contains("LOW")).select("fingerprint", F.lit("NA").alias("reply")).distinct()
    hit, miss = M.lookup(r, cache)
    return hit.select("o_orderkey", F.lit(True).alias("cached")).unionByName(miss.select("o_orderkey", F.lit(False).alias("cached")))


_REPLIES = ('{"country": " Norvelia "}', '{"country": ""}', '{"country": 7}', '{"country": "NA", "note": "x"}', "not json", '["Norvelia"]', '{"land": "Norvelia"}')


@query("SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'Norvelia' END AS country FROM events")
def reply_validate(spark, d):
    reply = F.element_at(F.array(*[F.lit(x) for x in _REPLIES]), (1 + F.col("event_id") % 7).cast("int"))
    return table(spark, d, "events").select("event_id", M.valid_country(reply).alias("country"))


@query(
    f"WITH r AS (SELECT DISTINCT request FROM ({_REQ})), c AS (SELECT CASE WHEN contains(request, 'URGENT') THEN 'timeout' ELSE 'ok' END AS status, CASE WHEN contains(request, 'URGENT') THEN 2 ELSE 1 END AS n, length(request) AS t FROM r) SELECT target, model, CAST(sum(n) AS BIGINT) AS attempts, count(*) FILTER (WHERE status = 'ok') AS successes, count(*) FILTER (WHERE status <> 'ok') AS failures, CAST(sum(n - 1) AS BIGINT) AS retries, "
    "CAST(sum(CASE WHEN status = 'ok' THEN t ELSE 0 END) AS BIGINT) AS input_tokens, CAST(sum(CASE WHEN status = 'ok' THEN 2 ELSE 0 END) AS BIGINT) AS output_tokens FROM (SELECT 'location' AS target, 'm-1' AS model, * FROM c) GROUP BY GROUPING SETS ((target, model), ())"
)
def llm_metrics(spark, d):
    """Calls of a deterministic stand-in for a model, one per distinct request, by target and model and in all."""
    calls = M.call_model(_requests(spark, d).select("fingerprint", "request"), _stand_in).withColumns({"target": F.lit("location"), "model": F.lit("m-1")})
    return M.metrics(calls, "target", "model").drop("seconds")


@query(f"SELECT 'location' AS target, 'timeout' AS status, count(*) AS n FROM (SELECT DISTINCT request FROM ({_REQ}) WHERE contains(request, 'URGENT')) HAVING count(*) > 0")
def llm_failures(spark, d):
    """Failed calls of the stand-in by kind."""
    return M.failures(M.call_model(_requests(spark, d).select("fingerprint", "request"), _stand_in).withColumn("target", F.lit("location")), "target")


def _stand_in(request: str) -> tuple[str, dict]:
    if "URGENT" in request:
        raise TimeoutError
    return '{"country": "Norvelia"}', {"input_tokens": len(request), "output_tokens": 2}


_OPENED = "cnt AS (SELECT record, count(*) FILTER (WHERE value <> '') AS n, count(*) FILTER (WHERE value IN (SELECT value FROM direct)) AS h FROM iso GROUP BY record), opened AS (SELECT record FROM cnt WHERE n > 0 AND n <> h)"


@query(
    f"WITH {_ISO}, {_ONTO}, {_DIRECT}, {_OPENED}, b AS (SELECT record, 'Metadata:' || chr(10) || string_agg(attribute || ' = ' || value, chr(10) ORDER BY pos, attribute, value) AS block FROM iso JOIN opened USING (record) WHERE value <> '' GROUP BY record) "
    "SELECT record, 'sample_only' AS request_mode, sha256('{\"messages\":[{\"content\":\"Choose terms.\",\"role\":\"system\"},{\"content\":' || to_json(block) || ',\"role\":\"user\"}],\"model\":\"m-1\",\"parameters\":{\"temperature\":0},\"response_schema_id\":\"terms:1\"}') AS fingerprint FROM b"
)
def iso_llm(spark, d):
    """Requests that a model would get for records that direct matches do not cover, and their fingerprints."""
    c = iso_candidates(spark, d)
    std = I.standardize_isolation(c, table(spark, d, "ontology_terms")).filter("not covered and request_mode is not null").select("record", "request_mode")
    pairs = c.filter("value <> ''").groupBy("record").agg(F.array_sort(F.collect_list(F.struct("pos", "attribute", "value"))).alias("p"))
    text = M.request_json("m-1", {"temperature": 0}, "terms:1", "Choose terms.", S.render_block(F.col("p.attribute"), F.col("p.value")))
    return std.join(pairs, "record").select("record", "request_mode", M.fingerprint(text).alias("fingerprint"))


# ---- host policy ----------------------------------------------------------------------------------------------------

POLICY = {
    "schema_version": 2, "normalization": {"ignored_substrings": ["healthy"]}, "routing": {"isolation_source_keywords": ["meat"]}, "value_rejections": {"exact": ["not a host"]},
    "curated_taxa": {
        "91001": {"scientific_name": "Ursina fulva", "match_terms": {"exact": ["ox of the hills"], "subset": ["hill ox"], "force": ["Grey-Hen"]}},
        "91003": {"scientific_name": "Velumia montana", "match_terms": {"exact": ["Ovis dentata", "hill goat"]}},
        "99999": {"scientific_name": "Absentia nulla", "match_terms": {"subset": ["nobody", "Pelagoma vasta"]}},
    },
}


@query(
    f"WITH {TAXA}, want(taxid, name) AS (VALUES (91001, 'Ursina fulva'), (91003, 'Velumia montana'), (99999, 'Absentia nulla')), mine(taxid, term) AS (VALUES (91001, 'ox of the hills'), (91001, 'hill ox'), (91003, 'ovis dentata'), (91003, 'hill goat'), (99999, 'nobody'), (99999, 'pelagoma vasta')), "
    "exact AS (SELECT lower(scientific_name) AS term, taxid FROM taxa UNION ALL SELECT lower(trim(unnest(string_split(synonym, ';')))), taxid FROM taxa) "
    "SELECT CAST(w.taxid AS BIGINT) AS taxid, CASE WHEN t.taxid IS NULL THEN 'absent' ELSE 'name' END AS problem, coalesce(t.scientific_name, '') AS detail FROM want w LEFT JOIN taxa t USING (taxid) WHERE t.scientific_name IS DISTINCT FROM w.name UNION ALL SELECT CAST(m.taxid AS BIGINT), 'term', term FROM mine m JOIN exact e USING (term) WHERE e.taxid <> m.taxid"
)
def host_policy_check(spark, d):
    """Curated taxa and terms of a policy that do not fit the taxa."""
    from sampleloom.operators.host_policy import HostPolicy

    return HostPolicy.of(POLICY).problems(spark, taxa(spark))
