"""Queries of sources, sinks and the final table, with their SQL."""

from __future__ import annotations

import json
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sampleloom.functions import strings as S
from sampleloom.operators import dataset as T
from sampleloom.plans import date_queries as DQ
from sampleloom.plans import entity_queries as E
from sampleloom.plans import pipeline as PL
from sampleloom.plans import seeds
from sampleloom.plans.folding import strip
from sampleloom.plans.relational_queries import REG, registry
from sampleloom.session import ensure_checkpoint_dir, spread, table
from sampleloom.sources import tables, xml

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _shared(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"


# ---- sources ---------------------------------------------------------------------------------------------------------


def _xml_file(spark: SparkSession, d: str) -> str:
    """The well-formed XML payloads as one text source."""
    path = _shared(spark, "xml")
    rows = table(spark, d, "raw_records").filter("payload_format = 'xml' and payload is not null").select("record_id", "payload").distinct()
    rows.select(F.col("payload").alias("value")).mapInArrow(_well_formed, "value string").mapInArrow(_rooted, "value string").write.text(path)
    return path


def _well_formed(batches):
    from sampleloom.operators.node_tables import bare_markup

    for b in batches:
        whole = [x.decode() for x in (bare_markup(v.encode()) for v in b.column(0).to_pylist()) if x]
        yield pa.record_batch([pa.array(whole, pa.string())], names=["value"])


def _rooted(batches):
    """One root element around the rows of each partition, so that each file is a document."""
    line = lambda s: pa.record_batch([pa.array([s])], names=["value"])
    yield line("<Set>")
    yield from batches
    yield line("</Set>")


def _escaped(c):
    """Text of an element or attribute: what XML 1.0 cannot hold is left out, line ends and tabs are written as references."""
    c = F.regexp_replace(c, r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "")
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("\t", "&#9;"), ("\n", "&#10;"), ("\r", "&#13;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def _sample_dump(spark: SparkSession, d: str) -> str:
    """All decisions as a dump of samples: one element for each accession, decision after decision, with its project as a link."""
    t = table(spark, d, "curation_decisions").filter("accession is not null").select("decision_id", "accession", "attr_name", "attr_value", "bioproject_accession").distinct()
    cell = F.struct("decision_id", "attr_name", "attr_value", "bioproject_accession")
    g = t.groupBy("accession").agg(F.array_sort(F.collect_list(cell)).alias("c"), F.max("decision_id").alias("last"), (F.max("decision_id") % 3).alias("taxid"))
    named = lambda x: F.when(x["decision_id"] % 2 == 0, F.concat(F.lit(' harmonized_name="'), _escaped(F.coalesce(x["attr_name"], F.lit(""))), F.lit('"'))).otherwise(F.concat(F.lit(' attribute="'), _escaped(F.coalesce(x["attr_name"], F.lit(""))), F.lit('"')))
    attributes = F.array_join(F.transform("c", lambda x: F.concat(F.lit("<Attribute"), named(x), F.lit(">"), _escaped(F.coalesce(x["attr_value"], F.lit(""))), F.lit("</Attribute>"))), "")
    links = F.array_join(F.transform("c", lambda x: F.concat(F.lit('<Link target="bioproject">'), F.regexp_replace(F.coalesce(x["bioproject_accession"], F.lit("")), "[^0-9]", ""), F.lit("</Link>"))), "")
    body = F.concat(
        F.lit('<BioSample accession="'), _escaped(F.col("accession")), F.lit('" access="public" submission_date="'), F.concat(F.lit("2020-01-01T00:00:"), F.lpad((F.col("last") % 60).cast("string"), 2, "0")), F.lit('"><Description><Organism taxonomy_id="'), F.col("taxid").cast("string"),
        F.lit('" taxonomy_name="n'), F.col("taxid").cast("string"), F.lit('"/></Description><Attributes>'), attributes, F.lit("</Attributes><Links>"), links, F.lit("</Links></BioSample>"),
    )
    path = _shared(spark, "samples")
    g.select(body.alias("value")).mapInArrow(_rooted, "value string").write.text(path)
    return path


_HELD = "regexp_replace({}, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]', '', 'g')"
_DUMPED = f"t AS (SELECT DISTINCT decision_id, accession, attr_name, attr_value, bioproject_accession FROM curation_decisions WHERE accession IS NOT NULL), inner_ AS (SELECT accession, decision_id, {_HELD.format('attr_name')} AS attribute, {_HELD.format('attr_value')} AS value FROM t)"


@query(
    f"WITH {_DUMPED}, c AS (SELECT accession, -1 AS i, 'submission_date' AS attribute, '2020-01-01T00:00:' || lpad(CAST(max(decision_id) % 60 AS VARCHAR), 2, '0') AS value, 'biosample_root' AS xml_source, false AS numbered FROM t GROUP BY accession UNION ALL SELECT accession, decision_id, attribute, value, 'attribute', false FROM inner_ WHERE attribute <> '' AND NOT regexp_full_match(value, '[ \\t\\r\\n]*')) "
    "SELECT accession, row_number() OVER (PARTITION BY accession ORDER BY i, attribute, value) - 1 AS pos, attribute, value, xml_source, (SELECT array_to_string(list_sort(list(DISTINCT regexp_replace(bioproject_accession, '[^0-9]', '', 'g'))), ',') FROM t WHERE t.accession = c.accession AND regexp_replace(bioproject_accession, '[^0-9]', '', 'g') <> '') AS ids FROM c"
)
def scan_xml_samples(spark, d):
    """Every candidate and linked id of all decisions, written as a dump of samples and scanned again."""
    got = xml.scan_samples(spark, _sample_dump(spark, d))
    return got.select("accession", F.posexplode("candidates").alias("pos", "c"), F.array_join("project_ids", ",").alias("ids")).select("accession", F.col("pos").cast("long").alias("pos"), "c.*", F.nullif("ids", F.lit("")).alias("ids"))


@query(
    "WITH t AS (SELECT accession, max(decision_id) % 3 AS taxid FROM curation_decisions WHERE accession <> '' GROUP BY accession), scope AS (SELECT DISTINCT accession FROM accession_index WHERE in_atb = 'True') "
    "SELECT accession, CASE taxid WHEN 1 THEN 'one' WHEN 2 THEN 'two' END AS pathogen, CAST(taxid AS VARCHAR) AS taxid, 'n' || taxid AS organism FROM t WHERE taxid <> 0 UNION ALL SELECT accession, NULL, NULL, NULL FROM t WHERE taxid = 0 AND accession IN (SELECT accession FROM scope)"
)
def subset_xml(spark, d):
    """Id lists by taxid and, with null pathogen, the elements that only the scope of the catalog keeps; the written subset is scanned again."""
    from sampleloom.plans import subset

    closed = spark.createDataFrame([(1, "one"), (2, "two")], "taxid long, key string")
    scope = table(spark, d, "accession_index").filter("in_atb = 'True'").select("accession")
    got = subset.select_samples(subset.raw_samples(spark, _sample_dump(spark, d)), closed, scope)
    path = _shared(spark, "subset")
    subset.write_subset(got.elements, path)
    again = xml.scan_samples(spark, path).select("accession")
    return again.join(got.lists, "accession", "left").select("accession", "pathogen", "taxid", "organism")


@query()
def scan_xml_projects(spark, d):
    """Top project elements of the XML payloads in both wrappings."""
    got = xml.scan_projects(spark, _xml_file(spark, d))
    return got.select("id", "accession", "title", F.to_json("relevance").alias("relevance"))


@query("SELECT DISTINCT accession, in_atb, pathogen_biosample, coalesce(taxid, '') AS taxid, coalesce(organism_value, '') AS organism_value FROM accession_index")
def scan_tsv(spark, d):
    """The index through the tab-separated sink and scan."""
    path = _shared(spark, "tsv")
    t = table(spark, d, "accession_index").select("accession", "in_atb", "pathogen_biosample", "taxid", "organism_value").distinct()
    tables.write_tsv(t, path)
    return tables.scan_tsv(spark, path, "accession string, in_atb string, pathogen_biosample string, taxid string, organism_value string")


# ---- final table -----------------------------------------------------------------------------------------------------

_SELECTED = ("q_varensis", "q_lutea", "b_oxalis")
_IN = ", ".join(f"'{s}'" for s in _SELECTED)
_EVERY = ", ".join(f"'{r[0]}'" for r in seeds.REGISTRY)
_RECORDS = "(SELECT accession, arg_max(pathogen_biosample, (first_seen, pathogen_biosample)) AS pathogen FROM accession_index WHERE trim(accession) <> '' AND trim(pathogen_biosample) <> '' GROUP BY accession)"


def records(spark: SparkSession, d: str) -> DataFrame:
    """``(accession, pathogen, bioproject_accession)`` of the index; the linked project of the greatest decision counts."""
    from sampleloom.operators.index import last_wins

    m = last_wins(table(spark, d, "accession_index"), "accession", "pathogen_biosample", ["first_seen"]).withColumnRenamed("pathogen_biosample", "pathogen")
    p = table(spark, d, "curation_decisions").filter("accession is not null and bioproject_accession is not null").groupBy("accession").agg(F.max(F.struct("decision_id", "bioproject_accession"))["bioproject_accession"].alias("bioproject_accession"))
    return m.join(p, "accession", "left")


@query(f"SELECT accession, pathogen FROM {_RECORDS} WHERE pathogen IN ({_IN})")
def select_pathogens(spark, d):
    return T.select_groups(records(spark, d), _SELECTED).select("accession", "pathogen")


@query(f"WITH {REG} SELECT r.key AS pathogen, count(x.accession) AS n FROM registry r LEFT JOIN {_RECORDS} x ON x.pathogen = r.key GROUP BY r.key")
def count_selected(spark, d):
    return T.count_groups(records(spark, d), registry(spark).select(F.col("key").alias("pathogen")))


_STD_DATE, _STD_HOST, _STD_LOC, _STD_ISO = DQ.ORACLE["std_date"], E.ORACLE["std_host"], E.ORACLE["std_location"], E.ORACLE["std_isolation"]
_OUTCOMES = (
    f"dates AS ({_STD_DATE}), hosts AS ({_STD_HOST}), places AS ({_STD_LOC}), isos AS ({_STD_ISO}), j AS (SELECT x.accession, x.pathogen, d.date_start, d.date_end, d.date_score, h.taxid, h.how, l.country, l.sublocation, i.term_paths, i.display_terms "
    f"FROM {_RECORDS} x LEFT JOIN dates d ON d.accession = x.accession LEFT JOIN hosts h ON h.record = x.accession LEFT JOIN places l ON l.record = x.accession LEFT JOIN isos i ON i.record = x.accession WHERE x.pathogen IN ({_EVERY}))"
)


def _outcomes(spark, d):
    """Outcomes of the records of all registered pathogens."""
    r = T.select_groups(records(spark, d), [x[0] for x in seeds.REGISTRY])
    k = lambda df: df.withColumnRenamed("record", "accession")
    dates = DQ.QUERIES["std_date"](spark, d)
    hosts, places, isos = (k(E.QUERIES[n](spark, d)) for n in ("std_host", "std_location", "std_isolation"))
    return (
        r.join(dates.select("accession", "date_start", "date_end", "date_score"), "accession", "left").join(hosts.select("accession", "taxid", "how"), "accession", "left")
        .join(places.select("accession", "country", "sublocation"), "accession", "left").join(isos.select("accession", "term_paths", "display_terms"), "accession", "left")
    )


@query(f"WITH {_OUTCOMES} SELECT accession FROM j WHERE date_start IS NOT NULL OR taxid IS NOT NULL OR country IS NOT NULL OR display_terms IS NOT NULL")
def accept_rows(spark, d):
    o = _outcomes(spark, d)
    return o.filter(T.accepted(*[F.col(c) for c in ("date_start", "taxid", "country", "display_terms")])).select("accession")


@query(
    f"WITH {REG}, {seeds.values(seeds.TAXA, seeds.TAXA_COLUMNS, 'taxa0')}, {_OUTCOMES} SELECT j.accession, r.scientific_name AS pathogen, EXISTS (SELECT 1 FROM accession_index a WHERE a.in_atb = 'True' AND a.accession = j.accession AND a.pathogen_atb = j.pathogen) AS in_ATB, "
    "coalesce(CAST(date_start AS VARCHAR), '') AS date_start, coalesce(CAST(date_end AS VARCHAR), '') AS date_end, coalesce(CAST(date_score AS VARCHAR), '') AS date_score, coalesce(country, '') AS loc_country, CASE WHEN country IS NULL THEN '' ELSE coalesce(sublocation, 'NA') END AS loc_sublocation, "
    "coalesce(term_paths, '') AS iso_term_paths, coalesce(CAST(j.taxid AS VARCHAR), '') AS host_taxid, coalesce(t.scientific_name, '') AS host_scientific_name FROM j JOIN registry r ON r.key = j.pathogen LEFT JOIN taxa0 t ON t.taxid = j.taxid"
)
def final_projection(spark, d):
    """The columns of the final table that the outcomes give."""
    names = E.taxa(spark).select("taxid", F.col("scientific_name").alias("host_scientific_name"))
    o = _outcomes(spark, d).join(names, "taxid", "left").withColumnsRenamed({"taxid": "host_taxid", "country": "loc_country", "sublocation": "loc_sublocation", "term_paths": "iso_term_paths"})
    absent = {c for a in T.COLUMNS.values() for c in a} - set(o.columns)
    o = o.withColumns({c: F.lit(None).cast("string") for c in absent})
    member = table(spark, d, "accession_index").filter("in_atb = 'True'").select(F.col("pathogen_atb").alias("pathogen"), "accession")
    wide = T.project_final(o, ("date", "loc", "iso", "host"), registry(spark), member)
    return wide.select("accession", "pathogen", "in_ATB", "date_start", "date_end", "date_score", "loc_country", "loc_sublocation", "iso_term_paths", "host_taxid", "host_scientific_name")


@query(
    f"WITH {REG}, {_OUTCOMES}, g AS (SELECT r.key AS pathogen, count(j.accession) AS processed, count_if(j.date_start IS NOT NULL) AS dated, count_if(j.taxid IS NOT NULL) AS hosted, count_if(j.country IS NOT NULL) AS placed FROM registry r LEFT JOIN j ON j.pathogen = r.key GROUP BY r.key), "
    "long AS (SELECT pathogen, unnest(['processed', 'dated', 'hosted', 'placed']) AS metric, unnest([processed, dated, hosted, placed]) AS n FROM g) SELECT pathogen, metric, CAST(sum(n) AS BIGINT) AS n FROM long GROUP BY GROUPING SETS ((pathogen, metric), (metric))"
)
def report_rollup(spark, d):
    flags = {"dated": F.col("date_start").isNotNull(), "hosted": F.col("taxid").isNotNull(), "placed": F.col("country").isNotNull()}
    return T.report(_outcomes(spark, d), registry(spark).select(F.col("key").alias("pathogen")), flags)


@query(f"WITH hosts AS ({_STD_HOST}), g AS (SELECT x.pathogen, h.how FROM {_RECORDS} x JOIN hosts h ON h.record = x.accession) SELECT pathogen, how AS diagnostic, count(*) AS n FROM g GROUP BY GROUPING SETS ((pathogen, how), (how))")
def diagnostic_histogram(spark, d):
    h = E.QUERIES["std_host"](spark, d).select(F.col("record").alias("accession"), F.array("how").alias("diagnostics"))
    return T.histogram(records(spark, d).join(h, "accession"), "diagnostics")


@query(
    f"WITH hosts AS ({_STD_HOST}), {E.NAME_FORMS}, raw AS (SELECT accession, arg_min(attr_value, decision_id) AS v FROM curation_decisions JOIN nf ON v = attr_name WHERE accession IS NOT NULL AND form = 'host' AND attr_value IS NOT NULL GROUP BY accession), "
    f"{seeds.values(seeds.TAXA, seeds.TAXA_COLUMNS, 'taxa')} SELECT h.record AS accession, coalesce(nullif(trim(t.scientific_name), ''), {strip('raw.v')}, '') AS host_context FROM hosts h LEFT JOIN raw ON raw.accession = h.record LEFT JOIN taxa t ON t.taxid = h.taxid"
)
def host_context(spark, d):
    """The standard name, else the first raw value under the host attribute, of every record with a host candidate."""
    raw = E.host_candidates(spark, d).filter("attribute = 'host' and value is not null").groupBy(F.col("record").alias("accession")).agg(F.min(F.struct("pos", "value"))["value"].alias("v"))
    h = E.QUERIES["std_host"](spark, d).select(F.col("record").alias("accession"), "taxid").join(E.taxa(spark).select("taxid", "scientific_name"), "taxid", "left")
    return h.join(raw, "accession", "left").select("accession", T.host_context(F.col("scientific_name"), S.strip(F.col("v"))).alias("host_context"))


@query(f"WITH isos AS ({_STD_ISO}) SELECT record AS accession, '{{\"accession\":' || to_json(record) || ',\"display_terms\":' || to_json(display_terms) || ',\"evidence_level\":' || to_json(evidence_level) || '}}' AS line FROM isos")
def reasoning_json(spark, d):
    i = E.QUERIES["std_isolation"](spark, d)
    return i.select(F.col("record").alias("accession"), T.reasoning_line({"accession": F.col("record"), "display_terms": F.col("display_terms"), "evidence_level": F.col("evidence_level")}).alias("line"))


def dimensions(spark: SparkSession, d: str) -> PL.Dimensions:
    """The seed vocabularies, with the ontology and catalog of the tables."""
    nodes = seeds.frame(spark, seeds.NODES, seeds.NODES_COLUMNS)
    catalog = table(spark, d, "bio_projects").select("accession", "title", "description", "relevance")
    return PL.Dimensions(
        registry(spark), table(spark, d, "accession_index").filter("in_atb = 'True'").select(F.col("pathogen_atb").alias("pathogen"), "accession"), E.taxa(spark), E.preempt_table(spark), nodes,
        nodes.select("taxid", "name", S.none_of().alias("common_names")), E.countries(spark), seeds.frame(spark, seeds.GAZETTEER, seeds.GAZETTEER_COLUMNS), seeds.frame(spark, seeds.REMAP, seeds.REMAP_COLUMNS),
        seeds.frame(spark, seeds.OFFICIAL_NAMES, "name string"), table(spark, d, "ontology_terms"), catalog, seeds.IGNORED_SUBSTRINGS, seeds.ISOLATION_KEYWORDS, ("latitude_only",), ("consumable", "organism"),
    )


def candidates(spark: SparkSession, d: str) -> DataFrame:
    """``(record, pos, target, attribute, value, category)`` of all four targets."""
    dates = table(spark, d, "date_origins").filter("accession is not null and trim(accession) <> '' and attr_value is not null and attr_name is not null")
    dates = spread(dates, "accession", "attr_value").groupBy(F.col("accession").alias("record"), F.col("attr_name").alias("attribute"), F.col("attr_value").alias("value"), "category").agg(F.min("origin_id").alias("pos"))
    out = dates.select("record", "pos", F.lit("date").alias("target"), "attribute", "value", "category")
    rest = E.curated(spark, d).select("record", "pos", "target", "attribute", "value", F.lit("").alias("category")).distinct()
    return out.unionByName(rest)


@query()
def harmonize(spark, d):
    """The whole pipeline for all registered pathogens; its steps have their own SQL."""
    request = PL.Request([r[0] for r in seeds.REGISTRY], reference_date=DQ.REFERENCE)
    return PL.final_table(records(spark, d), candidates(spark, d), dimensions(spark, d), request)


# ---- the model in the pipeline ---------------------------------------------------------------------------------------


def _place_client(request: str) -> str:
    """A stand-in that knows one country, does not know another kind of place, and fails on the rest."""
    if "geo" in request:
        return '{"country": "norvelia"}'
    if "place" in request:
        return '{"country": "NA"}'
    raise TimeoutError


@query(
    f"WITH std AS ({E.ORACLE['std_location']}), r AS (SELECT *, diagnostic = 'model_request' AS asked, row_number() OVER (PARTITION BY diagnostic, request ORDER BY record) = 1 AS first_call FROM std) SELECT record, CASE WHEN asked AND contains(request, 'geo') THEN 'Norvelia' ELSE country END AS country, CASE WHEN NOT asked THEN diagnostic "
    "WHEN contains(request, 'geo') THEN CASE WHEN first_call THEN 'llm_resolution' ELSE 'cache_resolution' END WHEN contains(request, 'place') THEN 'unmappable_result' ELSE 'recoverable_llm_failure' END AS diagnostic FROM r"
)
def location_llm(spark, d):
    """Locations with the answers of a deterministic stand-in for a model."""
    from sampleloom.plans.model_stage import Model, Prompts, location_answers

    dims = dimensions(spark, d)
    model = Model("m-1", _place_client, prompts=Prompts(location_user="Where? {metadata}"))
    return location_answers(E.places_of(spark, d), model, dims.aliases, dims.remap, dims.official).outcomes.select("record", "country", "diagnostic")


_TERM = "(SELECT max(term) FROM ontology_terms WHERE display_term IS NOT NULL AND term_comment IS NULL)"
_SAID = E._LINKED.replace("sel AS (SELECT DISTINCT record, term FROM iso JOIN direct USING (value))", f"sel AS (SELECT DISTINCT record, term FROM iso JOIN direct USING (value) UNION SELECT record, {_TERM} FROM opened)")


@query(
    f"WITH {E._ISO}, {E._ONTO}, {E._DIRECT}, {E._OPENED}, {_SAID}, {E._RENDER} SELECT c.record, coalesce(display_terms, 'unspecified') AS display_terms, coalesce(term_paths, '') AS term_paths, CASE WHEN o.record IS NOT NULL OR h > 0 THEN 'sample' ELSE 'none' END AS evidence_level, "
    "CASE WHEN o.record IS NOT NULL THEN 'swab' ELSE '' END AS reasoning FROM cnt c LEFT JOIN rend r ON r.record = c.record LEFT JOIN opened o ON o.record = c.record"
)
def isolation_llm(spark, d):
    """Isolation sources with one more term from a deterministic stand-in for a model, where values are left open."""
    from sampleloom.operators import isolation as I
    from sampleloom.plans.model_stage import Model, Prompts, isolation_answers

    ontology = table(spark, d, "ontology_terms")
    last = ontology.filter("display_term is not null and term_comment is null").agg(F.max(F.struct("term", "display_term"))["display_term"]).first()[0]
    reply = json.dumps({"terms": [last], "reasoning": "swab", "evidence_level": "sample"})
    cands = E.iso_candidates(spark, d)
    model = Model("m-1", lambda request: reply, prompts=Prompts(isolation_user="{metadata}"))
    got = isolation_answers(I.standardize_isolation(cands, ontology), cands, model, ontology).outcomes
    return got.select("record", "display_terms", "term_paths", "evidence_level", F.array_join("reasoning", "||").alias("reasoning"))


_FULL = f"dates AS ({_STD_DATE}), hosts AS ({_STD_HOST}), places AS ({_STD_LOC}), isos AS ({_STD_ISO})"
_DIAGNOSED = (
    "SELECT 'host' AS attribute, h.record AS accession, h.taxid IS NOT NULL AS standardized, h.how AS diagnostic FROM hosts h UNION ALL SELECT 'loc', record, country IS NOT NULL, diagnostic FROM places UNION ALL SELECT 'date', accession, date_start IS NOT NULL, CASE WHEN date_start IS NULL THEN 'none' ELSE 'some' END FROM dates "
    "UNION ALL SELECT 'iso', record, true, evidence_level FROM isos"
)


def _report(spark, d):
    std = lambda n: E.QUERIES[n](spark, d)
    part = lambda df, name, key, ok, said: df.select(F.lit(name).alias("attribute"), F.col(key).alias("accession"), ok.alias("standardized"), F.array(said).alias("diagnostics"))
    dates = DQ.QUERIES["std_date"](spark, d)
    parts = (
        part(std("std_host"), "host", "record", F.col("taxid").isNotNull(), F.col("how")), part(std("std_location"), "loc", "record", F.col("country").isNotNull(), F.col("diagnostic")),
        part(dates, "date", "accession", F.col("date_start").isNotNull(), F.when(F.col("date_start").isNull(), "none").otherwise("some")), part(std("std_isolation"), "iso", "record", F.lit(True), F.col("evidence_level")),
    )
    every = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    return T.outcome_report(every.join(records(spark, d).select("accession", "pathogen"), "accession"))


_REPORT = (
    f"WITH {_FULL}, every AS ({_DIAGNOSED}), j AS (SELECT e.*, x.pathogen FROM every e JOIN {_RECORDS} x ON x.accession = e.accession), m AS (SELECT attribute, pathogen, unnest(['processed', CASE WHEN standardized THEN 'standardized' ELSE 'rejected' END, 'diagnostic:' || diagnostic]) AS metric FROM j), "
    "rep AS (SELECT attribute, pathogen, metric, count(*) AS n FROM m GROUP BY GROUPING SETS ((attribute, pathogen, metric), (attribute, metric)))"
)


@query(_REPORT + " SELECT * FROM rep")
def build_report(spark, d):
    """Counters and histogram of diagnostics of every attribute, by pathogen and in all."""
    return _report(spark, d)


@query(_REPORT + " SELECT pathogen, max(n) AS n FROM rep WHERE metric = 'processed' GROUP BY pathogen")
def processed_rows(spark, d):
    return T.processed_rows(_report(spark, d))


_MADE = "SELECT o_orderkey AS accession, 'k' || (o_orderkey % 3) AS pathogen, o_orderkey % 2 = 0 AS standardized, (['cache_hit', 'cache_resolution', 'llm_disabled', 'invalid_llm_response', 'other'])[1 + o_orderkey % 5] AS diagnostic, (['loc', 'iso', 'host'])[1 + o_orderkey % 3] AS attribute FROM orders"


def _made(spark, d):
    k = F.col("o_orderkey")
    pick = lambda xs: F.element_at(F.array(*[F.lit(x) for x in xs]), (1 + k % len(xs)).cast("int"))
    t = table(spark, d, "orders").select(k.alias("accession"), F.concat(F.lit("k"), (k % 3).cast("string")).alias("pathogen"), (k % 2 == 0).alias("standardized"), F.array(pick(("cache_hit", "cache_resolution", "llm_disabled", "invalid_llm_response", "other"))).alias("diagnostics"), pick(("loc", "iso", "host")).alias("attribute"))
    return T.outcome_report(t)


@query(f"WITH m AS ({_MADE}) SELECT attribute, count(*) FILTER (WHERE diagnostic IN ('cache_hit', 'cache_resolution')) AS n FROM m WHERE attribute IN ('loc', 'iso') GROUP BY attribute")
def cache_hit_totals(spark, d):
    """Answers that came from a cache, by target."""
    return T.cache_hits(_made(spark, d))


@query(f"WITH m AS ({_MADE}) SELECT diagnostic, CASE diagnostic WHEN 'llm_disabled' THEN 'location LLM disabled' ELSE 'invalid location LLM response' END AS warning, count(*) AS n FROM m WHERE attribute = 'loc' AND diagnostic IN ('llm_disabled', 'invalid_llm_response') GROUP BY diagnostic")
def warning_counts(spark, d):
    """Conditions that a run got over."""
    return T.recoverable_warnings(_made(spark, d))
