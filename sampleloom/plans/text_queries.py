"""Queries of the string operators over the test tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sampleloom.functions import strings as S
from sampleloom.functions.text import full_col, presentation_col
from sampleloom.plans import seeds
from sampleloom.plans.folding import NAME_FORMS, squeeze, strip
from sampleloom.session import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


_PAIRS = "SELECT l_orderkey, string_agg(coalesce(l_returnflag, '') || '-' || CAST(l_partkey AS VARCHAR), '||' ORDER BY l_linenumber, l_partkey, coalesce(l_returnflag, '')) AS joined FROM lineitem GROUP BY l_orderkey"


def _joined(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", F.concat(F.coalesce("l_returnflag", F.lit("")), F.lit("-"), F.col("l_partkey").cast("string")).alias("item")))).alias("items")
    )
    return lines.select("l_orderkey", S.pipe_join(F.transform("items", lambda x: x["item"])).alias("joined"))


@query(f"WITH j AS ({_PAIRS}) SELECT l_orderkey, len(p) AS n_items, p[1] AS first_item, p[len(p)] AS last_item FROM (SELECT l_orderkey, string_split(joined, '||') AS p FROM j)")
def pipe_split(spark, d):
    parts = S.pipe_split(F.col("joined"))
    return _joined(spark, d).select("l_orderkey", F.size(parts).cast("long").alias("n_items"), parts[0].alias("first_item"), F.element_at(parts, -1).alias("last_item"))


@query("SELECT DISTINCT attr_name, replace(replace(lower(attr_name), ' ', '_'), '-', '_') AS norm FROM curation_decisions WHERE attr_name IS NOT NULL")
def norm_keyword(spark, d):
    return table(spark, d, "curation_decisions").filter("attr_name is not null").select("attr_name", S.norm_keyword(F.col("attr_name")).alias("norm")).distinct()


@query("SELECT DISTINCT attr_value, " + squeeze("regexp_replace(replace(replace(lower(attr_value), '_', ' '), '-', ' '), '[[:punct:]]', '', 'g')") + " AS norm FROM curation_decisions WHERE attr_value IS NOT NULL")
def norm_host(spark, d):
    rows = table(spark, d, "curation_decisions").filter("attr_value is not null")
    return rows.select("attr_value", S.norm_host(F.col("attr_value")).alias("norm")).distinct()


@query("SELECT term, array_to_string(list_filter(list_transform(string_split(coalesce(synonyms, ''), ';'), lambda x: trim(x)), lambda x: x <> '' AND lower(x) <> 'nan'), '|') AS items FROM ontology_terms")
def semi_split(spark, d):
    return table(spark, d, "ontology_terms").select("term", F.array_join(S.semi_split(F.col("synonyms")), "|").alias("items"))


@query(
    "SELECT p_partkey, array_to_string(list_sort(list_distinct(list_concat(w, list_filter(list_transform(w, lambda x: regexp_replace(x, '^[0-9]+|[0-9]+$', '', 'g')), lambda x: x <> '')))), ' ') AS words "
    "FROM (SELECT p_partkey, string_split(lower(p_name) || ' ' || lower(replace(p_brand, '#', '')) || ' 9' || lower(p_name), ' ') AS w FROM part)"
)
def digit_strip(spark, d):
    name, brand = F.lower("p_name"), F.lower(F.replace(F.col("p_brand"), F.lit("#"), F.lit("")))
    words = F.split(F.concat(name, F.lit(" "), brand, F.lit(" 9"), name), " ")
    return table(spark, d, "part").select("p_partkey", F.array_join(F.array_sort(S.digit_variants(words)), " ").alias("words"))


@query("SELECT DISTINCT site_label, CASE WHEN contains(site_label, ':') THEN trim(split_part(site_label, ':', 1)) ELSE site_label END AS country_part, CASE WHEN contains(site_label, ':') THEN nullif(trim(substr(site_label, instr(site_label, ':') + 1)), '') END AS sublocation FROM collection_sites")
def subloc_split(spark, d):
    return table(spark, d, "collection_sites").select("site_label", S.split_place(F.col("site_label")).alias("p")).select("site_label", "p.*").distinct()


@query(
    "SELECT accession, 'Metadata:' || chr(10) || string_agg(a || ' = ' || v, chr(10) ORDER BY i, a, v) || CASE WHEN max(i) % 2 = 0 THEN chr(10) || 'host = ' || accession ELSE '' END AS block "
    "FROM (SELECT DISTINCT origin_id AS i, accession, attr_name AS a, attr_value AS v FROM date_origins WHERE accession IS NOT NULL AND attr_name IS NOT NULL AND attr_value IS NOT NULL) GROUP BY accession"
)
def render_block(spark, d):
    rows = table(spark, d, "date_origins").filter("accession is not null and attr_name is not null and attr_value is not null")
    g = rows.groupBy("accession").agg(F.array_sort(F.collect_set(F.struct("origin_id", "attr_name", "attr_value"))).alias("c"))
    host = F.when(F.element_at("c", -1)["origin_id"] % 2 == 0, F.col("accession"))
    return g.select("accession", S.render_block(F.col("c.attr_name"), F.col("c.attr_value"), host).alias("block"))


_BLOCK = "|".join(S.BLOCK_TAGS)


@query(
    "SELECT project_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(replace(replace(replace(replace(replace(coalesce(description, ''), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&'), "
    f"'(?s)<!--.*?-->', '', 'g'), '(?i)</?(?:{_BLOCK})(?:\\s[^<>]*)?/?>', ' ', 'g'), '</?[A-Za-z][^<>]*>', '', 'g'), '\\s+', ' ', 'g')) AS readable FROM bio_projects"
)
def html_text(spark, d):
    return table(spark, d, "bio_projects").select("project_id", S.html_text(F.col("description")).alias("readable"))


@query("SELECT DISTINCT decision_id, array_to_string(regexp_extract_all(upper(attr_value), '\\b([A-Z]+:[0-9]+)\\b', 1), '|') AS ids FROM curation_decisions WHERE regexp_matches(upper(attr_value), '\\b[A-Z]+:[0-9]+\\b')")
def id_extract(spark, d):
    ids = S.extract_ids(F.col("attr_value"))
    return table(spark, d, "curation_decisions").select("decision_id", ids.alias("found")).filter(F.size("found") > 0).select("decision_id", F.array_join("found", "|").alias("ids")).distinct()


@query("SELECT term, n AS depth, array_to_string(string_split(term, ':')[1:n], ':') AS prefix FROM (SELECT term, unnest(range(1, len(string_split(term, ':')) + 1)) AS n FROM ontology_terms)")
def path_prefixes(spark, d):
    return table(spark, d, "ontology_terms").select("term", F.posexplode(S.path_prefixes(F.col("term"))).alias("p", "prefix")).select("term", (F.col("p") + 1).cast("long").alias("depth"), "prefix")


TRIGGERS = ("consumable", "organism:body matter", "outdoor:open")


@query("SELECT term, (" + " OR ".join(f"term = '{t}' OR starts_with(term, '{t}:')" for t in TRIGGERS) + ") AS retry FROM ontology_terms")
def retry_trigger(spark, d):
    return table(spark, d, "ontology_terms").select("term", S.under_any(F.col("term"), TRIGGERS).alias("retry"))


@query("SELECT term, coalesce(nullif(trim(display_term), ''), string_split(term, ':')[-1]) AS shown FROM ontology_terms")
def display_term(spark, d):
    return table(spark, d, "ontology_terms").select("term", S.shown_term(F.col("display_term"), F.col("term")).alias("shown"))


@query(f"WITH {NAME_FORMS} SELECT v AS attr_name, shown AS presentation, form AS full_form FROM nf")
def norm_attr(spark, d):
    """All names in both forms."""
    rows = table(spark, d, "curation_decisions").filter("attr_name is not null").select("attr_name").distinct()
    return rows.select("attr_name", presentation_col(F.col("attr_name")).alias("presentation"), full_col(F.col("attr_name")).alias("full_form"))


def _strip_sql(col: str) -> str:
    for s in seeds.IGNORED_SUBSTRINGS:
        col = f"regexp_replace({col}, '(?i){s.replace('(', chr(92) + '(').replace(')', chr(92) + ')').replace('.', chr(92) + '.')}', '', 'g')"
    return col


@query(f"SELECT DISTINCT attr_value, {_strip_sql('attr_value')} AS stripped FROM curation_decisions WHERE attr_value IS NOT NULL")
def strip_substrings(spark, d):
    rows = table(spark, d, "curation_decisions").filter("attr_value is not null")
    return rows.select("attr_value", S.strip_substrings(F.col("attr_value"), seeds.IGNORED_SUBSTRINGS).alias("stripped")).distinct()


@query(
    "WITH t AS (SELECT project_id, coalesce(relevance, []) AS r FROM bio_projects) SELECT project_id, array_to_string(list_filter(['Agricultural', 'Environmental', 'Veterinary'], lambda x: list_contains(r, x)), '|') AS flags FROM t"
)
def relevance_flags(spark, d):
    from sampleloom.sources.projects import relevance_flags as flags

    r = F.coalesce("relevance", S.none_of())
    rows = table(spark, d, "bio_projects").select("project_id", *[F.when(F.array_contains(r, n), " Yes ").otherwise("no").alias(n) for n in ("Agricultural", "Environmental", "Veterinary")])
    return rows.select("project_id", F.array_join(flags({n: F.col(n) for n in ("Agricultural", "Environmental", "Veterinary")}), "|").alias("flags"))


@query(
    "SELECT decision_id, nullif(" + strip("attr_value") + ", '') AS of_scalar, list_filter(list_transform([xml_source, ' ', attr_value, attr_name], lambda x: " + strip("x") + "), lambda x: x <> '')[1] AS of_list FROM (SELECT DISTINCT decision_id, attr_name, attr_value, xml_source FROM curation_decisions)"
)
def first_text(spark, d):
    """The first text that is not blank of a scalar and of a list."""
    t = table(spark, d, "curation_decisions").select("decision_id", "attr_name", "attr_value", "xml_source").distinct()
    return t.select("decision_id", S.first_text(F.col("attr_value")).alias("of_scalar"), S.first_text(F.array("xml_source", F.lit(" "), "attr_value", "attr_name"), True).alias("of_list"))
