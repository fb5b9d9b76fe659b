"""Queries of the date operators over ``date_origins``, with their SQL.

The SQL reads the same texts with other means (date casts and ``strptime``), not with the engine's patterns.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sampleloom.functions import dates as D
from sampleloom.operators.date_records import reduce_dates
from sampleloom.session import spread, table

REFERENCE = dt.date(2025, 6, 30)
QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


_MON = "(?i:january|february|march|april|may|june|july|august|september|october|november|december|jan|feb|mar|apr|jun|jul|aug|sept|sep|oct|nov|dec)"
_REF = f"DATE '{REFERENCE}'"


def _single(name: str, source: str) -> str:
    """CTEs that read column ``v`` of ``source`` as one date: ``name (v, fmt, s, e, sc, st, reason, cut)``."""
    fmt = (
        "CASE WHEN regexp_full_match({0}, '[0-9]{{4}}') THEN 'year' WHEN regexp_full_match({0}, '[0-9]{{4}}[-/][0-9]{{2}}') THEN 'year_month' WHEN regexp_full_match({0}, '[0-9]{{2}}[-/][0-9]{{4}}') THEN 'month_year' "
        f"WHEN regexp_full_match({{0}}, '{_MON}[ -][0-9]{{{{4}}}}') THEN 'named_month_year' WHEN regexp_full_match({{0}}, '[0-9]{{{{4}}}}-[0-9]{{{{2}}}}-[0-9]{{{{2}}}}|[0-9]{{{{4}}}}/[0-9]{{{{2}}}}/[0-9]{{{{2}}}}') THEN 'year_first_day' "
        f"WHEN regexp_full_match({{0}}, '{_MON} [0-9]{{{{1,2}}}},\\s*[0-9]{{{{4}}}}') THEN 'named_month_day' WHEN regexp_full_match({{0}}, '[0-9]{{{{1,2}}}}-{_MON}-[0-9]{{{{4}}}}') THEN 'day_named_month' "
        "WHEN regexp_full_match({0}, '[0-9]{{1,2}}-[0-9]{{1,2}}-[0-9]{{4}}|[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}}') THEN 'numeric_year_last_day' END"
    )
    hour, zone = "(?:[01][0-9]|2[0-3])", "(?:Z|[+-](?:[01][0-9]|2[0-3]):?[0-5][0-9])?"
    time = f"(?:{hour}:[0-5][0-9](?::[0-5][0-9](?:\\.[0-9]+)?)?|{hour}\\.[0-5][0-9]\\.[0-5][0-9](?:\\.[0-9]+)?){zone}"
    mdy = "try_strptime({0} || '-' || left({1}, 3) || '-' || right(t, 4), '%d-%b-%Y')::DATE"
    word = "regexp_extract(t, '([A-Za-z]+)', 1)"
    return f"""
    {name}_a AS (SELECT DISTINCT v, trim(regexp_replace(v, '^\\s+|\\s+$', '', 'g')) AS w FROM {source}),
    {name}_b AS (SELECT v, w, {fmt.format('w')} AS own, split_part(w, 'T', 1) AS base, CASE WHEN contains(w, 'T') THEN substr(w, instr(w, 'T') + 1) END AS suf FROM {name}_a),
    {name}_c AS (SELECT v, own, w, base, suf, CASE WHEN own IS NULL AND suf IS NOT NULL AND NOT contains(suf, '/') AND NOT regexp_matches(suf, '(?:^|\\s)(?i:to|-)(?:\\s|$)') THEN {fmt.format('base')} END AS fb FROM {name}_b),
    {name}_d AS (SELECT v, coalesce(own, fb) AS fmt, CASE WHEN fb IS NOT NULL THEN base ELSE w END AS t, (fb IS NOT NULL AND NOT regexp_full_match(suf, '{time}')) AS cut FROM {name}_c),
    {name}_e AS (SELECT v, fmt, t, cut, CASE fmt
        WHEN 'year' THEN try_cast(t || '-01-01' AS DATE)
        WHEN 'year_month' THEN try_cast(replace(t, '/', '-') || '-01' AS DATE)
        WHEN 'month_year' THEN try_cast(right(t, 4) || '-' || left(t, 2) || '-01' AS DATE)
        WHEN 'named_month_year' THEN {mdy.format("'01'", word)}
        WHEN 'year_first_day' THEN try_cast(replace(t, '/', '-') AS DATE)
        WHEN 'named_month_day' THEN {mdy.format("regexp_extract(t, ' ([0-9]{1,2}),', 1)", word)}
        WHEN 'day_named_month' THEN {mdy.format("regexp_extract(t, '^([0-9]{1,2})', 1)", word)}
        WHEN 'numeric_year_last_day' THEN try_strptime(replace(t, '/', '-'), '%d-%m-%Y')::DATE END AS d1,
        CASE WHEN fmt = 'numeric_year_last_day' THEN try_strptime(replace(t, '/', '-'), '%m-%d-%Y')::DATE END AS d2 FROM {name}_d),
    {name}_f AS (SELECT v, fmt, cut, d1, d2, CASE WHEN year(coalesce(d1, d2)) >= 1 THEN coalesce(d1, d2) END AS s FROM {name}_e),
    {name}_g AS (SELECT v, fmt, cut, s, CASE WHEN fmt = 'year' THEN (s + INTERVAL 1 YEAR - INTERVAL 1 DAY)::DATE WHEN fmt IN ('year_month', 'month_year', 'named_month_year') THEN last_day(s) ELSE s END AS e,
        CASE WHEN fmt = 'year' THEN 0.8 WHEN fmt IN ('year_month', 'month_year', 'named_month_year') THEN 0.9 WHEN d1 IS NOT NULL AND d2 IS NOT NULL AND d1 <> d2 THEN 0.7 ELSE 1.0 END AS sc FROM {name}_f),
    {name} AS (SELECT v, fmt, cut, s, e, CAST(sc AS DOUBLE) AS sc, CASE WHEN fmt IS NULL THEN 'unsupported_format' WHEN s IS NULL THEN 'invalid_calendar_date' WHEN year(e) < 1800 THEN 'before_supported_year' WHEN s > {_REF} THEN 'after_metadata_reference_date' END AS reason FROM {name}_g)"""


_WIDTH = "CASE WHEN {1} <= ({0} + INTERVAL 1 YEAR)::DATE THEN 0.6 WHEN {1} <= ({0} + INTERVAL 3 YEAR)::DATE THEN 0.5 WHEN {1} <= ({0} + INTERVAL 6 YEAR)::DATE THEN 0.4 WHEN {1} <= ({0} + INTERVAL 10 YEAR)::DATE THEN 0.3 ELSE 0.2 END"
_VALUES = "vals AS (SELECT DISTINCT attr_value AS v FROM date_origins WHERE attr_value IS NOT NULL)"


def _interpret() -> str:
    """CTEs that read ``vals (v)`` as dates or intervals: ``got (v, s, e, sc, reason, ctx, fid, notices)``."""
    join = "\\s+(?i:to|-)\\s+"
    return f"""WITH {_VALUES},
    trimmed AS (SELECT v, trim(regexp_replace(v, '^\\s+|\\s+$', '', 'g')) AS w FROM vals),
    kinds AS (SELECT v, w, len(regexp_split_to_array(w, '{join}')) - 1 AS joins, regexp_full_match(w, '[0-9]{{4}}-[0-9]{{2}}') AND right(w, 2) >= '13' AND left(w, 2) || right(w, 2) >= left(w, 4) AS abbr,
        regexp_matches(w, '(?:^|\\s)(?i:to|-)(?:\\s|$)') AS claim FROM trimmed),
    ends AS (
        SELECT v, 0 AS i, left(w, 4) AS a, left(w, 2) || right(w, 2) AS b FROM kinds WHERE abbr
        UNION ALL SELECT v, 0, regexp_split_to_array(w, '{join}')[1], regexp_split_to_array(w, '{join}')[2] FROM kinds WHERE NOT abbr AND joins = 1
        UNION ALL SELECT v, i, substr(w, 1, i - 1), substr(w, i + 1) FROM (SELECT v, w, unnest(range(1, length(w) + 1)) AS i FROM kinds WHERE NOT abbr AND joins = 0 AND NOT claim) WHERE substr(w, i, 1) = '/'),
    pool AS (SELECT w AS v FROM trimmed UNION SELECT a FROM ends UNION SELECT b FROM ends),
    {_single('one', 'pool')},
    pairs AS (SELECT x.v, x.i, a.s AS as_, a.e AS ae, a.sc AS asc_, a.reason AS ar, a.cut AS acut, b.s AS bs, b.e AS be, b.sc AS bsc, b.reason AS br, b.cut AS bcut FROM ends x JOIN one a ON a.v = x.a JOIN one b ON b.v = x.b),
    counted AS (SELECT v, count_if(ar IS NULL AND br IS NULL) AS usable, count_if(coalesce(ar, '') <> 'unsupported_format' AND coalesce(br, '') <> 'unsupported_format') AS known, bool_or(coalesce(ar, '') <> 'unsupported_format' OR coalesce(br, '') <> 'unsupported_format') AS claimed FROM pairs GROUP BY v),
    choice AS (SELECT p.* FROM pairs p JOIN counted c USING (v) JOIN kinds k USING (v) WHERE k.abbr OR k.joins = 1 OR (c.usable = 1 AND ar IS NULL AND br IS NULL) OR (c.usable = 0 AND c.known = 1 AND coalesce(ar, '') <> 'unsupported_format' AND coalesce(br, '') <> 'unsupported_format')),
    joined AS (SELECT v, CASE WHEN ar IS NULL AND br IS NULL THEN least(as_, bs) END AS s, CASE WHEN ar IS NULL AND br IS NULL THEN greatest(ae, be) END AS e, CASE WHEN as_ = bs AND ae = be THEN least(asc_, bsc) ELSE {_WIDTH.format('least(as_, bs)', 'greatest(ae, be)')} END AS sc,
        coalesce(ar, br) AS reason, CASE WHEN ar IS NOT NULL THEN 'start' WHEN br IS NOT NULL THEN 'end' END AS ctx, CAST(acut AS INTEGER) + CAST(bcut AS INTEGER) + CAST(as_ > be AS INTEGER) AS notices FROM choice),
    got AS (SELECT k.v, CASE WHEN w.reason IS NULL THEN w.s ELSE j.s END AS s, CASE WHEN w.reason IS NULL THEN w.e ELSE j.e END AS e, CAST(CASE WHEN w.reason IS NULL THEN w.sc WHEN j.s IS NOT NULL THEN j.sc END AS DOUBLE) AS sc,
        CASE WHEN w.reason IS NULL THEN NULL WHEN j.v IS NOT NULL THEN j.reason WHEN k.joins > 1 OR k.claim THEN 'invalid_interval_structure' WHEN c.usable > 1 OR (c.usable = 0 AND c.known > 1) THEN 'invalid_interval_structure'
             WHEN w.reason <> 'unsupported_format' THEN w.reason WHEN c.claimed THEN 'invalid_interval_structure' ELSE w.reason END AS reason,
        CASE WHEN w.reason IS NOT NULL THEN j.ctx END AS ctx, CASE WHEN w.reason IS NULL THEN w.fmt WHEN j.s IS NOT NULL THEN CASE WHEN k.abbr THEN 'abbreviated_year_interval' ELSE 'explicit_interval' END END AS fid,
        CASE WHEN w.reason IS NULL THEN CAST(w.cut AS INTEGER) WHEN j.s IS NOT NULL THEN j.notices ELSE 0 END AS notices
        FROM kinds k JOIN one w ON w.v = k.w LEFT JOIN joined j ON j.v = k.v LEFT JOIN counted c ON c.v = k.v)"""


def _values(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "date_origins").filter("attr_value is not null").select("attr_value").distinct()


def _parsed(spark: SparkSession, d: str) -> DataFrame:
    return _values(spark, d).select("attr_value", D.interpret_single(F.col("attr_value"), REFERENCE).alias("r"))


_ONE = f"WITH {_VALUES}, {_single('one', 'vals')} "


@query(_ONE + "SELECT v AS attr_value, fmt AS format_id, s AS date_start, e AS date_end, sc AS score FROM one WHERE reason IS NULL")
def date_formats(spark, d):
    return _parsed(spark, d).filter("r.status = 'ok'").select("attr_value", "r.format_id", F.col("r.start").alias("date_start"), F.col("r.end").alias("date_end"), "r.score")


@query(_ONE + "SELECT v AS attr_value, s AS day, sc AS score FROM one WHERE fmt = 'numeric_year_last_day' AND reason IS NULL")
def date_ambiguous(spark, d):
    return _parsed(spark, d).filter("r.format_id = 'numeric_year_last_day'").select("attr_value", F.col("r.start").alias("day"), "r.score")


@query(_ONE + "SELECT v AS attr_value, s AS day, cut AS malformed FROM one WHERE reason IS NULL AND contains(v, 'T')")
def date_time_suffix(spark, d):
    return _parsed(spark, d).filter((F.col("r.status") == "ok") & F.col("attr_value").contains("T")).select("attr_value", F.col("r.start").alias("day"), (F.size("r.notices") > 0).alias("malformed"))


@query(_ONE + "SELECT reason, count(*) AS n FROM one WHERE reason IS NOT NULL GROUP BY reason")
def date_limits(spark, d):
    return _parsed(spark, d).filter("r.reason is not null").groupBy(F.col("r.reason").alias("reason")).agg(F.count("*").alias("n"))


@query(
    "SELECT o_orderkey, CAST(CASE WHEN e <= (s + INTERVAL 1 YEAR)::DATE THEN 0.6 WHEN e <= (s + INTERVAL 3 YEAR)::DATE THEN 0.5 WHEN e <= (s + INTERVAL 6 YEAR)::DATE THEN 0.4 WHEN e <= (s + INTERVAL 10 YEAR)::DATE THEN 0.3 ELSE 0.2 END AS DOUBLE) AS score "
    "FROM (SELECT o_orderkey, o_orderdate::DATE AS s, (o_orderdate::DATE + CAST(o_orderkey * 37 % 5000 AS INTEGER)) AS e FROM orders)"
)
def width_score(spark, d):
    s = F.col("o_orderdate").cast("date")
    return table(spark, d, "orders").select("o_orderkey", D.width_score(s, F.date_add(s, (F.col("o_orderkey") * 37 % 5000).cast("int"))).alias("score"))


@query(_interpret() + " SELECT v AS attr_value, s AS date_start, e AS date_end, sc AS score, fid AS format_id, reason, ctx AS context, CAST(notices AS BIGINT) AS n_notices FROM got")
def date_intervals(spark, d):
    r = D.interpret(F.col("attr_value"), REFERENCE)
    return _values(spark, d).select("attr_value", r.alias("r")).select("attr_value", F.col("r.start").alias("date_start"), F.col("r.end").alias("date_end"), "r.score", "r.format_id", "r.reason", "r.context", F.size("r.notices").cast("long").alias("n_notices"))


_CANDS = (
    _interpret()
    + """, cands AS (SELECT accession, min(origin_id) AS pos, attr_name AS a, attr_value AS v, category AS c FROM date_origins WHERE accession IS NOT NULL AND trim(accession) <> '' AND attr_value IS NOT NULL AND attr_name IS NOT NULL GROUP BY ALL),
    usable AS (SELECT x.*, g.s, g.e, g.sc, g.reason FROM cands x JOIN got g ON g.v = x.v),
    samp AS (SELECT accession, min(s) AS s, max(e) AS e, count(DISTINCT (s, e)) AS n, min(sc) AS sc, min_by((a, v), pos) AS first_, string_agg(a, '||' ORDER BY pos) AS aa, string_agg(v, '||' ORDER BY pos) AS vv FROM (SELECT accession, a, v, min(pos) AS pos, any_value(s) AS s, any_value(e) AS e, any_value(sc) AS sc FROM usable WHERE reason IS NULL AND c = 's' GROUP BY accession, a, v) GROUP BY accession),
    fall AS (SELECT accession, arg_min(s, (s, pos)) AS s, arg_min(e, (s, pos)) AS e, arg_min(a, (s, pos)) AS a, arg_min(v, (s, pos)) AS v FROM usable WHERE reason IS NULL AND c = 'o' GROUP BY accession),
    ids AS (SELECT DISTINCT accession FROM cands)"""
)
_SAMPLED = f"CASE WHEN n > 1 THEN {_WIDTH.format('samp.s', 'samp.e')} ELSE samp.sc END"


def date_candidates(spark: SparkSession, d: str) -> DataFrame:
    """``(accession, pos, attribute, value, category)``; copies of a candidate are one."""
    rows = table(spark, d, "date_origins").filter("accession is not null and trim(accession) <> '' and attr_value is not null and attr_name is not null")
    return spread(rows, "accession", "attr_value").groupBy("accession", F.col("attr_name").alias("attribute"), F.col("attr_value").alias("value"), "category").agg(F.min("origin_id").alias("pos"))


def date_records(spark: SparkSession, d: str) -> DataFrame:
    """``(accession, candidates)`` in reading order, for records that are held in one row."""
    cands = F.array_sort(F.collect_list(F.struct("pos", "attribute", "value", "category")))
    return date_candidates(spark, d).groupBy("accession").agg(cands.alias("c")).select("accession", F.transform("c", lambda c: F.struct(c["attribute"], c["value"], c["category"])).alias("candidates"))


def _outcomes(spark: SparkSession, d: str) -> DataFrame:
    return date_records(spark, d).select("accession", D.standardize_dates(F.col("candidates"), REFERENCE).alias("o")).select("accession", "o.*")


@query(_CANDS + f" SELECT accession, s AS date_start, e AS date_end, CAST({_SAMPLED} AS DOUBLE) AS score, n AS n_bounds FROM samp")
def date_reduce(spark, d):
    cand = date_records(spark, d).select("accession", "candidates", D.standardize_dates(F.col("candidates"), REFERENCE).alias("o")).filter(F.array_contains("o.diagnostics", "sampling_selection"))
    usable = F.filter(F.transform(F.filter("candidates", lambda c: c["category"] == "s"), lambda c: D.interpret(c["value"], REFERENCE)), lambda r: r["status"] == "ok")
    n = F.size(F.array_distinct(F.transform(usable, lambda r: F.struct(r["start"], r["end"])))).cast("long")
    return cand.select("accession", F.col("o.start").alias("date_start"), F.col("o.end").alias("date_end"), "o.score", n.alias("n_bounds"))


@query(_CANDS + " SELECT accession, s AS date_start, e AS date_end, a AS attribute, v AS attr_value, CAST(0.1 AS DOUBLE) AS score FROM fall WHERE accession NOT IN (SELECT accession FROM samp)")
def date_fallback(spark, d):
    o = F.col("origins")[0]
    return _outcomes(spark, d).filter(F.array_contains("diagnostics", "fallback_selection")).select("accession", F.col("start").alias("date_start"), F.col("end").alias("date_end"), o["attribute"].alias("attribute"), o["value"].alias("attr_value"), "score")


@query(_CANDS + " SELECT accession, CASE WHEN samp.s IS NOT NULL THEN 'sampling' WHEN fall.s IS NOT NULL THEN 'fallback' ELSE 'none' END AS picked FROM ids LEFT JOIN samp USING (accession) LEFT JOIN fall USING (accession)")
def date_pick(spark, d):
    has = lambda x: F.array_contains("diagnostics", x)
    return _outcomes(spark, d).select("accession", F.when(has("sampling_selection"), "sampling").when(has("fallback_selection"), "fallback").otherwise("none").alias("picked"))


@query(_CANDS + " SELECT reason, count(*) AS n FROM usable WHERE reason IS NOT NULL GROUP BY reason")
def date_record(spark, d):
    """Rejections of all candidates of all records, by reason."""
    return _outcomes(spark, d).select(F.explode("rejections").alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


@query(
    _CANDS
    + f""" SELECT accession, coalesce(samp.s, fall.s) AS date_start, coalesce(samp.e, fall.e) AS date_end, CAST(CASE WHEN samp.s IS NOT NULL THEN {_SAMPLED} WHEN fall.s IS NOT NULL THEN 0.1 END AS DOUBLE) AS date_score,
    CASE WHEN samp.n > 1 THEN samp.aa WHEN samp.s IS NOT NULL THEN samp.first_[1] ELSE coalesce(fall.a, '') END AS date_attr_orig, CASE WHEN samp.n > 1 THEN samp.vv WHEN samp.s IS NOT NULL THEN samp.first_[2] ELSE coalesce(fall.v, '') END AS date_val_orig
    FROM ids LEFT JOIN samp USING (accession) LEFT JOIN fall USING (accession)"""
)
def std_date(spark, d):
    """Standardised collection date of every record."""
    rows = date_candidates(spark, d).withColumnRenamed("accession", "record")
    o = reduce_dates(rows, REFERENCE)
    return o.select(F.col("record").alias("accession"), F.col("start").alias("date_start"), F.col("end").alias("date_end"), F.col("score").alias("date_score"), F.col("attributes").alias("date_attr_orig"), F.col("values").alias("date_val_orig"))
