"""Assembly of the final table from the outcomes of the standardisers, and its reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sampleloom.functions import strings as S
from sampleloom.operators.ranking import dimension

# Columns of the final table by attribute, in their order.
BASE_COLUMNS = ("accession", "pathogen", "in_ATB", "bioproject")
COLUMNS = {
    "date": ("date_attr_orig", "date_val_orig", "date_start", "date_end", "date_score"),
    "loc": ("loc_attr_orig", "loc_val_orig", "loc_un_region", "loc_country", "loc_sublocation"),
    "iso": ("iso_attr_orig", "iso_val_orig", "iso_term_paths", "iso_display_terms", "iso_ontology_links"),
    "host": ("host_attr_orig", "host_val_orig", "host_taxid", "host_scientific_name", "host_common_names", "host_lineage_names", "host_lineage_taxids", "host_score", "host_low_conf"),
}
RETRY_TRIGGERS = ("host-associated", "food:animal product", "food:plant")


def host_context(scientific: Column, raw_values: Column) -> Column:
    """Standard host name, else the trimmed raw values."""
    return F.coalesce(F.nullif(F.trim(scientific), F.lit("")), F.trim(raw_values), F.lit(""))


def retry_eligible(taxid: Column, term_paths: Column, has_sample: Column, triggers: Sequence[str] = RETRY_TRIGGERS) -> Column:
    """True if no host is known, some path is under a trigger and there are sample values to read again."""
    return taxid.isNull() & has_sample & F.exists(S.pipe_split(term_paths), lambda p: S.under_any(p, triggers))


def accepted(*outcomes: Column) -> Column:
    """True if any outcome is there; an unspecified isolation source counts."""
    out = F.lit(False)
    for c in outcomes:
        out = out | c.isNotNull()
    return out


def select_groups(rows: DataFrame, groups: Sequence[str], key: str = "accession", group: str = "pathogen") -> DataFrame:
    """Rows of the selected groups; a row without key or group fails, wherever it belongs."""
    blank = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) == ""
    fail = lambda m: F.raise_error(F.lit(m)).cast("boolean")
    ok = F.when(blank(key), fail("a record has no accession")).when(blank(group), fail("a record has no pathogen")).otherwise(F.trim(group).isin(*groups))
    return rows.filter(ok)


def count_groups(rows: DataFrame, selection: DataFrame, group: str = "pathogen") -> DataFrame:
    """Rows of each selected group; groups without rows have zero."""
    n = rows.groupBy(group).agg(F.count("*").alias("n"))
    return selection.select(group).distinct().join(n, group, "left").select(group, F.coalesce("n", F.lit(0)).alias("n"))


def final_columns(attributes: Sequence[str]) -> list[str]:
    return [*BASE_COLUMNS, *(c for a in ("date", "loc", "iso", "host") if a in attributes for c in COLUMNS[a])]


def project_final(rows: DataFrame, attributes: Sequence[str], registry: DataFrame, members: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The final table: scientific names for keys, catalog membership, blanks for missing outcomes, ``NA`` sublocations.

    ``keep`` names further columns, such as the place of a record in its source, that stay behind the others.
    """
    if unknown := sorted(set(attributes) - COLUMNS.keys()):
        raise ValueError(f"unknown attributes: {', '.join(unknown)}")
    names = dimension(registry.select(F.col("key").alias("pathogen"), F.col("scientific_name").alias("__sci")))
    member = members.select("pathogen", "accession", F.lit(True).alias("__in")).distinct()
    j = rows.join(names, "pathogen", "left").join(member, ["pathogen", "accession"], "left")
    out = [F.col("accession"), F.coalesce("__sci", F.lit("")).alias("pathogen"), F.coalesce("__in", F.lit(False)).alias("in_ATB"), F.coalesce("bioproject_accession", F.lit("")).alias("bioproject")]
    for c in final_columns(attributes)[len(BASE_COLUMNS) :]:
        text = F.col(c).cast("string")
        if c == "loc_sublocation":
            text = F.when(F.col("loc_country").isNotNull(), F.coalesce(F.nullif(text, F.lit("")), F.lit("NA")))
        out.append(F.coalesce(text, F.lit("")).alias(c))
    return j.select(*out, *keep)


def report(rows: DataFrame, selection: DataFrame, flags: dict[str, Column], group: str = "pathogen") -> DataFrame:
    """Long report ``(group, metric, n)``: counts of each flag by group and in all (group null); absent groups have zeros."""
    known = rows.groupBy(group).agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in flags.items()], F.count("*").alias("processed"))
    full = selection.select(group).distinct().join(known, group, "left")
    names = [*flags, "processed"]
    long = full.select(group, F.explode(F.array(*[F.struct(F.lit(k).alias("metric"), F.coalesce(F.col(k), F.lit(0)).alias("n")) for k in names])).alias("m")).select(group, "m.*")
    return long.groupingSets([[group, "metric"], ["metric"]], group, "metric").agg(F.sum("n").alias("n"))


# Diagnostics of earlier answers, and of conditions that a run gets over, with what is said of them.
CACHE_HITS = ("cache_resolution", "cache_hit")
RECOVERABLE = {
    "llm_disabled": "location LLM disabled", "recoverable_llm_failure": "recoverable location LLM failure", "recoverable_coordinate_failure": "recoverable coordinate resolution failure",
    "invalid_llm_response": "invalid location LLM response",
}


def outcome_report(outcomes: DataFrame) -> DataFrame:
    """``(attribute, pathogen, metric, n)`` of ``outcomes (attribute, accession, pathogen, standardized, diagnostics)``.

    Metrics are ``processed``, ``standardized``, ``rejected`` and ``diagnostic:<name>``, by pathogen and in all (null pathogen).
    """
    said = F.transform(F.coalesce("diagnostics", S.none_of()), lambda x: F.concat(F.lit("diagnostic:"), x))
    done = F.when(F.col("standardized"), "standardized").otherwise("rejected")
    e = outcomes.select("attribute", "pathogen", F.explode(F.concat(F.array(F.lit("processed"), done), said)).alias("metric"))
    return e.groupingSets([["attribute", "pathogen", "metric"], ["attribute", "metric"]], "attribute", "pathogen", "metric").agg(F.count("*").alias("n"))


def processed_rows(report_rows: DataFrame) -> DataFrame:
    """``(pathogen, n)``: the most rows that any attribute has processed."""
    return report_rows.filter("metric = 'processed'").groupBy("pathogen").agg(F.max("n").alias("n"))


def cache_hits(report_rows: DataFrame) -> DataFrame:
    """``(attribute, n)`` of answers that came from a cache, over all pathogens; attributes without any have zero."""
    hit = F.col("metric").isin(*[f"diagnostic:{d}" for d in CACHE_HITS])
    return report_rows.filter("pathogen is null and attribute in ('loc', 'iso')").groupBy("attribute").agg(F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias("n"))


def recoverable_warnings(report_rows: DataFrame) -> DataFrame:
    """``(diagnostic, warning, n)`` of location conditions that a run got over."""
    said = F.create_map(*[F.lit(x) for kv in RECOVERABLE.items() for x in kv])
    d = F.regexp_replace("metric", "^diagnostic:", "")
    return report_rows.filter("pathogen is null and attribute = 'loc'").select(d.alias("diagnostic"), F.try_element_at(said, d).alias("warning"), "n").filter("warning is not null")


def histogram(rows: DataFrame, diagnostics: str, group: str = "pathogen") -> DataFrame:
    """``(group, diagnostic, n)`` by group and in all."""
    e = rows.select(group, F.explode(diagnostics).alias("diagnostic"))
    return e.groupingSets([[group, "diagnostic"], ["diagnostic"]], group, "diagnostic").agg(F.count("*").alias("n"))


def reasoning_line(columns: dict[str, Column]) -> Column:
    """JSON text of one accepted isolation record."""
    return F.to_json(F.struct(*[c.alias(k) for k, c in columns.items()]), {"ignoreNullFields": "false"})
