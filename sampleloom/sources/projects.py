"""Project catalog: resolution of linked ids, relevance, JSON lines and their validation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sampleloom.functions.strings import html_text, none_of
from sampleloom.operators.ranking import top_examples

# Relevance flags in their order and the texts that affirm one.
RELEVANCE = ("Agricultural", "Environmental", "Veterinary")
AFFIRMATIVE = ("1", "true", "yes")
FIELDS = ("accession", "description", "id", "relevance", "title")


def relevance_flags(texts: Mapping[str, Column]) -> Column:
    """Names of :data:`RELEVANCE` whose text affirms them, in their order."""
    said = F.array(*[F.when(F.lower(F.trim(texts[n])).isin(*AFFIRMATIVE), n) for n in RELEVANCE if n in texts])
    return F.filter(said, lambda x: x.isNotNull())


def resolve_contexts(projects: DataFrame, wanted: DataFrame) -> DataFrame:
    """Contexts of the projects whose id is in ``wanted (id)``; markup of titles and descriptions becomes text."""
    near = projects.join(wanted.select("id").distinct(), "id", "left_semi")
    return near.select(
        "id", "accession", html_text(F.col("title")).alias("title"), html_text(F.col("description")).alias("description"),
        F.coalesce(relevance_flags({n: F.col(f"relevance.{n}") for n in RELEVANCE}), none_of()).alias("relevance"),
    )


def duplicate_keys(contexts: DataFrame) -> DataFrame:
    """``(key_name, key, n)`` of ids and accessions that occur more than once."""
    keys = contexts.select(F.explode(F.array(F.struct(F.lit("id").alias("key_name"), F.col("id").alias("key")), F.struct(F.lit("accession").alias("key_name"), F.col("accession").alias("key")))).alias("k")).select("k.*")
    return keys.groupBy("key_name", "key").agg(F.count("*").alias("n")).filter("n > 1")


def catalog_line(columns: Mapping[str, Column] | None = None) -> Column:
    """Compact JSON text of one context, fields in their catalog order, text unescaped."""
    c = columns or {n: F.col(n) for n in ("id", "accession", "title", "description", "relevance")}
    return F.to_json(F.struct(*[c[n].alias(n) for n in ("id", "accession", "title", "description", "relevance")]), {"ignoreNullFields": "false"})


def write_catalog(contexts: DataFrame, path: str) -> None:
    """JSON lines sorted by accession."""
    contexts.orderBy("accession").select(catalog_line().alias("value")).write.mode("overwrite").text(path)


def validate_catalog(lines: DataFrame) -> DataFrame:
    """``(line_no, problem)`` for every bad line of ``lines (line_no, line)``; a good catalog gives no row.

    A line is one JSON object with exactly the five fields; the id has ASCII digits only; accession and title are not
    blank; relevance holds distinct known flags; ids and accessions are unique.
    """
    keys = F.json_object_keys("line")
    text = lambda f: F.get_json_object("line", f"$.{f}")
    typed = F.from_json("line", "id string, accession string, title string, description string, relevance array<string>")
    # a quoted value is a string: get_json_object drops the quotes that the variant keeps apart
    is_string = lambda f: F.schema_of_variant(F.try_variant_get(F.try_parse_json("line"), f"$.{f}", "variant")) == "STRING"
    flags = typed["relevance"]
    problem = (
        F.when(keys.isNull() | (F.array_sort(keys) != F.array(*[F.lit(f) for f in FIELDS])), "fields")
        .when(~(is_string("id") & text("id").rlike(r"\A[0-9]+\z")), "id")
        .when(~(is_string("accession") & (F.trim(text("accession")) != "")), "accession")
        .when(~(is_string("title") & (F.trim(text("title")) != "")), "title")
        .when(~is_string("description"), "description")
        .when(flags.isNull() | (F.size(F.array_distinct(flags)) != F.size(flags)) | F.exists(flags, lambda x: x.isNull() | ~x.isin(*RELEVANCE)), "relevance")
    )
    checked = lines.select("line_no", "line", F.coalesce(problem).alias("problem"))
    bad = checked.filter("problem is not null").select("line_no", "problem")
    good = checked.filter("problem is null").select("line_no", text("id").alias("id"), text("accession").alias("accession"))
    twice = lambda key: good.groupBy(key).agg(F.sort_array(F.collect_list("line_no")).alias("at")).select(F.explode(F.slice("at", 2, 2**31 - 1)).alias("line_no"), F.lit(f"duplicate {key}").alias("problem"))
    return bad.unionByName(twice("id")).unionByName(twice("accession"))


def attach_accessions(rows: DataFrame, key: str, ids: str, projects: DataFrame) -> DataFrame:
    """``(key, accessions)``: sorted accessions of the linked ids that resolve, null lists and misses left out."""
    links = rows.select(key, F.explode_outer(ids).alias("__id"))
    resolved = projects.select(F.col("id").alias("__id"), F.col("accession").alias("__accession"))
    return links.join(resolved, "__id", "left").groupBy(key).agg(F.array_sort(F.collect_set("__accession")).alias("accessions"))


def unresolved_links(links: DataFrame, projects: DataFrame) -> DataFrame:
    """``(id, samples, examples)`` of ``links (id, accession)`` without a project: distinct samples and the first three."""
    missing = links.filter("id is not null").join(projects.select("id").distinct(), "id", "left_anti").select("id", "accession").distinct()
    return top_examples(missing, ["id"], ["accession"], 3).select("id", F.col("n").alias("samples"), F.array_join("examples.accession", "||").alias("examples"))
