"""XML scans of sample and project records with declared schemas; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sampleloom.functions.strings import none_of

# Root attributes of a sample and the look of a root date.
ROOT_ATTRIBUTES = ("submission_date", "last_update", "publication_date", "access")
ROOT_DATE = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}"
SAMPLE_SCHEMA = (
    "_accession string, " + ", ".join(f"_{a} string" for a in ROOT_ATTRIBUTES) + ", "
    "Attributes struct<Attribute:array<struct<_VALUE:string,_harmonized_name:string,_attribute:string,_attribute_name:string>>>, "
    "Links struct<Link:array<struct<_VALUE:string,_target:string>>>"
)
_PROJECT_BODY = "struct<Title:string,Description:string,Relevance:struct<Agricultural:string,Environmental:string,Veterinary:string,Medical:string,Evolution:string>>"
_ARCHIVE = "struct<_accession:string,_id:string>"
PROJECT_SCHEMA = f"ProjectDescr {_PROJECT_BODY}, ArchiveID {_ARCHIVE}, Project struct<Project:struct<ProjectID:struct<ArchiveID:{_ARCHIVE}>,ProjectDescr:{_PROJECT_BODY}>,ProjectID:struct<ArchiveID:{_ARCHIVE}>,ArchiveID:{_ARCHIVE},ProjectDescr:{_PROJECT_BODY}>"


def _scan(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    return spark.read.format("xml").schema(schema).option("rowTag", tag).option("ignoreSurroundingSpaces", "false").option("mode", "PERMISSIVE").load(path)


_CANDIDATES = "array<struct<attribute:string,value:string,xml_source:string>>"


def candidates_of(root: dict[str, Column], inner: Column) -> Column:
    """Candidates of a record in reading order: root attributes that look like a date and time, then the inner ones.

    ``inner`` is ``array<struct<harmonized,attribute,value>>``; the harmonized name counts if it is there. Candidates
    without a name or value are left out; values keep their spaces.
    """
    outer = F.filter(F.array(*[F.struct(F.lit(a).alias("attribute"), c.alias("value"), F.lit("biosample_root").alias("xml_source")) for a, c in root.items()]), lambda c: c["value"].rlike(ROOT_DATE))
    named = F.transform(inner, lambda a: F.struct(F.coalesce(F.nullif(a["harmonized"], F.lit("")), a["attribute"]).alias("attribute"), a["value"].alias("value"), F.lit("attribute").alias("xml_source")))
    usable = F.filter(named, lambda c: c["attribute"].isNotNull() & (c["attribute"] != "") & c["value"].isNotNull() & (c["value"] != ""))
    return F.concat(outer, F.coalesce(usable, F.array().cast(_CANDIDATES)))


def scan_samples(spark: SparkSession, path: str) -> DataFrame:
    """One row per ``BioSample`` element of a plain or compressed file: accession (``unknown`` if absent), candidates, project ids.

    Values keep their spaces; one of white space alone counts as none. A compressed file is one task; spread the rows right after the scan if it is large.
    """
    raw = _scan(spark, path, "BioSample", SAMPLE_SCHEMA)
    inner = F.transform("Attributes.Attribute", lambda a: F.struct(a["_harmonized_name"].alias("harmonized"), a["_attribute"].alias("attribute"), a["_VALUE"].alias("value")))
    return raw.select(
        F.coalesce("_accession", F.lit("unknown")).alias("accession"), candidates_of({a: F.col(f"_{a}") for a in ROOT_ATTRIBUTES}, inner).alias("candidates"),
        linked_ids(F.col("Links.Link")).alias("project_ids"),
    )


def linked_ids(links: Column) -> Column:
    """Trimmed, distinct project ids of ``array<struct<_VALUE,_target>>``, in the order of texts."""
    found = F.transform(F.filter(links, lambda x: x["_target"] == "bioproject"), lambda x: F.trim(x["_VALUE"]))
    return F.coalesce(F.array_sort(F.array_distinct(F.filter(found, lambda x: x.isNotNull() & (x != "")))), none_of())


def require_numeric(ids: Column) -> Column:
    """``ids``, or a failure that names the first that is not made of ASCII digits."""
    bad = F.filter(ids, lambda x: ~x.rlike(r"\A[0-9]+\z"))
    return F.when(F.size(bad) > 0, F.raise_error(F.concat(F.lit("linked project id is not numeric: "), bad[0])).cast("array<string>")).otherwise(ids)


def scan_projects(spark: SparkSession, path: str, tags: tuple[str, ...] = ("Package", "DocumentSummary")) -> DataFrame:
    """One row per project element of any of ``tags``: id, accession, raw title and description, relevance texts."""
    parts = []
    for tag in tags:
        raw = _scan(spark, path, tag, PROJECT_SCHEMA)
        first = lambda *cs: F.coalesce(*[F.col(c) for c in cs])
        archive = first("ArchiveID", "Project.Project.ProjectID.ArchiveID", "Project.ProjectID.ArchiveID", "Project.ArchiveID")
        descr = first("ProjectDescr", "Project.Project.ProjectDescr", "Project.ProjectDescr")
        parts.append(raw.select(F.trim(archive["_id"]).alias("id"), F.trim(archive["_accession"]).alias("accession"), descr["Title"].alias("title"), descr["Description"].alias("description"), descr["Relevance"].alias("relevance")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_xml(df: DataFrame, path: str, root: str, tag: str) -> None:
    df.write.format("xml").option("rootTag", root).option("rowTag", tag).mode("overwrite").save(path)
