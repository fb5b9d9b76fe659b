"""Scans of vocabularies and id lists, and the sinks of id lists and indexes."""

from __future__ import annotations

from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sampleloom.sources.tables import scan_tsv, write_tsv

TAXA = "taxid long, rank string, scientific_name string, synonym string, genbank_common_name string, common_name string, comments string"
ONTOLOGY = "term string, display_term string, ontology_link string, crosslink_term string, synonyms string, comment string"
ID_LIST = "accession string, taxid string, organism string"
INDEX = ("accession", "in_atb", "pathogen_biosample", "pathogen_atb", "taxid", "organism_value", "osf_tarball_filename")


def _numbered(df: DataFrame, column: str) -> DataFrame:
    """Adds the order of the rows; a quoted multi-line file is read by one task, so the id follows the file."""
    return df.withColumn(column, F.monotonically_increasing_id())


def scan_taxa(spark: SparkSession, path: str) -> DataFrame:
    """Host dimension of one file; its row order is kept as ``table_priority``."""
    return _numbered(scan_tsv(spark, path, TAXA), "table_priority").filter("taxid is not null")


def scan_ontology(spark: SparkSession, path: str) -> DataFrame:
    return _numbered(scan_tsv(spark, path, ONTOLOGY), "ordinal").withColumnRenamed("comment", "term_comment").filter("trim(term) <> ''")


def scan_names(spark: SparkSession, path: str) -> DataFrame:
    """Trimmed lines of a vocabulary, without blank ones."""
    return spark.read.text(path).select(F.trim("value").alias("name")).filter("name <> ''").distinct()


def load_config(path: str | Path) -> dict:
    import yaml

    got = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
    if not isinstance(got, Mapping):
        raise ValueError(f"{path}: a mapping is needed")
    return dict(got)


def scan_id_lists(spark: SparkSession, folder: str) -> DataFrame:
    """``(accession, taxid, organism, pathogen, file_name)`` of the list files of a folder; the file stem is the pathogen.

    The manifest is left out and empty files give no row. If an accession is in several lists, the first file by name wins
    in :func:`first_listed`.
    """
    raw = spark.read.csv(folder, sep="\t", header=True, schema=ID_LIST, pathGlobFilter="*.tsv")
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    return raw.select("*", name.alias("file_name")).filter(F.col("file_name") != "manifest.tsv").withColumn("pathogen", F.regexp_replace("file_name", r"\.tsv\z", ""))


def scan_written_lists(spark: SparkSession, folder: str) -> DataFrame:
    """The lists that :func:`write_id_lists` wrote, as :func:`scan_id_lists` gives them."""
    raw = spark.read.csv(f"{folder}/pathogen=*", sep="\t", header=True, schema=ID_LIST)
    key = F.regexp_extract("_metadata.file_path", r"/pathogen=([^/]+)/", 1)
    return raw.select("*", key.alias("file_name"), key.alias("pathogen"))


def first_listed(lists: DataFrame) -> DataFrame:
    cell = F.struct("file_name", "pathogen", "taxid", "organism")
    return lists.groupBy("accession").agg(F.min(cell).alias("b")).select("accession", "b.pathogen", "b.taxid", "b.organism")


def write_id_lists(rows: DataFrame, path: str, key: str = "pathogen") -> None:
    """One folder of lists per key."""
    rows.select(key, "accession", "taxid", "organism").write.mode("overwrite").partitionBy(key).csv(path, sep="\t", header=True)


def list_manifest(rows: DataFrame, registry: DataFrame, key: str = "pathogen") -> DataFrame:
    """``(pathogen, taxid, rows, status)`` of every registered key; keys without rows are ``empty``."""
    n = rows.groupBy(F.col(key).alias("pathogen")).agg(F.count("*").alias("n"))
    out = registry.select(F.col("key").alias("pathogen"), "taxid").join(n, "pathogen", "left")
    return out.select("pathogen", "taxid", F.coalesce("n", F.lit(0)).alias("rows"), F.when(F.col("n") > 0, "ok").otherwise("empty").alias("status"))


def hashed_manifest(lists: DataFrame, registry: DataFrame, folder: str, source: str, run_date: str) -> list[dict]:
    """Rows of the manifest of written lists, each with the hash of its list; there is one for each registered key."""
    from sampleloom.run.files import Store

    store = Store(lists.sparkSession)
    rows = []
    for r in list_manifest(lists, registry).orderBy("pathogen").collect():
        path = f"{folder}/pathogen={r['pathogen']}"
        rows.append({"pathogen": r["pathogen"], "run_date": run_date, "taxids": str(r["taxid"]), "source": source, "rows": r["rows"], "status": r["status"], "sha256": store.sha256(path) if store.exists(path) else ""})
    return rows


def write_index(index: DataFrame, path: str) -> None:
    """The index as a table sorted by accession, in any store; a table that is there becomes ``*_old``."""
    from sampleloom.run.files import Store

    store = Store(index.sparkSession)
    if store.exists(path):
        stem, dot, suffix = path.rpartition(".")
        store.move(path, f"{stem}_old{dot}{suffix}" if dot and "/" not in suffix else f"{path}_old")
    write_tsv(index.select(*INDEX), path, ["accession"])
