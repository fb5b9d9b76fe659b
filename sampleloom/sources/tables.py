"""Delimited tables: strict scans and single-file sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan_tsv(spark: SparkSession, path: str, schema: str | T.StructType, multi_line: bool = True) -> DataFrame:
    """Tab-separated text with a header, plain or compressed by suffix; quotes are doubled inside quoted cells.

    Blank and absent text cells are both the empty text. With ``multi_line`` cells may hold line ends and each file is one task
    (the sink writes many); without it a plain file is split among tasks.
    """
    return spark.read.csv(path, sep="\t", header=True, quote='"', escape='"', multiLine=multi_line, schema=schema, enforceSchema=False, emptyValue="").na.fill("")


def python_bool(c: Column) -> Column:
    """``True`` and ``False`` as the tables write them."""
    return F.when(c, "True").when(~c, "False")


def write_tsv(df: DataFrame, path: str, order: list[str] | None = None, single: bool = False, drop: list[str] | None = None) -> None:
    """Tab-separated text with a header in every part and blank cells for nulls.

    Rows are in ``order`` if given, over the parts by their names as well; ``single`` asks for one part, written by one task.
    Columns of ``drop`` only order.
    """
    flat = df.select(*[python_bool(F.col(c)).alias(c) if t == "boolean" else F.col(c) for c, t in df.dtypes])
    if single:
        flat = flat.repartition(1)
        flat = flat.sortWithinPartitions(*order) if order else flat
    elif order:
        flat = flat.orderBy(*order)
    flat = flat.drop(*(drop or ()))
    flat.write.mode("overwrite").csv(path, sep="\t", header=True, quote='"', escape='"', emptyValue="", nullValue="", lineSep="\n")


def require_columns(df: DataFrame, needed: list[str]) -> None:
    missing = [c for c in needed if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def _dump(spark: SparkSession, path: str) -> DataFrame:
    """``(line_no, c)``: the trimmed cells of a bar-separated dump."""
    return spark.read.text(path).select(F.monotonically_increasing_id().alias("line_no"), F.transform(F.split("value", r"\|"), lambda x: F.trim(F.regexp_replace(x, r"\t", ""))).alias("c"))


def _number(i: int, name: str) -> Column:
    return F.col("c")[i].try_cast("bigint").alias(name)


def scan_nodes(spark: SparkSession, path: str) -> DataFrame:
    """``(taxid, parent, rank)``; short lines and ids that are no numbers are left out."""
    return _dump(spark, path).filter(F.size("c") >= 3).select(_number(0, "taxid"), _number(1, "parent"), F.col("c")[2].alias("rank")).filter("taxid is not null and parent is not null")


def scan_merged(spark: SparkSession, path: str) -> DataFrame:
    """``(old, new)`` of retired ids."""
    return _dump(spark, path).filter(F.size("c") >= 2).select(_number(0, "old"), _number(1, "new")).filter("old is not null and new is not null")


def scan_taxonomy(spark: SparkSession, nodes_path: str, names_path: str) -> tuple[DataFrame, DataFrame]:
    """``nodes (taxid, parent, rank)`` and ``names (taxid, name, common_names)`` of bar-separated dumps.

    Short lines and ids that are no numbers are left out; the first scientific name of a taxon counts, common names keep
    their order.
    """
    named = _dump(spark, names_path).filter(F.size("c") >= 4).select("line_no", F.expr("try_cast(c[0] as bigint)").alias("taxid"), F.col("c")[1].alias("name"), F.col("c")[3].alias("kind")).filter("taxid is not null")
    return scan_nodes(spark, nodes_path), names_of(named)


def names_of(named: DataFrame) -> DataFrame:
    """``(taxid, name, common_names)`` from ``named (line_no, taxid, name, kind)``."""
    common = F.when(F.col("kind").isin("genbank common name", "common name"), F.struct("line_no", "name"))
    return named.groupBy("taxid").agg(
        F.min(F.when(F.col("kind") == "scientific name", F.struct("line_no", "name")))["name"].alias("name"),
        F.transform(F.array_sort(F.collect_list(common)), lambda x: x["name"]).alias("common_names"),
    )
