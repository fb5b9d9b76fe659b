"""Queries of the general operators for training data (problems 1 to 3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sampleloom.operators.nested_records import flatten_records
from sampleloom.operators.time_ranges import normalise_times
from sampleloom.operators.wide_table import unpivot_typed, wide_table
from sampleloom.session import table


def _wide(spark: SparkSession, d: str):
    rows = table(spark, d, "curation_decisions").select(
        F.col("accession").alias("entity"), F.col("attr_name").alias("name"), F.col("attr_value").alias("value"), F.col("loaded_at").alias("at"), F.col("decision_id").alias("seq")
    )
    return wide_table(rows, table(spark, d, "attribute_types"), table(spark, d, "missing_words"), "accession")


def p1_wide(spark: SparkSession, d: str) -> DataFrame:
    """One row per accession, one typed column per attribute."""
    return _wide(spark, d)[0]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """The filled cells of the wide table."""
    wide, attributes = _wide(spark, d)
    return unpivot_typed(wide, attributes, "accession")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Ranges of UTC seconds of the three written time fields."""
    origins, bounds = table(spark, d, "date_origins"), table(spark, d, "date_bounds")
    part = lambda df, name, key, value: df.select(F.lit(name).alias("field_name"), F.col(key).alias("row_id"), F.col(value).alias("value"), "site_id")
    rows = (
        part(origins, "origin_value", "origin_id", "attr_value")
        .unionByName(part(bounds, "bound_start", "bounds_id", "bound_start"))
        .unionByName(part(bounds, "bound_end", "bounds_id", "bound_end"))
    )
    spans = normalise_times(rows.filter(F.col("value").isNotNull()), table(spark, d, "collection_sites"), "value")
    return spans.filter(F.col("from_s").isNotNull()).select("field_name", "row_id", "from_s", "to_s").distinct()


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Flat rows of the nested payloads."""
    return flatten_records(table(spark, d, "raw_records"))


QUERIES = {"p1_found": p1_found, "p1_wide": p1_wide, "p2_found": p2_found, "p3_found": p3_found}
ORACLE: dict[str, str] = {}
