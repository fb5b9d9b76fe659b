"""Accession index: label mapping, outer join of scopes, membership, retired ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sampleloom.operators.ranking import dimension, first_by

NA = "NA"  # the null text of the index


def label_token(c: Column) -> Column:
    """Lower case without a suffix of an underscore and capitals."""
    return F.lower(F.regexp_replace(c, r"_[A-Z]+\z", ""))


def map_labels(labels: DataFrame, registry: DataFrame, label: str = "label") -> DataFrame:
    """``(label, key)`` of the distinct labels: by genus and species, else by genus, else ``NA``."""
    distinct = labels.select(label).distinct()
    words = F.filter(F.split(F.trim(F.coalesce(label, F.lit(""))), r"\s+"), lambda w: w != "")
    parts = distinct.withColumn("__g", label_token(F.try_element_at(words, F.lit(1)))).withColumn("__s", label_token(F.try_element_at(words, F.lit(2))))
    reg = registry.select("key", "rank", F.split(F.lower("scientific_name"), r"\s+").alias("w"))
    species = dimension(reg.filter("rank <> 'genus'").select(F.col("w")[0].alias("__g"), F.try_element_at("w", F.lit(2)).alias("__s"), F.col("key").alias("__k1")).dropDuplicates(["__g", "__s"]))
    genus = dimension(reg.filter("rank = 'genus'").select(F.col("w")[0].alias("__g"), F.col("key").alias("__k2")).dropDuplicates(["__g"]))
    return parts.join(species, ["__g", "__s"], "left").join(genus, "__g", "left").select(label, F.coalesce("__k1", "__k2", F.lit(NA)).alias("key"))


def last_wins(rows: DataFrame, key: str, value: str, order: list[str]) -> DataFrame:
    """The value of the last row of each key; blank keys and values are left out."""
    full = rows.filter((F.trim(key) != "") & (F.trim(value) != ""))
    return first_by(full, [key], order, [value], last=True)


def membership(rows: DataFrame, flag: str, key: str, group: str) -> DataFrame:
    """Distinct ``(group, key)`` of the rows whose flag is the text ``True``."""
    return rows.filter((F.col(flag) == "True") & (F.trim(key) != "") & (F.trim(group) != "")).select(group, key).distinct()


def outer_index(scope: DataFrame, catalog: DataFrame, label_keys: DataFrame) -> DataFrame:
    """Index of both scopes: ``scope (accession, pathogen, taxid, organism)`` and ``catalog (accession, label, tarball)``.

    A catalog row only adds to the scope if its label maps to a key, but every catalog row counts for ``in_atb``.
    Accessions must be unique on either side.
    """
    right = catalog.join(dimension(label_keys), "label", "left").select("accession", F.coalesce("key", F.lit(NA)).alias("__key"), F.col("tarball").alias("__tar"), F.lit(True).alias("__in"))
    both = scope.withColumn("__scope", F.lit(True)).join(right, "accession", "full_outer").filter("__scope is not null or __key <> 'NA'")
    na = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(NA))
    return both.select(
        "accession", F.when(F.col("__in"), "True").otherwise("False").alias("in_atb"), na("pathogen").alias("pathogen_biosample"), F.coalesce("__key", F.lit(NA)).alias("pathogen_atb"),
        na("taxid").alias("taxid"), na("organism").alias("organism_value"), na("__tar").alias("osf_tarball_filename"),
    )


def index_counts(index: DataFrame) -> DataFrame:
    bio, atb = F.col("pathogen_biosample") != NA, F.col("pathogen_atb") != NA
    return index.agg(
        F.count("*").alias("rows"), F.count_if(bio & ~atb).alias("only_taxonomy"), F.count_if(~bio & atb).alias("only_catalog"), F.count_if(bio & atb).alias("both"),
        F.count_if(F.col("in_atb") == "True").alias("in_catalog"), F.count_if(~bio).alias("biosample_na"), F.count_if(~atb).alias("atb_na"),
    )


def conflicting_keys(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with more than one distinct value, and how many."""
    return rows.select(key, value).distinct().groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")
