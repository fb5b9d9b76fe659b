"""Id lists and the XML subset of a sample dump, from one scan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sampleloom.operators.ranking import dimension
from sampleloom.session import cut

_SAMPLE = "_accession string, Description struct<Organism:struct<_taxonomy_id:string,_taxonomy_name:string>>"
ROOT = "BioSampleSet"


def raw_samples(spark: SparkSession, path: str) -> DataFrame:
    """``(raw, accession, taxid, organism)`` of every sample element, its text as it stands.

    The dump is cut at the closing tags, so a plain file is read by many tasks. Elements without a closing tag of their own hold
    nothing and are left out; samples are not nested.
    """
    text = spark.read.text(path, lineSep="</BioSample>").select(F.regexp_extract("value", r"(?s)<BioSample[\s>].*", 0).alias("raw")).filter("raw <> ''")
    text = text.select(F.concat(F.regexp_replace("raw", r"(?s)\A(?:<BioSample\s[^<>]*/>\s*)+", ""), F.lit("</BioSample>")).alias("raw"))
    e = text.select("raw", F.from_xml("raw", _SAMPLE, {"rowTag": "BioSample"}).alias("e"))
    return e.select("raw", F.col("e._accession").alias("accession"), F.col("e.Description.Organism._taxonomy_id").alias("taxid"), F.col("e.Description.Organism._taxonomy_name").alias("organism"))


@dataclass(frozen=True)
class Subset:
    """``lists (pathogen, accession, taxid, organism)`` and ``elements (raw)``."""

    lists: DataFrame
    elements: DataFrame


def select_samples(samples: DataFrame, closure: DataFrame, scope: DataFrame | None = None) -> Subset:
    """Samples whose taxid is in ``closure (taxid, key)`` as lists; those and the ones of ``scope (accession)`` as elements.

    A sample without an accession is in neither. ``samples`` are scanned once and cut.
    """
    closed = dimension(closure.select(F.col("taxid").cast("string").alias("__t"), "key").dropDuplicates(["__t"]))
    number = F.when(F.col("taxid").rlike(r"\A[0-9]+\z"), F.regexp_replace("taxid", r"\A0+(?=[0-9])", ""))
    s = samples.filter("accession <> ''").withColumn("__t", number).join(closed, "__t", "left")
    if scope is not None:
        s = s.join(scope.select("accession", F.lit(True).alias("__in")).distinct(), "accession", "left")
    else:
        s = s.withColumn("__in", F.lit(False))
    kept = cut(s.filter("key is not null or coalesce(__in, false)"))
    lists = kept.filter("key is not null").select(F.col("key").alias("pathogen"), "accession", "taxid", F.coalesce("organism", F.lit("")).alias("organism"))
    return Subset(lists, kept.select("raw"))


def write_subset(elements: DataFrame, path: str) -> None:
    """Parts that are XML documents of their own: each has the root element around its samples."""
    import pyarrow as pa

    def rooted(batches):
        line = lambda s: pa.record_batch([pa.array([s])], names=["value"])
        yield line(f'<?xml version="1.0" encoding="UTF-8"?>\n<{ROOT}>')
        yield from batches
        yield line(f"</{ROOT}>")

    elements.select(F.col("raw").alias("value")).mapInArrow(rooted, "value string").write.mode("overwrite").text(path)
