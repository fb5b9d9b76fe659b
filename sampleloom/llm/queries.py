"""Queries of the operators for training data (problems 4 to 8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sampleloom.functions.text import full, full_col, not_blank
from sampleloom.llm.bpe import count_tokens, encode_corpus
from sampleloom.llm.canonical import map_to_list
from sampleloom.llm.langid import language_segments, wrong_or_mixed
from sampleloom.llm.packing import pack
from sampleloom.llm.term_counts import mark_terms, term_counts
from sampleloom.operators.wide_table import attributes_of
from sampleloom.plans.folding import SPACE, complete, forms
from sampleloom.session import cut, shipped, table


def _attribute_names(types: DataFrame, target: str) -> set[str]:
    """Full forms of the names and aliases of the attributes with this match target."""
    wanted = types.filter(F.col("match_target") == target)
    return {full(n) for a in attributes_of(wanted) for n in (a.name, *a.aliases)}


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Isolation sources with the ontology entries they name."""
    decisions = table(spark, d, "curation_decisions").select("decision_id", "attr_name", "attr_value")
    names = _attribute_names(table(spark, d, "attribute_types"), "iso")
    rows = decisions.filter("attr_name is not null and attr_value is not null").filter(full_col(F.col("attr_name")).isin(sorted(names)))
    return map_to_list(rows, table(spark, d, "ontology_terms"), "decision_id", "attr_value")


def _counts(spark: SparkSession, d: str) -> tuple[DataFrame, int]:
    rows = table(spark, d, "curation_decisions")
    shape = rows.select(
        F.col("decision_id").alias("occurrence"),
        F.col("accession").alias("record"),
        F.array("attr_value").alias("f0"),
        F.coalesce(F.transform("events", lambda e: e["normalized_attribute"]), F.array().cast("array<string>")).alias("f1"),
    )
    # one narrow scan for both figures: rows of each record, then records and rows
    per_record = rows.filter(not_blank(F.col("accession"))).groupBy("accession").agg(F.count("*").alias("n"))
    n, total = per_record.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    return term_counts(shape, 2, total=total), n


def _named(df: DataFrame) -> DataFrame:
    return df.withColumn("field_name", F.element_at(F.array(F.lit("attr_value"), F.lit("normalized_attribute")), F.col("field") + 1))


def p5_terms(spark: SparkSession, d: str) -> DataFrame:
    """Occurrences and records of every distinct term, with its mark."""
    counts, n = _counts(spark, d)
    return _named(mark_terms(counts, n)).select("field_name", "term", "occurrences", "records", "mark")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """The terms that are too rare or too common."""
    return p5_terms(spark, d).filter("mark is not null").select("field_name", "term", "mark")


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    """Token ids of every document."""
    return encode_corpus(table(spark, d, "documents"))


def p7_containers(spark: SparkSession, d: str) -> DataFrame:
    """Every document with text, or its pieces, in a container of 2,048 tokens."""
    docs = table(spark, d, "documents").filter("text <> ''")
    packed = pack(cut(count_tokens(docs).withColumnRenamed("doc_id", "key")))
    return packed.select(F.col("key").alias("doc_id"), "part_no", "container_id", "from_token", F.col("size").alias("n_tokens"))


def _languages(spark: SparkSession, d: str) -> list[str]:
    return sorted(r[0] for r in table(spark, d, "languages").select("lang").distinct().collect() if r[0])


def p8_segments(spark: SparkSession, d: str) -> DataFrame:
    """Language and confidence of every document or segment."""
    return language_segments(table(spark, d, "documents").select("doc_id", "text", "lang"), _languages(spark, d))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose label is wrong or missing, and those in several languages."""
    return wrong_or_mixed(p8_segments(spark, d), _languages(spark, d)).select("doc_id", "seg_no", "lang")


_DISTINCT = "(SELECT DISTINCT decision_id, accession, attr_value, events FROM curation_decisions)"
_TEXTS = forms("SELECT attr_value AS v FROM curation_decisions UNION ALL SELECT unnest(events).normalized_attribute FROM curation_decisions", "tf")
_OCCURRENCES = (
    f"o AS (SELECT 'attr_value' AS field_name, decision_id, accession, 1 AS place, attr_value AS v FROM {_DISTINCT} UNION ALL SELECT 'normalized_attribute', decision_id, accession, unnest(range(1, len(events) + 1)), unnest(events).normalized_attribute FROM {_DISTINCT}), "
    f"k AS (SELECT field_name, shown AS term, accession, decision_id, place FROM o JOIN tf USING (v) WHERE shown <> '' AND NOT regexp_full_match(accession, '{SPACE}*') GROUP BY ALL), n AS (SELECT count(DISTINCT accession) AS n FROM curation_decisions WHERE NOT regexp_full_match(accession, '{SPACE}*')), "
    "t AS (SELECT field_name, term, count(*) AS occurrences, count(DISTINCT accession) AS records FROM k GROUP BY field_name, term), m AS (SELECT t.*, CASE WHEN records < 3 THEN 'rare' WHEN records > 0.02 * n THEN 'common' END AS mark FROM t, n)"
)

_ALL = (p4_found, p5_found, p5_terms, p6_ids, p7_containers, p8_found, p8_segments)
QUERIES = {f.__name__: shipped(f) for f in _ALL}
ORACLE = {
    "p5_terms": complete(f"WITH {_TEXTS}, {_OCCURRENCES} SELECT field_name, term, occurrences, records, mark FROM m"),
    "p5_found": complete(f"WITH {_TEXTS}, {_OCCURRENCES} SELECT field_name, term, mark FROM m WHERE mark IS NOT NULL"),
}
