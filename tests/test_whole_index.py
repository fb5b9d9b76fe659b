"""Queries over the whole index, not over chosen ids or pathogens."""

import datetime as dt

import pytest

from sampleloom.plans.pipeline_queries import QUERIES as Q

INDEX = [("A1", "q_varensis"), ("A2", "q_varensis"), ("A3", "q_varensis"), ("A4", "m_tarda"), ("A5", "p_fulva"), ("A6", "other")]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("index"))
    rows = [(a, p, "False", None, dt.datetime(2020, 1, 1)) for a, p in INDEX]
    spark.createDataFrame(rows, "accession string, pathogen_biosample string, in_atb string, pathogen_atb string, first_seen timestamp").write.parquet(f"{d}/accession_index.parquet")
    decisions = [(i, a, "host", "Ursina fulva", None) for i, (a, _) in enumerate(INDEX)]
    spark.createDataFrame(decisions, "decision_id long, accession string, attr_name string, attr_value string, bioproject_accession string").write.parquet(f"{d}/curation_decisions.parquet")
    spark.createDataFrame([("t", "t", "", "", "", "")], "term string, display_term string, ontology_link string, synonyms string, crosslink_term string, term_comment string").write.parquet(f"{d}/ontology_terms.parquet")
    spark.createDataFrame([("host", "host", "")], "attr_name string, match_target string, aliases string").write.parquet(f"{d}/attribute_types.parquet")
    spark.createDataFrame([(0, "A1", "collection_date", "2019", "s")], "origin_id long, accession string, attr_name string, attr_value string, category string").write.parquet(f"{d}/date_origins.parquet")
    return d


def test_count_of_all_records(spark, folder):
    got = {r["pathogen"]: r["n"] for r in Q["count_selected"](spark, folder).collect()}
    assert got == {"q_varensis": 3, "q_lutea": 0, "b_oxalis": 0, "m_tarda": 1, "p_fulva": 1}


def test_outcomes_of_all_pathogens(spark, folder):
    assert {r["accession"] for r in Q["accept_rows"](spark, folder).collect()} == {"A1", "A2", "A3", "A4", "A5"}
    got = {(r["pathogen"], r["metric"]): r["n"] for r in Q["report_rollup"](spark, folder).collect()}
    assert (got["m_tarda", "hosted"], got["p_fulva", "hosted"], got["q_lutea", "hosted"], got[None, "hosted"]) == (1, 1, 0, 5)
    assert {(r["accession"], r["pathogen"]) for r in Q["final_projection"](spark, folder).collect()} >= {("A4", "Quorella tarda"), ("A5", "Pelagoma")}
