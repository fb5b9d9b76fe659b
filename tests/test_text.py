import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sampleloom.functions import strings as S
from sampleloom.functions.text import full, full_col, presentation, presentation_col

TEXTS = ["", " ", "A  b", "'x'", '"Äö  ß"', "''", "'", "ＦＵＬＬ width", "a_b-c", "\tTab\n", "É́", "İstanbul", "straße", "x\x1cy", "--", "“q”", "'a\"", "ﬁne", "9 ½"]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(codec="utf-8", exclude_characters="\x00"), max_size=12), min_size=1, max_size=60))
def test_forms_equal_python(spark, values):
    values = list(dict.fromkeys(values + TEXTS))
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string").select("i", presentation_col(F.col("v")).alias("p"), full_col(F.col("v")).alias("f"))
    for r in df.collect():
        assert (r["p"], r["f"]) == (presentation(values[r["i"]]), full(values[r["i"]])), repr(values[r["i"]])


def test_null_forms(spark):
    r = spark.createDataFrame([(None,)], "v string").select(presentation_col(F.col("v")).alias("p"), full_col(F.col("v")).alias("f"), S.norm_host(F.col("v")).alias("h"), S.pipe_split(F.col("v")).alias("s"), S.semi_split(F.col("v")).alias("m")).first()
    assert tuple(r) == (None, None, "", [], [])


@pytest.mark.parametrize("raw,expected", [("<p>a</p>b", "a b"), ("&lt;p&gt;x&lt;/p&gt;", "x"), ("a<!-- no -->b", "ab"), ("a<i>b</i>c", "abc"), ("1 &lt; 2", "1 < 2"), (None, ""), ("", ""), ("a<br/>b", "a b")])
def test_html(spark, raw, expected):
    r = spark.createDataFrame([(raw,)], "v string").select(S.html_text(F.col("v")).alias("x")).first()
    assert r["x"] == expected


def test_small_functions(spark):
    df = spark.createDataFrame([("a||b||", "x;; nan ;y", "Quessant: Brae", "a:b:c", "see qnt:0012 and PX:9")], "p string, s string, l string, t string, i string")
    r = df.select(
        S.pipe_split(F.col("p")).alias("p"), S.semi_split(F.col("s")).alias("s"), S.split_place(F.col("l")).alias("l"), S.path_prefixes(F.col("t")).alias("t"), S.extract_ids(F.col("i")).alias("i"),
        S.digit_variants(F.array(F.lit("9"), F.lit("patient1"), F.lit("2x2"))).alias("d"), S.norm_keyword(F.lit("Raw Curd-x")).alias("k"), S.strip_substrings(F.lit("healthy HOST (juv.) x"), ["healthy", "(juv.)", "host"]).alias("z"),
        S.under_any(F.lit("food:x"), ["food"]).alias("u"), S.under_any(F.lit("foods"), ["food"]).alias("v"),
    ).first()
    assert r["p"] == ["a", "b", ""] and r["s"] == ["x", "y"] and tuple(r["l"]) == ("Quessant", "Brae") and r["t"] == ["a", "a:b", "a:b:c"] and r["i"] == ["QNT:0012", "PX:9"]
    assert r["d"] == ["9", "patient1", "2x2", "patient", "x"] and r["k"] == "raw_curd_x" and r["z"].split() == ["x"] and r["u"] and not r["v"]
