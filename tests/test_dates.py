import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from sampleloom.functions import dates as D

REF = dt.date(2026, 7, 9)
# value, start, end, score
CASES = [
    ("2019-03-15", "2019-03-15", "2019-03-15", 1.0), ("2019/03/15", "2019-03-15", "2019-03-15", 1.0), ("March 15, 2019", "2019-03-15", "2019-03-15", 1.0), ("15-Mar-2019", "2019-03-15", "2019-03-15", 1.0),
    ("2019-03-15T12:00:00Z", "2019-03-15", "2019-03-15", 1.0), ("2019-03-15T25:99", "2019-03-15", "2019-03-15", 1.0), ("2019", "2019-01-01", "2019-12-31", 0.8), ("03-2019", "2019-03-01", "2019-03-31", 0.9), ("March 2019", "2019-03-01", "2019-03-31", 0.9),
    ("2020-02", "2020-02-01", "2020-02-29", 0.9), ("03/03/2019", "2019-03-03", "2019-03-03", 1.0), ("04/03/2019", "2019-03-04", "2019-03-04", 0.7), ("12/31/2019", "2019-12-31", "2019-12-31", 1.0), ("2018/2020", "2018-01-01", "2020-12-31", 0.5),
    ("2018 to 2020", "2018-01-01", "2020-12-31", 0.5), ("2015/2020", "2015-01-01", "2020-12-31", 0.4), ("2011/2020", "2011-01-01", "2020-12-31", 0.3), ("1990/2020", "1990-01-01", "2020-12-31", 0.2), ("2019/2019", "2019-01-01", "2019-12-31", 0.8),
    ("2018/2020-06", "2018-01-01", "2020-06-30", 0.5), ("2020 to 2018", "2018-01-01", "2020-12-31", 0.5), ("Nov-2016/29-May-2017", "2016-11-01", "2017-05-29", 0.6), ("2019-20", "2019-01-01", "2020-12-31", 0.5), ("  2019  ", "2019-01-01", "2019-12-31", 0.8),
]
REJECTED = [("1799", "before_supported_year"), ("2922-08-23", "after_metadata_reference_date"), ("not a date", "unsupported_format"), ("2019 to 2027", "after_metadata_reference_date"), ("2019-02-30", "invalid_calendar_date"), ("to 2019", "invalid_interval_structure"), ("0000", "invalid_calendar_date"), (None, "unsupported_format"), ("", "unsupported_format"), ("2018 to 2019 to 2020", "invalid_interval_structure")]


def test_interpret(spark):
    df = spark.createDataFrame([(c[0],) for c in CASES], "v string").select("v", D.interpret(F.col("v"), REF).alias("r"))
    got = {r["v"]: (str(r["r"]["start"]), str(r["r"]["end"]), r["r"]["score"]) for r in df.collect()}
    assert got == {v: (s, e, x) for v, s, e, x in CASES}


def test_rejections(spark):
    df = spark.createDataFrame([(c[0],) for c in REJECTED], "v string").select("v", D.interpret(F.col("v"), REF)["reason"].alias("r"))
    assert {r["v"]: r["r"] for r in df.collect()} == dict(REJECTED)


RECORDS = [
    ([("d", "2019-03-04", "s"), ("e", "04/03/2019", "s")], ("2019-03-04", "2019-03-04", 0.7), [("d", "2019-03-04")], "equivalent_candidate_collapse"),
    ([("d", "1993", "s"), ("e", "2009", "s"), ("d", "1993", "s")], ("1993-01-01", "2009-12-31", 0.2), [("d", "1993"), ("e", "2009")], "conflicting_candidate_combination"),
    ([("d", "2922-08-23", "s"), ("o", "2021-06-15", "o"), ("p", "2019", "o")], ("2019-01-01", "2019-12-31", 0.1), [("p", "2019")], "fallback_selection"),
    ([("a", "2019", "o"), ("b", "2019-01", "o")], ("2019-01-01", "2019-12-31", 0.1), [("a", "2019")], "fallback_selection"),
    ([], ("None", "None", None), [], "no_usable_candidate"),
    (None, ("None", "None", None), [], "no_usable_candidate"),
]


def test_records(spark):
    rows = [(i, r[0]) for i, r in enumerate(RECORDS)]
    df = spark.createDataFrame(rows, "i int, c array<struct<attribute:string,value:string,category:string>>")
    for r in df.select("i", D.standardize_dates(F.col("c"), REF).alias("o")).collect():
        _, bounds, origins, diagnostic = RECORDS[r["i"]]
        o = r["o"]
        assert (str(o["start"]), str(o["end"]), o["score"]) == bounds
        assert [tuple(x) for x in o["origins"]] == origins
        assert diagnostic in o["diagnostics"]


@pytest.mark.parametrize("parts", [1, 5])
def test_partitions_do_not_matter(spark, parts):
    values = [c[0] for c in CASES] * 3
    random.Random(parts).shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(parts).select("v", D.interpret(F.col("v"), REF)["score"].alias("s"))
    assert {r["v"]: r["s"] for r in df.collect()} == {c[0]: c[3] for c in CASES}


@pytest.mark.parametrize("parts", [1, 4])
def test_rows_equal_lists(spark, parts):
    """Reduction of rows and of lists agree, with a hot record, ties and repeated rows."""
    from sampleloom.operators.date_records import reduce_dates

    r = random.Random(parts)
    values = [c[0] for c in CASES] + [c[0] for c in REJECTED if c[0] is not None]
    rows = [("hot" if r.random() < 0.33 else f"r{r.randrange(150)}", i, r.choice("ab"), r.choice(values), r.choice("so")) for i in range(600)]
    df = spark.createDataFrame(rows, "record string, pos long, attribute string, value string, category string").repartition(parts)
    got = {x["record"]: (x["start"], x["end"], x["score"], x["attributes"], x["values"], x["diagnostics"]) for x in reduce_dates(df, REF).collect()}
    lists = df.groupBy("record").agg(F.array_sort(F.collect_list(F.struct("pos", "attribute", "value", "category"))).alias("c"))
    o = lists.select("record", D.standardize_dates(F.transform("c", lambda c: F.struct(c["attribute"], c["value"], c["category"])), REF).alias("o"))
    want = {x["record"]: (x["o"]["start"], x["o"]["end"], x["o"]["score"], "||".join(y["attribute"] for y in x["o"]["origins"]), "||".join(y["value"] for y in x["o"]["origins"]), x["o"]["diagnostics"]) for x in o.collect()}
    assert got == want
    assert reduce_dates(df.limit(0), REF).count() == 0
