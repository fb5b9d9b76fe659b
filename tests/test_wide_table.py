import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from sampleloom.functions.text import full
from sampleloom.operators import typed_values as V
from sampleloom.operators import wide_table as W

NUMBERS = [
    ("2126", None, "2126"), ('"24110"', None, "24110"), ("040885", None, "40885"), ("+2239", None, "2239"), ("2062.00", None, "2062"), ("71 436", None, "71436"), ("3,935", None, "3935"), ("6279.5", None, None), ("3723-3726", None, None),
    ("~2032", None, None), ("2'540", None, "2540"), ("3\xa0635", None, "3635"), ("360E1", None, "3600"), ("62577e0", None, "62577"), ("44 or 45", None, None), ("16524?", None, None), ("−39", "m", "-39"), ("60 M", "m", "60"), ("45 ft", "m", None),
    ("７", None, "7"), ("٣", None, "3"), ("52YEARS", "years", "52"), ("10 months", "years", None), ("", None, None), ("1,23", None, None), ("9" * 30, None, None),
]
DECIMALS = [
    ("7,34", None, "7.340"), ("-35.", None, "-35.000"), (".3", None, "0.300"), ("391.630.01.1", None, None), ("322.2/2", None, None), ("122.2E+00", None, "122.200"), ("'2'", None, "2.000"), ("59.4%", "%", "59.400"), ("38.3 %", "%", "38.300"),
    ("ca. 34.3", None, None), (">138", None, None), ("-3.8--3.89", None, None), ("1,234.5", None, "1234.500"), ("1.234.567,8", None, "1234567.800"), ("12,345,678", None, "12345678.000"), ("-0.0001", None, "0.000"), ("9.5 c", "C", "9.500"), ("8 units", None, None), ("nan", None, None), ("1e400", None, None),
]


@pytest.mark.parametrize("raw,unit,expected", NUMBERS)
def test_integer(raw, unit, expected):
    assert V.read_integer(raw, unit) == expected


@pytest.mark.parametrize("raw,unit,expected", DECIMALS)
def test_decimal(raw, unit, expected):
    assert V.read_decimal(raw, unit) == expected


@pytest.mark.parametrize("raw,expected", [("Y", "true"), (" y", "true"), ("0", "false"), ("yes/no", None), ("y?", None), ("2", None), ('"No"', "false")])
def test_boolean(raw, expected):
    assert V.read_boolean(raw) == expected


@pytest.mark.parametrize("raw,expected", [("21-SEP-2020", "2020-09-21"), ("2024/06/28", "2024-06-28"), ("September 12, 2019", "2019-09-12"), ("19 August 2019", "2019-08-19"), ("2019/2020", None), ("2014-03", None), ("31-Jun-2013", None), ("2023-13-07", None), ("25/12/2019", "2019-12-25"), ("12/25/2019", "2019-12-25")])
def test_day(raw, expected):
    d = V.read_day(raw)
    assert (d and d.isoformat()) == expected


TYPES = [("age", "integer", "years", "age of host"), ("weight", "decimal", "kg", None), ("captive", "boolean", None, None), ("seen", "date", None, "seen on;day seen"), ("note", "text", None, None)]
VALUES = {"age": ["3", "4 years", "x", "5-6"], "weight": ["1.5", "2,25 kg", "heavy"], "captive": ["yes", "no", "maybe"], "seen": ["2020-01-02", "3 May 2021", "2020"], "note": [" a  b ", "n/a", "Plain"]}
NAMES = {"age": ["AGE", "age of host", "Age-of-host"], "weight": ["weight", " Weight "], "captive": ["captive", '"captive"'], "seen": ["seen_on", "DAY SEEN"], "note": ["note", "ｎｏｔｅ"]}


def _rows(n, seed):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        a = r.choice(list(VALUES))
        e = "hot" if r.random() < 0.33 else r.choice([None, "", " ", "e1", "e2", "e3", f"e{r.randrange(200)}"])
        rows.append((e, r.choice([*NAMES[a], None, "other"]), r.choice([*VALUES[a], None, ""]), dt.datetime(2025, 1, 1) + dt.timedelta(seconds=r.randrange(50)) if r.random() < 0.97 else None, r.choice([i, None]) if r.random() < 0.1 else i))
    return rows + rows[: n // 10]


def _brute(rows):
    col = {full(x): t for t in TYPES for x in (t[0], *(t[3] or "").split(";")) if x}
    best = {}
    for e, n, v, at, seq in rows:
        if not e or not e.strip() or n is None or v is None:
            continue
        t = col.get(full(n))
        if not t or full(v) in ("", "n a"):
            continue
        got = V.read_as(v, t[1], t[2])
        if got is None:
            continue
        k = (at or dt.datetime.min, -1 if seq is None else seq, got)
        if (e, t[0]) not in best or k > best[e, t[0]]:
            best[e, t[0]] = k
    return {(e, a, k[2]) for (e, a), k in best.items()}


@pytest.mark.parametrize("parts,batch", [(1, 10000), (7, 50)])
def test_against_brute_force(spark, parts, batch):
    rows = _rows(3000, parts)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        df = spark.createDataFrame(rows, "entity string, name string, value string, at timestamp_ntz, seq long").withColumn("col", F.lit("clash")).withColumn("typed", F.lit("clash")).repartition(parts)
        types = spark.createDataFrame(TYPES, "attr_name string, value_type string, unit string, aliases string")
        wide, attributes = W.wide_table(df, types, spark.createDataFrame([("n/a",)], "word string"), "entity")
        got = [tuple(r) for r in W.unpivot_typed(wide, attributes, "entity").collect()]
        assert len(got) == len(set(got)) and set(got) == _brute(rows)
        assert wide.count() == len({e for e, _, _ in got})
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_empty(spark):
    df = spark.createDataFrame([], "entity string, name string, value string, at timestamp_ntz, seq long")
    types = spark.createDataFrame(TYPES, "attr_name string, value_type string, unit string, aliases string")
    wide, _ = W.wide_table(df, types, spark.createDataFrame([], "word string"))
    assert wide.count() == 0 and wide.columns == ["entity", "age", "captive", "note", "seen", "weight"]


def test_hot_entity(spark):
    """One entity with most rows, in many batches: a task sends few cells of it, and the last stage holds one per column."""
    hot = [("hot", n, str(i), dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i), i) for i in range(9000) for n in ("age", "note")]
    rows = [*hot, *((f"e{i}", "note", f"v{i}", None, i) for i in range(3000))]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 50)
    try:
        df = spark.createDataFrame(rows, "entity string, name string, value string, at timestamp_ntz, seq long").repartition(3)
        types = spark.createDataFrame(TYPES, "attr_name string, value_type string, unit string, aliases string")
        attributes = W.attributes_of(types)
        found = W.cells(df, attributes, [], 200)
        assert found.filter("entity = 'hot'").count() <= 3 * 2
        wide = W.widen(found, attributes)
        assert set(map(tuple, W.unpivot_typed(wide, attributes, "entity").collect())) == _brute(rows)
        plain = W.cells(df, attributes, [], 10**6)
        assert set(map(tuple, W.unpivot_typed(W.widen(plain.unionByName(found), attributes), attributes, "entity").collect())) == _brute(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_many_missing_words(spark):
    rows = _rows(500, 2)
    df = spark.createDataFrame(rows, "entity string, name string, value string, at timestamp_ntz, seq long")
    types = spark.createDataFrame(TYPES, "attr_name string, value_type string, unit string, aliases string")
    words = spark.createDataFrame([("n/a",), (None,), ("N A",), ("other",)], "word string")
    wide, attributes = W.wide_table(df, types, words, "entity", shipped_words=1)
    assert {tuple(r) for r in W.unpivot_typed(wide, attributes, "entity").collect()} == _brute(rows)


def test_widest_decimal():
    digits = "9" * 35
    assert V.read_as(digits, "decimal", None) == digits + ".000"
    assert V.read_as(digits + "9", "decimal", None) is None and V.read_as(digits + ".9996", "decimal", None) is None
