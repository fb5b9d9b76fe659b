import random
from collections import defaultdict

import pytest

from sampleloom.functions.text import presentation
from sampleloom.llm import term_counts as T
from sampleloom.session import ship

SCHEMA = "occurrence long, record string, f0 array<string>, f1 array<string>, field string"


def _rows(n, seed):
    r = random.Random(seed)
    word = lambda: r.choice(["hot", "Hot ", "HOT", None, "", " ", "'q'", f"w{r.randrange(n // 4 + 1)}", "ünïq", "ＨＯＴ"])
    rows = [(i, "big" if r.random() < 0.33 else r.choice([None, "", " ", f"r{r.randrange(n // 5 + 1)}"]), [word()], [word() for _ in range(r.randrange(4))] if r.random() < 0.9 else None, "clash") for i in range(n)]
    return rows + rows[: n // 10]


def _brute(rows):
    occ, rec = defaultdict(set), defaultdict(set)
    for o, r, *fs, _ in rows:
        if not r or not r.strip():
            continue
        for f, values in enumerate(fs):
            for i, v in enumerate(values or []):
                if v is not None and (p := presentation(v)):
                    occ[f, p].add((o, i))
                    rec[f, p].add(r)
    return {k: (len(occ[k]), len(rec[k])) for k in occ}


@pytest.mark.parametrize("n,parts,batch", [(2000, 7, 64), (500, 1, 10000), (3, 4, 10000), (0, 3, 10000)])
def test_against_brute_force(spark, n, parts, batch):
    ship(spark)
    rows = _rows(n, n)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        df = spark.createDataFrame(rows, SCHEMA).repartition(3)
        from pyspark.sql import functions as F

        df = df.withColumn("f1", F.coalesce("f1", F.array().cast("array<string>")))
        got = T.term_counts(df, 2, parts).collect()
        assert {(r["field"], r["term"]): (r["occurrences"], r["records"]) for r in got} == _brute(rows) and len(got) == len(_brute(rows))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_marks(spark):
    df = spark.createDataFrame([("a", 2), ("b", 3), ("c", 20), ("d", 21)], "term string, records long")
    assert {r["term"]: r["mark"] for r in T.mark_terms(df, 1000).collect()} == {"a": "rare", "b": None, "c": None, "d": "common"}
