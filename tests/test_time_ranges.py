import datetime as dt

import pytest

from sampleloom.operators.time_ranges import normalise_times, time_range


def utc(*a):
    return int(dt.datetime(*a, tzinfo=dt.timezone.utc).timestamp())


NY, BE = "America/New_York", "Europe/Berlin"
CASES = [
    ("2024-04-03T00:00:28", "UTC", utc(2024, 4, 3, 0, 0, 28), utc(2024, 4, 3, 0, 0, 28)), ("2024-07-01T12:00", BE, utc(2024, 7, 1, 10), utc(2024, 7, 1, 10, 0, 59)), ("1521494499", NY, 1521494499, 1521494499), ("1515649075142", NY, 1515649075, 1515649075),
    ("1567768450270417", BE, 1567768450, 1567768450), ("2019-02-31T12:28:25Z", NY, None, None), ("2019-01-06T05:40:34+02:00", NY, utc(2019, 1, 6, 3, 40, 34), utc(2019, 1, 6, 3, 40, 34)), ("20170104T233115Z", NY, utc(2017, 1, 4, 23, 31, 15), utc(2017, 1, 4, 23, 31, 15)),
    ("20160622074726", "UTC", utc(2016, 6, 22, 7, 47, 26), utc(2016, 6, 22, 7, 47, 26)), ("2014-11-02 02:53:00 EST", BE, utc(2014, 11, 2, 7, 53), utc(2014, 11, 2, 7, 53)), ("01/04/2013 01:32", "UTC", utc(2013, 4, 1, 1, 32), utc(2013, 4, 1, 1, 32, 59)),
    ("12/25/2013 01:32", "UTC", utc(2013, 12, 25, 1, 32), utc(2013, 12, 25, 1, 32, 59)), ("Nov 26, 2016 6:49 AM", "UTC", utc(2016, 11, 26, 6, 49), utc(2016, 11, 26, 6, 49, 59)), ("Jan 24, 2013 12:34 am", "UTC", utc(2013, 1, 24, 0, 34), utc(2013, 1, 24, 0, 34, 59)),
    ("Sun, 31 Oct 2021 02:12:11 +0100", NY, utc(2021, 10, 31, 1, 12, 11), utc(2021, 10, 31, 1, 12, 11)), ("2014-12-15+11:00", NY, utc(2014, 12, 14, 13), utc(2014, 12, 15, 12, 59, 59)), ("2012-05-07Z", NY, utc(2012, 5, 7), utc(2012, 5, 7, 23, 59, 59)),
    ("2021-11-18T22:54:13 Asia/Tokyo", NY, utc(2021, 11, 18, 13, 54, 13), utc(2021, 11, 18, 13, 54, 13)), ("2021-12-03T12:39:42[America/New_York]", BE, utc(2021, 12, 3, 17, 39, 42), utc(2021, 12, 3, 17, 39, 42)), ("2022-04-20T04:31:20[UTC]", BE, utc(2022, 4, 20, 4, 31, 20), utc(2022, 4, 20, 4, 31, 20)),
    ("2024-03-10T02:30:00", NY, None, None), ("2024-11-03T01:30:00", NY, utc(2024, 11, 3, 5, 30), utc(2024, 11, 3, 6, 30)), ("2024-11-03 01:30", NY, utc(2024, 11, 3, 5, 30), utc(2024, 11, 3, 6, 30, 59)), ("2024-11-03", NY, utc(2024, 11, 3, 4), utc(2024, 11, 4, 4, 59, 59)),
    ("2024-03", BE, utc(2024, 2, 29, 23), utc(2024, 3, 31, 21, 59, 59)), ("2023", "UTC", utc(2023, 1, 1), utc(2023, 12, 31, 23, 59, 59)), ("2013/2015", "UTC", utc(2013, 1, 1), utc(2015, 12, 31, 23, 59, 59)), ("2016-03-19 TO December 2015", "UTC", utc(2015, 12, 1), utc(2016, 3, 19, 23, 59, 59)),
    ("Aug-2017 - 2018", "UTC", utc(2017, 8, 1), utc(2018, 12, 31, 23, 59, 59)), ("2020-12-24T06:01:58.6", "UTC", utc(2020, 12, 24, 6, 1, 58), utc(2020, 12, 24, 6, 1, 58)), ("2018-09-29T12:32:51.157779409z", NY, utc(2018, 9, 29, 12, 32, 51), utc(2018, 9, 29, 12, 32, 51)),
    ("2017-15-21 21:08", "UTC", None, None), ("2019-11-27 35:30:47", "UTC", None, None), ("12:30", "UTC", None, None), ("last week", "UTC", None, None), ("Q3", "UTC", None, None), ("", "UTC", None, None), (None, "UTC", None, None), ("  2023-01-02 ", "UTC", utc(2023, 1, 2), utc(2023, 1, 2, 23, 59, 59)),
    ("201606220747", "UTC", utc(2016, 6, 22, 7, 47), utc(2016, 6, 22, 7, 47, 59)), ("20160622", "UTC", utc(2016, 6, 22), utc(2016, 6, 22, 23, 59, 59)), ("1530826468123456789", NY, 1530826468, 1530826468),
    ("2023-01-02", None, None, None), ("2023-01-02Z", None, utc(2023, 1, 2), utc(2023, 1, 2, 23, 59, 59)), ("2018-06-01 00:15:00", "Australia/Lord_Howe", utc(2018, 5, 31, 13, 45), utc(2018, 5, 31, 13, 45)), ("x" * 100_000, "UTC", None, None), ("Mon, 31 Oct 2021 02:12:11 +0100", NY, None, None),
]


@pytest.mark.parametrize("value,zone,a,b", CASES)
def test_case(value, zone, a, b):
    assert time_range(value, zone) == (None if a is None else (a, b))


def test_rows(spark):
    rows = [(i, c[0], i if c[1] else None, "clash") for i, c in enumerate(CASES)]
    sites = [(i, c[1], "label") for i, c in enumerate(CASES) if c[1]]
    df = normalise_times(spark.createDataFrame(rows, "k int, v string, site_id int, time_zone string"), spark.createDataFrame(sites + sites[:3] + [(None, "UTC", "x")], "site_id int, time_zone string, site_label string"), "v")
    assert df.columns == ["k", "v", "site_id", "time_zone", "from_s", "to_s"]
    assert {r["k"]: (r["from_s"], r["to_s"]) for r in df.collect()} == {i: (c[2], c[3]) for i, c in enumerate(CASES)}
    assert normalise_times(spark.createDataFrame([], "k int, v string, site_id int"), spark.createDataFrame([], "site_id int, time_zone string"), "v").count() == 0


def test_kernels_equal_the_patterns():
    """What the array kernels read, the patterns read to the same range; around changes of the clock and in damaged writings, too."""
    import random

    import pyarrow as pa

    from sampleloom.operators.time_ranges import plain_ranges, time_range

    pick = random.Random(3)
    zones = ["Europe/Berlin", "America/New_York", "Australia/Lord_Howe", "Asia/Kolkata", "Nowhere/Land", None]
    shapes = ("{y}-{m}-{d}T{h}:{i}:{s}{f}{z}", "{y}/{m}/{d} {h}:{i}{z}", "{d}.{m}.{y} {h}:{i}:{s}{z}", "{y}-{m}-{d}{z}", "{d}-{m}-{y}", "{n}")
    values, at = [], []
    for _ in range(20_000):
        n = str(pick.randrange(10 ** pick.choice((8, 9, 10, 12, 13, 16, 18)), 10**19))[: pick.choice((9, 10, 13, 16, 19, 12))]
        v = pick.choice(shapes).format(
            y=pick.choice(("2021", "2024", "1999", "0000")), m=f"{pick.choice((3, 10, 11, 4, 0, 12, 13)):02}", d=f"{pick.randrange(33):02}", h=f"{pick.choice((0, 1, 2, 3, 12, 23, 24)):02}",
            i=f"{pick.choice((0, 30, 59, 60)):02}", s=f"{pick.choice((0, 59, 60)):02}", f=pick.choice(("", "", ".5", ",123456789", ".")), z=pick.choice(("", "", "Z", " utc", "+02", "-0330", "+05:45", " +15:00", "+14:60", " z", "  Z", "x")), n=n,
        )
        if pick.random() < 0.1:
            k = pick.randrange(len(v))
            v = v[:k] + pick.choice("0-: T ٣") + v[k + 1 :]
        values.append(pick.choice(("", " ", "\t")) + v)
        at.append(pick.choice(zones))
    first, last, found = plain_ranges(pa.array(values), pa.array(at))
    assert found.mean() > 0.2
    assert [(v, z) for i, (v, z) in enumerate(zip(values, at)) if found[i] and time_range(v, z) != (int(first[i]), int(last[i]))] == []


def test_long_values():
    from sampleloom.operators.time_ranges import time_range

    assert time_range("2020-01-02T00:00:00." + "0" * 500 + "Z", None) == (1577923200, 1577923200)
    assert time_range("2020-01-02" + " " * 500, "UTC") == (1577923200, 1578009599)
