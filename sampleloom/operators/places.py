"""Locations: coordinates, country names, nearest places, mapping to an official list."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sampleloom.functions import strings as S
from sampleloom.operators.ranking import dimension

NA = "NA"
_NUMBER = r"(-?[0-9]+\.?[0-9]*)"
# The two writings of coordinates; both are searched for, not matched as a whole.
HEMISPHERES = rf"(?iU){_NUMBER}\s*([NS])\s*[,/\s]*\s*{_NUMBER}\s*([EW])"
PAIR = rf"(?U){_NUMBER}\s*[,/]\s*{_NUMBER}"
# Decimal digits of all scripts, in runs from zero to nine.
DIGITS = "".join(c for c in map(chr, range(128, 0x10000)) if unicodedata.category(c) == "Nd")


def _read_coordinates(c: Column) -> Column:
    """One-item list of ``(lat, lon, looks, valid)``; each step is bound to a variable, so that a text is searched once for each writing."""
    plain = F.when(c.rlike(r"[^\x00-\x7f]"), F.translate(c, DIGITS, "0123456789" * (len(DIGITS) // 10))).otherwise(c)
    seen = F.transform(F.array(plain), lambda x: F.struct(x.alias("x"), x.rlike(HEMISPHERES).alias("named"), x.rlike(PAIR).alias("pair")))
    num = lambda s, p, g: F.regexp_extract(s["x"], p, g).try_cast("double")
    sign = lambda s, g, minus: F.when(F.upper(F.regexp_extract(s["x"], HEMISPHERES, g)) == minus, -1.0).otherwise(1.0)
    of = lambda s, n, g, minus, k: F.when(s["named"], num(s, HEMISPHERES, n) * sign(s, g, minus)).when(s["pair"], num(s, PAIR, k))
    point = F.transform(seen, lambda s: F.struct(of(s, 1, 2, "S", 1).alias("lat"), of(s, 3, 4, "W", 2).alias("lon"), F.coalesce(s["named"] | s["pair"], F.lit(False)).alias("looks")))
    ok = lambda p: F.coalesce(p["lat"].between(-90, 90) & p["lon"].between(-180, 180), F.lit(False))
    return F.transform(point, lambda p: F.struct(p["lat"].alias("lat"), p["lon"].alias("lon"), p["looks"].alias("looks"), ok(p).alias("valid")))


def coordinates(c: Column) -> Column:
    """Struct ``(lat, lon, looks, valid)``; nulls if no writing is found in the text."""
    return _read_coordinates(c)[0]


def with_coordinates(rows: DataFrame, column: str) -> DataFrame:
    """Adds ``lat``, ``lon``, ``looks`` and ``valid`` of a text column; inlined, so that the text is searched once."""
    return rows.select("*", F.inline(_read_coordinates(F.coalesce(F.col(column), F.lit("")))))


def great_circle(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Degrees of arc between two points."""
    dlat, dlon = F.radians(lat2 - lat1) / 2, F.radians(lon2 - lon1) / 2
    h = F.pow(F.sin(dlat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon), 2)
    return F.degrees(2 * F.asin(F.least(F.lit(1.0), F.sqrt(h))))


def _cell(lat: Column, lon: Column) -> list[Column]:
    return [F.least(F.floor(lat + 90), F.lit(179)).cast("int").alias("r"), F.pmod(F.floor(lon + 180), F.lit(360)).cast("int").alias("c")]


def _unit(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    lat, lon = np.radians(lat), np.radians(lon)
    return np.stack([np.cos(lat) * np.cos(lon), np.cos(lat) * np.sin(lon), np.sin(lat)], axis=1)


def _cells_to_visit(cells: np.ndarray):
    """Arrow stage over ``(lat, lon, degrees, ...)``: the cells that may hold a place nearer than the one known so far."""
    centre = _unit(cells[:, 0] - 89.5, cells[:, 1] - 179.5)
    reach = 0.7072  # no point of a cell is farther from its centre, in degrees

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, 2_000_000 // max(1, len(cells)))
        for batch in batches:
            for lo in range(0, batch.num_rows, step):
                b = batch.slice(lo, step)
                lat, lon, known = (np.asarray(b.column(i).fill_null(np.inf)) for i in range(3))
                far = np.degrees(np.arccos(np.clip(_unit(lat, lon) @ centre.T, -1, 1)))
                bound = np.minimum(far.min(axis=1, initial=np.inf) + reach, known) + 1e-6
                # what is known within the cells around is final up to their edge
                edge = np.degrees(np.arcsin(np.sin(np.radians(1.0)) * np.cos(np.radians(lat))))
                open_ = known > np.minimum(1.0, edge)
                at, cell = np.nonzero((far - reach <= bound[:, None]) & open_[:, None])
                yield pa.record_batch([b.column(0).take(pa.array(at)), b.column(1).take(pa.array(at)), pa.array(cells[cell, 0], pa.int32()), pa.array(cells[cell, 1], pa.int32())], names=["lat", "lon", "r", "c"])

    return run


def nearest_place(points: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """``(lat, lon, place, country, degrees)`` of the nearest place of each distinct point; exact, whatever the distance.

    Points meet the places of the 3 x 3 cells of one degree around them; a hit nearer than the edge of those is final. Every
    other point goes on to the cells, of at most 64,800, whose nearest edge is not beyond what is known or the farthest edge of
    the cell that is nearest: one of them holds its place. Points outside the usual ranges, null ones and, without any
    place, all points give no row.
    """
    points = points.select("lat", "lon").filter("lat between -90 and 90 and lon between -180 and 180").distinct()
    places = gazetteer.filter("lat is not null and lon is not null").select("place", "country", F.col("lat").alias("__a"), F.col("lon").alias("__o"), *_cell(F.col("lat"), F.col("lon")))
    taken = places.select("r", "c").distinct().toArrow()  # one row per cell of the globe at most
    cells = np.stack([np.asarray(taken.column(0)), np.asarray(taken.column(1))], axis=1).astype(np.int64)
    held = dimension(places)
    met = F.when(F.col("__a").isNotNull(), F.struct(great_circle(F.col("lat"), F.col("lon"), F.col("__a"), F.col("__o")).alias("degrees"), "place", "country")).alias("b")
    r, c = _cell(F.col("lat"), F.col("lon"))
    around = F.array(*[F.struct((r + i).cast("int").alias("r"), F.pmod(c + j, F.lit(360)).cast("int").alias("c")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    # read twice below from one shuffle
    near = points.select("lat", "lon", F.inline(around)).join(held, ["r", "c"], "left").groupBy("lat", "lon").agg(F.min(met).alias("b"))
    more = near.select("lat", "lon", "b.degrees").mapInArrow(_cells_to_visit(cells), "lat double, lon double, r int, c int")
    far = more.join(held, ["r", "c"]).select("lat", "lon", met)
    both = near.filter("b is not null").unionByName(far).groupBy("lat", "lon").agg(F.min("b").alias("b"))
    return both.select("lat", "lon", "b.place", "b.country", "b.degrees")


def country_tokens(c: Column) -> Column:
    """Trimmed parts between colons, commas and semicolons, without blank ones."""
    return F.filter(F.transform(F.split(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " "), "[:;,]"), lambda x: F.trim(x)), lambda x: x != "")


def lookup_countries(values: DataFrame, aliases: DataFrame, value: str = "value") -> DataFrame:
    """``(value, country, continent, un_region)`` of the distinct values one of whose parts is a known name; the first part wins."""
    parts = values.select(value).distinct().select(value, F.posexplode(country_tokens(F.col(value))).alias("pos", "token"))
    known = dimension(aliases.select(F.lower("alias").alias("__t"), "country", "continent", "un_region").dropDuplicates(["__t"]))
    hit = parts.join(known, F.lower("token") == F.col("__t"))
    return hit.groupBy(value).agg(F.min(F.struct("pos", "country", "continent", "un_region")).alias("b")).select(value, "b.country", "b.continent", "b.un_region")


def to_official(rows: DataFrame, remap: DataFrame, official: DataFrame, country: str = "country") -> DataFrame:
    """Adds ``official``: the mapped name if the official list has it, else null, and ``unmappable``."""
    m = dimension(remap.select(F.col("country").alias(country), "mapped").dropDuplicates([country]))
    names = dimension(official.select(F.col("name").alias("__o")).distinct())
    j = rows.join(m, country, "left").withColumn("__m", F.coalesce("mapped", country)).drop("mapped").join(names, F.col("__m") == F.col("__o"), "left")
    return j.withColumn("official", F.col("__o")).withColumn("unmappable", F.col(country).isNotNull() & F.col("__o").isNull()).drop("__m", "__o")


def standardize_places(cands: DataFrame, aliases: DataFrame, gazetteer: DataFrame, remap: DataFrame, official: DataFrame, hints: Sequence[str] = ()) -> DataFrame:
    """Location of each record of ``cands (record, pos, attribute, value)``.

    Coordinates, or values under an attribute of ``hints``, are decoded and never read as names. The first match with a
    sublocation is taken, else the first match. Records without any match and with unread names give their pairs as
    ``request`` for a model; with neither they are unresolved. Blank values are left out.
    """
    rows = cands.select("record", "pos", S.strip(F.coalesce("attribute", F.lit(""))).alias("attribute"), S.strip(F.col("value")).alias("value")).filter("value <> ''")
    hinted = F.col("attribute").isin(*hints) if hints else F.lit(False)
    c = with_coordinates(rows, "value").withColumn("by_point", F.col("looks") | hinted).withColumn("part", S.split_place(F.col("value")))
    points = c.filter("by_point and valid").select("record", "pos", "lat", "lon")
    decoded = points.join(nearest_place(points, gazetteer), ["lat", "lon"]).select("record", "pos", "country", F.col("place").alias("sublocation"), F.lit("coordinate_resolution").alias("how"))
    names = c.filter("not by_point").select("record", "pos", "attribute", "value", S.strip(F.col("part.country_part")).alias("name"), F.nullif(S.strip(F.col("part.sublocation")), F.lit("")).alias("sublocation"))
    found = names.join(lookup_countries(names, aliases, "name"), "name")
    named = found.select("record", "pos", "country", "sublocation", F.lit("direct_resolution").alias("how"))
    matches = decoded.unionByName(named)
    picked = matches.groupBy("record").agg(F.min(F.struct(F.col("sublocation").isNull().alias("no_sub"), "pos", "country", "sublocation", "how")).alias("b")).select("record", "b.country", "b.sublocation", "b.how")
    pair = F.concat_ws("=", "attribute", "value")
    unread = names.join(found.select("record", "pos"), ["record", "pos"], "left_anti").groupBy("record").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", pair.alias("p")))), lambda x: x["p"]), " ").alias("pairs"))
    regions = dimension(aliases.select("country", "continent", "un_region").dropDuplicates(["country"]))
    out = cands.select("record").distinct().join(picked, "record", "left").join(unread, "record", "left").join(regions, "country", "left")
    out = to_official(out, remap, official)
    status = F.when(F.col("unmappable"), "unmappable_result").when(F.col("country").isNotNull(), F.col("how")).when(F.col("pairs").isNotNull(), "model_request").otherwise("unresolved_place")
    return out.select("record", F.col("official").alias("country"), F.when(F.col("official").isNotNull(), F.col("un_region")).alias("un_region"), "sublocation", status.alias("diagnostic"), F.when(F.col("country").isNull(), F.col("pairs")).alias("request"))


def place_replies(answers: DataFrame, aliases: DataFrame, remap: DataFrame, official: DataFrame) -> DataFrame:
    """Locations of ``answers (record, reply, how)`` of a model: ``(record, country, diagnostic)``.

    A reply is one JSON object with a country; it is read as a known name if it is one, then mapped to the official list.
    """
    from sampleloom.operators.model_requests import valid_country

    a = answers.select("record", "how", "reply", valid_country(F.col("reply")).alias("said"))
    known = lookup_countries(a.filter("said is not null"), aliases, "said").select("said", F.col("country").alias("__c"))
    named = a.join(known, "said", "left").withColumn("country", F.when(F.col("said") != NA, F.coalesce("__c", "said"))).drop("__c")
    out = to_official(named, remap, official)
    status = (
        F.when(F.col("how") == "disabled", "llm_disabled").when(F.col("how") == "failed", "recoverable_llm_failure").when(F.col("said").isNull(), "invalid_llm_response")
        .when(F.col("said") == NA, F.when(F.col("how") == "cache", "unresolved_place").otherwise("unmappable_result")).when(F.col("unmappable"), "unmappable_result")
        .when(F.col("how") == "call", "llm_resolution").otherwise("cache_resolution")
    )
    return out.select("record", F.col("official").alias("country"), status.alias("diagnostic"))
