"""Reported collection dates as calendar bounds with a reliability score.

Everything is a column expression, so a record's candidates are interpreted inside its row and nothing is shuffled.
Digits are ASCII digits. A result is a struct: ``status`` is ok, rejected (recognised but not usable) or unsupported.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

MIN_YEAR = 1800
FALLBACK_SCORE = 0.1
# Month names, their short forms and the scores of the date forms.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
MONTH_NUMBERS = {**{m[:3]: i for i, m in enumerate(MONTHS, 1)}, **{m: i for i, m in enumerate(MONTHS, 1)}, "sept": 9}
YEAR_SCORE, MONTH_SCORE, DAY_SCORE, AMBIGUOUS_SCORE = 0.8, 0.9, 1.0, 0.7
WIDTH_SCORES = ((1, 0.6), (3, 0.5), (6, 0.4), (10, 0.3))
WIDEST_SCORE = 0.2

_MON = "(?i:" + "|".join(sorted(MONTH_NUMBERS, key=lambda m: (-len(m), m))) + ")"
# The date forms, by id.
FORMATS = {
    "year": r"[0-9]{4}",
    "year_month": r"[0-9]{4}[-/][0-9]{2}",
    "month_year": r"[0-9]{2}[-/][0-9]{4}",
    "named_month_year": rf"{_MON}[ -][0-9]{{4}}",
    "year_first_day": r"[0-9]{4}(?:-[0-9]{2}-|/[0-9]{2}/)[0-9]{2}",
    "named_month_day": rf"{_MON} [0-9]{{1,2}},\s*[0-9]{{4}}",
    "day_named_month": rf"[0-9]{{1,2}}-{_MON}-[0-9]{{4}}",
    "numeric_year_last_day": r"[0-9]{1,2}(?:-[0-9]{1,2}-|/[0-9]{1,2}/)[0-9]{4}",
}
_HOUR, _ZONE = r"(?:[01][0-9]|2[0-3])", r"(?:Z|[+-](?:[01][0-9]|2[0-3]):?[0-5][0-9])?"
TIME_SUFFIX = rf"(?:{_HOUR}:[0-5][0-9](?::[0-5][0-9](?:\.[0-9]+)?)?|{_HOUR}\.[0-5][0-9]\.[0-5][0-9](?:\.[0-9]+)?){_ZONE}"
JOIN = r"\s+(?i:to|-)\s+"
JOIN_CLAIM = r"(?:^|\s)(?i:to|-)(?=\s|\z)"

INTERPRETATION = "struct<status:string,start:date,end:date,score:double,format_id:string,notices:array<string>,reason:string,context:string>"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\A\s+|\s+\z", "")


def _whole(c: Column, pattern: str) -> Column:
    return c.rlike(rf"\A(?:{pattern})\z")


def format_id(c: Column) -> Column:
    """Id of the one date form that ``c`` has, else null."""
    return reduce(lambda acc, kv: acc.when(_whole(c, kv[1]), kv[0]), list(FORMATS.items())[1:], F.when(_whole(c, FORMATS["year"]), "year"))


def _day(y: Column, m: Column, d: Column) -> Column:
    pad = lambda c, n: F.lpad(c.cast("string"), n, "0")
    # ANSI make_date raises and accepts year 0; the guarded parse gives null instead
    return F.when(y >= 1, F.try_to_date(F.concat_ws("-", pad(y, 4), pad(m, 2), pad(d, 2)), "yyyy-MM-dd"))


def _number(c: Column) -> Column:
    return F.when(c != "", c.cast("int"))


def _shape(x: Column) -> Column:
    """Text to read, its form and whether a malformed time was cut off."""
    v = strip(x)
    own = format_id(v)
    base, suffix = F.substring_index(v, "T", 1), F.regexp_replace(v, r"\A[^T]*T", "")
    of_base = F.when(own.isNull() & v.contains("T") & ~suffix.contains("/") & ~suffix.rlike(JOIN_CLAIM), format_id(base))
    return F.struct(
        F.when(of_base.isNotNull(), base).otherwise(v).alias("text"),
        F.coalesce(own, of_base).alias("form"),
        (of_base.isNotNull() & ~_whole(suffix, TIME_SUFFIX)).alias("cut"),
    )


def _numbers(s: Column) -> Column:
    text = s["text"]
    rest = F.regexp_replace(text, r"[0-9]{4}", "")
    month = F.regexp_extract(F.lower(text), r"([a-z]+)", 1)
    names = F.create_map(*[F.lit(x) for kv in MONTH_NUMBERS.items() for x in kv])
    return F.struct(
        s["form"].alias("form"),
        s["cut"].alias("cut"),
        _number(F.regexp_extract(text, r"([0-9]{4})", 1)).alias("y"),
        F.try_element_at(names, month).alias("named"),
        _number(F.regexp_extract(rest, r"([0-9]{1,2})", 1)).alias("a"),
        _number(F.regexp_extract(rest, r"[0-9]{1,2}[^0-9]+([0-9]{1,2})", 1)).alias("b"),
    )


def _readings(n: Column) -> Column:
    form, y, a, b = n["form"], n["y"], n["a"], n["b"]
    one = F.lit(1)
    month = F.when(form.isin("named_month_year", "named_month_day", "day_named_month"), n["named"]).otherwise(a)
    first = (
        F.when(form == "year", _day(y, one, one))
        .when(form.isin("year_month", "month_year", "named_month_year"), _day(y, month, one))
        .when(form == "year_first_day", _day(y, a, b))
        .when(form.isin("named_month_day", "day_named_month"), _day(y, month, a))
        .when(form == "numeric_year_last_day", _day(y, b, a))
    )
    other = F.when(form == "numeric_year_last_day", _day(y, a, b))
    return F.struct(form.alias("form"), n["cut"].alias("cut"), y.alias("y"), first.alias("first"), other.alias("other"))


def _single(r: Column, ref: Column) -> Column:
    form, first, other = r["form"], r["first"], r["other"]
    start = F.coalesce(first, other)
    end = (
        F.when(form == "year", F.add_months(start, 12) - F.expr("INTERVAL 1 DAY"))
        .when(form.isin("year_month", "month_year", "named_month_year"), F.last_day(start))
        .otherwise(start)
    ).cast("date")
    score = (
        F.when(form == "year", YEAR_SCORE)
        .when(form.isin("year_month", "month_year", "named_month_year"), MONTH_SCORE)
        .when(first.isNotNull() & other.isNotNull() & (first != other), AMBIGUOUS_SCORE)
        .otherwise(DAY_SCORE)
    )
    reason = (
        F.when(form.isNull(), "unsupported_format")
        .when(start.isNull(), "invalid_calendar_date")
        .when(F.year(end) < MIN_YEAR, "before_supported_year")
        .when(start > ref, "after_metadata_reference_date")
    )
    ok = reason.isNull()
    return F.struct(
        F.when(ok, "ok").when(form.isNull(), "unsupported").otherwise("rejected").alias("status"),
        F.when(ok, start).alias("start"),
        F.when(ok, end).alias("end"),
        F.when(ok, score).alias("score"),
        F.when(ok, form).alias("format_id"),
        F.when(ok & r["cut"], F.array(F.lit("malformed_time_suffix_ignored"))).otherwise(F.array().cast("array<string>")).alias("notices"),
        reason.alias("reason"),
        F.lit(None).cast("string").alias("context"),
    )


def _singles(texts: Column, ref: Column) -> Column:
    """Each text of an array as a single date; the steps are separate maps, so each subexpression runs once."""
    for step in (_shape, _numbers, _readings):
        texts = F.transform(texts, step)
    return F.transform(texts, lambda r: _single(r, ref))


def interpret_single(c: Column, reference_date: dt.date | Column) -> Column:
    """Struct with the bounds of one date; null and empty texts are unsupported."""
    ref = reference_date if isinstance(reference_date, Column) else F.lit(reference_date)
    return _singles(F.array(F.coalesce(c, F.lit(""))), ref)[0]


def width_score(start: Column, end: Column) -> Column:
    """Score of an interval by its width in anniversaries; 29 February has its anniversary on the 28th."""
    return reduce(lambda acc, ys: acc.when(end <= F.add_months(start, 12 * ys[0]), ys[1]), WIDTH_SCORES[1:], F.when(end <= F.add_months(start, 12), WIDTH_SCORES[0][1])).otherwise(WIDEST_SCORE)


def _rejection(reason: Column | str, context: str | None = None) -> Column:
    return F.struct(
        F.lit("rejected").alias("status"), F.lit(None).cast("date").alias("start"), F.lit(None).cast("date").alias("end"), F.lit(None).cast("double").alias("score"),
        F.lit(None).cast("string").alias("format_id"), F.array().cast("array<string>").alias("notices"),
        (reason if isinstance(reason, Column) else F.lit(reason)).alias("reason"), F.lit(context).cast("string").alias("context"),
    )


def _join_ends(a: Column, b: Column, form: str) -> Column:
    start, end = F.least(a["start"], b["start"]), F.greatest(a["end"], b["end"])
    same = (a["start"] == b["start"]) & (a["end"] == b["end"])
    notices = F.concat(a["notices"], b["notices"])
    ok = F.struct(
        F.lit("ok").alias("status"), start.alias("start"), end.alias("end"),
        F.when(same, F.least(a["score"], b["score"])).otherwise(width_score(start, end)).alias("score"), F.lit(form).alias("format_id"),
        F.when(a["start"] > b["end"], F.concat(notices, F.array(F.lit("reversed_interval_normalized")))).otherwise(notices).alias("notices"),
        F.lit(None).cast("string").alias("reason"), F.lit(None).cast("string").alias("context"),
    )
    return F.when(a["status"] != "ok", _rejection(a["reason"], "start")).when(b["status"] != "ok", _rejection(b["reason"], "end")).otherwise(ok)


def _interpretations(values: Column, ref: Column) -> Column:
    def cut(value: Column) -> Column:
        v = strip(F.coalesce(value, F.lit("")))
        joins = F.size(F.split(v, JOIN, -1)) - 1
        halves = F.split(v, JOIN, 2)
        joined = joins == 1
        short = _whole(v, r"[0-9]{4}-[0-9]{2}")
        y, suffix = F.substring(v, 1, 4), F.substring(v, 6, 2)
        until = F.concat(F.substring(v, 1, 2), suffix)
        abbreviated = short & (suffix >= "13") & (until >= y)
        slashes = F.filter(F.sequence(F.lit(1), F.greatest(F.length(v), F.lit(1))), lambda i: F.substring(v, i, F.lit(1)) == "/")
        none = F.array().cast("array<string>")
        ends = (
            F.when(abbreviated, F.array(y, until))
            .when(joined, F.array(halves[0], halves[1]))
            .otherwise(F.flatten(F.transform(slashes, lambda i: F.array(F.substring(v, F.lit(1), i - 1), F.substring(v, i + 1, F.length(v))))))
        )
        kind = F.when(abbreviated, "abbreviated").when(joined, "joined").when((joins > 1) | v.rlike(JOIN_CLAIM), "claimed").otherwise("slashes")
        return F.struct(kind.alias("kind"), F.concat(F.array(v), F.when(kind == "claimed", none).otherwise(ends)).alias("texts"))

    def parse(c: Column) -> Column:
        return F.struct(c["kind"].alias("kind"), _singles(c["texts"], ref).alias("got"))

    def pairs(p: Column) -> Column:
        """Recognised decompositions at slashes, those with two usable ends first choice."""
        got = p["got"]
        n = F.floor((F.size(got) - 1) / 2).cast("int")
        at = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
        every = F.transform(at, lambda i: F.struct(got[i * 2 - 1].alias("a"), got[i * 2].alias("b")))
        known = F.filter(every, lambda x: (x["a"]["status"] != "unsupported") & (x["b"]["status"] != "unsupported"))
        usable = F.filter(known, lambda x: (x["a"]["status"] == "ok") & (x["b"]["status"] == "ok"))
        return F.struct(
            p["kind"].alias("kind"), got[0].alias("whole"), F.when(F.size(usable) > 0, usable).otherwise(known).alias("best"), F.try_element_at(every, F.lit(1)).alias("only"),
            F.exists(every, lambda x: (x["a"]["status"] != "unsupported") | (x["b"]["status"] != "unsupported")).alias("claimed"),
        )

    def decide(q: Column) -> Column:
        kind, whole, best, only = q["kind"], q["whole"], q["best"], q["only"]
        return (
            F.when(whole["status"] == "ok", whole)
            .when(kind == "abbreviated", _join_ends(only["a"], only["b"], "abbreviated_year_interval"))
            .when(kind == "joined", _join_ends(only["a"], only["b"], "explicit_interval"))
            .when(kind == "claimed", _rejection("invalid_interval_structure"))
            .when(F.size(best) == 1, _join_ends(best[0]["a"], best[0]["b"], "explicit_interval"))
            .when(F.size(best) > 1, _rejection("invalid_interval_structure"))
            .when(whole["status"] == "rejected", whole)
            .when(q["claimed"], _rejection("invalid_interval_structure"))
            .otherwise(whole)
        )

    for step in (cut, parse, pairs, decide):
        values = F.transform(values, step)
    return values


def interpret(c: Column, reference_date: dt.date | Column) -> Column:
    """Struct with the bounds of a date or interval, or the reason of its rejection. Null counts as the empty text."""
    ref = reference_date if isinstance(reference_date, Column) else F.lit(reference_date)
    return _interpretations(F.array(c), ref)[0]


def standardize_dates(candidates: Column, reference_date: dt.date | Column) -> Column:
    """Outcome of a record from ``array<struct<attribute,value,category>>`` in the order they were read.

    Usable sampling candidates (category ``s``) win over fallback ones (``o``): equal bounds collapse to the first with
    the least score, different bounds combine to their envelope with all distinct origins. Of fallback candidates the one
    that starts first is taken, with the fallback score. A null or empty array has no usable candidate.
    """
    ref = reference_date if isinstance(reference_date, Column) else F.lit(reference_date)
    cands = F.coalesce(candidates, F.array().cast("array<struct<attribute:string,value:string,category:string>>"))
    parsed = F.zip_with(cands, _interpretations(F.transform(cands, lambda c: c["value"]), ref), lambda c, r: F.struct(c.alias("c"), r.alias("r")))

    def split(p: Column) -> Column:
        usable = lambda cat: F.filter(p, lambda x: (x["r"]["status"] == "ok") & (x["c"]["category"] == cat))
        return F.struct(
            usable("s").alias("s"), usable("o").alias("o"), F.filter(F.transform(p, lambda x: x["r"]["reason"]), lambda x: x.isNotNull()).alias("rejections"),
            F.flatten(F.transform(p, lambda x: x["r"]["notices"])).alias("notices"),
        )

    # the parsed candidates are bound to a variable, so they are computed once
    return F.transform(F.transform(F.array(parsed), split), _choose)[0]


def _choose(x: Column) -> Column:
    s, o = x["s"], x["o"]
    bounds = F.array_distinct(F.transform(s, lambda p: F.struct(p["r"]["start"], p["r"]["end"])))
    start, end = F.array_min(F.transform(s, lambda p: p["r"]["start"])), F.array_max(F.transform(s, lambda p: p["r"]["end"]))
    conflict = F.size(bounds) > 1
    # the first of those that start first
    early = F.array_min(F.transform(o, lambda p, i: F.struct(p["r"]["start"].alias("start"), i.alias("i"))))["i"]
    origin = lambda p: F.struct(p["c"]["attribute"].alias("attribute"), p["c"]["value"].alias("value"))
    none = F.array().cast("array<struct<attribute:string,value:string>>")
    sampled, fallback = F.size(s) > 0, F.size(o) > 0
    pick = F.try_element_at(o, early + 1)
    return F.struct(
        F.when(sampled, start).when(fallback, pick["r"]["start"]).alias("start"),
        F.when(sampled, end).when(fallback, pick["r"]["end"]).alias("end"),
        F.when(sampled & conflict, width_score(start, end)).when(sampled, F.array_min(F.transform(s, lambda p: p["r"]["score"]))).when(fallback, FALLBACK_SCORE).alias("score"),
        F.when(sampled & conflict, F.array_distinct(F.transform(s, origin))).when(sampled, F.array(origin(s[0]))).when(fallback, F.array(origin(pick))).otherwise(none).alias("origins"),
        F.concat(
            F.when(sampled & conflict, F.array(F.lit("conflicting_candidate_combination"))).when(F.size(s) > 1, F.array(F.lit("equivalent_candidate_collapse"))).otherwise(F.array().cast("array<string>")),
            F.array(F.when(sampled, "sampling_selection").when(fallback, "fallback_selection").otherwise("no_usable_candidate")),
        ).alias("diagnostics"),
        x["rejections"].alias("rejections"),
        x["notices"].alias("notices"),
    )
