"""Written times of many formats, precisions and zones as ranges of UTC seconds.

Each value goes through an ordered cascade of anchored patterns with strict parsing. A zone of its own wins over the
default zone of its source. Policy for local times: a time that the clock shows twice means both readings, a time that
the clock skips means nothing.

The first steps of the cascade are array kernels over the bytes of a whole batch: counts since 1970 and numeric dates of
full width with or without a 24-hour clock, a fraction and an offset. They take a value only if all its parts are valid and,
for local times, if the clock shows it exactly once; every other value goes on to the patterns.
"""

from __future__ import annotations

import calendar
import datetime as dt
import re
from collections.abc import Iterator
from functools import lru_cache
from zoneinfo import ZoneInfo

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sampleloom.operators.typed_values import MONTH_NO, day

# Zone abbreviations and their offsets in minutes.
ABBREVIATIONS = {
    "utc": 0, "gmt": 0, "ut": 0, "z": 0, "wet": 0, "west": 60, "bst": 60, "cet": 60, "cest": 120, "eet": 120, "eest": 180, "msk": 180,
    "est": -300, "edt": -240, "cst": -360, "cdt": -300, "mst": -420, "mdt": -360, "pst": -480, "pdt": -420, "ast": -240, "adt": -180,
    "akst": -540, "akdt": -480, "hst": -600, "ist": 330, "npt": 345, "jst": 540, "kst": 540, "eat": 180, "cat": 120, "wat": 60, "sast": 120,
    "aest": 600, "aedt": 660, "acst": 570, "acdt": 630, "awst": 480, "lhst": 630, "lhdt": 660, "nzst": 720, "nzdt": 780,
}
# Digits of a count since 1970 and the units in a second.
COUNTS = ((re.compile(r"-?\d{9,10}(?:\.\d+)?"), 1), (re.compile(r"-?\d{13}"), 10**3), (re.compile(r"-?\d{16}"), 10**6), (re.compile(r"-?\d{19}"), 10**9))
WEEKDAYS = ("mon", "tue", "wed", "thu", "fri", "sat", "sun")

_ZONE = r"(?P<zone>\s*(?:z|[+-]\d{2}(?::?\d{2})?)|\s+[a-z]{2,5})?(?P<name>\s*\[[a-z_]+(?:/[a-z_+\-0-9]+)*\]|\s+[a-z_]+(?:/[a-z_+\-0-9]+)+)?"
_CLOCK = r"(?P<h>\d{1,2}):(?P<mi>\d{2})(?::(?P<s>\d{2})(?:[.,]\d+)?)?(?:\s*(?P<ap>[ap])\.?m\.?)?"
_DAYS = (
    ("ymd", r"(?P<y>\d{4})(?P<sep>[-/.])(?P<m>\d{1,2})(?P=sep)(?P<d>\d{1,2})"),
    ("xxy", r"(?P<a>\d{1,2})(?P<sep>[-/.])(?P<b>\d{1,2})(?P=sep)(?P<y>\d{4})"),
    ("dMy", r"(?:(?P<w>[a-z]{3,9}),?\s+)?(?P<d>\d{1,2})(?P<sep>[-\s/])(?P<M>[a-z]{3,9})\.?,?(?P=sep)(?P<y>\d{4})"),
    ("Mdy", r"(?:(?P<w>[a-z]{3,9}),?\s+)?(?P<M>[a-z]{3,9})\.?\s+(?P<d>\d{1,2})(?:st|nd|rd|th)?,?\s+(?P<y>\d{4})"),
)
_TIMES = [re.compile(rf"{d}(?:\s*t\s*|,?\s+(?:at\s+)?){_CLOCK}{_ZONE}") for _, d in _DAYS]
_TIMES.append(re.compile(rf"(?P<y>\d{{4}})(?P<m>\d{{2}})(?P<d>\d{{2}})t?(?P<h>\d{{2}})(?P<mi>\d{{2}})(?:(?P<s>\d{{2}})(?:[.,]\d+)?)?{_ZONE}"))
_DATES = [re.compile(rf"{d}{_ZONE}") for _, d in _DAYS]
_DATES.append(re.compile(rf"(?P<y>\d{{4}})(?P<m>\d{{2}})(?P<d>\d{{2}}){_ZONE}"))
_DATES += [
    re.compile(r"(?P<y>\d{4})[-/.](?P<m>\d{1,2})"),
    re.compile(r"(?P<m>\d{1,2})[-/.](?P<y>\d{4})"),
    re.compile(r"(?P<M>[a-z]{3,9})\.?,?[-\s/](?P<y>\d{4})"),
    re.compile(r"(?P<y>\d{4})[-\s/](?P<M>[a-z]{3,9})"),
    re.compile(r"(?P<y>\d{4})"),
]
_JOINS = (re.compile(r"\s+(?:to|until|through|-|–|—)\s+"), re.compile(r"\s*(?:–|—|\.\.)\s*"), re.compile(r"\s*/\s*"))
_EPOCH = dt.datetime(1970, 1, 1)

Range = tuple[int, int]


@lru_cache(maxsize=1024)
def _zone(name: str) -> ZoneInfo | None:
    parts = name.split("/")
    tidy = "/".join("_".join(w[:1].upper() + w[1:] for w in p.split("_")) for p in parts)
    for key in (name, tidy, name.upper()):
        try:
            return ZoneInfo(key)
        except (KeyError, ValueError, OSError):
            continue
    return None


def _seconds(t: dt.datetime) -> int:
    return int((t - _EPOCH).total_seconds())


def _readings(t: dt.datetime, tz: ZoneInfo) -> list[int]:
    """UTC seconds at which the clock of ``tz`` shows ``t``: none, one or two."""
    early, late = t.replace(tzinfo=tz).utcoffset(), t.replace(tzinfo=tz, fold=1).utcoffset()
    if early == late:  # neither twice nor skipped
        return [_seconds(t - early)]
    found = []
    for off in (early, late):
        utc = t - off
        if (utc.replace(tzinfo=dt.timezone.utc).astimezone(tz)).replace(tzinfo=None) == t:
            s = _seconds(utc)
            if s not in found:
                found.append(s)
    return sorted(found)


def _local_range(first: dt.datetime, last: dt.datetime, tz: ZoneInfo) -> Range | None:
    a, b = _readings(first, tz), _readings(last, tz)
    if not a:  # the span begins in a gap: from the first second after it
        a = [_seconds(first - first.replace(tzinfo=tz, fold=1).utcoffset())]
        off = max(first.replace(tzinfo=tz, fold=f).utcoffset() for f in (0, 1)) - min(first.replace(tzinfo=tz, fold=f).utcoffset() for f in (0, 1))
        lo, hi = a[0] - int(off.total_seconds()), a[0] + int(off.total_seconds())
        show = lambda s: (dt.datetime.fromtimestamp(s, dt.timezone.utc).astimezone(tz)).replace(tzinfo=None)
        while hi - lo > 1:
            mid = (lo + hi) // 2
            lo, hi = (lo, mid) if show(mid) >= first else (mid, hi)
        a = [hi]
    if not b:
        b = [_seconds(last - last.replace(tzinfo=tz, fold=0).utcoffset())]
    return a[0], b[-1]


def _offset(g: dict[str, str | None]) -> int | ZoneInfo | None | bool:
    """Minutes of the value's own offset, its named zone, None without either, False if it is no zone."""
    z, name = (g.get("zone") or "").strip(), (g.get("name") or "").strip().strip("[]")
    if z:
        if z[0] in "+-":
            digits = z[1:].replace(":", "")
            h, m = int(digits[:2]), int(digits[2:] or 0)
            return (h * 60 + m) * (-1 if z[0] == "-" else 1) if h <= 14 and m < 60 else False
        return ABBREVIATIONS.get(z, False)
    if name:
        return ABBREVIATIONS[name] if name in ABBREVIATIONS else _zone(name) or False
    return None


def _date_of(g: dict[str, str | None]) -> tuple[dt.date, dt.date] | None:
    """First and last day that the date part can mean."""
    y = int(g["y"])
    if y < 1:
        return None
    if g.get("a"):
        a, b = int(g["a"]), int(g["b"])
        d = day(y, b, a) or day(y, a, b)
        return d and (d, d)
    if g.get("M"):
        month = MONTH_NO.get(g["M"])
        if not month:
            return None
    elif g.get("m"):
        month = int(g["m"])
        if not 1 <= month <= 12:
            return None
    else:
        return dt.date(y, 1, 1), dt.date(y, 12, 31)
    if g.get("d"):
        d = day(y, month, int(g["d"]))
        if d is None or (g.get("w") and WEEKDAYS[d.weekday()] != g["w"][:3]):
            return None
        return d, d
    return dt.date(y, month, 1), dt.date(y, month, calendar.monthrange(y, month)[1])


def _dates(s: str, default: ZoneInfo | None) -> Range | None:
    for p in _DATES:
        if m := p.fullmatch(s):
            g = m.groupdict()
            span = _date_of(g)
            if not span:
                continue
            first, last = dt.datetime.combine(span[0], dt.time()), dt.datetime.combine(span[1], dt.time(23, 59, 59))
            off = _offset(g)
            if off is False:
                return None
            if isinstance(off, int):
                return _seconds(first) - off * 60, _seconds(last) - off * 60
            tz = off or default
            return _local_range(first, last, tz) if tz else None
    return None


def _time(s: str, default: ZoneInfo | None) -> Range | None:
    for p in _TIMES:
        if m := p.fullmatch(s):
            g = m.groupdict()
            span = _date_of(g)
            if not span:
                return None
            h, mi, sec = int(g["h"]), int(g["mi"]), g.get("s")
            if ap := g.get("ap"):
                if not 1 <= h <= 12:
                    return None
                h = h % 12 + 12 * (ap == "p")
            if h > 23 or mi > 59 or int(sec or 0) > 59:
                return None
            t, more = dt.datetime.combine(span[0], dt.time(h, mi, int(sec or 0))), 0 if sec else 59
            off = _offset(g)
            if off is False:
                return None
            if isinstance(off, int):
                at = [_seconds(t) - off * 60]
            else:
                tz = off or default
                at = _readings(t, tz) if tz else []
            return (at[0], at[-1] + more) if at else None
    return None


def time_range(value: str | None, zone: str | None) -> Range | None:
    """First and last whole UTC second that ``value``, written in ``zone``, can mean; None if it means no time."""
    if value is None:
        return None
    s = " ".join(value.split()).lower()
    if not s or not any(ch.isdigit() for ch in s):
        return None
    s = s.replace("−", "-")
    for p, per_second in COUNTS:
        if p.fullmatch(s):
            n = int(s.split(".")[0]) // per_second
            return n, n
    default = _zone(zone) if zone else None
    try:
        if found := _time(s, default) or _dates(s, default):
            return found
        for p in _JOINS:
            if len(parts := p.split(s)) == 2 and all(parts):
                ends = [_time(x, default) or _dates(x, default) for x in parts]
                if all(ends):
                    return min(e[0] for e in ends), max(e[1] for e in ends)
    except OverflowError:
        return None
    return None


_WIDTH = 40
_DAY = 86_400


def _number(m: np.ndarray, at: int, n: int) -> np.ndarray:
    """Value of the ``n`` digits from column ``at``."""
    out = np.zeros(len(m), np.int64)
    for k in range(at, at + n):
        out = out * 10 + (m[:, k] - 48)
    return out


def _days(y: np.ndarray, mo: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Days since 1970 and whether there is such a day."""
    month = (y - 1970) * 12 + np.clip(mo, 1, 12) - 1
    first = month.astype("datetime64[M]").astype("datetime64[D]").astype(np.int64)
    length = (month + 1).astype("datetime64[M]").astype("datetime64[D]").astype(np.int64) - first
    return first + d - 1, (y > 0) & (mo > 0) & (mo < 13) & (d > 0) & (d <= length)


def _counts(m: np.ndarray, size: np.ndarray, digit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seconds of counts of 9, 10, 13, 16 or 18 digits without sign or fraction, and which values are such."""
    whole = digit.sum(axis=1) == size
    seconds, found = np.zeros(len(m), np.int64), np.zeros(len(m), bool)
    for n, per_second in ((9, 1), (10, 1), (13, 10**3), (16, 10**6)):
        here = whole & (size == n)
        seconds[here] = _number(m[here], 0, n) // per_second
        found |= here
    return seconds, found


def _own_offset(m: np.ndarray, size: np.ndarray, digit: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What stands from column ``at`` on: whether it is a zone or nothing, whether it is a zone, and its offset in seconds."""
    rest = size - at
    spaced = (np.take_along_axis(m, np.minimum(at, _WIDTH - 1)[:, None], 1)[:, 0] == 32) & (rest > 0)
    at, rest = at + spaced, rest - spaced
    cols = np.minimum(at[:, None] + np.arange(6), _WIDTH - 1)
    r, dg = np.take_along_axis(m, cols, 1), np.take_along_axis(digit, cols, 1)
    z = (rest == 1) & (r[:, 0] == 122)
    named = spaced & (rest == 3) & (((r[:, 0] == 117) & (r[:, 1] == 116) & (r[:, 2] == 99)) | ((r[:, 0] == 103) & (r[:, 1] == 109) & (r[:, 2] == 116)))
    signed = ((r[:, 0] == 43) | (r[:, 0] == 45)) & dg[:, 1] & dg[:, 2]
    colon = signed & (rest == 6) & (r[:, 3] == 58) & dg[:, 4] & dg[:, 5]
    plain = signed & (rest == 5) & dg[:, 3] & dg[:, 4]
    short = signed & (rest == 3)
    h = np.where(signed, (r[:, 1].astype(np.int64) - 48) * 10 + r[:, 2] - 48, 0)
    mi = np.where(colon, (r[:, 4].astype(np.int64) - 48) * 10 + r[:, 5] - 48, np.where(plain, (r[:, 3].astype(np.int64) - 48) * 10 + r[:, 4] - 48, 0))
    own = z | named | ((colon | plain | short) & (h <= 14) & (mi < 60))
    return own | ((rest == 0) & ~spaced), own, (h * 3600 + mi * 60) * np.where(r[:, 0] == 45, -1, 1)


def _numeric(m: np.ndarray, size: np.ndarray, digit: np.ndarray) -> tuple[np.ndarray, ...]:
    """First and last local second of numeric dates, whether they have their own offset, that offset, and which values are such."""
    n = len(m)
    mark = lambda c: (m[:, c] == 45) | (m[:, c] == 46) | (m[:, c] == 47)
    all_digits = lambda *cols: digit[:, list(cols)].all(axis=1)
    ymd = all_digits(0, 1, 2, 3, 5, 6, 8, 9) & mark(4) & (m[:, 4] == m[:, 7])
    dmy = all_digits(0, 1, 3, 4, 6, 7, 8, 9) & mark(2) & (m[:, 2] == m[:, 5])
    y = np.where(ymd, _number(m, 0, 4), _number(m, 6, 4))
    a, b = np.where(ymd, _number(m, 5, 2), _number(m, 3, 2)), np.where(ymd, _number(m, 8, 2), _number(m, 0, 2))
    y, a, b = (np.where(ymd | dmy, x, 1) for x in (y, a, b))
    day_no, ok = _days(y, a, b)
    other, other_ok = _days(y, b, a)
    swap = dmy & ~ok & other_ok
    day_no, ok = np.where(swap, other, day_no), ok | swap
    clock = ((m[:, 10] == 116) | (m[:, 10] == 32)) & all_digits(11, 12, 14, 15) & (m[:, 13] == 58)
    seconds = clock & (m[:, 16] == 58) & all_digits(17, 18)
    fraction = seconds & ((m[:, 19] == 46) | (m[:, 19] == 44)) & digit[:, 20]
    after = 20 + np.argmin(np.c_[digit[:, 20:], np.zeros(n, bool)], axis=1)
    at = np.where(fraction, after, np.where(seconds, 19, np.where(clock, 16, 10)))
    fits, own, offset = _own_offset(m, size, digit, at)
    h, mi, s = (np.where(x, _number(m, c, 2), 0) for x, c in ((clock, 11), (clock, 14), (seconds, 17)))
    ok &= (ymd | dmy) & fits & (h < 24) & (mi < 60) & (s < 60)
    first = day_no * _DAY + h * 3600 + mi * 60 + s
    last = first + np.where(seconds, 0, np.where(clock, 59, _DAY - 1))
    return first, last, own, offset, ok


def _offsets(local: np.ndarray, zones: list[str | None]) -> np.ndarray:
    """UTC offset in seconds of local times that the clock shows exactly once, else a great number."""
    none = dt.timedelta(days=9)
    known = {z: _zone(z) if z else None for z in set(zones)}
    times = local.astype("datetime64[s]").tolist()
    out = []
    for t, z in zip(times, zones):
        tz = known[z]
        if tz is None or not isinstance(t, dt.datetime):
            out.append(none)
            continue
        off = t.replace(tzinfo=tz).utcoffset()
        out.append(off if off == t.replace(tzinfo=tz, fold=1).utcoffset() else none)
    return np.array(out, "timedelta64[s]").astype(np.int64)


def plain_ranges(values: pa.Array, zones: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(from, to, found)`` of the values that the first steps of the cascade read."""
    n = len(values)
    first, last, found = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, bool)
    text = pc.utf8_lower(pc.utf8_trim_whitespace(values.cast(pa.large_string())))
    size = np.asarray(pc.fill_null(pc.binary_length(text), 0)).astype(np.int64)
    short = np.flatnonzero((size >= 9) & (size < _WIDTH))
    if not len(short):
        return first, last, found
    taken = text.take(pa.array(short))
    start, data = np.frombuffer(taken.buffers()[1], np.int64)[: len(short)], np.frombuffer(taken.buffers()[2], np.uint8)
    size = size[short]
    column = np.arange(_WIDTH)
    m = np.where(column < size[:, None], data[np.minimum(start[:, None] + column, len(data) - 1)], 0).astype(np.uint8)
    digit = (m >= 48) & (m <= 57)
    seconds, is_count = _counts(m, size, digit)
    lo, hi, own, offset, ok = _numeric(m, size, digit)
    ok &= ~is_count
    local = np.flatnonzero(ok & ~own)
    zone = zones.take(pa.array(short[local])).to_pylist()
    begin, end = _offsets(lo[local], zone), _offsets(hi[local], zone)
    once = (np.abs(begin) < _DAY) & (np.abs(end) < _DAY)
    ok[local[~once]] = False
    lo_off, hi_off = offset.copy(), offset.copy()
    lo_off[local], hi_off[local] = begin, end
    first[short], last[short], found[short] = np.where(is_count, seconds, lo - lo_off), np.where(is_count, seconds, hi - hi_off), is_count | ok
    return first, last, found


def _ranges(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    memo: dict[tuple[str, str | None], Range | None] = {}
    for values, zones in batches:
        if len(memo) > 200_000:
            memo.clear()
        first, last, found = plain_ranges(values, zones)
        rest = np.flatnonzero(~found & np.asarray(values.is_valid()))
        at = pa.array(rest)
        for i, v, z in zip(rest.tolist(), values.take(at).to_pylist(), zones.take(at).to_pylist()):
            if (v, z) not in memo:
                memo[v, z] = time_range(v, z)
            if (r := memo[v, z]) is not None:
                first[i], last[i], found[i] = *r, True
        yield pa.StructArray.from_arrays([pa.array(first, mask=~found), pa.array(last, mask=~found)], ["from_s", "to_s"])


def time_range_col(value: Column, zone: Column) -> Column:
    """Struct ``(from_s, to_s)`` of a written time; both null if the value means no time, is null or is no text of a time."""
    return F.arrow_udf(_ranges, "from_s long, to_s long")(value, zone)


def normalise_times(rows: DataFrame, sites: DataFrame, value: str, site: str = "site_id") -> DataFrame:
    """Adds ``from_s`` and ``to_s`` to ``rows``; the default zone comes from ``sites (site_id, time_zone)``, a dimension.

    Rows whose site is null or unknown keep values that have a zone of their own and get nulls for the others. Columns of
    ``rows`` may clash with those of ``sites``; only the dimension's zone is joined.
    """
    zone = sites.select(F.col("site_id").alias("__site"), F.col("time_zone").alias("__zone")).filter("__site is not null").dropDuplicates(["__site"])
    joined = rows.join(zone, rows[site] == F.col("__site"), "left")
    span = joined.withColumn("__span", time_range_col(F.col(value), F.col("__zone")))
    return span.select(*[F.col(f"`{c}`") for c in rows.columns], F.col("__span.from_s").alias("from_s"), F.col("__span.to_s").alias("to_s"))
