"""Reading one free-text value as an integer, decimal, boolean, calendar day or text."""

from __future__ import annotations

import datetime
import re
import unicodedata
from decimal import Decimal, InvalidOperation

# Words, letters and digits that say yes or no.
YES = frozenset("yes y true t 1 on".split())
NO = frozenset("no n false f 0 off".split())
# English month names.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
MONTH_NO = {m: i for i, m in enumerate(MONTHS, 1)} | {m[:3]: i for i, m in enumerate(MONTHS, 1)} | {"sept": 9}

_SEP = "[ ']"  # NFKC has made other spaces plain
_GROUPED = re.compile(rf"([+-]?)(\d{{1,3}})((?:,\d{{3}})+|(?:{_SEP}\d{{3}})+)(\.\d*)?(?:[eE]([+-]?\d+))?")
_DOT_GROUPED = re.compile(r"([+-]?)(\d{1,3})((?:\.\d{3}){2,}|(?:\.\d{3})+(?=,))(,\d*)?")
_PLAIN = re.compile(r"[+-]?(?:\d+[.,]?\d*|[.,]\d+)(?:[eE][+-]?\d+)?")
_INT64 = 2**63
_DEC_LIMIT = Decimal(10) ** 35

_YMD = re.compile(r"(\d{4})([-/.])(\d{1,2})\2(\d{1,2})")
_COMPACT = re.compile(r"(\d{4})(\d{2})(\d{2})")
_DMY = re.compile(r"(\d{1,2})([-/.])(\d{1,2})\2(\d{4})")
_D_MON_Y = re.compile(r"(\d{1,2})(?:st|nd|rd|th)?[- ./]([a-z]+)\.?,?[- ./](\d{4})")
_MON_D_Y = re.compile(r"([a-z]+)\.? (\d{1,2})(?:st|nd|rd|th)?,? (\d{4})")


def plain_digits(value: str) -> str:
    """NFKC with every decimal digit of any script as 0-9 and every minus sign as ``-``."""
    s = unicodedata.normalize("NFKC", value)
    if not s.isascii():
        s = "".join(str(unicodedata.decimal(ch)) if ch.isdecimal() else "-" if ch in "−‐‑‒–﹣" else "'" if ch == "’" else ch for ch in s)
    return s


def unquote(value: str) -> str:
    s = value.strip()
    while len(s) > 1 and s[0] == s[-1] and s[0] in "'\"":
        s = s[1:-1].strip()
    return s


def read_number(value: str, unit: str | None, whole: bool) -> Decimal | None:
    """The one exact number that ``value`` is, or None. A lone comma groups digits in whole numbers and splits decimals."""
    s = unquote(plain_digits(value))
    if unit and s.lower().endswith(unit.lower()):
        s = unquote(s[: -len(unit)])
    if m := _GROUPED.fullmatch(s):
        sign, head, groups, frac, exp = m.groups()
        if groups[0] != "," or whole or frac or len(groups) > 4:
            digits = head + re.sub(r"\D", "", groups)
            return _decimal(f"{sign}{digits}{frac or ''}" + (f"e{exp}" if exp else ""))
    if m := _DOT_GROUPED.fullmatch(s):
        sign, head, groups, frac = m.groups()
        return _decimal(sign + head + groups.replace(".", "") + (frac or "").replace(",", "."))
    if _PLAIN.fullmatch(s):
        return _decimal(s.replace(",", "."))
    return None


def _decimal(s: str) -> Decimal | None:
    try:
        d = Decimal(s)
        return d if d.is_finite() and d.copy_abs() < _DEC_LIMIT else None
    except InvalidOperation:
        return None


def read_integer(value: str, unit: str | None) -> str | None:
    d = read_number(value, unit, True)
    if d is None or d != d.to_integral_value() or not -_INT64 <= d < _INT64:
        return None
    return str(int(d))


def read_decimal(value: str, unit: str | None) -> str | None:
    d = read_number(value, unit, False)
    if d is None:
        return None
    text = f"{d:.3f}"
    if len(text.lstrip("-")) > 39:  # rounded up to one digit too many
        return None
    return text[1:] if text.startswith("-") and not float(text) else text


def read_boolean(value: str) -> str | None:
    s = unquote(plain_digits(value)).casefold()
    return "true" if s in YES else "false" if s in NO else None


def day(y: int, m: int, d: int) -> datetime.date | None:
    try:
        return datetime.date(y, m, d)
    except ValueError:
        return None


def read_day(value: str) -> datetime.date | None:
    """The calendar day that ``value`` writes; in numeric dates that end with the year the day comes first if that is possible."""
    s = " ".join(unquote(plain_digits(value)).casefold().split())
    if m := _YMD.fullmatch(s):
        return day(int(m[1]), int(m[3]), int(m[4]))
    if m := _COMPACT.fullmatch(s):
        return day(int(m[1]), int(m[2]), int(m[3]))
    if m := _DMY.fullmatch(s):
        return day(int(m[4]), int(m[3]), int(m[1])) or day(int(m[4]), int(m[1]), int(m[3]))
    if (m := _D_MON_Y.fullmatch(s)) and m[2] in MONTH_NO:
        return day(int(m[3]), MONTH_NO[m[2]], int(m[1]))
    if (m := _MON_D_Y.fullmatch(s)) and m[1] in MONTH_NO:
        return day(int(m[3]), MONTH_NO[m[1]], int(m[2]))
    return None


def read_text(value: str) -> str:
    return " ".join(value.split())


def read_as(value: str, value_type: str, unit: str | None) -> str | None:
    """``value`` as the text of its type, or None if it cannot be read as that type."""
    if value_type == "integer":
        return read_integer(value, unit)
    if value_type == "decimal":
        return read_decimal(value, unit)
    if value_type == "boolean":
        return read_boolean(value)
    if value_type == "date":
        d = read_day(value)
        return d and d.isoformat()
    return read_text(value)
