"""Text normal forms.

*presentation*: NFKC, case folding, trimming, one outer pair of equal quotes removed, white space collapsed.
*full*: presentation with every run of non-word characters or underscores as one space.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_NON_WORD = re.compile(r"[\W_]+")
#: ASCII characters that Python treats as white space, as a Java character class.
ASCII_SPACE = r"[\x09-\x0d\x1c-\x20]"
ASCII_ONLY = r"\A[\x00-\x7f]*\z"


def presentation(value: str) -> str:
    s = unicodedata.normalize("NFKC", value).casefold().strip()
    if len(s) > 1 and s[0] in "'\"" and s[0] == s[-1]:
        s = s[1:-1]
    return " ".join(s.split())


def full(value: str) -> str:
    return _NON_WORD.sub(" ", presentation(value)).strip()


def not_blank(c: Column) -> Column:
    """True if there is anything but white space; false for null."""
    return F.coalesce(c.rlike(r"(?U)\S"), F.lit(False))


def _unicode_form(form: Callable[[str], str]):
    @F.pandas_udf("string")
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            known = {v: form(v) for v in s.dropna().unique()}
            yield pd.Series([known.get(v) for v in s], dtype=object)

    return apply


def _ascii_presentation(c: Column) -> Column:
    trim = lambda x: F.regexp_replace(x, rf"\A{ASCII_SPACE}+|{ASCII_SPACE}+\z", "")
    s = trim(F.lower(c))
    quoted = s.rlike(r"(?s)\A(?:'.*'|\".*\")\z")
    s = F.when(quoted & (F.length(s) > 1), F.substring(s, F.lit(2), F.length(s) - 2)).otherwise(s)
    return F.regexp_replace(trim(s), f"{ASCII_SPACE}+", " ")


def presentation_col(c: Column) -> Column:
    """Presentation form of a string column. ASCII values stay in the JVM; only the others pass through Arrow."""
    plain = c.rlike(ASCII_ONLY)
    rest = _unicode_form(presentation)(F.when(~plain, c))
    return F.when(plain, _ascii_presentation(c)).otherwise(rest)


def full_col(c: Column) -> Column:
    """Full form of a string column; see :func:`presentation_col`."""
    plain = c.rlike(ASCII_ONLY)
    rest = _unicode_form(full)(F.when(~plain, c))
    return F.when(plain, F.trim(F.regexp_replace(_ascii_presentation(c), r"[^0-9a-z]+", " "))).otherwise(rest)
