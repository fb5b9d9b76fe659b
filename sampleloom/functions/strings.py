"""String operators of the harmonisation pipeline, as column expressions."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator, Sequence
from functools import reduce
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# ASCII punctuation that host names lose.
PUNCTUATION = r"[!-/:-@\[-`{-~]"
# Elements whose text stands apart from its neighbours.
BLOCK_TAGS = (
    "article", "blockquote", "br", "dd", "div", "dl", "dt", "h1", "h2", "h3", "h4", "h5", "h6", "hr", "li", "ol", "p", "pre", "section", "table", "td", "th", "tr", "ul",
)
ONTOLOGY_ID = r"\b([A-Z]+:[0-9]+)\b"
_NONE = "array<string>"


def first_text(c: Column, listed: bool = False) -> Column:
    """The first text that is not blank, without white space around it: of a scalar, or of the items of a list; null without any."""
    return F.try_element_at(F.filter(F.transform(c, lambda x: strip(x.cast("string"))), lambda x: x.isNotNull() & (x != "")), F.lit(1)) if listed else F.nullif(strip(c.cast("string")), F.lit(""))


def none_of(kind: str = _NONE) -> Column:
    return F.array().cast(kind)


def squeeze(c: Column) -> Column:
    """Runs of white space as one space, trimmed."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def strip(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(c, r"(?U)\A[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", "")


def pipe_split(c: Column, trim: bool = False) -> Column:
    """Items between double pipes; null and empty texts hold none."""
    parts = F.when(c.isNull() | (c == ""), none_of()).otherwise(F.split(c, r"\|\|", -1))
    return F.transform(parts, lambda x: F.regexp_replace(x, r"(?U)\A\s+|\s+\z", "")) if trim else parts


def pipe_join(c: Column) -> Column:
    return F.array_join(c, "||")


def norm_keyword(c: Column) -> Column:
    """Lower case with underscores for spaces and hyphens."""
    return F.translate(F.lower(c), " -", "__")


def norm_host(c: Column) -> Column:
    """Lower case, underscores and hyphens as spaces, without punctuation, white space collapsed; null is empty."""
    return squeeze(F.regexp_replace(F.translate(F.lower(F.coalesce(c, F.lit(""))), "_-", "  "), PUNCTUATION, ""))


def words_of(c: Column) -> Column:
    """Words of a normalised text; the empty text has none."""
    return F.when(c == "", none_of()).otherwise(F.split(c, " "))


def semi_split(c: Column) -> Column:
    """Trimmed items of a semicolon list, without blank ones and ``nan``; null holds none."""
    parts = F.transform(F.split(c, ";", -1), lambda x: F.regexp_replace(x, r"(?U)\A\s+|\s+\z", ""))
    return F.coalesce(F.filter(parts, lambda x: (x != "") & (F.lower(x) != "nan")), none_of())


def digit_variants(words: Column) -> Column:
    """Distinct words and those that are left when digits at either end are taken off."""
    bare = F.filter(F.transform(words, lambda w: F.regexp_replace(w, r"\A[0-9]+|[0-9]+\z", "")), lambda w: w != "")
    return F.array_union(words, bare)


def split_place(c: Column) -> Column:
    """Struct of the part before the first colon and, if not blank, the part after it."""
    has = c.contains(":")
    rest = strip(F.regexp_replace(c, r"(?s)\A[^:]*:", ""))
    return F.struct(
        F.when(has, strip(F.substring_index(c, ":", 1))).otherwise(c).alias("country_part"),
        F.when(has & (rest != ""), rest).alias("sublocation"),
    )


def render_block(attributes: Column, values: Column, host: Column | None = None) -> Column:
    """``a = v`` lines of a metadata block, with a host line if there is a host."""
    lines = F.zip_with(attributes, values, lambda a, v: F.concat_ws(" = ", a, v))
    if host is not None:
        lines = F.concat(lines, F.when(F.trim(F.coalesce(host, F.lit(""))) != "", F.array(F.concat(F.lit("host = "), host))).otherwise(none_of()))
    return F.concat(F.lit("Metadata:\n"), F.array_join(lines, "\n"))


def pair_context(attributes: Column, values: Column) -> Column:
    return F.array_join(F.zip_with(attributes, values, lambda a, v: F.concat_ws("=", a, v)), " ")


def extract_ids(c: Column) -> Column:
    """Ontology ids in a text, upper case, in reading order."""
    return F.coalesce(F.regexp_extract_all(F.upper(c), F.lit(ONTOLOGY_ID), 1), none_of())


def path_segments(c: Column) -> Column:
    return F.split(c, ":", -1)


def path_prefixes(c: Column) -> Column:
    """All paths from the first segment down to the whole path."""
    parts = path_segments(c)
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), ":"))


def under_any(c: Column, triggers: Sequence[str]) -> Column:
    """True if the path is one of ``triggers`` or below one."""
    return reduce(lambda a, t: a | (c == t) | c.startswith(t + ":"), triggers, F.lit(False))


def shown_term(display: Column, path: Column) -> Column:
    """Display term, or the last segment of the path where it is null or blank."""
    return F.coalesce(F.nullif(F.trim(display), F.lit("")), F.element_at(path_segments(path), -1))


def strip_substrings(c: Column, ignored: Sequence[str]) -> Column:
    """Every literal of ``ignored`` taken out in list order, in any case, inside words too."""
    return reduce(lambda acc, s: F.regexp_replace(acc, "(?iu)" + re.sub(r"([^\w\s])", r"\\\1", s), ""), ignored, c)


class _Text(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []

    def handle_starttag(self, tag, attrs) -> None:
        if tag in BLOCK_TAGS:
            self.parts.append(" ")

    handle_startendtag = handle_starttag

    def handle_endtag(self, tag) -> None:
        if tag in BLOCK_TAGS:
            self.parts.append(" ")

    def handle_data(self, data) -> None:
        self.parts.append(data)


def read_html(fragment: str | None) -> str:
    """Readable text of an escaped or literal fragment; comments go, text after them stays."""
    if not fragment:
        return ""
    parser = _Text()
    parser.feed(html.unescape(fragment))
    parser.close()
    return " ".join("".join(parser.parts).split())


def _html_batches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in batches:
        known = {v: read_html(v) for v in s.dropna().unique()}
        yield pd.Series([known.get(v, "") for v in s], dtype=object)


def html_text(c: Column) -> Column:
    """Exact readable text through an Arrow stage, for texts that hold markup; others stay in the JVM."""
    marked = c.rlike(r"[<&]")
    return F.when(marked, F.pandas_udf(_html_batches, "string")(F.when(marked, c))).otherwise(squeeze(F.coalesce(c, F.lit(""))))
