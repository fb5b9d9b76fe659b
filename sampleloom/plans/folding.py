"""Unicode text forms in the checking SQL, so that it covers whole tables as the queries do.

The presentation form is case folding after NFKC. DuckDB has neither, but both work character by character up to the
composition that ``nfc_normalize`` gives; the table of characters is made from the standard's data by that rule.
"""

from __future__ import annotations

import functools
import unicodedata

_MARK = ""
#: Stands in the SQL for the table of characters, which is put in when the SQL is asked for.
TABLE = "{{fold_chars}}"
#: White space as RE2 classes: the property alone, and with the four separators that Python strips as well.
SPACE = "[\\t-\\r \\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
SPACES = SPACE.replace(" \\x{85}", "\\x{1c}-\\x{20}\\x{85}")
WORD_GAP = "[^\\pL\\pN]+"


@functools.cache
def fold_chars() -> str:
    """CTE ``fold_chars (ch, mapped)`` of all characters that NFKC or case folding change, ASCII included."""
    pairs = []
    for c in map(chr, [*range(0x41, 0x5B), *range(0x80, 0xD800), *range(0xF900, 0x20000), *range(0x2F800, 0x2FA20)]):
        to = unicodedata.normalize("NFKC", c).casefold()
        if to != c:
            pairs.append((c, to))
    quote = lambda xs: "'" + _MARK.join(xs).replace("'", "''") + "'"
    return f"fold_chars AS (SELECT unnest(string_split({quote(c for c, _ in pairs)}, '{_MARK}')) AS ch, unnest(string_split({quote(t for _, t in pairs)}, '{_MARK}')) AS mapped)"


def complete(sql: str) -> str:
    return sql.replace(TABLE, fold_chars()) if TABLE in sql else sql


def strip(c: str) -> str:
    """Without white space at either end, the separators included."""
    return f"regexp_replace({c}, '^{SPACES}+|{SPACES}+$', '', 'g')"


def squeeze(c: str) -> str:
    return f"trim(regexp_replace({c}, '{SPACE}+', ' ', 'g'))"


def simple_form(c: str) -> str:
    """Full form of a text without characters that fold to others."""
    return f"trim(regexp_replace(lower({c}), '{WORD_GAP}', ' ', 'g'))"


def forms(source: str, name: str) -> str:
    """CTEs up to ``name (v, shown, form)``: presentation and full form of the distinct texts of ``source``, a query of one column ``v``."""
    unquoted = "CASE WHEN length(s) > 1 AND left(s, 1) = right(s, 1) AND left(s, 1) IN ('''', '\"') THEN substr(s, 2, length(s) - 2) ELSE s END"
    return (
        f"{TABLE}, {name}_t AS (SELECT DISTINCT v FROM ({source}) WHERE v IS NOT NULL), {name}_c AS (SELECT v, unnest(regexp_extract_all(v, '(?s).')) AS ch, generate_subscripts(regexp_extract_all(v, '(?s).'), 1) AS i FROM {name}_t WHERE NOT regexp_full_match(v, '[\\x00-\\x7f]*')), "
        f"{name}_n AS (SELECT v, nfc_normalize(string_agg(coalesce(mapped, ch), '' ORDER BY i)) AS n FROM {name}_c LEFT JOIN fold_chars USING (ch) GROUP BY v), {name}_s AS (SELECT v, {strip('coalesce(n, lower(v))')} AS s FROM {name}_t LEFT JOIN {name}_n USING (v)), "
        f"{name}_p AS (SELECT v, trim(regexp_replace({unquoted}, '{SPACES}+', ' ', 'g')) AS shown FROM {name}_s), {name} AS (SELECT v, shown, trim(regexp_replace(shown, '{WORD_GAP}', ' ', 'g')) AS form FROM {name}_p)"
    )


NAME_FORMS = forms("SELECT attr_name AS v FROM curation_decisions", "nf")
VALUE_FORMS = forms("SELECT attr_value AS v FROM curation_decisions", "vf")
