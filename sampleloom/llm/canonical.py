"""Freely typed values mapped to the entries of a reference list.

A multi-pattern automaton over canonical names, aliases and ids finds embedded mentions in the folded value; the longest
non-overlapping ones win. What remains goes to token-set similarity: each token is mapped to the words of the names
(equal, plural, one edit, digit for letter, abbreviation with a dot), and a name of any number of words is meant if its
whole token set is there with nothing but link words between. A value may name several entries; one that names none is
reported with an empty term.

Words of names that have fewer than four letters, and names that hold digits, are only meant as they stand. A reference list of up to
``BLOCK_TERMS`` entries is one lexicon; a longer one is met block by block, with the same result.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import groupby

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sampleloom.functions.text import presentation
from sampleloom.session import cut

_WORD = re.compile(r"[^\W_]+\.?")
# Words that may stand between the words of one name.
_LINK_WORDS = frozenset("of the from in on at a an for by de".split())
# Letters that digits are read as.
_DIGIT_LETTERS = {"0": "o", "1": "li", "3": "e", "5": "s", "8": "b"}
_SKELETON = str.maketrans({"i": "l"} | {d: x[0] for d, x in _DIGIT_LETTERS.items()})
_MEMO_LIMIT = 200_000
#: Entries of the reference list that one lexicon holds.
BLOCK_TERMS = 100_000

Hit = tuple[int, int, str, tuple[str, ...]]  # first token, token after the last, name, entries
Option = tuple[bool, int, int, tuple[int, ...], str, tuple[str, ...]]  # one word, cost, gap, tokens, name, entries


def fold(value: str) -> str:
    """Presentation form without combining marks."""
    s = presentation(value)
    if s.isascii():
        return s
    return "".join(ch for ch in unicodedata.normalize("NFD", s) if not unicodedata.combining(ch))


def words_of(value: str) -> list[str]:
    return [w.rstrip(".") for w in _WORD.findall(fold(value))]


def within_one_edit(a: str, b: str) -> bool:
    """Optimal string alignment distance of at most one."""
    if a == b:
        return True
    la, lb = len(a), len(b)
    if abs(la - lb) > 1:
        return False
    i = 0
    while i < min(la, lb) and a[i] == b[i]:
        i += 1
    if la == lb:
        return a[i + 1 :] == b[i + 1 :] or (a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :])
    return a[i + 1 :] == b[i:] if la > lb else a[i:] == b[i + 1 :]


def _reads_as(token: str, word: str) -> bool:
    """Like :func:`within_one_edit`, where a digit of ``token`` equals the letters that it can stand for."""
    same = lambda x, y: x == y or y in _DIGIT_LETTERS.get(x, "")
    every = lambda a, b: len(a) == len(b) and all(map(same, a, b))
    i = 0
    while i < min(len(token), len(word)) and same(token[i], word[i]):
        i += 1
    if len(token) == len(word):
        swapped = every(token[i : i + 2][::-1], word[i : i + 2]) and every(token[i + 2 :], word[i + 2 :])
        return every(token[i + 1 :], word[i + 1 :]) or swapped
    return every(token[i + 1 :], word[i:]) if len(token) > len(word) else every(token[i:], word[i + 1 :])


def tokens_of(value: str) -> list[str]:
    """Folded words of a value, each with the dot that follows it."""
    return _WORD.findall(fold(value))


def choose_mentions(hits: Iterable[Hit]) -> tuple[set[str], list[tuple[int, int]]]:
    """Entries of the longest non-overlapping mentions, then the leftmost, and the tokens that they take."""
    ordered = sorted(hits, key=lambda h: (-len(h[2]), h[0], h[2]))
    used: set[int] = set()
    terms: set[str] = set()
    taken: dict[tuple[int, int], str] = {}
    for a, b, name, of in ordered:
        if taken.get((a, b)) == name:
            terms.update(of)
        elif used.isdisjoint(range(a, b)):
            used.update(range(a, b))
            taken[a, b] = name
            terms.update(of)
    return terms, sorted(taken)


def rest_of(tokens: list[str], taken: list[tuple[int, int]]) -> list[str]:
    """The tokens outside the mentions, with a bar where a mention was."""
    rest, at = [], 0
    for a, b in taken:
        rest += [*tokens[at:a], "|"]
        at = b
    return rest + tokens[at:]


def choose_options(options: Iterable[Option]) -> set[str]:
    """Entries of the cheapest readings, those of several words first, each token used once; equally near entries of different names are left out."""
    terms: set[str] = set()
    used: set[int] = set()
    for (_, cost, _, places), same in groupby(sorted(set(options)), key=lambda o: o[:4]):
        rivals = list(same)
        if not used.isdisjoint(places):
            continue
        of: dict[str, set[str]] = {}
        for o in rivals:
            of.setdefault(o[4], set()).update(o[5])
        every = set().union(*of.values())
        name = next((n for n in sorted(of) if not cost or of[n] == every), None)
        if name is not None:  # else it cannot be told which entry is meant
            used.update(places)
            terms |= of[name]
    return terms


@dataclass
class Lexicon:
    """Names of the entries, compiled; its size is that of the reference list or of one block of it."""

    names: dict[str, set[str]] = field(default_factory=dict)

    def add(self, name: str | None, term: str) -> None:
        if name and (key := " ".join(words_of(name))):
            self.names.setdefault(key, set()).add(term)

    def compile(self) -> "Lexicon":
        self.automaton = ahocorasick.Automaton()
        self.by_word: dict[str, list[tuple[str, frozenset[str]]]] = {}
        self.squeezed: dict[str, str] = {}
        for name in self.names:
            self.automaton.add_word(f" {name} ", name)
            tokens = tuple(name.split())
            if any(ch.isdigit() for ch in name):
                continue  # ids and codes are only meant as they stand
            for w in set(tokens):
                self.by_word.setdefault(w, []).append((name, frozenset(tokens)))
            if len(tokens) > 1:
                self.squeezed["".join(tokens)] = name
        self.automaton.make_automaton() if len(self.automaton) else None
        words = self.by_word.keys() | self.squeezed.keys()
        self.sorted_words = sorted(self.by_word)
        self.longest = max(map(len, words), default=0)
        self.near: dict[str, set[str]] = {}
        self.near_skeleton: dict[str, set[str]] = {}
        for w in words:
            for x in self._deletes(w):
                self.near.setdefault(x, set()).add(w)
            for x in self._deletes(w.translate(_SKELETON)):
                self.near_skeleton.setdefault(x, set()).add(w)
        self._memo: dict[tuple[str, bool], dict[str, int]] = {}
        return self

    @staticmethod
    def _deletes(w: str) -> set[str]:
        return {w} | {w[:i] + w[i + 1 :] for i in range(len(w))}

    def knows(self, word: str) -> bool:
        return word in self.by_word or word in self.squeezed

    def readings(self, token: str, known: bool = False) -> dict[str, int]:
        """Words (or squeezed names) that ``token`` can be, with the cost of that reading; a ``known`` word is only itself."""
        if (token, known) in self._memo:
            return self._memo[token, known]
        if len(self._memo) > _MEMO_LIMIT:
            self._memo.clear()
        dotted, t = token.endswith("."), token.rstrip(".")
        found: dict[str, int] = {}

        def note(w: str, cost: int) -> None:
            if cost < found.get(w, 99):
                found[w] = cost

        if known or self.knows(t):
            if self.knows(t):
                note(t, 0)
        elif len(t) <= self.longest + 2:
            digits = any(ch.isdigit() for ch in t)
            for form, more in ((t, 0), (t[:-1], 1)) if t[-1:] in ("s", "5") else ((t, 0),):
                if digits:
                    bare = form.translate(_SKELETON)
                    if not bare.isalpha() or form.isdigit():
                        continue
                    candidates = set().union(*(self.near_skeleton.get(x, ()) for x in self._deletes(bare)))
                    for w in candidates:
                        if len(w) == len(form) and all(x == y or y in _DIGIT_LETTERS.get(x, "") for x, y in zip(form, w)):
                            note(w, 1 + more)
                        elif len(form) >= 3 and len(w) >= 4 and abs(len(form) - len(w)) < 2 and _reads_as(form, w):
                            note(w, 2 + more)
                    continue
                if self.knows(form):
                    note(form, 1 + more)
                if len(form) >= 3:
                    for x in self._deletes(form):
                        for w in self.near.get(x, ()):
                            if len(w) >= 4 and within_one_edit(form, w):
                                note(w, 2 + more)
            if dotted and len(t) >= 3:
                for i in range(bisect_left(self.sorted_words, t), len(self.sorted_words)):
                    w = self.sorted_words[i]
                    if not w.startswith(t):
                        break
                    if len(w) > len(t):
                        note(w, 2)
        self._memo[token, known] = found
        return found

    def mentions(self, tokens: list[str]) -> list[Hit]:
        """Every mention of a name in the tokens of a value."""
        if not len(self.automaton):
            return []
        words = [t.rstrip(".") for t in tokens]
        starts, at = {}, 0
        for i, w in enumerate(words):
            starts[at] = i
            at += len(w) + 1
        out = []
        for end, name in self.automaton.iter(f" {' '.join(words)} "):
            first = starts[end - len(name) - 1]
            out.append((first, first + name.count(" ") + 1, name, tuple(sorted(self.names[name]))))
        return out

    def options(self, tokens: list[str], known: frozenset[str] = frozenset()) -> list[Option]:
        """Names whose token set is among ``tokens``, with nothing but link words between."""
        bare = [t.rstrip(".") for t in tokens]
        read = [self.readings(t, b in known) if t != "|" else {} for t, b in zip(tokens, bare)]
        there = set().union(*read)
        out: list[Option] = []
        offer = lambda cost, gap, places, name: out.append((len(places) == 1 and " " not in name, cost, gap, places, name, tuple(sorted(self.names[name]))))
        for i, r in enumerate(read):
            for w, cost in r.items():
                if w in self.squeezed:
                    offer(cost, 0, (i,), self.squeezed[w])
                for name, need in self.by_word.get(w, ()):
                    if len(need) == 1:
                        if name == w:
                            offer(cost, 0, (i,), name)
                    elif need <= there and (places := self._places(i, w, cost, need, bare, read)):
                        total, where = places
                        offer(total, max(where) - min(where), tuple(sorted(where)), name)
        return out

    @staticmethod
    def _places(i: int, w: str, cost: int, need: frozenset[str], bare: list[str], read: list[dict[str, int]]) -> tuple[int, list[int]] | None:
        """Cost and tokens of the other words of a name around its word ``w`` at ``i``: the cheapest, then the nearest of each."""
        reach = [i, i]
        for side, step in ((0, -1), (1, 1)):
            j = i + step
            # a token that is ``w`` as well is nearer to what lies beyond it
            while 0 <= j < len(bare) and (bare[j] in _LINK_WORDS or not need.isdisjoint(read[j])) and read[j].get(w, 99) > cost:
                reach[side] = j
                j += step
        places, total = [i], cost
        for other in sorted(need - {w}):
            best = None
            for j in range(reach[0], reach[1] + 1):
                if j in places or other not in read[j]:
                    continue
                lo, hi = min(i, j), max(i, j)
                k = (read[j][other], hi - lo, j)
                if (best is None or k < best) and all(bare[x] in _LINK_WORDS or x in places or not need.isdisjoint(read[x]) for x in range(lo + 1, hi)):
                    best = k
            if best is None:
                return None
            places.append(best[2])
            total += best[0]
        inside = range(min(places) + 1, max(places))
        return (total, places) if all(x in places or bare[x] in _LINK_WORDS for x in inside) else None

    def terms(self, value: str) -> set[str]:
        """All entries that ``value`` names."""
        tokens = tokens_of(value)
        terms, taken = choose_mentions(self.mentions(tokens))
        rest = rest_of(tokens, taken)
        return terms | choose_options(self.options(rest)) if any(t != "|" for t in rest) else terms


def lexicon_of(rows: Iterable, level_comment: str = "grouping level") -> Lexicon:
    """Names, paths, synonyms and links of rows of ``ontology_terms``; rows that are only levels are left out."""
    lex = Lexicon()
    for r in rows:
        if not r["term"] or r["term_comment"] == level_comment:
            continue
        shown = (r["display_term"] or "").strip() or r["term"].rpartition(":")[2]
        for name in (r["term"], shown, *(r["synonyms"] or "").split(";"), *(r["ontology_link"] or "").split(";")):
            lex.add(name, r["term"])
    return lex


def ontology_lexicon(terms: DataFrame) -> Lexicon:
    """The whole of ``ontology_terms`` as one lexicon; a list of more than ``BLOCK_TERMS`` entries fails."""
    rows = terms.limit(BLOCK_TERMS + 1).collect()
    if len(rows) > BLOCK_TERMS:
        raise ValueError(f"more than {BLOCK_TERMS} entries: use map_to_list")
    return lexicon_of(rows)


def map_to_entries(rows: DataFrame, lexicon: Lexicon, key: str, value: str) -> DataFrame:
    """``(key, term)``: one row for each entry that a value names, one with an empty term if it names none.

    Null and blank values give no row. Copies give equal rows, which are dropped.
    """
    names = lexicon.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex = Lexicon(names).compile()
        memo: dict[str, list[str]] = {}
        for b in batches:
            if len(memo) > _MEMO_LIMIT:
                memo.clear()
            keys, terms = [], []
            for k, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if v is None or not v.strip():
                    continue
                got = memo.get(v)
                if got is None:
                    got = memo[v] = sorted(lex.terms(v)) or [""]
                keys += [k] * len(got)
                terms += got
            yield pa.record_batch([pa.array(keys, pa.int64()), pa.array(terms, pa.string())], names=[key, "term"])

    return rows.select(F.col(key).cast("long").alias(key), value).mapInArrow(run, f"`{key}` long, term string").distinct()


_HITS = "value string, first array<int>, after array<int>, name array<string>, terms array<array<string>>, known array<string>"
_OPTIONS = "value string, single array<boolean>, cost array<int>, gap array<int>, places array<array<int>>, name array<string>, terms array<array<string>>"


def _blocks(terms: DataFrame, n: int) -> Iterator[Lexicon]:
    for i in range(n):
        yield lexicon_of(terms.filter(F.pmod(F.xxhash64("term"), F.lit(n)) == i).collect())


def map_to_list(rows: DataFrame, terms: DataFrame, key: str, value: str, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """:func:`map_to_entries` for a reference list of any length, ``terms`` with the columns of ``ontology_terms``.

    Up to ``block_terms`` entries are one lexicon. A longer list is cut into blocks by a hash of the term; the distinct
    values meet one block after the other, first for mentions and known words, then what is left of them for similar
    names, and the hits of all blocks are chosen from together.
    """
    listed = terms.limit(block_terms + 1).collect()
    if len(listed) <= block_terms:
        return map_to_entries(rows, lexicon_of(listed), key, value)
    n = -(-terms.count() // block_terms)
    filled = rows.select(F.col(key).cast("long").alias(key), F.col(value).alias("value")).filter(F.col("value").rlike(r"(?U)\S"))
    values = filled.select("value").distinct()

    def mentions_of(lexicon: Lexicon):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lex = Lexicon(lexicon.names).compile()
            for b in batches:
                out: list[list] = [[] for _ in range(6)]
                for v in b.column(0).to_pylist():
                    tokens = tokens_of(v)
                    hits = lex.mentions(tokens)
                    for col, x in zip(out, (v, [h[0] for h in hits], [h[1] for h in hits], [h[2] for h in hits], [list(h[3]) for h in hits], sorted({t for t in (x.rstrip(".") for x in tokens) if lex.knows(t)}))):
                        col.append(x)
                yield pa.record_batch([pa.array(c, t) for c, t in zip(out, (pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.string()), pa.list_(pa.list_(pa.string())), pa.list_(pa.string())))], names=["value", "first", "after", "name", "terms", "known"])

        return values.mapInArrow(run, _HITS)

    def options_of(lexicon: Lexicon, left: DataFrame):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lex = Lexicon(lexicon.names).compile()
            for b in batches:
                out: list[list] = [[] for _ in range(7)]
                for v, rest, known in zip(*(b.column(i).to_pylist() for i in range(3))):
                    found = lex.options(rest, frozenset(known))
                    for col, x in zip(out, (v, *([list(o[k]) if k in (3, 5) else o[k] for o in found] for k in range(6)))):
                        col.append(x)
                kinds = (pa.string(), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.list_(pa.int32())), pa.list_(pa.string()), pa.list_(pa.list_(pa.string())))
                yield pa.record_batch([pa.array(c, t) for c, t in zip(out, kinds)], names=["value", "single", "cost", "gap", "places", "name", "terms"])

        return left.select("value", "rest", "known").mapInArrow(run, _OPTIONS)

    def chosen_mentions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[], [], [], []]
            for v, first, after, name, of, known in zip(*(b.column(i).to_pylist() for i in range(6))):
                tokens = tokens_of(v)
                got, taken = choose_mentions((a, z, n_, tuple(t)) for a, z, n_, t in zip(first, after, name, of))
                for col, x in zip(out, (v, sorted(got), rest_of(tokens, taken), known)):
                    col.append(x)
            yield pa.record_batch([pa.array(out[0], pa.string()), *(pa.array(c, pa.list_(pa.string())) for c in out[1:])], names=["value", "terms", "rest", "known"])

    def chosen_options(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values_, terms_ = [], []
            for v, *columns in zip(*(b.column(i).to_pylist() for i in range(7))):
                values_.append(v)
                terms_.append(sorted(choose_options((s, c, g, tuple(p), n_, tuple(t)) for s, c, g, p, n_, t in zip(*columns))))
            yield pa.record_batch([pa.array(values_, pa.string()), pa.array(terms_, pa.list_(pa.string()))], names=["value", "terms"])

    def gathered(parts: list[DataFrame]) -> DataFrame:
        """The hits of all blocks for each value; a value has as many rows as there are blocks."""
        both = parts[0]
        for p in parts[1:]:
            both = both.unionByName(p)
        return both.groupBy("value").agg(*[F.flatten(F.collect_list(c)).alias(c) for c in both.columns[1:]])

    found = cut(gathered([mentions_of(x) for x in _blocks(terms, n)]).mapInArrow(chosen_mentions, "value string, terms array<string>, rest array<string>, known array<string>"))
    similar = gathered([options_of(x, found) for x in _blocks(terms, n)]).mapInArrow(chosen_options, "value string, terms array<string>")
    every = found.select("value", "terms").join(similar.withColumnRenamed("terms", "more"), "value").select("value", F.array_union("terms", "more").alias("terms"))
    named = every.select("value", F.explode(F.when(F.size("terms") > 0, F.col("terms")).otherwise(F.array(F.lit("")))).alias("term"))
    return filled.join(named, "value").select(key, "term").distinct()
