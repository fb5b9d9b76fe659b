"""Language of documents and of their segments by compression.

Every language has a raw-content zstandard dictionary made of a bounded, cleaned sample of labelled rows. A sentence
costs, in each language, the bytes it takes with that dictionary; the segmentation of a document is the sequence of
languages with the least total cost, a change of language costing ``SWITCH`` bytes. A segment whose margin to the next
language is narrow has no language. Codes, numbers, sequences and words that are spread over most languages, such as taxon
names, are taken out first.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sampleloom.llm.bpe import slices

#: Labelled documents per language that the dictionaries are fitted on.
SAMPLE_DOCS = 150
#: Bytes of the texts of one language that the dictionaries are fitted on.
SAMPLE_BYTES = 8 << 20
#: Bytes of one dictionary.
DICTIONARY_BYTES = 1 << 16
#: Bytes that a change of language costs.
SWITCH = 14
#: Least margin to the second language, in bytes and as a share of its cost.
MIN_MARGIN, MIN_SHARE = 6, 0.08
LEVEL = 3
_MEMO_LIMIT = 300_000

_SENTENCE = re.compile(r"(?<=[.!?…])[\"')\]]*\s+|\s*\n\s*\n\s*|\s+[/|]\s+|(?<=[;])\s+")
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
_SEQUENCE = re.compile(r"[acgtun]{8,}")


# The form of a character reference.
_REFERENCE = re.compile(r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)")


def unescape(text: str) -> tuple[str, list[int], list[int]]:
    """``text`` without character references, and the places in it and in ``text`` behind each of them."""
    out, there, here, at, n = [], [0], [0], 0, 0
    for m in _REFERENCE.finditer(text):
        new = html.unescape(m[0])
        out += [text[at : m.start()], new]
        n += m.start() - at + len(new)
        at = m.end()
        if new != m[0]:
            there.append(n)
            here.append(at)
    return "".join([*out, text[at:]]), there, here


def spans(text: str) -> list[tuple[str, int, int]]:
    """The sentences of ``text``, without character references, and where each begins and ends in ``text``."""
    plain, there, here = unescape(text) if "&" in text else (text, [0], [0])
    found, at = [], 0
    for m in _SENTENCE.finditer(plain):
        if m.start() > at:
            found.append((plain[at : m.start()], at, m.start()))
        at = m.end()
    if at < len(plain):
        found.append((plain[at:], at, len(plain)))
    if len(there) == 1:
        return found
    # a place inside what a reference stands for is the one behind the reference
    back = lambda x: here[i] + x - there[i] if (i := bisect_right(there, x) - 1) + 1 == len(there) or here[i] + x - there[i] <= here[i + 1] else here[i + 1]
    return [(s, back(a), back(b)) for s, a, b in found]


def sentences(text: str) -> list[str]:
    return [s for s, _, _ in spans(text)]


@dataclass(frozen=True)
class Segment:
    """A run of text in one language; ``lang`` is None where it cannot be told."""

    lang: str | None
    confidence: float
    start: int
    end: int


class WordFilter(dict):
    """Token -> its lower-case words that can have a language, joined by spaces; each distinct token is read once."""

    def __init__(self, neutral: frozenset[str] = frozenset()) -> None:
        self.neutral = neutral

    def __missing__(self, token: str) -> str:
        if len(self) > _MEMO_LIMIT:
            self.clear()
        if token.isascii() and any("0" <= ch <= "9" for ch in token):
            got = ""
        else:
            got = " ".join(w for w in _WORD.findall(token) if w not in self.neutral and not _SEQUENCE.fullmatch(w))
        self[token] = got
        return got

    def words(self, sentence: str) -> str:
        return " ".join(filter(None, map(self.__getitem__, sentence.lower().split())))


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    dictionaries: tuple[bytes, ...]
    neutral: frozenset[str]


def fit(rows: list[tuple[str, str]]) -> LanguageModel:
    """Dictionaries from labelled ``(lang, text)`` rows, some of whose labels are wrong.

    A sentence is kept for its label only if its words, weighted by how exclusive they are to each language, speak for
    that label most. The most frequent sentences come last in a dictionary, where they are cheapest to refer to.
    """
    plain = WordFilter()
    docs: dict[str, list[list[str]]] = defaultdict(list)
    for lang, text in sorted(rows):
        docs[lang].append(sentences(text))
    share: dict[str, dict[str, float]] = defaultdict(dict)
    for lang, ds in docs.items():
        df = Counter(w for d in ds for w in {w for s in d for w in plain.words(s).split()})
        for w, n in df.items():
            share[w][lang] = n / len(ds)
    langs = tuple(sorted(docs))
    weight: dict[str, dict[str, float]] = {}
    for w, x in share.items():
        total = sum(x.values())
        weight[w] = {k: v / total for k, v in x.items()}
    # spread evenly over most languages: no language of its own
    neutral = frozenset(w for w, x in weight.items() if len(langs) >= 4 and len(x) > 0.6 * len(langs) and max(x.values()) < 0.3)
    worded = WordFilter(neutral)
    kept: dict[str, Counter] = {k: Counter() for k in langs}
    for lang, ds in docs.items():
        for d in ds:
            for s in d:
                words = worded.words(s)
                votes: Counter = Counter()
                for w in words.split():
                    for k, v in weight[w].items():
                        votes[k] += v
                if votes and votes.most_common(1)[0][0] == lang:
                    kept[lang][words] += 1
    dictionaries = []
    for lang in langs:
        chosen, size = [], 0
        for s, _ in sorted(kept[lang].items(), key=lambda x: (-x[1], x[0])):
            size += len(s.encode()) + 1
            if size > DICTIONARY_BYTES:
                break
            chosen.append(s)
        dictionaries.append("\n".join(reversed(chosen)).encode() or b"\n" * 8)
    return LanguageModel(langs, tuple(dictionaries), neutral)


def training_rows(docs: DataFrame, languages: list[str], per_language: int = SAMPLE_DOCS) -> list[tuple[str, str]]:
    """About ``per_language`` labelled rows of each language, chosen by a hash of the id.

    At most twice that many rows in all, and of each language those that fit in ``SAMPLE_BYTES``, in the order of the hash.
    """
    labelled = docs.filter(F.col("lang").isin(languages) & F.col("text").isNotNull())
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    chosen = F.lit(False)
    for lang, n in sorted(counts.items()):
        chosen = chosen | ((F.col("lang") == lang) & (draw < min(1.0, per_language / n)))
    sample = labelled.filter(chosen).select("lang", "text", draw.alias("draw"), "doc_id").limit(2 * per_language * max(1, len(languages)))
    held = F.sum(F.octet_length("text")).over(Window.partitionBy("lang").orderBy("draw", "doc_id", "text").rowsBetween(Window.unboundedPreceding, 0))
    return [(r["lang"], r["text"]) for r in sample.withColumn("held", held).filter(F.col("held") <= SAMPLE_BYTES).select("lang", "text").collect()]


class Classifier:
    """Compressed sizes of sentences in every language, and the segmentation of documents."""

    def __init__(self, model: LanguageModel) -> None:
        self.model = model
        self.compress = []
        for d in model.dictionaries:
            raw = zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            raw.precompute_compress(level=LEVEL)
            self.compress.append(zstandard.ZstdCompressor(dict_data=raw, write_checksum=False, write_content_size=False, write_dict_id=False).compress)
        self.words = WordFilter(model.neutral).words
        self.memo: dict[str, tuple[int, ...]] = {}

    def cost(self, words: str) -> tuple[int, ...]:
        got = self.memo.get(words)
        if got is None:
            if len(self.memo) > _MEMO_LIMIT:
                self.memo.clear()
            raw = words.encode()
            got = self.memo[words] = tuple(len(c(raw)) for c in self.compress)
        return got

    def segments(self, text: str | None) -> list[Segment]:
        """Runs of one language in reading order; those that cannot be told have no language. None if the text has no words of a language."""
        if not text or not self.compress:
            return []
        costs, at = [], []
        for s, start, end in spans(text):
            words = self.words(s)
            if words:
                costs.append(self.cost(words))
                at.append((start, end))
        if not costs:
            return []
        table = np.array(costs, np.int64)
        n, k = table.shape
        favourite = table.argmin(axis=1)
        if (favourite == favourite[0]).all():  # no change of language can cost less
            return self._sure([[int(favourite[0]), table.sum(axis=0), at[0][0], at[-1][1]]])
        best = np.zeros((n, k), np.int64)
        total = table[0].copy()
        for i in range(1, n):
            stay = total
            j = int(total.argmin())
            move = total[j] + SWITCH
            best[i] = np.where(stay <= move, np.arange(k), j)
            total = np.minimum(stay, move) + table[i]
        path = [int(total.argmin())]
        for i in range(n - 1, 0, -1):
            path.append(int(best[i][path[-1]]))
        path.reverse()
        runs: list[list] = []
        for i, lang in enumerate(path):
            if runs and runs[-1][0] == lang:
                runs[-1][1] = runs[-1][1] + table[i]
                runs[-1][3] = at[i][1]
            else:
                runs.append([lang, table[i].copy(), *at[i]])
        return self._sure(runs)

    def _sure(self, runs: list[list]) -> list[Segment]:
        """The runs, those without a clear margin without a language; runs of one language with nothing clear between are one."""
        found: list[list] = []
        clear = -1  # the last run with a language
        for lang, sizes, start, end in runs:
            if self._narrow(lang, sizes):
                found.append([None, sizes, start, end])
            elif clear >= 0 and found[clear][0] == lang:
                del found[clear + 1 :]
                found[clear][1] = found[clear][1] + sizes
                found[clear][3] = end
            else:
                clear = len(found)
                found.append([lang, sizes, start, end])
        return [Segment(None, 0.0, a, b) if lang is None else Segment(self.model.languages[lang], self._confidence(lang, sizes), a, b) for lang, sizes, a, b in found]

    @staticmethod
    def _second(lang: int, sizes: np.ndarray) -> int:
        return int(np.delete(sizes, lang).min()) if len(sizes) > 1 else int(sizes[lang]) + MIN_MARGIN

    def _narrow(self, lang: int, sizes: np.ndarray) -> bool:
        second = self._second(lang, sizes)
        margin = second - int(sizes[lang])
        return margin < MIN_MARGIN or margin < MIN_SHARE * second

    def _confidence(self, lang: int, sizes: np.ndarray) -> float:
        second = self._second(lang, sizes)
        return round(min(1.0, max(0.0, (second - int(sizes[lang])) / max(1, second))), 4)


_SEGMENTS = "doc_id long, label string, n_segments long, seg_no long, lang string, confidence double, start long, end long"


def language_segments(docs: DataFrame, languages: list[str], per_language: int = SAMPLE_DOCS) -> DataFrame:
    """``(doc_id, label, n_segments, seg_no, lang, confidence, start, end)`` of every document of ``docs (doc_id, text, lang)``.

    ``start`` and ``end`` cut a segment out of its text, in characters, from its first to its last sentence with words of a
    language. Runs whose language cannot be told have null ``lang``
    and ``seg_no`` and confidence 0; so has the one row, without places, of a text without words of a language, null and
    empty ones included. ``n_segments`` counts the runs with a language; ``label`` is the given label as it is.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(fit(training_rows(docs, languages, per_language)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = Classifier(model.value)
        names = [x.split()[0] for x in _SEGMENTS.split(", ")]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64()]
        for batch in batches:
            for b in slices(batch, 1):
                rows = []
                for d, t, label in zip(*(b.column(i).to_pylist() for i in range(3))):
                    found = classifier.segments(t)
                    n = sum(x.lang is not None for x in found)
                    no = 0
                    for x in found:
                        no += x.lang is not None
                        rows.append((d, label, n, no if x.lang else None, x.lang, x.confidence, x.start, x.end))
                    if not found:
                        rows.append((d, label, 0, None, None, 0.0, None, None))
                cols = list(zip(*rows)) or [()] * len(kinds)
                yield pa.record_batch([pa.array(list(c), k) for c, k in zip(cols, kinds)], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").mapInArrow(run, _SEGMENTS)


def wrong_or_mixed(segments: DataFrame, languages: list[str]) -> DataFrame:
    """Documents in one language with a wrong, missing or unknown label, and all documents in several languages."""
    bad = F.coalesce(~F.col("label").isin(languages) | (F.col("label") != F.col("lang")), F.lit(True))
    return segments.filter(F.col("lang").isNotNull() & ((F.col("n_segments") > 1) | bad))
