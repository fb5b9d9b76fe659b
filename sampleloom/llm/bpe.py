"""Whole-corpus encoding with a public byte-level BPE vocabulary.

Texts are cut at plain spaces with Arrow kernels, pieces are dictionary-encoded, and only distinct pieces reach Python.
New pre-tokens of a batch are merged together through a pair occurrence index: each pair maps to all its positions,
active ranks are applied in ascending order, and the lists of the affected neighbours are updated. Ids return to the
documents by vectorised take. Nothing is shuffled and whole texts are encoded.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
# Fixed value: the pre-token pattern that the public vocabulary was made with.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SLICE_BYTES = 16 << 20
_MEMO_LIMIT = 300_000


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the vocabulary file."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, spare = [""] * 256, 256
    for b in range(256):
        if b in shown:
            letters[b] = chr(b)
        else:
            letters[b], spare = chr(spare), spare + 1
    return letters


class PairIndexEncoder:
    """Byte-level BPE of many pre-tokens at once."""

    def __init__(self, path: str = VOCABULARY) -> None:
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab = model["vocab"]
        self.byte_id = [vocab[x] for x in _byte_letters()]
        self.merge: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merge[vocab[a] << 20 | vocab[b]] = (rank, vocab[a + b])
        self._split = regex.compile(PATTERN).findall
        self.pretokens: dict[str, tuple[int, ...]] = {}
        self.pieces: dict[str, tuple[int, ...]] = {}

    def _merge_all(self, words: list[str]) -> list[tuple[int, ...]]:
        byte_id, merge = self.byte_id, self.merge
        tok: list[int] = []
        start: list[int] = []
        for w in words:
            start.append(len(tok))
            tok += [byte_id[b] for b in w.encode("utf-8", "surrogatepass")]
            tok.append(-1)  # fences keep pairs inside their word
        n = len(tok)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        where: dict[int, list[int]] = {}
        for i in range(n - 1):
            a, b = tok[i], tok[i + 1]
            if a >= 0 <= b and (k := a << 20 | b) in merge:
                where.setdefault(k, []).append(i)
        heap = [(merge[k][0], k) for k in where]
        heapq.heapify(heap)
        while heap:
            _, k = heapq.heappop(heap)
            places = where.pop(k, None)
            if not places:
                continue
            a, b, new = k >> 20, k & 0xFFFFF, merge[k][1]
            places.sort()
            for i in places:
                j = after[i]
                if tok[i] != a or j >= n or tok[j] != b:
                    continue
                tok[i], tok[j] = new, -2
                far = after[i] = after[j]
                if far < n:
                    before[far] = i
                    right = tok[far]
                    if right >= 0 and (q := new << 20 | right) in merge:
                        if q in where:
                            where[q].append(i)
                        else:
                            where[q] = [i]
                            heapq.heappush(heap, (merge[q][0], q))
                near = before[i]
                if near >= 0:
                    left = tok[near]
                    if left >= 0 and (q := left << 20 | new) in merge:
                        if q in where:
                            where[q].append(near)
                        else:
                            where[q] = [near]
                            heapq.heappush(heap, (merge[q][0], q))
        ends = [*start[1:], n]
        return [tuple(t for t in tok[s : e - 1] if t >= 0) for s, e in zip(start, ends)]

    def encode_many(self, texts: Iterable[str]) -> list[tuple[int, ...]]:
        """Ids of each text; texts are cut into pre-tokens, and new ones are merged together."""
        cut = [self._split(t) for t in texts]
        if len(self.pretokens) > _MEMO_LIMIT:
            self.pretokens.clear()
        known = self.pretokens
        new = list(dict.fromkeys(w for words in cut for w in words if w not in known))
        known.update(zip(new, self._merge_all(new)))
        return [tuple(chain.from_iterable(map(known.__getitem__, words))) for words in cut]

    def piece_ids(self, pieces: list[str]) -> list[tuple[int, ...]]:
        if len(self.pieces) > _MEMO_LIMIT:
            self.pieces.clear()
        new = [p for p in pieces if p not in self.pieces]
        self.pieces.update(zip(new, self.encode_many(new)))
        return [self.pieces[p] for p in pieces]


@lru_cache(maxsize=2)
def encoder(path: str) -> PairIndexEncoder:
    return PairIndexEncoder(path)


def _list_array(rows: list[tuple[int, ...]]) -> pa.ListArray:
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    flat = np.fromiter(chain.from_iterable(rows), np.int32, int(sizes.sum()))
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), pa.array(flat))


def encode_texts(texts: pa.Array, path: str = VOCABULARY) -> pa.ListArray:
    """Token ids of every text; null and empty texts have an empty list."""
    enc = encoder(path)
    texts = texts.fill_null("")
    parts = pc.split_pattern(texts, " ")
    offsets = np.asarray(parts.offsets) - parts.offsets[0].as_py()
    code = parts.flatten().dictionary_encode()
    words, at = code.dictionary.to_pylist(), np.asarray(code.indices)
    odd = np.fromiter((not w or w[0].isspace() for w in words), bool, len(words))
    n = len(texts)
    doc = np.repeat(np.arange(n), np.diff(offsets))
    slow = np.zeros(n, bool)
    slow[doc[odd[at]]] = True
    first = np.zeros(len(at), np.int64)
    first[offsets[:-1][np.diff(offsets) > 0]] = 1
    use = ~slow[doc]
    key = (at.astype(np.int64) * 2 + first)[use]
    uniq, inverse = np.unique(key, return_inverse=True)
    pieces = [words[k >> 1] if k & 1 else " " + words[k >> 1] for k in uniq.tolist()]
    ids = enc.piece_ids(pieces)
    counts = np.bincount(doc[use], minlength=n)
    whole = np.flatnonzero(slow)
    if len(whole):  # texts with other white space at a cut are encoded in one go
        ids = ids + enc.encode_many(texts.take(pa.array(whole)).to_pylist())
        inverse = np.insert(inverse, np.cumsum(counts)[whole], len(uniq) + np.arange(len(whole)))
        counts[whole] = 1
    got = _list_array(ids).take(pa.array(inverse))
    value_offsets = np.asarray(got.offsets)[np.r_[0, np.cumsum(counts)]]
    return pa.ListArray.from_arrays(pa.array(value_offsets, pa.int32()), got.values)


def slices(batch: pa.RecordBatch, column: int, limit: int = _SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of ``batch`` whose texts hold about ``limit`` bytes."""
    size = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64))
    if not len(size):
        return
    at = 0
    while at < len(size):
        base = size[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(size, base + limit, "right")))
        yield batch.slice(at, to - at)
        at = to


def encode_corpus(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """``(key, ids)`` with the token ids of each document, without special tokens, one row for each row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b, 1):
                yield pa.record_batch([part.column(0), encode_texts(part.column(1), path)], names=[key, "ids"])

    return docs.select(F.col(key).cast("long").alias(key), text).mapInArrow(run, f"`{key}` long, ids array<int>")


def count_tokens(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """``(key, n_tokens)``; the ids themselves never leave the Arrow stage."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b, 1):
                n = pc.list_value_length(encode_texts(part.column(1), path)).cast(pa.int64())
                yield pa.record_batch([part.column(0), n], names=[key, "n_tokens"])

    return docs.select(F.col(key).cast("long").alias(key), text).mapInArrow(run, f"`{key}` long, n_tokens long")
