"""Nested JSON and XML payloads into related flat tables that keep parent-child links.

One Arrow stage. The payloads of a slice become one node table (:mod:`sampleloom.operators.node_tables`); projects,
samples, decisions and children are found for the whole slice at once by the offsets of its parent column. Each level is
an Arrow list array over the next one: parent indices come from its offsets, and keys reach each child by vectorised
take. Nothing is shuffled but the final distinct.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sampleloom.operators.node_tables import LIST, NULL, OBJECT, TEXT, Nodes, json_nodes, plain_name, xml_nodes

SCHEMA = "record_id long, parent_accession string, project_accession string, sample_accession string, decision_pos long, xml_source string, child_kind string, child_pos long"
_NAMES = [x.split()[0] for x in SCHEMA.split(", ")]
#: Bytes of payloads that are taken at once, and rows of one output batch.
SLICE_BYTES, OUTPUT_ROWS = 4 << 20, 20_000

# Member and tag names, without case, underscores and hyphens.
_KNOWN = (
    "accession", "xmlsource", "package", "documentsummary", "project", "projectid", "archiveid", "subprojects", "subproject",
    "samples", "sample", "biosamples", "biosample", "decisions", "decision", "matches", "match", "events", "event",
)
_CODES = {n: i for i, n in enumerate(_KNOWN, 1)}


def _code_of(name: str) -> int:
    return _CODES.get(plain_name(name), 0)


def _any_of(*names: str) -> np.ndarray:
    """Table by code: true for these names."""
    t = np.zeros(len(_KNOWN) + 1, bool)
    t[[_CODES[n] for n in names]] = True
    return t


_WRAPS, _SUB = _any_of("package", "documentsummary", "project"), _any_of("subprojects", "subproject")
_SAMPLES, _DECISIONS = _any_of("samples", "sample", "biosamples", "biosample"), _any_of("decisions", "decision")
_MATCHES, _EVENTS = _any_of("matches", "match"), _any_of("events", "event")
_ACCESSION, _SOURCE = _any_of("accession"), _any_of("xmlsource")
_LISTS = _SUB | _SAMPLES | _DECISIONS | _MATCHES | _EVENTS
_Pairs = tuple[np.ndarray, np.ndarray, np.ndarray]  # parent's row, node, place


@dataclass
class Levels:
    """The levels of a slice; each names the row of its parent in the level above."""

    record: np.ndarray
    parent: pa.Array
    project: pa.Array
    sample_project: np.ndarray
    sample: pa.Array
    decision_sample: np.ndarray
    decision_pos: np.ndarray
    source: pa.Array
    matches: tuple[np.ndarray, np.ndarray]  # decision, place
    events: tuple[np.ndarray, np.ndarray]

    def flatten(self) -> Iterator[pa.RecordBatch]:
        n = len(self.decision_pos)
        bare = np.ones(n, bool)
        bare[self.matches[0]] = bare[self.events[0]] = False
        alone = np.flatnonzero(bare)
        children = {"match": self.matches, "event": self.events, "none": (alone, np.full(len(alone), -1))}
        decision_of = _list_of(self.decision_sample, np.arange(n), len(self.sample))
        sample_of = _list_of(self.sample_project, np.arange(len(self.sample)), len(self.project))
        decision_sample = _inverse(decision_of, n)
        sample_project = _inverse(sample_of, len(self.sample))
        for kind, (decision, place) in children.items():
            child = _list_of(decision, place, n)
            parents, places = np.asarray(pc.list_parent_indices(child)), pc.list_flatten(child)
            for lo in range(0, len(parents), OUTPUT_ROWS):
                d = parents[lo : lo + OUTPUT_ROWS]
                s = decision_sample[d]
                p = sample_project[s]
                take = lambda values, at: values.take(pa.array(at)).cast(pa.string())
                yield pa.record_batch(
                    [
                        pa.array(self.record[p], pa.int64(), mask=self.record[p] == _NO_RECORD), take(self.parent, p), take(self.project, p), take(self.sample, s), pa.array(self.decision_pos[d], pa.int64()), take(self.source, d),
                        pa.array([kind], pa.string()).take(pa.array(np.zeros(len(d), np.int64))), places.slice(lo, OUTPUT_ROWS),
                    ],
                    names=_NAMES,
                )


_NO_RECORD = -(2**63)


def _list_of(parent: np.ndarray, values: np.ndarray, n: int) -> pa.ListArray:
    """List array of ``n`` parents over ``values``, from the parent of each value."""
    order = np.argsort(parent, kind="stable")
    offsets = np.r_[0, np.cumsum(np.bincount(parent, minlength=n))] if n else np.zeros(1, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values[order], pa.int64()))


def _inverse(lists: pa.ListArray, n: int) -> np.ndarray:
    """The parent of each value of a list array over row numbers."""
    out = np.zeros(n, np.int64)
    out[np.asarray(pc.list_flatten(lists))] = np.asarray(pc.list_parent_indices(lists))
    return out


def _first_each(n: int, i: np.ndarray, what: np.ndarray) -> np.ndarray:
    """For each of ``n`` rows the first of its ``what``, -1 without any."""
    out = np.full(n, -1, np.int64)
    out[i[::-1]] = what[::-1]
    return out


# ---- JSON ------------------------------------------------------------------------------------------------------------


def _items(t: Nodes, of: np.ndarray, codes: np.ndarray) -> _Pairs:
    """Items of the members of these names: the elements of a list, or a single object or scalar; every list has its own places."""
    i, m = t.children(of, codes)
    lists = t.kind[m] == LIST
    k, inside = t.children(m[lists])
    single = ~lists & (t.kind[m] != TEXT) & (t.kind[m] != NULL)
    return np.r_[i[lists][k], i[single]], np.r_[inside, m[single]], np.r_[t.pos[inside], np.zeros(int(single.sum()), np.int64)]


def _objects(t: Nodes, found: _Pairs) -> _Pairs:
    keep = t.kind[found[1]] == OBJECT
    return tuple(x[keep] for x in found)


def _member_text(t: Nodes, of: np.ndarray, codes: np.ndarray) -> pa.Array:
    """Text of the first member of these names that is not null; empty for none and for what is no text or number."""
    i, m = t.children(of, codes)
    keep = t.kind[m] != NULL
    i, m = i[keep], m[keep]
    order = np.lexsort((m, i))
    node = _first_each(len(of), i[order], m[order])
    text = np.where(node >= 0, t.text[np.maximum(node, 0)] if len(t.text) else -1, -1)
    return t.texts.take(pa.array(np.maximum(text, 0), mask=text < 0)).fill_null("")


def _json_levels(records: np.ndarray, docs: list[bytes]) -> Levels:
    t = json_nodes(docs, _code_of, _ACCESSION | _SOURCE, _LISTS | _WRAPS)
    good = t.roots >= 0
    node, record = t.roots[good], records[good]
    tops, top_records = [], []
    while len(node):  # objects that only wrap projects, and lists of them
        lists, objects = t.kind[node] == LIST, t.kind[node] == OBJECT
        i, inner = t.children(node[objects], _WRAPS)
        fits = (t.kind[inner] == OBJECT) | (t.kind[inner] == LIST)
        i, inner = i[fits], inner[fits]
        has = np.zeros(int(objects.sum()), bool)
        has[i] = True
        own, _ = t.children(node[objects], _SAMPLES | _SUB)
        has[own] = False
        tops.append(node[objects][~has])
        top_records.append(record[objects][~has])
        keep = has[i]
        k, elements = t.children(node[lists])
        record = np.r_[record[objects][i[keep]], record[lists][k]]
        node = np.r_[inner[keep], elements]
    none = np.zeros(0, np.int64)
    front, front_record = np.concatenate([*tops, none]), np.concatenate([*top_records, none])
    parent = pa.nulls(len(front), pa.large_string()).fill_null("")
    projects, owners, parents, names = [], [], [], []
    while len(front):  # one level of nested projects after the other
        name = _member_text(t, front, _ACCESSION)
        projects.append(front)
        owners.append(front_record)
        parents.append(parent)
        names.append(name)
        i, front, _ = _objects(t, _items(t, front, _SUB))
        front_record, parent = front_record[i], name.take(pa.array(i))
    text = lambda parts: pa.concat_arrays([*parts, pa.array([], pa.large_string())])
    project = np.concatenate([*projects, none])
    sample_project, sample, _ = _objects(t, _items(t, project, _SAMPLES))
    decision_sample, decision, decision_pos = _objects(t, _items(t, sample, _DECISIONS))
    m, e = _items(t, decision, _MATCHES), _items(t, decision, _EVENTS)
    return Levels(
        np.concatenate([*owners, none]), text(parents), text(names), sample_project, _member_text(t, sample, _ACCESSION), decision_sample, decision_pos,
        _member_text(t, decision, _SOURCE), (m[0], m[2]), (e[0], e[2]),
    )


# ---- XML -------------------------------------------------------------------------------------------------------------


def _elements(t: Nodes, of: np.ndarray, wraps: np.ndarray, names: np.ndarray) -> _Pairs:
    """Elements of these names directly in ``of`` or in a wrapping element directly in it, with their places in reading order."""
    i, direct = t.children(of, names)
    w, wrapping = t.children(of, wraps)
    k, inner = t.children(wrapping, names)
    row, node = np.r_[i, w[k]], np.r_[direct, inner]
    order = np.lexsort((node, row))
    row, node = row[order], node[order]
    head = np.flatnonzero(np.r_[True, np.diff(row) > 0]) if len(row) else row
    return row, node, np.arange(len(row)) - np.repeat(head, np.diff(np.r_[head, len(row)]))


def _xml_levels(records: np.ndarray, docs: list[bytes]) -> Levels:
    t = xml_nodes(docs, _code_of)
    good = t.roots >= 0
    node, record = t.roots[good], records[good]
    tops, top_records = [], []
    while len(node):  # the topmost projects below any wrappers
        is_project = _WRAPS[t.code[node]]
        tops.append(node[is_project])
        top_records.append(record[is_project])
        k, inner = t.children(node[~is_project])
        node, record = inner, record[~is_project][k]
    none = np.zeros(0, np.int64)
    nothing, project_tag, archive = np.zeros(len(_KNOWN) + 1, bool), _any_of("project"), _any_of("archiveid")
    front, front_record = np.concatenate([*tops, none]), np.concatenate([*top_records, none])
    parent = pa.nulls(len(front), pa.large_string()).fill_null("")
    projects, owners, parents, names = [], [], [], []
    while len(front):
        only = _first_each(len(front), *_elements(t, front, nothing, project_tag)[:2])
        named = _first_each(len(front), *_elements(t, front, nothing, archive)[:2])
        inside = (t.code[front] == _CODES["documentsummary"]) & (only >= 0) & (named < 0)
        front = np.where(inside, only, front)
        ids = _first_each(len(front), *_elements(t, front, _any_of("project", "projectid"), archive)[:2])
        name = t.attribute(np.where(ids >= 0, ids, front), "accession").fill_null("")
        projects.append(front)
        owners.append(front_record)
        parents.append(parent)
        names.append(name)
        i, group = t.children(front, _SUB)
        k, inner = t.children(group, _WRAPS)
        front, front_record, parent = inner, front_record[i[k]], name.take(pa.array(i[k]))
    text = lambda parts: pa.concat_arrays([*parts, pa.array([], pa.large_string())])
    sample_project, sample, _ = _elements(t, np.concatenate([*projects, none]), _any_of("biosamples", "samples"), _any_of("biosample", "sample"))
    decision_sample, decision, decision_pos = _elements(t, sample, _any_of("decisions"), _any_of("decision"))
    m, e = (_elements(t, decision, _any_of(w), _any_of(n)) for w, n in (("matches", "match"), ("events", "event")))
    return Levels(
        np.concatenate([*owners, none]), text(parents), text(names), sample_project, t.attribute(sample, "accession").fill_null(""), decision_sample, decision_pos,
        t.attribute(decision, "xmlsource").fill_null(""), (m[0], m[2]), (e[0], e[2]),
    )


def _slices(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of at most ``SLICE_BYTES`` of payloads, or one payload."""
    size = np.asarray(pc.fill_null(pc.binary_length(b.column(1)), 0)).astype(np.int64)
    lo, held = 0, 0
    for i, n in enumerate(size.tolist()):
        if held and held + n > SLICE_BYTES:
            yield b.slice(lo, i - lo)
            lo, held = i, 0
        held += n
    if lo < len(size):
        yield b.slice(lo)


def flatten_batch(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Flat rows of one batch ``(record id, payload)``."""
    for part in _slices(b):
        payload = pc.utf8_ltrim(part.column(1).cast(pa.large_string()), "﻿ \t\r\n")
        records = np.asarray(part.column(0).fill_null(_NO_RECORD))
        for pattern, levels in (("^<", _xml_levels), (r"^[\[{]", _json_levels)):
            rows = np.flatnonzero(np.asarray(pc.fill_null(pc.match_substring_regex(payload, pattern), False)))
            if len(rows):
                yield from levels(records[rows], payload.take(pa.array(rows)).cast(pa.large_binary()).to_pylist()).flatten()


def flatten_records(rows: DataFrame, record: str = "record_id", payload: str = "payload") -> DataFrame:
    """Flat rows of matches, events and bare decisions of every payload; see ``SCHEMA``.

    Null, empty, cut-off and foreign payloads give no row; a null record id stays null. Lists of one kind that stand beside
    each other each have their own places. Projects at any depth and below any wrapping elements count. Rows are distinct.
    """

    def flatten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield from flatten_batch(b)

    return rows.select(F.col(record).cast("long"), payload).mapInArrow(flatten, SCHEMA).distinct()
