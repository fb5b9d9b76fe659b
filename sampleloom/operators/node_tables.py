"""JSON and XML texts of a whole batch as node tables, by array kernels over the joined bytes.

A node has a parent, a code for its name, a kind and its place in its list. No text is walked object by object: structure
comes from the positions of brackets and tags, their running depth gives each node the container that was opened last
on its level, and names and values are gathered as Arrow arrays whose distinct entries alone are looked at in Python.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field
from xml.parsers import expat
from xml.sax.saxutils import quoteattr

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

OBJECT, LIST, TEXT, SCALAR, NULL = 1, 3, 7, 8, 9
_OPEN_O, _CLOSE_O, _OPEN_L, _CLOSE_L, _COLON, _COMMA, _QUOTE, _SPACE = 1, 2, 3, 4, 5, 6, 7, 8
_CLASS = np.zeros(256, np.uint8)
for _i, _c in enumerate(b'{}[]:,"', 1):
    _CLASS[_c] = _i
_CLASS[list(b" \t\n\r")] = _SPACE
_HEX = np.zeros(256, bool)
_HEX[list(b"0123456789abcdefABCDEF")] = True
_ESCAPED = np.zeros(256, bool)
_ESCAPED[list(b'"/bfnrtu')] = True
_SCALAR = re.compile(r"-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?|true|false|null|NaN|-?Infinity", re.ASCII)
_EMBEDDED = r'^"(?:\s|\\[nrt])*[\[{]'
_OUTSIDE = re.compile(rb"<!--.*?-->|<!\[CDATA\[.*?\]\]>|<\?.*?\?>", re.S)
_ATTRIBUTES = r"""(?:\s+[^\s=]+\s*=\s*(?:"[^"]*"|'[^']*'))*"""
_TAG = rf"(?s)^<(?P<name>[^\s/>]+){_ATTRIBUTES}\s*(?P<empty>/?)>"
_REFERENCE = re.compile(r"&(?:#x([0-9a-fA-F]+)|#([0-9]+)|(\w+));")
# References that XML defines.
_NAMED = {"lt": "<", "gt": ">", "amp": "&", "quot": '"', "apos": "'"}


def plain_name(name: str) -> str:
    """A member or tag name without case, underscores and hyphens."""
    return name.replace("_", "").replace("-", "").lower()


def gather(u: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The byte ranges of ``u`` as one string array."""
    n = end - start
    to = np.r_[0, np.cumsum(n)]
    at = np.repeat(start - to[:-1], n) + np.arange(to[-1])
    return pa.Array.from_buffers(pa.large_string(), len(n), [None, pa.py_buffer(to.astype(np.int64)), pa.py_buffer(u[at])])


def _mapped(texts: pa.Array, of) -> tuple[np.ndarray, list]:
    """``of`` each distinct text, and the index of every row into these results."""
    code = texts.dictionary_encode()
    return np.asarray(code.indices), [of(t) for t in code.dictionary.to_pylist()]


class _Joined:
    """Texts joined by line ends, so that nothing of one can reach into the next."""

    def __init__(self, docs: list[bytes]) -> None:
        self.u = np.frombuffer(b"\n".join(docs) + b"\n" * 6, np.uint8)
        length = np.fromiter(map(len, docs), np.int64, len(docs))
        self.end = np.cumsum(length + 1) - 1
        self.start = self.end - length

    def doc_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.end, at)


def _last_open(opens: np.ndarray, level: np.ndarray, at: np.ndarray, of_level: np.ndarray) -> np.ndarray:
    """For each place ``at``: the place of the container opened last before it on ``of_level``; -1 on level 0."""
    wide = np.int64(max(int(opens.max(initial=0)), int(at.max(initial=0))) + 2)
    key = level * wide + opens
    order = np.argsort(key, kind="stable")
    i = np.searchsorted(key[order], of_level * wide + at) - 1
    return np.where(of_level > 0, opens[order][np.maximum(i, 0)] if len(opens) else -1, -1)


@dataclass
class Nodes:
    """Columns of a node table; ``text`` is the place of a node's value in ``texts``, -1 if it was not asked for."""

    kind: np.ndarray
    parent: np.ndarray
    code: np.ndarray
    pos: np.ndarray
    text: np.ndarray
    texts: pa.Array
    roots: np.ndarray  # node of each document, -1 if it is malformed
    _csr: tuple = field(default=(), repr=False)

    def children(self, of: np.ndarray, codes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """``(i, child)`` for the children of ``of[i]`` (of the given codes), by the offsets of the parent column."""
        if not self._csr:
            order = np.argsort(self.parent, kind="stable")
            self._csr = order, self.parent[order]
        order, sorted_parent = self._csr
        lo, hi = np.searchsorted(sorted_parent, of), np.searchsorted(sorted_parent, of, "right")
        n = hi - lo
        i = np.repeat(np.arange(len(of)), n)
        child = order[np.repeat(lo - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(int(n.sum()))] if len(of) else np.zeros(0, np.int64)
        if codes is not None:
            keep = codes[self.code[child]]
            i, child = i[keep], child[keep]
        return i, child


def _tokens(docs: list[bytes]):
    """Tokens of JSON texts ``(joined, kind, start, end, doc, scalar)`` and which texts are malformed so far."""
    j = _Joined(docs)
    u, bad = j.u, np.zeros(len(docs), bool)
    cls = _CLASS[u]
    quote = np.flatnonzero(cls == _QUOTE)
    slash = np.flatnonzero(u == 92)
    escaped = np.zeros(0, np.int64)
    if len(slash):
        run = np.flatnonzero(np.r_[True, np.diff(slash) > 1])
        length = np.diff(np.r_[run, len(slash)])
        escaped = (slash[run] + length)[length % 2 == 1]
        is_escaped = np.zeros(len(u), bool)
        is_escaped[escaped] = True
        quote = quote[~is_escaped[quote]]
        wrong = ~_ESCAPED[u[escaped]]
        long = np.flatnonzero(u[escaped] == 117)
        wrong[long] |= ~_HEX[u[np.minimum(escaped[long, None] + np.arange(1, 5), len(u) - 1)]].all(axis=1)
        bad[np.minimum(j.doc_of(escaped[wrong]), len(docs) - 1)] = True
    before = np.searchsorted(quote, j.start)
    bad |= (np.searchsorted(quote, j.end) - before) % 2 == 1
    inside = lambda at, doc: (np.searchsorted(quote, at) - before[doc]) % 2 == 1
    control = np.flatnonzero(u < 32)
    control = control[control < j.end[-1]]
    doc = j.doc_of(control)
    bad[doc[inside(control, doc) & (control < j.end[doc])]] = True
    mark = np.flatnonzero((cls >= _OPEN_O) & (cls <= _COMMA))
    doc = j.doc_of(mark)
    mark = mark[~inside(mark, doc) & ~bad[doc]]
    quote = quote[~bad[j.doc_of(quote)]]
    start, end = np.r_[mark, quote[0::2]], np.r_[mark + 1, quote[1::2] + 1]
    kind = np.r_[cls[mark], np.full(len(quote) // 2, _QUOTE, np.uint8)]
    order = np.argsort(start, kind="stable")
    start, end, kind = start[order], end[order], kind[order]
    doc = j.doc_of(start)
    # what lies between tokens is white space or a scalar
    first = np.r_[True, doc[1:] != doc[:-1]] if len(doc) else np.zeros(0, bool)
    last = np.r_[first[1:], True] if len(doc) else first
    gap_from = np.r_[np.where(first, j.start[doc], np.r_[0, end[:-1]] if len(end) else end), end[last]]
    gap_to = np.r_[start, j.end[doc[last]]]
    some = gap_to > gap_from
    gap_from, gap_to = gap_from[some], gap_to[some]
    at, read = _mapped(gather(u, gap_from, gap_to), lambda t: t.strip(" \t\n\r"))
    filled = np.array([bool(t) for t in read] or [False])[at] if len(at) else np.zeros(0, bool)
    fine = np.array([bool(_SCALAR.fullmatch(t)) for t in read] or [True])[at] if len(at) else filled
    bad[j.doc_of(gap_from[filled & ~fine])] = True
    value = [str(json.loads(t)) if t and _SCALAR.fullmatch(t) and t != "null" else None for t in read]
    start, end = np.r_[start, gap_from[filled]], np.r_[end, gap_to[filled]]
    kind = np.r_[kind, np.full(int(filled.sum()), SCALAR, np.uint8)]
    scalar = np.r_[np.full(len(order), -1), at[filled]]
    order = np.argsort(start, kind="stable")
    return j, kind[order].astype(np.int64), start[order], end[order], scalar[order], value, bad


def _json_round(docs: list[bytes], code_of, wanted: np.ndarray, embedding: np.ndarray, stands_for: np.ndarray):
    """Node table of JSON texts and the texts embedded in it: ``(nodes, node of each embedded text, what it stands for, embedded texts)``.

    ``stands_for`` is the code in whose place each text stands, -1 for a whole record.
    """
    j, t, start, end, scalar, value, bad = _tokens(docs)
    doc = j.doc_of(start)
    delta = ((t == _OPEN_O) | (t == _OPEN_L)).astype(np.int64) - ((t == _CLOSE_O) | (t == _CLOSE_L))
    run = np.cumsum(delta)
    first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]) if len(doc) else np.zeros(0, np.int64)
    if len(first):
        base = np.r_[0, run[first[1:] - 1]]
        depth = run - np.repeat(base, np.diff(np.r_[first, len(doc)]))
        bad[doc[first]] |= (np.minimum.reduceat(depth, first) < 0) | (np.add.reduceat(delta, first) != 0)
    else:
        depth = run
    keep = ~bad[doc]
    t, start, end, scalar, doc, depth, delta = (x[keep] for x in (t, start, end, scalar, doc, depth, delta))
    n = len(t)
    opens = np.flatnonzero(delta > 0)
    inner = depth - (delta > 0) + (delta < 0)  # level of the container that a token stands in, or closes
    up = _last_open(opens, depth[opens], np.arange(n), inner)
    ctx = np.where(up >= 0, t[np.maximum(up, 0)], 0) if n else t
    new = np.r_[True, doc[1:] != doc[:-1]] if n else np.zeros(0, bool)
    prev = np.where(new, 0, np.r_[0, t[:-1]]) if n else t
    begins = (delta > 0) | (t == _QUOTE) | (t == SCALAR)
    key = (t == _QUOTE) & (ctx == _OPEN_O) & ((prev == _OPEN_O) | (prev == _COMMA))
    after_key = np.r_[False, key[:-1]] if n else key
    ended = np.isin(prev, (_QUOTE, SCALAR, _CLOSE_O, _CLOSE_L)) & ~after_key
    ok = np.select(
        [begins & (ctx == 0), begins & (ctx == _OPEN_L), begins, t == _COLON, t == _COMMA, t == _CLOSE_O, t == _CLOSE_L],
        [prev == 0, (prev == _OPEN_L) | (prev == _COMMA), key | (prev == _COLON), (ctx == _OPEN_O) & after_key, (ctx > 0) & ended, (ctx == _OPEN_O) & (ended | (prev == _OPEN_O)), (ctx == _OPEN_L) & (ended | (prev == _OPEN_L))],
        False,
    )
    bad[doc[~ok]] = True
    seen = np.zeros(len(docs), bool)
    seen[doc] = True
    bad |= ~seen
    is_node = begins & ~key & ~bad[doc]
    token = np.flatnonzero(is_node)
    node_of = np.full(n + 1, -1, np.int64)
    node_of[token] = np.arange(len(token))
    parent = node_of[up[token]]
    kind = t[token].copy()
    nothing = np.array([v is None for v in value] or [False])
    kind[(kind == SCALAR) & nothing[np.maximum(scalar[token], 0)]] = NULL
    code = np.zeros(len(token), np.int64)
    member = np.flatnonzero(ctx[token] == _OPEN_O)
    name_at = token[member] - 2
    spelled = lambda s: code_of(json.loads(f'"{s}"') if "\\" in s else s)
    at, codes = _mapped(gather(j.u, start[name_at] + 1, end[name_at] - 1), spelled)
    code[member] = np.array(codes or [0])[at] if len(at) else 0
    # of equal member names of one object the last counts
    some = np.flatnonzero(code[member] > 0)
    if len(some):
        spot = parent[member[some]] * (len(codes) + 1) + at[some]
        _, last = np.unique(spot[::-1], return_index=True)
        dead = np.ones(len(some), bool)
        dead[len(some) - 1 - last] = False
        parent[member[some[dead]]] = -2
    pos = np.zeros(len(token), np.int64)
    listed = np.flatnonzero(ctx[token] == _OPEN_L)
    order = listed[np.argsort(parent[listed], kind="stable")]
    if len(order):
        head = np.flatnonzero(np.r_[True, np.diff(parent[order]) > 0])
        pos[order] = np.arange(len(order)) - np.repeat(head, np.diff(np.r_[head, len(order)]))
    roots = np.full(len(docs), -1, np.int64)
    root = np.flatnonzero(parent == -1)
    roots[doc[token[root]]] = root
    # values that were asked for
    text = np.full(len(token), -1, np.int64)
    asked = np.flatnonzero(wanted[code] & ((kind == TEXT) | (kind == SCALAR)))
    strings, scalars = asked[kind[asked] == TEXT], asked[kind[asked] == SCALAR]
    raw = gather(j.u, start[token[strings]] + 1, end[token[strings]] - 1)
    if len(strings) and pc.any(esc := pc.match_substring(raw, "\\")).as_py():
        decoded = pa.array([json.loads(f'"{s}"') for s in raw.filter(esc).to_pylist()], pa.large_string())
        raw = pc.replace_with_mask(raw, esc, decoded)
    text[strings] = np.arange(len(strings))
    text[scalars] = len(strings) + np.arange(len(scalars))
    texts = pa.concat_arrays([raw, pa.array([value[k] for k in scalar[token[scalars]].tolist()], pa.large_string())])
    # texts that stand where an object or a list is expected
    jump = np.where((parent >= 0) & (kind[np.maximum(parent, 0)] == LIST), parent, np.arange(len(token))) if len(token) else parent
    while len(jump) and (jump[jump] != jump).any():
        jump = jump[jump]
    is_root = parent[jump] == -1
    role = np.where(is_root, stands_for[doc[token[jump]]], code[jump]) if len(token) else code
    within = np.flatnonzero((kind == TEXT) & ((role < 0) | embedding[role]))
    quoted = gather(j.u, start[token[within]], end[token[within]])
    likely = np.asarray(pc.match_substring_regex(quoted, _EMBEDDED)).astype(bool) if len(within) else np.zeros(0, bool)
    found = [json.loads(s).strip().encode("utf-8", "surrogatepass") for s in quoted.filter(pa.array(likely)).to_pylist()] if likely.any() else []
    return Nodes(kind, parent, code, pos, text, texts, roots), within[likely], role[within[likely]], found


def json_nodes(docs: list[bytes], code_of, wanted: np.ndarray, embedding: np.ndarray) -> Nodes:
    """Node table of JSON texts. ``code_of`` gives a member name its code (0: of no interest), ``wanted[code]`` says whose
    values are read, ``embedding[code]`` in whose place a text that is JSON itself stands for what it holds.

    Malformed texts have root -1; a malformed embedded text stays a text. Any depth, without recursion.
    """
    whole, holders, roles, found = _json_round(docs, code_of, wanted, embedding, np.full(len(docs), -1))
    while found:
        base, text_base = len(whole.kind), len(whole.texts)
        more, inner, roles, found = _json_round(found, code_of, wanted, embedding, roles)
        parent = np.where(more.parent >= 0, more.parent + base, more.parent)
        good = more.roots >= 0
        root, holder = more.roots[good], holders[good]
        parent[root] = whole.parent[holder]
        code, pos = more.code.copy(), more.pos.copy()
        code[root], pos[root] = whole.code[holder], whole.pos[holder]
        moved = whole.parent.copy()
        moved[holder] = -2
        roots = whole.roots.copy()
        whole = Nodes(
            np.r_[whole.kind, more.kind], np.r_[moved, parent], np.r_[whole.code, code], np.r_[whole.pos, pos],
            np.r_[whole.text, np.where(more.text >= 0, more.text + text_base, -1)], pa.concat_arrays([whole.texts, more.texts]), roots,
        )
        holders = inner + base
    return whole


def _canonical(doc: bytes) -> bytes:
    """A document with a type declaration as bare tags: entities and default attributes are resolved by the parser."""
    out: list[str] = []
    p = expat.ParserCreate(namespace_separator="}")
    p.ordered_attributes = True
    local = lambda n: n.rpartition("}")[2]

    def begin(name: str, attrs: list[str]) -> None:
        out.append(f"<{local(name)}" + "".join(f" {local(k)}={quoteattr(v)}" for k, v in zip(attrs[::2], attrs[1::2])) + ">")

    p.StartElementHandler = begin
    p.EndElementHandler = lambda name: out.append(f"</{local(name)}>")
    p.Parse(doc, True)
    return "".join(out).encode()


def bare_markup(doc: bytes) -> bytes | None:
    """The tags of a well-formed document without comments, sections and instructions; null if it is malformed."""
    doc = re.sub(rb"\A<\?xml[^>]*\?>", b"", doc)
    try:
        expat.ParserCreate(namespace_separator="}").Parse(doc, True)
        if b"<!" in doc or b"<?" in doc:
            doc = _OUTSIDE.sub(b"", doc)
            if b"<!" in doc:
                doc = _canonical(doc)
    except (expat.ExpatError, ValueError):
        return None
    return doc


def _resolve(value: str) -> str:
    value = re.sub(r"\r\n|[\t\n\r]", " ", value)
    return _REFERENCE.sub(lambda m: chr(int(m[1], 16)) if m[1] else chr(int(m[2])) if m[2] else _NAMED.get(m[3], ""), value)


class Markup(Nodes):
    """Elements of well-formed XML documents; attributes are read for the elements that are asked for."""

    spans: pa.Array

    def attribute(self, of: np.ndarray, name: str) -> pa.Array:
        """The first attribute called ``name`` (without case, prefix, underscores and hyphens) of each element, else null."""
        loose = "[_-]*" + "".join(f"{ch}[_-]*" for ch in name)
        pattern = rf"""(?s)^<[^\s/>]+{_ATTRIBUTES}?\s+(?:[^\s=:]+:)?(?i:{loose})\s*=\s*(?:"(?P<d>[^"]*)"|'(?P<s>[^']*)')"""
        got = pc.extract_regex(self.spans.take(pa.array(of)), pattern)
        value = pc.binary_join_element_wise(got.field("d"), got.field("s"), pa.scalar("", pa.large_string()))
        value = pc.if_else(pc.is_valid(got), value, pa.scalar(None, pa.large_string()))
        odd = pc.fill_null(pc.match_substring_regex(value, r"[&\t\n\r]"), False)
        if pc.any(odd).as_py():
            value = pc.replace_with_mask(value, odd, pa.array([_resolve(v) for v in value.filter(odd).to_pylist()], pa.large_string()))
        return value


def xml_nodes(docs: list[bytes], code_of) -> Markup:
    """Node table of XML texts; malformed ones have root -1. Only the check for being well-formed is made text by text, in the parser."""
    bare = [bare_markup(d) for d in docs]
    j = _Joined([b or b"" for b in bare])
    lt = np.flatnonzero(j.u == 60)
    doc = j.doc_of(lt)
    end = np.minimum(np.r_[lt[1:], len(j.u)] if len(lt) else lt, j.end[doc])
    closing = j.u[lt + 1] == 47 if len(lt) else np.zeros(0, bool)
    token = np.flatnonzero(~closing)
    spans = gather(j.u, lt[token], end[token])
    got = pc.extract_regex(spans, _TAG)
    at, codes = _mapped(got.field("name").fill_null(""), lambda name: code_of(name.rpartition(":")[2]))
    code = np.array(codes or [0])[at] if len(at) else np.zeros(0, np.int64)
    empty = np.asarray(pc.equal(got.field("empty"), "/").fill_null(True)).astype(bool) if len(token) else np.zeros(0, bool)
    delta = np.where(closing, -1, 1)
    delta[token[empty]] = 0
    depth = np.cumsum(delta)
    opens = np.flatnonzero(delta > 0)
    up = _last_open(opens, depth[opens], token, depth[token] - (delta[token] > 0))
    node_of = np.full(len(lt) + 1, -1, np.int64)
    node_of[token] = np.arange(len(token))
    parent = node_of[up]
    roots = np.full(len(docs), -1, np.int64)
    root = np.flatnonzero(parent == -1)
    roots[doc[token[root]]] = root
    n = len(token)
    found = Markup(np.full(n, OBJECT), parent, code, np.zeros(n, np.int64), np.full(n, -1), pa.array([], pa.large_string()), roots)
    found.spans = spans
    return found
