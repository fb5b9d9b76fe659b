"""Brute force for nested records: every payload is walked object by object."""

import json
import re
import xml.etree.ElementTree as ET

WRAPS = ("package", "documentsummary", "project")
SUB, SAMPLES, DECISIONS = ("subprojects", "subproject"), ("samples", "sample", "biosample", "biosamples"), ("decisions", "decision")


def key(name):
    return name.replace("_", "").replace("-", "").lower()


def tag(e):
    return key(e.tag.rpartition("}")[2])


def embedded(v):
    if isinstance(v, str):
        try:
            return json.loads(v.strip()) if v.strip()[:1] in ("{", "[") else None
        except ValueError:
            return None
    return v


def members(o, names):
    return [v for k, v in o.items() if key(k) in names and v is not None]


def lists(o, names):
    for v in members(o, names):
        v = embedded(v)
        yield v if isinstance(v, list) else [] if v is None else [v]


def text(o, names):
    v = next(iter(members(o, names)), None)
    return v if isinstance(v, str) else "" if v is None or isinstance(v, (dict, list)) else str(v)


def objects(found):
    return [(i, x) for xs in found for i, x in ((i, embedded(x)) for i, x in enumerate(xs)) if isinstance(x, dict)]


def roots(o):
    o = embedded(o)
    if isinstance(o, list):
        return [r for x in o for r in roots(x)]
    if not isinstance(o, dict):
        return []
    inner = [v for v in members(o, WRAPS) if isinstance(embedded(v), (dict, list))]
    return [r for v in inner for r in roots(v)] if inner and not members(o, SUB + SAMPLES) and not any(key(k) in SUB + SAMPLES for k in o) else [o]


def json_rows(o, parent):
    name = text(o, ("accession",))
    for _, s in objects(lists(o, SAMPLES)):
        for i, d in objects(lists(s, DECISIONS)):
            kids = [(kind, p) for kind, names in (("match", ("matches", "match")), ("event", ("events", "event"))) for xs in lists(d, names) for p in range(len(xs))]
            for kind, p in kids or [("none", -1)]:
                yield parent, name, text(s, ("accession",)), i, text(d, ("xmlsource",)), kind, p
    for _, x in objects(lists(o, SUB)):
        yield from json_rows(x, name)


def below(e, wraps, names):
    return [y for x in e for y in ([z for z in x if tag(z) in names] if tag(x) in wraps else [x] if tag(x) in names else [])]


def attr(e, name):
    return next((v for k, v in e.attrib.items() if key(k.rpartition("}")[2]) == name), "")


def xml_rows(e, parent):
    if tag(e) == "documentsummary" and (only := below(e, (), ("project",))) and not below(e, (), ("archiveid",)):
        e = only[0]
    ids = below(e, ("project", "projectid"), ("archiveid",))
    name = attr(ids[0] if ids else e, "accession")
    for s in below(e, ("biosamples", "samples"), ("biosample", "sample")):
        for i, d in enumerate(below(s, ("decisions",), ("decision",))):
            kids = [(k, p) for k, w in (("match", "matches"), ("event", "events")) for p in range(len(below(d, (w,), (k,))))]
            for kind, p in kids or [("none", -1)]:
                yield parent, name, attr(s, "accession"), i, attr(d, "xmlsource"), kind, p
    for x in e:
        if tag(x) in SUB:
            for y in x:
                if tag(y) in WRAPS:
                    yield from xml_rows(y, name)


def xml_roots(e):
    return [e] if tag(e) in WRAPS else [r for x in e for r in xml_roots(x)]


def walk(payload):
    s = payload.lstrip("\ufeff \t\r\n")
    try:
        if s[:1] == "<":
            return {row for r in xml_roots(ET.fromstring(re.sub(r"\A<\?xml[^>]*\?>", "", s))) for row in xml_rows(r, "")}
        if s[:1] in ("{", "["):
            return {row for r in roots(json.loads(s)) for row in json_rows(r, "")}
    except (ValueError, ET.ParseError):
        pass
    return set()
