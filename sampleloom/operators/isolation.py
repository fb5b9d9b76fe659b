"""Isolation sources: ontology indexes, direct matches, crosslinks, evidence, rendering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sampleloom.functions import strings as S
from sampleloom.operators.ranking import dimension

NONE, SAMPLE, PROJECT, BOTH = "none", "sample", "project", "sample_and_project"
UNSPECIFIED = "unspecified"


def nodes_of(ontology: DataFrame) -> DataFrame:
    """``(ordinal, term, shown, links, synonyms)``; the ordinal is the order of the paths unless the table brings one."""
    from pyspark.sql import Window

    ordinal = F.col("ordinal") if "ordinal" in ontology.columns else F.row_number().over(Window.orderBy("term"))
    return ontology.select(ordinal.alias("ordinal"), F.trim("term").alias("term"), S.shown_term(F.col("display_term"), F.trim("term")).alias("shown"), S.semi_split(F.col("ontology_link")).alias("links"), S.semi_split(F.col("synonyms")).alias("synonyms"), S.semi_split(F.col("crosslink_term")).alias("crosslinks"))


def term_index(nodes: DataFrame) -> DataFrame:
    """``(norm, term)``: normal display terms and synonyms; the earliest node wins, its display term before its synonyms."""
    names = nodes.select("ordinal", "term", F.posexplode(F.concat(F.array("shown"), "synonyms")).alias("pos", "name")).withColumn("norm", S.norm_keyword(F.col("name"))).filter("norm <> ''")
    return names.groupBy("norm").agg(F.min(F.struct("ordinal", "pos", "term"))["term"].alias("term"))


def display_index(nodes: DataFrame) -> DataFrame:
    """``(norm, term)`` of display terms alone; the last node wins."""
    names = nodes.select("ordinal", "term", S.norm_keyword(F.col("shown")).alias("norm")).filter("norm <> ''")
    return names.groupBy("norm").agg(F.max(F.struct("ordinal", "term"))["term"].alias("term"))


def id_index(nodes: DataFrame) -> DataFrame:
    """``(id, term)`` of the ontology links, upper case; the earliest node wins."""
    ids = nodes.select("ordinal", "term", F.explode("links").alias("id")).withColumn("id", F.upper("id"))
    return ids.groupBy("id").agg(F.min(F.struct("ordinal", "term"))["term"].alias("term"))


def direct_matches(values: DataFrame, nodes: DataFrame, value: str = "value") -> DataFrame:
    """``(value, term)`` of the distinct values that hold a known id (the first one counts) or are a term or synonym."""
    v = values.select(value).distinct()
    ids = v.select(value, F.posexplode(S.extract_ids(F.col(value))).alias("pos", "id")).join(dimension(id_index(nodes)), "id").groupBy(value).agg(F.min(F.struct("pos", "term"))["term"].alias("__by_id"))
    return (
        v.join(ids, value, "left").withColumn("norm", S.norm_keyword(F.col(value))).join(dimension(term_index(nodes)), "norm", "left")
        .select(value, F.coalesce("__by_id", "term").alias("term")).filter("term is not null")
    )


def crosslink_edges(nodes: DataFrame) -> DataFrame:
    """``(term, target)`` of crosslinks, resolved by term or else by id; unknown targets are left out."""
    raw = nodes.select("term", F.explode("crosslinks").alias("x")).withColumn("norm", S.norm_keyword(F.col("x"))).withColumn("id", F.upper("x"))
    by_term = dimension(term_index(nodes).withColumnRenamed("term", "__t"))
    by_id = dimension(id_index(nodes).withColumnRenamed("term", "__i"))
    return raw.join(by_term, "norm", "left").join(by_id, "id", "left").select("term", F.coalesce("__t", "__i").alias("target")).filter("target is not null").distinct()


def with_crosslinks(selected: DataFrame, edges: DataFrame, key: str) -> DataFrame:
    """``(key, term, crosslinked)``: the selected nodes and those one hop away that are not selected."""
    more = selected.join(dimension(edges), "term").select(key, F.col("target").alias("term")).distinct().join(selected, [key, "term"], "left_anti")
    return selected.select(key, "term").distinct().withColumn("crosslinked", F.lit(False)).unionByName(more.withColumn("crosslinked", F.lit(True)))


def render_nodes(chosen: DataFrame, nodes: DataFrame, key: str) -> DataFrame:
    """Categories, display terms, links and paths of the nodes of each key, in the order of their paths."""
    info = dimension(nodes.select("term", "shown", F.coalesce(F.nullif(F.array_join("links", ";"), F.lit("")), F.lit("NA")).alias("link")))
    g = chosen.select(key, "term").distinct().join(info, "term").groupBy(key).agg(F.array_sort(F.collect_list(F.struct("term", "shown", "link"))).alias("n"))
    first = F.array_sort(F.array_distinct(F.transform("n", lambda x: F.split(x["term"], ":")[0])))
    return g.select(key, F.array_join(first, "||").alias("categories"), F.array_join("n.shown", "||").alias("display_terms"), F.array_join("n.link", "||").alias("ontology_links"), F.array_join("n.term", "||").alias("term_paths"))


def evidence_level(direct: Column, model: Column, claimed: Column) -> Column:
    """Evidence of a result with and without specific direct and model terms; a bad claim fails."""
    bad = F.raise_error(F.lit("a specific isolation source must name supporting evidence")).cast("string")
    return (
        F.when(~direct & ~model, NONE).when(direct & ~model, SAMPLE).when(direct & claimed.isin(PROJECT, BOTH), BOTH).when(claimed == NONE, bad).otherwise(claimed)
    )


def request_mode(has_sample: Column, has_project: Column) -> Column:
    return F.when(has_sample & has_project, "combined").when(has_sample, "sample_only").when(has_project, "project_only")


def project_contexts(records: DataFrame, catalog: DataFrame, key: str, accessions: str) -> DataFrame:
    """``(key, contexts)``: distinct catalog entries of the linked accessions, by accession."""
    links = records.select(key, F.explode(accessions).alias("accession")).distinct()
    entry = F.struct("accession", "title", "description", "relevance")
    return links.join(catalog.dropDuplicates(["accession"]), "accession").groupBy(key).agg(F.array_sort(F.collect_list(F.struct("accession", entry.alias("e")))).alias("c")).select(key, F.col("c.e").alias("contexts"))


def standardize_isolation(cands: DataFrame, ontology: DataFrame, contexts: DataFrame | None = None) -> DataFrame:
    """Isolation source of each record of ``cands (record, pos, attribute, value)`` without a model.

    Blank values are left out. Direct nodes and those one crosslink away are rendered; a record without any is unspecified.
    ``covered`` says that every value matched, so that no model would be asked. ``contexts (record, contexts)`` adds the
    mode of the request that would be made.
    """
    rows = cands.select("record", "pos", "attribute", S.strip(F.col("value")).alias("value"))
    filled = rows.filter("value <> ''")
    nodes = nodes_of(ontology)
    hits = filled.join(direct_matches(filled, nodes), "value").select("record", "pos", "term")
    chosen = with_crosslinks(hits.select("record", "term").distinct(), crosslink_edges(nodes), "record")
    counts = filled.groupBy("record").agg(F.count("*").alias("n_values")).join(hits.groupBy("record").agg(F.count("*").alias("n_hits"), F.bool_or(F.col("term") != UNSPECIFIED).alias("specific")), "record", "left")
    out = rows.select("record").distinct().join(counts, "record", "left").join(render_nodes(chosen, nodes, "record"), "record", "left")
    if contexts is not None:
        out = out.join(contexts.select("record", F.lit(True).alias("__project")).distinct(), "record", "left")
    else:
        out = out.withColumn("__project", F.lit(False))
    n, h = F.coalesce("n_values", F.lit(0)), F.coalesce("n_hits", F.lit(0))
    covered = (n > 0) & (n == h)
    specific = F.coalesce("specific", F.lit(False))
    none = F.col("term_paths").isNull()
    diagnostics = F.filter(F.array(F.when(h > 0, "exact_match"), F.when(none, UNSPECIFIED)), lambda x: x.isNotNull())
    return out.select(
        "record", F.coalesce("categories", F.lit(UNSPECIFIED)).alias("categories"), F.coalesce("display_terms", F.lit(UNSPECIFIED)).alias("display_terms"), F.coalesce("ontology_links", F.lit("NA")).alias("ontology_links"),
        F.coalesce("term_paths", F.lit("")).alias("term_paths"), F.when(specific, SAMPLE).otherwise(NONE).alias("evidence_level"), covered.alias("covered"),
        F.when(~covered, request_mode(n > 0, F.coalesce("__project", F.lit(False)))).alias("request_mode"), diagnostics.alias("diagnostics"),
    )


def render_tree(rows: list[tuple[str, str, str | None]], first_roots: tuple[str, ...] = ()) -> tuple[str, list[str]]:
    """Markdown of the tree and its notes, and the paths in that order, from ``(term, shown, comment)`` of a small ontology.

    Levels that have no row of their own stand under their last segment. Roots of ``first_roots`` come first.
    """
    info = {t: (s, c) for t, s, c in rows}
    children: dict[str, list[str]] = {}
    for t, _, _ in rows:
        parts = t.split(":")
        for i in range(len(parts)):
            parent, path = ":".join(parts[:i]), ":".join(parts[: i + 1])
            if path not in children.setdefault(parent, []):
                children[parent].append(path)
    roots = children.get("", [])
    ordered = [r for r in first_roots if r in roots] + [r for r in roots if r not in first_roots]
    tree, notes, paths = [], [], []
    todo = [(r, 0) for r in reversed(ordered)]
    while todo:
        path, depth = todo.pop()
        shown, comment = info.get(path, (None, None))
        shown = (shown or path.rpartition(":")[2]).strip()
        tree.append(f"{'  ' * depth}- {shown}")
        paths.append(path)
        if comment and comment.strip():
            notes.append(f'- "{shown}": {comment.strip().rstrip(".")}.')
        todo += [(c, depth + 1) for c in reversed(children.get(path, []))]
    text = "\n".join(["## Tree", *tree] + (["", "## Node notes", *notes] if notes else []))
    return text, paths


# Evidence that a reply may claim, by the mode of its request.
PERMITTED = {"sample_only": (SAMPLE, NONE), "project_only": (PROJECT, NONE), "combined": (SAMPLE, PROJECT, BOTH, NONE)}
REPLY = "terms array<string>, reasoning string, evidence_level string"


def reply_schema(shown: list[str], mode: str) -> dict:
    """JSON schema of a reply to a request of ``mode``: display terms of the ontology, a reasoning and the evidence it may claim."""
    return {
        "type": "object", "additionalProperties": False, "required": ["terms", "reasoning", "evidence_level"],
        "properties": {"terms": {"type": "array", "items": {"type": "string", "enum": sorted(set(shown))}}, "reasoning": {"type": "string"}, "evidence_level": {"type": "string", "enum": list(PERMITTED[mode])}},
    }


def read_replies(replies: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(record, terms, reasoning, claimed, problem)`` of ``replies (record, request_mode, reply)``.

    ``terms`` are the paths of the named display terms. A reply is bad if it is no object with a term list, if a term is no
    display term of the ontology, or if it claims evidence that its request does not permit.
    """
    r = replies.select("record", "request_mode", F.from_json("reply", REPLY).alias("r"))
    index = dimension(display_index(nodes))
    named = r.select("record", F.explode("r.terms").alias("t")).withColumn("norm", S.norm_keyword(F.col("t"))).join(index, "norm", "left")
    found = named.groupBy("record").agg(F.array_sort(F.collect_set("term")).alias("terms"), F.bool_or(F.col("term").isNull()).alias("unknown"))
    permitted = F.lit(False)
    for mode, levels in PERMITTED.items():
        permitted = permitted | ((F.col("request_mode") == mode) & F.col("r.evidence_level").isin(*levels))
    problem = (
        F.when(F.col("r.terms").isNull() | F.col("r.reasoning").isNull(), "reply").when(F.coalesce("unknown", F.lit(False)), "terms").when(~F.coalesce(permitted, F.lit(False)), "evidence")
    )
    out = r.join(found, "record", "left")
    return out.select("record", F.coalesce("terms", S.none_of()).alias("terms"), F.col("r.reasoning").alias("reasoning"), F.col("r.evidence_level").alias("claimed"), problem.alias("problem"))


def with_replies(direct: DataFrame, replies: DataFrame, nodes: DataFrame, strict: bool = True) -> DataFrame:
    """Nodes and evidence of records with a model's reply: ``(record, ...rendered, evidence_level, reasoning)``.

    ``direct (record, term)`` are the direct nodes, ``replies`` as :func:`read_replies` gives them. A bad reply fails if
    ``strict``, else the record keeps its direct nodes.
    """
    if strict:
        fail = F.raise_error(F.concat(F.lit("bad isolation reply of "), F.col("record"), F.lit(": "), F.col("problem"))).cast("boolean")
        replies = replies.filter(F.when(F.col("problem").isNotNull(), fail).otherwise(F.lit(True)))
    good = replies.withColumn("terms", F.when(F.col("problem").isNull(), F.col("terms")).otherwise(S.none_of())).withColumn("claimed", F.when(F.col("problem").isNull(), F.col("claimed")).otherwise(NONE))
    chosen = direct.select("record", "term").unionByName(good.select("record", F.explode("terms").alias("term"))).distinct()
    specific = lambda c: F.exists(c, lambda t: t != UNSPECIFIED)
    has_direct = direct.filter(F.col("term") != UNSPECIFIED).select("record", F.lit(True).alias("__d")).distinct()
    linked = with_crosslinks(chosen, crosslink_edges(nodes), "record")
    out = good.join(has_direct, "record", "left").join(render_nodes(linked, nodes, "record"), "record", "left")
    return out.select(
        "record", F.coalesce("categories", F.lit(UNSPECIFIED)).alias("categories"), F.coalesce("display_terms", F.lit(UNSPECIFIED)).alias("display_terms"), F.coalesce("ontology_links", F.lit("NA")).alias("ontology_links"), F.coalesce("term_paths", F.lit("")).alias("term_paths"),
        evidence_level(F.coalesce("__d", F.lit(False)), specific(F.col("terms")), F.col("claimed")).alias("evidence_level"), "reasoning",
    )
