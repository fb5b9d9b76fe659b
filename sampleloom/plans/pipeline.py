"""The whole harmonisation as one plan: dates, locations, hosts, isolation sources, host retry, lineage, final table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sampleloom.functions import strings as S
from sampleloom.functions.text import not_blank
from sampleloom.operators import dataset as T
from sampleloom.operators.date_records import reduce_dates
from sampleloom.operators import hosts as H
from sampleloom.operators import isolation as I
from sampleloom.operators import lineage as L
from sampleloom.operators import places as G
from sampleloom.operators.ranking import dimension
from sampleloom.plans.model_stage import Model, isolation_answers, location_answers
from sampleloom.session import cut


@dataclass(frozen=True)
class Dimensions:
    """Vocabularies of a run, each a table of its own; a user brings larger ones through the same columns."""

    registry: DataFrame
    members: DataFrame
    taxa: DataFrame
    preempt: DataFrame
    nodes: DataFrame
    names: DataFrame
    aliases: DataFrame
    gazetteer: DataFrame
    remap: DataFrame
    official: DataFrame
    ontology: DataFrame
    catalog: DataFrame | None = None
    ignored_substrings: Sequence[str] = ()
    isolation_keywords: Sequence[str] = ()
    coordinate_attributes: Sequence[str] = ()
    retry_triggers: Sequence[str] = T.RETRY_TRIGGERS
    curated: DataFrame | None = None


@dataclass(frozen=True)
class Request:
    """What a run is asked for; the attributes decide which steps are in the plan at all."""

    pathogens: Sequence[str]
    attributes: Sequence[str] = ("date", "loc", "iso", "host")
    reference_date: dt.date = dt.date(2026, 7, 9)
    #: replacements of the steps ``date``, ``loc``, ``host``, ``iso`` and ``lineage``, with the arguments of those below
    stages: Mapping[str, Callable] = field(default_factory=dict)
    #: the model that is asked about what the steps leave open; none without it
    model: Model | None = None

    def __post_init__(self) -> None:
        for name, values in (("pathogens", self.pathogens), ("attributes", self.attributes)):
            if not values or len(set(values)) != len(values):
                raise ValueError(f"{name} must be given once each")
        if unknown := set(self.attributes) - T.COLUMNS.keys():
            raise ValueError(f"unknown attributes: {', '.join(sorted(unknown))}")
        if unknown := set(self.stages) - {*T.COLUMNS, "lineage"}:
            raise ValueError(f"unknown stages: {', '.join(sorted(unknown))}")


@dataclass(frozen=True)
class Run:
    """Wide rows of a run, the outcome of each step that was asked for, caches by target and the calls of a model."""

    chosen: DataFrame
    rows: DataFrame
    outcomes: Mapping[str, DataFrame]
    caches: Mapping[str, DataFrame]
    calls: DataFrame | None


def candidates_of(candidates: DataFrame, target: str) -> DataFrame:
    return candidates.filter(F.col("target") == target).select("record", "pos", "attribute", "value", "category")


def origins(cands: DataFrame, prefix: str) -> DataFrame:
    """``(record, <prefix>_attr_orig, <prefix>_val_orig)`` of all candidates in reading order."""
    g = cands.groupBy("record").agg(F.array_sort(F.collect_list(F.struct("pos", "attribute", "value"))).alias("c"))
    return g.select("record", F.array_join("c.attribute", "||").alias(f"{prefix}_attr_orig"), F.array_join(F.transform("c", lambda x: F.coalesce(x["value"], F.lit(""))), "||").alias(f"{prefix}_val_orig"))


def date_step(cands: DataFrame, reference_date: dt.date) -> DataFrame:
    o = reduce_dates(cands, reference_date)
    return o.select(
        "record", F.col("attributes").alias("date_attr_orig"), F.col("values").alias("date_val_orig"), F.col("start").cast("string").alias("date_start"), F.col("end").cast("string").alias("date_end"),
        F.col("score").alias("date_score"), "diagnostics",
    )


def location_step(cands: DataFrame, dims: Dimensions) -> DataFrame:
    """Locations as :func:`sampleloom.operators.places.standardize_places` gives them."""
    return G.standardize_places(cands, dims.aliases, dims.gazetteer, dims.remap, dims.official, dims.coordinate_attributes)


def host_step(cands: DataFrame, dims: Dimensions, keywords: Sequence[str]) -> DataFrame:
    o = H.standardize_hosts(cands, dims.taxa, dims.preempt, dims.ignored_substrings, keywords, dims.curated)
    return o.select(
        "record", F.col("attribute").alias("host_attr_orig"), F.col("value").alias("host_val_orig"), F.col("taxid").alias("host_taxid"), F.col("scientific_name").alias("host_scientific_name"), F.col("score").alias("host_score"),
        F.col("low_confidence").alias("host_low_conf"), "overflow", "diagnostics",
    )


def isolation_candidates(cands: DataFrame, hosts: DataFrame | None, host_cands: DataFrame) -> DataFrame:
    """Isolation candidates, with the host values of records whose host step found none, behind them."""
    every = cands.select("record", "pos", "attribute", "value")
    if hosts is None:
        return every
    last = cands.groupBy("record").agg(F.max("pos").alias("__last"))
    over = host_cands.join(hosts.filter("overflow").select("record"), "record", "left_semi").join(last, "record", "left")
    return every.unionByName(over.select("record", (F.coalesce("__last", F.lit(-1)) + 1 + F.col("pos")).alias("pos"), "attribute", "value"))


def isolation_step(every: DataFrame, dims: Dimensions, contexts: DataFrame | None) -> DataFrame:
    """Isolation sources as :func:`sampleloom.operators.isolation.standardize_isolation` gives them."""
    return I.standardize_isolation(every, dims.ontology, contexts)


def lineage_step(found: DataFrame, dims: Dimensions) -> DataFrame:
    """``found`` with the names and lineage of its taxids."""
    line = dimension(L.lineages(dims.nodes, dims.names).join(dimension(found.select(F.col("host_taxid").alias("taxid")).distinct()), "taxid", "left_semi")).withColumnRenamed("taxid", "host_taxid")
    line = line.select("host_taxid", F.col("common_names").alias("host_common_names"), F.col("lineage_names").alias("host_lineage_names"), F.col("lineage_taxids").alias("host_lineage_taxids"))
    return found.join(line, "host_taxid", "left")


def run(records: DataFrame, candidates: DataFrame, dims: Dimensions, request: Request) -> Run:
    """All outcomes of the selected records, and one wide row of each that has any (before projection).

    ``records (accession, pathogen, bioproject_accession)``, ``candidates (record, pos, target, attribute, value,
    category)``. The candidates are cut once, as every step reads them.
    """
    chosen = T.select_groups(records, request.pathogens)
    cands = cut(candidates.join(chosen.select(F.col("accession").alias("record")), "record", "left_semi"))
    want, model = set(request.attributes), request.model
    step = lambda name, usual: request.stages.get(name, usual)
    outcomes: dict[str, DataFrame] = {}
    caches: dict[str, DataFrame] = {}
    calls: list[DataFrame] = []
    parts: dict[str, DataFrame] = {}
    host_cands, iso_cands = candidates_of(cands, "host"), candidates_of(cands, "iso")
    if "date" in want:
        outcomes["date"] = step("date", date_step)(candidates_of(cands, "date"), request.reference_date)
        parts["date"] = outcomes["date"].filter("date_start is not null").drop("diagnostics")
    if "loc" in want:
        loc_cands = candidates_of(cands, "loc")
        found = step("loc", location_step)(loc_cands, dims)
        if model is not None:
            answered = location_answers(cut(found), model, dims.aliases, dims.remap, dims.official)
            found, caches["location"] = answered.outcomes, answered.cache
            calls += [answered.calls] if answered.calls is not None else []
        outcomes["loc"] = cut(found)
        shown = outcomes["loc"].filter("country is not null").join(origins(loc_cands, "loc"), "record", "left")
        parts["loc"] = shown.select("record", "loc_attr_orig", "loc_val_orig", F.col("un_region").alias("loc_un_region"), F.col("country").alias("loc_country"), F.col("sublocation").alias("loc_sublocation"))
    if "host" in want:
        outcomes["host"] = cut(step("host", host_step)(host_cands, dims, dims.isolation_keywords))
    if "iso" in want:
        contexts = None
        if dims.catalog is not None:
            links = chosen.select(F.col("accession").alias("record"), S.pipe_split(F.col("bioproject_accession")).alias("accessions"))
            contexts = I.project_contexts(links, dims.catalog, "record", "accessions")
            contexts = cut(contexts) if model is not None else contexts
        every = isolation_candidates(iso_cands, outcomes.get("host"), host_cands)
        every = cut(every) if model is not None else every
        found = step("iso", isolation_step)(every, dims, contexts)
        if model is not None:
            context = outcomes["host"].select("record", F.col("host_scientific_name").alias("host")) if "host" in want else None
            answered = isolation_answers(cut(found), every, model, dims.ontology, contexts, context)
            found, caches["isolation"] = answered.outcomes, answered.cache
            calls += [answered.calls] if answered.calls is not None else []
        outcomes["iso"] = cut(found)
        shown = outcomes["iso"].join(origins(every.filter(not_blank(F.col("value"))), "iso"), "record", "left")
        parts["iso"] = shown.select("record", "iso_attr_orig", "iso_val_orig", F.col("term_paths").alias("iso_term_paths"), F.col("display_terms").alias("iso_display_terms"), F.col("ontology_links").alias("iso_ontology_links"))
    if "host" in want:
        hosts = outcomes["host"]
        if "iso" in want:
            paths = outcomes["iso"].select("record", "term_paths")
            has_sample = iso_cands.filter(not_blank(F.col("value"))).select("record", F.lit(True).alias("__sample")).distinct()
            again = hosts.filter("host_taxid is null").select("record").unionByName(iso_cands.select("record")).distinct()
            eligible = again.join(hosts.select("record", F.col("host_taxid").alias("__t")), "record", "left").join(paths, "record").join(has_sample, "record", "left")
            eligible = eligible.filter(T.retry_eligible(F.col("__t"), F.col("term_paths"), F.coalesce("__sample", F.lit(False)), dims.retry_triggers))
            retried = step("host", host_step)(iso_cands.join(eligible.select("record"), "record", "left_semi"), dims, ()).filter("host_taxid is not null")
            retried = cut(retried.withColumn("diagnostics", F.concat("diagnostics", F.array(F.lit("retry_resolution")))))
            hosts = outcomes["host"] = hosts.join(retried.select("record"), "record", "left_anti").unionByName(retried)
        parts["host"] = step("lineage", lineage_step)(hosts.filter("host_taxid is not null").drop("overflow", "diagnostics"), dims)
    out = chosen
    for a in ("date", "loc", "iso", "host"):
        if a in parts:
            out = out.join(parts[a].withColumnRenamed("record", "accession"), "accession", "left")
    signs = {"date": "date_start", "loc": "loc_country", "iso": "iso_display_terms", "host": "host_taxid"}
    every_call = calls[0] if calls else None
    for c in calls[1:]:
        every_call = every_call.unionByName(c)
    return Run(chosen, out.filter(T.accepted(*[F.col(signs[a]) for a in request.attributes])), outcomes, caches, every_call)


def harmonize(records: DataFrame, candidates: DataFrame, dims: Dimensions, request: Request) -> DataFrame:
    """The wide rows of :func:`run`."""
    return run(records, candidates, dims, request).rows


def reasoning_lines(r: Run, origins_of: DataFrame | None = None) -> DataFrame:
    """``(accession, line)``: one JSON line for each isolation outcome, with its reasoning, evidence and origins."""
    o = r.outcomes["iso"].withColumnRenamed("record", "accession")
    o = o if "reasoning" in o.columns else o.withColumn("reasoning", S.none_of())
    hosts = r.outcomes["host"].select(F.col("record").alias("accession"), "host_scientific_name", F.col("host_val_orig").alias("__raw")) if "host" in r.outcomes else None
    o = o.join(hosts, "accession", "left") if hosts is not None else o.withColumns({"host_scientific_name": F.lit(None).cast("string"), "__raw": F.lit(None).cast("string")})
    shown = r.rows.select("accession", "iso_attr_orig", "iso_val_orig")
    j = o.join(r.chosen.select("accession", "pathogen"), "accession").join(shown, "accession", "left")
    pairs = F.arrays_zip(S.pipe_split(F.col("iso_attr_orig")).alias("attribute"), S.pipe_split(F.col("iso_val_orig")).alias("value"))
    line = T.reasoning_line({
        "accession": F.col("accession"), "pathogen": F.col("pathogen"), "origins": pairs, "host_context": T.host_context(F.col("host_scientific_name"), F.col("__raw")), "categories": F.col("categories"), "term_paths": F.col("term_paths"),
        "display_terms": F.col("display_terms"), "ontology_links": F.col("ontology_links"), "evidence_level": F.col("evidence_level"), "diagnostics": F.col("diagnostics"), "reasoning": F.col("reasoning"),
    })
    return j.select("accession", line.alias("line"))


def build_report(r: Run) -> DataFrame:
    """``(attribute, pathogen, metric, n)`` of every outcome, by pathogen and in all (null pathogen); see :func:`sampleloom.operators.dataset.outcome_report`."""
    signs = {"date": "date_start", "loc": "country", "iso": "display_terms", "host": "host_taxid"}
    parts = []
    for name, o in r.outcomes.items():
        d = F.col("diagnostics") if "diagnostics" in o.columns else F.array("diagnostic")
        parts.append(o.select(F.lit(name).alias("attribute"), F.col("record").alias("accession"), F.col(signs[name]).isNotNull().alias("standardized"), d.alias("diagnostics")))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    # every chosen record is processed for every attribute, also one without candidates
    asked = r.chosen.select("accession", "pathogen", F.explode(F.array(*[F.lit(a) for a in r.outcomes])).alias("attribute"))
    return T.outcome_report(asked.join(every, ["attribute", "accession"], "left").withColumn("standardized", F.coalesce("standardized", F.lit(False))))


def final_table(records: DataFrame, candidates: DataFrame, dims: Dimensions, request: Request) -> DataFrame:
    """The standardised table in its fixed column order."""
    return T.project_final(harmonize(records, candidates, dims, request), request.attributes, dims.registry, dims.members)
