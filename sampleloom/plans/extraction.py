"""Extraction: sample XML and project XML to the candidate table, the project catalog and the review reports."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sampleloom.functions import strings as S
from sampleloom.operators import curation as C
from sampleloom.operators.index import last_wins
from sampleloom.run.manifest import provenance
from sampleloom.session import cut
from sampleloom.sources import projects as P
from sampleloom.sources.tables import write_tsv
from sampleloom.sources.xml import require_numeric

COLUMNS = ("accession", "bioproject_id", "bioproject_accession", "pathogen", "date_category", *(f"{t}_{n}_orig" for t in C.TARGETS for n in ("attr", "val")))


@dataclass(frozen=True)
class Extraction:
    candidates: DataFrame
    catalog: DataFrame
    unresolved: DataFrame
    unreviewed: DataFrame
    uncertain: DataFrame
    rejections: DataFrame
    counters: DataFrame


def extract(samples: DataFrame, projects: DataFrame, index: DataFrame, rules: C.CurationRules, names: Sequence[str] = (), evaluate: Callable[[DataFrame], DataFrame] | None = None) -> Extraction:
    """All tables of an extraction.

    ``samples`` and ``projects`` as their scans give them, ``index (accession, pathogen_biosample, seq)``: the last row of an
    accession counts. Reviews see every sample; the candidate table holds the samples of the index (of ``names``, if given)
    that have a matched candidate or a linked project. Duplicate ids or accessions of resolved projects fail.
    """
    raw = samples.select("accession", F.posexplode("candidates").alias("pos", "c")).select("accession", "pos", "c.*")
    decided = cut((evaluate or (lambda df: C.curate(df, rules)))(raw))
    keys = last_wins(index, "accession", "pathogen_biosample", ["seq"]).withColumnRenamed("pathogen_biosample", "pathogen")
    keys = keys.filter(F.col("pathogen").isin(*names)) if names else keys
    rows = samples.select("accession", require_numeric(F.col("project_ids")).alias("ids")).join(keys, "accession")
    lists = C.assemble(decided.filter(F.size("matches") > 0), "accession", ["pos"])
    kept = cut(rows.join(lists, "accession", "left").filter((F.size("ids") > 0) | F.col("date_category").isNotNull()))
    wanted = kept.select(F.explode("ids").alias("id")).distinct()
    catalog = cut(P.resolve_contexts(projects, wanted))
    if bad := P.duplicate_keys(catalog).limit(1).collect():
        raise ValueError(f"project {bad[0]['key_name']} {bad[0]['key']} occurs {bad[0]['n']} times")
    resolved = P.attach_accessions(kept, "accession", "ids", catalog)
    table = kept.join(resolved, "accession", "left").withColumns({"bioproject_id": S.pipe_join(F.col("ids")), "bioproject_accession": F.coalesce(S.pipe_join(F.col("accessions")), F.lit(""))})
    links = kept.select("accession", F.explode("ids").alias("id"))
    return Extraction(
        table.select(*[F.coalesce(c, F.lit("")).alias(c) for c in COLUMNS]), catalog, P.unresolved_links(links, catalog), C.review_report(decided, C.UNREVIEWED, "normalized_attribute"),
        C.review_report(decided, C.UNCERTAIN, "normalized_value"), C.rejection_counts(decided), C.counters(decided),
    )


def long_candidates(table: DataFrame) -> DataFrame:
    """``(record, pos, target, attribute, value, category)`` of a candidate table; lists of unequal length fail."""
    parts = []
    for t in C.TARGETS:
        attrs, vals = S.pipe_split(F.col(f"{t}_attr_orig")), S.pipe_split(F.col(f"{t}_val_orig"))
        cats = S.pipe_split(F.col("date_category")) if t == "date" else F.transform(vals, lambda _: F.lit(""))
        equal = (F.size(attrs) == F.size(vals)) & (F.size(vals) == F.size(cats))
        # values of one blank item are lists of one; an empty date category then stands for no candidate
        zipped = F.when(equal, F.arrays_zip(attrs.alias("a"), vals.alias("v"), cats.alias("c"))).otherwise(F.raise_error(F.concat(F.lit(f"malformed {t} candidates of "), F.col("accession"))).cast("array<struct<a:string,v:string,c:string>>"))
        parts.append(table.select(F.col("accession").alias("record"), F.lit(t).alias("target"), F.posexplode(zipped).alias("pos", "z")).select("record", F.col("pos").cast("long").alias("pos"), "target", F.col("z.a").alias("attribute"), F.col("z.v").alias("value"), F.col("z.c").alias("category")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_bundle(e: Extraction, folder: str, staging: str, manifests: dict[str, tuple[str, str]], reviews: bool = True) -> None:
    """Candidate table, catalog and provenance as one bundle in any store, the marker published last; reviews beside it."""
    import yaml

    from sampleloom.run.files import Store

    store = Store(e.candidates.sparkSession)
    stage = lambda n: f"{staging}/{n}"
    store.make_folder(staging)
    write_tsv(e.candidates, stage("extracted_metadata.tsv"), ["accession"])
    P.write_catalog(e.catalog, stage("bioproject_context.jsonl"))
    if reviews:
        for name, df, order in (("unreviewed_attributes.tsv", e.unreviewed, ["target", "family", "norm"]), ("uncertain_rejections.tsv", e.uncertain, ["target", "family", "norm"]), ("unresolved_bioproject_links.tsv", e.unresolved, ["id"])):
            if df.limit(1).count():
                write_tsv(df, f"{folder}/{name}", order)
    names, marker = ("extracted_metadata.tsv", "bioproject_context.jsonl"), "provenance.yaml"
    store.write_text(stage(marker), yaml.safe_dump(provenance(manifests, {n: stage(n) for n in names}, store.sha256), sort_keys=True))
    store.publish({n: stage(n) for n in (*names, marker)}, folder, marker)


def scan_index(spark: SparkSession, path: str) -> DataFrame:
    from sampleloom.sources.tables import scan_tsv

    return scan_tsv(spark, path, "accession string, pathogen_biosample string").withColumn("seq", F.monotonically_increasing_id())


def scan_candidates(spark: SparkSession, path: str) -> DataFrame:
    """A written candidate table with the order of its rows as ``source_position``."""
    from sampleloom.sources.tables import scan_tsv

    return scan_tsv(spark, path, ", ".join(f"{c} string" for c in COLUMNS)).withColumn("source_position", F.monotonically_increasing_id())
