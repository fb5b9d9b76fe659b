"""Command lines before the standardisation.

``python -m sampleloom.run.extract_cli extract``: sample and project XML to the candidate table, catalog and reviews.
``... id-lists``: taxonomy closure and catalog scope to id lists, their manifest and the XML subset, in one scan of the dump.
``... index``: id lists and catalog to the index.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from sampleloom.run import logs
from sampleloom.run.runtime import Places


def parser() -> argparse.ArgumentParser:
    d = Places()
    p = argparse.ArgumentParser(prog="sampleloom-extract", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = p.add_subparsers(dest="command", required=True)
    e = commands.add_parser("extract")
    e.add_argument("--output", required=True, help="folder of the bundle")
    e.add_argument("--samples", default=str(d.samples))
    e.add_argument("--projects", default=str(d.projects))
    e.add_argument("--index", default=str(d.index), help="table that gives the pathogen of an accession")
    e.add_argument("--rules", required=True, help="curation rules as YAML")
    e.add_argument("--names", nargs="*", default=[], help="keys to keep; all if not given")
    e.add_argument("--manifest", help="snapshot manifest of the inputs")
    i = commands.add_parser("id-lists")
    i.add_argument("dump", nargs="?", default=str(d.samples))
    i.add_argument("--registry", required=True, help="registry as YAML")
    i.add_argument("--catalog", help="catalog metadata (accession, osf_tarball_filename, sylph_species)")
    i.add_argument("--nodes-dmp", default=str(d.taxonomy[1]))
    i.add_argument("--merged-dmp")
    i.add_argument("--id-lists-dir", required=True)
    i.add_argument("--subset", help="folder of the XML subset; none if not given")
    x = commands.add_parser("index")
    x.add_argument("catalog")
    x.add_argument("--registry", required=True)
    x.add_argument("--id-lists-dir", required=True)
    x.add_argument("--output", default=str(d.index))
    for c in (e, i, x):
        c.add_argument("--log-file")
        c.add_argument("--log-level", default="INFO")
        c.add_argument("--quiet", action="store_true")
    return p


def extract(spark, args, log) -> None:
    from sampleloom.operators.curation import CurationRules
    from sampleloom.plans import extraction as E
    from sampleloom.run.manifest import Snapshot
    from sampleloom.sources import xml
    from sampleloom.sources.dimensions import load_config

    manifests = {}
    if args.manifest:
        snapshot = Snapshot.load(args.manifest)
        snapshot.check_inputs([args.samples, args.projects])
        manifests["source"] = (snapshot.snapshot_id, args.manifest)
    got = E.extract(xml.scan_samples(spark, args.samples), xml.scan_projects(spark, args.projects), E.scan_index(spark, args.index), CurationRules.of(load_config(args.rules)), args.names)
    E.write_bundle(got, args.output, f"{args.output}.staging", manifests)
    log.info("candidates: %s", got.counters.first().asDict())


CATALOG = "accession string, osf_tarball_filename string, sylph_species string"


def _catalog(spark, path: str, registry):
    """``(accession, label, tarball)`` of the catalog and ``(label, key)`` of its labels."""
    from pyspark.sql import functions as F

    from sampleloom.operators.index import map_labels
    from sampleloom.sources.tables import scan_tsv

    rows = scan_tsv(spark, path, CATALOG).select("accession", F.col("sylph_species").alias("label"), F.col("osf_tarball_filename").alias("tarball"))
    return rows, map_labels(rows.select("label"), registry.frame(spark))


def id_lists(spark, args, log) -> None:
    from pyspark.sql import functions as F

    from sampleloom.operators import lineage as L
    from sampleloom.plans import subset as S
    from sampleloom.run.files import Store
    from sampleloom.run.registry import Registry
    from sampleloom.session import cut
    from sampleloom.sources import dimensions as D
    from sampleloom.sources.tables import scan_merged, scan_nodes, write_tsv

    registry = Registry.load(args.registry)
    closed = L.closure(scan_nodes(spark, args.nodes_dmp), registry.seeds(spark))
    if args.merged_dmp:
        closed = L.with_retired(cut(closed), scan_merged(spark, args.merged_dmp))
    scope = None
    if args.catalog and args.subset:
        rows, keys = _catalog(spark, args.catalog, registry)
        scope = rows.join(keys.filter("key <> 'NA'"), "label").select("accession")
    got = S.select_samples(S.raw_samples(spark, args.dump), closed, scope)
    D.write_id_lists(got.lists, args.id_lists_dir)
    if args.subset:
        S.write_subset(got.elements, args.subset)
    rows = D.hashed_manifest(got.lists, registry.frame(spark), args.id_lists_dir, args.dump.rpartition("/")[2], dt.date.today().isoformat())
    names = ("pathogen", "run_date", "taxids", "source", "rows", "status", "sha256")
    Store(spark).write_text(f"{args.id_lists_dir}/manifest.tsv", "".join("\t".join(map(str, r)) + "\n" for r in [names, *([r[n] for n in names] for r in rows)]))
    log.info("rows: %s", {r["pathogen"]: r["rows"] for r in rows})


def index(spark, args, log) -> None:
    from sampleloom.operators import index as X
    from sampleloom.run.registry import Registry
    from sampleloom.sources import dimensions as D

    registry = Registry.load(args.registry)
    rows, keys = _catalog(spark, args.catalog, registry)
    lists = D.first_listed(D.scan_written_lists(spark, args.id_lists_dir))
    got = X.outer_index(lists, rows.dropDuplicates(["accession"]), keys)
    D.write_index(got, args.output)
    log.info("index: %s", X.index_counts(got).first().asDict())


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    log = logs.setup(args.log_file, args.log_level, args.quiet)
    try:
        from pyspark.sql import SparkSession

        from sampleloom.session import ship

        spark = SparkSession.builder.getOrCreate()
        ship(spark)
        logs.progress(spark, args.quiet)
        {"extract": extract, "id-lists": id_lists, "index": index}[args.command](spark, args, log)
        return 0
    except Exception as e:  # noqa: BLE001 - every failure is told and ends with a code
        log.error("%s", e)
        return 1


if __name__ == "__main__":
    sys.exit(main())
