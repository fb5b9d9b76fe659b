"""Command line of the standardisation: ``python -m sampleloom.run.cli --output-dir OUT --dimensions DIR ... [NAMES ...]``.

Tables are Parquet; ``DIR`` holds one table per vocabulary of :class:`sampleloom.plans.pipeline.Dimensions`. Candidates come
from ``--records`` and ``--candidates``, or from the candidate table of an extraction (``--extracted-metadata``). A folder of
configuration may hold ``pathogens.yaml`` (the registry), ``host.yaml`` (the host policy), ``location.yaml`` and
``isolation.yaml`` (prompts).
"""

from __future__ import annotations

import argparse
import datetime as dt
import importlib
import sys
from pathlib import Path

from sampleloom.operators.dataset import COLUMNS
from sampleloom.run import logs
from sampleloom.run.manifest import Snapshot, check_bundle, sha256_of
from sampleloom.run.outputs import Diagnostics, Outputs, prompt_snapshot
from sampleloom.run.runtime import Places, describe

TABLES = ("registry", "members", "taxa", "preempt", "nodes", "names", "aliases", "gazetteer", "remap", "official", "ontology", "catalog")
#: Vocabularies that other options bring.
OPTIONAL = {"catalog", "nodes", "names", "registry", "preempt"}
CONFIGS = ("pathogens.yaml", "host.yaml", "location.yaml", "isolation.yaml")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="sampleloom", description="Standardise sample metadata")
    p.add_argument("names", nargs="*", help="keys or containers of the registry; all that occur if none is given")
    p.add_argument("--output-dir", default=str(Places().output))
    p.add_argument("--output-file", help="dataset, instead of <output-dir>/<run-name>.tsv")
    p.add_argument("--run-name", default="run")
    p.add_argument("--records", help="table (accession, pathogen, bioproject_accession[, source_position])")
    p.add_argument("--candidates", help="table (record, pos, target, attribute, value, category)")
    p.add_argument("--extracted-metadata", help="candidate table of an extraction, instead of records and candidates")
    p.add_argument("--dimensions", required=True, help="folder of the vocabulary tables")
    p.add_argument("--config-dir", help="folder of YAML configuration")
    p.add_argument("--registry-file", help="registry as YAML, instead of the table")
    p.add_argument("--names-dmp", help="taxonomy names, instead of the table")
    p.add_argument("--nodes-dmp", help="taxonomy nodes, instead of the table")
    p.add_argument("--attribute", action="append", choices=sorted(COLUMNS), help="repeatable; all if not given")
    p.add_argument("--reference-date", type=dt.date.fromisoformat, help="today, or the day of the snapshot, if not given")
    p.add_argument("--snapshot", help="manifest of the source snapshot; inputs must be its files")
    p.add_argument("--bundle", help="folder of the extraction bundle; it must be whole")
    p.add_argument("--model", help="name of the model")
    p.add_argument("--model-client", help="module:function that takes a request text and gives a reply; the executors must be able to import it")
    p.add_argument("--model-cache", help="table (fingerprint, reply) of earlier answers; fresh ones are written beside the dataset")
    p.add_argument("--skip-llm", action="store_true", help="no model is asked, earlier answers included")
    p.add_argument("--single-file", action="store_true", help="the dataset as one part, written by one task")
    p.add_argument("--force", action="store_true", help="replace outputs that are there")
    p.add_argument("--debug", action="store_true")
    p.add_argument("--quiet", action="store_true")
    return p


def _client(spec: str | None):
    if not spec:
        return None
    module, _, name = spec.partition(":")
    return getattr(importlib.import_module(module), name)


def _configs(folder: str | None) -> dict[str, dict]:
    from sampleloom.sources.dimensions import load_config

    found = {n: Path(folder) / n for n in CONFIGS} if folder else {}
    return {n: load_config(p) for n, p in found.items() if p.exists()}


def _checked_sources(args: argparse.Namespace, log) -> dt.date | None:
    """The day of the snapshot, after the snapshot and the bundle have been found whole."""
    day = None
    if args.snapshot:
        snapshot = Snapshot.load(args.snapshot)
        day = snapshot.reference_date
        if args.bundle:
            import yaml

            document = yaml.safe_load((Path(args.bundle) / "provenance.yaml").read_text(encoding="utf-8"))
            check_bundle(document, args.bundle, {k: args.snapshot for k in document["source_manifests"]})
        log.info("snapshot %s of %s", snapshot.snapshot_id, day)
    return day


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    attributes = tuple(a for a in ("date", "loc", "iso", "host") if not args.attribute or a in args.attribute)
    if not args.extracted_metadata and not (args.records and args.candidates):
        parser().error("records and candidates, or extracted metadata are needed")
    with_model = bool(args.model) and not args.skip_llm
    outputs = Outputs.plan(args.output_dir, args.run_name, attributes, with_model, args.output_file)
    Path(args.output_dir).mkdir(parents=True, exist_ok=True)
    inputs = [x for x in (args.records, args.candidates, args.extracted_metadata) if x]
    outputs.check(inputs, args.force)
    log = logs.setup(outputs.log, "DEBUG" if args.debug else "INFO", args.quiet)
    configs = [Path(args.config_dir) / n for n in CONFIGS if args.config_dir and (Path(args.config_dir) / n).exists()]
    run = Diagnostics(outputs.diagnostics, attributes=attributes, names=args.names, model=args.model if with_model else None, runtime=describe([*configs, *([args.registry_file] if args.registry_file else [])]), inputs={p: sha256_of(p) for p in inputs if Path(p).exists()})
    try:
        run.phase("planning")
        day = _checked_sources(args, log)
        from pyspark.sql import Observation, SparkSession
        from pyspark.sql import functions as F

        from sampleloom.operators import dataset as T
        from sampleloom.operators import model_requests as M
        from sampleloom.operators.host_policy import HostPolicy
        from sampleloom.operators.isolation import render_tree
        from sampleloom.plans import pipeline as PL
        from sampleloom.plans.extraction import long_candidates, scan_candidates
        from sampleloom.plans.model_stage import Model, Prompts
        from sampleloom.run.registry import Registry
        from sampleloom.session import cut, ship
        from sampleloom.sources.tables import scan_taxonomy, write_tsv

        spark = SparkSession.builder.getOrCreate()
        ship(spark)
        logs.progress(spark, args.quiet)
        configured = _configs(args.config_dir)
        dims = {n: spark.read.parquet(f"{args.dimensions}/{n}") for n in TABLES if n not in OPTIONAL or (Path(args.dimensions) / n).exists()}
        if args.nodes_dmp and args.names_dmp:
            dims["nodes"], dims["names"] = scan_taxonomy(spark, args.nodes_dmp, args.names_dmp)
        if args.registry_file or "pathogens.yaml" in configured:
            registry = Registry.load(args.registry_file) if args.registry_file else Registry(configured["pathogens.yaml"])
            dims["registry"] = registry.frame(spark)
            keys = registry.expand(args.names) if args.names else list(registry.leaves)
        else:
            known = [r[0] for r in dims["registry"].orderBy("ordinal").select("key").collect()]
            if unknown := set(args.names) - set(known):
                raise ValueError(f"unknown names: {', '.join(sorted(unknown))}")
            keys = args.names or known
        if "host.yaml" in configured:
            policy = HostPolicy.of(configured["host.yaml"])
            policy.require(spark, dims["taxa"])
            dims |= {"preempt": policy.preempt(spark), "curated": policy.curated(spark), "ignored_substrings": policy.ignored, "isolation_keywords": policy.keywords}
        model = None
        if with_model:
            rows = [(r["term"], r["display_term"], r["term_comment"]) for r in dims["ontology"].orderBy("term").collect()]
            prompts = Prompts.of(configured.get("location.yaml"), configured.get("isolation.yaml"), render_tree(rows)[0])
            outputs.prompts and outputs.prompts.write_text(prompt_snapshot(prompts.sections(args.model)), encoding="utf-8")
            model = Model(args.model, _client(args.model_client), prompts=prompts, cache=spark.read.parquet(args.model_cache) if args.model_cache else None)
        if args.extracted_metadata:
            table = scan_candidates(spark, args.extracted_metadata)
            records, candidates = table.select("accession", "pathogen", "bioproject_accession", "source_position"), long_candidates(table)
        else:
            records, candidates = spark.read.parquet(args.records), spark.read.parquet(args.candidates)
        run.phase("dataset_streaming")
        got = PL.run(records, candidates, PL.Dimensions(**dims), PL.Request(keys, attributes, args.reference_date or day or dt.date.today(), model=model))
        place = "source_position" if "source_position" in records.columns else "accession"
        final = T.project_final(got.rows, attributes, dims["registry"], dims["members"], [place] if place != "accession" else [])
        seen = Observation("rows")
        final = final.observe(seen, F.count("*").alias("n"))
        write_tsv(final, str(outputs.dataset), [place], args.single_file, drop=[place] if place != "accession" else [])
        if outputs.reasoning is not None:
            PL.reasoning_lines(got).orderBy("accession").select("line").write.mode("overwrite").text(str(outputs.reasoning))
        run.phase("reporting")
        report = cut(PL.build_report(got))
        counters: dict = {}
        for r in report.collect():
            counters.setdefault(r["attribute"], {}).setdefault(r["pathogen"] or "all", {})[r["metric"]] = r["n"]
        for r in T.recoverable_warnings(report).collect():
            log.warning("%s: %d record(s)", r["warning"][:1].upper() + r["warning"][1:], r["n"])
        calls = [r.asDict() for r in M.metrics(got.calls, "target", "model").collect()] if got.calls is not None else []
        if got.calls is not None and args.model_cache:
            for target, cache in got.caches.items():
                cache.write.mode("overwrite").parquet(f"{args.output_dir}/{args.run_name}_cache_{target}")
        n = seen.get["n"]
        processed = {r["pathogen"] or "all": r["n"] for r in T.processed_rows(report).collect()}
        run.finish("succeeded", rows=n, counters=counters, processed_rows=processed.get("all", n), cache_hits={r["attribute"]: r["n"] for r in T.cache_hits(report).collect()}, model_calls=calls)
        log.info("%d rows written to %s", n, outputs.dataset)
        return 0
    except KeyboardInterrupt as e:
        run.finish("interrupted", e)
        return 130
    except Exception as e:  # noqa: BLE001 - every failure is written down
        run.finish("failed", e)
        log.error("%s", run.document["error"]["message"])
        return 1


if __name__ == "__main__":
    sys.exit(main())
