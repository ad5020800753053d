"""The jobs from the command line: ``spark-submit nightfolio/__main__.py batch --help``."""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence
from dataclasses import asdict

from pyspark.sql import SparkSession

from nightfolio.plans.preview import show_layers
from nightfolio.plans.reservation_batch import BatchCounts, run_reservation_batch
from nightfolio.plans.serving_load import (
    recover_run,
    run_append_load,
    run_serving_load,
    run_upsert_load,
)
from nightfolio.plans.synthesis import synthesise_and_store
from nightfolio.sources.layers import layer_path
from nightfolio.sources.run_log import compact
from nightfolio.sources.snapshots import repair_snapshot


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="nightfolio")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, summary: str, *paths: str) -> argparse.ArgumentParser:
        one = jobs.add_parser(name, help=summary)
        for path in paths:
            one.add_argument(f"--{path}", required=True, metavar="PATH")
        return one

    synth = job("synthesise", "make reservations as CSV and JSON lines", "csv", "json")
    synth.add_argument("--count", type=int, required=True)
    synth.add_argument("--business-date", required=True)
    synth.add_argument("--property-code")
    synth.add_argument("--seed", type=int)
    synth.add_argument("--partitions", type=int)

    batch = job(
        "batch",
        "rebuild all layers from the raw CSV files",
        "raw", "layers",
    )
    batch.add_argument("--business-date", required=True)
    batch.add_argument("--money", choices=("double", "decimal"), default="double")
    batch.add_argument("--keep-stale-rejects", action="store_true")
    batch.add_argument("--gold-partition-by", nargs="*", default=[])
    batch.add_argument("--cluster-silver", action="store_true")

    def of_gold(name: str, summary: str, *paths: str) -> argparse.ArgumentParser:
        one = job(name, summary, *paths)
        source = one.add_mutually_exclusive_group(required=True)
        source.add_argument("--layers", metavar="PATH", help="take gold of the last batch there")
        source.add_argument("--gold", metavar="PATH", help="take a gold layer that lies there")
        return one

    load = of_gold("load", "merge gold into the serving table", "staging", "serving", "audit")
    load.add_argument("--business-date", required=True)
    load.add_argument("--run-id")
    load.add_argument("--batch-counts", help="what the batch printed, for the audit table")

    of_gold("upsert", "merge gold without run bookkeeping", "staging", "serving")
    append = of_gold("append", "append gold to a table", "table")
    append.add_argument("--run-id", help="append once for this id, to a table of versions")
    job("compact", "fold the audit log's records into its table", "audit")
    recover = job("recover", "record the end of a load that a commit notes", "serving", "audit")
    recover.add_argument("--run-id", required=True)
    job("repair", "remove what interrupted writers left in a table", "table")
    job("preview", "show the first rows of each layer", "layers")
    return parser


def run(spark: SparkSession, arguments: Sequence[str] | None = None):
    args = _parser().parse_args(arguments)
    if args.job == "synthesise":
        return synthesise_and_store(
            spark, args.count, args.business_date, args.csv, args.json,
            args.property_code, args.seed, args.partitions,
        )
    if args.job == "batch":
        return asdict(
            run_reservation_batch(
                spark, args.raw, args.layers,
                args.business_date, money=args.money, keep_stale_rejects=args.keep_stale_rejects,
                gold_partition_by=args.gold_partition_by, cluster_silver=args.cluster_silver,
            )
        )
    if args.job in ("load", "upsert", "append"):
        gold = args.gold or layer_path(spark, args.layers, "gold")
    if args.job == "load":
        return asdict(
            run_serving_load(
                spark, gold, args.staging, args.serving, args.audit,
                args.business_date, run_id=args.run_id,
                batch=args.batch_counts and BatchCounts(**json.loads(args.batch_counts)),
            )
        )
    if args.job == "upsert":
        return {"rows": run_upsert_load(spark, gold, args.staging, args.serving)}
    if args.job == "append":
        return {"rows": run_append_load(spark, gold, args.table, args.run_id)}
    if args.job == "compact":
        return {"records": compact(spark, args.audit)}
    if args.job == "recover":
        return {"recovered": recover_run(spark, args.serving, args.audit, args.run_id)}
    if args.job == "repair":
        return {"removed": repair_snapshot(spark, args.table)}
    show_layers(spark, args.layers)
    return None


def main() -> None:
    # Master, memory, time zone and jars are the caller's, through spark-submit.
    spark = SparkSession.builder.appName("nightfolio").getOrCreate()
    try:
        summary = run(spark)
        if summary is not None:
            print(json.dumps(summary))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
