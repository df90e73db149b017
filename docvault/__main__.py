"""Command-line entry: ``spark-submit -m docvault`` style job launcher (or ``python -m docvault``).

    python -m docvault backup  --store PATH --client NAME --config CONFIG.json --out DIR
                               [--indexes PATH] [--skip-indexes] [--format parquet|jsonl|array]
                               [--compression CODEC] [--cluster]
    python -m docvault restore --dir RUN_DIR --target ROOT [--skip-indexes] [--manifest PATH] [--lenient] [--verify]
                               [--stream CHECKPOINT]

``--store`` is a parquet table ``(client, tenant, type, id, doc)``, or the root of a target written by a
restore (its ``documents`` table is used), so environment-to-environment migration is a backup of one
target root followed by a restore into another.  ``--indexes`` is a parquet table
``(client, tenant, type, pos, keys, options)`` or a target root.  The Spark master and resources come from spark-submit.
"""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import SparkSession

from docvault.model import INDEX_SCHEMA, MANIFEST_NAME
from docvault.plans.backup import run_backup
from docvault.plans.migrate import verify_restore
from docvault.plans.restore import indexes_root, run_restore
from docvault.session import path_exists
from docvault.sinks.snapshot import numbers, read_snapshot
from docvault.sinks.target import docs_root, read_target, stored_types
from docvault.sources.config import read_backup_config, read_manifest
from docvault.streaming.restore import stream_restore


def _store(spark: SparkSession, path: str):
    if path_exists(spark, docs_root(path)):
        return read_target(spark, path)
    return spark.read.parquet(path).select("client", "tenant", "type", "id", "doc")


def _indexes(spark: SparkSession, path: str):
    """An index table, or the current one of a target root."""
    if path_exists(spark, docs_root(path)):
        return read_snapshot(spark, indexes_root(path), INDEX_SCHEMA)
    if numbers(spark, path):
        return read_snapshot(spark, path, INDEX_SCHEMA)
    return spark.read.parquet(path)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="docvault")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("backup")
    b.add_argument("--store", required=True)
    b.add_argument("--client", required=True)
    b.add_argument("--config", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--indexes")
    b.add_argument("--skip-indexes", action="store_true")
    b.add_argument("--format", default="parquet", choices=["parquet", "jsonl", "array"])
    b.add_argument("--compression")
    b.add_argument("--cluster", action="store_true")
    r = sub.add_parser("restore")
    r.add_argument("--dir", required=True)
    r.add_argument("--target", required=True)
    r.add_argument("--manifest")
    r.add_argument("--skip-indexes", action="store_true")
    r.add_argument("--lenient", action="store_true")
    r.add_argument("--verify", action="store_true")
    r.add_argument("--stream")
    args = ap.parse_args(argv)

    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    spark = SparkSession.builder.appName(f"docvault-{args.cmd}").getOrCreate()
    if args.cmd == "backup":
        request = read_backup_config(spark, args.config, args.client)
        indexes = _indexes(spark, args.indexes) if args.indexes and not args.skip_indexes else None
        catalog = stored_types(spark, args.store) if path_exists(spark, docs_root(args.store)) else None
        res = run_backup(spark, _store(spark, args.store), request, args.out, indexes, catalog=catalog,
                         skip_indexes=args.skip_indexes, fmt=args.format, compression=args.compression, cluster=args.cluster)
        print(res.run_dir)
    else:
        manifest = read_manifest(spark, args.manifest or f"{args.dir}/{MANIFEST_NAME}")
        if args.stream:
            totals = stream_restore(spark, args.dir, args.target, args.stream, manifest=manifest, strict=not args.lenient,
                                    skip_indexes=args.skip_indexes)
        else:
            totals = run_restore(spark, args.dir, args.target, args.skip_indexes, manifest, not args.lenient).totals
        totals.show(truncate=False)
        if args.verify:
            verify_restore(spark, args.dir, args.manifest or f"{args.dir}/{MANIFEST_NAME}", args.target, args.skip_indexes)
    return 0


if __name__ == "__main__":
    sys.exit(main())
