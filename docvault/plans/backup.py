"""C1 backup job: request → resolved types → one dump write for all types → indexes → manifest.

Plan shape: the type catalog is a partial aggregate over the three key columns of the store; the resolved
types (one row per type, size-checked) are broadcast into the store scan, so the documents are filtered
map-side and written straight out, partitioned by their dump key, with no shuffle of document text.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docvault.operators.indexes import attach_indexes
from docvault.operators.manifest import manifest_rows
from docvault.operators.types import resolve_types, type_key
from docvault.session import among, broadcast_if_small, small_frame
from docvault.sinks.dumps import new_run_dir, write_array_dumps, write_dumps, write_jsonl_dumps, write_manifest
from docvault.sources.store import type_catalog

KEY = ["client", "tenant", "type"]
log = logging.getLogger("docvault.backup")


@dataclass
class BackupResult:
    run_dir: str
    manifest: list[dict]
    manifest_path: str


def plan_backup(spark: SparkSession, store: DataFrame, request: DataFrame,
                indexes: DataFrame | None = None, skip_indexes: bool = False,
                catalog: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The two frames of a backup without writing: ``(manifest_local, docs)``.

    ``manifest_local``: ``(ord, client, tenant, type, n_docs, file[, indexes])``, a size-checked local frame.
    ``docs``: ``(ord, client, tenant, type, file, n_docs, id, doc)`` for every resolved type.
    ``catalog`` may be passed when it is already computed (e.g. a catalog table); default: S1 over the store.
    """
    if catalog is None:
        catalog = type_catalog(store, request)
    resolved_local, rows = small_frame(spark, resolve_types(request, catalog), "resolved types")
    # static filters from short lists: partition pruning / row-group skipping on a store laid out by type, before the
    # join picks the exact (client, tenant, type) triples
    for c in KEY:
        store = store.where(among(c, rows))
    if "tkey" in store.columns:  # a restored target: its partitions are the types
        keyed = resolved_local.withColumn("tkey", type_key())
        _, keys = small_frame(spark, keyed.select("tkey").distinct(), "type keys")
        docs = store.where(among("tkey", keys)).join(broadcast_if_small(keyed), [*KEY, "tkey"])
    else:
        docs = store.join(broadcast_if_small(resolved_local), KEY)
    manifest = resolved_local
    if indexes is not None and not skip_indexes:
        manifest, _ = small_frame(spark, attach_indexes(resolved_local, indexes), "manifest")
    return manifest, docs


def run_backup(spark: SparkSession, store: DataFrame, request: DataFrame, out_root: str,
               indexes: DataFrame | None = None, skip_indexes: bool = False, fmt: str = "parquet",
               max_records_per_file: int = 1_000_000, compression: str | None = None,
               catalog: DataFrame | None = None, cluster: bool = False,
               array_bytes: int = 256 * 1024 * 1024) -> BackupResult:
    """C1.  A failing scan or write raises and leaves no manifest (dumps already written stay).

    ``cluster``: for a store whose files mix many types, shuffle the documents on (dump, salt) first, so
    each dump gets ``ceil(n_docs / max_records_per_file)`` files instead of one small file per scan task
    and type.  A store laid out by type (the usual case) needs no shuffle and is written map-only.
    """
    if fmt == "array" and compression:
        raise ValueError("array dumps are not compressed: the array reader takes plain text only")
    if fmt not in ("parquet", "jsonl", "array"):
        raise ValueError(f"unknown dump format {fmt!r}")
    run_dir = new_run_dir(spark, out_root)
    manifest, docs = plan_backup(spark, store, request, indexes, skip_indexes, catalog)
    if cluster and fmt != "array":
        salts = F.greatest(F.lit(1), F.ceil(F.col("n_docs") / F.lit(max_records_per_file)))
        docs = (docs.withColumn("_salt", F.pmod(F.xxhash64("id"), salts))
                .repartition("file", "_salt").drop("_salt"))
    if fmt == "parquet":
        write_dumps(docs, run_dir, max_records_per_file, compression)
    elif fmt == "jsonl":
        write_jsonl_dumps(docs, run_dir, max_records_per_file, compression)
    else:
        write_array_dumps(docs, run_dir, array_bytes)
    rows = manifest_rows(manifest)
    for r in rows:
        log.info("dumped %s/%s/%s: %s documents", r["client"], r["tenant"], r["type"], r["n_docs"])
    path = write_manifest(spark, run_dir, rows)
    log.info("manifest with %d rows in %s", len(rows), run_dir)
    return BackupResult(run_dir, rows, path)
