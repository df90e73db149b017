"""C2 restore job: manifest → read all dumps → totals and checks → staged upsert of the touched types → indexes → switch.

The checks (a missing or incomplete dump, text that is not JSON) come before anything is written.  The new content of
the touched types is staged as a version that nothing names; indexes are created and the version is made current only
after it is complete.  Types the manifest does not name are neither read nor written.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docvault.model import INDEX_SCHEMA, MANIFEST_NAME, RestoreError
from docvault.operators.indexes import ensure_indexes
from docvault.operators.restore import (buckets_to_read, load_documents, merge_types, plan_buckets, restore_totals,
                                       touched_types)
from docvault.session import broadcast_if_small, local_frame, small_frame
from docvault.sinks.snapshot import commit, current
from docvault.sinks.target import CATALOG_SCHEMA, catalog_root, read_buckets, read_catalog, stage_types, switch_types
from docvault.sources.config import read_manifest
from docvault.sources.dumps import dump_bytes, locate_dumps, read_dumps

KEY = ["client", "tenant", "type"]
log = logging.getLogger("docvault.restore")


@dataclass
class RestoreResult:
    totals: DataFrame
    created_indexes: int


def indexes_root(target_root: str) -> str:
    return f"{target_root.rstrip('/')}/indexes"


def restore_frames(spark: SparkSession, dumps: DataFrame, manifest_local: DataFrame, target: DataFrame,
                   ) -> tuple[DataFrame, DataFrame, DataFrame, list]:
    """``(loaded, merged, totals, total rows)``: the documents read from the dumps, the new content of the touched types,
    and the per-row totals.  The target is not written.

    The dumps are counted first, so the merge is split by the documents that they really hold."""
    loaded = load_documents(dumps, manifest_local)
    touched = touched_types(_counted(spark, manifest_local, loaded))
    totals, rows = small_frame(spark, restore_totals(manifest_local, loaded, target, touched), "restore totals")
    return loaded, merge_types(target, loaded, touched), totals, rows


def _counted(spark: SparkSession, manifest: DataFrame, loaded: DataFrame) -> DataFrame:
    """The manifest with the documents that its dumps really hold (of parquet dumps only footers are read)."""
    counts, _ = small_frame(spark, loaded.groupBy("ord").agg(F.count(F.lit(1)).alias("n_docs")), "dump counts")
    return manifest.drop("n_docs").join(broadcast_if_small(counts), "ord", "left")


def check_complete(manifest_local: DataFrame, totals) -> None:
    """A dump with fewer texts, or more documents, than its manifest row counted has lost or gained a part."""
    counted = {r["ord"]: (r["total"], r["total"] - r["rejected"]) for r in totals}
    for r in manifest_local.select("ord", "file", "n_docs").toLocalIterator():
        texts, documents = counted.get(r["ord"], (0, 0))
        if r["n_docs"] is not None and not documents <= r["n_docs"] <= texts:
            raise RestoreError(f"dump {r['file']} holds {documents} documents, its manifest row says {r['n_docs']}")


def create_indexes(spark: SparkSession, manifest_local: DataFrame, target_root: str) -> int:
    """J2 on the stored index table; made again when another job published indexes meanwhile.  Returns how many are new."""
    created = 0

    def change(have: DataFrame) -> DataFrame | None:
        nonlocal created
        made, new_indexes = ensure_indexes(manifest_local, have)
        created = made.count()
        return new_indexes.coalesce(1) if created else None

    commit(spark, indexes_root(target_root), INDEX_SCHEMA, change)
    return created


def restore_dumps(spark: SparkSession, dumps: DataFrame, manifest_local: DataFrame, target_root: str, run_name: str,
                  skip_indexes: bool = False, strict: bool = True, sizes: DataFrame | None = None) -> RestoreResult:
    """Restore documents that were read from dumps: check everything, stage the documents, then publish indexes and
    documents.  A failed check changes nothing.  ``sizes`` ``(file, bytes)``: stored bytes of the dumps.

    Only the buckets of the touched types in which a restored id falls are read and rewritten."""
    base = current(spark, catalog_root(target_root)) or 0
    catalog = read_catalog(spark, target_root, base) if base else local_frame(spark, [], CATALOG_SCHEMA)
    loaded = load_documents(dumps, manifest_local)
    touched = plan_buckets(touched_types(_counted(spark, manifest_local, loaded)), catalog, manifest_local, sizes)
    affected, _ = small_frame(spark, buckets_to_read(catalog, loaded, touched), "affected buckets")
    target = read_buckets(spark, target_root, affected)
    totals, rows = small_frame(spark, restore_totals(manifest_local, loaded, target, touched), "restore totals")
    merged = merge_types(target, loaded, touched)
    bad = [r for r in rows if r["rejected"]]
    if bad:
        first = bad[0]
        msg = (f"{sum(r['rejected'] for r in bad)} dumped texts are not JSON objects, "
               f"the first in {first['client']}/{first['tenant']}/{first['type']}")
        if strict:
            raise RestoreError(msg)
    if "n_docs" in manifest_local.columns:
        check_complete(manifest_local, rows)
    if bad:
        rejects = f"{target_root.rstrip('/')}/rejects/{run_name}"
        loaded.where("bad").select("ord", *KEY, "file", "doc").write.mode("overwrite").parquet(rejects)
        log.warning("%s; written to %s", msg, rejects)
    ver = stage_types(merged, target_root)
    created = 0
    if not skip_indexes and "indexes" in manifest_local.columns:
        created = create_indexes(spark, manifest_local, target_root)
    switch_types(spark, target_root, ver, base, touched.select("tkey", F.col("salts").alias("buckets"), "kept"))
    for r in rows:
        log.info("restored %s/%s/%s: %d documents, %d new, %d replaced", r["client"], r["tenant"], r["type"], r["total"],
                 r["inserted"], r["replaced"])
    return RestoreResult(totals.orderBy("ord"), created)


def run_restore(spark: SparkSession, run_dir: str, target_root: str, skip_indexes: bool = False,
                manifest: DataFrame | None = None, strict: bool = True) -> RestoreResult:
    """C2.  ``manifest`` overrides ``<run_dir>/backup.json`` (e.g. a selected or retargeted one)."""
    if manifest is None:
        manifest = read_manifest(spark, f"{run_dir}/{MANIFEST_NAME}")
    manifest_local, rows = small_frame(spark, manifest, "manifest")
    where = locate_dumps(spark, run_dir, rows)
    return restore_dumps(spark, read_dumps(spark, run_dir, rows, where), manifest_local, target_root,
                         run_dir.rstrip("/").rsplit("/", 1)[-1], skip_indexes, strict, dump_bytes(spark, run_dir, where))
