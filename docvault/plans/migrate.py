"""C3 environment migration: backup from store A, restore into target B, and the check of both; ids and indexes kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docvault.model import INDEX_SCHEMA, RestoreError
from docvault.operators.restore import load_documents, touched_types
from docvault.operators.verify import verify_documents, verify_indexes
from docvault.plans.backup import BackupResult, run_backup
from docvault.plans.restore import RestoreResult, indexes_root, run_restore
from docvault.session import small_frame
from docvault.sinks.snapshot import read_snapshot
from docvault.sinks.target import read_target
from docvault.sources.config import read_manifest
from docvault.sources.dumps import read_dumps


def verify_restore(spark: SparkSession, run_dir: str, manifest_path: str, target: str, skip_indexes: bool = False) -> None:
    """V1 and V2 after a restore: every dumped document and index is in the target as the restore should leave it.
    Documents that the target held before are no error."""
    manifest, rows = small_frame(spark, read_manifest(spark, manifest_path), "manifest")
    loaded = load_documents(read_dumps(spark, run_dir, rows), manifest)
    found = verify_documents(loaded, read_target(spark, target), touched_types(manifest))
    wrong = found.where("missing > 0 or different > 0").first()
    if wrong:
        raise RestoreError(f"{wrong['client']}/{wrong['tenant']}/{wrong['type']}: {wrong['missing']} documents missing, "
                           f"{wrong['different']} different")
    if not skip_indexes:
        lost = verify_indexes(manifest, read_snapshot(spark, indexes_root(target), INDEX_SCHEMA)).first()
        if lost:
            raise RestoreError(f"{lost['client']}/{lost['tenant']}/{lost['type']}: index {lost['name']} missing")


def migrate(spark: SparkSession, store_a: DataFrame, request: DataFrame, out_root: str, target_b: str,
            indexes_a: DataFrame | None = None, skip_indexes: bool = False, fmt: str = "parquet", cluster: bool = False,
            verify: bool = False) -> tuple[BackupResult, RestoreResult]:
    """The run directory is the only hand-over between the two environments."""
    b = run_backup(spark, store_a, request, out_root, indexes_a, skip_indexes, fmt, cluster=cluster)
    r = run_restore(spark, b.run_dir, target_b, skip_indexes)
    if verify:
        verify_restore(spark, b.run_dir, b.manifest_path, target_b, skip_indexes)
    return b, r
