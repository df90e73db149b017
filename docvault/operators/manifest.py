"""T6 manifest selection / retargeting and A2 manifest collection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def select_manifest(manifest: DataFrame, types: list[str] | None = None, tenants: list[str] | None = None,
                    retarget_tenant: dict | None = None, retarget_client: dict | None = None) -> DataFrame:
    """Restore a subset and/or into other names: filter rows, then rename tenant/client.

    Dump files stay as named; only the target names change.  Positions (``ord``) are kept.
    """
    out = manifest
    if types is not None:
        out = out.where(F.col("type").isin(types))
    if tenants is not None:
        out = out.where(F.col("tenant").isin(tenants))
    for col, mapping in (("tenant", retarget_tenant), ("client", retarget_client)):
        if mapping:
            expr = F.col(col)
            for old, new in mapping.items():
                expr = F.when(F.col(col) == old, F.lit(new)).otherwise(expr)
            out = out.withColumn(col, expr)
    return out


def manifest_rows(manifest_local: DataFrame) -> list[dict]:
    """A2: the manifest in order (tenant-list order, then type name); ``[]`` when empty.

    The frame is one row per type and already bounded (see ``session.small_frame``).
    """
    rows = manifest_local.orderBy("ord", "type").collect()
    out = []
    for r in rows:
        d = r.asDict(recursive=True)
        out.append(d)
    return out
