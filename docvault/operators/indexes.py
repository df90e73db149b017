"""Index chain: T3 ``_id`` filter, T4 weights fix, T5/R12 null drop, J1 attach, J2 ensure."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docvault.functions.json import drop_null_fields, index_name, is_id_index, prepare_options

KEY = ["client", "tenant", "type"]


def usable_indexes(indexes: DataFrame) -> DataFrame:
    """Drop indexes whose key set is only ``_id``."""
    return indexes.where(~is_id_index("keys"))


def attach_indexes(manifest: DataFrame, indexes: DataFrame) -> DataFrame:
    """Per manifest row, its remaining index definitions in catalog order; none left → NULL.

    The index table is grouped per type (a handful of definitions each, bounded by the store's per-type
    index limit) and left-joined to the manifest, which is one row per type.
    """
    per_type = (usable_indexes(indexes)
                .groupBy(*KEY)
                .agg(F.sort_array(F.collect_list(F.struct("pos", "keys", "options"))).alias("_ix")))
    per_type = per_type.select(*KEY, F.transform("_ix", lambda x: F.struct(
        x["keys"].alias("keys"), x["options"].alias("options"))).alias("indexes"))
    cols = [c for c in manifest.columns if c != "indexes"]
    return manifest.select(*cols).join(per_type, KEY, "left")


def manifest_indexes(manifest: DataFrame) -> DataFrame:
    """The index definitions of manifest rows, one row each: ``(ord, client, tenant, type, pos, keys, options)``."""
    return (manifest.select("ord", *KEY, F.posexplode("indexes").alias("pos", "ix"))
            .select("ord", *KEY, F.col("pos").cast("int").alias("pos"), "ix.keys", "ix.options"))


def prepare_for_creation(ix: DataFrame) -> DataFrame:
    """T3 again (hand-made manifests), then T4 and the null drop; adds the index ``name``."""
    out = (usable_indexes(ix)
           .withColumn("options", drop_null_fields(prepare_options("options")))
           .withColumn("keys", drop_null_fields("keys")))
    return out.withColumn("name", index_name("keys", "options"))


def ensure_indexes(manifest: DataFrame, target_indexes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Create the manifest's indexes on the target; an existing one (same type, same name) is success.

    Returns ``(created, new_target_indexes)``.  Within one restore the first definition of a name wins.
    ``target_indexes`` has ``(client, tenant, type, pos, keys, options)``.
    """
    wanted = prepare_for_creation(manifest_indexes(manifest))
    first = (wanted.groupBy(*KEY, "name")
             .agg(F.min_by(F.struct("keys", "options"), F.struct("ord", "pos")).alias("d"),
                  F.min(F.struct("ord", "pos")).alias("at")))
    existing = target_indexes.select(*KEY, index_name("keys", "options").alias("name"))
    created = first.join(existing, KEY + ["name"], "left_anti")
    base = target_indexes.select(*KEY, "pos", "keys", "options")
    start = base.groupBy(*KEY).agg(F.max("pos").alias("_p"))
    w = Window.partitionBy(*KEY).orderBy("at")  # in the order of the manifest
    new_rows = (created.join(start, KEY, "left")
                .select(*KEY, (F.coalesce("_p", F.lit(-1)) + F.row_number().over(w)).cast("int").alias("pos"),
                        F.col("d.keys").alias("keys"), F.col("d.options").alias("options")))
    return created.select(*KEY, "name", F.col("d.keys").alias("keys"), F.col("d.options").alias("options")), \
        base.unionByName(new_rows)
