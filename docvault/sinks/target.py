"""The target document store: versions of buckets of types and one small catalog that says which version is current.

A type is split by the hash of the document id into buckets.  ``documents/ver=<n>/tkey=<type key>-<bucket>/`` holds the
documents of a bucket as one restore wrote them; ``types/`` holds the catalog, one row per bucket with its version, its
names, documents and stored bytes, as numbered snapshots.  A restore writes the new content of the buckets whose ids it
touches as a new version and then commits a catalog that names it.  Nothing that is current is deleted or renamed, so a
job that is lost at any moment leaves the old content readable, and running it again gives the same result.  Buckets that
are not touched are neither read nor rewritten, and the type catalog of a target is read without opening a document.

Commits detect conflicts (:func:`switch_types`): jobs that change different types at the same time all keep their
changes; of two that change one type, the later one fails and changes nothing.
``vacuum`` deletes versions that neither the current nor recent catalogs name.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import docvault.session as session
from docvault.model import BINARY_COLUMNS, STORE_SCHEMA, ConflictError
from docvault.operators.types import type_key
from docvault.session import among, broadcast_if_small, hadoop_fs, list_names, local_frame, path_exists, put_new, small_frame
from docvault.sinks.snapshot import commit, committed, current, read_number

TARGET_SCHEMA = T.StructType(list(STORE_SCHEMA.fields) + [T.StructField("tkey", T.StringType(), True)])
STORED_SCHEMA = T.StructType(list(TARGET_SCHEMA.fields) + [T.StructField("ver", T.IntegerType(), True)])
# One row per bucket of a type; a row that only has ``tkey`` and ``ver`` is a type of one bucket of unknown size.
CATALOG_SCHEMA = T.StructType([T.StructField(name, kind, True) for name, kind in (
    ("tkey", T.StringType()), ("bucket", T.IntegerType()), ("buckets", T.IntegerType()), ("ver", T.IntegerType()), ("client", T.StringType()),
    ("tenant", T.StringType()), ("type", T.StringType()), ("n_docs", T.LongType()), ("bytes", T.LongType()))])
KEY = ["client", "tenant", "type"]
BUCKET = ["tkey", "bucket"]
KEY_LENGTH = 20  # of a type key


def docs_root(target_root: str) -> str:
    return f"{target_root.rstrip('/')}/documents"


def catalog_root(target_root: str) -> str:
    return f"{target_root.rstrip('/')}/types"


def _filled(catalog: DataFrame) -> DataFrame:
    return catalog.na.fill(0, ["bucket"]).na.fill(1, ["buckets"])


def read_catalog(spark: SparkSession, target_root: str, number: int | None = None) -> DataFrame:
    """The current version of each stored bucket (or that of the catalog ``number``)."""
    root = catalog_root(target_root)
    return _filled(read_number(spark, root, current(spark, root) if number is None else number, CATALOG_SCHEMA))


def stored_types(spark: SparkSession, target_root: str) -> DataFrame:
    """S1 of a target: ``(client, tenant, type, n_docs)`` from the catalog alone."""
    return read_catalog(spark, target_root).groupBy(*KEY).agg(F.sum("n_docs").alias("n_docs"))


def _directory(tkey="tkey", bucket="bucket"):
    """Name of a bucket's partition."""
    return F.concat(F.col(tkey), F.lit("-"), F.col(bucket).cast("string"))


def _bucket_of(directory: str = "tkey"):
    return F.coalesce(F.get(F.split(directory, "-"), F.lit(1)).cast("int"), F.lit(0))


def read_buckets(spark: SparkSession, target_root: str, catalog: DataFrame | None = None) -> DataFrame:
    """The documents that a catalog names (default: the current one), with ``tkey`` and ``bucket``.

    Only the named versions' partitions are read: the catalog is small, and the join on the partition columns prunes the
    scan."""
    p = docs_root(target_root)
    empty = local_frame(spark, [], T.StructType([*TARGET_SCHEMA.fields, T.StructField("bucket", T.IntegerType(), True)]))
    if not path_exists(spark, p):
        return empty
    now, rows = small_frame(spark, read_catalog(spark, target_root) if catalog is None else catalog, "stored types")
    if not rows:
        return empty
    docs = spark.read.schema(STORED_SCHEMA).parquet(p)
    if not isinstance(rows, list) or set(_versions(spark, target_root)) - {r["ver"] for r in rows}:
        docs = docs.where(among("ver", rows))
    if catalog is not None and isinstance(rows, list) and len(rows) <= session.MAX_PRUNE_VALUES:  # a folder without a bucket is a type's only one
        docs = docs.where(F.col("tkey").isin(sorted({f"{r['tkey']}-{r['bucket']}" for r in rows} | {r["tkey"] for r in rows if not r["bucket"]})))
    docs = docs.select(*KEY, "id", "doc", "ver", F.substring("tkey", 1, KEY_LENGTH).alias("tkey"), _bucket_of().alias("bucket"))
    return docs.join(broadcast_if_small(now.select(*BUCKET, "ver")), [*BUCKET, "ver"], "left_semi").select(*KEY, "id", "doc", *BUCKET)


def read_target(spark: SparkSession, target_root: str) -> DataFrame:
    """The target's documents ``(client, tenant, type, id, doc, tkey)``; empty when nothing is there yet."""
    return read_buckets(spark, target_root).select(*KEY, "id", "doc", "tkey")


def _versions(spark: SparkSession, target_root: str) -> list[int]:
    return [int(n[4:]) for n, is_dir in list_names(spark, docs_root(target_root)) if is_dir and n.startswith("ver=")]


def _new_version(spark: SparkSession, target_root: str) -> int:
    """A version number that no other job has: numbers are claimed, so jobs that run at the same time write apart."""
    claims = f"{docs_root(target_root)}/_versions"
    taken = [int(n) for n, _ in list_names(spark, claims) if n.isdigit()]
    ver = max([*_versions(spark, target_root), *taken], default=0) + 1
    while not put_new(spark, f"{claims}/{ver}", ""):
        ver += 1
    return ver


def stage_types(df: DataFrame, target_root: str) -> int:
    """Write the documents of ``df`` (with ``bucket``, or types of one bucket) as a new version that nothing names yet."""
    spark = df.sparkSession
    ver = _new_version(spark, target_root)
    tkey = F.col("tkey") if "tkey" in df.columns else type_key()
    bucket = F.col("bucket") if "bucket" in df.columns else F.lit(0)
    out = df.select(*KEY, "id", "doc", tkey.alias("tkey"), bucket.alias("bucket")).select(*KEY, "id", "doc", _directory().alias("tkey"))
    with session.unsorted_writes(spark):
        out.write.mode("errorifexists").partitionBy("tkey").parquet(f"{docs_root(target_root)}/ver={ver}")
    return ver


def staged_buckets(spark: SparkSession, target_root: str, ver: int) -> DataFrame:
    """What a version holds, one row per bucket: names and documents from three dictionary columns, bytes from a listing."""
    p = f"{docs_root(target_root)}/ver={ver}"
    if not any(n.startswith("tkey=") for n, _ in list_names(spark, p)):
        return local_frame(spark, [], CATALOG_SCHEMA).drop("buckets")
    held = spark.read.schema(TARGET_SCHEMA).parquet(p).groupBy("tkey").agg(
        *[F.min(c).alias(c) for c in KEY], F.count(F.lit(1)).alias("n_docs"))
    files = spark.read.format("binaryFile").schema(f"{BINARY_COLUMNS}, tkey string").load(p)
    held = held.join(files.groupBy("tkey").agg(F.sum("length").alias("bytes")), "tkey", "left")
    return held.select(F.substring("tkey", 1, KEY_LENGTH).alias("tkey"), _bucket_of().alias("bucket"), F.lit(ver).cast("int").alias("ver"),
                       *KEY, "n_docs", "bytes")


def switch_types(spark: SparkSession, target_root: str, ver: int, base: int | None = None, buckets: DataFrame | None = None) -> None:
    """Make the staged version current for what it holds.

    ``buckets`` ``(tkey, buckets, kept)``: the number of buckets of each type and whether its other buckets stay; types
    that aren't there are replaced whole and have one bucket.  ``base`` is the number of the catalog that the version was
    made from: when another job has changed one of the types since, this raises :class:`ConflictError`."""
    new, _ = small_frame(spark, staged_buckets(spark, target_root, ver), "staged buckets")
    shape = "tkey string, buckets int, kept boolean"
    buckets = local_frame(spark, [], shape) if buckets is None else buckets
    new = new.join(broadcast_if_small(buckets), "tkey", "left").na.fill(1, ["buckets"]).na.fill(False, ["kept"])
    whole = new.where(~F.col("kept")).select("tkey").distinct()
    names = [f.name for f in CATALOG_SCHEMA]

    def change(old: DataFrame) -> DataFrame:
        old = _filled(old)
        if base is not None and (current(spark, catalog_root(target_root)) or 0) != base:
            _check_unchanged(spark, target_root, base, old, new.select("tkey").distinct())
        rest = old.join(broadcast_if_small(whole), "tkey", "left_anti").join(broadcast_if_small(new.select(*BUCKET)), BUCKET, "left_anti")
        return rest.select(*names).unionByName(new.select(*names)).coalesce(1)

    commit(spark, catalog_root(target_root), CATALOG_SCHEMA, change)


def _check_unchanged(spark: SparkSession, target_root: str, base: int, now: DataFrame, types: DataFrame) -> None:
    """``base`` 0: the target was empty."""
    then = _filled(read_number(spark, catalog_root(target_root), base or None, CATALOG_SCHEMA))
    a, b = (c.join(broadcast_if_small(types), "tkey", "left_semi").select(*BUCKET, "ver") for c in (then, now))
    changed = a.unionByName(b).groupBy(*BUCKET, "ver").count().where("count <> 2").first()
    if changed:
        raise ConflictError(f"type {changed['tkey']} of {target_root} was changed by another job since this one read it; nothing was published")


def write_types(df: DataFrame, target_root: str) -> None:
    """Replace exactly the types present in ``df`` (``client, tenant, type, id, doc``)."""
    switch_types(df.sparkSession, target_root, stage_types(df, target_root))


def drop_types_in_place(spark: SparkSession, target_root: str, types: DataFrame) -> int:
    """V3 on the stored target: the next catalog no longer names the types; no data is read or rewritten.

    ``types`` has ``(client, tenant, type)``.  Returns the number of types dropped."""
    gone, _ = small_frame(spark, types.select(type_key().alias("tkey")).distinct(), "types to drop")
    found = 0

    def change(old: DataFrame) -> DataFrame | None:
        nonlocal found
        found = old.join(broadcast_if_small(gone), "tkey", "left_semi").select("tkey").distinct().count()
        return old.join(broadcast_if_small(gone), "tkey", "left_anti").coalesce(1) if found else None

    commit(spark, catalog_root(target_root), CATALOG_SCHEMA, change)
    return found


def vacuum(spark: SparkSession, target_root: str, keep_catalogs: int = 1, older_than_s: float = 0.0) -> int:
    """Delete the versions of buckets that none of the last ``keep_catalogs`` catalogs names.

    Jobs that read an older catalog, or have staged a version and not yet committed it, need what they read or wrote:
    beside running jobs, keep several catalogs and spare versions younger than the longest job (``older_than_s``)."""
    named = None
    for _, n in zip(range(keep_catalogs), committed(spark, catalog_root(target_root))):
        c = read_catalog(spark, target_root, n).select(_directory().alias("dir"), "tkey", "bucket", "ver")
        named = c if named is None else named.unionByName(c)
    before = (time.time() - older_than_s) * 1000
    found = []
    for ver in _versions(spark, target_root):
        fs, p = hadoop_fs(spark, f"{docs_root(target_root)}/ver={ver}")
        found += [(st.getPath().getName()[5:], ver) for st in fs.listStatus(p)
                  if st.isDirectory() and st.getPath().getName().startswith("tkey=") and st.getModificationTime() <= before]
    there = local_frame(spark, found, "raw string, ver int").withColumn("dir", F.concat(
        F.substring("raw", 1, KEY_LENGTH), F.lit("-"), _bucket_of("raw").cast("string")))
    gone = there if named is None else there.join(named.select("dir", "ver"), ["dir", "ver"], "left_anti")
    removed = 0
    for r in gone.select("raw", "ver").toLocalIterator():
        fs, p = hadoop_fs(spark, f"{docs_root(target_root)}/ver={r['ver']}/tkey={r['raw']}")
        fs.delete(p, True)
        removed += 1
    return removed
