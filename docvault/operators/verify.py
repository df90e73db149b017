"""V1 verify documents, V2 verify indexes (the checks of a migration)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docvault.operators.indexes import manifest_indexes, prepare_for_creation
from docvault.functions.json import index_name
from docvault.operators.restore import touched_part
from docvault.session import broadcast_if_small, staged

KEY = ["client", "tenant", "type"]
LEAVES = 4096  # of the hash tree of a type


def leaf():
    """Leaf of a document in the hash tree of its type; a document without an id has none of its own and is always compared."""
    return F.when(F.col("id").isNull(), F.lit(-1)).otherwise(F.pmod(F.xxhash64("id"), F.lit(LEAVES))).cast("int")


def checksums(docs: DataFrame, hash_column: str) -> DataFrame:
    """``client, tenant, type, leaf`` with the count and order-free sums over the ids and text hashes of a leaf; partial sums
    are made before the shuffle, so it moves one row per leaf and task."""
    h = F.xxhash64("id", hash_column, F.lit("sum"))
    return (docs.select(*KEY, leaf().alias("leaf"), F.xxhash64("id", hash_column).alias("_x"), h.alias("_s"))
            .groupBy(*KEY, "leaf").agg(F.struct(
                F.count(F.lit(1)).alias("n"), F.bit_xor("_x").alias("x"), F.sum(F.shiftrightunsigned("_s", 32)).alias("hi"),
                F.sum(F.col("_s").bitwiseAND(F.lit(0xFFFFFFFF))).alias("lo")).alias("sums")))


def compare_leaves(expected: DataFrame, target: DataFrame) -> DataFrame:
    """``client, tenant, type, leaf, n, equal``: leaves that either side has and whether their checksums are equal."""
    e = checksums(expected, "he").withColumnRenamed("sums", "se")
    t = checksums(target, "ht").withColumnRenamed("sums", "st")
    both = e.join(t, [*KEY, "leaf"], "full_outer")
    return both.select(*KEY, "leaf", F.col("se.n").alias("n"), ((F.col("leaf") >= 0) & F.col("se").eqNullSafe(F.col("st"))).alias("equal"))


def verify_documents(expected: DataFrame, target: DataFrame, touched: DataFrame) -> DataFrame:
    """V1: per type, documents missing from the target, extra in it, and with different text.

    ``expected`` is ``(client, tenant, type, id, doc)``, already hashed ``(client, tenant, type, id, sha)``
    (e.g. the winners of a restore), or what a restore loads (with ``seq`` and ``bad``), of which the winners count;
    only the types in ``touched`` are compared.  Texts are compared through their SHA-256, so only hashes are shuffled.

    A hash tree of ``LEAVES`` leaves a type is compared first (a job of its own): equal leaves are counted, and only the
    documents of the others are joined by id.  An equal target is verified by one row per leaf.  Ids are unique within
    a type of the target, as a restore leaves them, so a leaf whose loaded documents equal the target's has no document
    that another replaces: winners are looked for in the other leaves alone.
    """
    loaded = "seq" in expected.columns
    if loaded:
        expected = expected.where(~F.col("bad"))
    digest = F.unhex(F.col("sha") if "sha" in expected.columns else F.sha2("doc", 256))
    e = expected.select(*KEY, "id", *(["seq"] if loaded else []), digest.alias("he"))
    t = touched_part(target, touched).select(*KEY, "id", F.unhex(F.sha2("doc", 256)).alias("ht"))
    leaves = staged(compare_leaves(e, t), "verified-leaves")
    same = leaves.where("equal").groupBy(*KEY).agg(F.sum("n").alias("same"))
    zero = F.lit(0).cast("long")
    per_type = same.select(*KEY, zero.alias("missing"), zero.alias("extra"), zero.alias("different"), "same")
    unequal = leaves.where(~F.col("equal")).select(*KEY, "leaf")
    if not unequal.isEmpty():
        unequal = broadcast_if_small(unequal)
        e, t = (d.withColumn("leaf", leaf()).join(unequal, [*KEY, "leaf"], "left_semi").drop("leaf") for d in (e, t))
        if loaded:
            e = _last(e, "he")
        j = e.join(t, KEY + ["id"], "full_outer")
        per_type = per_type.unionByName(j.groupBy(*KEY).agg(
            F.count_if(F.col("ht").isNull()).alias("missing"),
            F.count_if(F.col("he").isNull()).alias("extra"),
            F.count_if(F.col("he").isNotNull() & F.col("ht").isNotNull() & (F.col("he") != F.col("ht"))).alias("different"),
            F.count_if(F.col("he") == F.col("ht")).alias("same")))
    counts = ("missing", "extra", "different", "same")
    per_type = per_type.groupBy(*KEY).agg(*[F.sum(c).alias(c) for c in counts])
    return (broadcast_if_small(touched.select(*KEY)).join(per_type, KEY, "left")
            .select(*KEY, *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts]))


def verify_indexes(manifest: DataFrame, target_indexes: DataFrame) -> DataFrame:
    """V2: manifest index definitions (as they would be created) that the target does not have, by name."""
    wanted = prepare_for_creation(manifest_indexes(manifest))
    have = target_indexes.select(*KEY, index_name("keys", "options").alias("name"))
    return wanted.join(have, KEY + ["name"], "left_anti").select("ord", *KEY, "pos", "name", "keys", "options")


def winners(loaded: DataFrame) -> DataFrame:
    """What a restore of the loaded documents leaves per id: the last one's hash ``(client, tenant, type, id, sha)``.
    The shuffle moves hashes, not documents."""
    hashed = loaded.where(~F.col("bad")).select(*KEY, "id", "seq", F.unhex(F.sha2("doc", 256)).alias("sha"))
    return _last(hashed, "sha").select(*KEY, "id", F.lower(F.hex("sha")).alias("sha"))


def _last(hashed: DataFrame, column: str) -> DataFrame:
    return hashed.groupBy(*KEY, "id").agg(F.max_by(column, "seq").alias(column))
