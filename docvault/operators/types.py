"""Resolve the requested types against the store's type catalog and flatten them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docvault.session import broadcast_if_small, small_frame


def _part(c):
    return F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c))


def type_key(client="client", tenant="tenant", typ="type"):
    """Partition key of a type in a target store: a hash of (client, tenant, type).

    Raw names would make poor directory names (an empty name reads back as NULL, digits may be inferred
    as numbers); the names themselves stay data columns.
    """
    canon = F.concat_ws("|", _part(client), _part(tenant), _part(typ))
    return F.substring(F.sha2(canon, 256), 1, 20)


def file_key(ord_col="ord", client="client", tenant="tenant", typ="type"):
    """Deterministic dump name of one resolved row: a hash of (ord, client, tenant, type).

    Length-prefixed fields make the encoding unambiguous; a retried task can never rename a dump.
    """
    canon = F.concat_ws("|", F.col(ord_col).cast("string"), _part(client), _part(tenant), _part(typ))
    return F.concat(F.lit("f_"), F.substring(F.sha2(canon, 256), 1, 32))


def resolve_types(request: DataFrame, catalog: DataFrame) -> DataFrame:
    """Request ⋈ catalog: all types when ``types`` is NULL or empty, else the intersection.

    Unknown requested types vanish, a tenant without types yields no row, duplicate tenant rows each keep
    their own rows (``ord`` is part of the key).  The request is config-sized and broadcast.
    """
    r = broadcast_if_small(small_frame(request.sparkSession, request, "backup request")[0].alias("r"))
    c = catalog.alias("c")
    cond = ((F.col("r.client") == F.col("c.client")) & (F.col("r.tenant") == F.col("c.tenant"))
            & ((F.coalesce(F.size("r.types"), F.lit(0)) <= 0) | F.array_contains("r.types", F.col("c.type"))))
    out = c.join(r, cond, "inner").select(
        F.col("r.ord").alias("ord"), F.col("c.client").alias("client"), F.col("c.tenant").alias("tenant"),
        F.col("c.type").alias("type"), F.col("c.n_docs").alias("n_docs"))
    return out.withColumn("file", file_key())
