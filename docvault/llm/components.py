"""Connected components of an edge table with joins and aggregates (no collect, no graph in one task).

Large-star / small-star contraction (Kiveris and others, 2014) on ``(u, v)`` longs.  A node's edges are spread
over ``SALTS`` keys by their other end, and its minimum is taken per salt and then per node, so a hub with a
large part of all edges is never one key of a join.  Every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docvault.llm.common import stage_table

SALTS = 64


def _with_min(edges: DataFrame) -> DataFrame:
    """Directed ``(u, v)`` → plus ``m``: the smallest ``v`` of each ``u``."""
    e = edges.withColumn("s", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
    parts = e.groupBy("u", "s").agg(F.min("v").alias("p"))
    whole = parts.groupBy("u").agg(F.min("p").alias("m"))
    least = parts.select("u", "s").join(whole, "u")
    return e.join(least, ["u", "s"]).select("u", "v", "m")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    star = _with_min(both).withColumn("m", F.least("u", "m"))
    return star.where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    star = _with_min(edges)
    down = star.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return down.union(star.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()


def components(edges: DataFrame) -> DataFrame:
    """``(u, v)`` long pairs, any order, repeats and loops allowed → ``(node, root)``: the smallest node that each
    node of an edge reaches.  Empty edges give no rows."""
    e = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = stage_table(e, "edges")
    state = _state(e)
    while state[0]:
        e = stage_table(_small_star(_large_star(e)), "edges")
        new = _state(e)
        if new == state:
            break
        state = new
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
