"""Mixing sources to target weights (DataFrame functions only).

Each source gets a target number of words; sampling without replacement inside a source follows Efraimidis and
Spirakis: document *d* draws the exponential key ``-ln(u) / quality`` and documents are taken in ascending key
order until the source's budget is spent, so better documents come earlier.  When a target exceeds the source,
whole *epochs* (every document once) come first and only the rest is selected by key.

Scale: the texts are read once to write a narrow row per document; a source is summed with partial aggregates.
The running sums inside a source are taken in two levels: keys map to about ``sqrt(n)`` equal-probability
buckets, bucket totals are prefix-summed per source, and documents are prefix-summed inside their bucket, so a
source that holds a third of all rows is spread over as many tasks as it has buckets.  Targets need one row
per source.

Defined results: a null text has size 0; a null source is a source of its own, last in order; a source of size
0 has target 0; ties of the key are broken by doc_id and row; repeated rows are documents of their own; an
empty table gives an empty mix; extra columns are ignored by ``mix`` and kept by ``expand``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from docvault.llm.common import fresh, numbered, stage_table, table, word_array

SEED = 20251
MAX_EPOCHS = 3
WEIGHTS = (1, 2, 3)  # by the rank of the source, repeating


def quality_weight(text: str = "text") -> Column:
    """A document's sampling weight in [0.1, 1]: 1 minus its symbols per character."""
    t = F.coalesce(F.col(text), F.lit(""))
    symbols = F.char_length(F.regexp_replace(t, "[^#*$%&|<>]+", ""))
    return F.greatest(F.lit(0.1), F.lit(1.0) - symbols / F.greatest(F.char_length(t), F.lit(1)))


def uniform(seed: int, *cols: Column) -> Column:
    """A number in (0, 1) that depends on the given columns only: 52 bits of their MD5."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("")) for c in cols]))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def targets(by_source: DataFrame, share: float = 1.0, weights: tuple = WEIGHTS, cap: int = MAX_EPOCHS) -> DataFrame:
    """``source, n, source_size`` → plus ``target``: ``share`` of all words dealt by weight, at most ``cap``
    times the source's size, the excess dealt again by weight until no source is above its cap.

    With sources in ascending order of cap per unit of weight, the capped ones are a prefix, so the level
    ``(total - caps so far) / (weights left)`` is found with running sums over one row per source.
    """
    ranked = by_source.withColumn(
        "_rank", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    s = ranked.withColumn("_w", weight).withColumn("_cap", F.col("source_size") * float(cap))
    every = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    order = W.orderBy((F.col("_cap") / F.col("_w")).asc(), F.col("_rank").asc())
    s = (s.withColumn("_total", F.sum("source_size").over(every) * F.lit(float(share)))
          .withColumn("_caps", F.coalesce(F.sum("_cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)))
          .withColumn("_left", F.sum("_w").over(order.rowsBetween(W.currentRow, W.unboundedFollowing)))
          .withColumn("_level", (F.col("_total") - F.col("_caps")) / F.col("_left"))
          .withColumn("_open", F.col("_level") * F.col("_w") <= F.col("_cap")))
    # the first open source fixes the level of all that follow it
    s = s.withColumn("_at", F.min(F.when(F.col("_open"), F.struct(F.col("_cap") / F.col("_w"), "_rank", "_level"))).over(every))
    level = F.col("_at")["_level"]
    target = F.when(F.col("_at").isNull(), F.col("_cap")).otherwise(F.least(F.col("_cap"), level * F.col("_w")))
    return s.select("source", "n", "source_size", F.round(target, 6).alias("target"))


def mix(docs: DataFrame, quality: Column | None = None, share: float = 1.0, weights: tuple = WEIGHTS,
        cap: int = MAX_EPOCHS, seed: int = SEED, rid: str = "_rid") -> DataFrame:
    """``doc_id, rid, size, source_size, target, copies, taken`` for every row of ``docs`` (which must carry
    ``rid``; see ``common.numbered``).

    ``copies`` is how often the document enters the mix; a document is taken whole, and the one at the edge of
    the budget is taken when that brings the source nearer to its target.
    """
    quality = quality_weight() if quality is None else quality
    key = -F.log(uniform(seed, F.col("doc_id"), F.col("text"))) / F.col("_q")
    rows = docs.select("doc_id", rid, "source", F.size(word_array("text")).cast("long").alias("size"),
                       quality.alias("_q"), "text")
    rows = stage_table(rows.select("doc_id", rid, "source", "size", key.alias("_key")), "mix")
    sources = stage_table(targets(rows.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size")),
                                  share, weights, cap), "sources")
    sources = (sources.withColumn("_buckets", F.ceil(F.sqrt("n")))
               .withColumn("_epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
               .withColumn("_rest", F.col("target") - F.col("_epochs") * F.col("source_size")))
    d = rows.join(sources.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    # 1 - exp(-key) is nearly uniform, and rises with the key
    bucket = F.least(F.floor(F.col("_buckets") * (1 - F.exp(-F.col("_key")))), F.col("_buckets") - 1)
    d = d.withColumn("_b", bucket)
    sums = d.groupBy("source", "_b").agg(F.sum("size").alias("_sum"))
    before = F.sum("_sum").over(W.partitionBy("source").orderBy("_b").rowsBetween(W.unboundedPreceding, -1))
    sums = sums.select(F.col("source").alias("_s"), F.col("_b").alias("_sb"), F.coalesce(before, F.lit(0)).alias("_base"))
    inside = W.partitionBy("source", "_b").orderBy("_key", F.col("doc_id").asc_nulls_last(), rid)
    d = d.withColumn("_in", F.coalesce(F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    d = d.join(sums, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_b") == F.col("_sb")))
    before = F.col("_base") + F.col("_in")
    chosen = (before + F.col("size") / 2 <= F.col("_rest")) & (F.col("size") > 0)
    copies = (F.col("_epochs") + F.when(chosen, 1).otherwise(0)).cast("long")
    return d.select("doc_id", rid, "source", "size", "source_size", "target", copies.alias("copies"),
                    (copies * F.col("size")).alias("taken"))


def expand(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as the mix takes it; columns unchanged."""
    cols = docs.columns
    rid = fresh(cols, "_rid")
    rows = numbered(docs, rid)
    plan = mix(rows, rid=rid, **options).where("copies > 0").select(F.col(rid).alias("_mix_rid"), F.col("copies").alias("_mix_copies"))
    out = rows.join(plan.hint("merge"), F.col(rid) == F.col("_mix_rid"))  # the plan grows with the documents
    return out.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_copies")))).select(*[F.col(f"`{c}`") for c in cols])


def query(spark, sf_dir):
    """op2: the mix of all documents at 100 % of all words."""
    docs = numbered(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(concat_ws('|', '20251', coalesce(CAST(doc_id AS VARCHAR), ''), coalesce(text, ''))) AS h
  FROM documents),
k AS (
  SELECT *, -ln((CAST(CAST(('0x' || substr(h, 1, 13)) AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496.0)
         / greatest(0.1, 1.0 - CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS DOUBLE) / greatest(length(t), 1)) AS key
  FROM d),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) AS rnk
  FROM k GROUP BY source),
w AS (SELECT *, CAST(rnk % 3 + 1 AS DOUBLE) AS w, source_size * 3.0::DOUBLE AS cap FROM s),
l AS (
  SELECT *, ((SELECT sum(source_size) FROM s)
             - coalesce(sum(cap) OVER (ORDER BY cap / w, rnk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY cap / w, rnk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev
  FROM w),
o AS (SELECT lev FROM l WHERE lev * w <= cap ORDER BY cap / w, rnk LIMIT 1),
t AS (SELECT source, source_size, round(least(cap, coalesce((SELECT lev FROM o) * w, cap)), 6) AS target FROM l),
p AS (
  SELECT k.doc_id, k.source, k.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS epochs,
         coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY key, doc_id NULLS LAST, rid
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source),
c AS (
  SELECT *, CAST(epochs + CASE WHEN size > 0 AND before + size / 2.0 <= target - epochs * source_size THEN 1 ELSE 0 END AS BIGINT) AS copies
  FROM p)
SELECT doc_id, size, source_size, target, copies * size AS taken, source, copies FROM c
"""
