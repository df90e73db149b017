"""The corpus pipeline: stages over ``documents``, each written as Parquet and read back by the next.

``STAGES`` lists ``(name, function)``; a function takes ``(spark, docs, sf_dir)`` and returns a DataFrame, all but the
last with the columns of ``documents``.  ``run`` applies them to the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docvault.llm import line_dedup, mixing, packing, quality_rules, simhash
from docvault.llm.common import SEPARATORS, stage_table

END_ID = 2
LENGTH = 4096


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that quality policy ``v1`` rejects go."""
    return quality_rules.select_kept(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks of lines aligned with an earlier document go; so does a document that has no word left.  ``n_chars`` is
    counted anew."""
    out = line_dedup.dedup(docs).withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.where(F.btrim("text", F.lit(SEPARATORS)) != "").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group (3-word shingles, 3 bits) stays: the first by doc_id."""
    return simhash.keep_first(docs, shingle=3, max_distance=3)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source is taken to its target; a document is repeated as often as the mix takes it."""
    return mixing.expand(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences along the space-filling curve."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), END_ID, LENGTH)


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("simhash", near_duplicates), ("mixing", mixed), ("packing", packed)]

# SQL expresses neither the alignment, nor XXH64 fingerprints, nor the tokenizer: tests hold each stage against a
# brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
