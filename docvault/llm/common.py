"""Helpers shared by the operators: words, row ids, tables in the shared folder."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docvault.session import MAX_BROADCAST_BYTES, scratch_path

# What separates words (space, tab, line feed, vertical tab, form feed, carriage return).
SEPARATORS = " \t\n\x0b\x0c\r"
SEPARATOR_RUN = r"[\x20\x09-\x0D]+"
MAX_PARTITIONS = 200_000  # of one shuffle
EMPTY_HOST = ":///"  # of a path without a host: file:///a and file:/a are one file


def word_array(text: Column | str) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text column, in order; null and blank texts have none."""
    text = F.col(text) if isinstance(text, str) else text
    t = F.btrim(F.coalesce(text, F.lit("")), F.lit(SEPARATORS))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SEPARATOR_RUN))


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to a fresh folder under ``spark.checkpoint.dir`` and read it back.

    Cuts lineage with files that every executor sees, so a lost executor costs no recomputation of what
    stands above; also gives Spark the exact size of the frame for its choice of joins.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _scanned(df: DataFrame) -> bool:
    """Whether a frame is columns and filters, the same in every evaluation, over one scan of Parquet files."""
    plan = df._jdf.queryExecution().analyzed()
    if not plan.deterministic():
        return False
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        if not plan.deterministic():
            return False
        plan = plan.children().head()
    if plan.nodeName() != "LogicalRelation":
        return False
    relation = plan.relation()
    return relation.getClass().getSimpleName() == "HadoopFsRelation" and relation.fileFormat().toString() == "Parquet"


def numbered(df: DataFrame, rid: str = "_rid") -> DataFrame:
    """Add a row id that is the same in every evaluation of the frame.

    Row ids tell repeated rows (and rows whose key is null) apart.  ``monotonically_increasing_id`` hangs on how a
    scan is cut, which changes with the executors that are there, so a row of a Parquet file is named by the number
    of the file and its place in it, and any other frame is written to the shared folder together with its ids.
    """
    named = _scanned(df) and fresh(df.columns, "_metadata") == "_metadata"
    paths = sorted({p.replace(EMPTY_HOST, ":/") for p in df.inputFiles()}) if named else []
    if not paths or sum(map(len, paths)) > MAX_BROADCAST_BYTES // 4:
        return stage_table(df.withColumn(rid, F.monotonically_increasing_id()), "rows")
    cols = [F.col(f"`{c}`") for c in df.columns]
    path, row = fresh([*df.columns, rid], "_path"), fresh([*df.columns, rid], "_row")
    number, file = fresh([*df.columns, rid], "_number"), fresh([*df.columns, rid], "_file")
    placed = df.select(*cols, F.replace("_metadata.file_path", F.lit(EMPTY_HOST), F.lit(":/")).alias(path), F.col("_metadata.row_index").alias(row))
    if len(paths) == 1:
        return placed.select(*cols, F.col(row).alias(rid))
    unknown = F.raise_error(F.concat(F.lit("not among the files of the frame: "), F.col(path))).cast("long")
    files = df.sparkSession.createDataFrame(list(enumerate(paths)), f"{number} long, {file} string")
    placed = placed.join(F.broadcast(files), F.col(path) == F.col(file), "left")
    return placed.select(*cols, (F.shiftleft(F.coalesce(F.col(number), unknown), 40) + F.col(row)).alias(rid))


def partitions_for(df: DataFrame, times: float = 3.0, bytes_per_task: int = 128 << 20) -> int:
    """Partitions for a shuffle of about ``times`` the size that Spark estimates for ``df`` (compressed files are smaller
    than their rows), at least the session's own number.  Meant for scans and written tables: the estimate of a join is
    the product of its sides."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(math.ceil(times * size / bytes_per_task), MAX_PARTITIONS))


def fresh(columns: list[str], name: str) -> str:
    """``name``, lengthened by underscores until no column has it (column names clash without regard to case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
