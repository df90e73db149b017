"""K1 dump sink, K2 manifest sink, K3 run directory.

Dumps are written in ONE distributed write for all types, partitioned by the ``file`` key, in one of
three formats:

* ``parquet`` (default): ``<run>/dumps/file=<key>/part-*.parquet`` with ``(id, doc)``.  The document text
  is a string column, exact to the byte; the id travels with it, so a restore never parses documents and
  its totals read the ``id`` column only.  Splittable, compressed, row positions known (``row_index``).
* ``jsonl``: ``<run>/jsonl/file=<key>/part-*.txt``, one document per line, text unchanged except raw line
  breaks between JSON tokens, which become spaces.  Splittable on read.
* ``array``: ``<run>/arrays/file=<key>/chunk=<n>/part-*.txt``, each file one JSON array (the reference's dump
  format).  A type is salted into ``ceil(bytes / target_bytes)`` chunks so no file (and no task) has to
  hold a whole large type.

``parquet`` and ``jsonl`` need no shuffle: every scan task writes its own files for the types it holds, so
one huge type is spread over all tasks.  The manifest is written last, from the driver (one row per type),
to a temporary name and renamed: its presence marks a complete backup.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docvault.functions.json import strip_nulls
from docvault.model import ARRAYS_DIR, DUMPS_DIR, JSONL_DIR, MANIFEST_NAME
from docvault.session import broadcast_if_small, path_exists, small_frame, unsorted_writes, write_text_file


def new_run_dir(spark: SparkSession, out_root: str) -> str:
    """K3: ``<out>/backup-<epoch seconds>``; an existing directory is never reused or cleared."""
    base = f"{out_root.rstrip('/')}/backup-{int(time.time())}"
    path, n = base, 1
    while path_exists(spark, path):
        n += 1
        path = f"{base}-{n}"
    return path


def write_dumps(docs: DataFrame, run_dir: str, max_records_per_file: int = 1_000_000,
                compression: str | None = None) -> None:
    """K1 (parquet): ``docs`` has ``file``, ``id`` and ``doc``."""
    w = (docs.select("file", "id", "doc").write.partitionBy("file").mode("errorifexists")
         .option("maxRecordsPerFile", max_records_per_file))
    if compression:
        w = w.option("compression", compression)
    with unsorted_writes(docs.sparkSession):
        w.parquet(f"{run_dir}/{DUMPS_DIR}")


def write_jsonl_dumps(docs: DataFrame, run_dir: str, max_records_per_file: int = 1_000_000,
                      compression: str | None = None) -> None:
    """K1 (JSONL): ``docs`` has ``file`` and ``doc``."""
    out = docs.select("file", F.regexp_replace("doc", "[\\r\\n]", " ").alias("value"))
    w = (out.write.partitionBy("file").mode("errorifexists")
         .option("maxRecordsPerFile", max_records_per_file))
    if compression:
        w = w.option("compression", compression)
    with unsorted_writes(docs.sparkSession):
        w.text(f"{run_dir}/{JSONL_DIR}")


def write_array_dumps(docs: DataFrame, run_dir: str, target_bytes: int = 256 * 1024 * 1024) -> None:
    """K1 (JSON arrays): ``docs`` has ``file``, ``id`` and ``doc``; the text is written as it is, line breaks included.

    Array files cannot be split on read and each must fit one task's memory there, so every dump is salted
    into ``ceil(bytes / target_bytes)`` chunk files (sizes from one aggregate over the dump, one row per
    dump).  Each chunk is written by one task; the window that places brackets and commas spans one chunk.
    """
    spark = docs.sparkSession
    sizes = docs.groupBy("file").agg(F.sum(F.octet_length("doc")).alias("_bytes"))
    sizes_local, _ = small_frame(spark, sizes, "dump sizes")
    chunks = F.greatest(F.lit(1), F.ceil(F.col("_bytes") / F.lit(target_bytes))).cast("long")
    salted = (docs.join(broadcast_if_small(sizes_local), "file")
              .withColumn("chunk", F.pmod(F.xxhash64("id", "doc"), chunks).cast("int")))
    w = Window.partitionBy("file", "chunk").orderBy("id", "doc")
    w_all = Window.partitionBy("file", "chunk")
    lines = (salted
             .withColumn("_rn", F.row_number().over(w))
             .withColumn("_n", F.count(F.lit(1)).over(w_all))
             .select("file", "chunk", F.concat(
                 F.when(F.col("_rn") == 1, F.lit("[")).otherwise(F.lit(",")),
                 F.col("doc"),
                 F.when(F.col("_rn") == F.col("_n"), F.lit("]")).otherwise(F.lit(""))).alias("value")))
    lines.write.partitionBy("file", "chunk").mode("errorifexists").text(f"{run_dir}/{ARRAYS_DIR}")


def _raw(v: str | None) -> str | None:
    """Index JSON as printed in the manifest: verbatim, except null-valued members are dropped."""
    if v is None:
        return None
    json.loads(v)  # must be JSON to be embedded
    return strip_nulls(v)


def manifest_text(rows: list[dict]) -> str:
    """K2 body: a pretty JSON array; NULL fields are left out; index JSON is embedded as written."""
    if not rows:
        return "[]"
    items = []
    for r in rows:
        fields = []
        for k in ("client", "tenant", "type", "file", "n_docs"):
            if r.get(k) is not None:
                fields.append(f'        {json.dumps(k)}: {json.dumps(r[k], ensure_ascii=False)}')
        if r.get("indexes") is not None:
            ix = []
            for d in r["indexes"]:
                parts = []
                for k in ("keys", "options"):
                    v = _raw(d.get(k))
                    if v is not None:
                        parts.append(f'                "{k}": {v}')
                ix.append("            {\n" + ",\n".join(parts) + "\n            }")
            fields.append('        "indexes": [\n' + ",\n".join(ix) + "\n        ]")
        items.append("    {\n" + ",\n".join(fields) + "\n    }")
    return "[\n" + ",\n".join(items) + "\n]"


def write_manifest(spark: SparkSession, run_dir: str, rows: list[dict]) -> str:
    """K2: written after every dump; ``rows`` in manifest order."""
    path = f"{run_dir}/{MANIFEST_NAME}"
    write_text_file(spark, path, manifest_text(rows))
    return path
