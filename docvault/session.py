"""Session defaults and the shared scratch location.

Everything that is written as an intermediate (run directories of queries, lineage cuts) goes under the
folder named by ``spark.checkpoint.dir``.  On a cluster that setting names shared storage; only when it is
unset (local tests) do we create one.
"""

from __future__ import annotations

import re
import tempfile
import time
import uuid
from contextlib import contextmanager

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

# Up to so many rows a metadata frame (requests, resolved types, manifests: one row per document type) is kept as a
# local relation.  A larger one is a written table that is read where it is needed and joined as Spark sees fit.
MAX_LOCAL_ROWS = 200_000
# A frame is only broadcast when Spark's own size estimate proves it to be no larger.
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
# Longest list of values in a static filter.
MAX_PRUNE_VALUES = 2_000
# Files that a task of a partitioned write keeps open at once.
OPEN_FILES = 128


def build_session(master: str | None = None, app: str = "docvault", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.  Only a local session that names none gets a temporary one; on a cluster
    a folder of one machine would be lost to the others, so that is an error."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="docvault-ckpt-"))
        d = spark.sparkContext.getCheckpointDir()
    return d.rstrip("/")


def scratch_path(spark: SparkSession, prefix: str) -> str:
    """A fresh, never reused path under the shared folder (not created)."""
    return f"{shared_dir(spark)}/{prefix}-{int(time.time())}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, prefix: str) -> DataFrame:
    """``df`` written to the shared folder and read from there."""
    path = scratch_path(df.sparkSession, prefix)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def unsorted_writes(spark: SparkSession):
    """Partitioned writes in here put each row straight into its partition's open file.

    Otherwise Spark sorts all that a task holds by partition, and a scan task holds as many rows as its split, some dozen
    times the split's size when rows are narrow.  A task that meets more than ``OPEN_FILES`` partitions sorts what is left."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(max(int(before), OPEN_FILES)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def hadoop_fs(spark: SparkSession, path: str):
    """(FileSystem, Path) for a path, through the JVM so any Hadoop-compatible store works."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_fs(spark, path)
    return bool(fs.exists(p))


def list_names(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """(name, is_dir) of the direct children of a directory; [] when it does not exist."""
    fs, p = hadoop_fs(spark, path)
    if not fs.exists(p):
        return []
    return [(st.getPath().getName(), bool(st.isDirectory())) for st in fs.listStatus(p)]


def write_text_file(spark: SparkSession, path: str, text: str, overwrite: bool = False) -> None:
    """Write one small file from the driver: to a temporary name, then rename (the rename is the commit)."""
    fs, p = hadoop_fs(spark, path)
    if fs.exists(p) and not overwrite:
        raise FileExistsError(path)
    jvm = spark.sparkContext._jvm
    tmp = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{uuid.uuid4().hex}.tmp")
    out = fs.create(tmp, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if overwrite and fs.exists(p):
        fs.delete(p, False)
    if not fs.rename(tmp, p):
        raise OSError(f"could not commit {path}")


def put_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create one small file with its whole content, unless it exists: of several writers exactly one gets True.

    The content is written to a temporary name first.  On a local file system a hard link to it is the exclusive step;
    elsewhere a rename, which HDFS refuses when the name is taken."""
    fs, p = hadoop_fs(spark, path)
    jvm = spark.sparkContext._jvm
    tmp = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{uuid.uuid4().hex}.tmp")
    if fs.exists(p):
        return False
    out = fs.create(tmp, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    try:
        if fs.getUri().getScheme() == "file":
            as_file = lambda q: jvm.java.io.File(q.toUri().getPath()).toPath()
            try:
                jvm.java.nio.file.Files.createLink(as_file(p), as_file(tmp))
                return True
            except Py4JJavaError:
                if fs.exists(p):
                    return False
                raise
        return not fs.exists(p) and bool(fs.rename(tmp, p))
    finally:
        fs.delete(tmp, False)


def read_text_file(spark: SparkSession, path: str) -> str:
    fs, p = hadoop_fs(spark, path)
    if not fs.exists(p):
        raise FileNotFoundError(path)
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        data = jvm.org.apache.commons.io.IOUtils.toByteArray(stream)
    finally:
        stream.close()
    return bytes(data).decode("utf-8")


class StoredRows:
    """The rows of a written metadata table, read again at each iteration, a partition at a time."""

    def __init__(self, df: DataFrame):
        self.df = df

    def __iter__(self):
        return self.df.toLocalIterator()

    def __bool__(self) -> bool:
        return True


def small_frame(spark: SparkSession, df: DataFrame, what: str, max_rows: int | None = None):
    """Evaluate a metadata frame once: ``(frame, rows)``.

    Up to ``max_rows`` (default ``MAX_LOCAL_ROWS``) rows it becomes a local relation and a list.  A larger one is
    written to the shared folder; its rows are then a :class:`StoredRows`, to be iterated but not collected.
    """
    limit = MAX_LOCAL_ROWS if max_rows is None else max_rows
    rows = df.limit(limit + 1).collect()
    if len(rows) <= limit:
        return local_frame(spark, rows, df.schema), rows
    path = scratch_path(spark, "metadata-" + what.replace(" ", "-"))
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    return stored, StoredRows(stored)


def broadcast_if_small(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint when its estimated size allows it; else as it is (an ordinary join)."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return F.broadcast(df) if size <= max_bytes else df


def among(column: str, rows) -> "F.Column":
    """``column IN (its values in rows)``, to prune a scan early; always true for rows that aren't a short list, where
    the join that follows does the work."""
    if isinstance(rows, list) and len(rows) <= MAX_PRUNE_VALUES:
        return F.col(column).isin(sorted({r[column] for r in rows}))
    return F.lit(True)


def local_frame(spark: SparkSession, rows: list, schema) -> DataFrame:
    """A frame of driver-side rows, shipped as an Arrow table whatever the session's settings.

    Scanning it needs no Python worker, and Spark knows its size, so it can be broadcast: of a frame made from Python rows
    it does not, and a join with one shuffles the documents by type."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    columns = [pa.array([_plain(r[i]) for r in rows], type=to_arrow_type(f.dataType)) for i, f in enumerate(schema.fields)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, names=schema.names), schema)


def _plain(v):
    """Rows become dicts for the Arrow conversion."""
    if isinstance(v, list):
        return [_plain(x) for x in v]
    if hasattr(v, "asDict"):
        return v.asDict(recursive=True)
    return v
