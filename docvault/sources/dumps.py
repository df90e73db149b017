"""S6 dump-file source and S7 JSON-array framing.

Dumps are located through the manifest: own parquet dumps under ``<run>/dumps/file=<key>/``, JSONL dumps
under ``<run>/jsonl/file=<key>/``, array dumps under ``<run>/arrays/file=<key>/``, foreign array files
directly as ``<run>/<file>``.  A manifest row whose dump is missing is an error naming the file, unless the
manifest says it holds no documents.

Every reader yields ``(file, path, blk, pos, id, bad, doc)``.  ``seq = (path, blk, pos)`` follows file order,
so the serial restore semantics (a later row or later document wins) can be evaluated in parallel.  ``id``
comes from the dump (parquet) or from parsing only the ``_id`` field of the text; ``bad`` marks text that
is not JSON.
"""

from __future__ import annotations

import sys

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import docvault.session as session
from docvault.model import ARRAYS_DIR, BINARY_COLUMNS, DUMPS_DIR, JSONL_DIR, MAX_OBJECT_BYTES, RestoreError
from docvault.session import broadcast_if_small, list_names, local_frame, small_frame, staged

FRAMED_SCHEMA = "file string, path string, blk long, pos long, doc string"
LOADED_SCHEMA = "file string, path string, blk long, pos long, id string, bad boolean, doc string"
LINES_SCHEMA = "file string, path string, blk long, mono long, id string, bad boolean, doc string"
_PARSE = "struct<_id: variant, _corrupt_record: string>"
# One JSON object and nothing else (what follows it would be lost with the line): the parsers stop after a first value,
# so the text is put into an array whose second element must then be this mark.
_MARK = "end"

_BETWEEN = b" \t\r\n,[]"


class FramingError(ValueError):
    pass


def frame_objects(data, max_bytes: int = MAX_OBJECT_BYTES, chunk: int = 16 << 20) -> Iterator[tuple[int, str]]:
    """Split a dump into its top-level ``{...}`` objects, text unchanged.

    Needs braces only, not valid JSON: objects may follow each other without commas, arrays may start
    with a newline.  Braces inside strings do not count.  Anything but whitespace, commas and brackets
    between objects, an object over ``max_bytes`` or an unterminated last object is an error.

    Works on the UTF-8 bytes (structural characters are ASCII and never occur inside a multi-byte
    character) and touches only quote and brace positions: a quote is real unless an odd run of
    backslashes precedes it; a brace counts when an even number of real quotes precedes it; a running sum
    over the counted braces gives the depth.  Chunks bound the temporary arrays; state carries over.
    """
    buf = data.encode("utf-8") if isinstance(data, str) else bytes(data)
    arr = np.frombuffer(buf, dtype=np.uint8)
    parity, depth, open_at, last_end, pos = 0, 0, -1, 0, 0
    for g in range(0, len(buf), chunk):
        c = arr[g:g + chunk]
        q = np.flatnonzero(c == 34) + g
        if len(q):
            after_bs = q[(q > 0) & (arr[np.maximum(q - 1, 0)] == 92)]
            escaped = []
            for i in after_bs.tolist():
                j = i - 1
                while j >= 0 and buf[j] == 92:
                    j -= 1
                if (i - 1 - j) % 2:
                    escaped.append(i)
            if escaped:
                q = np.setdiff1d(q, np.asarray(escaped, dtype=q.dtype), assume_unique=True)
        b = np.flatnonzero((c == 123) | (c == 125)) + g
        b = b[(parity + np.searchsorted(q, b)) % 2 == 0]
        sign = np.where(arr[b] == 123, 1, -1)
        d_after = depth + np.cumsum(sign)
        if len(d_after) and d_after.min() < 0:
            raise FramingError(f"unbalanced '}}' at byte {int(b[np.argmax(d_after < 0)])}")
        starts = b[(sign == 1) & (d_after == 1)]
        ends = b[(sign == -1) & (d_after == 0)]
        opens = ([open_at] if open_at >= 0 else []) + starts.tolist()
        for s0, e0 in zip(opens, ends.tolist()):
            if buf[last_end:s0].strip(_BETWEEN):
                raise FramingError(f"unexpected text outside an object at byte {last_end}")
            if e0 - s0 + 1 > max_bytes:
                raise FramingError(f"object {pos} exceeds {max_bytes} bytes")
            yield pos, buf[s0:e0 + 1].decode("utf-8")
            pos += 1
            last_end = e0 + 1
        open_at = opens[-1] if len(opens) > len(ends) else -1
        if open_at >= 0 and g + len(c) - open_at > max_bytes:
            raise FramingError(f"object {pos} exceeds {max_bytes} bytes")
        parity = (parity + len(q)) % 2
        depth = int(d_after[-1]) if len(d_after) else depth
    if depth != 0 or open_at >= 0:
        raise FramingError(f"truncated object {pos} at byte {open_at}")
    if buf[last_end:].strip(_BETWEEN):
        raise FramingError(f"unexpected text after the last object at byte {last_end}")


_FILE_DIR = re.compile(r"/file=([^/]+)/")


def _frame_batches(batches: Iterator[pd.DataFrame], max_bytes: int, out_rows: int = 4096):
    for b in batches:
        for path, content in zip(b["path"], b["content"]):
            m = _FILE_DIR.search(path)
            key = m.group(1) if m else path.rsplit("/", 1)[-1]
            acc = []
            try:
                for pos, obj in frame_objects(content, max_bytes):
                    acc.append((key, path, 0, pos, obj))
                    if len(acc) >= out_rows:
                        yield pd.DataFrame(acc, columns=["file", "path", "blk", "pos", "doc"])
                        acc = []
            except FramingError as e:
                raise FramingError(f"{path}: {e}") from None
            if acc:
                yield pd.DataFrame(acc, columns=["file", "path", "blk", "pos", "doc"])


def with_parsed_id(df: DataFrame) -> DataFrame:
    """Adds ``id`` (JSON text of ``_id``; only that field is materialised) and ``bad`` (not one JSON object)."""
    p = F.from_json("doc", _PARSE, {"columnNameOfCorruptRecord": "_corrupt_record"})
    second = F.get_json_object(F.concat(F.lit("["), F.col("doc"), F.lit(f',"{_MARK}"]')), "$[1]")
    bad = F.col("_p._corrupt_record").isNotNull() | ~F.col("doc").rlike(r"^\s*\{") | ~second.eqNullSafe(F.lit(_MARK))
    return (df.withColumn("_p", p)
            .select("file", "path", "blk", "pos", F.nullif(F.to_json(F.col("_p._id")), F.lit("null")).alias("id"), bad.alias("bad"), "doc"))


def frame_array_files(spark: SparkSession, paths: list[str], max_bytes: int = MAX_OBJECT_BYTES) -> DataFrame:
    """JSON-array dump files → ``(file, path, blk, pos, doc)``.

    One task per file group (array files do not split; each file must fit a task's memory), the scanner
    runs over Arrow batches of whole files.  Gzip files (``*.gz``) are not supported here.
    """
    if not paths:
        return local_frame(spark, [], FRAMED_SCHEMA)
    raw = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
           .load(paths).select("path", "content"))
    return frame_binary(raw, max_bytes)


def _sum(column: str, frame):
    return F.coalesce(F.sum(column).over(frame), F.lit(0))


def _split_states(pieces: DataFrame) -> DataFrame:
    """Measured pieces → ``path, blk, _own, _back``, one row per split: its home, and the last home before it.

    A home is the first piece of a split that opens an object outside all others: its ``mono``, whether it starts inside a
    string (``odd``), its place ``at`` and the number of objects before it.  Depth is never negative in a file that can be
    framed, so depth 0 is where a split's running sum is lowest, whatever the depth it starts at."""
    split = Window.partitionBy("path", "blk")
    before = split.orderBy("mono").rowsBetween(Window.unboundedPreceding, -1)
    n = pieces.select("path", "blk", "mono", "bytes", "flip", "out", "in")
    n = n.withColumn("rel", _sum("flip", before) % 2).withColumn("off", _sum("bytes", before))
    for odd in (0, 1):  # as if the split started outside (0) or inside (1) a string
        quoted = (F.col("rel") + odd) % 2 == 1
        opens = F.when(quoted, F.col("in")).otherwise(F.col("out"))
        n = n.withColumn(f"opens{odd}", opens).withColumn(f"step{odd}", opens - (quoted == (F.col("flip") == 1)).cast("int"))
    for odd in (0, 1):
        n = n.withColumn(f"depth{odd}", _sum(f"step{odd}", before))
    for odd in (0, 1):
        n = n.withColumn(f"low{odd}", F.min(f"depth{odd}").over(split))
    sums = [F.sum("flip").alias("flips"), F.sum("bytes").alias("bytes")]
    for odd in (0, 1):
        starts = (F.col(f"opens{odd}") > 0) & (F.col(f"depth{odd}") == F.col(f"low{odd}"))
        home = F.when(starts, F.struct("mono", "rel", "off"))
        sums.append(F.struct(F.sum(f"step{odd}").alias("step"), F.min(f"low{odd}").alias("low"), F.count_if(starts).alias("starts"),
                             F.min(home).alias("home")).alias(f"as{odd}"))
    splits = n.groupBy("path", "blk").agg(*sums)
    earlier = Window.partitionBy("path").orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("odd", _sum("flips", earlier) % 2).withColumn("at", _sum("bytes", earlier))
    now = F.when(F.col("odd") == 1, F.col("as1")).otherwise(F.col("as0"))
    splits = splits.select("path", "blk", "odd", "at", now.alias("now")).select("path", "blk", "odd", "at", "now.*")
    splits = splits.withColumn("depth", _sum("step", earlier))
    splits = splits.withColumn("starts", F.when(F.col("depth") == -F.col("low"), F.col("starts")).otherwise(0))
    splits = splits.withColumn("objects", _sum("starts", earlier))
    own = F.when(F.col("starts") > 0, F.struct(
        F.col("home.mono").alias("mono"), F.col("blk").alias("home"), ((F.col("odd") + F.col("home.rel")) % 2).alias("odd"),
        (F.col("at") + F.col("home.off")).alias("at"), F.col("objects").alias("objects")))
    splits = splits.select("path", "blk", own.alias("_own"))
    return splits.withColumn("_back", F.last("_own", ignorenulls=True).over(earlier))


def frame_text_files(spark: SparkSession, paths: list[str], max_bytes: int = MAX_OBJECT_BYTES) -> DataFrame:
    """S7 over files of any length: ``(file, path, blk, pos, doc)``, read in splits.

    The text reader cuts a file after each ``}``.  What a piece does to the state (inside a string or not, depth) hangs on
    whether it starts inside a string, so it is measured for both cases; the measures are composed to one row per split, and
    running sums over these rows give the state before each split.  All of that moves narrow rows.  A split's *home* is where
    an object opens outside all others; the pieces from one home to the next, mostly one split, are a group that holds
    whole objects, so the text is written once, moved once to its groups and put together there.  Text outside objects other
    than white space, commas and brackets, an object over ``max_bytes``, an unbalanced ``}`` or an unterminated object is an
    error that names the file.
    """
    if not paths:
        return local_frame(spark, [], FRAMED_SCHEMA)
    meta = F.col("_metadata")
    raw = spark.read.option("lineSep", "}").text(paths).select(
        F.url_decode(F.replace(meta["file_path"], F.lit("+"), F.lit("%2B"))).alias("path"),
        meta["file_block_start"].alias("blk"), meta["file_size"].alias("size"), F.monotonically_increasing_id().alias("mono"), "value")
    plain = F.split(F.regexp_replace("value", r"(?s)\\.", ""), '"', -1)  # without escapes, cut at the real quotes

    def opens(odd: int):  # braces in every second part
        return F.aggregate(F.transform("_parts", lambda x, i: F.when(i % 2 == odd, F.char_length(x) - F.char_length(F.replace(x, F.lit("{"), F.lit(""))))
                                       .otherwise(0)), F.lit(0).cast("long"), lambda a, x: a + x)

    p = raw.withColumn("_parts", plain).select(
        "path", "blk", "size", "mono", "value", (F.octet_length("value") + 1).cast("long").alias("bytes"),
        ((F.size("_parts") - 1) % 2).alias("flip"), opens(0).alias("out"), opens(1).alias("in"))
    p = stage_parsed(p)
    own, back = F.col("_own"), F.col("_back")
    here = F.col("mono") >= own["mono"]  # the home of this split has been reached
    start = F.when(here, own).otherwise(back)
    p = p.join(broadcast_if_small(_split_states(p)), ["path", "blk"])
    p = p.withColumn("_start", start).select(
        "path", "blk", "size", "mono", "value", "bytes", "flip", "out", "in",
        *[F.coalesce(F.col("_start")[c], F.lit(none)).alias(f"_{c}") for c, none in (("home", -1), ("odd", 0), ("at", 0), ("objects", 0))])
    group = Window.partitionBy("path", "_home").orderBy("blk", "mono")
    upto = group.rowsBetween(Window.unboundedPreceding, 0)
    before = group.rowsBetween(Window.unboundedPreceding, -1)
    p = (p.withColumn("quoted", (F.col("_odd") + _sum("flip", before)) % 2 == 1)
         .withColumn("at", F.col("_at") + _sum("bytes", before))
         .withColumn("opens", F.when(F.col("quoted"), F.col("in")).otherwise(F.col("out"))))
    # the reader does not tell whether the last piece was followed by a brace: the file's length does
    shut = (F.col("at") + F.col("bytes") <= F.col("size")) & (F.col("quoted") == (F.col("flip") == 1))
    p = p.withColumn("step", F.col("opens") - shut.cast("int")).withColumn("depth", _sum("step", before))
    p = p.withColumn("first", (F.col("depth") == 0) & (F.col("opens") > 0))
    p = p.withColumn("object", F.col("_objects") + F.sum(F.col("first").cast("int")).over(upto) - 1)
    p = p.withColumn("head", F.when(F.col("first"), F.substring_index("value", "{", 1))
                     .when((F.col("depth") == 0) & ~F.col("first"), F.col("value")))
    last = F.col("at") + F.col("bytes") >= F.col("size")
    wrong = (F.when(F.col("depth") + F.col("step") < 0, "an unbalanced '}'")
             .when(F.col("head").isNotNull() & ~F.col("head").rlike(r"^[ \t\r\n,\[\]]*$"), "text outside an object")
             .when(last & ((F.col("depth") + F.col("step") > 0) | (F.col("quoted") != (F.col("flip") == 1))), "a truncated object"))
    fail = F.raise_error(F.concat(F.col("path"), F.lit(": "), wrong, F.lit(" near byte "), F.col("at").cast("string")))
    text = F.when(F.col("first"), F.substring("value", F.char_length("head") + 1, F.char_length("value"))).otherwise(F.col("value"))
    text = F.concat(text, F.when(F.col("at") + F.col("bytes") <= F.col("size"), F.lit("}")).otherwise(F.lit("")))
    part = p.select("path", "_home", "object", "at", F.when(wrong.isNotNull(), fail).otherwise(F.col("head").isNull() | F.col("first")).alias("keep"), text.alias("text"))
    part = part.where("keep")
    whole = part.groupBy("path", "_home", "object").agg(F.sum(F.octet_length("text")).alias("n"), F.array_sort(F.collect_list(F.struct("at", "text"))).alias("t"))
    doc = F.array_join(F.transform("t", lambda x: x["text"]), "")
    doc = F.when(F.col("n") > max_bytes, F.raise_error(F.concat(F.col("path"), F.lit(f": object exceeds {max_bytes} bytes")))).otherwise(doc)
    key = F.regexp_extract("path", r"/file=([^/]+)/", 1)
    key = F.when(key == "", F.element_at(F.split("path", "/"), -1)).otherwise(key)
    return whole.select(key.alias("file"), "path", F.lit(0).cast("long").alias("blk"), F.col("object").cast("long").alias("pos"), doc.alias("doc"))


def frame_binary(raw: DataFrame, max_bytes: int = MAX_OBJECT_BYTES) -> DataFrame:
    """S7 over a frame of whole files ``(path, content)`` (a batch or a micro-batch of ``binaryFile``)."""
    return raw.select("path", "content").mapInPandas(lambda it: _frame_batches(it, max_bytes), FRAMED_SCHEMA)


def read_parquet_dumps(spark: SparkSession, dumps_dir: str, keys: list[str]) -> DataFrame:
    """Own parquet dumps of the given keys.  No parsing: ``id`` is stored; ``pos`` is the row index."""
    if not keys:
        return local_frame(spark, [], LOADED_SCHEMA)
    df = spark.read.schema("id string, doc string, file string").parquet(dumps_dir)
    return of_files(df.select("file", F.col("_metadata.file_path").alias("path"), F.lit(0).cast("long").alias("blk"),
                              F.col("_metadata.row_index").alias("pos"), "id", F.lit(False).alias("bad"), "doc"), keys)


def raw_lines(df: DataFrame) -> DataFrame:
    """A scan of JSONL files (``file, value``) → ``(file, path, blk, mono, id, bad, doc)``, to be written before it is numbered."""
    lines = df.select("file", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("blk"),
                      F.monotonically_increasing_id().alias("pos"), F.col("value").alias("doc"))
    return with_parsed_id(lines).withColumnRenamed("pos", "mono")


def line_positions(written: DataFrame) -> DataFrame:
    """Written :func:`raw_lines` → dump rows whose ``pos`` is the line's number in its file.

    ``mono`` rises inside a block (a split of a file), and the lines of the blocks before one give its first number, one
    row per block.  How a scan is cut follows the cores that are registered, so block starts and ``mono`` only agree
    within one evaluation: both the counts and the lines are read from what that evaluation wrote.
    """
    blocks = written.groupBy("path", "blk").agg(F.min("mono").alias("_m0"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy("path").orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("path", "blk", "_m0", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_l0"))
    starts = broadcast_if_small(small_frame(written.sparkSession, starts, "dump blocks")[0])
    return (written.join(starts, ["path", "blk"])
            .select("file", "path", F.lit(0).cast("long").alias("blk"), (F.col("_l0") + F.col("mono") - F.col("_m0")).alias("pos"),
                    "id", "bad", "doc"))


def of_files(df: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose ``file`` is among ``keys``: a static partition filter for a short list, a join for a long one."""
    spark = df.sparkSession
    if len(keys) <= session.MAX_PRUNE_VALUES:
        return df.where(F.col("file").isin(keys))
    return df.join(broadcast_if_small(local_frame(spark, [(k,) for k in keys], "file string")), "file", "left_semi")


def read_jsonl_dumps(spark: SparkSession, dumps_dir: str, keys: list[str]) -> DataFrame:
    """JSONL dumps of the given keys → ``(file, path, blk, pos, id, bad, doc)``.

    Only the named ``file=`` partitions are read; the lines are parsed and written once and numbered from there, so ids
    given to documents without ``_id`` are the same on every run.
    """
    if not keys:
        return local_frame(spark, [], LOADED_SCHEMA)
    # the metadata columns are taken at the scan: the join of a long list of keys comes after them
    df = spark.read.schema("value string, file string").text(dumps_dir)
    return line_positions(stage_parsed(of_files(raw_lines(df), keys)))


def locate_dumps(spark: SparkSession, run_dir: str, manifest_rows: list) -> dict:
    """Where each manifest file lives: ``{'parquet'|'jsonl'|'array'|'foreign': [...]}``; raises R21."""
    def keys(sub):
        return {n[5:] for n, d in list_names(spark, f"{run_dir}/{sub}") if d and n.startswith("file=")}

    parquet, jsonl, arrays = keys(DUMPS_DIR), keys(JSONL_DIR), keys(ARRAYS_DIR)
    own = {n for n, _ in list_names(spark, run_dir)}
    nested: dict[str, set] = {}  # file names with folders: one listing per folder

    def there(f: str) -> bool:
        folder, _, name = f.rpartition("/")
        if not folder:
            return name in own
        if folder not in nested:
            nested[folder] = {n for n, _ in list_names(spark, f"{run_dir}/{folder}")}
        return name in nested[folder]

    found = {"parquet": set(), "jsonl": set(), "array": set(), "foreign": set()}
    for r in manifest_rows:
        f = r["file"]
        if f in parquet:
            found["parquet"].add(f)
        elif f in jsonl:
            found["jsonl"].add(f)
        elif f in arrays:
            found["array"].add(f)
        elif there(f):
            found["foreign"].add(f)
        elif r["n_docs"] is not None and r["n_docs"] == 0:
            continue
        else:
            raise RestoreError(f"the manifest names {f}, but {run_dir} holds no such dump")
    return {k: sorted(v) for k, v in found.items()}


# Where the dump files of each kind lie in a run directory; foreign files lie in it directly.
FOLDERS = {"parquet": DUMPS_DIR, "jsonl": JSONL_DIR, "array": ARRAYS_DIR}


def list_dump_files(spark: SparkSession, run_dir: str, kind: str, keys: list[str]) -> DataFrame:
    """``(file, path, length)`` of the dump files of the given keys: a listing that Spark distributes; nothing is opened.
    ``path`` is written as the scan of the kind writes it."""
    path = F.col("_metadata.file_path").alias("path") if kind in ("parquet", "jsonl") else F.col("path")
    place = [path, F.col("_metadata.file_size").alias("length")]
    if not keys:
        return local_frame(spark, [], "file string, path string, length long")
    if kind == "foreign":
        files = spark.read.format("binaryFile").load([f"{run_dir}/{_literal(k)}" for k in keys])
        return files.select(F.element_at(F.split("path", "/"), -1).alias("file"), *place)
    partitions = ", ".join(["file string", *(["chunk int"] if kind == "array" else [])])
    files = spark.read.format("binaryFile").schema(f"{BINARY_COLUMNS}, {partitions}").load(f"{run_dir}/{FOLDERS[kind]}")
    return of_files(files.select("file", *place), keys)


def dump_bytes(spark: SparkSession, run_dir: str, where: dict) -> DataFrame:
    """``(file, bytes)`` of located dumps, from file listings."""
    out = None
    for kind, keys in where.items():
        if keys:
            part = list_dump_files(spark, run_dir, kind, keys)
            out = part if out is None else out.unionByName(part)
    if out is None:
        return local_frame(spark, [], "file string, bytes long")
    return out.groupBy("file").agg(F.sum("length").alias("bytes"))


def stage_parsed(df: DataFrame) -> DataFrame:
    """Text dumps are framed and parsed once: the result is written to the shared folder and read from there."""
    return staged(df, "parsed-dumps")


def _literal(name: str) -> str:
    """A file name for a path that is read as a pattern."""
    return "".join(f"\\{c}" if c in "\\*?[]{},^" else c for c in name)


def read_dumps(spark: SparkSession, run_dir: str, manifest_rows: list, where: dict | None = None) -> DataFrame:
    """Every dump named by the manifest, each file once → ``(file, path, blk, pos, id, bad, doc)``.
    ``where``: the located dumps, when they are known."""
    where = locate_dumps(spark, run_dir, manifest_rows) if where is None else where
    parts = []
    if where["parquet"] or not (where["jsonl"] or where["array"] or where["foreign"]):
        parts.append(read_parquet_dumps(spark, f"{run_dir}/{DUMPS_DIR}", where["parquet"]))
    if where["jsonl"]:
        parts.append(read_jsonl_dumps(spark, f"{run_dir}/{JSONL_DIR}", where["jsonl"]))
    if where["array"]:  # our own, of bounded size
        paths = [f"{run_dir}/{ARRAYS_DIR}/file={k}" for k in where["array"]]
        parts.append(stage_parsed(with_parsed_id(frame_array_files(spark, paths))))
    if where["foreign"]:
        paths = [f"{run_dir}/{_literal(k)}" for k in where["foreign"]]
        parts.append(stage_parsed(with_parsed_id(frame_text_files(spark, paths))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# Ship this module's Python code with its UDFs, so workers need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
