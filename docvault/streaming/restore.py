"""C4 streaming restore: the dumps as file streams, staged batch by batch, merged into the target once.

``readStream`` over the run's dumps, one stream per kind that the manifest names (parquet, JSONL, own array files, array
files of other origin), ``maxFilesPerTrigger`` bounds a micro-batch and ``trigger(availableNow=True)`` drains what is
there.  A micro-batch only parses its files and writes them, with their place in the dump, under ``<checkpoint>-staged``.

A ledger beside the staged rows names every dump file that is staged: path, length, rows.  A run lists the files of its
own manifest and stages those that the ledger lacks, whatever manifests earlier runs had.  These files are dealt by name to
a few streams that run side by side, each with its own micro-batches and its progress under a name made of its files; a
micro-batch leaves out what the ledger has.  It is one write and nothing else, so many small ones stay cheap.  The batches
that are complete are entered in the ledger together, when the streams have stopped or, if they were lost, when the next run
begins; the lengths are those that the run had listed before its streams.  A replayed batch that is entered is skipped, one
that isn't overwrites its rows, so at-least-once delivery stays exact.  A staged file whose length changes is an error.

When the streams have stopped, the staged rows of the manifest's files go through the same restore as a batch: the same
order (manifest row, file, position), checks, totals, rejects and one merge, so each touched type is written once.  A
merge is recorded by target, manifest and files; a run that repeats one returns its totals.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import docvault.session as session
from docvault.model import ARRAYS_DIR, BINARY_COLUMNS, DUMPS_DIR, JSONL_DIR, MANIFEST_NAME, RestoreError
from docvault.plans.restore import restore_dumps
from docvault.session import among, broadcast_if_small, list_names, local_frame, path_exists, small_frame
from docvault.sources.config import read_manifest
from docvault.sources.dumps import (LINES_SCHEMA, LOADED_SCHEMA, _literal, dump_bytes, frame_binary, line_positions,
                                    list_dump_files, locate_dumps, of_files, raw_lines, with_parsed_id)

LEDGER_SCHEMA = "path string, length long, rows long, at string"
LISTED_SCHEMA = "run string, path string, length long"
BATCH = r"([^/]+/batch=\d+)/[^/]+$"  # <stream>/batch=<id> of a file's path; a stream is <run>-<number>
EMPTY = "batch=empty-"  # ledger entries of files without rows
STREAMS = 8  # of one run, side by side
FOREVER = "36500d"  # files are told apart by the ledger, never by their age


def _source(spark: SparkSession, run_dir: str, kind: str, keys: list[str], most: int, names: list[str] | None) -> DataFrame:
    """The stream of one kind's rows, of the files with the given names.  ``path`` names the file; JSONL rows are numbered when
    they have been written."""
    def stream(fmt, schema):
        reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", most).option("maxFileAge", FOREVER)
        return reader if names is None else reader.option("pathGlobFilter", f"{{{','.join(_literal(n) for n in names)}}}")

    path = F.col("_metadata.file_path").alias("path")
    if kind == "parquet":
        src = stream("parquet", "id string, doc string, file string").load(f"{run_dir}/{DUMPS_DIR}")
        rows = src.select("file", path, F.lit(0).cast("long").alias("blk"), F.col("_metadata.row_index").alias("pos"), "id",
                          F.lit(False).alias("bad"), "doc")
    elif kind == "jsonl":
        src = stream("text", "value string, file string").load(f"{run_dir}/{JSONL_DIR}")
        rows = src.select("file", path, F.col("_metadata.file_block_start").alias("blk"), F.col("value").alias("doc"))
    elif kind == "array":
        src = stream("binaryFile", f"{BINARY_COLUMNS}, file string, chunk int").load(f"{run_dir}/{ARRAYS_DIR}")
        rows = src.select("file", "path", "content")
    else:
        there = ",".join(_literal(f) for f in keys)
        src = stream("binaryFile", BINARY_COLUMNS).load(f"{run_dir}/{{{there}}}")
        return src.select(F.element_at(F.split("path", "/"), -1).alias("file"), "path", "content")
    return of_files(rows, keys)


def _parsed(kind: str, batch: DataFrame) -> DataFrame:
    if kind == "parquet":
        return batch
    if kind == "jsonl":
        rows = batch.select("file", "path", "blk", F.monotonically_increasing_id().alias("pos"), "doc")
        return with_parsed_id(rows).withColumnRenamed("pos", "mono")
    return with_parsed_id(frame_binary(batch))


def _read(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(*paths) if paths else local_frame(spark, [], schema)


def _complete(spark: SparkSession, root: str) -> list[str]:
    """``<stream>/<batch>`` of what is wholly written under a folder of streams."""
    return [f"{s}/{b}" for s, _ in list_names(spark, root) for b, _ in list_names(spark, f"{root}/{s}") if path_exists(spark, f"{root}/{s}/{b}/_SUCCESS")]


def read_ledger(spark: SparkSession, staged_root: str, kind: str) -> DataFrame:
    """The dump files of one kind that are staged: ``(path, length, rows, at)``, ``at`` the batch that holds the rows."""
    root = f"{staged_root}/ledger/{kind}"
    entries = [f"{root}/{e}" for e in _complete(spark, root)]
    if not entries:
        return local_frame(spark, [], LEDGER_SCHEMA)
    own = F.nullif(F.regexp_extract("_metadata.file_path", BATCH, 1), F.lit(""))  # of an entry of one batch
    return _read(spark, entries, LEDGER_SCHEMA).withColumn("at", F.coalesce("at", own))


def _enter(files: DataFrame, at: str) -> None:
    files.select("path", "length", "rows", "at").write.mode("overwrite").parquet(at)


def _enter_complete(spark: SparkSession, staged_root: str, kind: str) -> list[str]:
    """Enter the batches that are written and not yet in the ledger, with one count for all; returns all that have rows."""
    data, listed = f"{staged_root}/{kind}", f"{staged_root}/listed/{kind}"
    done = {r["at"] for r in read_ledger(spark, staged_root, kind).where("at IS NOT NULL").select("at").distinct().collect()}
    runs = {n for n, _ in list_names(spark, listed) if path_exists(spark, f"{listed}/{n}/_SUCCESS")}
    late = [b for b in _complete(spark, data) if b not in done and b.split("-")[0] in runs]
    if late:
        batch = F.regexp_extract("_metadata.file_path", BATCH, 1)
        counts = _read(spark, [f"{data}/{b}" for b in late], "path string").groupBy(batch.alias("at"), "path").agg(F.count(F.lit(1)).alias("rows"))
        counts, rows = small_frame(spark, counts.withColumn("run", F.substring_index("at", "-", 1)), "staged batches")
        if rows:
            lengths = _read(spark, [f"{listed}/{n}" for n in sorted({b.split("-")[0] for b in late})], LISTED_SCHEMA)
            _enter(counts.join(broadcast_if_small(lengths), ["run", "path"]), f"{staged_root}/ledger/{kind}/complete/batch={_digest(*late)}")
            done |= {r["at"] for r in rows}
    return sorted(done)


def _digest(*parts: str) -> str:
    return hashlib.sha256("\0".join(parts).encode()).hexdigest()[:20]


def _stage_kind(spark: SparkSession, run_dir: str, kind: str, keys: list[str], most: int, base: str) -> DataFrame:
    """Stage the files of ``keys`` that the ledger lacks; returns the staged rows of ``keys``."""
    staged_root = f"{base}-staged"
    batches = _enter_complete(spark, staged_root, kind)
    listed, _ = small_frame(spark, list_dump_files(spark, run_dir, kind, keys), "dump files")
    ledger, _ = small_frame(spark, read_ledger(spark, staged_root, kind), "staged files")
    both = listed.join(ledger.select("path", F.col("length").alias("was")), "path", "left")
    changed = both.where(F.col("was") != F.col("length")).first()
    if changed:
        raise RestoreError(f"dump file {changed['path']} has {changed['length']} bytes, but {changed['was']} when it was staged")
    name = F.element_at(F.split("path", "/"), -1)
    if kind in ("parquet", "jsonl"):  # written as a URL
        name = F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
    new, rows = small_frame(spark, both.where(F.col("was").isNull()).select("file", "path", "length", name.alias("name")), "new dump files")
    wanted, lengths = sorted({r["file"] for r in rows}), new.select("path", "length")
    if wanted:
        few = isinstance(rows, list) and len(rows) <= session.MAX_PRUNE_VALUES
        names = sorted({r["name"] for r in rows}) if few else []
        run = _digest(run_dir, *wanted, *names)
        lengths.withColumn("run", F.lit(run)).write.mode("overwrite").parquet(f"{staged_root}/listed/{kind}/{run}")

        def staging(stream: str):
            def stage(batch: DataFrame, batch_id: int) -> None:
                if f"{stream}/batch={batch_id}" in batches:
                    return
                fresh = batch.where(among("path", rows)) if few else batch.join(broadcast_if_small(lengths.select("path")), "path", "left_semi")
                _parsed(kind, fresh.select(*batch.columns)).write.mode("overwrite").parquet(f"{staged_root}/{kind}/{stream}/batch={batch_id}")
            return stage

        queries = []
        try:
            for k, part in enumerate([names[k::STREAMS] for k in range(min(STREAMS, len(names)))] or [None]):
                queries.append(_source(spark, run_dir, kind, wanted, most, part).writeStream.foreachBatch(staging(f"{run}-{k}"))
                               .option("checkpointLocation", f"{base}/{kind}/{run}-{k}").trigger(availableNow=True).start())
            for query in queries:
                query.awaitTermination()
        finally:
            for query in queries:
                query.stop()
        batches = _enter_complete(spark, staged_root, kind)
        # what was listed before the streams ran and gave no rows holds none
        known = read_ledger(spark, staged_root, kind).select("path")
        empty = lengths.join(broadcast_if_small(known), "path", "left_anti")
        entries = f"{staged_root}/ledger/{kind}/{run}"
        _enter(empty.withColumns({"rows": F.lit(0).cast("long"), "at": F.lit(None).cast("string")}), f"{entries}/{EMPTY}{len(list_names(spark, entries))}")
    schema = LINES_SCHEMA if kind == "jsonl" else LOADED_SCHEMA
    staged = _read(spark, [f"{staged_root}/{kind}/{b}" for b in batches], schema)
    columns = staged.columns
    staged = of_files(staged, keys).join(broadcast_if_small(listed.select("path")), "path", "left_semi").select(*columns)
    return line_positions(staged) if kind == "jsonl" else staged


def stream_restore(spark: SparkSession, run_dir: str, target_root: str, checkpoint: str, max_files_per_trigger: int = 64,
                   manifest: DataFrame | None = None, strict: bool = True, skip_indexes: bool = False) -> DataFrame:
    """C4.  Returns the per-manifest-row totals, as the batch restore does."""
    if manifest is None:
        manifest = read_manifest(spark, f"{run_dir}/{MANIFEST_NAME}")
    manifest_local, rows = small_frame(spark, manifest, "manifest")
    base = checkpoint.rstrip("/")
    where = locate_dumps(spark, run_dir, rows)
    dumps = local_frame(spark, [], LOADED_SCHEMA)
    for kind, keys in where.items():
        if keys:
            dumps = dumps.unionByName(_stage_kind(spark, run_dir, kind, keys, max_files_per_trigger, base))
    # a run that repeats a merge has nothing to do: its totals are those of that merge
    named = _digest(target_root, run_dir, str(skip_indexes), str(strict), *_content(manifest_local), *_files(spark, run_dir, where))
    done = f"{base}-merged/{named}"
    if path_exists(spark, f"{done}/_SUCCESS"):
        return spark.read.parquet(done).orderBy("ord")
    result = restore_dumps(spark, dumps, manifest_local, target_root, run_dir.rstrip("/").rsplit("/", 1)[-1], skip_indexes, strict,
                           sizes=dump_bytes(spark, run_dir, where))
    result.totals.write.mode("overwrite").parquet(done)
    return result.totals


def _content(manifest: DataFrame) -> list[str]:
    """A digest of the manifest's rows, whatever their number."""
    text = F.to_json(F.struct(*manifest.columns))
    got = manifest.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(text).cast("decimal(20,0)")).alias("h"),
                       F.bit_xor(F.xxhash64(F.lit("x"), text)).alias("x")).first()
    return [str(v) for v in got]


def _files(spark: SparkSession, run_dir: str, where: dict) -> list[str]:
    out = []
    for kind, keys in where.items():
        if keys:
            got = list_dump_files(spark, run_dir, kind, keys).agg(
                F.count(F.lit(1)), F.sum("length"), F.sum(F.xxhash64("path", "length").cast("decimal(20,0)"))).first()
            out += [kind, *(str(v) for v in got)]
    return out
