"""Restore operators: load (S6 → rows with identity and order), J3 upsert, A1/A3 totals, T8 batch plan.

Serial semantics, evaluated in parallel.  The reference restores manifest rows one after another and the
documents of a row in file order, so across a restore the *first* occurrence of an id can be an insert and
the *last* one wins.  Every loaded document carries ``seq = (ord, path, blk, pos)``; "first" and "last" are
``min``/``max_by`` over it, grouped by (client, tenant, type, id) — never a window over a type, never one
task per type.  The totals aggregate ids only (hash aggregation with map-side combine); the merge moves
documents once, salted so that a large type (large in the dump *or* already in the target) is split over
many tasks of bounded text.  Only rows of the types the manifest touches are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docvault.model import DOCUMENTS_PER_REQUEST
from docvault.operators.types import type_key
from docvault.session import MAX_BROADCAST_BYTES, among, broadcast_if_small, local_frame, small_frame, staged

KEY = ["client", "tenant", "type"]


UNNAMED = "id IS NULL AND NOT bad"
PLACE = ["path", "blk", "pos"]
NUMBER_BYTES = 512  # of a broadcast row that places one numbered document


def name_documents(dumps: DataFrame) -> DataFrame:
    """``dumps`` with an id for every document that has none: its text's hash and its number among its dump's equal ones.

    Equal documents are numbered by hash and place, in a written table that leaves out the first of each, so texts are not
    shuffled: the numbers are broadcast.  When there are too many, the texts are shuffled by place once and written."""
    nth = F.row_number().over(Window.partitionBy("file", "_sha").orderBy(*PLACE))
    places = dumps.where(UNNAMED).select("file", *PLACE, F.sha2("doc", 256).alias("_sha")).withColumn("_nth", nth)
    later = staged(places.where("_nth > 1").select(*PLACE, "_nth"), "equal-documents")
    name = F.concat(F.lit("#"), F.sha2("doc", 256), F.lit("-"), F.coalesce("_nth", F.lit(1)).cast("string"))
    few = later.count() * NUMBER_BYTES <= MAX_BROADCAST_BYTES
    named = dumps.where(UNNAMED).join(F.broadcast(later) if few else later, PLACE, "left").withColumn("id", name).select(*dumps.columns)
    return dumps.where(f"NOT ({UNNAMED})").unionByName(named if few else staged(named, "named-documents"))


def load_documents(dumps: DataFrame, manifest: DataFrame) -> DataFrame:
    """Dump rows ``(file, path, blk, pos, id, bad, doc)`` ⋈ manifest on ``file`` → documents to restore.

    Target names come from the manifest row (two rows may name one file: each restores it).  A document without an
    ``_id`` gets the hash of its text and its number among the dump's equal documents, so the same document has the
    same id in every backup and wherever the run directory lies.
    """
    m = broadcast_if_small(small_frame(manifest.sparkSession, manifest.select("ord", *KEY, "file"), "manifest")[0])
    if not dumps.where(UNNAMED).isEmpty():  # read from the id column alone; most dumps have none and need no numbering
        dumps = name_documents(dumps)
    j = dumps.join(m, "file")
    return j.select("ord", *KEY, "file", F.struct("ord", "path", "blk", "pos").alias("seq"),
                    F.coalesce("id", F.lit("")).alias("id"), "bad", "doc")


# Size of one bucket of a type: a type is salted into
# max(ceil(restored docs / ROWS_PER_TASK), ceil(bytes already in the target / BYTES_PER_TASK)) buckets.
ROWS_PER_TASK = 2_000_000
BYTES_PER_TASK = 256 * 1024 * 1024
# Text of one merge task, which sorts it, and what a row takes besides its text.
MERGE_BYTES = 64 * 1024 * 1024
ROW_BYTES = 256
MAX_TASKS = 200_000  # of one shuffle


def touched_types(manifest: DataFrame, target_bytes: dict | None = None, rows_per_task: int = ROWS_PER_TASK,
                  bytes_per_task: int = BYTES_PER_TASK) -> DataFrame:
    """Distinct types of a manifest with their target partition key ``tkey`` and ``salts`` (buckets).

    ``salts`` covers both what is restored (the manifest's document counts; 0 when a foreign manifest has
    none) and what the target already holds for the type (``target_bytes``: stored bytes per ``tkey``, from
    file metadata).  The list is one row per type: it is materialised on the driver with a size check, so
    it is broadcast without a shuffle and its keys become static partition filters on the target.
    """
    n = F.coalesce(F.col("n_docs"), F.lit(0)) if "n_docs" in manifest.columns else F.lit(0)
    t = (manifest.select(*KEY, n.alias("_n")).groupBy(*KEY).agg(F.sum("_n").alias("_n"))
         .select(*KEY, type_key().alias("tkey"),
                 F.greatest(F.lit(1), F.ceil(F.col("_n") / F.lit(rows_per_task))).cast("int").alias("salts")))
    local, _ = small_frame(manifest.sparkSession, t, "touched types")
    return add_target_salts(local, target_bytes, bytes_per_task) if target_bytes else local


def with_counts(manifest: DataFrame, totals: list) -> DataFrame:
    """The manifest with ``n_docs`` as counted in the dumps (a foreign manifest has none)."""
    counted = local_frame(manifest.sparkSession, [(r["ord"], r["total"]) for r in totals], "ord int, n_docs long")
    return manifest.drop("n_docs").join(broadcast_if_small(counted), "ord", "left")


def add_target_salts(touched: DataFrame, target_bytes: dict, bytes_per_task: int = BYTES_PER_TASK) -> DataFrame:
    """Raise each type's ``salts`` to cover what the target already stores (bytes per ``tkey``)."""
    rows = touched.collect()
    fixed = [(r["client"], r["tenant"], r["type"], r["tkey"],
              max(r["salts"], -(-int(target_bytes.get(r["tkey"], 0)) // bytes_per_task)))
             for r in rows]
    return local_frame(touched.sparkSession, fixed, touched.schema)


def plan_buckets(touched: DataFrame, catalog: DataFrame, manifest: DataFrame, sizes: DataFrame | None = None,
                 bytes_per_task: int = BYTES_PER_TASK) -> DataFrame:
    """``touched`` with ``salts`` = the number of buckets each type will have, and ``kept``: whether it has them already.

    A type's buckets follow its bytes: what the catalog says is stored and what its dumps hold (``sizes``: file, bytes).
    Stored buckets are kept until they are more than twice too large; then the type is written anew with more of them."""
    spark = touched.sparkSession
    have = catalog.groupBy("tkey").agg(F.max("buckets").alias("_have"), F.sum(F.coalesce("bytes", F.lit(0))).alias("_stored"))
    out = touched.join(broadcast_if_small(have), "tkey", "left")
    if sizes is None:
        out = out.withColumn("_new", F.lit(0).cast("long"))
    else:
        new = manifest.join(broadcast_if_small(sizes), "file").groupBy(*KEY).agg(F.sum("bytes").alias("_new"))
        out = out.join(broadcast_if_small(new), KEY, "left")
    size = F.coalesce("_stored", F.lit(0)) + F.coalesce("_new", F.lit(0))
    wanted = F.greatest(F.col("salts"), F.ceil(size / F.lit(bytes_per_task)).cast("int"))
    kept = F.coalesce(wanted <= 2 * F.col("_have"), F.lit(False))
    out = out.select(*KEY, "tkey", F.when(kept, F.col("_have")).otherwise(wanted).alias("salts"), kept.alias("kept"))
    return small_frame(spark, out, "touched types")[0]


def buckets_to_read(catalog: DataFrame, loaded: DataFrame, touched: DataFrame) -> DataFrame:
    """The stored buckets that a restore has to read and replace: those in which a restored id falls, and all of a type that
    is bucketed anew.  ``touched`` from :func:`plan_buckets`; only ids are read."""
    t = broadcast_if_small(touched.select(*KEY, "tkey", "salts", "kept"))
    hit = (loaded.where(~F.col("bad")).select(*KEY, "id").join(t, KEY).where("kept")
           .select("tkey", F.pmod(F.xxhash64("id"), "salts").cast("int").alias("bucket")).distinct())
    named = catalog.join(broadcast_if_small(touched.select("tkey", "kept")), "tkey")
    whole = named.where(~F.col("kept")).drop("kept")
    return whole.unionByName(named.where("kept").drop("kept").join(broadcast_if_small(small_frame(touched.sparkSession, hit, "hit buckets")[0]),
                                                                   ["tkey", "bucket"], "left_semi"))


def touched_part(target: DataFrame, touched: DataFrame) -> DataFrame:
    """The target rows of the touched types.  ``touched`` (from :func:`touched_types`) is one row per type;
    its keys become a static partition filter, so untouched types of the target are not even listed."""
    if "tkey" in target.columns and "tkey" in touched.columns:
        _, rows = small_frame(touched.sparkSession, touched.select("tkey").distinct(), "touched types")
        target = target.where(among("tkey", rows))
    return target.join(broadcast_if_small(touched.select(*KEY)), KEY, "left_semi")


def _target_seq():
    return F.struct(F.lit(-1).alias("ord"), F.lit("").alias("path"), F.lit(-1).cast("long").alias("blk"),
                    F.lit(-1).cast("long").alias("pos"))


def merge_types(target: DataFrame, loaded: DataFrame, touched: DataFrame) -> DataFrame:
    """The new content of the touched types (the only part of the target a restore rewrites).

    Per (type, id) the document with the greatest ``seq`` wins; documents already in the target order
    before everything restored.  One shuffle, on ``(tkey, salt, part)`` with ``salt = hash(id) % salts``: the
    grouping keys include them (all are functions of ``id``, so groups are unchanged), hence the
    aggregation needs no second exchange, every task holds few types (few output files per type) and a huge
    type is split over ``salts`` buckets.  A bucket is sized in stored, compressed bytes, so the texts that are merged
    are measured (:func:`merge_parts`) and a bucket is split into parts of at most ``MERGE_BYTES`` of text, a file each.
    ``max_by`` over text is sort-based: it spills instead of failing.
    ``target`` may be limited to the buckets that :func:`buckets_to_read` names.
    Output: ``(client, tenant, type, id, doc, tkey, bucket)``; the bucket is the salt.
    """
    t = broadcast_if_small(touched.select(*KEY, "tkey", "salts"))
    current = (touched_part(target, touched).select(*KEY, "id", "doc").join(t, KEY)
               .withColumn("seq", _target_seq()))
    new = loaded.where(~F.col("bad")).select(*KEY, "id", "doc", "seq").join(t, KEY)
    u = current.unionByName(new)
    parts = merge_parts(u, touched)
    tasks = parts.agg(F.sum(F.col("salts").cast("long") * F.col("parts"))).first()[0] or 1
    least = int(touched.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    u = (u.join(broadcast_if_small(parts.select("tkey", "parts")), "tkey").withColumn("salt", F.pmod(F.xxhash64("id"), F.col("salts")))
         .withColumn("part", F.pmod(F.xxhash64("id", F.lit("part")), F.col("parts"))))
    return (u.repartition(min(max(int(tasks), least), MAX_TASKS), "tkey", "salt", "part")
            .groupBy("tkey", "salt", "part", *KEY, "id").agg(F.max_by("doc", "seq").alias("doc"))
            .select(*KEY, "id", "doc", "tkey", F.col("salt").cast("int").alias("bucket")))


def merge_parts(documents: DataFrame, touched: DataFrame) -> DataFrame:
    """``(tkey, salts, parts)``: into how many parts each bucket of a type is merged, by the bytes of its documents' text."""
    size = F.octet_length("doc").cast("long") + ROW_BYTES
    text = documents.groupBy("tkey").agg(F.sum(F.coalesce(size, F.lit(ROW_BYTES))).alias("_text"))
    parts = F.ceil(F.coalesce("_text", F.lit(0)) / F.col("salts") / F.lit(MERGE_BYTES))
    sized = touched.select("tkey", "salts").join(text, "tkey", "left")
    return small_frame(touched.sparkSession, sized.select("tkey", "salts", F.greatest(F.lit(1), parts).cast("int").alias("parts")), "merge parts")[0]


def upsert(target: DataFrame, loaded: DataFrame, touched: DataFrame) -> DataFrame:
    """The whole new target as one frame: untouched types as they are, touched types merged."""
    untouched = target.join(broadcast_if_small(touched.select(*KEY)), KEY, "left_anti").select(*KEY, "id", "doc")
    return untouched.unionByName(merge_types(target, loaded, touched).select(*KEY, "id", "doc"))


def restore_totals(manifest: DataFrame, loaded: DataFrame, target: DataFrame, touched: DataFrame) -> DataFrame:
    """A1/A3: per manifest row ``total``, ``inserted``, ``replaced`` and ``rejected``; zeros for empty dumps.

    ``inserted`` = first occurrence in the whole restore and absent from the target before it; text that is
    not JSON is ``rejected`` (never written); ``replaced`` is the rest.  Only ids (no document text) are
    shuffled for this.
    """
    per_row = loaded.groupBy("ord").agg(F.count(F.lit(1)).alias("_total"),
                                        F.count_if("bad").alias("_rejected"))
    # ``seq`` is ord-major, so the first occurrence of an id lies in its smallest ``ord``: an int
    # min/max keeps this a hash aggregation
    existing = (touched_part(target, touched)
                .select(*KEY, "id", F.lit(None).cast("int").alias("_ord"), F.lit(1).alias("_in")))
    ids = (loaded.where(~F.col("bad")).select(*KEY, "id", F.col("ord").alias("_ord"), F.lit(0).alias("_in"))
           .unionByName(existing))
    first = ids.groupBy(*KEY, "id").agg(F.min("_ord").alias("_first"), F.max("_in").alias("_in"))
    ins = (first.where((F.col("_in") == 0) & F.col("_first").isNotNull())
           .groupBy(F.col("_first").alias("ord")).agg(F.count(F.lit(1)).alias("_ins")))
    out = (manifest.select("ord", *KEY).join(broadcast_if_small(per_row), "ord", "left")
           .join(broadcast_if_small(ins), "ord", "left"))
    total = F.coalesce("_total", F.lit(0)).cast("long")
    inserted = F.coalesce("_ins", F.lit(0)).cast("long")
    rejected = F.coalesce("_rejected", F.lit(0)).cast("long")
    return out.select("ord", *KEY, total.alias("total"), inserted.alias("inserted"),
                      (total - inserted - rejected).alias("replaced"), rejected.alias("rejected"))


def assign_batches(loaded: DataFrame, size: int = DOCUMENTS_PER_REQUEST) -> DataFrame:
    """``loaded`` with the insert request (``batch``) of each document: its number in its manifest row, in file order,
    divided by ``size``.

    A document's number is its position in its file plus the documents of the files before it, which takes one row per
    dump file; no window runs over documents."""
    files = loaded.groupBy("ord", F.col("seq.path").alias("path")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("ord").orderBy("path").rowsBetween(Window.unboundedPreceding, -1))
    files = files.select("ord", F.col("path").alias("_path"), F.coalesce(before, F.lit(0)).alias("_before"))
    number = F.col("_before") + F.col("seq.pos")
    return (loaded.withColumn("_path", F.col("seq.path")).join(files, ["ord", "_path"])
            .withColumn("batch", F.floor(number / size).cast("int")).drop("_path", "_before"))


def batch_plan(counts: DataFrame, size: int = DOCUMENTS_PER_REQUEST, n_col: str = "total") -> DataFrame:
    """The insert requests of each manifest row: ``size`` documents each, a short last one.

    Derived from per-row counts, so no window has to number the documents of a huge type in one task.
    ``full`` marks the batches whose progress the reference reports.
    """
    n = F.col(n_col)
    nb = F.ceil(n / F.lit(size)).cast("int")
    seq = F.when(n > 0, F.sequence(F.lit(0), nb - 1)).otherwise(F.array().cast("array<int>"))
    keep = [c for c in counts.columns if c != n_col]
    out = counts.select(*keep, n.alias("_n"), F.explode(seq).alias("batch"))
    docs = F.least(F.lit(size).cast("long"), F.col("_n") - F.col("batch").cast("long") * size)
    return out.select(*keep, "batch", docs.alias("docs"), (docs == size).alias("full"))
