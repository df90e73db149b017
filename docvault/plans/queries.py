"""The registered queries: each takes ``(spark, sf_dir)``, runs over the whole generated tables and returns
a DataFrame.  Queries that back up or restore write into a fresh directory under the shared folder.

The standard request (fixed values) hits the request rules: a repeated type and an unknown one, "all
types" given as missing and as ``[]``, a repeated tenant row, an unknown tenant, and a tenant whose
requested types do not exist.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docvault.model import DOCUMENTS_PER_REQUEST, INDEX_SCHEMA
from docvault.operators.indexes import ensure_indexes, manifest_indexes, usable_indexes
from docvault.operators.manifest import select_manifest
from docvault.operators.restore import assign_batches, batch_plan, load_documents, touched_types
from docvault.operators.types import resolve_types
from docvault.operators.verify import verify_documents, verify_indexes
from docvault.plans.backup import plan_backup, run_backup
from docvault.plans.migrate import migrate
from docvault.plans.restore import indexes_root, restore_frames, run_restore
from docvault.sinks.dumps import new_run_dir, write_dumps, write_jsonl_dumps, write_manifest
from docvault.sinks.snapshot import read_snapshot
from docvault.sinks.target import drop_types_in_place, read_target, stored_types, write_types
from docvault.functions.json import has_weights_all, index_name, prepare_options
from docvault.session import local_frame, scratch_path, small_frame, write_text_file
from docvault.sources.config import read_backup_config, read_manifest, request_frame
from docvault.sources.dumps import read_dumps
from docvault.sources.store import documents_store, index_catalog, store_from_tables, type_catalog
from docvault.streaming.restore import stream_restore

KEY = ["client", "tenant", "type"]

# The standard backup request, as (ord, client, tenant, types).
STANDARD_REQUEST = [
    (0, "analytics", "tenant_0", ["click", "view", "click", "missing"]),
    (1, "analytics", "tenant_1", None),
    (2, "analytics", "tenant_1", []),
    (3, "analytics", "tenant_0", ["click"]),
    (4, "analytics", "nobody", None),
    (5, "corpus", "en", None),
    (6, "corpus", "fr", ["src1", "src3", "src5"]),
    (7, "corpus", "de", ["nope"]),
    (8, "web", "site_0", None),
    (9, "web", "site_1", ["page", "page"]),
]


def standard_request(spark: SparkSession) -> DataFrame:
    return request_frame(spark, STANDARD_REQUEST)


def _store(spark, sf_dir):
    return store_from_tables(spark, sf_dir)


def _catalog(spark, store):
    """S1 once per job, kept on the driver (one row per type, size-checked)."""
    return small_frame(spark, type_catalog(store), "type catalog")[0]


def _env(spark, sf_dir):
    """(store, catalog, index table) of the generated tables."""
    store = _store(spark, sf_dir)
    cat = _catalog(spark, store)
    return store, cat, index_catalog(cat)


def _indexes(spark, sf_dir):
    return _env(spark, sf_dir)[2]


def payload(doc="doc"):
    """A typed field of a stored document, to compare across engines: events ``value``, documents
    ``n_chars``, pages the UTF-8 byte length of the decoded ``html`` (so the whole text must survive)."""
    html = F.octet_length(F.get_json_object(doc, "$.html")).cast("string")
    return F.coalesce(F.get_json_object(doc, "$.value"), F.get_json_object(doc, "$.n_chars"), html).cast("double")


def stale_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The restore target of the queries: every store id divisible by 3 is already there, with old text."""
    s = _store(spark, sf_dir).where(F.col("id").cast("long") % 3 == 0)
    return s.select(*KEY, "id", F.concat(F.lit('{"_id":'), F.col("id"), F.lit(',"stale":true}')).alias("doc"))


def target_view(df: DataFrame) -> DataFrame:
    return df.select(*KEY, "id", F.coalesce(F.get_json_object("doc", "$.stale") == "true", F.lit(False)).alias("stale"),
                     payload().alias("payload"))


def _backup(spark, sf_dir, fmt="parquet", with_indexes=True):
    out = scratch_path(spark, "q-backups")
    store, cat, ix = _env(spark, sf_dir)
    return run_backup(spark, store, standard_request(spark), out, ix if with_indexes else None, fmt=fmt,
                      catalog=cat)


def _seed(spark, root, df):
    write_types(df, root)


# ---------------------------------------------------------------- S1, S4/T1/T2, S3, S2/T3, J1, T4, J2

def q_type_catalog(spark, sf_dir):
    return type_catalog(_store(spark, sf_dir))


def q_resolve_types(spark, sf_dir):
    """S4 → T1 → T2: the request is written as one config file per client and read back."""
    d = scratch_path(spark, "q-config")
    by_client: dict[str, list] = {}
    for o, c, t, types in STANDARD_REQUEST:
        by_client.setdefault(c, []).append((o, {"tenant": t} if types is None else {"tenant": t, "types": types}))
    req = None
    for c, items in by_client.items():
        p = f"{d}/{c}.json"
        write_text_file(spark, p, json.dumps({"tenants": [x for _, x in items]}, indent=4))
        r = read_backup_config(spark, p, c, ord_offset=items[0][0])
        req = r if req is None else req.unionByName(r)
    return resolve_types(req, type_catalog(_store(spark, sf_dir)))


def q_document_scan(spark, sf_dir):
    _, docs = plan_backup(spark, _store(spark, sf_dir), standard_request(spark))
    return docs.select("ord", *KEY, "id", payload().alias("payload"))


def q_index_filter(spark, sf_dir):
    return usable_indexes(_indexes(spark, sf_dir))


def q_index_attach(spark, sf_dir):
    store, cat, ix = _env(spark, sf_dir)
    manifest, _ = plan_backup(spark, store, standard_request(spark), ix, catalog=cat)
    has = F.col("indexes").isNotNull()
    return manifest.select(
        "ord", *KEY, "file",
        has.alias("has_indexes"), F.coalesce(F.size("indexes"), F.lit(0)).alias("n_indexes"),
        F.when(has, F.concat_ws(";", F.transform("indexes", lambda x: x["keys"]))).alias("index_keys"),
        F.when(has, F.concat_ws(";", F.transform("indexes", lambda x: x["options"]))).alias("index_options"))


def q_index_weights(spark, sf_dir):
    ix = _indexes(spark, sf_dir)
    return ix.select(*KEY, "pos", "keys", has_weights_all("options").alias("has_all"),
                     prepare_options("options").alias("options"))


def existing_target_indexes(spark, catalog: DataFrame) -> DataFrame:
    """Index table of the restore target: ``tenant_0`` already has ``user_ts``; ``tenant_1`` has another
    index under that name (an existing name counts as success and is left unchanged)."""
    c = catalog.where(F.col("client") == "analytics")
    a = c.where(F.col("tenant") == "tenant_0").select(*KEY, F.lit(0).alias("pos"),
                                                      F.lit('{"user_id":1,"ts":-1}').alias("keys"),
                                                      F.lit('{"name":"user_ts"}').alias("options"))
    b = c.where(F.col("tenant") == "tenant_1").select(*KEY, F.lit(0).alias("pos"), F.lit('{"other":1}').alias("keys"),
                                                      F.lit('{"name":"user_ts"}').alias("options"))
    return local_frame(spark, [], INDEX_SCHEMA).unionByName(a).unionByName(b)


def q_index_ensure(spark, sf_dir):
    store, cat, ix = _env(spark, sf_dir)
    manifest, _ = plan_backup(spark, store, standard_request(spark), ix, catalog=cat)
    existing = existing_target_indexes(spark, cat)
    created, new_table = ensure_indexes(manifest, existing)
    made = created.select(*KEY, "name").withColumn("created", F.lit(True))
    return (new_table.select(*KEY, index_name("keys", "options").alias("name"), "keys", "options")
            .join(made, KEY + ["name"], "left")
            .select(*KEY, "name", "keys", "options", F.coalesce("created", F.lit(False)).alias("created")))


# ---------------------------------------------------------------- C1: A2/K1/K2/S5/S6, T6, S7

def q_backup_manifest(spark, sf_dir):
    b = _backup(spark, sf_dir)
    m = read_manifest(spark, b.manifest_path)
    has = F.col("indexes").isNotNull()
    return m.select("ord", *KEY, "file", "n_docs", has.alias("has_indexes"),
                    F.coalesce(F.size("indexes"), F.lit(0)).alias("n_indexes"))


def q_backup_roundtrip(spark, sf_dir):
    b = _backup(spark, sf_dir)
    m = read_manifest(spark, b.manifest_path)
    loaded = load_documents(read_dumps(spark, b.run_dir, m.collect()), m)
    return loaded.select(F.col("ord").alias("ord"), *KEY, "id", payload().alias("payload"))


def q_backup_jsonl(spark, sf_dir):
    """K1/S6 with JSON Lines dumps: written as text, read back and parsed for ``_id``."""
    b = _backup(spark, sf_dir, fmt="jsonl", with_indexes=False)
    m = read_manifest(spark, b.manifest_path)
    loaded = load_documents(read_dumps(spark, b.run_dir, m.collect()), m)
    return loaded.select("ord", *KEY, "id", payload().alias("payload"))


def q_manifest_select(spark, sf_dir):
    b = _backup(spark, sf_dir, with_indexes=False)
    m = read_manifest(spark, b.manifest_path)
    sel = select_manifest(m, types=["click", "src1", "src3"], retarget_tenant={"tenant_0": "tenant_9"})
    return sel.select("ord", *KEY, "file", "n_docs")


def q_frame_arrays(spark, sf_dir):
    b = _backup(spark, sf_dir, fmt="array", with_indexes=False)
    m = read_manifest(spark, b.manifest_path)
    loaded = load_documents(read_dumps(spark, b.run_dir, m.collect()), m)
    return loaded.select("ord", *KEY, "id", payload().alias("payload"))


# ---------------------------------------------------------------- C2: T8, A1/A3, J3; C3; C4

def _restore_into_stale(spark, sf_dir, with_indexes=False):
    b = _backup(spark, sf_dir, with_indexes=with_indexes)
    root = scratch_path(spark, "q-target")
    _seed(spark, root, stale_target(spark, sf_dir))
    r = run_restore(spark, b.run_dir, root, skip_indexes=not with_indexes)
    return b, root, r


def q_batch_sizes(spark, sf_dir):
    b = _backup(spark, sf_dir, with_indexes=False)
    m = read_manifest(spark, b.manifest_path)
    dumps = read_dumps(spark, b.run_dir, m.collect())
    _, _, totals, _ = restore_frames(spark, dumps, m, read_target(spark, scratch_path(spark, "q-empty")))
    return batch_plan(totals.select("ord", *KEY, "total")).select(
        "ord", *KEY, F.col("batch").cast("int").alias("batch"), "docs", "full")


def q_restore_totals(spark, sf_dir):
    _, _, r = _restore_into_stale(spark, sf_dir)
    return r.totals.select("ord", *KEY, "total", "inserted", "replaced")


def q_restore_upsert(spark, sf_dir):
    _, root, _ = _restore_into_stale(spark, sf_dir)
    return target_view(read_target(spark, root))


def q_migrate(spark, sf_dir):
    root_b = scratch_path(spark, "q-env-b")
    store, _, ix = _env(spark, sf_dir)
    migrate(spark, store, standard_request(spark), scratch_path(spark, "q-backups"), root_b, ix)
    return target_view(read_target(spark, root_b))


def q_stream_restore(spark, sf_dir):
    b = _backup(spark, sf_dir, with_indexes=False)
    root = scratch_path(spark, "q-target")
    _seed(spark, root, stale_target(spark, sf_dir))
    stream_restore(spark, b.run_dir, root, checkpoint=scratch_path(spark, "q-stream-ckpt"))
    return target_view(read_target(spark, root))


def q_stream_restore_widened(spark, sf_dir):
    """C4 with one checkpoint and three manifests: a subset, everything, and everything of one tenant under another name."""
    b = _backup(spark, sf_dir, with_indexes=False)
    root, ckpt = scratch_path(spark, "q-target"), scratch_path(spark, "q-stream-ckpt")
    _seed(spark, root, stale_target(spark, sf_dir))
    m = read_manifest(spark, b.manifest_path)
    for step in (select_manifest(m, types=["click", "src1"]), m, select_manifest(m, tenants=["tenant_0"], retarget_tenant={"tenant_0": "tenant_9"})):
        stream_restore(spark, b.run_dir, root, ckpt, manifest=step)
    return target_view(read_target(spark, root))


def q_target_catalog(spark, sf_dir):
    """S1 of a restored target, from the catalog that its restores maintain."""
    _, root, _ = _restore_into_stale(spark, sf_dir)
    return stored_types(spark, root)


# ---------------------------------------------------------------- V1–V3

def q_verify_documents(spark, sf_dir):
    """Restore into an empty target, damage it in a known way, and compare it with the dumps."""
    b = _backup(spark, sf_dir, with_indexes=False)
    root = scratch_path(spark, "q-target")
    run_restore(spark, b.run_dir, root, skip_indexes=True)
    t = read_target(spark, root)
    n = F.col("id").cast("long")
    damaged = (t.where(n % 7 != 1)
               .withColumn("doc", F.when(n % 11 == 2, F.concat(F.col("doc"), F.lit(" "))).otherwise(F.col("doc")))
               .unionByName(t.where(n % 13 == 3).withColumn("id", F.concat(F.lit("-"), F.col("id")))))
    m = read_manifest(spark, b.manifest_path)
    loaded = load_documents(read_dumps(spark, b.run_dir, m.collect()), m)
    return verify_documents(loaded, damaged, touched_types(m))


def q_verify_indexes(spark, sf_dir):
    store, cat, ix = _env(spark, sf_dir)
    manifest, _ = plan_backup(spark, store, standard_request(spark), ix, catalog=cat)
    return verify_indexes(manifest, existing_target_indexes(spark, cat))


def q_drop_type(spark, sf_dir):
    _, root, _ = _restore_into_stale(spark, sf_dir)
    drop = local_frame(spark, [("analytics", "tenant_1", "click"), ("analytics", "tenant_1", "view"),
                                  ("corpus", "en", "src0")], "client string, tenant string, type string")
    drop_types_in_place(spark, root, drop)
    return read_target(spark, root).groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- conflicts, texts kept, onward migration

def q_backup_skip_indexes(spark, sf_dir):
    """The same backup with indexes left out, read back."""
    store, cat, ix = _env(spark, sf_dir)
    b = run_backup(spark, store, standard_request(spark), scratch_path(spark, "q-backups"), ix, skip_indexes=True, catalog=cat)
    return read_manifest(spark, b.manifest_path).select("ord", *KEY, "file", "n_docs", F.col("indexes").isNotNull().alias("has_indexes"))


def q_batch_assign(spark, sf_dir):
    """Every restored document's insert request, counted."""
    b = _backup(spark, sf_dir, with_indexes=False)
    m = read_manifest(spark, b.manifest_path)
    docs = assign_batches(load_documents(read_dumps(spark, b.run_dir, m.collect()), m))
    return (docs.groupBy("ord", *KEY, "batch").agg(F.count(F.lit(1)).alias("docs"))
            .withColumn("full", F.col("docs") == DOCUMENTS_PER_REQUEST))


def _conflicting_run(spark, sf_dir):
    """One type, two manifest rows: all documents, then stale text for the ids divisible by 3.  The second row's dump comes
    first by name, so arrival order and manifest order differ."""
    docs = documents_store(spark, sf_dir).select("id", "doc")
    old = docs.where(F.col("id").cast("long") % 3 == 0)
    old = old.select("id", F.concat(F.lit('{"_id":'), F.col("id"), F.lit(',"stale":true}')).alias("doc"))
    run_dir = new_run_dir(spark, scratch_path(spark, "q-backups"))
    parts = docs.withColumn("file", F.lit("f_b")).unionByName(old.withColumn("file", F.lit("f_a")))
    write_dumps(parts, run_dir, max_records_per_file=5_000)
    n = {r["file"]: r["n"] for r in parts.groupBy("file").agg(F.count(F.lit(1)).alias("n")).collect()}
    write_manifest(spark, run_dir, [{"client": "corpus", "tenant": "all", "type": "doc", "file": f, "n_docs": n.get(f, 0)} for f in ("f_b", "f_a")])
    return run_dir


def q_stream_restore_conflicts(spark, sf_dir):
    root = scratch_path(spark, "q-target")
    stream_restore(spark, _conflicting_run(spark, sf_dir), root, scratch_path(spark, "q-stream-ckpt"), max_files_per_trigger=1)
    return target_view(read_target(spark, root))


def q_restore_idless(spark, sf_dir):
    """Two dumps of the same documents without ``_id``, both restored: the second one only replaces."""
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = d.select(F.to_json(F.struct("text", "lang", "source")).alias("doc"))
    root, n = scratch_path(spark, "q-target"), d.count()
    out = None
    for k in range(2):
        run_dir = new_run_dir(spark, scratch_path(spark, "q-backups"))
        write_jsonl_dumps(docs.withColumn("file", F.lit(f"f_{k}")), run_dir)
        write_manifest(spark, run_dir, [{"client": "corpus", "tenant": "all", "type": "doc", "file": f"f_{k}", "n_docs": n}])
        t = run_restore(spark, run_dir, root, skip_indexes=True).totals.select(F.lit(k).alias("run"), "total", "inserted", "replaced")
        out = t if out is None else out.unionByName(t)
    return out


def _typed_indexes(catalog):
    """Index definitions with numbers and orders that a rewrite would change, derived from each type's count."""
    c = catalog.select(*KEY, "n_docs")
    n = F.col("n_docs").cast("string")
    parts = [
        (F.concat(F.lit('{"k":1.50,"n":'), n, F.lit(".50}")), F.concat(F.lit('{"z":1e2,"weights":{"$all":1},"a":'), n, F.lit('.50,"name":"w"}'))),
        (F.concat(F.lit('{"b":1,"a":'), n, F.lit("}")), F.concat(F.lit('{"weights":"{\\"$all\\":1}","b":'), n, F.lit('.10,"a":12345678901234567890123}'))),
    ]
    out = None
    for pos, (keys, options) in enumerate(parts):
        t = c.select(*KEY, F.lit(pos).cast("int").alias("pos"), keys.alias("keys"), options.alias("options"))
        out = t if out is None else out.unionByName(t)
    return out


def q_manifest_text(spark, sf_dir):
    """K2 → S5: index definitions through a written manifest and back, text unchanged."""
    store, cat, _ = _env(spark, sf_dir)
    b = run_backup(spark, store, standard_request(spark), scratch_path(spark, "q-backups"), _typed_indexes(cat), catalog=cat)
    return manifest_indexes(read_manifest(spark, b.manifest_path))


def q_index_options_text(spark, sf_dir):
    """T4 on options whose member order and numbers must survive, and on ``weights`` that is text."""
    ix = _typed_indexes(type_catalog(_store(spark, sf_dir)))
    return ix.select(*KEY, "pos", prepare_options("options").alias("options"))


def q_migrate_onward(spark, sf_dir):
    """C3 twice, A → B → C, each checked by V1 and V2: documents of C, with the number of its type's indexes."""
    root_b, root_c = scratch_path(spark, "q-env-b"), scratch_path(spark, "q-env-c")
    store, _, ix = _env(spark, sf_dir)
    migrate(spark, store, standard_request(spark), scratch_path(spark, "q-backups"), root_b, ix, verify=True)
    have = read_snapshot(spark, indexes_root(root_b), INDEX_SCHEMA)
    migrate(spark, read_target(spark, root_b), standard_request(spark), scratch_path(spark, "q-backups"), root_c, have, verify=True)
    return target_view(read_target(spark, root_c))


QUERIES = {
    "type_catalog": q_type_catalog,
    "resolve_types": q_resolve_types,
    "document_scan": q_document_scan,
    "index_filter": q_index_filter,
    "index_attach": q_index_attach,
    "index_weights": q_index_weights,
    "index_ensure": q_index_ensure,
    "backup_manifest": q_backup_manifest,
    "backup_roundtrip": q_backup_roundtrip,
    "backup_jsonl": q_backup_jsonl,
    "manifest_select": q_manifest_select,
    "frame_arrays": q_frame_arrays,
    "batch_sizes": q_batch_sizes,
    "restore_totals": q_restore_totals,
    "restore_upsert": q_restore_upsert,
    "migrate": q_migrate,
    "stream_restore": q_stream_restore,
    "stream_restore_widened": q_stream_restore_widened,
    "target_catalog": q_target_catalog,
    "verify_documents": q_verify_documents,
    "verify_indexes": q_verify_indexes,
    "drop_type": q_drop_type,
    "backup_skip_indexes": q_backup_skip_indexes,
    "batch_assign": q_batch_assign,
    "stream_restore_conflicts": q_stream_restore_conflicts,
    "restore_idless": q_restore_idless,
    "manifest_text": q_manifest_text,
    "index_options_text": q_index_options_text,
    "migrate_onward": q_migrate_onward,
}
