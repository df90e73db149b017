"""The document store as a table, built over the generated test tables, plus the store's two catalogs.

``store(client, tenant, type, id, doc)``:

* ``events``    → client ``analytics``, tenant ``tenant_<user_id % 2>``, type ``event_type``, ``_id`` = ``event_id``
* ``documents`` → client ``corpus``, tenant ``lang``, type ``source``, ``_id`` = ``doc_id``
* ``pages``     → client ``web``, tenant ``site_<page_id % 2>``, type ``page``, ``_id`` = ``page_id`` (raw HTML:
  line breaks, quotes, braces and non-ASCII text inside the documents)

``doc`` is the row as one JSON object; ``id`` is the JSON text of its ``_id`` (what ``functions.doc_id`` yields).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docvault.session import among, broadcast_if_small, small_frame

TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def events_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    doc = F.to_json(F.struct(
        F.col("event_id").alias("_id"),
        F.date_format("ts", TS_FORMAT).alias("ts"),
        "user_id", "event_type", "value", "props"))
    return e.select(
        F.lit("analytics").alias("client"),
        F.concat(F.lit("tenant_"), (F.col("user_id") % 2).cast("string")).alias("tenant"),
        F.col("event_type").alias("type"),
        F.col("event_id").cast("string").alias("id"),
        doc.alias("doc"))


def documents_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    doc = F.to_json(F.struct(F.col("doc_id").alias("_id"), "text", "lang", "source", "n_chars"))
    return d.select(
        F.lit("corpus").alias("client"),
        F.col("lang").alias("tenant"),
        F.col("source").alias("type"),
        F.col("doc_id").cast("string").alias("id"),
        doc.alias("doc"))


def pages_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = spark.read.parquet(f"{sf_dir}/pages.parquet")
    doc = F.to_json(F.struct(F.col("page_id").alias("_id"), "url", "html"))
    return p.select(
        F.lit("web").alias("client"),
        F.concat(F.lit("site_"), (F.col("page_id") % 2).cast("string")).alias("tenant"),
        F.lit("page").alias("type"),
        F.col("page_id").cast("string").alias("id"),
        doc.alias("doc"))


def store_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source store: a union of three scans, no shuffle."""
    return (events_store(spark, sf_dir).unionByName(documents_store(spark, sf_dir))
            .unionByName(pages_store(spark, sf_dir)))


def type_catalog(store: DataFrame, request: DataFrame | None = None) -> DataFrame:
    """The distinct types of each (client, tenant) with their document counts.

    A partial (map-side) aggregate over the three key columns only: the scan reads no document text and
    the shuffle carries one row per type and task.  With a request only its (client, tenant) pairs are counted.
    """
    if request is not None:
        wanted = request.select("client", "tenant").distinct()
        small, rows = small_frame(store.sparkSession, wanted, "requested tenants")
        for c in ("client", "tenant"):
            store = store.where(among(c, rows))
        store = store.join(broadcast_if_small(small), ["client", "tenant"], "left_semi")
    return store.groupBy("client", "tenant", "type").agg(F.count(F.lit(1)).alias("n_docs"))


def index_catalog(catalog: DataFrame) -> DataFrame:
    """Index definitions of every type, derived from the type catalog by fixed rules.

    Covers the cases the index rules care about: the ``_id`` index (always), an empty key set, an
    ``_id``-plus-field compound, null options, compound keys whose order matters, and text indexes whose
    weights carry ``$all`` (even-numbered sources) or per-field weights (odd ones).
    """
    c = catalog.select("client", "tenant", "type")
    is_events = F.col("client") == "analytics"
    is_corpus = F.col("client") == "corpus"
    even_src = F.coalesce(F.expr("try_cast(substring(type, 4, 10) AS INT)") % 2 == 0, F.lit(False))

    def rows(pos, cond, keys, options):
        return c.where(cond).select("client", "tenant", "type", F.lit(pos).cast("int").alias("pos"),
                                    keys.alias("keys"), options.alias("options"))

    # The index definitions of the generated store.
    parts = [
        rows(0, F.lit(True), F.lit('{"_id":1}'), F.lit('{"name":"_id_"}')),
        rows(1, is_events, F.lit('{"user_id":1,"ts":-1}'), F.lit('{"name":"user_ts","unique":false}')),
        rows(1, is_corpus, F.lit('{"n_chars":1}'), F.lit(None).cast("string")),
        rows(2, is_corpus & even_src, F.lit('{"text":"text","lang":"text"}'),
             F.concat(F.lit('{"name":"text_idx","weights":{"$all":1},"default_language":"'), F.col("tenant"),
                      F.lit('"}'))),
        rows(2, is_corpus & ~even_src, F.lit('{"text":"text","lang":"text"}'),
             F.lit('{"name":"text_idx","weights":{"text":10,"lang":5}}')),
        rows(3, is_events & (F.col("type") == "error"), F.lit("{}"), F.lit('{"name":"empty"}')),
        rows(3, is_events & (F.col("type") == "purchase"), F.lit('{"_id":1,"user_id":1}'),
             F.lit('{"name":"id_user","sparse":null}')),
        rows(4, is_events & (F.col("type") == "view"), F.lit('{"_id":-1}'), F.lit(None).cast("string")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
