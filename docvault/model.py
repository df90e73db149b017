"""Schemas of the data model and the two failure kinds of config/manifest reading."""

from __future__ import annotations

from pyspark.sql import types as T

# A stored document: the 3-part type key, the document id as JSON text of its ``_id`` value, raw text.
STORE_SCHEMA = T.StructType([
    T.StructField("client", T.StringType(), False),
    T.StructField("tenant", T.StringType(), False),
    T.StructField("type", T.StringType(), False),
    T.StructField("id", T.StringType(), True),
    T.StructField("doc", T.StringType(), True),
])

# One backup request row: a (client, tenant) and the requested types (NULL or [] = all).
REQUEST_SCHEMA = T.StructType([
    T.StructField("ord", T.IntegerType(), False),
    T.StructField("client", T.StringType(), False),
    T.StructField("tenant", T.StringType(), False),
    T.StructField("types", T.ArrayType(T.StringType()), True),
])

# Index metadata of the store: keys/options are raw JSON text (key order of compound keys matters).
INDEX_SCHEMA = T.StructType([
    T.StructField("client", T.StringType(), False),
    T.StructField("tenant", T.StringType(), False),
    T.StructField("type", T.StringType(), False),
    T.StructField("pos", T.IntegerType(), False),
    T.StructField("keys", T.StringType(), True),
    T.StructField("options", T.StringType(), True),
])

INDEX_DEF = T.StructType([
    T.StructField("keys", T.StringType(), True),
    T.StructField("options", T.StringType(), True),
])

# One manifest element as it is read from backup.json (n_docs is our own optional field).
MANIFEST_ELEMENT = T.StructType([
    T.StructField("client", T.StringType(), True),
    T.StructField("tenant", T.StringType(), True),
    T.StructField("type", T.StringType(), True),
    T.StructField("file", T.StringType(), True),
    T.StructField("n_docs", T.LongType(), True),
    T.StructField("indexes", T.ArrayType(INDEX_DEF), True),
])
MANIFEST_SCHEMA = T.StructType([T.StructField("ord", T.IntegerType(), True), *MANIFEST_ELEMENT.fields])
MANIFEST_REQUIRED = ("client", "tenant", "type", "file")

TOTALS_SCHEMA = T.StructType([
    T.StructField("ord", T.IntegerType(), False),
    T.StructField("client", T.StringType(), False),
    T.StructField("tenant", T.StringType(), False),
    T.StructField("type", T.StringType(), False),
    T.StructField("total", T.LongType(), False),
    T.StructField("inserted", T.LongType(), False),
    T.StructField("replaced", T.LongType(), False),
])

# Fixed value: documents per insert request of a restore (the reference's default).
DOCUMENTS_PER_REQUEST = 1000
# Fixed value: largest framed object in bytes.
MAX_OBJECT_BYTES = 16_777_216
# Fixed value: file name of the manifest inside a run directory.
MANIFEST_NAME = "backup.json"
# Sub-directories of a run directory, one per dump format.
DUMPS_DIR = "dumps"
JSONL_DIR = "jsonl"
ARRAYS_DIR = "arrays"
# Fixed value: the columns of Spark's binary file source.
BINARY_COLUMNS = "path string, modificationTime timestamp, length long, content binary"


class ConfigNotFound(Exception):
    """Config or manifest file is missing."""


class ConfigParseError(Exception):
    """Config or manifest is not JSON or does not have the required shape."""


class RestoreError(Exception):
    """A restore cannot proceed (e.g. a dump named by the manifest is missing)."""


class ConflictError(RestoreError):
    """Another job changed the same thing since this one read it; nothing was published."""
