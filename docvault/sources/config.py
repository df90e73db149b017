"""S4 backup-request source and S5 manifest source.

Both are one JSON file, read whole and checked strictly: text that is not JSON, or JSON of another shape, is refused
with the place that is wrong.  Two failure kinds: a missing file (:class:`ConfigNotFound`) and a parse or shape
error (:class:`ConfigParseError`).  Index definitions inside a manifest stay JSON text with the order of their
members and the text of their numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docvault.functions.json import _dump, _load, _Num, _Obj
from docvault.model import MANIFEST_REQUIRED, MANIFEST_SCHEMA, REQUEST_SCHEMA, ConfigNotFound, ConfigParseError
from docvault.session import path_exists, read_text_file, small_frame


def _parsed(spark: SparkSession, path: str):
    if not path_exists(spark, path):
        raise ConfigNotFound(f"no such file: {path}")
    try:
        return _load(read_text_file(spark, path))
    except ValueError as e:
        raise ConfigParseError(f"{path} is not JSON: {e}") from None


def _text(path: str, where: str, v) -> str:
    if not isinstance(v, str) or isinstance(v, _Num):
        raise ConfigParseError(f"{path}: {where} must be a string")
    return v


def _list(path: str, where: str, v) -> list:
    if not isinstance(v, list) or isinstance(v, _Obj):
        raise ConfigParseError(f"{path}: {where} must be a list")
    return v


def _fields(path: str, where: str, v) -> dict:
    if not isinstance(v, _Obj):
        raise ConfigParseError(f"{path}: {where} must be an object")
    return dict(v)


def read_backup_config(spark: SparkSession, path: str, client: str, ord_offset: int = 0) -> DataFrame:
    """``{"tenants":[{"tenant":..., "types":[...]}]}`` → request rows ``(ord, client, tenant, types)``.

    ``types`` becomes a set (duplicates dropped); a missing, null or empty list means "all types".  Tenant rows keep
    their order and their duplicates.  Other members are ignored.
    """
    top = _fields(path, "the config", _parsed(spark, path))
    out = []
    for i, t in enumerate(_list(path, "tenants", top.get("tenants"))):
        row = _fields(path, f"tenant {i}", t)
        types = row.get("types")
        if types is not None:
            types = [_text(path, f"a type of tenant {i}", x) for x in _list(path, f"types of tenant {i}", types)]
        out.append((ord_offset + i, client, _text(path, f"name of tenant {i}", row.get("tenant")), types))
    return request_frame(spark, out)


def request_frame(spark: SparkSession, rows: list) -> DataFrame:
    """Request rows from Python tuples ``(ord, client, tenant, types)``; ``types`` de-duplicated."""
    df = spark.createDataFrame(rows, REQUEST_SCHEMA)
    return df.withColumn("types", F.array_distinct("types"))


def _element(path: str, i: int, v) -> tuple:
    row = _fields(path, f"element {i}", v)
    named = [_text(path, f"{f} of element {i}", row.get(f)) for f in MANIFEST_REQUIRED]
    n = row.get("n_docs")
    if n is not None and not (isinstance(n, _Num) and n.isdigit()):
        raise ConfigParseError(f"{path}: n_docs of element {i} must be a count")
    indexes = row.get("indexes")
    if indexes is not None:
        indexes = [_fields(path, f"an index of element {i}", x) for x in _list(path, f"indexes of element {i}", indexes)]
        indexes = [tuple(None if x.get(k) is None else _dump(x[k], nulls=True) for k in ("keys", "options")) for x in indexes]
    return (i, *named, None if n is None else int(n), indexes)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest (a JSON array) → ``(ord, client, tenant, type, file, n_docs, indexes)``.

    ``ord`` is the array position.  One row per dump; a longer manifest than a local relation should hold is kept as a
    written table (see ``session.small_frame``).
    """
    rows = [_element(path, i, v) for i, v in enumerate(_list(path, "the manifest", _parsed(spark, path)))]
    return small_frame(spark, spark.createDataFrame(rows, MANIFEST_SCHEMA), "manifest")[0]
