"""Numbered snapshots of small tables: immutable parquet directories ``v<number>``; the highest committed one is current.

A writer claims the next number, writes the snapshot and commits the number.  Claim and commit each are a small file that
only one writer can create (``_commit/v<number>.claim`` and ``.done``), so of writers that run at the same time each gets
its own number, and a number that stays open is decided once: committed by its writer, or abandoned by a later writer
that waited for it in vain, which the first then learns when it tries to commit.  A snapshot is made from the current one
(:func:`commit`), and is committed only if no other was committed in between; otherwise it is made again from the newer
one, so no change is lost.  There is no pointer to replace and no moment without a current snapshot: a job that is lost
while writing leaves the previous one current.  A snapshot without ``_SUCCESS``, which Spark writes last, never counts.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from docvault.session import list_names, local_frame, path_exists, put_new, read_text_file

_NAME = re.compile(r"v(\d{8})")
_FILE = re.compile(r"v(\d{8})\.(claim|done)")
COMMITTED, ABANDONED = "committed", "abandoned"
PATIENCE = 300.0  # seconds that a claimed number may stay open; writing a small table takes a few


def _decisions(root: str) -> str:
    return f"{root.rstrip('/')}/_commit"


def _state(spark: SparkSession, root: str) -> tuple[list[int], set[int], set[int]]:
    """``(snapshot directories, claimed numbers, decided numbers)``."""
    dirs = sorted(int(m[1]) for n, is_dir in list_names(spark, root) if is_dir and (m := _NAME.fullmatch(n)))
    files = [m for n, _ in list_names(spark, _decisions(root)) if (m := _FILE.fullmatch(n))]
    return dirs, {int(m[1]) for m in files if m[2] == "claim"}, {int(m[1]) for m in files if m[2] == "done"}


def numbers(spark: SparkSession, root: str) -> list[int]:
    """Numbers of all snapshot directories, complete or not, ascending."""
    return _state(spark, root)[0]


def directory(root: str, number: int) -> str:
    return f"{root.rstrip('/')}/v{number:08d}"


def _decision(spark: SparkSession, root: str, number: int) -> str:
    return read_text_file(spark, f"{_decisions(root)}/v{number:08d}.done")


def current(spark: SparkSession, root: str) -> int | None:
    """Number of the current snapshot."""
    return next(iter(committed(spark, root)), None)


def committed(spark: SparkSession, root: str):
    """Numbers of the committed snapshots, newest first."""
    dirs, claimed, decided = _state(spark, root)
    for n in reversed(dirs):
        if n in claimed and (n not in decided or _decision(spark, root, n) != COMMITTED):
            continue
        if path_exists(spark, f"{directory(root, n)}/_SUCCESS"):
            yield n


def read_number(spark: SparkSession, root: str, number: int | None, schema: T.StructType) -> DataFrame:
    """A snapshot by its number; None: an empty frame of ``schema``."""
    if number is None:
        return local_frame(spark, [], schema)
    return spark.read.schema(schema).parquet(directory(root, number))


def read_snapshot(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The current snapshot, or an empty frame of ``schema`` when nothing was published yet."""
    return read_number(spark, root, current(spark, root), schema)


def _settle(spark: SparkSession, root: str, above: int, below: int, patience: float) -> None:
    """Wait until every claimed number between the two is decided; abandon what stays open."""
    end = time.monotonic() + patience
    while True:
        _, claimed, decided = _state(spark, root)
        still = sorted(n for n in claimed - decided if above < n < below)
        if not still:
            return
        if time.monotonic() >= end:
            for n in still:
                put_new(spark, f"{_decisions(root)}/v{n:08d}.done", ABANDONED)
            return
        time.sleep(0.2)


def commit(spark: SparkSession, root: str, schema: T.StructType, change: Callable[[DataFrame], DataFrame | None],
           patience: float = PATIENCE) -> int | None:
    """Make the next snapshot from the current one; returns its number.

    ``change`` gets the current snapshot and returns the next one (None: there is nothing to change).  It runs again
    when another writer was first, and may raise :class:`docvault.model.ConflictError` when both cannot be."""
    while True:
        base = current(spark, root)
        new = change(read_number(spark, root, base, schema))
        if new is None:
            return None
        dirs, claimed, _ = _state(spark, root)
        n = max([*dirs, *claimed], default=0) + 1
        if not put_new(spark, f"{_decisions(root)}/v{n:08d}.claim", uuid.uuid4().hex):
            continue
        # writers of higher numbers wait for this one; when the lower ones are decided, the base is or isn't the newest
        _settle(spark, root, base or 0, n, patience)
        if current(spark, root) != base:
            put_new(spark, f"{_decisions(root)}/v{n:08d}.done", ABANDONED)
            continue
        new.write.mode("errorifexists").parquet(directory(root, n))
        if put_new(spark, f"{_decisions(root)}/v{n:08d}.done", COMMITTED):
            return n


def publish(spark: SparkSession, root: str, df: DataFrame) -> int:
    """Write ``df`` as the next snapshot, whatever the current one holds.  Returns its number."""
    return commit(spark, root, df.schema, lambda _: df)
