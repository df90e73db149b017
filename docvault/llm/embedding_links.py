"""Embedding near-duplicates with an inverted multi-index.

Vectors are scaled to unit length and cut in halves; each half has its own codebook (k-means on a bounded sample of
``FIT_ROWS`` rows) and the pair of nearest centroids is the vector's cell in the product grid.  Every vector is
indexed.  As a query it traverses cells in ascending order of a two-part distance, the sum over the halves of the
squared distance to the border of the neighbouring centroid's region, until the target recall is reached.

The stopping distance is measured.  ``QUERIES`` query vectors are compared with *all* rows in blocks, and a pair weighs one
over the pairs of its query, so a large group of near copies doesn't decide for the others; partners made at exactly the
cosine in random directions stand for the hardest links where the queries have few.  The greater of the two quantiles at the
target recall, times ``MARGIN``, stops the traversal.  The recall is then measured on as many other queries; under
``LOWEST`` the distance below which no pair can be missed is used, as with ``exact=True``.

A pair is found once: the vector with the smaller class id visits the other's cell.  What a visited cell holds is verified by
cosine in double precision.  Cells and their visitors are cut into chunks that meet two by two, so a dense cell is spread
over tasks and a task holds two chunks.  Of two chunks that meet only each vector's number of links and its least
connected vector go on, never the pairs.  Vectors travel in the type of the column (half the bytes for floats).

Equal vectors of one label are one class; links are between classes and counted with their copies.

Defined results: a vector that is null, empty, zero, or holds null or non-finite components, or whose label is null,
links with nothing; vectors of different length don't link; a null vec_id takes part and names no component (a
component of null ids alone has a null id); repeated rows link to each other; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docvault.llm.common import numbered, stage_table, table
from docvault.llm.components import components

COSINE = 0.93
FIT_ROWS = 20_000  # rows, at most, that the codebooks are fitted on (by hash of the row id)
QUERIES = 256  # query vectors, at most, for the stopping distance, and as many others for the recall
PARTNERS = 16  # made partners of each query vector
LOWEST = 0.95  # recall of the other queries under which the exact bound is used
TARGET = 0.999  # recall that the stopping distance aims at
MARGIN = 1.5  # times the measured stopping distance
CHUNK = 1024  # vectors of a cell (and of its visitors) that meet in one comparison
VECTOR = "cid long, grp long, n long, dim int, raw binary"
LINKED = "cid long, others long, root long"


def _valid(vector: list | None) -> bool:
    return bool(vector) and all(x is not None and np.isfinite(x) for x in vector) and any(vector)


def _raws(dtype: str):
    """Valid vectors as bytes of the column's own type; the others have dimension 0."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            vectors = [np.array(v, dtype=dtype) if _valid(v) else None for v in batch.column("embedding").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("cid", "grp", "n")], pa.array([0 if v is None else len(v) for v in vectors], pa.int32()),
                 pa.array([None if v is None else v.tobytes() for v in vectors], pa.binary())], names=["cid", "grp", "n", "dim", "raw"])

    return run


def units(raws: list[bytes], dim: int, dtype: str) -> np.ndarray:
    """Vectors of unit length in double precision; scaled by their largest component first, so no square overflows."""
    x = np.frombuffer(b"".join(raws), dtype=dtype).reshape(-1, dim).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True, initial=1e-320)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 3) -> np.ndarray:
    rng = np.random.RandomState(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = (((c * c).sum(1)) - 2 * (x @ c.T)).argmin(axis=1)
        for j in range(len(c)):
            if (near == j).any():
                c[j] = x[near == j].mean(axis=0)
    return np.unique(c, axis=0)


class Grid:
    """Two codebooks; cells, and border distances of vectors to the regions of each half."""

    def __init__(self, books: list[np.ndarray]):
        self.books = books
        self.cut = books[0].shape[1]

    def borders(self, x: np.ndarray) -> list[np.ndarray]:
        """Per half: squared distance of each vector to the region of each centroid (0 for the nearest one), bounded from
        below by the plane between that centroid and the nearest one."""
        out = []
        for book, part in zip(self.books, (x[:, :self.cut], x[:, self.cut:]), strict=True):
            d = (part * part).sum(1)[:, None] - 2 * part @ book.T + (book * book).sum(1)[None, :]
            near = d.argmin(axis=1)
            gap = np.sqrt(np.maximum(((book[near][:, None, :] - book[None, :, :]) ** 2).sum(2), 1e-300))
            h = np.maximum(d - d[np.arange(len(d)), near][:, None], 0) / (2 * gap)
            h[np.arange(len(d)), near] = 0
            out.append(h * h)
        return out

    def cells(self, x: np.ndarray) -> np.ndarray:
        a, b = self.borders(x)
        return a.argmin(axis=1) * len(self.books[1]) + b.argmin(axis=1)

    def visit(self, x: np.ndarray, reach: float):
        """Multi-sequence traversal: for each vector the cells with summed distance up to ``reach``, nearest first."""
        a, b = self.borders(x)
        order_a, order_b = np.argsort(a, axis=1), np.argsort(b, axis=1)
        for r in range(len(x)):
            da, db = a[r][order_a[r]], b[r][order_b[r]]
            n = np.searchsorted(db, reach - da[da <= reach], side="right")  # how far to go in the other half
            i = np.repeat(np.arange(len(n)), n)
            j = np.concatenate([np.arange(k) for k in n]) if len(n) else i
            rank = np.argsort(da[i] + db[j], kind="stable")
            yield order_a[r][i[rank]] * len(self.books[1]) + order_b[r][j[rank]]


def _sample(vectors: DataFrame, rows: int, salt: int) -> list:
    return vectors.orderBy(F.xxhash64("cid", F.lit(salt)), "cid").limit(rows).collect()


def fit(vectors: DataFrame, dim: int, dtype: str, n: int, rows: int = FIT_ROWS) -> Grid:
    """Codebooks of about ``n ** 0.25`` centroids (at most 256) from a sample of at most ``rows`` vectors."""
    x = units([bytes(r.raw) for r in _sample(vectors, rows, 0)], dim, dtype)
    k, cut = int(min(256, max(1, round(n ** 0.25)))), (dim + 1) // 2
    return Grid([kmeans(x[:, :cut], k), kmeans(x[:, cut:], k) if dim > cut else np.zeros((1, 0))])


def made_pair_distances(x: np.ndarray, grid: Grid, cosine: float, partners: int = PARTNERS, seed: int = 7) -> np.ndarray:
    """Traversal distances from each vector to the cells of partners at exactly the cosine, in random directions."""
    rng = np.random.RandomState(seed)
    x = np.repeat(x, partners, axis=0)
    away = rng.standard_normal(x.shape)
    away -= np.einsum("ij,ij->i", away, x)[:, None] * x
    away /= np.maximum(np.sqrt(np.einsum("ij,ij->i", away, away)), 1e-300)[:, None]
    y = cosine * x + np.sqrt(1 - cosine * cosine) * away
    (a, b), (ya, yb), r = grid.borders(x), grid.borders(y), np.arange(len(x))
    return a[r, ya.argmin(axis=1)] + b[r, yb.argmin(axis=1)]


def true_pair_distances(vectors: DataFrame, sample: list, grid: Grid, dim: int, dtype: str, cosine: float) -> DataFrame:
    """``query, need``: number of the query vector and traversal distance of each true pair (query vector, other vector), by
    comparing the queries with all rows in blocks; the visitor is the one with the smaller class id."""
    q = units([bytes(r.raw) for r in sample], dim, dtype)
    ids, groups = np.array([r.cid for r in sample]), np.array([r.grp for r in sample])

    def run(batches):
        import pyarrow as pa

        qa, qb = grid.borders(q)
        nearest = (qa.argmin(axis=1), qb.argmin(axis=1))
        for batch in batches:
            cid, grp = batch.column("cid").to_numpy(), batch.column("grp").to_numpy()
            raw = batch.column("raw").to_pylist()
            for at in range(0, len(raw), 4096):
                part = units(raw[at:at + 4096], dim, dtype)
                others = cid[at:at + 4096]
                i, j = np.nonzero((part @ q.T >= cosine) & (grp[at:at + 4096, None] == groups) & (others[:, None] != ids))
                if not len(i):
                    continue
                xa, xb = grid.borders(part[i])
                r = np.arange(len(i))
                there = qa[j, xa.argmin(axis=1)] + qb[j, xb.argmin(axis=1)]
                back = xa[r, nearest[0][j]] + xb[r, nearest[1][j]]
                need = np.where(ids[j] < others[i], there, back)
                yield pa.RecordBatch.from_arrays([pa.array(j, pa.int64()), pa.array(need, pa.float64())], names=["query", "need"])

    return vectors.mapInArrow(run, "query long, need double")


def stopping_distance(need: DataFrame, made: np.ndarray, cosine: float, target: float = TARGET, exact: bool = False) -> dict:
    """``query, need`` → the reach, from made partners and the queries of even number, with the recall of the odd ones there."""
    bound = 2 - 2 * cosine
    weighed = need.join(need.groupBy("query").agg((1 / F.count("*")).alias("w")), "query")
    # true pairs by their distance in steps of a thousandth of the bound: at most 1001 rows of weights for each half
    step = F.least(F.ceil(F.col("need") / bound * 1000), F.lit(1000)).cast("int")
    rows = weighed.groupBy((F.col("query") % 2).alias("odd"), step.alias("step")).agg(F.sum("w").alias("w"), F.count("*").alias("n")).collect()
    weight = np.zeros((2, 1001))
    for r in rows:
        weight[r.odd, r.step] += r.w
    reach = float(np.quantile(made, target)) if len(made) else 0.0
    if weight[0].any():
        share = np.cumsum(weight[0]) / weight[0].sum()
        reach = max(reach, float(np.searchsorted(share, target - 1e-12)) / 1000 * bound)
    reach = bound if exact else min(bound, MARGIN * reach)

    def recall():
        if not weight[1].any():
            return None
        return float(weight[1][:int(np.floor(reach / bound * 1000 + 1e-9)) + 1].sum() / weight[1].sum())

    found = recall()
    if found is not None and found < LOWEST:
        reach, found = bound, 1.0
    return {"reach": reach, "pairs": sum(r.n for r in rows), "recall": found}


def _places(grid: Grid, reach: float, dim: int, dtype: str, part):
    """For a batch: the row, cell and role (visitor or not) of every posting."""
    x = units(part.column("raw").to_pylist(), dim, dtype)
    visits = list(grid.visit(x, reach))
    row = np.concatenate([np.arange(len(x)), np.repeat(np.arange(len(x)), [len(v) for v in visits])])
    return row, np.concatenate([grid.cells(x), *visits]).astype(np.int64), np.arange(len(row)) >= len(x)


def _slices(batches, rows: int = 1024):
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _sizes(grid: Grid, reach: float, dim: int, dtype: str):
    """Members and visitors of the cells, counted per slice."""

    def run(batches):
        import pyarrow as pa

        for part in _slices(batches):
            row, cell, visitor = _places(grid, reach, dim, dtype, part)
            keys, at = np.unique(np.stack([part.column("grp").to_numpy()[row], cell]), axis=1, return_inverse=True)
            at = at.reshape(-1)
            counts = [np.bincount(at[m], minlength=keys.shape[1]) for m in (~visitor, visitor)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (*keys, *counts)], names=["grp", "cell", "nm", "nv"])

    return run


def _postings(grid: Grid, reach: float, dim: int, dtype: str):
    """Each vector as a member of its cell and as a visitor of the cells it traverses."""

    def run(batches):
        import pyarrow as pa

        for part in _slices(batches):
            row, cell, visitor = _places(grid, reach, dim, dtype, part)
            for at in range(0, len(row), 1 << 14):
                cut = slice(at, at + (1 << 14))
                rows = part.select(["cid", "grp", "n", "raw"]).take(pa.array(row[cut]))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(cell[cut]), pa.array(visitor[cut])],
                                                 names=["cid", "grp", "n", "raw", "cell", "visitor"])

    return run


def _roots(nodes: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least node that each node of the edges reaches."""
    root = np.arange(nodes)
    while True:
        new = root.copy()
        low = np.minimum(root[i], root[j])
        for k in (root[i], root[j], i, j):
            np.minimum.at(new, k, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _verify(cosine: float, dim: int, dtype: str):
    """Sorted rows of one (group, cell, member chunk, visitor chunk), members first → per linked vector the number of vectors
    that it links with among these (copies counted) and the least one that it is connected with."""

    def compare(members, visitors):
        a, b = (np.array([r[0] for r in s]) for s in (members, visitors))
        x, y = (units([r[1] for r in s], dim, dtype) for s in (members, visitors))
        near = x @ y.T >= cosine - 1e-9
        i, j = np.nonzero(near & (b[None, :] < a[:, None]))
        close = np.concatenate([np.einsum("ij,ij->i", x[i[k:k + 65536]], y[j[k:k + 65536]]) for k in range(0, len(i), 65536)] or [np.zeros(0)])
        i, j = i[close >= cosine], j[close >= cosine]
        ids, at = np.unique(np.concatenate([a[i], b[j]]), return_inverse=True)
        u, v = at[:len(i)], at[len(i):]
        n, m = (np.array([r[2] for r in s], dtype=np.int64) for s in (members, visitors))
        others = np.zeros(len(ids), np.int64)
        np.add.at(others, u, m[j])
        np.add.at(others, v, n[i])
        return ids, others, ids[_roots(len(ids), u, v)] if len(ids) else ids

    def run(batches):
        import pyarrow as pa

        names = ["cid", "others", "root"]
        now, members, visitors = None, [], []

        def out():
            if not members or not visitors:
                return []
            return [pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in compare(members, visitors)], names=names)]

        for batch in batches:
            for *key, cid, raw, n, visitor in zip(*[batch.column(c).to_pylist() for c in ("grp", "cell", "mc", "vc", "cid", "raw", "n", "visitor")],
                                                  strict=True):
                if key != now:
                    yield from out()
                    now, members, visitors = key, [], []
                (visitors if visitor else members).append((cid, raw, n))
        yield from out()

    return run


def links(vectors: DataFrame, grid: Grid, reach: float, dim: int, dtype: str, cosine: float, chunk: int = CHUNK) -> DataFrame:
    """``cid, others, root``, some rows per linked class: vectors of other classes that it links with, to be added up, and a class
    it is connected with."""
    sizes = vectors.mapInArrow(_sizes(grid, reach, dim, dtype), "grp long, cell long, nm long, nv long").groupBy("grp", "cell").agg(
        *[F.ceil(F.sum(c) / chunk).cast("int").alias(c) for c in ("nm", "nv")])
    sizes = stage_table(sizes.where("nm > 0 and nv > 0"), "cells")
    posts = vectors.mapInArrow(_postings(grid, reach, dim, dtype), "cid long, grp long, n long, raw binary, cell long, visitor boolean")
    p = posts.join(sizes, ["grp", "cell"])
    own = F.pmod(F.xxhash64("cid"), F.when(F.col("visitor"), F.col("nv")).otherwise(F.col("nm"))).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.when(F.col("visitor"), F.col("nm")).otherwise(F.col("nv")) - 1))
    p = p.select("grp", "cell", "cid", "n", "raw", "visitor", own.alias("own"), other.alias("other"))
    p = p.withColumn("mc", F.when(F.col("visitor"), F.col("other")).otherwise(F.col("own")))
    p = p.withColumn("vc", F.when(F.col("visitor"), F.col("own")).otherwise(F.col("other")))
    p = p.repartition("grp", "cell", "mc", "vc").sortWithinPartitions("grp", "cell", "mc", "vc", "visitor")
    return p.select("grp", "cell", "mc", "vc", "visitor", "cid", "raw", "n").mapInArrow(_verify(cosine, dim, dtype), LINKED)


def near_duplicates(rows: DataFrame, cosine: float = COSINE, target: float = TARGET, fit_rows: int = FIT_ROWS,
                    queries: int = QUERIES, chunk: int = CHUNK, exact: bool = False) -> tuple[DataFrame, dict]:
    """``vec_id, embedding, label`` → per row ``vec_id, n_links, component_id, kept``; and what was measured: per vector
    length the cells, the reach, the mean number of cells a query vector visits, and the recall over other query vectors
    against all rows.  ``exact`` visits every cell that can hold a link."""
    spark = rows.sparkSession
    dtype = "<f4" if rows.schema["embedding"].dataType.elementType.typeName() == "float" else "<f8"
    rows = numbered(rows.select("vec_id", "embedding", "label"), "rid")
    rows = rows.withColumn("h", F.when(F.col("label").isNotNull() & F.col("embedding").isNotNull(), F.xxhash64("label", "embedding")))
    classes = (rows.where("h is not null").groupBy("h", "label", "embedding")
               .agg(F.min("rid").alias("cid"), F.min("vec_id").alias("least"), F.count("*").alias("n")))
    classes = stage_table(classes, "vector-classes")
    grp = F.xxhash64("label")
    vectors = stage_table(classes.select("cid", grp.alias("grp"), "n", "embedding").mapInArrow(_raws(dtype), VECTOR).where("dim > 0"), "vectors")
    found, report = [], {}
    dims = vectors.groupBy("dim").count().collect()  # one row per vector length
    for dim, n in sorted((r["dim"], r["count"]) for r in dims):
        part = vectors.where(F.col("dim") == dim)
        grid = fit(part, dim, dtype, n, fit_rows)
        sample = _sample(part, 2 * queries, 1)
        need = stage_table(true_pair_distances(part, sample, grid, dim, dtype, cosine), "need")
        x = units([bytes(r.raw) for r in sample], dim, dtype)
        stop = stopping_distance(need, made_pair_distances(x[::2], grid, cosine), cosine, target, exact)
        visited = float(np.mean([len(v) for v in grid.visit(x, stop["reach"])]))
        report[dim] = {"vectors": n, "cells": len(grid.books[0]) * len(grid.books[1]), "visited": visited, **stop}
        found.append(links(part, grid, stop["reach"], dim, dtype, cosine, chunk))
    near = spark.createDataFrame([], LINKED)
    for f in found:
        near = near.union(f)
    near = stage_table(near, "vector-links")
    linked = near.groupBy("cid").agg(F.sum("others").alias("others"))
    roots = components(near.select(F.col("cid").alias("u"), F.col("root").alias("v"))).withColumnRenamed("node", "cid")
    valid = vectors.select("cid", F.lit(True).alias("valid"))
    c = (classes.select("h", "label", "embedding", "cid", "least", "n").join(valid, "cid", "left").join(linked, "cid", "left")
         .join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid")))
    names = c.groupBy("root").agg(F.min("least").alias("component"))
    c = stage_table(c.join(names, "root").where("valid").select(
        "h", "label", "embedding", (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component"), "vector-components")
    out = rows.join(c, ["h", "label", "embedding"], "left")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.col("vec_id").eqNullSafe(component).alias("kept")), report


def query(spark, sf_dir):
    """op4: all vectors, cosine at least 0.93 within a label."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))[0]


SQL = r"""
WITH RECURSIVE d AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
u AS (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS n FROM d
      WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) = len(list_filter(e, lambda x: x IS NOT NULL AND isfinite(x)))
        AND len(e) > 0 AND list_dot_product(e, e) > 0),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b
      ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      AND list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.93),
r(a, b) AS (SELECT a, b FROM p UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a),
c AS (SELECT a, least(a, min(b)) AS m FROM r GROUP BY a),
k AS (SELECT a, count(*) AS n FROM p GROUP BY a)
SELECT vec_id, CAST(coalesce(k.n, 0) AS BIGINT) AS n_links, coalesce(c.m, vec_id) AS component_id,
       coalesce(c.m, vec_id) = vec_id AS kept
FROM d LEFT JOIN c ON c.a = vec_id LEFT JOIN k ON k.a = vec_id
"""
