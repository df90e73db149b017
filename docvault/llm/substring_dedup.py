"""Substring dedup over a compacted de Bruijn graph of word k-mers.

Edges are the k-word windows of the documents (k = 20 words): two windows are the same edge when their words are.  The
vertex of a window is its *minimizer*, the m-word sequence in it with the least hash, so equal windows have the same
vertex at the same place; consecutive windows of a document with one minimizer form a path (a super-k-mer, as in
BCALM, Chikhi and others, 2016).

1. Map: the vertices of each document.  A join with the vertices found at least twice keeps the repeated ones; text that
   occurs once goes no further, and of a window only its vertex travels.
2. Map over the documents with their repeated vertices: the paths through them, each with its content hash, document
   and place (source coordinates), and the hashes of its edges.
3. Compaction by joins: equal paths are one; a path whose document is not its first is repeated as a whole, a vertex with a single path does
   not branch and is settled.  Only the first occurrences at branching vertices (several different paths) are
   opened into edges, which are joined with each edge's first document.
4. Source coordinates: overlapping and adjacent repeated windows of a document are merged into spans, and the words they
   cover are removed from the text.

A window is repeated when an equal one starts earlier: in a document with a smaller doc_id (nulls last), or earlier in the same
row.  Windows are judged on the input.  An edge is identified by the 64-bit hash of its words among the edges
of its vertex, itself a 64-bit hash of m of these words.

Scale: about one vertex per eight words is shuffled, narrow; frequent vertices and paths are pre-aggregated and
otherwise met in joins that Spark can split; lists are per document.  Shuffle files of finished steps are released.

Defined results: a null or empty text has no words; fewer than k words are kept; rows that share a doc_id (or have none)
are not earlier than each other; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import gc

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docvault.llm import wordhash
from docvault.llm.common import numbered, stage_table, table

WINDOW = 20
VERTEX = 6  # words of a vertex
GROUP_BYTES = 2_000_000  # of text handled at once
LAST = (1 << 63) - 1  # stands for a null doc_id


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of results that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


class Graph:
    """Words, windows, vertices and paths of a group of texts."""

    def __init__(self, raws: list[bytes], window: int, vertex: int):
        buf = np.frombuffer(b"\n".join([*raws, b""]), dtype=np.uint8)
        starts, ends = wordhash.runs((buf == 32) | ((buf >= 9) & (buf <= 13)))
        self.sums = wordhash.prefix(wordhash.of_ranges(wordhash.prefix(buf), starts, ends))
        after = np.searchsorted(starts, np.cumsum(np.array([len(r) + 1 for r in raws])))
        self.first = np.concatenate([[0], after[:-1]])  # of each text: its first word
        self.n_words = after - self.first
        n = np.maximum(self.n_words - window + 1, 0)
        self.doc = np.repeat(np.arange(len(raws)), n)  # of each window: its text
        self.start = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)  # and its first word there
        self.at = self.start + self.first[self.doc]
        self.window = window
        if not len(self.at):
            self.vertex = self.at
            return
        at = np.arange(len(starts) - vertex + 1)
        grams = wordhash.of_ranges(self.sums, at, at + vertex)
        view = np.lib.stride_tricks.sliding_window_view(grams, window - vertex + 1)
        least = np.empty(len(self.at), dtype=np.int64)
        for i in range(0, len(least), 1 << 16):
            least[i:i + (1 << 16)] = view[self.at[i:i + (1 << 16)]].argmin(axis=1)
        self.vertex = self.at + least  # of each window: the word its minimizer starts at
        self.vertex_hash = grams[self.vertex].astype(np.int64)

    def edges(self) -> np.ndarray:
        """Hash of each window."""
        return wordhash.of_ranges(self.sums, self.at, self.at + self.window).astype(np.int64)

    def paths(self, chosen: np.ndarray):
        """Index of the first window and number of windows of each path among the chosen windows (a mask)."""
        if not len(self.at):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        new = np.ones(len(self.at), dtype=bool)
        new[1:] = (self.vertex[1:] != self.vertex[:-1]) | (self.doc[1:] != self.doc[:-1])
        begin = np.flatnonzero(new)
        count = np.diff(np.append(begin, len(self.at)))
        keep = chosen[begin]
        return begin[keep], count[keep]


def _groups(batch):
    """Slices of an Arrow batch with about GROUP_BYTES of text, and their texts as bytes (null: empty)."""
    import pyarrow as pa

    raws = [r or b"" for r in batch.column("text").cast(pa.binary()).to_pylist()]
    at, size = 0, 0
    for i, r in enumerate(raws):
        size += len(r)
        if size >= GROUP_BYTES or i == len(raws) - 1:
            yield batch.slice(at, i + 1 - at), raws[at:i + 1]
            at, size = i + 1, 0


def _vertices(window: int, vertex: int):
    """(rid, vertex, n): the vertices of each text, ``n`` 2 when it has more than one occurrence there."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for part, raws in _groups(batch):
                g = Graph(raws, window, vertex)
                begin, _ = g.paths(np.ones(len(g.at), dtype=bool))
                if not len(begin):
                    continue
                found = np.stack([g.doc[begin], g.vertex_hash[begin]], axis=1)
                found, n = np.unique(found, axis=0, return_counts=True)
                rid = part.column("rid").to_numpy()[found[:, 0]]
                yield pa.RecordBatch.from_arrays([pa.array(rid), pa.array(found[:, 1]), pa.array(np.minimum(n, 2).astype(np.int32))],
                                                 names=["rid", "vertex", "n"])

    return run


PATHS = "rid long, doc long, vertex long, path long, start int, n int, own boolean, edges binary"


def _paths(window: int, vertex: int):
    """Paths through the repeated vertices.  ``own``: repeated in the row itself, not to be looked up."""

    def run(batches):
        import pyarrow as pa

        names = [c.split()[0] for c in PATHS.split(", ")]
        for batch in batches:
            for part, raws in _groups(batch):
                g = Graph(raws, window, vertex)
                if not len(g.at):
                    continue
                lists = part.column("vertices").to_pylist()
                wanted = np.unique(np.array([v for x in lists for v in x], dtype=np.int64))
                begin, count = g.paths(np.isin(g.vertex_hash, wanted))  # of another text of the group: harmless
                if not len(begin):
                    continue
                edges = g.edges()
                rid, doc = part.column("rid").to_numpy(), part.column("doc").to_numpy()
                # windows equal to an earlier one of the row are settled here
                inside = np.repeat(begin, count) + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
                _, first = np.unique(np.stack([g.doc[inside], edges[inside]], axis=1), axis=0, return_index=True)
                again = np.ones(len(inside), dtype=bool)
                again[first] = False
                mine = inside[again]
                if len(mine):
                    step = np.ones(len(mine), dtype=bool)
                    step[1:] = (np.diff(mine) != 1) | (np.diff(g.doc[mine]) != 0)
                    b = np.flatnonzero(step)
                    m = np.diff(np.append(b, len(mine)))
                    w = mine[b]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(rid[g.doc[w]]), pa.array(doc[g.doc[w]]), pa.array(np.zeros(len(w), np.int64)), pa.array(np.zeros(len(w), np.int64)),
                         pa.array(g.start[w].astype(np.int32)), pa.array(m.astype(np.int32)), pa.array(np.ones(len(w), bool)),
                         pa.nulls(len(w), pa.binary())], names=names)
                content = wordhash.of_ranges(g.sums, g.at[begin], g.at[begin] + count + window - 1)
                content = wordhash.mix(content, g.vertex[begin] - g.at[begin]).astype(np.int64)
                key = np.stack([g.doc[begin], g.vertex_hash[begin], content], axis=1)
                _, first = np.unique(key, axis=0, return_index=True)
                begin, count, content = begin[first], count[first], content[first]
                raw = edges.tobytes()
                blobs = [raw[8 * a:8 * (a + k)] for a, k in zip(begin.tolist(), count.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rid[g.doc[begin]]), pa.array(doc[g.doc[begin]]), pa.array(g.vertex_hash[begin]), pa.array(content),
                     pa.array(g.start[begin].astype(np.int32)), pa.array(count.astype(np.int32)), pa.array(np.zeros(len(begin), bool)),
                     pa.array(blobs, pa.binary())], names=names)

    return run


def _opened(batches):
    """Paths → one row per edge."""
    import pyarrow as pa

    for batch in batches:
        n = batch.column("n").to_numpy()
        r = np.repeat(np.arange(len(n)), n)
        step = np.arange(len(r)) - np.repeat(np.cumsum(n) - n, n)
        edges = np.frombuffer(b"".join(batch.column("edges").to_pylist()), dtype=np.int64)
        start = batch.column("start").to_numpy()[r] + step
        yield pa.RecordBatch.from_arrays(
            [pa.array(batch.column("rid").to_numpy()[r]), pa.array(batch.column("doc").to_numpy()[r]),
             pa.array(batch.column("vertex").to_numpy()[r]), pa.array(edges), pa.array(start.astype(np.int32))],
            names=["rid", "doc", "vertex", "edge", "start"])


def _removed(window: int):
    """Texts with their repeated windows → the digest of what is left."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            out = []
            for raw, spans in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("spans").to_pylist(), strict=True):
                words = (raw or b"").split()
                n = len(words)
                if spans:
                    covered = np.zeros(n + 1, dtype=np.int32)
                    s = np.array([x["start"] for x in spans])
                    np.add.at(covered, s, 1)
                    np.add.at(covered, s + np.array([x["n"] for x in spans]) + window - 1, -1)
                    kept = np.flatnonzero(np.cumsum(covered[:n]) == 0).tolist()
                    words = [words[i] for i in kept]
                out.append((n, n - len(words), b" ".join(words)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()),
                 pa.array([x[2] for x in out], pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])

    return run


def repeated_windows(rows: DataFrame, window: int = WINDOW, vertex: int = VERTEX) -> DataFrame:
    """``rid, doc, text`` (doc: LAST for none) → ``rid, start, n``: runs of windows that also start earlier."""
    spark = rows.sparkSession
    seen = stage_table(rows.select("rid", "text").mapInArrow(_vertices(window, vertex), "rid long, vertex long, n int"), "vertices")
    twice = stage_table(seen.groupBy("vertex").agg(F.sum("n").alias("n")).where("n > 1").select("vertex"), "repeated-vertices")
    release(spark)
    mine = seen.join(twice, "vertex", "left_semi").groupBy("rid").agg(F.collect_list("vertex").alias("vertices"))
    mine = stage_table(mine, "document-vertices")
    release(spark)
    found = rows.join(mine.hint("merge"), "rid").select("rid", "doc", "text", "vertices")
    paths = stage_table(found.mapInArrow(_paths(window, vertex), PATHS), "paths")
    release(spark)
    # compaction: equal paths are one, and a vertex branches when it has several
    narrow = paths.where("not own").select("rid", "doc", "vertex", "path", "start", "n")
    unique = stage_table(narrow.groupBy("vertex", "path").agg(F.min("doc").alias("source"), F.count("*").alias("times")), "unique-paths")
    many = stage_table(unique.groupBy("vertex").agg(F.count("*").alias("n_paths")).where("n_paths > 1").select("vertex"), "branching")
    repeats = unique.where("times > 1").select("vertex", "path", "source")
    whole = narrow.join(repeats, ["vertex", "path"]).where(F.col("doc") > F.col("source")).select("rid", "start", "n")
    branching = unique.join(many, "vertex", "left_semi").select("vertex", "path", "source")
    heads = (paths.where("not own").select("rid", "doc", "vertex", "path", "start", "n", "edges").join(branching, ["vertex", "path"])
             .where(F.col("doc") == F.col("source")).select("rid", "doc", "vertex", "start", "n", "edges"))
    edges = stage_table(heads.mapInArrow(_opened, "rid long, doc long, vertex long, edge long, start int"), "edges")
    least = edges.groupBy("vertex", "edge").agg(F.min("doc").alias("source"), F.count("*").alias("times")).where("times > 1")
    least = stage_table(least.select("vertex", "edge", "source"), "first-edges")
    single = edges.join(least, ["vertex", "edge"]).where(F.col("doc") > F.col("source")).select("rid", "start", F.lit(1).alias("n"))
    own = paths.where("own").select("rid", "start", "n")
    return whole.union(single).union(own)


def dedup(docs: DataFrame, window: int = WINDOW, vertex: int = VERTEX) -> DataFrame:
    """``doc_id, text`` → ``doc_id, n_words, n_removed, kept``: the kept words joined by one space."""
    rows = numbered(docs.select("doc_id", "text"), "rid").withColumn("doc", F.coalesce("doc_id", F.lit(LAST)))
    spans = repeated_windows(rows, window, vertex).groupBy("rid").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    spans = stage_table(spans, "spans")
    release(docs.sparkSession)
    out = rows.select("rid", "doc_id", "text").join(spans.hint("merge"), "rid", "left").select("doc_id", "text", "spans")
    return out.mapInArrow(_removed(window), "doc_id long, n_words long, n_removed long, kept string")


def query(spark, sf_dir):
    """op8: all documents, 20-word windows."""
    out = dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


SQL = None
