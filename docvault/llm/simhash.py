"""SimHash near-duplicates: a byte-position inverted index with count filtering.

Two 64-bit fingerprints within 3 bits differ in at most 3 of their 8 bytes, so they share at least 5 positional
bytes.  Posting lists of single (position, byte) pairs hold 1/256 of the table each, and tallying over them would
pair up nearly everything; the index therefore posts a fingerprint under *groups* of four positional bytes,
chosen so that every set of 5 positions contains a whole group (14 groups do, each an equal split of the
Steiner system on 8 points).  A pair that shares a posting has its shared positional bytes tallied, is retained
with at least 5, and then verified by bit distance, so no pair within the distance is missed.

Scale: equal fingerprints (copies) are one node.  A posting list emits a spanning forest of its verified pairs
instead of the pairs; a list beyond ``MAX_LIST`` fingerprints is dealt as pairs of chunks, so that a task holds
two chunks at most.  Components come from ``components``.

Defined results: a null or empty text has fingerprint 0 and links like any other; a null doc_id takes part, and
never names a component (a component of null ids alone has a null id); repeated rows link to each other; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import accumulate, combinations, repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docvault.llm.common import fresh, numbered, stage_table, table
from docvault.llm.components import components

MAX_LIST = 20_000
BLOCK_BYTES = 16_000_000  # of a distance block
GROUP_WORDS = 200_000  # shingles whose bits are counted at once


def fingerprint(shingle_hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes."""
    bits = np.unpackbits(shingle_hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return int(np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > len(bits), bitorder="little").view("<u8")[0])


def shingle_hashes(raw: bytes, n: int) -> list[int]:
    """XXH64 (seed 42) of the space-joined ``n``-word shingles of a UTF-8 text, A-Z lower-cased, repeats included;
    of the whole word sequence when it is shorter."""
    import xxhash

    words = raw.lower().split()
    if not words:
        return []
    if len(words) <= n:
        return [xxhash.xxh64_intdigest(b" ".join(words), 42)]
    joined = b" ".join(words)
    ends = [e - 1 for e in accumulate([len(w) + 1 for w in words])]
    starts = [0, *[e + 1 for e in ends[:-1]]]
    pieces = [joined[a:b] for a, b in zip(starts, ends[n - 1:])]
    return list(map(xxhash.xxh64_intdigest, pieces, repeat(42)))


def _fingerprints(n: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            out, group, sizes, held = [], [], [], 0

            def flush():
                if group:
                    flat = np.array(group, dtype="<u8")
                    bits = np.unpackbits(flat.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                full = [s for s in sizes if s]
                if full:
                    sums = np.add.reduceat(bits, np.cumsum([0, *full[:-1]]), axis=0, dtype=np.int32)
                    made = np.packbits(2 * sums > np.array(full)[:, None], axis=1, bitorder="little")
                    made = iter(made.reshape(-1).view("<i8").tolist())
                out.extend(next(made) if s else 0 for s in sizes)

            for raw in batch.column("text").cast(pa.binary()).to_pylist():
                hashes = shingle_hashes(raw or b"", n)
                group += hashes
                sizes.append(len(hashes))
                if len(group) >= GROUP_WORDS:
                    flush()
                    group, sizes = [], []
            flush()
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.int64())], names=["id", "fp"])

    return run


def byte_groups(max_distance: int, size: int = 4) -> list[tuple[int, ...]]:
    """Groups of byte positions such that any two fingerprints within ``max_distance`` bits agree on a whole group:
    every set of ``8 - max_distance`` positions contains one.  Greedy, most uncovered sets first."""
    shared = 8 - max_distance
    if shared < 1:
        raise ValueError("the distance must leave at least one shared byte")
    size = min(size, shared)
    wanted = set(combinations(range(8), shared))
    groups = []
    while wanted:
        best = max(combinations(range(8), size), key=lambda g: sum(set(g) <= set(w) for w in wanted))
        groups.append(best)
        wanted = {w for w in wanted if not set(best) <= set(w)}
    return groups


def _near(rows: np.ndarray, cols: np.ndarray, max_distance: int):
    """Index pairs within the distance: tally shared positional bytes, retain by count, verify by bits.  Unsigned, as numpy
    counts the bits of the absolute value of a signed number."""
    diff = rows.view("<u8")[:, None] ^ cols.view("<u8")[None, :]
    shared = (diff.view(np.uint8).reshape(*diff.shape, 8) == 0).sum(axis=2, dtype=np.uint8)
    i, j = np.nonzero(shared >= 8 - max_distance)
    ok = np.bitwise_count(diff[i, j]) <= max_distance
    return i[ok], j[ok]


def spanning_forest(fps: np.ndarray, max_distance: int) -> list[tuple[int, int]]:
    """Edges (other, smallest) that connect exactly what the pairs within the distance connect."""
    m = len(fps)
    label = np.arange(m)
    step = max(1, BLOCK_BYTES // (8 * m))
    for a in range(0, m, step):
        i, j = _near(fps[a:a + step], fps, max_distance)
        pairs = np.unique(np.stack([label[i + a], label[j]], axis=1), axis=0)
        pairs = pairs[pairs[:, 0] != pairs[:, 1]]
        if not len(pairs):
            continue
        parent = {}

        def find(x):
            while (p := parent.get(x, x)) != x:
                parent[x] = parent.get(p, p)
                x = p
            return x

        for x, y in pairs.tolist():
            x, y = find(x), find(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
        known = np.unique(label)
        root = np.array([find(x) for x in known.tolist()])
        label = root[np.searchsorted(known, label)]
    return [(int(fps[k]), int(fps[label[k]])) for k in range(m) if label[k] != k]


def _link_lists(max_distance: int):
    """Rows sorted by list key: (k, key, c, fp) → spanning edges of each list; a list is at most two chunks."""

    def run(batches):
        import pyarrow as pa

        now, held = None, []

        def link():
            if len(held) == 2:
                a, b = held
                d = a ^ b
                near = (sum(not (d >> s) & 255 for s in range(0, 64, 8)) >= 8 - max_distance
                        and (d & (2 ** 64 - 1)).bit_count() <= max_distance)
                return [(b, a)] if near else []
            return spanning_forest(np.array(sorted(set(held)), dtype="<i8"), max_distance) if len(held) > 2 else []

        def out(edges):
            u, v = zip(*edges, strict=True) if edges else ([], [])
            return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

        for batch in batches:
            edges = []
            for key in zip(*[batch.column(c).to_pylist() for c in ("k", "key", "c", "fp")], strict=True):
                if key[:3] != now:
                    edges += link()
                    now, held = key[:3], []
                held.append(key[3])
            yield out(edges)
        yield out(link())

    return run


def links(nodes: DataFrame, max_distance: int, max_list: int = MAX_LIST) -> DataFrame:
    """Distinct fingerprints ``fp`` → edges that connect those within ``max_distance`` bits."""
    masks = [sum(255 << (8 * p) for p in g) for g in byte_groups(max_distance)]
    masks = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = F.array(*[F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                     for k, m in enumerate(masks)])
    posts = nodes.select("fp", F.explode(keys).alias("p")).select("p.k", "p.key", "fp")
    sizes = posts.groupBy("k", "key").agg(F.count("*").alias("n"))
    large = stage_table(sizes.where(F.col("n") > max_list), "large-lists")
    schema = "u long, v long"
    zero = F.lit("0")
    if large.isEmpty():
        lists = posts.withColumn("c", zero)
    else:  # a long list: its chunks meet two by two
        chunks = F.ceil(F.col("n") / max_list).cast("int")
        split = posts.join(large, ["k", "key"], "left")
        own = F.pmod(F.xxhash64("fp"), chunks).cast("int")
        meets = F.transform(F.sequence(F.lit(0), chunks - 1),
                            lambda j: F.concat_ws("-", F.least(own, j).cast("string"), F.greatest(own, j).cast("string")))
        lists = split.select("k", "key", "fp", F.explode(F.when(F.col("n").isNull(), F.array(zero)).otherwise(meets)).alias("c"))
    lists = lists.repartition("k", "key", "c").sortWithinPartitions("k", "key", "c", "fp")
    return lists.select("k", "key", "c", "fp").mapInArrow(_link_lists(max_distance), schema)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3,
                    max_distance: int = 3, max_list: int = MAX_LIST) -> DataFrame:
    """``id, fp, component`` for every row: the fingerprint and the smallest id reachable over links."""
    ids = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text"))
    fps = stage_table(ids.mapInArrow(_fingerprints(shingle), "id long, fp long"), "fingerprints")
    nodes = stage_table(fps.groupBy("fp").agg(F.min("id").alias("least")), "fingerprint-nodes")
    roots = components(links(nodes, max_distance, max_list))
    named = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    whole = named.groupBy("root").agg(F.min("least").alias("component"))
    named = stage_table(named.select("fp", "root").join(whole, "root").select("fp", "component"), "fingerprint-components")
    return fps.join(named, "fp").select("id", "fp", "component")


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """One row of each near-duplicate group: the first by doc_id (nulls last); columns unchanged."""
    cols = docs.columns
    rid = fresh(cols, "_rid")
    rows = numbered(docs, rid)
    found = stage_table(near_duplicates(rows, rid, **options).select(F.col("id").alias("_sim_rid"), F.col("component").alias("_sim_root")), "groups")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col(rid)) if "doc_id" in cols else F.struct(F.col(rid))
    ids = rows.select(F.col(rid), order.alias("_sim_order"))
    first = (ids.join(found, F.col(rid) == F.col("_sim_rid")).groupBy("_sim_root")
             .agg(F.min_by("_sim_rid", "_sim_order").alias("_sim_first")).select("_sim_first"))
    first = first.hint("merge")  # grows with the documents
    return rows.join(first, F.col(rid) == F.col("_sim_first"), "left_semi").select(*[F.col(f"`{c}`") for c in cols])


def query(spark, sf_dir):
    """op3: all documents, 3-word shingles, at most 3 differing bits."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


SQL = None
