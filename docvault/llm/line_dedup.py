"""Line dedup by pairwise alignment: documents that share rare lines are aligned with patience diff, and the aligned
common blocks are deleted from the later document.

1. Documents with the same lines are one class; all but the first of a class are aligned with it as a whole.
2. Lines (trimmed, not blank) are hashed; of the lines that at least two classes hold, a *rare* one (at most
   ``RARE`` classes) pairs up all its documents.  Whatever the frequency, each shortest run of consecutive lines that
   reaches ``MIN_CHARS`` (from each first line on, and back from each last line) pairs a later document with the earliest
   that holds the run.  A block common to two documents is made of such runs, so each of its lines has a partner,
   and the pairs grow with the lines, never with the square of a group.
3. Each pair is aligned over its shared lines: common ends, then lines that occur once in both (longest increasing
   run), recursively, then repeated lines by their count.  Runs of aligned lines that follow each other in both
   documents, with at least ``MIN_CHARS`` characters, are deleted from the later document.  A block that stands in
   another order than in all its partners is not aligned, as in any diff.

"Later" is by doc_id (nulls last), then row.  Scale: only hashes and lengths of shared lines travel to the pairs;
a frequent line or a first document with many partners is a join key that Spark splits; the texts are joined once
with the line numbers to delete.

Defined results: a null text stays null and has no lines; an empty or blank text stays as it is; blank lines are
never matched nor deleted; repeated rows are copies; an empty table gives no rows; extra columns are kept
by ``dedup``.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docvault.llm.common import SEPARATORS, fresh, numbered, stage_table, table

RARE = 4
MIN_CHARS = 30


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence of pairs (sorted by the first) that also rises in the second."""
    tails, ends, back = [], [], []
    for k, (_, b) in enumerate(pairs):
        d = bisect_left(tails, b)
        back.append(ends[d - 1] if d else -1)
        if d == len(tails):
            tails.append(b)
            ends.append(k)
        else:
            tails[d], ends[d] = b, k
    out, k = [], ends[-1] if ends else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Matched index pairs of two sequences, rising in both."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        i, j, k, m = todo.pop()
        while i < j and k < m and a[i] == b[k]:
            out.append((i, k))
            i, k = i + 1, k + 1
        while i < j and k < m and a[j - 1] == b[m - 1]:
            j, m = j - 1, m - 1
            out.append((j, m))
        if i == j or k == m:
            continue
        ca, cb = Counter(a[i:j]), Counter(b[k:m])
        at = {x: p for p, x in enumerate(b[k:m], k) if cb[x] == 1}
        anchors = _increasing([(p, at[x]) for p, x in enumerate(a[i:j], i) if ca[x] == 1 and x in at])
        if not anchors:  # only repeated lines are common: the n-th of one meets the n-th of the other
            seen, place = Counter(), {}
            for p in range(k, m):
                place[b[p], seen[b[p]]] = p
                seen[b[p]] += 1
            seen, pairs = Counter(), []
            for p in range(i, j):
                key = (a[p], seen[a[p]])
                seen[a[p]] += 1
                if key in place:
                    pairs.append((p, place[key]))
            out += _increasing(pairs)
            continue
        for p, q in anchors:
            out.append((p, q))
        for (p, q), (r, s) in zip([(i - 1, k - 1), *anchors], [*anchors, (j, m)], strict=True):
            todo.append((p + 1, r, q + 1, s))
    return sorted(out)


def blocks(a: list, b: list, at_a: list[int], at_b: list[int], chars: list[int], min_chars: int) -> list[int]:
    """Line numbers of ``a`` (the later document) in aligned blocks of at least ``min_chars``; ``at_a``, ``at_b`` are
    the places of the shared lines among all lines that aren't blank."""
    out, run = [], []

    def close():
        if sum(chars[p] for p, _ in run) >= min_chars:
            out.extend(p for p, _ in run)

    for p, q in patience(a, b):
        if run and not (at_a[p] == at_a[run[-1][0]] + 1 and at_b[q] == at_b[run[-1][1]] + 1):
            close()
            run.clear()
        run.append((p, q))
    close()
    return out


def runs(places, chars, min_chars: int, documents=(0,)):
    """The shortest runs ``[first, end)`` of lines in consecutive places that reach ``min_chars``, from each first line on and
    back from each last line: every line of a block that reaches it stands in one of them.  ``documents`` are the
    indexes at which documents begin."""
    import numpy as np

    places, n, need = np.asarray(places, np.int64), len(places), max(min_chars, 1)
    if not n:
        return np.empty((0, 2), np.int64)
    new = np.ones(n, bool)
    new[1:] = places[1:] != places[:-1] + 1
    new[[d for d in documents if d < n]] = True
    begins = np.flatnonzero(new)
    piece = np.cumsum(new) - 1
    stops = np.append(begins[1:], n)
    sums = np.concatenate([[0], np.cumsum(np.asarray(chars, np.int64))])
    at = np.arange(n)
    end = np.searchsorted(sums, sums[:-1] + need)
    first = np.searchsorted(sums, sums[1:] - need, "right") - 1
    on, back = end <= stops[piece], first >= begins[piece]
    pairs = np.concatenate([np.stack([at[on], end[on]], 1), np.stack([first[back], at[back] + 1], 1)])
    return np.unique(pairs, axis=0)


def _runs(min_chars: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        import xxhash

        for batch in batches:
            lines = batch.column("lines")
            flat, ends = lines.flatten(), np.cumsum([0, *lines.value_lengths().to_pylist()])
            hashes = flat.field("hash").to_numpy(zero_copy_only=False).astype("<i8")
            found = runs(flat.field("place").to_numpy(zero_copy_only=False), flat.field("chars").to_numpy(zero_copy_only=False), min_chars, ends[:-1])
            keys, raw = hashes[found[:, 0]], hashes.tobytes()  # a run of one line is named by the line
            for k in np.flatnonzero(found[:, 1] - found[:, 0] > 1).tolist():
                i, j = found[k].tolist()
                h = xxhash.xxh64_intdigest(raw[8 * i:8 * j])
                keys[k] = h - (1 << 64) if h >> 63 else h
            row = np.searchsorted(ends, found[:, 0], "right") - 1
            yield pa.RecordBatch.from_arrays([batch.column("rid").take(pa.array(row)), batch.column("doc").take(pa.array(row)),
                                              pa.array(keys, pa.int64())], names=["rid", "doc", "run"])

    return run


def _align(min_chars: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            ids, gone = [], []
            cols = [batch.column(c).to_pylist() for c in ("later", "lines", "other_lines")]
            for rid, mine, theirs in zip(*cols, strict=True):
                found = blocks([x["hash"] for x in mine], [x["hash"] for x in theirs], [x["place"] for x in mine],
                               [x["place"] for x in theirs], [x["chars"] for x in mine], min_chars)
                if found:
                    ids.append(rid)
                    gone.append([mine[p]["line"] for p in found])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(gone, pa.list_(pa.int32()))], names=["rid", "gone"])

    return run


def deletions(rows: DataFrame, rid: str = "_rid", doc_id: str = "doc_id", text: str = "text", rare: int = RARE,
              min_chars: int = MIN_CHARS) -> DataFrame:
    """``rid, gone``: the numbers (from 0) of the lines to delete, for each row that loses any."""
    trimmed = F.transform(F.split(F.col(text), "\n", -1), lambda x: F.btrim(x, F.lit(SEPARATORS)))
    numbers = F.filter(F.transform("_all", lambda x, i: F.struct(
        i.alias("line"), F.xxhash64(x).alias("hash"), F.char_length(x).alias("chars"))), lambda s: s["chars"] > 0)
    lines = rows.where(F.col(text).isNotNull()).select(F.col(rid).alias("rid"), F.col(doc_id).alias("doc"), trimmed.alias("_all"))
    lines = lines.select("rid", "doc", numbers.alias("_lines"))
    placed = F.transform("_lines", lambda s, i: F.struct(s["line"].alias("line"), i.alias("place"), s["hash"].alias("hash"), s["chars"].alias("chars")))
    total = F.aggregate("_lines", F.lit(0).cast("long"), lambda a, s: a + s["chars"])
    hashes = F.transform("_lines", lambda s: s["hash"])
    lines = lines.where(F.size("_lines") > 0).select("rid", "doc", placed.alias("lines"), F.xxhash64(hashes).alias("all_hash"),
                                                    total.alias("total"), F.hash(hashes).alias("all_hash2"))
    lines = stage_table(lines, "lines")
    order = F.struct(F.col("doc").isNull().alias("x"), F.col("doc").alias("d"), F.col("rid").alias("r"))
    key = ["all_hash", "all_hash2", "total"]

    # copies of a whole document
    first = stage_table(lines.groupBy(*key).agg(F.min_by("rid", order).alias("first"), F.count("*").alias("n")), "line-classes")
    copies = (lines.join(first.where("n > 1"), key).where((F.col("rid") != F.col("first")) & (F.col("total") >= min_chars))
              .select("rid", F.transform("lines", lambda s: s["line"]).alias("gone")))

    # shared lines of the classes
    reps = lines.join(first.select(F.col("first").alias("rid")), "rid", "left_semi")
    occ = reps.select("rid", "doc", F.explode("lines").alias("s")).select("rid", "doc", "s.hash", "s.line", "s.place", "s.chars")
    per_doc = occ.select("hash", "rid", "doc").distinct()
    shared = per_doc.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1")
    shared = stage_table(shared, "shared-lines")
    occ = stage_table(occ.join(shared, "hash"), "line-places")
    seqs = occ.groupBy("rid", "doc").agg(F.array_sort(F.collect_list(F.struct("place", "line", "hash", "chars"))).alias("lines"))
    seqs = stage_table(seqs, "line-sequences")
    typed = f"rid long, doc {seqs.schema['doc'].dataType.simpleString()}, run long"
    held = stage_table(seqs.mapInArrow(_runs(min_chars), typed), "line-runs")
    seqs = seqs.drop("doc")
    holders = held.groupBy("run").agg(F.count("*").alias("n"), F.min(order).alias("o")).where("n > 1")
    holders = stage_table(holders.select("run", F.col("o")["r"].alias("earlier")), "run-holders")
    star = held.join(holders, "run").where("rid <> earlier").select(F.col("rid").alias("later"), "earlier")
    few = occ.where(F.col("n") <= rare).groupBy("hash").agg(F.array_sort(F.collect_set(order)).alias("g"))
    among = F.flatten(F.transform("g", lambda b, j: F.transform(
        F.slice(F.col("g"), F.lit(1), j), lambda a: F.struct(b["r"].alias("later"), a["r"].alias("earlier")))))
    pairs = stage_table(star.union(few.select(F.explode(among).alias("p")).select("p.later", "p.earlier")).distinct(), "line-pairs")

    met = pairs.join(seqs.select(F.col("rid").alias("earlier"), F.col("lines").alias("other_lines")), "earlier")
    met = stage_table(met, "line-partners").join(seqs.withColumnRenamed("rid", "later"), "later")
    found = met.select("later", "lines", "other_lines").mapInArrow(_align(min_chars), "rid long, gone array<int>")
    return found.union(copies).groupBy("rid").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("gone")))).alias("gone"))


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rare: int = RARE, min_chars: int = MIN_CHARS,
          counts: bool = False) -> DataFrame:
    """``docs`` with the aligned blocks deleted from ``text``; with ``counts`` also ``n_lines`` and ``n_removed``."""
    cols = docs.columns
    rid = fresh(cols, "_rid")
    rows = numbered(docs, rid)
    gone = stage_table(deletions(rows, rid, doc_id, text, rare, min_chars), "line-deletions")
    gone = gone.select(F.col("rid").alias("_line_rid"), F.col("gone").alias("_line_gone")).hint("merge")  # grows with the documents
    out = rows.join(gone, F.col(rid) == F.col("_line_rid"), "left")
    lines = F.split(F.col(text), "\n", -1)
    kept = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains(F.col("_line_gone"), i)), "\n")
    out = out.withColumn("_line_kept", F.when(F.col("_line_gone").isNull(), F.col(text)).otherwise(kept))
    picked = [F.col("_line_kept").alias(c) if c == text else F.col(f"`{c}`") for c in cols]
    if counts:
        picked += [F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
                   F.coalesce(F.size("_line_gone"), F.lit(0)).cast("long").alias("n_removed")]
    return out.select(*picked)


def query(spark, sf_dir):
    """op5: all documents with their remaining text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup(docs, counts=True).select("doc_id", "text", "n_lines", "n_removed")


SQL = None
