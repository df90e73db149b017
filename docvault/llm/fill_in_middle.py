"""Fill-in-middle training texts: every document cut into prefix, middle and suffix and put in another order.

A document is cut at units (lines) into three segments by numbers drawn from the hash of its id.  The texts are moved
as pieces of at most ``PIECE`` bytes, each holding whole units where they fit, keyed by document and position in the
output.  One shuffle deals the pieces by document and sorts them by (document, position) inside the partitions, the
secondary sort of ``repartitionAndSortWithinPartitions`` as data frames have it.  A task then reads each output as a
stream: it feeds the digest and looks for the marks, which tells from output and form alone where every piece belongs
in the source.  The pieces stay in their partition and are only sorted again, by place in the source, to restore the
text.  A task holds one Arrow batch of pieces, never a document; only :func:`texts` holds one document at a time.

Defined results: a null or empty text, and one that holds a mark, is plain; a null doc_id counts as the empty text
when numbers are drawn; repeated rows (and rows of one doc_id) are documents of their own with equal numbers; an
empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docvault.llm.common import numbered, partitions_for, table

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PIECE = 16 << 10
SEED = 7
FIM_PERCENT = 100
SPM_PERCENT = 50
ORDER = {"psm": (0, 2, 1), "spm": (2, 0, 1), "plain": (0,)}  # segments (0 prefix, 1 middle, 2 suffix) as they are written
MARKS = {0: PREFIX, 1: MIDDLE, 2: SUFFIX}
HEAD = "doc_id long, n long, form string, prefix_chars long, middle_chars long"
PIECES = f"_rid long, pos long, body binary, {HEAD}"
PLACED = f"_rid long, segment int, pos long, body binary, {HEAD}, output_sha256 string"
DIGESTS = f"{HEAD}, output_sha256 string, restored_sha256 string"
EMIT_BYTES = 4 << 20


def unit_ends(raw: bytes) -> np.ndarray:
    """Byte offsets at which the units ``[^\\n]*\\n|[^\\n]+`` end."""
    ends = np.flatnonzero(np.frombuffer(raw, dtype=np.uint8) == 10) + 1
    return np.append(ends, len(raw)) if raw and raw[-1] != 10 else ends


def plan(doc_id: int | None, raw: bytes, seed: int = SEED, fim: int = FIM_PERCENT, spm: int = SPM_PERCENT) -> tuple[int, str, int, int]:
    """``(units, form, end of the prefix, end of the middle)`` of a text, ends in bytes."""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    ends = unit_ends(raw)
    n = len(ends)
    if not raw or h3 % 100 >= fim or any(m in raw for m in MARKS.values()):
        return n, "plain", len(raw), len(raw)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    at = [int(ends[k - 1]) if k else 0 for k in (a, b)]
    return n, "spm" if h4 % 100 < spm else "psm", at[0], at[1]


def chunks(raw: bytes, start: int, end: int, size: int = PIECE):
    """``raw[start:end]`` in parts of at most ``size`` bytes, cut behind a unit where one ends."""
    while start < end:
        stop = min(start + size, end)
        if stop < end:
            stop = raw.rfind(b"\n", start, stop) + 1 or stop
        yield raw[start:stop]
        start = stop


def output_pieces(raw: bytes, form: str, a: int, b: int, size: int = PIECE):
    """The output as consecutive parts, in order."""
    bounds = {0: (0, a), 1: (a, b), 2: (b, len(raw))}
    for segment in ORDER[form]:
        mark = MARKS[segment] if form != "plain" else b""
        first = True
        for part in chunks(raw, *bounds[segment], size):
            yield mark + part if first else part
            first = False
        if first:
            yield mark


class Reader:
    """Reads an output of known form as a stream of parts; ``feed`` gives ``(segment, bytes)`` of the source text.

    Only the marks tell the segments apart, and a mark may be spread over parts: the last bytes that could begin one
    are held back until the next part."""

    def __init__(self, form: str):
        self.left = [(MARKS[s], s) for s in ORDER[form]] if form != "plain" else []
        self.segment = 0 if form == "plain" else None
        self.rest = b""

    def feed(self, part: bytes, last: bool = False):
        data = self.rest + part
        while self.left:
            mark, segment = self.left[0]
            at = data.find(mark)
            if at < 0:
                break
            yield from self._out(data[:at])
            data, self.segment = data[at + len(mark):], segment
            self.left.pop(0)
        keep = 0
        if self.left and not last:
            keep = next((k for k in (2, 1) if data.endswith(self.left[0][0][:k])), 0)
        self.rest = data[len(data) - keep:]
        yield from self._out(data[:len(data) - keep])

    def _out(self, body: bytes):
        if body:
            if self.segment is None:
                raise ValueError("text before the first mark")
            yield self.segment, body


def restore(output: bytes, form: str) -> bytes:
    """The source text of a whole output."""
    parts = list(Reader(form).feed(output, last=True))
    return b"".join(body for s in (0, 1, 2) for segment, body in parts if segment == s)


def _cut(seed: int, fim: int, spm: int, size: int):
    names = [c.split()[0] for c in PIECES.split(", ")]

    def run(batches):
        for batch in batches:
            rows, held = [], 0
            for rid, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("_rid", "doc_id", "text")), strict=True):
                raw = (text or "").encode()
                n, form, a, b = plan(doc_id, raw, seed, fim, spm)
                head = (doc_id, n, form, *((None, None) if form == "plain" else (len(raw[:a].decode()), len(raw[a:b].decode()))))
                for pos, body in enumerate(output_pieces(raw, form, a, b, size)):
                    rows.append((rid, pos, body, *(head if pos == 0 else (None,) * 5)))
                    held += len(body)
                    if held >= EMIT_BYTES:
                        yield _batch(rows, names, PIECES)
                        rows, held = [], 0
            if rows:
                yield _batch(rows, names, PIECES)

    return run


def _batch(rows: list[tuple], names: list[str], schema: str):
    import pyarrow as pa

    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    types = [kinds[c.split()[1]] for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)], names=names)


def _rows(batches, schema: str):
    names = [c.split()[0] for c in schema.split(", ")]
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in names), strict=True)


def _place(batches):
    """Sorted pieces → digest of each output, and its pieces with their places in the source.

    The row with a document's digest has segment -1, so it comes before the pieces when they are sorted again."""
    names = [c.split()[0] for c in PLACED.split(", ")]
    rows, held = [], 0
    rid = head = digest = reader = None
    k = 0

    def end():
        return (rid, -1, 0, None, *head, digest.hexdigest())

    for r, pos, body, *meta in _rows(batches, PIECES):
        if pos == 0:
            if head is not None:
                rows += [(rid, s, k + i, b, *(None,) * 6) for i, (s, b) in enumerate(reader.feed(b"", last=True))]
                rows.append(end())
            rid, head, digest, reader, k = r, meta, hashlib.sha256(), Reader(meta[2]), 0
        digest.update(body)
        for segment, part in reader.feed(body):
            rows.append((rid, segment, k, part, *(None,) * 6))
            held += len(part)
            k += 1
        if held >= EMIT_BYTES or len(rows) >= 10_000:
            yield _batch(rows, names, PLACED)
            rows, held = [], 0
    if head is not None:
        rows += [(rid, s, k + i, b, *(None,) * 6) for i, (s, b) in enumerate(reader.feed(b"", last=True))]
        rows.append(end())
    if rows:
        yield _batch(rows, names, PLACED)


def _restored(batches):
    """Pieces sorted by place in the source → one row a document with both digests."""
    names = [c.split()[0] for c in DIGESTS.split(", ")]
    rows, head, digest = [], None, None
    for _, segment, _, body, *meta in _rows(batches, PLACED):
        if segment < 0:
            if head is not None:
                rows.append((*head, digest.hexdigest()))
            head, digest = meta, hashlib.sha256()
            if len(rows) >= 10_000:
                yield _batch(rows, names, DIGESTS)
                rows = []
        else:
            digest.update(body)
    if head is not None:
        rows.append((*head, digest.hexdigest()))
    if rows:
        yield _batch(rows, names, DIGESTS)


def _joined(batches):
    """Sorted pieces → one row a document with its output text."""
    schema = f"{HEAD}, output string"
    names = [c.split()[0] for c in schema.split(", ")]
    head, parts = None, []
    for _, pos, body, *meta in _rows(batches, PIECES):
        if pos == 0:
            if head is not None:
                yield _batch([(*head, b"".join(parts).decode())], names, schema)
            head, parts = meta, []
        parts.append(body)
    if head is not None:
        yield _batch([(*head, b"".join(parts).decode())], names, schema)


def sorted_pieces(docs: DataFrame, seed: int = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT,
                  size: int = PIECE) -> DataFrame:
    """The outputs of ``docs`` (doc_id, text) as pieces ``(_rid, pos, body, ...)``: all of a document in one partition, in
    output order; the first piece carries what is known of the document."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pieces = numbered(docs).mapInArrow(_cut(seed, fim_percent, spm_percent, size), PIECES)
    return pieces.repartition(partitions_for(docs), "_rid").sortWithinPartitions("_rid", "pos")


def texts(docs: DataFrame, **options) -> DataFrame:
    """The transformed documents: doc_id, n, form, prefix_chars, middle_chars, output."""
    return sorted_pieces(docs, **options).mapInArrow(_joined, f"{HEAD}, output string")


def digests(docs: DataFrame, **options) -> DataFrame:
    """Per document the digest of its output and of the text that is restored from output and form."""
    placed = sorted_pieces(docs, **options).mapInArrow(_place, PLACED)
    return placed.sortWithinPartitions("_rid", "segment", "pos").mapInArrow(_restored, DIGESTS)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: all documents, lines as units."""
    return digests(table(spark, sf_dir, "documents"))


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS units FROM d),
k AS (SELECT *, len(units) AS n,
        CAST('0x' || substr(h, 1, 8) AS UBIGINT) % (len(units) + 1) AS c1, CAST('0x' || substr(h, 9, 8) AS UBIGINT) % (len(units) + 1) AS c2,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain'
             WHEN CAST('0x' || substr(h, 25, 8) AS UBIGINT) % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u),
s AS (SELECT *, array_to_string(units[1:least(c1, c2)], '') AS p, array_to_string(units[least(c1, c2) + 1:greatest(c1, c2)], '') AS m,
        array_to_string(units[greatest(c1, c2) + 1:n], '') AS x FROM k)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
    CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || x || '<M>' || m ELSE '<S>' || x || '<P>' || p || '<M>' || m END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM s
"""

# Ship this module's Python code with its functions, so workers need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
