"""Packing documents into training sequences along a space-filling curve.

Each document's token counts are feature-hashed into a signed vector, scaled to unit length and projected with
fixed Gaussian directions to a few dimensions; the coordinates, spread evenly by the normal distribution
function, give its place on a Hilbert curve.  Documents are range-sorted by that key, so neighbours on the
curve, which share vocabulary, are packed into the same sequences.

One pass tokenizes and writes (key, ids); the ids are shuffled once, by range.  A partition is cut as one
stream into full sequences, and what is left at its end into sequences whose lengths are powers of two, so no
sequence needs padding.  Equal keys (copies) are ordered by doc_id and content and may lie in several
partitions; a task holds one document at a time besides its Arrow batch.

Defined results: a null or empty text is the end id alone; documents of equal key, id and ids are
interchangeable; an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docvault.llm.common import stage_table, table
from docvault.llm.tokens import as_uint32, encoder, text_groups

LENGTH = 4096
BUCKETS = 1024
DIMS = 4
BITS = 12  # of each coordinate: DIMS * BITS <= 62
SEED = 7
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def hilbert_key(coords: np.ndarray, bits: int) -> np.ndarray:
    """Index along the Hilbert curve of integer points (rows) with ``bits`` bits a coordinate.

    Skilling's transform (2004): undo the reflections and exchanges of each level from the top, Gray-encode, and
    interleave the bits of the coordinates.
    """
    x = np.array(coords, dtype=np.int64).T.copy()
    dims = len(x)
    level = 1 << (bits - 1)
    while level > 1:
        low = level - 1
        for i in range(dims):
            flip = (x[i] & level) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(flip, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        level >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    level = 1 << (bits - 1)
    while level > 1:
        turn = np.where((x[-1] & level) != 0, turn ^ (level - 1), turn)
        level >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def _normal_cdf(x: np.ndarray) -> np.ndarray:
    """The logistic approximation of the normal distribution function; only its order and spread matter."""
    return 1 / (1 + np.exp(-1.702 * x))


def document_keys(ids: list[np.ndarray]) -> np.ndarray:
    """Hilbert keys of documents given as id arrays; depends on the multiset of ids only."""
    lengths = np.array([len(a) for a in ids], dtype=np.int64)
    flat = np.concatenate(ids).astype(np.uint64) if len(ids) else np.zeros(0, dtype=np.uint64)
    mixed = (flat * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
    sign = 1.0 - 2.0 * ((mixed >> np.uint64(12)) & np.uint64(1)).astype(np.float64)
    place = np.repeat(np.arange(len(ids)), lengths) * BUCKETS + (mixed & np.uint64(BUCKETS - 1)).astype(np.int64)
    vectors = np.bincount(place, weights=sign, minlength=len(ids) * BUCKETS).reshape(len(ids), BUCKETS)
    norm = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    unit = vectors / np.where(norm > 0, norm, 1)
    axes = np.random.RandomState(SEED).standard_normal((BUCKETS, DIMS))
    spread = _normal_cdf(unit @ axes)
    return hilbert_key(np.minimum((spread * (1 << BITS)).astype(np.int64), (1 << BITS) - 1), BITS)


def _tokenizer(path: str, end_id: int):
    def run(batches):
        import pyarrow as pa

        enc = encoder(path)
        end = np.array([end_id], dtype=enc.dtype).tobytes()
        for batch, texts in text_groups(batches):
            raw = enc.encode(texts)
            keys = np.concatenate([document_keys([np.frombuffer(r, dtype=enc.dtype) for r in raw[i:i + 256]])
                                   for i in range(0, len(raw), 256)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(keys, pa.int64()), pa.array([r + end for r in raw], pa.binary())],
                names=["doc_id", "key", "ids"])

    return run


def _cutter(dtype: str, length: int):
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        kind = np.dtype(dtype)
        w, sequence, fill = kind.itemsize, TaskContext.get().partitionId() << 32, 0
        held: list[tuple] = []  # the pieces of the sequence being filled: fewer than ``length`` ids

        def batch_of(rows):
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 7
            names = [c.split()[0] for c in PIECES.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=names)

        def close(piece, seq, off):
            doc, at, raw, total = piece
            return doc, at, len(raw) // w, zlib.crc32(as_uint32(raw, kind)), total, seq, off

        for batch in batches:
            rows = []
            for doc, raw in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                total, at = len(raw) // w, 0
                while at < total:
                    n = min(length - fill, total - at)
                    held.append((doc, at, raw[at * w:(at + n) * w], total))
                    at, fill = at + n, fill + n
                    if fill == length:
                        off = 0
                        for piece in held:
                            rows.append(close(piece, sequence, off))
                            off += len(piece[2]) // w
                        held, fill, sequence = [], 0, sequence + 1
            if rows:
                yield batch_of(rows)
        rows, room, off = [], 0, 0
        for doc, at, raw, total in held:  # the rest of the partition: its binary digits are the sequence lengths
            while raw:
                if not room:
                    room, off = 1 << (fill.bit_length() - 1), 0
                n = min(room, len(raw) // w)
                rows.append(close((doc, at, raw[:n * w], total), sequence, off))
                raw, at, off, room, fill = raw[n * w:], at + n, off + n, room - n, fill - n
                if not room:
                    sequence += 1
        if rows:
            yield batch_of(rows)

    return run


def tokenized(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """doc_id, key (place on the curve), ids (bytes); written to the shared folder, as the range sort reads it twice."""
    rows = docs.select("doc_id", "text").mapInArrow(_tokenizer(tokenizer_path, end_id), "doc_id long, key long, ids binary")
    return stage_table(rows, "packing")


def pack(docs: DataFrame, tokenizer_path: str, end_id: int, length: int = LENGTH) -> DataFrame:
    """One row per piece: which ids of which document lie where in which sequence (see ``PIECES``).

    ``ids_crc32`` checks the piece's ids as little-endian unsigned 32-bit integers.
    """
    order = [F.col("key").asc(), F.col("doc_id").asc_nulls_last(), F.col("_hash").asc(), F.col("_row").asc()]
    rows = tokenized(docs, tokenizer_path, end_id)
    rows = rows.select("*", F.xxhash64("ids").alias("_hash"), F.monotonically_increasing_id().alias("_row"))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "ids")
    return rows.mapInArrow(_cutter(encoder(tokenizer_path).dtype.str, length), PIECES)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: all documents, end id 2, sequences of 4096."""
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2)


SQL = None
