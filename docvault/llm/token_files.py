"""Token ids as binary shard files with Elias-Fano document boundaries.

Documents are range-partitioned by doc_id and sorted, each partition is one shard file, written as a stream:

    ids of all documents, back to back (2 or 4 bytes each, little endian)
    Elias-Fano block of the documents' end offsets
    Elias-Fano block of the documents' ids (they ascend, so the same code fits), nulls last and only counted
    footer: JSON with the places of the parts, its length (8 bytes), magic

An Elias-Fano block keeps the low ``l`` bits of each value packed and the high parts in unary, with the place of
every 256th one bit as select structure: about ``2 + log2(ids / documents)`` bits a document instead of 64.

A task attempt writes its own file and names it in the manifest row it returns, and Spark commits one row a
shard, so a lost executor or a repeated attempt leaves at most an unnamed file behind.

Defined results: a null or empty text has only the end id; documents with one doc_id (and null doc_ids, last) are
ordered by text hash; repeated rows are documents of their own; an empty table gives no shards; other columns
are ignored.  A partition of one hot doc_id is split by text hash and row.
"""

from __future__ import annotations

import json
import uuid
import zlib
from array import array

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from docvault.llm.common import stage_table, table
from docvault.llm.tokens import as_uint32, encoder, text_groups
from docvault.session import scratch_path

MAGIC = b"TOKEF001"
SAMPLE = 256
READ_IDS = 2_000_000  # ids read at once
MANIFEST = "shard int, path string, n_docs long, n_tokens long"


class EliasFano:
    """A non-decreasing sequence of unsigned integers below 2**63, with constant-time access by index."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: np.ndarray):
        self.n, self.low_bits = n, low_bits
        self.low, self.high, self.samples = low, high, samples

    @classmethod
    def encode(cls, values: np.ndarray) -> "EliasFano":
        v = np.asarray(values, dtype=np.uint64)
        n = len(v)
        if not n:
            return cls(0, 0, b"", b"", np.zeros(0, dtype="<u8"))
        per = (int(v[-1]) + 1) // n
        bits = max(0, per.bit_length() - 1)
        parts = []
        for i in range(0, n, 1 << 16):
            part = (v[i:i + (1 << 16), None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
            parts.append(part.astype(np.uint8).ravel())
        low = np.packbits(np.concatenate(parts), bitorder="little").tobytes() if bits else b""
        ones = (v >> np.uint64(bits)).astype(np.int64) + np.arange(n, dtype=np.int64)
        unary = np.zeros(int(ones[-1]) + 1, dtype=np.uint8)
        unary[ones] = 1
        return cls(n, bits, low, np.packbits(unary, bitorder="little").tobytes(), ones[::SAMPLE].astype("<u8"))

    def to_bytes(self) -> bytes:
        head = np.array([self.n, self.low_bits, len(self.low), len(self.high)], dtype="<u8").tobytes()
        return head + self.low + self.high + self.samples.tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> "EliasFano":
        n, bits, a, b = (int(x) for x in np.frombuffer(raw[:32], dtype="<u8"))
        return cls(n, bits, raw[32:32 + a], raw[32 + a:32 + a + b], np.frombuffer(raw[32 + a + b:], dtype="<u8"))

    def __getitem__(self, i: int) -> int:
        """Value ``i``: select the (i+1)-th one bit from the nearest sample on, add the low bits."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at = int(self.samples[i // SAMPLE])
        left, byte = i % SAMPLE, at // 8
        word = self.high[byte] & (0xFF << (at % 8))
        while (ones := word.bit_count()) <= left:
            left -= ones
            byte += 1
            word = self.high[byte]
        for _ in range(left):
            word &= word - 1
        place = byte * 8 + (word & -word).bit_length() - 1
        first = i * self.low_bits
        raw = int.from_bytes(self.low[first // 8:(first + self.low_bits + 7) // 8], "little") >> (first % 8)
        return ((place - i) << self.low_bits) | (raw & ((1 << self.low_bits) - 1))

    def values(self) -> np.ndarray:
        """All values at once."""
        if not self.n:
            return np.zeros(0, dtype=np.uint64)
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, dtype=np.uint8), bitorder="little"))[:self.n]
        out = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits:
            low = np.unpackbits(np.frombuffer(self.low, dtype=np.uint8), bitorder="little")[:self.n * self.low_bits]
            for k in range(self.low_bits):
                out |= low[k::self.low_bits].astype(np.uint64) << np.uint64(k)
        return out


def filesystem(uri: str):
    """(pyarrow file system, path) of a folder or file that executors share."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if ":" in uri.split("/")[0] else (fs.LocalFileSystem(), uri)


def _writer(folder: str, tokenizer_path: str, end_id: int):
    def write(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        enc = encoder(tokenizer_path)
        end = np.array([end_id], dtype=enc.dtype).tobytes()
        fs, base = filesystem(folder)
        shard = TaskContext.get().partitionId()
        name = f"shard-{shard:06d}-{uuid.uuid4().hex}.tok"
        out, ends, ids, n_null, total = None, array("q"), array("q"), 0, 0
        for batch, texts in text_groups(batches):
            if out is None:
                fs.create_dir(base, recursive=True)
                out = fs.open_output_stream(f"{base}/{name}")
            raw = [t + end for t in enc.encode(texts)]
            out.write(b"".join(raw))
            for doc, t in zip(batch.column("doc_id").to_pylist(), raw, strict=True):
                total += len(t) // enc.dtype.itemsize
                ends.append(total)
                if doc is None:
                    n_null += 1
                else:
                    ids.append(doc)
        if out is None:
            return
        least = ids[0] if ids else 0
        shifted = (np.array(ids, dtype=np.int64) - np.int64(least)).astype(np.uint64)
        blocks = [EliasFano.encode(np.array(ends, dtype=np.uint64)).to_bytes(), EliasFano.encode(shifted).to_bytes()]
        foot = json.dumps({"dtype": enc.dtype.str, "n_tokens": total, "n_docs": len(ends), "n_null": n_null,
                           "least_doc_id": least, "blocks": [len(b) for b in blocks]}).encode()
        out.write(b"".join([*blocks, foot, len(foot).to_bytes(8, "little"), MAGIC]))
        out.close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int32()), pa.array([f"{folder}/{name}"]), pa.array([len(ends)], pa.int64()),
             pa.array([total], pa.int64())], names=["shard", "path", "n_docs", "n_tokens"])

    return write


class TokenFile:
    """One shard: ``doc_ids``, ``offset(i)``, ``ids(i)``, and ``groups()`` over all documents in bounded pieces."""

    def __init__(self, path: str):
        fs, p = filesystem(path)
        self.file = fs.open_input_file(p)
        size = self.file.size()
        tail = self.file.read_at(16, size - 16)
        if tail[8:] != MAGIC:
            raise ValueError(f"{path}: not a token file")
        n = int.from_bytes(tail[:8], "little")
        self.meta = json.loads(self.file.read_at(n, size - 16 - n))
        self.dtype = np.dtype(self.meta["dtype"])
        a, b = self.meta["blocks"]
        at = self.meta["n_tokens"] * self.dtype.itemsize
        self.ends = EliasFano.from_bytes(self.file.read_at(a, at))
        known = EliasFano.from_bytes(self.file.read_at(b, at + a)).values().astype(np.int64) + self.meta["least_doc_id"]
        self.doc_ids = [*known.tolist(), *[None] * self.meta["n_null"]]

    def offset(self, i: int) -> int:
        return self.ends[i - 1] if i else 0

    def read(self, first: int, last: int) -> bytes:
        w = self.dtype.itemsize
        return self.file.read_at((last - first) * w, first * w)

    def ids(self, i: int) -> np.ndarray:
        return np.frombuffer(self.read(self.offset(i), self.ends[i]), dtype=self.dtype)

    def groups(self, most: int = READ_IDS):
        """``(first document, starts, ends, ids as bytes)`` of consecutive documents, about ``most`` ids at once."""
        ends = self.ends.values().astype(np.int64)
        starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        i = 0
        while i < len(ends):
            j = max(i + 1, int(np.searchsorted(ends, starts[i] + most, side="right")))
            yield i, starts[i:j], ends[i:j], self.read(int(starts[i]), int(ends[j - 1]))
            i = j


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int) -> DataFrame:
    """Write ``docs`` (doc_id, text) as shards in ascending doc_id order; returns the manifest, one row a shard."""
    order = [F.col("doc_id").asc_nulls_last(), F.col("_hash").asc(), F.col("_row").asc()]
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("_hash"), F.monotonically_increasing_id().alias("_row"))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    return stage_table(rows.mapInArrow(_writer(folder, tokenizer_path, end_id), MANIFEST), "token-manifest")


def _reader(batches):
    import pyarrow as pa

    for batch in batches:
        for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist(), strict=True):
            f = TokenFile(path)
            w = f.dtype.itemsize
            for first, starts, ends, raw in f.groups():
                at = starts[0]
                crc = [zlib.crc32(as_uint32(raw[(a - at) * w:(b - at) * w], f.dtype))
                       for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(f.doc_ids[first:first + len(crc)], pa.int64()), pa.array(starts + base, pa.int64()),
                     pa.array(ends - starts, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Per document, from the files alone: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    before = F.sum("n_tokens").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1))  # one row a shard
    rows = manifest.select("path", F.coalesce(before, F.lit(0)).cast("long").alias("base"))
    n = max(1, manifest.count())
    return rows.repartition(n).mapInArrow(_reader, "doc_id long, start long, n_tokens long, ids_crc32 long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: all documents, written with end id 1 and read back."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    folder = scratch_path(spark, "llm-token-files")
    return read_token_files(write_token_files(docs, folder, public_tokenizers.path("word_bpe_49k.json"), 1))


SQL = None
