"""SentencePiece ids with the source bytes of every piece, and their decoding.

A text is normalised here, by the character map that the model carries: at every place the longest entry of the map
(a double-array trie of source strings) is replaced, and each byte of the result records the source byte at which its
replacement began.  The normalised text is segmented by the sentencepiece library with the normalisation of its model
switched off, so the pieces tile the normalised text, and the record projects each piece to its span of source bytes.
Decoding is the library's, with the model as it is.

A task loads the model once and holds one group of texts (about 0.5 MB) at a time; there is no shuffle.

Defined results: a null or empty text has the begin and end ids alone, whose spans are empty, and decodes to the empty
text; repeated rows are rows of their own; an empty table gives no rows; other columns are ignored.  Text is data:
what looks like a control piece (``<s>``) is encoded as ordinary characters, as the library does.
"""

from __future__ import annotations

import functools
import re
import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docvault.llm.common import table
from docvault.llm.tokens import text_groups

# The mark that stands for a space, and what replaces bytes that are not UTF-8.
SPACE = "▁".encode()
REPLACEMENT = "�".encode()
# Field numbers of the model file, and kinds of pieces.
F_PIECES, F_TRAINER, F_NORMALIZER = 1, 2, 3
N_CHARS_MAP, N_DUMMY_PREFIX, N_TRIM, N_ESCAPE = 2, 3, 4, 5
T_SPACE_SUFFIX = 24
UNKNOWN, CONTROL, USER_DEFINED, BYTE = 2, 3, 4, 6
WORDS = 200_000  # normalised words that a worker keeps
ENCODED = "doc_id long, ids binary, spans binary, decoded string"


def _varint(raw: bytes, i: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        value |= (raw[i] & 127) << shift
        shift += 7
        i += 1
        if raw[i - 1] < 128:
            return value, i


def fields(raw: bytes):
    """``(number, value, start, end)`` of each field of a serialized message; the range takes in the field's key."""
    i = 0
    while i < len(raw):
        start = i
        key, i = _varint(raw, i)
        kind = key & 7
        if kind == 0:
            value, i = _varint(raw, i)
        else:
            n, i = _varint(raw, i) if kind == 2 else ({1: 8, 5: 4}[kind], i)
            value, i = raw[i:i + n], i + n
        yield key >> 3, value, start, i


class CharMap:
    """The compiled character map: longest entry that begins at a place, and its replacement."""

    def __init__(self, blob: bytes):
        n = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4:4 + n], dtype="<u4").tolist()
        self.strings = blob[4 + n:]

    def __bool__(self) -> bool:
        return bool(self.units)

    def longest(self, raw: bytes, at: int) -> tuple[int, bytes] | None:
        """``(bytes replaced, replacement)`` for the longest entry at ``at``."""
        units = self.units
        node = self._child(units[0])
        found = None
        for i in range(at, len(raw)):
            c = raw[i]
            node ^= c
            unit = units[node]
            if unit & 0x800000FF != c:
                break
            node ^= self._child(unit)
            if unit >> 8 & 1:
                found = i + 1 - at, units[node] & 0x7FFFFFFF
        if found is None:
            return None
        return found[0], self.strings[found[1]:self.strings.index(b"\0", found[1])]

    @staticmethod
    def _child(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def spans_spaces(self) -> bool:
        """Whether an entry may hold a space behind its first byte: some unit other than the root's child is labelled so."""
        if not self.units:
            return False
        labelled = np.flatnonzero((np.array(self.units, dtype=np.uint32) & 0x800000FF) == 32)
        return bool(len(set(labelled.tolist()) - {self._child(self.units[0]) ^ 32}))


class Normalizer:
    """Normalisation of a model, with the source byte of every normalised byte."""

    def __init__(self, spec: bytes, user_defined: list[bytes] = (), space_suffix: bool = False):
        got = {n: v for n, v, _, _ in fields(spec)}
        self.map = CharMap(got.get(N_CHARS_MAP, b""))
        self.dummy, self.trim, self.escape = (bool(got.get(k, 1)) for k in (N_DUMMY_PREFIX, N_TRIM, N_ESCAPE))
        self.suffix = space_suffix
        self.kept = re.compile(b"|".join(re.escape(u) for u in sorted(user_defined, key=len, reverse=True))) if user_defined else None
        self.plain = not self.map and not self.trim and not self.kept
        # words may be normalised one by one when no entry reaches over a space
        self.by_word = not self.kept and not self.map.spans_spaces()
        self.word = functools.lru_cache(WORDS)(self._replaced)

    def _replaced(self, raw: bytes) -> list[tuple[int, bytes]]:
        """``(source bytes, replacement)`` along ``raw``: longest entry, else one character."""
        out, at = [], 0
        while at < len(raw):
            if self.kept and (m := self.kept.match(raw, at)):
                n, text = len(m[0]), m[0]
            elif (hit := self.map.longest(raw, at) if self.map else None) is not None:
                n, text = hit
            else:
                c = raw[at]
                n = 1 if c < 0x80 else 2 if c < 0xE0 else 3 if c < 0xF0 else 4
                text = raw[at:at + n]
            out.append((n, text))
            at += n
        return out

    def __call__(self, text: str) -> tuple[bytes, np.ndarray]:
        """``(normalised, source)``: ``source`` is one longer, its last element the end of the source that was used."""
        raw = text.encode("utf-8", "replace")
        space = SPACE if self.escape else b" "
        if not raw:
            return b"", np.zeros(1, dtype=np.int64)
        if self.plain:
            body = raw.replace(b" ", space)
            at = np.repeat(np.arange(len(raw)), np.where(np.frombuffer(raw, dtype=np.uint8) == 32, len(space), 1))
            pad, n = (space, len(space)) if self.dummy else (b"", 0)
            if self.suffix:
                return body + pad, np.concatenate([at, np.full(n + 1, len(raw))])
            return pad + body, np.concatenate([np.zeros(n, dtype=np.int64), at, [len(raw)]])
        steps = self._replaced(raw) if not self.by_word else [s for w in re.findall(rb" +[^ ]*|[^ ]+", raw) for s in self.word(w)]
        first = used = 0
        if self.trim:
            while first < len(steps) and steps[first][1] == b" ":
                used += steps[first][0]
                first += 1
            if first == len(steps):
                return b"", np.array([used], dtype=np.int64)
        out, source = bytearray(), []

        def put(part: bytes) -> None:
            out.extend(part)
            source.extend([used] * len(part))

        if self.dummy and not self.suffix:
            put(space)
        after_space = self.trim
        for n, part in steps[first:]:
            if after_space:
                part = part.lstrip(b" ")
            if part:
                put(part.replace(b" ", space))
                after_space = part.endswith(b" ")
            used += n
            after_space = after_space and self.trim
        if self.trim:
            while out.endswith(space):
                del out[-len(space):]
                used = source[len(out)]
                del source[len(out):]
        if self.dummy and self.suffix:
            put(space)
        return bytes(out), np.array([*source, used], dtype=np.int64)


class PieceEncoder:
    """``encode(texts)``: per text the ids and the ``(begin, end)`` source bytes of each; ``decode(ids)``."""

    def __init__(self, path: str):
        import sentencepiece

        with open(path, "rb") as f:
            model = f.read()
        pieces, plain, spec, suffix = [], b"", b"", False
        for number, value, start, end in fields(model):
            if number == F_PIECES:
                got = {n: v for n, v, _, _ in fields(value)}
                pieces.append((got[1], got.get(3, 1)))
            if number == F_TRAINER:
                suffix = any(n == T_SPACE_SUFFIX and v for n, v, _, _ in fields(value))
            if number == F_NORMALIZER:
                spec = value
            else:
                plain += model[start:end]
        off = bytes(b for k in (N_DUMMY_PREFIX, N_TRIM, N_ESCAPE) for b in (k << 3, 0))
        plain += bytes([F_NORMALIZER << 3 | 2, len(off)]) + off
        self.normalize = Normalizer(spec, [p for p, kind in pieces if kind == USER_DEFINED], suffix)
        self.whole = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.segmenter = sentencepiece.SentencePieceProcessor(model_proto=plain)
        self.width = np.array([1 if kind == BYTE else 0 if kind == CONTROL else len(p) for p, kind in pieces], dtype=np.int64)
        self.unknown = self.whole.unk_id()

    def encode(self, texts: list[str], begin: bool = True, end: bool = True) -> list[tuple[np.ndarray, np.ndarray]]:
        normal = [self.normalize(t) for t in texts]
        found = self.segmenter.encode([t.decode() for t, _ in normal], num_threads=1)
        return [self._project(text, source, ids, begin, end) for (text, source), ids in zip(normal, found, strict=True)]

    def _project(self, text: bytes, source: np.ndarray, ids: list[int], begin: bool, end: bool):
        ids = np.array(ids, dtype="<u4")
        width = self.width[ids]
        if (ids == self.unknown).any():  # an unknown piece may hold several characters: the library tells which
            parts = self.segmenter.encode(text.decode(), out_type="immutable_proto").pieces
            width = np.array([len(p.surface.encode()) for p in parts], dtype=np.int64)
        stops = np.cumsum(width)
        if (int(stops[-1]) if len(stops) else 0) != len(text):
            raise ValueError("the pieces do not tile the normalised text")
        spans = np.stack([source[stops - width], source[stops]], axis=1)
        if begin:
            ids, spans = np.append(np.array([self.whole.bos_id()], "<u4"), ids), np.concatenate([[[0, 0]], spans])
        if end:
            last = spans[-1, 1] if len(spans) else 0
            ids, spans = np.append(ids, np.array([self.whole.eos_id()], "<u4")), np.concatenate([spans, [[last, last]]])
        return ids.astype("<u4"), spans

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        return self.whole.decode([x.tolist() for x in ids], num_threads=1) if ids else []


@functools.lru_cache(2)
def encoder(path: str) -> PieceEncoder:
    """One encoder per file and Python worker, kept between tasks."""
    return PieceEncoder(path)


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """``docs`` (doc_id, text) → doc_id, ids (little-endian unsigned 32-bit, with begin and end id), spans (begin and end
    source byte of each id, 64-bit little-endian) and the text that the ids decode to."""
    def run(batches):
        import pyarrow as pa

        enc = encoder(model_path)
        for batch, texts in text_groups(batches):
            got = enc.encode(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([i.tobytes() for i, _ in got], pa.binary()),
                 pa.array([s.astype("<i8").tobytes() for _, s in got], pa.binary()), pa.array(enc.decode([i for i, _ in got]), pa.string())],
                names=["doc_id", "ids", "spans", "decoded"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, ENCODED)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: all documents, encoded and decoded; ``spans_crc32`` stands for the source spans."""
    import public_tokenizers

    rows = encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return rows.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"), F.crc32("spans").alias("spans_crc32"))


SQL = None  # the segmentation has no SQL; tests hold it against the library and the spans against the source texts

# Ship this module's Python code with its functions, so workers need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
