"""Token ids of whole texts with the ``tokenizers`` library, each different word encoded once.

A tokenizer that drops white space and never merges across it gives a text the concatenated ids of its
space-separated words, so a word met before needs no second encoding.  Words are cut at spaces and line feeds
only; anything else inside a word is left to the tokenizer.  Words of ASCII and Latin-1 letters are looked up in
lower case and without one trailing comma or full stop, whose id is appended: such a tokenizer lower-cases letter
by letter and treats letters and punctuation as separate pieces.

Words are found, hashed (64 bits) and looked up for a group of texts at once with numpy; the cache is a sorted
array per Python worker, bounded by ``MAX_WORDS``, and only new words reach the library.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterable, Iterator

import numpy as np

from docvault.llm import wordhash

MAX_WORDS = 1_500_000  # cached words per Python worker, about 30 bytes each
RECENT = 200_000  # new words before they are merged into the sorted cache
CHUNK_CHARS = 500_000  # texts are encoded in groups of about so many characters
MARK = "~"  # stands between words that are encoded together; not a letter
OTHER = 0xA5A5A5A5A5A5A5A5  # tells the hashes of words that are not plain letters


class _Table:
    """Sorted hashes with the place and number of each word's ids."""

    def __init__(self):
        self.keys, self.at, self.n = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def add(self, keys, at, n) -> None:
        keys, at, n = np.concatenate([self.keys, keys]), np.concatenate([self.at, at]), np.concatenate([self.n, n.astype(np.int32)])
        order = np.argsort(keys, kind="stable")
        self.keys, self.at, self.n = keys[order], at[order], n[order]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key, or -1."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        i = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[i] == keys, i, -1)


class WordEncoder:
    """``encode(texts)`` gives the little-endian ids of each text (``dtype`` uint16 or uint32) as bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        split = json.dumps(config.get("pre_tokenizer") or {})
        lower = json.dumps(config.get("normalizer") or {})
        # words are independent when white space is replaced, lower-cased and left out of every piece
        self.by_word = '"Lowercase"' in lower and "\\\\s+" in lower and '"Removed"' in split and "[\\\\p{L}]+" in split
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        if self.by_word:
            self.mark, comma, stop = (self._ids(c) for c in (MARK, ",", "."))
            self.by_word = len(self.mark) == len(comma) == len(stop) == 1
            self.tail = np.array([0, *comma, *stop], dtype=self.dtype)
            self._forget()

    def _forget(self) -> None:
        self.known, self.recent = _Table(), _Table()
        self.flat, self.used = np.zeros(1 << 16, self.dtype), 0  # ids of all cached words; grows by doubling
        self._keep(self.tail)

    def _keep(self, ids: np.ndarray) -> int:
        """Append ids, return their place."""
        if self.used + len(ids) > len(self.flat):
            grown = np.zeros(2 * (self.used + len(ids)), self.dtype)
            grown[:self.used] = self.flat[:self.used]
            self.flat = grown
        at = self.used
        self.flat[at:at + len(ids)] = ids
        self.used += len(ids)
        return at

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _learn(self, keys: np.ndarray, words: list[bytes], plain: np.ndarray) -> None:
        """Encode new words: plain ones in groups with a mark between two of them, the others one by one."""
        letters = [words[i] for i in np.flatnonzero(plain)]
        groups = [f" {MARK} ".join(b"\n".join(letters[i:i + 400]).decode().split("\n")) for i in range(0, len(letters), 400)]
        ids = [np.array(e.ids, dtype=self.dtype) for e in self.tokenizer.encode_batch_fast(groups, add_special_tokens=False)]
        mark = np.array(self.mark, dtype=self.dtype)
        if ids:
            flat = np.concatenate([x for g in ids for x in (g, mark)])
            cuts = np.flatnonzero(flat == mark[0])
            if len(cuts) != len(letters):
                raise ValueError("the tokenizer joins words across white space")
            at = np.concatenate([[0], cuts[:-1] + 1])
            self.recent.add(keys[plain], at + self._keep(flat), cuts - at)
        rest = [words[i].decode() for i in np.flatnonzero(~plain)]
        if rest:
            ids = [np.array(e.ids, dtype=self.dtype) for e in self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)]
            n = np.array([len(x) for x in ids])
            self.recent.add(keys[~plain], np.cumsum(n) - n + self._keep(np.concatenate(ids)), n)

    def _group(self, texts: list[str]) -> list[bytes]:
        raws = [t.encode() for t in texts]
        buf = np.frombuffer(b"\n".join([*raws, b""]), dtype=np.uint8)
        starts, ends = wordhash.runs((buf == 32) | (buf == 10))
        before = np.roll(buf, 1)
        latin = (before == 0xC3) & (buf >= 0x80) & (buf <= 0xBF)  # second byte of a Latin-1 letter
        upper = (buf - 65 < 26) | (latin & (buf < 0x9F) & (buf != 0x97))
        low = buf + np.where(upper, 32, 0).astype(np.uint8)
        after = np.roll(buf, -1)
        letter = (low - 97 < 26) | (latin & (buf != 0x97) & (buf != 0xB7)) | ((buf == 0xC3) & (after != 0x97) & (after != 0xB7))
        others = np.concatenate([[0], np.cumsum(~letter, dtype=np.int64)])
        last = buf[ends - 1]
        tail = np.where(ends - starts > 1, np.where(last == 44, 1, np.where(last == 46, 2, 0)), 0)
        cut = ends - (tail > 0)
        plain = others[cut] == others[starts]
        cut, tail = np.where(plain, cut, ends), np.where(plain, tail, 0)
        keys = wordhash.of_ranges(wordhash.prefix(low), starts, cut)
        if not plain.all():
            keys[~plain] = wordhash.of_ranges(wordhash.prefix(buf), starts[~plain], ends[~plain]) ^ np.uint64(OTHER)
        unique, first, inverse = np.unique(keys, return_index=True, return_inverse=True)

        if len(self.known.keys) > MAX_WORDS:
            self._forget()
        if len(self.recent.keys) > RECENT:
            self.known.add(self.recent.keys, self.recent.at, self.recent.n)
            self.recent = _Table()
        new = np.flatnonzero((self.known.find(unique) < 0) & (self.recent.find(unique) < 0))
        if len(new):
            w = first[new]
            lower, raw = low.tobytes(), buf.tobytes()
            words = [(lower if p else raw)[a:b] for a, b, p in zip(starts[w].tolist(), cut[w].tolist(), plain[w].tolist(), strict=True)]
            self._learn(unique[new], words, plain[w])
        at, n = np.zeros(len(unique), np.int64), np.zeros(len(unique), np.int64)
        for t in (self.known, self.recent):
            found = t.find(unique)
            hit = found >= 0
            at[hit], n[hit] = t.at[found[hit]], t.n[found[hit]]
        # the ids of every word, then of its tail: gather ranges of ``flat``
        at, n = at[inverse], n[inverse]
        total = n + (tail > 0)
        ends_at = np.cumsum(total)
        place = np.arange(int(ends_at[-1]) if len(total) else 0) - np.repeat(ends_at - total, total) + np.repeat(at, total)
        has = np.flatnonzero(tail)
        place[ends_at[has] - 1] = tail[has]  # the tails' ids are the first in ``flat``
        out = self.flat[place].tobytes()
        sizes = np.array([len(r) + 1 for r in raws])
        words_before = np.searchsorted(starts, np.cumsum(sizes))
        stops = (np.concatenate([[0], ends_at])[words_before] * self.dtype.itemsize).tolist()
        return [out[a:b] for a, b in zip([0, *stops[:-1]], stops, strict=True)]

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return [np.array(e.ids, dtype=self.dtype).tobytes()
                    for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return [raw for group in chunks(texts) for raw in self._group(group)]


def chunks(texts: list[str], chars: int = CHUNK_CHARS) -> Iterator[list[str]]:
    group: list[str] = []
    n = 0
    for t in texts:
        group.append(t)
        n += len(t)
        if n >= chars:
            yield group
            group, n = [], 0
    if group:
        yield group


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per file and Python worker, kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def as_uint32(raw: bytes, dtype) -> bytes:
    """The ids as little-endian unsigned 32-bit integers."""
    return np.frombuffer(raw, dtype=dtype).astype("<u4").tobytes()


def text_groups(batches: Iterable, text: str = "text") -> Iterator[tuple[object, list[str]]]:
    """Arrow batches cut into slices of about ``CHUNK_CHARS`` bytes of text, with their texts (null: empty)."""
    import pyarrow.compute as pc

    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(ends):
            before = ends[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(ends, before + CHUNK_CHARS, side="right")))
            part = batch.slice(at, end - at)
            yield part, [t or "" for t in part.column(text).to_pylist()]
            at = end
