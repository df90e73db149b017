"""62-bit hashes of byte ranges and of word sequences, for whole buffers at once (numpy).

Polynomial prefix sums modulo two primes give the hash of any range with one subtraction and one multiplication by the
inverse power of its start; both are mixed with the range's length.  Modulo a prime a polynomial has no more roots than its
degree, whatever the text; modulo a power of two, self-similar words of equal length would have equal hashes.
"""

from __future__ import annotations

import numpy as np

PRIMES = ((1 << 31) - 1, (1 << 31) - 19)
BASES = (1_640_531_527, 1_181_783_497)
SMALL = 1 << 22  # of values below 2 ** 9 as many products with a power, and more, add up below 2 ** 64
_POWERS: list[tuple[np.ndarray, np.ndarray]] = []


def _power_table(base: int, prime: int, n: int) -> np.ndarray:
    out = np.ones(n, dtype=np.uint32)
    done = 1
    while done < n:
        more = min(done, n - done)
        out[done:done + more] = out[:more].astype(np.uint64) * np.uint64(pow(base, done, prime)) % np.uint64(prime)
        done += more
    return out


def _powers(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per prime ``base ** j`` and its inverse for j below n, at least; kept, and made again when a longer buffer comes."""
    if not _POWERS or len(_POWERS[0][0]) < n:
        size = max(n, 1 << 16)
        _POWERS[:] = [(_power_table(b, p, size), _power_table(pow(b, -1, p), p, size)) for b, p in zip(BASES, PRIMES, strict=True)]
    return _POWERS


def mix(h: np.ndarray, salt=0) -> np.ndarray:
    """A 64-bit finalizer (splitmix)."""
    z = h + np.uint64(0x9E3779B97F4A7C15) * (np.asarray(salt).astype(np.uint64) + np.uint64(1))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def prefix(values: np.ndarray) -> np.ndarray:
    """Per prime, prefix sums of ``(value + 1) * base ** position`` (differences of them are meant, modulo the prime)."""
    n = len(values)
    out = np.zeros((len(PRIMES), n + 1), dtype=np.uint64)
    small = values.dtype == np.uint8
    for sums, prime, (up, _) in zip(out, PRIMES, _powers(n + 1), strict=True):
        v = values.astype(np.uint64) if small else values.astype(np.uint64) % np.uint64(prime)
        v += np.uint64(1)
        v *= up[:n]
        if not small or n > SMALL:
            v %= np.uint64(prime)
        np.cumsum(v, out=sums[1:])
    return out


def of_ranges(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the ranges ``[start, end)`` of what ``sums`` was made from."""
    high, low = ((s[ends] - s[starts]) % np.uint64(prime) * down[starts] % np.uint64(prime)
                 for s, prime, (_, down) in zip(sums, PRIMES, _powers(sums.shape[1]), strict=True))
    return mix((high << np.uint64(32)) | low, ends - starts)


def runs(is_sep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs that hold no separator."""
    edge = np.diff(is_sep.astype(np.int8), prepend=1, append=1)
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
