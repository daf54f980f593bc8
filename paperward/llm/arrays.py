"""Text as flat numpy arrays: word bounds, word hashes, ragged gathers.

Everything works on the UTF-8 bytes of a batch of texts laid end to end, so no
Python object is made per word.  Batches are cut to ``CHUNK`` bytes of text by
:func:`chunks`; one text longer than that is a batch of its own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

CHUNK = 4 << 20
_SLICE = 1 << 19

U64 = np.uint64
_ODD = U64(0x9E3779B97F4A7C15)
_STEP = 0xD6E8FEB86659FD93
_BACK = U64(pow(_STEP, -1, 1 << 64))

SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (splitmix64's end)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_BYTE = mix(np.arange(1, 257, dtype=U64) * _ODD)


def _powers(base: U64, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    out[0] = 1
    return np.cumprod(out, dtype=U64)


_UP, _DOWN = _powers(U64(_STEP), _SLICE + 1), _powers(_BACK, _SLICE + 1)


def chunks(texts: Iterable[bytes | None]) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first, texts) of batches of about ``CHUNK`` bytes; null is empty."""
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        text = text or b""
        if held and size + len(text) > CHUNK:
            yield first, held
            first, held, size = i, [], 0
        held.append(text)
        size += len(text) + 1
    if held:
        yield first, held


def lay(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, a newline after each, and where each text starts (one more at the end)."""
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    at = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(sizes, out=at[1:])
    return np.frombuffer(b"\n".join([*texts, b""]), np.uint8), at


def bounds(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every run of True; the last item must be False."""
    change = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        change = np.concatenate(([0], change))
    return change[0::2], change[1::2]


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of every span; spans are ordered and don't overlap."""
    out = np.empty(len(starts), U64)
    i = 0
    while i < len(starts):
        base = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, base + _SLICE, "right")))
        up, down = _UP, _DOWN
        if (need := int(ends[j - 1]) - base) > _SLICE:
            up, down = _powers(U64(_STEP), need + 1), _powers(_BACK, need + 1)
        sums = np.zeros(need + 1, U64)
        np.cumsum(_BYTE[buf[base : base + need]] * up[:need], out=sums[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(U64) * _ODD)
        i = j
    return out


class Words:
    """The words of a batch: maximal runs of bytes other than ASCII white space."""

    def __init__(self, texts: list[bytes], lower: bool = False):
        self.buf, at = lay(texts)
        if lower:
            self.buf = LOWER[self.buf]
        self.starts, self.ends = bounds(~IS_SPACE[self.buf])
        #: word number where each text starts, one more at the end
        self.first = np.searchsorted(self.starts, at)
        self.hashes = hash_spans(self.buf, self.starts, self.ends)
        self.counts = np.diff(self.first)

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, text number and first word of every run of ``k`` words inside one text."""
        n = len(self.hashes) - k + 1
        if n <= 0:
            return np.empty(0, U64), np.empty(0, np.int64), np.empty(0, np.int64)
        text = np.repeat(np.arange(len(self.counts)), self.counts)
        fits = np.flatnonzero(text[:n] == text[k - 1 :])
        total = self.hashes[:n].copy()
        for j in range(1, k):
            total *= _ODD
            total += self.hashes[j : j + n]
        return mix(total[fits] + U64(k)), text[fits], fits


def gather(values: np.ndarray, offsets: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ragged rows ``values[offsets[r]:offsets[r+1]]`` laid end to end, and their offsets."""
    sizes = offsets[rows + 1] - offsets[rows]
    out = np.zeros(len(rows) + 1, np.int64)
    np.cumsum(sizes, out=out[1:])
    at = np.arange(out[-1]) + np.repeat(offsets[rows] - out[:-1], sizes)
    return values[at], out


def span_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of every ragged row, empty rows included."""
    total = np.zeros(len(values) + 1, values.dtype)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]
