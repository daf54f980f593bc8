"""Pre-tokens of the word-level BPE vocabulary, cut and told apart in numpy.

The vocabulary's rule: compose, collapse white space, lower-case; then contractions,
runs of letters, single digits and runs of anything else.  For texts of ASCII and the
accented letters of Latin-1 the rule is a matter of bytes, and a batch is cut by array
operations.  Other texts, and those that hold a special token's string, are left to the
library's own normaliser and pre-tokeniser.

What is worked out for a pre-token is kept, by the hash of its bytes, as long as the
Python worker lives, up to ``KEPT`` pre-tokens; after that the worker starts anew.
"""

from __future__ import annotations

import numpy as np

from paperward.llm.arrays import bounds, gather, hash_spans, lay

KEPT = 500_000
#: Pre-tokens worked out at once.
BATCH = 4000

_SPACE, _LETTER, _DIGIT, _OTHER = range(4)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE
_CLASS[48:58] = _DIGIT
_CLASS[65:91] = _CLASS[97:123] = _LETTER
_CLASS[128:] = _LETTER
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LEAD = 0xC3  # of the letters U+00C0 to U+00FF
#: Follow the lead byte but are no letters: multiplication and division sign.
_SIGNS = (0x97, 0xB7)
_CONTROL = np.zeros(256, bool)
_CONTROL[:32] = _CONTROL[127] = True
_CONTROL[9:14] = False


def is_plain(texts: list[bytes], special: tuple[bytes, ...]) -> np.ndarray:
    """Which texts can be cut as bytes."""
    buf, at = lay(texts)
    high = buf >= 128
    after = np.concatenate(([False], buf[:-1] == _LEAD))
    good = (buf == _LEAD) | (after & (buf < 0xC0) & (buf != _SIGNS[0]) & (buf != _SIGNS[1]))
    bad = (high & ~good) | _CONTROL[buf]
    plain = np.ones(len(texts), bool)
    plain[np.searchsorted(at, np.flatnonzero(bad), "right") - 1] = False
    for i, text in enumerate(texts):
        if plain[i] and any(s in text for s in special):
            plain[i] = False
    return plain


class Cut:
    """Lower-cased bytes of plain texts and the bounds of their pre-tokens."""

    def __init__(self, texts: list[bytes]):
        raw, at = lay([*texts, b"\n\n\n"])
        lower = _LOWER[raw]
        big = np.flatnonzero(raw == _LEAD) + 1
        big = big[raw[big] <= 0x9E]
        lower[big] += 0x20
        kind = _CLASS[raw]
        start = kind != _SPACE
        start[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        _contractions(lower, kind, start)
        self.buf = lower
        self.starts = np.flatnonzero(start)
        _, run_ends = bounds(kind != _SPACE)
        until = run_ends[np.searchsorted(run_ends, self.starts, "right")] if len(self.starts) else self.starts
        self.ends = np.minimum(until, np.append(self.starts[1:], len(lower)))
        self.first = np.searchsorted(self.starts, at[:-1])
        self.hashes = hash_spans(self.buf, self.starts, self.ends)


def _contractions(buf: np.ndarray, kind: np.ndarray, start: np.ndarray) -> None:
    """Move the starts after an apostrophe that opens 's, 't, 'm, 'd, 're, 've or 'll."""
    at = np.flatnonzero(start & (buf == ord("'")))
    if not len(at):
        return
    a, b = buf[at + 1], buf[at + 2]
    one = np.isin(a, [ord(c) for c in "stmd"])
    two = np.zeros(len(at), bool)
    for x, y in ("re", "ve", "ll"):
        two |= (a == ord(x)) & (b == ord(y))
    for hit, n in ((one, 1), (two, 2)):
        where = at[hit]
        start[where + 1] = False
        after = where + n + 1
        start[after[kind[after] == _LETTER]] = True


class Kept:
    """Number rows kept by hash: ``work`` gives the rows of spans not met before."""

    def __init__(self, work, limit: int = KEPT):
        self.work, self.limit = work, limit
        self.clear()

    def clear(self) -> None:
        self.slot: dict[int, int] = {}
        self.values, self.offsets = np.empty(0, np.int32), np.zeros(1, np.int64)

    def rows(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """For each span, its row in ``values`` and ``offsets``."""
        if len(self.slot) > self.limit:
            self.clear()
        names, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        get = self.slot.get
        slots = np.array([get(h, -1) for h in names.tolist()], np.int64)
        new = np.flatnonzero(slots < 0)
        if len(new):
            at = first[new]
            data = buf.tobytes()
            spans = [data[s:e] for s, e in zip(starts[at].tolist(), ends[at].tolist())]
            parts = [self.work(spans[i : i + BATCH]) for i in range(0, len(spans), BATCH)]
            values, sizes = (np.concatenate(x) for x in zip(*parts))
            base = len(self.offsets) - 1
            slots[new] = base + np.arange(len(new))
            self.slot.update(zip(names[new].tolist(), range(base, base + len(new))))
            self.values = np.concatenate([self.values, values.astype(np.int32)])
            self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(sizes)])
        return slots[inverse]

    def gathered(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return gather(self.values, self.offsets, rows)


_held: dict = {}


def held(name, make):
    """An object that lives as long as this Python worker."""
    if name not in _held:
        _held[name] = make()
    return _held[name]


def special_tokens(tokenizer) -> tuple[bytes, ...]:
    return tuple(t.content.encode() for t in tokenizer.get_added_tokens_decoder().values())


def flat(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Rows laid end to end, and their sizes."""
    sizes = np.array([len(r) for r in rows], np.int64)
    return np.array([x for r in rows for x in r], np.int32), sizes


class Encoder:
    """Ids of whole texts, as the library gives them, each distinct pre-token once."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = special_tokens(self.tokenizer)
        self.kept = Kept(self._encode)

    def _encode(self, spans: list[bytes]):
        found = self.tokenizer.encode_batch([s.decode() for s in spans], add_special_tokens=False)
        return flat([e.ids for e in found])

    def ids(self, texts: list[bytes]) -> list[np.ndarray]:
        plain = is_plain(texts, self.special)
        cut = Cut([t if p else b"" for t, p in zip(texts, plain)])
        values, offsets = self.kept.gathered(self.kept.rows(cut.buf, cut.starts, cut.ends, cut.hashes))
        ends = offsets[cut.first]
        out = [values[s:e] for s, e in zip(ends, ends[1:])]
        for i in np.flatnonzero(~plain):
            found = self.tokenizer.encode(texts[i].decode(), add_special_tokens=False)
            out[i] = np.array(found.ids, np.int32)
        return out
