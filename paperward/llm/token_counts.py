"""Token counts by rank-synchronous merging of arrays.

The pre-tokens of a batch are one flat array of symbols with row offsets.  In each step
every row looks up the rank of each neighbouring pair, takes its lowest, and merges that
pair wherever it stands in the row, all rows at once; rows without a pair that merges
leave the batch.  What is left of a row is its count.  No ids are built for texts, and a
pre-token that a worker has met before is only looked up.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperward.llm.arrays import bounds, chunks
from paperward.llm.pretokens import Cut, Kept, held, is_plain, special_tokens
from paperward.llm.shared import lean, tune, utf8

LIMIT = 2048
_NONE = np.int64(1) << 40


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class Merger:
    """Byte-level BPE with word ends, read from a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, end = model["vocab"], model.get("end_of_word_suffix") or ""
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.last = np.array([vocab[c + end] for c in letters], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        # Of a pair listed twice the last rank counts, as in a map that is filled in order.
        order = np.argsort(keys, kind="stable")
        keep = np.append(keys[order][1:] != keys[order][:-1], True)
        self.rank, self.keys, self.made = order[keep], keys[order][keep], made[order][keep]

    def symbols(self, spans: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """First symbols of every span laid end to end, and the row of each."""
        sizes = np.array([len(s) for s in spans], np.int64)
        data = np.frombuffer(b"".join(spans), np.uint8)
        symbols = self.inner[data]
        ends = np.cumsum(sizes)[sizes > 0] - 1
        symbols[ends] = self.last[data[ends]]
        return symbols, np.repeat(np.arange(len(spans)), sizes)

    def counts(self, spans: list[bytes]) -> np.ndarray:
        """Symbols of each span that are left when nothing merges any more."""
        symbols, row = self.symbols(spans)
        left = np.bincount(row, minlength=len(spans))
        while len(symbols) > 1:
            key = symbols[:-1] << 32 | symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.where((self.keys[at] == key) & (row[1:] == row[:-1]), self.rank[at], _NONE)
            starts = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
            lowest = np.minimum.reduceat(np.append(rank, _NONE), starts)
            sizes = np.diff(np.append(starts, len(row)))
            hit = (rank < _NONE) & (rank == np.repeat(lowest, sizes)[:-1])
            first = _apart(hit)
            symbols[first] = self.made[at[first]]
            keep = np.ones(len(symbols), bool)
            keep[first + 1] = False
            keep &= np.repeat(lowest < _NONE, sizes)  # rows that are done go
            left -= np.bincount(row[first], minlength=len(left))
            symbols, row = symbols[keep], row[keep]
        return left


def _apart(hit: np.ndarray) -> np.ndarray:
    """Places of a pair to merge: of places that overlap, every other from the left."""
    s, e = bounds(np.append(hit, False))
    if not len(s):
        return s
    size = (e - s + 1) // 2
    at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    return np.repeat(s, size) + 2 * at


class Counter:
    """Token counts of whole texts."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = special_tokens(self.tokenizer)
        self.merger = Merger(path)
        self.kept = Kept(lambda spans: (self.merger.counts(spans), np.ones(len(spans), np.int64)))
        letters = byte_letters()
        self.byte = {c: b for b, c in enumerate(letters)}

    def counts(self, texts: list[bytes]) -> np.ndarray:
        plain = is_plain(texts, self.special)
        cut = Cut([t if p else b"" for t, p in zip(texts, plain)])
        rows = self.kept.rows(cut.buf, cut.starts, cut.ends, cut.hashes)
        per = self.kept.values[rows]
        total = np.concatenate(([0], np.cumsum(per, dtype=np.int64)))
        out = np.diff(total[cut.first])
        for i in np.flatnonzero(~plain):
            out[i] = self._other(texts[i].decode())
        return out

    def _other(self, text: str) -> int:
        """A text that needs the library's normaliser; a special string is one token."""
        parts, n = [text], 0
        for token in (s.decode() for s in self.special):
            n += sum(p.count(token) for p in parts)
            parts = [q for p in parts for q in p.split(token)]
        spans = []
        for part in parts:
            normal = self.tokenizer.normalizer.normalize_str(part)
            for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal):
                spans.append(bytes(self.byte[c] for c in piece))
        return n + int(self.merger.counts(spans).sum())


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """Rows (doc_id, n_bytes, n_tokens, over_limit), one for each of ``docs(doc_id, text)``.

    ``path`` is a byte-level BPE file of the tokenizers library with word ends, readable
    where the executors run.  A null text is empty and has no token.  Null and repeated
    ids stay as they are; other columns are left out; no rows give no rows.
    """
    tune(docs.sparkSession)

    def run(batches):
        counter = held(("counter", path), lambda: Counter(path))
        for batch in batches:
            texts = batch.column("text").to_pylist()
            n = [counter.counts(part) for _, part in chunks(texts)]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            tokens = np.concatenate([np.empty(0, np.int64), *n])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), sizes, pa.array(tokens)], ["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("text"))
    return rows.mapInArrow(lean(run), "doc_id long, n_bytes long, n_tokens long").withColumn(
        "over_limit", F.col("n_tokens") > limit
    )
