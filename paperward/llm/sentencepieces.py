"""SentencePiece encoding and decoding on the tokenizers library.

The model file is a protobuf message; its pieces, scores, types and normaliser settings
are read field by field.  From them a tokenizer of the other library is rebuilt:

* normaliser: the model's character map if it has one, spaces cut if it says so, then
  a space in front (the dummy prefix) and the metaspace marker U+2581 for every space;
* model: Unigram with the scores for a unigram model; for a BPE model the merges that
  its scores stand for: each piece that splits in two pieces, best score first;
* byte fallback: what no piece covers becomes the pieces of its UTF-8 bytes.

No piece of a model that is split at spaces reaches over a space into the next word, so
a text is cut before its spaces and each distinct part is encoded once: in batches, with
the library's threads.  The rebuilt tokenizer's ids are the answer.  Each distinct part is
encoded by the sentencepiece library as well, and parts whose ids differ are counted for
each text; no id is taken from there.

Decoding lays the bytes of the pieces end to end, a space for each marker.
"""

from __future__ import annotations

import os
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperward.llm.arrays import bounds, chunks, gather, hash_spans, lay
from paperward.llm.pretokens import Kept, flat, held
from paperward.llm.shared import lean, tune, utf8

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def fields(data: bytes):
    """(number, value) of each field of a protobuf message, in order."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        elif kind == 2:
            size = varint()
            yield tag >> 3, data[at : at + size]
            at += size
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            yield tag >> 3, data[at : at + size]
            at += size
        else:
            raise ValueError(f"not a model file: field kind {kind}")


class Model:
    """What a model file says."""

    def __init__(self, data: bytes):
        self.pieces: list[tuple[str, float, int]] = []
        self.kind, self.byte_fallback, self.unk = UNIGRAM, False, 0
        self.charsmap, self.dummy_prefix, self.cut_spaces, self.escape = b"", True, True, True
        self.suffix = False
        for number, value in fields(data):
            if number == 1:
                got = dict(fields(value))
                score = struct.unpack("<f", got[2])[0] if 2 in got else 0.0
                self.pieces.append((got.get(1, b"").decode(), score, got.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(fields(value))
                self.kind = trainer.get(3, UNIGRAM)
                self.suffix = bool(trainer.get(24, 0))
                self.byte_fallback = bool(trainer.get(35, 0))
                self.unk = trainer.get(40, 0)
            elif number == 3:
                normal = dict(fields(value))
                self.charsmap = normal.get(2, b"")
                self.dummy_prefix = bool(normal.get(3, 1))
                self.cut_spaces = bool(normal.get(4, 1))
                self.escape = bool(normal.get(5, 1))
        if self.kind not in (UNIGRAM, BPE) or self.suffix or not self.escape:
            raise ValueError("only unigram and BPE models with a marker before words")

    def merges(self) -> list[tuple[str, str]]:
        """Every way to join two pieces to a third, best score of the third first."""
        usable = {p: (-s, i) for i, (p, s, t) in enumerate(self.pieces) if t in (NORMAL, USER)}
        found = []
        for piece, rank in usable.items():
            ways = [
                (piece[:i], piece[i:]) for i in range(1, len(piece))
                if piece[:i] in usable and piece[i:] in usable
            ]
            found += [(rank, usable[a], usable[b], a, b) for a, b in ways]
        return [(a, b) for *_, a, b in sorted(found)]

    def tokenizer(self, prefix: bool | None = None):
        """The same model for the tokenizers library; ``prefix`` overrides the dummy prefix."""
        from tokenizers import Regex, Tokenizer, decoders, models, normalizers

        if self.kind == UNIGRAM:
            model = models.Unigram([(p, s) for p, s, _ in self.pieces], self.unk, self.byte_fallback)
        else:
            model = models.BPE(
                {p: i for i, (p, _, _) in enumerate(self.pieces)}, self.merges(),
                unk_token=self.pieces[self.unk][0], fuse_unk=True, byte_fallback=self.byte_fallback,
            )
        steps = [normalizers.Precompiled(self.charsmap)] if self.charsmap else []
        if self.cut_spaces:
            steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
        if self.dummy_prefix if prefix is None else prefix:
            steps.append(normalizers.Prepend(MARK))
        out = Tokenizer(model)
        out.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", MARK)])
        cut = [decoders.Strip(" ", 1, 0)] if self.dummy_prefix else []
        out.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *cut])
        return out

    def piece_bytes(self) -> tuple[np.ndarray, np.ndarray]:
        """What each id stands for in a text, laid end to end, and the offsets."""
        out = []
        for piece, _, kind in self.pieces:
            if kind == BYTE:
                out.append(bytes([int(piece[1:-1], 16)]))
            elif kind == CONTROL:
                out.append(b"")
            elif kind == UNKNOWN:
                out.append(" ⁇ ".encode())
            else:
                out.append(piece.replace(MARK, " ").encode())
        return np.frombuffer(b"".join(out), np.uint8), np.cumsum([0, *map(len, out)])


class Codec:
    """Encodes and decodes whole texts."""

    def __init__(self, path: str):
        import sentencepiece

        with open(path, "rb") as f:
            data = f.read()
        self.model = Model(data)
        self.whole = self.model.tokenizer()
        self.part = self.model.tokenizer(prefix=False)
        self.other = sentencepiece.SentencePieceProcessor(model_proto=data)
        #: A text may be cut before spaces and around line ends.
        inner = [p for p, _, t in self.model.pieces if t == NORMAL and len(p) > 1]
        plain = not self.model.charsmap and not self.model.cut_spaces and self.model.dummy_prefix
        self.cuts = plain and not any("\n" in p or MARK in p.lstrip(MARK) for p in inner)
        self.kept = Kept(self._encode)
        self.bytes, self.offsets = self.model.piece_bytes()
        self.differ: set[bytes] = set()

    def _checked(self, tokenizer, texts: list[str], prefixed: bool) -> list[list[int]]:
        """Ids of the rebuilt tokenizer; parts for which the other library's differ are noted."""
        found = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
        # The library puts its own space in front, so a part goes in without the one it has.
        right = self.other.encode([t[1:] if prefixed else t for t in texts], num_threads=1)
        for i, (a, b) in enumerate(zip(found, right)):
            # One space is the prefix of an empty text, of which nothing is encoded.
            if a != b and not (prefixed and texts[i] == " "):
                self.differ.add(texts[i].encode())
        return found

    def _encode(self, spans: list[bytes]):
        """Parts with a space in front; others are what follows a line end."""
        texts = [s.decode() for s in spans]
        out: list[list[int]] = [[]] * len(texts)
        opened = [i for i, t in enumerate(texts) if t.startswith(" ")]
        for i, ids in zip(opened, self._checked(self.part, [texts[i] for i in opened], True)):
            out[i] = ids
        rest = [i for i, t in enumerate(texts) if not t.startswith(" ")]
        # After a line end no space may be put in front, which the other library always
        # does: the line end goes before the part, and its ids are taken off again.
        lead = self.other.encode("\n")
        found = [e.ids for e in self.part.encode_batch([texts[i] for i in rest], add_special_tokens=False)]
        right = self.other.encode(["\n" + texts[i] for i in rest], num_threads=1)
        for i, a, b in zip(rest, found, right):
            if a != b[len(lead) :]:
                self.differ.add(spans[i])
            out[i] = a
        return flat(out)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids laid end to end, offsets of the texts, and how many parts differed in each."""
        mark = MARK.encode()
        alone = [not self.cuts or mark in t for t in texts]
        buf, at = lay([b"" if a or not t else b" " + t for a, t in zip(alone, texts)])
        space, line = buf == 32, buf == 10
        start = np.zeros(len(buf), bool)
        start[1:] = (space[1:] & ~space[:-1]) | line[1:] | line[:-1]
        if len(buf):
            start[0] = True
        start[at[1:] - 1] = False  # the line ends between texts are no part of any
        starts = np.flatnonzero(start)
        ends = np.append(starts[1:], len(buf))
        stops = at[1:] - 1
        ends = np.minimum(ends, stops[np.searchsorted(stops, starts)]) if len(starts) else ends[:0]
        keep = ends > starts
        starts, ends = starts[keep], ends[keep]
        hashes = hash_spans(buf, starts, ends)
        rows = self.kept.rows(buf, starts, ends, hashes)
        ids, offsets = self.kept.gathered(rows)
        first = np.searchsorted(starts, at)
        edges = offsets[first]
        differ = np.zeros(len(texts), np.int64)
        if self.differ:
            data = buf.tobytes()
            odd = np.array([data[s:e] in self.differ for s, e in zip(starts, ends)], np.int64)
            differ = np.diff(np.concatenate(([0], np.cumsum(odd)))[first])
        if any(a and t for a, t in zip(alone, texts)):
            split = [ids[s:e] for s, e in zip(edges, edges[1:])]
            for i, (a, t) in enumerate(zip(alone, texts)):
                if a and t:
                    before = len(self.differ)
                    self.differ.discard(t)
                    split[i] = np.array(self._checked(self.whole, [t.decode()], False)[0], np.int32)
                    differ[i] = t in self.differ
                    self.differ.discard(t)
            ids = np.concatenate(split)
            edges = np.cumsum([0, *map(len, split)])
        return ids, edges, differ

    def decode(self, ids: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes of the texts laid end to end, without the dummy prefix, and offsets."""
        data, offsets = gather(self.bytes, self.offsets, ids)
        return data, offsets[edges]


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """Each row of ``docs(doc_id, text)`` encoded, decoded and compared.

    Gives doc_id, n_bytes, n_tokens, n_bytes_fallback (ids of single bytes), ids_crc32
    (unsigned, ids as little-endian unsigned 32-bit numbers), ids, ``round_trip`` (the
    ids decode to the text again) and ``n_unlike`` (parts for which the sentencepiece
    library gives other ids than the rebuilt tokenizer, whose ids these are).  A null
    or empty text has no ids.  Null and repeated ids stay as they are; other columns are
    left out; no rows give no rows.
    """
    tune(docs.sparkSession)
    names = ["doc_id", "n_bytes", "n_tokens", "n_byte_tokens", "ids_crc32", "ids", "round_trip", "n_unlike"]

    def run(batches):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
        codec = held(("codec", path), lambda: Codec(path))
        is_byte = np.array([t == BYTE for _, _, t in codec.model.pieces])
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            for first, texts in chunks(batch.column("text").to_pylist()):
                ids, edges, differ = codec.encode(texts)
                data, ends = codec.decode(ids, edges)
                single = np.concatenate(([0], np.cumsum(is_byte[ids])))
                prefix = b" " if codec.model.dummy_prefix else b""
                rows = [
                    (ids[a:b].astype("<u4"), data[s:e].tobytes() == prefix + t if t else s == e)
                    for a, b, s, e, t in zip(edges, edges[1:], ends, ends[1:], texts)
                ]
                arrays = [
                    pa.array(doc_ids[first : first + len(texts)], pa.int64()),
                    pa.array([len(t) for t in texts], pa.int64()), pa.array(np.diff(edges), pa.int64()),
                    pa.array(np.diff(single[edges]), pa.int64()),
                    pa.array([zlib.crc32(r.tobytes()) for r, _ in rows], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(ids, pa.int32())),
                    pa.array([bool(ok) for _, ok in rows], pa.bool_()), pa.array(differ, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("text"))
    return rows.mapInArrow(
        lean(run), "doc_id long, n_bytes long, n_tokens long, n_byte_tokens long, ids_crc32 long, ids array<int>,"
        " round_trip boolean, n_unlike long",
    )
