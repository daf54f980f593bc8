"""Exchange of hashed word runs in packed blobs.

A corpus has about as many word runs as words.  As rows of their own they would be
shuffled with far more bytes than the texts have.  So a task packs the runs of a batch
of texts, for each target group, in one blob: the owners in it, how many runs each has
here, and the runs' fingerprints, a few bytes each.  Spark partitions and shuffles the
blobs by group; a group sees every run that falls in it.

Groups are sized by the corpus: about ``GROUP_RUNS`` runs each.  A run that is found in
more than ``HOT_RUNS`` texts would make its group too large.  Where there are that many
texts at all, such runs are found from a sample (only the balance rests on it, not the
answer) and handed to the caller, who answers them where they stand.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperward.llm.arrays import Words, chunks
from paperward.llm.shared import utf8

GROUP_RUNS = 3_000_000
LEAST_GROUPS = 32
HOT_RUNS = 1_000_000
#: How often a hot run turns up in the sample on average.
SAMPLE_HITS = 64

BLOBS = "grp int, owners binary, counts binary, prints binary"


def group_count(docs: DataFrame, group_runs: int = GROUP_RUNS) -> int:
    """A power of two, from the bytes of all texts at about six for each word."""
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    groups = LEAST_GROUPS
    while groups * group_runs < size // 6:
        groups *= 2
    return groups


def hot_runs(docs: DataFrame, k: int, lower: bool, limit: int = HOT_RUNS) -> np.ndarray:
    """Fingerprints of the runs of ``k`` words that more than ``limit`` rows hold.

    No run can have more rows than the table.  Beyond that the sample is
    ``SAMPLE_HITS / limit`` of the rows; a run counts as hot at half the expected hits,
    so at most ``2 / SAMPLE_HITS`` of the sampled runs, summed up by Spark, come back.
    """
    if docs.count() <= limit:
        return np.empty(0, np.uint64)

    def sampled(batches):
        for batch in batches:
            for _, texts in chunks(batch.column(0).to_pylist()):
                prints, text, _ = Words(texts, lower).windows(k)
                found = np.unique(np.stack([prints, text.astype(np.uint64)]), axis=1)[0]
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], ["print"])

    rows = docs.where(F.rand(11) < SAMPLE_HITS / limit).select(utf8())
    hot = (
        rows.mapInArrow(sampled, "print long").groupBy("print").count()
        .where(F.col("count") * 2 >= SAMPLE_HITS).select("print").toPandas()
    )
    return np.sort(hot["print"].to_numpy(np.int64).view(np.uint64))


def is_in(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values


def pack(prints: np.ndarray, width: int) -> bytes:
    """The low ``width`` (4, 5, 7 or 8) bytes of each fingerprint, byte planes apart."""
    if width == 8:
        return prints.tobytes()
    if width == 4:
        return prints.astype(np.uint32).tobytes()
    parts = [prints.astype(np.uint32).tobytes()]
    if width == 7:
        parts.append((prints >> np.uint64(32)).astype(np.uint16).tobytes())
    parts.append((prints >> np.uint64(8 * width - 8)).astype(np.uint8).tobytes())
    return b"".join(parts)


def unpack(data: bytes, width: int) -> np.ndarray:
    if width == 8:
        return np.frombuffer(data, np.uint64)
    if width == 4:
        return np.frombuffer(data, np.uint32).astype(np.uint64)
    n = len(data) // width
    out = np.frombuffer(data, np.uint32, n).astype(np.uint64)
    if width == 7:
        out |= np.frombuffer(data, np.uint16, n, 4 * n).astype(np.uint64) << np.uint64(32)
    return out | np.frombuffer(data, np.uint8, n, (width - 1) * n).astype(np.uint64) << np.uint64(8 * width - 8)


def thinned(values: np.ndarray, steps: bool) -> bytes:
    """Numbers (or the steps between them) as byte planes, most of which are zero and compress away."""
    values = np.diff(values, prepend=values.dtype.type(0)) if steps else values
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def thickened(data: bytes, kind, steps: bool) -> np.ndarray:
    size = np.dtype(kind).itemsize
    values = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()
    return np.cumsum(values, dtype=kind) if steps else values


def blobs(groups: np.ndarray, owners: np.ndarray, prints: np.ndarray, width: int, thin: bool = False) -> pa.RecordBatch:
    """Rows of ``BLOBS``; runs of one owner must stand together.

    ``prints`` may have several rows of fingerprints, which are packed one after the other.
    If ``thin``, owners and counts are written to be compressed.
    """
    order = np.argsort(groups.astype(np.uint16) if groups.max(initial=0) < 1 << 16 else groups, kind="stable")
    groups, owners, prints = groups[order], owners[order], prints[..., order]
    cuts = np.flatnonzero(np.concatenate(([True], groups[1:] != groups[:-1]))) if len(groups) else []
    columns: list[list] = [[], [], [], []]
    for s, e in zip(cuts, [*cuts[1:], len(groups)]):
        mine = owners[s:e]
        at = np.flatnonzero(np.concatenate(([True], mine[1:] != mine[:-1])))
        columns[0].append(int(groups[s]))
        whose, counts = mine[at].astype(np.int64), np.diff(np.append(at, e - s)).astype(np.uint32)
        columns[1].append(thinned(whose, True) if thin else whose.tobytes())
        columns[2].append(thinned(counts, False) if thin else counts.tobytes())
        columns[3].append(pack(prints[..., s:e].ravel(), width))
    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], ["grp", "owners", "counts", "prints"]
    )


def owners_of_group(rows, thin: bool = False) -> np.ndarray:
    """Owner of every run in the blobs of one group."""
    if thin:
        held = [(thickened(o, np.int64, True), thickened(c, np.uint32, False)) for o, c in zip(rows["owners"], rows["counts"])]
    else:
        held = [(np.frombuffer(o, np.int64), np.frombuffer(c, np.uint32)) for o, c in zip(rows["owners"], rows["counts"])]
    return np.concatenate([np.repeat(o, c) for o, c in held])


def runs_of_group(rows, width: int, thin: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Owner and fingerprint of every run in the blobs of one group."""
    return owners_of_group(rows, thin), np.concatenate([unpack(p, width) for p in rows["prints"]])
