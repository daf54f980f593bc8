"""Documents as sequences of at most 2048 tokens, by first-fit decreasing.

Documents are cut every ``LENGTH`` tokens; only a last piece is shorter.  Pieces are
dealt at random to groups of about ``GROUP`` pieces, which are packed independently: in
order of falling length, each piece goes to the first sequence that still has room.  A
tournament tree over the room of the sequences finds it in as many steps as the tree is
high: each node holds the largest room below it, and the search goes left where it can.

Token ids stay where they are made; what is shuffled is a row of numbers for a piece.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperward.llm.arrays import chunks
from paperward.llm.pretokens import Encoder, held
from paperward.llm.shared import lean, tune, utf8
from paperward.plans.shape import materialize

LENGTH = 2048
#: Pieces of a group; a group leaves about one sequence half empty.
GROUP = 4096
#: Token that ends a document.
END = 1


def first_fit(lengths: list[int], capacity: int) -> list[int]:
    """For each length, in this order, the first bin with room, by a tournament tree."""
    leaves = 1
    while leaves < len(lengths):
        leaves *= 2
    room = [capacity] * (2 * leaves)
    out = []
    for length in lengths:
        node = 1
        while node < leaves:
            node *= 2
            if room[node] < length:
                node += 1
        out.append(node - leaves)
        room[node] -= length
        while node > 1:
            node //= 2
            left, right = room[2 * node], room[2 * node + 1]
            room[node] = left if left >= right else right
    return out


def pack_group(rows: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Add ``bin`` and ``offset`` to the pieces of a group; ties go by ``_row``."""
    rows = rows.sort_values(["length", "_row"], ascending=[False, True])
    bins = first_fit(rows["length"].tolist(), capacity)
    length = rows["length"]
    offset = length.groupby(np.array(bins, np.int64)).cumsum() - length if len(rows) else length
    return rows.assign(bin=bins, offset=offset)


def pieces(docs: DataFrame, path: str, capacity: int = LENGTH, end: int = END) -> DataFrame:
    """Rows (doc_id, start, length, ids_crc32, doc_tokens) of the pieces of all documents.

    A document's ids are those of the library with ``end`` after them.
    """
    tune(docs.sparkSession)
    kinds = {"doc_id": "long", "start": "long", "length": "long", "ids_crc32": "long", "doc_tokens": "long"}

    def run(batches):
        encoder = held(("encoder", path), lambda: Encoder(path))
        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            for first, texts in chunks(batch.column("text").to_pylist()):
                out: list[list] = [[] for _ in kinds]
                for name, ids in zip(names[first:], encoder.ids(texts)):
                    ids = np.append(ids, end).astype("<u4")
                    for start in range(0, len(ids), capacity):
                        part = ids[start : start + capacity]
                        for held_, x in zip(out, (name, start, len(part), zlib.crc32(part.tobytes()), len(ids))):
                            held_.append(x)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], list(kinds))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("text"))
    return rows.mapInArrow(lean(run), ", ".join(f"{k} {v}" for k, v in kinds.items()))


def pack(cut: DataFrame, capacity: int = LENGTH, group: int = GROUP) -> DataFrame:
    """``cut`` with ``sequence_id`` and ``offset``; ``length`` is at most ``capacity``.

    Other columns stay, and may hold the ids themselves.  Pieces that agree in all
    columns are packed each by itself.  No rows give no rows.
    """
    cut = materialize(cut.withColumn("_row", F.monotonically_increasing_id()))
    groups = cut.count() // group + 1
    dealt = cut.select(
        "_row", F.col("length").cast("int").alias("length"), F.pmod(F.xxhash64("_row", F.lit(17)), F.lit(groups)).alias("_group")
    )

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        packed = pack_group(rows, capacity)
        sequence = packed["_group"].astype("int64") * 2**32 + packed["bin"]
        return pd.DataFrame({"_row": packed["_row"], "sequence_id": sequence, "offset": packed["offset"].astype("int64")})

    placed = dealt.groupBy("_group").applyInPandas(run, "_row long, sequence_id long, offset long")
    return cut.join(placed, "_row").drop("_row")


def pack_documents(docs: DataFrame, path: str, capacity: int = LENGTH, group: int = GROUP) -> DataFrame:
    """Pieces of all documents with their sequence and place in it.

    A null or empty text is a piece of the end token alone.  Null and repeated ids stay
    as they are; other columns are left out; no rows give no rows.
    """
    return pack(pieces(docs, path, capacity), capacity, group)
