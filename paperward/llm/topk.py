"""Exact top-k search by inner product: tiled products, partial selection, tree merging.

Vectors are turned into whole numbers, ``floor(scale * x)``, and packed: a task lays the
vectors of an Arrow batch in one shard, ordered by id, in 2 bytes a component where they
fit.  Shards are dealt to ``J`` groups and queries to ``I`` groups of a bounded number of
bytes each; every cell of the ``I x J`` grid is one group of a cogrouped task, so a shard
is copied once for each query group and a query once for each shard group, and nothing is
broadcast or collected.  The tile of queries and shard is one matrix product in doubles,
which is exact below 2^53; beyond that Python's whole numbers are used.

A tile keeps the best ``k`` of each query by one partition of ``score * columns -
column``, which settles ties by the smaller id.  What a cell keeps is a list of ``k`` for
each query; the lists are merged by a tree of ``FAN`` lists a node, keyed by the query.

Defined cases: null vectors, those with null or non-finite components or whose scaled
components leave the range of doubles, and rows without an id take no part.  Only vectors
of one length are compared; empty ones have the score 0 with each other.  Every row is a
vector of its own: repeated rows of an id are candidates of each other, and a query that
stands in several rows is answered for each.  Scores are cut to the range of a long.  No
rows give no rows; other columns are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperward.llm.shared import lean, tune
from paperward.plans.shape import materialize

#: Queries of one product, bytes of the queries and of the shards of one cell.
TILE, QUERY_BYTES, SHARD_BYTES = 512, 32 << 20, 64 << 20
LEAST_GROUPS = 32
#: Lists that one node of the merging tree takes.
FAN = 16

_SHARDS = "dim int, kind string, ids binary, rows binary, marks binary, cells binary"
_TOPS = "q long, query_id long, part int, top array<struct<low:bigint,vec_id:bigint,row:bigint>>"
_LONG = (1 << 63) - 1


def _kind(cells: np.ndarray) -> str:
    most = np.abs(cells).max(initial=0)
    return "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<f8"


def _packer(scale: float):
    def pack(batches):
        """Shards: one for each length of vector in a batch, ordered by id."""
        task, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            vectors = batch.column("embedding")
            sizes = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
            starts = np.cumsum(sizes) - sizes
            with np.errstate(invalid="ignore", over="ignore"):
                flat = np.floor(scale * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
            bad = np.zeros(len(flat) + 1, np.int64)
            np.cumsum(~np.isfinite(flat), out=bad[1:])
            able = vectors.is_valid().to_numpy(zero_copy_only=False) & (bad[starts + sizes] == bad[starts])
            ids = batch.column("vec_id").to_numpy()
            marks = batch.column("is_query").to_numpy(zero_copy_only=False).astype(np.uint8)
            rows = (task << 40) + n + np.arange(len(ids))
            n += len(ids)
            out = []
            for dim in np.unique(sizes[able]).tolist():
                mine = np.flatnonzero(able & (sizes == dim))
                mine = mine[np.argsort(ids[mine], kind="stable")]
                cells = flat[starts[mine][:, None] + np.arange(dim)]
                kind = _kind(cells)
                out.append((
                    dim, kind, ids[mine].tobytes(), rows[mine].tobytes(), marks[mine].tobytes(),
                    cells.astype(kind).tobytes(),
                ))
            yield _table(out, [pa.int32(), pa.string()] + [pa.binary()] * 4, ["dim", "kind", "ids", "rows", "marks", "cells"])

    return pack


def _table(rows: list[tuple], kinds: list, names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _cells(shard: dict) -> np.ndarray:
    return np.frombuffer(shard["cells"], shard["kind"]).reshape(len(shard["rows"]) // 8, shard["dim"])


def _queries(batches):
    """The queries of each shard, packed in the same way."""
    names = ["dim", "kind", "ids", "rows", "cells"]
    for batch in batches:
        out = []
        for shard in batch.to_pylist():
            mine = np.frombuffer(shard["marks"], np.uint8) > 0
            if mine.any():
                ids, rows = (np.frombuffer(shard[c], np.int64)[mine].tobytes() for c in ("ids", "rows"))
                cells = np.frombuffer(shard["cells"], shard["kind"]).reshape(len(mine), shard["dim"])
                out.append((shard["dim"], shard["kind"], ids, rows, cells[mine].tobytes()))
        yield _table(out, [pa.int32(), pa.string()] + [pa.binary()] * 3, names)


def _products(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, bool]:
    """Whole inner products as longs, and whether a multiple by the columns fits a long."""
    most = float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0)) * max(left.shape[1], 1)
    if most < 1 << 50:
        return (left @ right.T).astype(np.int64), True
    exact = np.array([[int(x) for x in row] for row in right.tolist()], object).reshape(right.shape)
    mine = np.array([[int(x) for x in row] for row in left.tolist()], object).reshape(left.shape)
    return np.clip(mine.dot(exact.T), -_LONG, _LONG).astype(np.int64), False


def _best_of_tile(scores: np.ndarray, small: bool, own: np.ndarray, k: int) -> np.ndarray:
    """Columns of the ``k`` highest scores of each row, earlier columns first among equals.

    ``own`` is the column of the query itself, or -1; it comes last.
    """
    n = scores.shape[1]
    held = np.flatnonzero(own >= 0)
    k = min(k, n)
    if small:
        order = scores * n - np.arange(n)
        order[held, own[held]] = -_LONG
        return np.argpartition(order, n - k, axis=1)[:, n - k :]
    mine = np.zeros(scores.shape, bool)
    mine[held, own[held]] = True
    columns = np.broadcast_to(np.arange(n), scores.shape)
    return np.lexsort((columns, -scores, mine), axis=1)[:, :k]


def _scan(k: int):
    names = ["q", "query_id", "part", "top"]

    def scan(queries: pa.Table, shards: pa.Table) -> pa.Table:
        """Best ``k`` of one group of shards for each query of one group."""
        out = []
        shards = sorted(shards.to_pylist(), key=lambda s: s["rows"])
        queries = queries.to_pylist() if shards else []
        for kind in sorted({q["kind"] for q in queries}):
            mine = [q for q in queries if q["kind"] == kind]
            ids = np.frombuffer(b"".join(q["ids"] for q in mine), np.int64)
            rows = np.frombuffer(b"".join(q["rows"] for q in mine), np.int64)
            cells = np.concatenate([_cells(q) for q in mine])
            for at in range(0, len(ids), TILE):
                tile = slice(at, at + TILE)
                out.append(_scan_tile(ids[tile], rows[tile], cells[tile].astype(np.float64), shards, k))
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.list_(_ITEM)]
        if not out:
            return pa.table([pa.array([], t) for t in kinds], names)
        return pa.concat_tables(out)

    return scan


_ITEM = pa.struct([("low", pa.int64()), ("vec_id", pa.int64()), ("row", pa.int64())])


def _scan_tile(ids, rows, cells, shards, k) -> pa.Table:
    tops = None
    for shard in shards:
        xids, xrows = (np.frombuffer(shard[c], np.int64) for c in ("ids", "rows"))
        scores, small = _products(cells, _cells(shard).astype(np.float64))
        by_row = np.argsort(xrows)
        at = by_row[np.minimum(np.searchsorted(xrows, rows, sorter=by_row), len(xrows) - 1)]
        own = np.where(xrows[at] == rows, at, -1)
        best = _best_of_tile(scores, small, own, k)
        low = -np.take_along_axis(scores, best, 1)
        gone = best == own[:, None]
        found = [gone, low, xids[best], xrows[best]]
        if tops is not None:
            found = [np.concatenate(pair, axis=1) for pair in zip(tops, found)]
        order = np.lexsort((found[3], found[2], found[1], found[0]), axis=1)[:, :k]
        tops = [np.take_along_axis(x, order, 1) for x in found]
    gone, low, vec, row = tops
    offsets = np.concatenate(([0], np.cumsum((~gone).sum(axis=1)))).astype(np.int32)
    items = pa.StructArray.from_arrays([pa.array(x[~gone]) for x in (low, vec, row)], fields=list(_ITEM))
    part = shards[0]["part"]
    return pa.table(
        [pa.array(rows), pa.array(ids), pa.array(np.full(len(ids), part, np.int32)), pa.ListArray.from_arrays(offsets, items)],
        ["q", "query_id", "part", "top"],
    )


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 10, scale: float = 1024.0,
    query_bytes: int = QUERY_BYTES, shard_bytes: int = SHARD_BYTES, least_groups: int = LEAST_GROUPS,
) -> DataFrame:
    """The ``k`` best other rows of ``vectors(vec_id, embedding)`` for each row that ``is_query`` marks.

    Rows (query_id, rank from 1, vec_id, score); equal scores go by the smaller vec_id.
    """
    tune(vectors.sparkSession)
    shards = materialize(
        vectors.where("vec_id IS NOT NULL").select(
            F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"),
            F.coalesce(is_query, F.lit(False)).alias("is_query"),
        ).mapInArrow(lean(_packer(scale)), _SHARDS)
    )
    queries = shards.mapInArrow(lean(_queries), "dim int, kind string, ids binary, rows binary, cells binary")
    queries = materialize(queries)
    size = lambda df: df.agg(F.sum(F.octet_length("cells") + F.octet_length("ids") * 2)).first()[0] or 0
    n_queries, n_shards = size(queries) // query_bytes + 1, max(size(shards) // shard_bytes + 1, least_groups)
    dealt = lambda n: F.pmod(F.xxhash64("rows"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.select("*", dealt(n_queries).alias("tile"), every(n_shards).alias("part"))
    right = shards.drop("marks").select("*", every(n_queries).alias("tile"), dealt(n_shards).alias("part"))
    keys = ["dim", "tile", "part"]
    tops = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_scan(k), _TOPS)
    return merge_tops(tops, n_shards, k).select(
        "query_id", F.posexplode("top").alias("rank", "best")
    ).select(
        "query_id", (F.col("rank") + 1).alias("rank"), "best.vec_id", (-F.col("best.low")).alias("score")
    )


def merge_tops(tops: DataFrame, parts: int, k: int) -> DataFrame:
    """One list for each query from those of ``parts`` groups, ``FAN`` lists at a time."""
    while parts > 1:
        parts = -(-parts // FAN)
        lists = F.flatten(F.collect_list("top"))
        tops = tops.groupBy("q", "query_id", F.floor(F.col("part") / FAN).cast("int").alias("part")).agg(
            F.slice(F.array_sort(lists), 1, k).alias("top")
        )
    return tops
