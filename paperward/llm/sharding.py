"""Shards of near equal bytes by Karmarkar-Karp differencing.

Rows with equal keys (here: equal texts) form a group that may not be split.  Spark
sums the bytes of every group.  A group holding at least ``1 / LUMPS`` of all bytes
is an item of its own, of which there can be at most ``LUMPS``; the others are
added up by hash in ``LUMPS`` lumps, each small beside a shard.  So the differencing
sees at most ``2 * LUMPS`` items whatever the size of the input, and its answer
goes back to the groups as a table of that bound.

Differencing: every item starts as a partial partition with one filled shard.  The
two partial partitions of largest spread are combined, the fullest shard of one with
the emptiest of the other, until one is left.  What one step leaves uneven the next
levels, which keeps the shards far closer than dealing the items out one by one.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperward.plans.shape import materialize

LUMPS = 8192
#: Rows that one window of the slot numbering holds on average.
RUN = 4096


def difference(sizes: np.ndarray, k: int) -> np.ndarray:
    """Shard 0..k-1 of each item, by k-way differencing; no items give none.

    Ties go by the order of the items, so the answer is a function of the sizes.
    """
    n = len(sizes)
    if n == 0:
        return np.empty(0, np.int64)
    # Node i < n is an item; a combined node remembers its two parts and the order
    # in which their shards, both sorted from fullest to emptiest, were paired.
    sums: list = [(int(s), *([0] * (k - 1))) for s in sizes]
    parts: list = [None] * n
    heap = [(-int(s), i) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        joined = [x + y for x, y in zip(sums[a], reversed(sums[b]))]
        order = sorted(range(k), key=lambda j: -joined[j])
        sums[a] = sums[b] = None
        sums.append(tuple(joined[j] for j in order))
        parts.append((a, b, order))
        top = sums[-1]
        heapq.heappush(heap, (top[-1] - top[0], len(sums) - 1))
    shard = np.zeros(n, np.int64)
    open_nodes = [(heap[0][1], list(range(k)))]
    while open_nodes:
        node, where = open_nodes.pop()  # where[j]: final shard of its j-th fullest
        if parts[node] is None:
            shard[node] = where[0]
            continue
        a, b, order = parts[node]
        left, right = [0] * k, [0] * k
        for place, j in enumerate(order):
            left[j], right[k - 1 - j] = where[place], where[place]
        open_nodes += [(a, left), (b, right)]
    return shard


def shard_by_bytes(
    rows: DataFrame, group: str, size: str, order: list[str], shards: int = 8, lumps: int = LUMPS
) -> DataFrame:
    """``rows`` with ``shard`` int and ``slot`` long, all rows of a group in one shard.

    ``group`` is a key column (nulls form one group), ``size`` the bytes of a row, a
    long of at least 0.  ``slot`` numbers the rows of a shard from 0 without gaps;
    rows that agree in all of ``order`` and in the group may take each other's place.
    No rows give no rows.  A group larger than a fair shard makes its shard that
    much larger, as it can't be split.
    """
    key = F.coalesce(F.xxhash64(group), F.lit(0))
    keyed = rows.withColumn("_key", key)
    groups = keyed.groupBy("_key").agg(F.sum(size).alias("_bytes"))
    groups = materialize(groups)
    total = groups.agg(F.sum("_bytes")).first()[0] or 0
    large = F.col("_bytes") * lumps >= F.lit(max(1, total))
    groups = groups.withColumn(
        "_item", F.when(large, F.col("_key")).otherwise(F.pmod("_key", F.lit(lumps)))
    ).withColumn("_large", large)
    items = (
        groups.groupBy("_large", "_item").agg(F.sum("_bytes").alias("_bytes"))
        .toPandas().sort_values(["_bytes", "_large", "_item"], ascending=False)
    )
    items["_shard"] = difference(items["_bytes"].to_numpy(np.int64), shards)
    spark = rows.sparkSession
    answer = spark.createDataFrame(
        list(zip(items["_large"].tolist(), items["_item"].tolist(), items["_shard"].tolist())),
        "_large boolean, _item long, shard int",
    )
    # At most 2 * lumps rows of 13 bytes.
    placed = groups.join(F.broadcast(answer), ["_large", "_item"]).select("_key", "shard")
    return number_slots(keyed.join(placed, "_key").drop("_key"), "shard", [*order, group])


def number_slots(rows: DataFrame, shard: str, order: list[str]) -> DataFrame:
    """Add ``slot``: a gapless number from 0 within each shard.

    The rows of a shard are dealt to runs by hash; a run is numbered by itself, and
    starts where the runs before it end.
    """
    rows = materialize(rows)
    runs = max(1, rows.count() // RUN // 8)
    run = F.pmod(F.xxhash64(*order), F.lit(runs))
    rows = rows.withColumn("_run", run)
    before = Window.partitionBy(shard).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy(shard, "_run").agg(F.count("*").alias("_n"))
        .select(shard, "_run", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    inside = Window.partitionBy(shard, "_run").orderBy(*order)
    numbered = rows.withColumn("_in", F.row_number().over(inside))
    return (
        numbered.join(starts, [shard, "_run"])
        .withColumn("slot", (F.col("_start") + F.col("_in") - 1).cast("long"))
        .drop("_run", "_in", "_start")
    )
