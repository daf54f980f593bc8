"""Exact search against brute force on whole numbers."""

import math
import random

import pytest
from pyspark.sql import functions as F

from paperward.llm import topk

SCHEMA = "vec_id long, embedding array<double>, score double, rank string, row int"


def brute(rows, k, scale=1024):
    """{(query row, rank): (query_id, vec_id, score)} of rows (vec_id, vector)."""
    able = []
    for at, (i, v) in enumerate(rows):
        if i is not None and v is not None and all(x is not None and math.isfinite(x) and math.isfinite(scale * x) for x in v):
            able.append((at, i, [math.floor(scale * x) for x in v]))
    out = []
    for at, i, v in able:
        if i % 10:
            continue
        near = []
        for other, j, w in able:
            if other != at and len(w) == len(v):
                score = sum(a * b for a, b in zip(v, w))
                near.append((-max(min(score, topk._LONG), -topk._LONG), j))
        out += [(i, rank, j, -low) for rank, (low, j) in enumerate(sorted(near)[:k], 1)]
    return sorted(out)


def vectors(seed, n=150, dim=6):
    rng = random.Random(seed)
    out = [(i, [rng.uniform(-1, 1) for _ in range(dim)]) for i in range(n)]
    same = [0.25] * dim
    out += [(n + i, same) for i in range(60)]  # ties beyond k
    out += [(20, out[20][1]), (20, out[20][1]), (30, same)]  # repeated ids
    out += [(1000, None), (1010, [0.1, None] + [0.0] * (dim - 2)), (1020, [math.nan] * dim), (1030, [math.inf] * dim)]
    out += [(1040, []), (1041, []), (1050, [0.5]), (1051, [0.25]), (1060, [0.5, 0.5]), (None, same)]
    out += [(1070, [1e200] * dim), (1080, [-1e10] + [3e9] * (dim - 1)), (1071, [1e305] * dim), (-10, same), (1090, [40.0] * dim)]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("groups", [1, 3, 40])
def test_top_k(spark, seed, groups):
    rows = vectors(seed)
    df = spark.createDataFrame([(i, v, 0.5, "x", 1) for i, v in rows], SCHEMA).repartition(5)
    found = topk.top_k(df, F.col("vec_id") % 10 == 0, 4, query_bytes=600, least_groups=groups)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert dict(found.dtypes)["rank"] == "int"
    assert sorted(map(tuple, found.collect())) == brute(rows, 4)


def test_large_numbers_go_exactly():
    import numpy as np

    left = np.array([[float(1 << 40), 3.0]])
    right = np.array([[float(1 << 20), 1.0], [float(1 << 20), 2.0]])
    scores, small = topk._products(left, right)
    assert not small and scores.tolist() == [[(1 << 60) + 3, (1 << 60) + 6]]


def test_no_rows_and_no_queries(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert topk.top_k(empty, F.lit(True)).count() == 0
    few = spark.createDataFrame([(1, [0.5], 0.0, "", 1)], SCHEMA)
    assert topk.top_k(few, F.col("vec_id") == 5).count() == 0
    assert topk.top_k(few, F.lit(None).cast("boolean")).count() == 0
    assert topk.top_k(few, F.lit(True)).count() == 0


def test_groups_are_bounded_and_merged_in_a_tree(spark):
    """More lists than one node takes; the answer does not depend on the groups."""
    rows = [(i, [float(i % 7), float(i % 11)]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(40)
    many = topk.top_k(df, F.col("vec_id") % 100 == 0, 10, shard_bytes=16, least_groups=1)
    assert many.collect() and sorted(map(tuple, many.collect())) == sorted(
        map(tuple, topk.top_k(df, F.col("vec_id") % 100 == 0, 10, least_groups=1).collect())
    )
