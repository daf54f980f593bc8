"""Near-equal embeddings: sign hashes of random hyperplanes, exact cosines, components.

Vectors are compared only inside one label and one length.  Equal vectors are first
joined into one class with a count, so a group of exact copies, however large, is one
row.  Every class then gets, in each of ``TABLES`` hash tables, the ``BITS`` signs of
its products with random hyperplanes, and meets those with the same signs.  What meets
is checked by the cosine in double precision.  Two unit vectors at the threshold of
0.93 agree in one sign with probability 0.88, in all 12 of a table with 0.215, and so
meet in one of 24 tables at least with 0.997; closer ones meet more surely.

A pair that meets in several tables counts in the first of them, which both rows can
tell from their signs alone, so counts per row add up over tables and no pair is ever
written out.  Large buckets are cut in blocks of ``BLOCK`` rows, and each pair of blocks
is a task's work: a row is copied once for each other block, and a block gives a count
per row and a spanning forest of its links.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperward.llm.shared import components, tune
from paperward.plans.shape import materialize

BITS, TABLES, SEED = 12, 24, 7
#: Rows of one side of a comparison.
BLOCK = 1500


def planes(dim: int, bits: int, tables: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, bits * tables))


def sign_codes(vectors: np.ndarray, bits: int, tables: int, seed: int) -> np.ndarray:
    """One code of ``bits`` signs per row and table."""
    signs = vectors @ planes(vectors.shape[1], bits, tables, seed) >= 0
    return signs.reshape(len(vectors), tables, bits) @ (1 << np.arange(bits, dtype=np.int64))


class Forest:
    """Union-find over 0..n-1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def spanning(links: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of a boolean link matrix, breadth first."""
    n, todo, out = len(links), np.ones(len(links), bool), []
    for first in range(n):
        if not todo[first]:
            continue
        todo[first] = False
        front = [first]
        while front:
            i = front.pop()
            near = np.flatnonzero(links[i] & todo)
            todo[near] = False
            front.extend(near.tolist())
            out += [(i, int(j)) for j in near]
    return out


def _digests(batches):
    """Key of each vector and its bytes as doubles; null for rows that can't link."""
    for batch in batches:
        keys, raws = [], []
        vectors = batch.column("embedding").to_pylist()
        for able, vector in zip(batch.column("able").to_pylist(), vectors):
            keys.append(None)
            raws.append(None)
            if not able or not vector or any(x is None for x in vector):
                continue
            array = np.asarray(vector, np.float64) + 0.0  # -0.0 counts as 0.0
            if np.isfinite(array).all() and array.any():
                raws[-1] = array.tobytes()
                keys[-1] = hashlib.blake2b(raws[-1], digest_size=16).digest()
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), batch.column("label"), pa.array(keys, pa.binary()), pa.array(raws, pa.binary())],
            ["vec_id", "label", "key", "raw"],
        )


def _unit(raws) -> np.ndarray:
    vectors = np.frombuffer(b"".join(raws), np.float64).reshape(len(raws), -1)
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # no overflow in squares
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _coder(bits: int, tables: int, seed: int):
    def codes(batches):
        for batch in batches:
            raws = batch.column("raw").to_pylist()
            out = [b""] * len(raws)
            by_size: dict[int, list[int]] = {}
            for i, raw in enumerate(raws):
                by_size.setdefault(len(raw), []).append(i)
            for members in by_size.values():
                rows = sign_codes(_unit([raws[i] for i in members]), bits, tables, seed)
                for i, row in zip(members, rows.astype("<i8")):
                    out[i] = row.tobytes()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(out, pa.binary())], [*batch.schema.names, "codes"]
            )

    return codes


def _links(unit: np.ndarray, earlier: np.ndarray, sides: np.ndarray | None, threshold: float) -> np.ndarray:
    """Which rows of a bucket link and met in none of the earlier tables."""
    cosine = unit @ unit.T
    links = cosine >= threshold
    # A product next to the threshold is worked out again, with one rounding.
    for i, j in zip(*np.nonzero(np.abs(cosine - threshold) < 1e-12)):
        links[i, j] = math.fsum(unit[i] * unit[j]) >= threshold
    np.fill_diagonal(links, False)
    if sides is not None:
        links &= sides[:, None] != sides[None, :]
    for i in np.flatnonzero(links.any(axis=1)):
        near = np.flatnonzero(links[i])
        links[i, near[(earlier[near] == earlier[i]).any(axis=1)]] = False
    return links


def _compare(threshold: float):
    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        """Counts per row and forests of links of all buckets in one group of buckets."""
        rows = rows.sort_values("bucket", kind="stable")
        bucket, ids, copies = (rows[c].to_numpy() for c in ("bucket", "id", "copies"))
        table, across, side = (rows[c].to_numpy() for c in ("tab", "across", "block"))
        raws, codes = rows["raw"].tolist(), rows["codes"].tolist()
        cuts = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1).tolist(), len(rows)]
        counted, counts, ends = [], [], []
        for s, e in zip(cuts, cuts[1:]):
            if e - s < 2:
                continue
            earlier = np.frombuffer(b"".join(codes[s:e]), "<i8").reshape(e - s, -1)[:, : table[s]]
            links = _links(_unit(raws[s:e]), earlier, side[s:e] if across[s] else None, threshold)
            if not links.any():
                continue
            n = links @ copies[s:e]
            counted.append(ids[s:e][n > 0])
            counts.append(n[n > 0])
            ends += [(ids[s + i], ids[s + j]) for i, j in spanning(links)]
        counted, counts = (np.concatenate([*x, np.empty(0, np.int64)]) for x in (counted, counts))
        return pd.DataFrame({
            "id": np.concatenate([counted, np.array([i for i, _ in ends], np.int64)]),
            "other": pd.array([None] * len(counted) + [int(j) for _, j in ends], "Int64"),
            "n": np.concatenate([counts, np.zeros(len(ends), np.int64)]),
        })

    return compare


def near_duplicates(
    vectors: DataFrame, threshold: float = 0.93, bits: int = BITS, tables: int = TABLES,
    seed: int = SEED, block: int = BLOCK,
) -> DataFrame:
    """``vectors(vec_id, embedding, label)`` with ``n_links``, ``component_id``, ``kept``.

    A vector links with others of its label whose cosine with it reaches the
    threshold.  Null, empty and zero vectors, those with null or non-finite parts, and
    rows without a label or an id link with nothing and are their own component.  Rows
    with one id stand for one node of the links, and each counts as a row.  No rows
    give no rows; other columns are left out.
    """
    spark = vectors.sparkSession
    tune(spark)
    able = F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    keyed = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"), able.alias("able"),
    ).mapInArrow(_digests, "vec_id long, label string, key binary, raw binary")
    keyed = materialize(keyed)
    classes = materialize(
        keyed.where("key IS NOT NULL").groupBy("label", "key")
        .agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"), F.first("raw").alias("raw"))
        .withColumn("id", F.monotonically_increasing_id())
    )
    found = _met_pairs(classes, threshold, bits, tables, seed, block)
    counts = found.groupBy("id").agg(F.sum("n").alias("n"))
    named = classes.select("id", F.col("first").alias("node"))
    links = (
        found.where("other IS NOT NULL").select("id", "other")
        .join(named.withColumnRenamed("node", "u"), "id")
        .join(named.select(F.col("id").alias("other"), F.col("node").alias("v")), "other")
        .select("u", "v")
    )
    answers = classes.join(counts, "id", "left").select(
        "label", "key", "first", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    rows = materialize(keyed.drop("raw").join(answers, ["label", "key"], "left"))
    same = rows.where("first <> vec_id").select(F.col("first").alias("u"), F.col("vec_id").alias("v"))
    groups = components(links.unionByName(same)).select(
        F.col("node").alias("vec_id"), F.col("component").alias("component_id")
    )
    component = F.coalesce("component_id", "vec_id")
    return rows.join(groups, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


def _met_pairs(
    classes: DataFrame, threshold: float, bits: int, tables: int, seed: int, block: int
) -> DataFrame:
    """Rows (id, null, count of linked rows) and (id, other, 0) of a forest of links."""
    coded = classes.mapInArrow(
        _coder(bits, tables, seed),
        "label string, key binary, first long, copies long, raw binary, id long, codes binary",
    ).select("id", "label", "copies", "raw", "codes", F.octet_length("raw").alias("dim"))
    met = coded.select("*", F.explode(F.sequence(F.lit(0), F.lit(tables - 1))).alias("tab")).withColumn(
        "code", F.expr("substring(codes, tab * 8 + 1, 8)")
    )
    bucket = ["label", "dim", "tab", "code"]
    sizes = materialize(
        met.groupBy(*bucket).agg(F.count("*").alias("_n")).where("_n > 1")
        .select(*bucket, "_n", F.ceil(F.col("_n") / block).cast("long").alias("blocks"))
    )
    # Groups of buckets: about four blocks' rows each, a row once for each other block.
    n_rows = sizes.agg(F.sum(F.col("_n") * F.col("blocks"))).first()[0] or 0
    groups = n_rows // (4 * block) + 1
    met = met.join(sizes.drop("_n"), bucket).withColumn("block", F.pmod(F.xxhash64("id"), "blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("_o")
    met = met.select("*", other).select(
        "id", "copies", "raw", "codes", "tab", "block", (F.col("_o") != F.col("block")).alias("across"),
        F.xxhash64(*bucket, F.least("_o", "block"), F.greatest("_o", "block")).alias("bucket"),
    )
    met = met.groupBy(F.pmod("bucket", F.lit(groups)).alias("_g")).applyInPandas(
        _compare(threshold), "id long, other long, n long"
    )
    return materialize(met.groupBy("id", "other").agg(F.sum("n").alias("n")))
