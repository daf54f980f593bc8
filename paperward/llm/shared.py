"""Small Spark helpers of this subpackage."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperward.plans.shape import materialize


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top = Path(__file__).resolve().parent.parent
    # Spark's own file server hands this small file out for as long as the driver lives.
    archive = f"{tempfile.mkdtemp(prefix=top.name)}/{top.name}-{context.applicationId}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(top.rglob("*.py")):
            out.write(path, path.relative_to(top.parent))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def tune(spark: SparkSession) -> None:
    """Ship the package; keep Arrow batches small, as texts can be long."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4000")


def give_back() -> None:
    """Return freed memory to the system, so that a worker which waits holds little."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def lean(run):
    """A function over Arrow batches that gives memory back when it is through."""

    def through(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return through


def lean_group(run):
    """The same for a function of one group."""

    def through(table):
        out = run(table)
        del table
        give_back()
        return out

    return through


def utf8(text: str = "text") -> Column:
    return F.coalesce(F.col(text), F.lit("")).cast("binary")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(u, v)`` of longs: rows (node, component).

    ``component`` is the smallest node reachable.  Nodes go by a 64-bit hash, which is
    one to one on longs and puts them in a random order.  Each round every node takes the
    first in that order among itself and its neighbours, follows that choice four steps,
    and the graph is contracted to the choices.  In a random order few chains of choices
    are longer, so a round leaves less than half of the nodes that still have an edge,
    also on long paths, and the rounds grow with the logarithm of the size.  Only sums
    per node and equi-joins are shuffled; nothing is collected.  Nodes in no edge, and
    edges with a null end, give no row.
    """
    edges = edges.where("u IS NOT NULL AND v IS NOT NULL")
    edges = materialize(edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    nodes = edges.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    left = materialize(edges.where("u <> v").select(F.xxhash64("u").alias("u"), F.xxhash64("v").alias("v")))
    labels = None
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("v").alias("u"), F.col("u").alias("v")))
        to = materialize(both.groupBy(F.col("u").alias("key")).agg(F.min("v").alias("to")).select(
            "key", F.least("key", "to").alias("to")
        ))
        for _ in range(2):
            up = to.select(F.col("key").alias("to"), F.col("to").alias("next"))
            to = to.join(up, "to").select("key", F.col("next").alias("to"))
        to = materialize(to)
        if labels is None:
            labels = to.select("key", F.col("to").alias("label"))
        else:
            step = to.select(F.col("key").alias("label"), F.col("to").alias("_next"))
            labels = materialize(
                labels.join(step, "label", "left").select("key", F.coalesce("_next", "label").alias("label"))
            )
        ends = [to.select(F.col("key").alias(x), F.col("to").alias(x + "2")) for x in "uv"]
        moved = left.join(ends[0], "u").join(ends[1], "v").where("u2 <> v2")
        left = materialize(
            moved.select(F.least("u2", "v2").alias("u"), F.greatest("u2", "v2").alias("v")).distinct()
        )
    if labels is None:
        return nodes.select("node", F.col("node").alias("component"))
    labelled = materialize(
        nodes.withColumn("key", F.xxhash64("node")).join(labels, "key", "left")
        .select("node", F.coalesce("label", "key").alias("label"))
    )
    least = labelled.groupBy("label").agg(F.min("node").alias("component"))
    return labelled.join(least, "label").select("node", "component")
