"""op13: periodic runs of words in all documents."""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark.sql import functions as F

from paperward.llm.periodic import periodic_runs
from paperward.llm.shared import lean, tune, utf8
from paperward.queries.registry import registry
from paperward.sources.tables import read_table

QUERIES, ORACLES, query = registry()


def repeated(doc_id: int | None, text: bytes) -> bytes:
    """The contract's text: of one document in ten a tail repeats its first words."""
    if doc_id is None or (h := zlib.crc32(str(doc_id).encode())) % 10:
        return text
    words = text.split()
    if not words:
        return text
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    tail = words[a : a + p] * (-(-(n - a) // p))
    return b" ".join(words[:a] + tail[: n - a])


def _repeat(batches):
    for batch in batches:
        rows = zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())
        texts = pa.array([repeated(i, t) for i, t in rows], pa.binary()).cast(pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), texts], ["doc_id", "text"])


def _stronger(best, run):
    return F.when(best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best)


@query()
def op13_periodic_runs(spark, folder):
    """Runs of every period aren't said by SQL in bearable time; tests compare with brute force."""
    tune(spark)
    docs = read_table(spark, folder, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("text"))
    docs = docs.mapInArrow(lean(_repeat), "doc_id long, text string")
    nothing = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    best = F.aggregate("runs", nothing, _stronger)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = periodic_runs(docs).withColumn("_best", best)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "_best.start", "_best.length", "_best.period",
        F.floor(1000 * F.col("_best.length") / F.col("_best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
