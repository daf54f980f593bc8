"""Writing results: accepted rows, refused rows, and the ledger.

Every write is a batch with a name, and has a folder of its own below the location.
Writing a batch again, after a failure or a retried micro-batch, replaces what the first
attempt left, whole, and touches no other batch.  Readers see the batches as partitions.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

REJECTS = "rejects"
RESULTS = "results"


def _folder(location: str, batch: str | int) -> str:
    if not re.fullmatch(r"[A-Za-z0-9_-]+", str(batch)):
        raise ValueError(f"not a batch name: {batch!r}")
    return f"{location}/batch={batch}"


def write_results(
    df: DataFrame, location: str, error: Column, batch: str | int, by: tuple[str, ...] = ()
) -> None:
    """Write one batch in one pass, split into results and rejects.

    The two parts are partitions of a single write, so the input is computed
    once; read either with :func:`read_results`.
    """
    part = F.when(error.isNull(), RESULTS).otherwise(REJECTS)
    df.withColumn("part", part).write.mode("overwrite").partitionBy("part", *by).parquet(_folder(location, batch))


def read_results(spark: SparkSession, location: str, schema: StructType, part: str = RESULTS) -> DataFrame:
    """The rows of one part over all batches, with the columns of ``schema``."""
    full = StructType([*schema.fields]).add("part", StringType()).add("batch", StringType())
    return spark.read.schema(full).parquet(location).where(F.col("part") == part).select(*schema.names)


def results_sink(location: str, error: Column, by: tuple[str, ...] = (), name: str = "stream"):
    """A function for ``foreachBatch``: a micro-batch that runs again replaces itself.

    Streams that share a location need different names.
    """

    def write(df: DataFrame, number: int) -> None:
        write_results(df, location, error, f"{name}-{number}", by)

    return write


def append_ledger(entries: DataFrame, location: str, batch: str | int) -> None:
    """Write a batch of ledger rows, partitioned by day."""
    entries.withColumn("day", F.to_date("ts")).write.mode("overwrite").partitionBy("day").parquet(_folder(location, batch))
