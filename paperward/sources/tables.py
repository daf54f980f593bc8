"""Reading the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stream_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The same table as a file stream, be it one file or a folder of them.

    A stream takes a single file only by a pattern, so the last letter is one; a folder
    that it matches is read with all that is below it.
    """
    schema = read_table(spark, folder, name).schema
    return (
        spark.readStream.schema(schema)
        .option("basePath", folder)
        .parquet(f"{folder}/{name}.parque[t]")
    )
