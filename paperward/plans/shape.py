"""Small helpers that shape plans."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors see, as ``spark.checkpoint.dir`` names it.

    Only a session on one machine that names none, as in tests, gets a folder of its own,
    which goes when Python ends.  On a cluster a missing setting is an error: a local folder
    of the driver is not where executors could write.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        folder = tempfile.mkdtemp(prefix="paperward-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of executors."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


def compute_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that later filters and projections read, never recompute.

    A filter on a plain projected column is pushed below the projection, and
    the expression is then evaluated twice or more.  A generator over a
    one-element array gives the same rows and stops that, while filters on the
    other columns still pass through to the scan.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
