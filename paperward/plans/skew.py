"""Joins to one row a key where some keys hold much of the table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperward.plans.shape import materialize

#: A key with more than this share of the rows is dealt out; at least so many shares.
LEAST_SHARES = 4096


def attach(rows: DataFrame, per_key: DataFrame, keys: list[str], weight: str, spread: list[str]) -> DataFrame:
    """Left join of ``rows`` to ``per_key``, which has one row a key and its row count ``weight``.

    Adaptive execution can't split a hot key where an aggregate stands between the
    exchange and the join, and rows of one key are never split where it may not.  So the
    rows are dealt by the key and a salt, a hash of the ``spread`` columns, which must tell
    most rows of a key apart.  The rows are taken as ``shares`` equal ones, four for each
    task at least.  A key of more than one share gets as many salts as it has shares, and
    its row of ``per_key`` is copied once for each: fewer than two copies a share in all.
    Fewer keys than shares can have more than one, so the table of their salts is
    broadcast with that bound.  Rows with a null key match nothing and are dealt over all
    salts.  ``weight`` isn't kept; ``per_key`` is read three times, so it should be written.
    """
    spark = rows.sparkSession
    shares = max(LEAST_SHARES, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    total = per_key.agg(F.sum(weight)).first()[0] or 0
    share = max(total // shares, 1)
    salts = F.ceil(F.col(weight) / share).cast("int")
    hot = per_key.where(F.col(weight) > share).select(*keys, salts.alias("_salts"))
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    salt = F.pmod(F.xxhash64(*spread), F.when(missing, shares).otherwise(F.coalesce("_salts", F.lit(1))))
    left = rows.join(F.broadcast(hot), keys, "left").withColumn("_salt", salt).drop("_salts")
    right = per_key.select("*", F.explode(F.sequence(F.lit(0).cast("long"), salts.cast("long") - 1)).alias("_salt"))
    return left.join(right.drop(weight), [*keys, "_salt"], "left").drop("_salt")


def attach_counted(rows: DataFrame, per_key: DataFrame, keys: list[str], spread: list[str]) -> DataFrame:
    """:func:`attach` where the rows of each key are still to be counted, which is one aggregate more."""
    counted = rows.groupBy(*keys).agg(F.count("*").alias("_n"))
    return attach(rows, materialize(per_key.join(counted, keys)), keys, "_n", spread)


def hashable(df: DataFrame) -> list[str]:
    """Columns that a hash can be taken of."""
    return [c for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
