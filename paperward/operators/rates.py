"""Population rates of classified fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperward.functions import lexicon as L


def _rates() -> list[Column]:
    confidence = F.col("match.confidence")
    return [
        F.count("*").alias("fields"),
        F.count_if(F.col("match").isNotNull()).alias("findings"),
        F.count_if(confidence == L.CONFIDENT).alias("confident"),
        F.count_if(confidence == L.TENTATIVE).alias("tentative"),
        F.count_if(F.size("match.obfuscation") > 0).alias("obfuscated"),
        F.avg(F.col("match").isNotNull().cast("double")).alias("rate"),
    ]


def injection_rates(matched: DataFrame, *by: str) -> DataFrame:
    """Counts and share of findings per group of an already classified table.

    ``matched`` carries a ``match`` column.  The lexicon version is part of the
    key, so populations classified by different lexicons are never mixed.
    """
    return matched.withColumn("lexicon_version", F.lit(L.LEXICON_VERSION)).groupBy("lexicon_version", *by).agg(*_rates())


def injection_rates_rollup(matched: DataFrame, *by: str) -> DataFrame:
    """The same per group, per leading part of the key, and in all, in one aggregate.

    ``totals`` tells a total from a null key: one bit for each of ``by``, the last being
    the lowest, set where the row sums over that column.
    """
    rows = matched.rollup(*by).agg(F.grouping_id().cast("bigint").alias("totals"), *_rates())
    return rows.select(F.lit(L.LEXICON_VERSION).alias("lexicon_version"), "*")


def category_counts(matched: DataFrame, *by: str) -> DataFrame:
    """Findings per cue category."""
    return (
        matched.where("match is not null")
        .select(*by, F.explode("match.categories").alias("category"))
        .groupBy(*by, "category")
        .agg(F.count("*").alias("findings"))
    )
