"""Metering, the derived call ledger, and files a tenant sent before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperward.plans.shape import materialize
from paperward.plans.skew import attach

# Allowances, and metered documents per call.
ANONYMOUS_PER_HOUR = 10
KEYED_PER_MONTH = 50
COMPARE_COST = 2


def call_cost(tool: Column, n_docs: Column) -> Column:
    """A comparison counts two documents, a case as many as it holds."""
    return (
        F.when(tool == "compare_documents", COMPARE_COST)
        .when(tool == "inspect_case", n_docs)
        .otherwise(1)
        .cast("bigint")
    )


def needs_key(tool: Column) -> Column:
    """Comparisons and cases are refused without a key, and cost nothing then."""
    return F.coalesce(tool.isin("compare_documents", "inspect_case"), F.lit(False))


def _metered(calls: DataFrame) -> DataFrame:
    """Calls with ``account``, ``anonymous``, ``refused`` and ``cost``."""
    if "caller" not in calls.columns:
        calls = calls.withColumn("caller", F.lit("anonymous"))
    anonymous = F.col("key").isNull()
    refused = anonymous & needs_key(F.col("tool"))
    return calls.select(
        "ts", F.coalesce("key", "caller").alias("account"), anonymous.alias("anonymous"),
        refused.alias("refused"),
        F.when(refused, F.lit(0).cast("bigint")).otherwise(call_cost(F.col("tool"), F.col("n_docs"))).alias("cost"),
    )


def _sums() -> list[Column]:
    return [
        F.sum("cost").alias("documents"),
        F.count_if(~F.col("refused")).alias("calls"),
        F.count_if("refused").alias("refused"),
    ]


def _window(ts: str) -> Column:
    return F.when(F.col("anonymous"), F.date_trunc("hour", ts)).otherwise(F.date_trunc("month", ts))


def _with_over(used: DataFrame) -> DataFrame:
    limit = F.when(F.col("anonymous"), ANONYMOUS_PER_HOUR).otherwise(KEYED_PER_MONTH)
    return used.withColumn("over", F.col("documents") > limit)


def usage(calls: DataFrame) -> DataFrame:
    """Metered documents per key and allowance window, and whether it is over.

    Calls without a key share the hourly anonymous allowance per ``caller``;
    keyed calls have the monthly one.  Without a ``caller`` column all
    anonymous calls are one caller.  Calls that need a key and have none are
    refused: they are counted as such and cost nothing.  Sums combine before the
    shuffle.
    """
    metered = _metered(calls)
    period = _window("ts").alias("period")
    return _with_over(metered.groupBy("account", "anonymous", period).agg(*_sums()))


def hourly_usage(calls: DataFrame, hour: Column) -> DataFrame:
    """The same sums per account and ``hour``, a window column; also of a stream."""
    return _metered(calls).groupBy(hour.alias("hour"), "account", "anonymous").agg(*_sums())


def usage_of_hours(hours: DataFrame) -> DataFrame:
    """:func:`usage` from rows ``(account, anonymous, period, documents, calls, refused)`` of hours."""
    sums = [F.sum(c).cast("bigint").alias(c) for c in ("documents", "calls", "refused")]
    period = _window("period").alias("period")
    return _with_over(hours.groupBy("account", "anonymous", period).agg(*sums))


def ledger(calls: DataFrame, content: str = "content") -> DataFrame:
    """Short derived record of each call: hashes, signal ids, score.

    The columns are listed, not inherited: no file, name or text can get in.
    """
    return calls.select(
        "call_id",
        "tenant",
        "ts",
        F.sha2(F.col(content), 256).alias("sha256"),
        F.transform("signals", lambda s: s["id"]).alias("signal_ids"),
        F.col("score").cast("double").alias("score"),
    )


def tenant_matches(calls: DataFrame) -> DataFrame:
    """Has this tenant sent this file before?  Only earlier calls count.

    The first call per tenant and file is an aggregate combined before the shuffle, one
    row for each file sent more than once.  It is attached by a salted join, so a file or
    a tenant that makes up most of the table is spread over all tasks.  Calls without a
    tenant or a hash match nothing.
    """
    order = F.struct("ts", "call_id")
    firsts = materialize(
        calls.where("tenant IS NOT NULL AND sha256 IS NOT NULL").groupBy("tenant", "sha256")
        .agg(F.min(order).alias("_first"), F.count("*").alias("_n"))
        .where("_n > 1")
    )
    joined = attach(calls, firsts, ["tenant", "sha256"], "_n", ["call_id", "ts"])
    seen = F.coalesce(F.col("_first") < order, F.lit(False))
    return joined.select(
        *calls.columns,
        seen.alias("seen_before"),
        F.when(seen, F.col("_first.call_id")).alias("first_call_id"),
    )
