"""Streaming versions of the batch operators.

Batch and stream share their columns; this module only adds event time, and
keeps every piece of state bounded: sums, and at most ten slots per case.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperward.operators import cases as K
from paperward.operators.classify import field_findings
from paperward.operators.metering import hourly_usage
from paperward.operators.network import screen_urls
from paperward.operators.ranges import screen_urls_by_rules
from paperward.plans.shape import shared_folder
from paperward.sources.sinks import results_sink


def classify_stream(fields: DataFrame) -> DataFrame:
    """Findings of arriving text fields.  Stateless."""
    return field_findings(fields)


def metering_stream(
    calls: DataFrame, lateness: str = "10 minutes", period: str = "1 hour"
) -> DataFrame:
    """Metered documents per account and hour; a window closes with the watermark.

    Accounts, refusals and costs are those of the batch; ``usage_of_hours`` sums
    closed hours up to allowance windows, with the batch's answer.
    """
    hours = hourly_usage(calls.withWatermark("ts", lateness), F.window("ts", period))
    return hours.select(
        "account", "anonymous", F.col("hour.start").alias("period"), "documents", "calls", "refused"
    )


def _sessions(documents: DataFrame, lateness: str, gap: str) -> DataFrame:
    """Cases of documents that arrive close together, under the batch's rules."""
    arriving = documents.withWatermark("ts", lateness).withColumn(
        "session", F.session_window("ts", gap)
    )
    return K.validate(K.assemble(arriving, ("case_id", "session")))


def same_file_stream(
    documents: DataFrame, lateness: str = "10 minutes", gap: str = "15 minutes"
) -> DataFrame:
    """Identical files within a case whose documents arrive close together.

    A case that the batch refuses has one row with the reason and no file.  State is
    ten slots per case, whatever a "case" holds.
    """
    cases = _sessions(documents, lateness, gap)
    found = F.when(F.col("error").isNull(), K.same_file(F.col("docs")))
    one = F.explode(F.coalesce(found, F.array(F.lit(None).cast("struct<code:string,documents:array<int>>"))))
    rows = cases.select("case_id", "session", "error", "docs", one.alias("f"))
    first = F.filter("docs", lambda d: d["doc_idx"] == F.col("f.documents")[0])
    return rows.select(
        "case_id", F.col("session.start").alias("opened"), "error",
        F.get(first, F.lit(0))["sha256"].alias("sha256"), F.col("f.documents").alias("documents"),
    )


def case_stream(
    documents: DataFrame, lateness: str = "10 minutes", gap: str = "15 minutes"
) -> DataFrame:
    """Cases assembled from documents that arrive close together.

    The session aggregate is the batch one - ten slots per case - and the
    findings are row expressions on top of it.
    """
    return _sessions(documents, lateness, gap).transform(K.with_findings).select(
        "case_id",
        F.col("session.start").alias("opened"),
        "n_docs",
        "error",
        "findings",
    )


def url_screen_stream(urls: DataFrame, allowed: Sequence[str] = ()) -> DataFrame:
    """Arriving URLs with their verdict.  Stateless; the ranges are constants."""
    return screen_urls(urls, "url", allowed)


def screen_by_rules(
    urls: DataFrame, ranges: Callable[[SparkSession], DataFrame], allowed: Callable[[SparkSession], DataFrame],
    location: str, state: str, name: str = "stream",
):
    """Start a stream that screens arriving URLs by two tables, as they are at each micro-batch.

    ``ranges`` and ``allowed`` read the tables, anew for each micro-batch, so a rule
    added between two takes effect in the second.  Rows go to the results sink, refused
    ones to its rejects; a micro-batch that runs again replaces what it left.
    """

    def screen(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        screened = screen_urls_by_rules(batch, ranges(spark), allowed(spark))
        results_sink(location, F.when(F.col("verdict") != "ok", F.col("verdict")), name=name)(screened, number)

    return (
        urls.writeStream.foreachBatch(screen).option("checkpointLocation", state).trigger(availableNow=True).start()
    )


def run_to_table(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    """Drain the available input into a table of the shared folder, and read it."""
    base = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", f"{base}/state")
        .option("path", f"{base}/rows")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/rows")
