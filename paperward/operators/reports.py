"""Operators over tables of inspection reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperward.functions import reports as R
from paperward.operators.redact import redact_reports
from paperward.plans.shape import compute_once


def with_view(reports: DataFrame, body: str = "body", out: str = "report") -> DataFrame:
    """Add the typed view of each body; the body is parsed once."""
    return compute_once(reports, out, R.read_report(F.col(body)))


def inspect(reports: DataFrame, name: str = "name", body: str = "body") -> DataFrame:
    """The answer about each document: its redacted body and a line about it.

    Bodies come redacted by both passes, always, so the answer is safe for a
    model to read.  A body that only carries an error, or can't be read, says so.
    """
    safe = reports.transform(redact_reports, body).transform(with_view, body, "report")
    return safe.withColumn("line", R.summary_line(F.col(name), F.col("report")))


def triage(reports: DataFrame, name: str = "name", body: str = "body") -> DataFrame:
    """The cheap answer: redacted body, cost line and where to send the file."""
    safe = reports.transform(redact_reports, body).transform(with_view, body, "report")
    view = F.col("report")
    return safe.withColumns({
        "line": R.triage_line(F.col(name), view),
        "route": R.triage_route(
            view["risk_score"].try_cast("double"),
            view["cost"]["expansion_ratio"].try_cast("double"),
        ),
    })


def check_redaction(
    reports: DataFrame, name: str = "name", body: str = "body"
) -> DataFrame:
    """Did redactions remove the words?  Every document gets an answer.

    Adds ``exposed``, ``findings`` (whole signals as JSON), ``media_type`` and
    ``line``.  Recovered words are kept unless they read as an instruction.  Of a
    report that is an error or can't be read, ``exposed`` is null and the line says so.
    """
    safe = reports.transform(redact_reports, body)
    doc = F.try_parse_json(F.col(body))
    signals = F.coalesce(
        F.try_variant_get(doc, "$.signals", "array<variant>"),
        F.array().cast("array<variant>"),
    )
    found = F.transform(
        F.filter(
            signals,
            lambda s: F.try_variant_get(s, "$.id", "string").eqNullSafe(
                F.lit(R.REDACTION_SIGNAL)
            ),
        ),
        lambda s: F.to_json(s),
    )
    safe = compute_once(safe, "findings", found)
    safe = safe.transform(with_view, body, "_view")
    silent = R.not_analysed(F.col("_view")).isNotNull()
    exposed = F.when(~silent, F.size("findings") > 0)
    return safe.withColumns({
        "exposed": exposed,
        "media_type": F.when(~exposed, F.try_variant_get(doc, "$.mediaType", "string")),
        "line": F.when(silent, R.not_analysed_line(F.col(name), F.col("_view"))).otherwise(
            F.concat(F.col(name), F.when(exposed, R.EXPOSED).otherwise(R.NOT_EXPOSED))
        ),
    }).drop("_view")


def apply_policies(
    reports: DataFrame, policies: DataFrame, tenant: str, report: str = "report"
) -> DataFrame:
    """Add ``policy_verdict`` by the policy of each report's tenant.

    ``policies (tenant, review, reject, reject_on, review_on)``, one row per
    tenant.  A report without a policy, or one that is an error or can't be read,
    gets no verdict.
    """
    view = F.col(report)
    rules = policies.select(
        tenant, F.struct("review", "reject", "reject_on", "review_on").alias("_p")
    )
    verdict = R.policy_verdict(
        view["risk_score"].cast("double"),
        F.transform(view["signals"], lambda s: s["id"]),
        F.col("_p.review"),
        F.col("_p.reject"),
        F.col("_p.reject_on"),
        F.col("_p.review_on"),
    )
    return (
        reports.join(rules, tenant, "left")
        .withColumn("policy_verdict", F.when(F.col("_p").isNotNull() & R.not_analysed(view).isNull(), verdict))
        .drop("_p")
    )


def category_totals(reports: DataFrame, *by: str, report: str = "report") -> DataFrame:
    """Reports and matched fields per cue category, one row each.

    Long form on purpose: nothing is collected per group, so a source that
    sends most reports is as cheap as any other.
    """
    signals = F.col(f"{report}.signals")
    return (
        reports.select(
            *by,
            R.injection_fields_matched(signals).alias("_fields"),
            F.explode(R.injection_categories(signals)).alias("category"),
        )
        .groupBy(*by, "category")
        .agg(F.count("*").alias("reports"), F.sum("_fields").alias("fields"))
    )


def triage_costs(reports: DataFrame, *by: str, report: str = "report") -> DataFrame:
    """What it cost to read the reports of a group, and what was left out."""
    view = F.col(report)
    cost = view["cost"]
    families = F.greatest(F.size(view["suppressed_families"]), F.lit(0))
    return reports.groupBy(*by).agg(
        F.count("*").alias("reports"),
        F.sum(cost["physical_bytes"]).alias("physical_bytes"),
        F.sum(cost["expanded_bytes"]).alias("expanded_bytes"),
        F.max(cost["expansion_ratio"].try_cast("double")).alias("max_ratio"),
        F.try_divide(
            F.sum(cost["expanded_bytes"]).cast("double"), F.sum(cost["physical_bytes"])
        ).alias("ratio"),
        F.sum(F.coalesce(families, F.lit(0))).cast("bigint").alias("suppressed_families"),
    )


#: Size of a quantile sketch.  Up to as many values it is exact; beyond, the rank of an
#: answer is off by less than ``RANK_ERROR`` of the values, with 99 % confidence.
SKETCH_K = 4096
RANK_ERROR = 0.002


def cost_sketches(reports: DataFrame, *by: str, report: str = "report", k: int = SKETCH_K) -> DataFrame:
    """Mergeable quantile sketches of the costs of a group: bytes read, and expansion ratio.

    Rows (by, reports, bytes_sketch, ratio_sketch), some 50 kB a group at most, combined
    before the shuffle.  Take a day or an hour into ``by`` and keep them: sketches of any
    periods are put together by :func:`cost_percentiles`.  Reports without a cost count
    as reports and are in no sketch.
    """
    cost = F.col(report)["cost"]
    return reports.groupBy(*by).agg(
        F.count("*").alias("reports"),
        F.kll_sketch_agg_bigint(cost["physical_bytes"], F.lit(k)).alias("bytes_sketch"),
        F.kll_sketch_agg_double(cost["expansion_ratio"].try_cast("double"), F.lit(k)).alias("ratio_sketch"),
    )


def cost_percentiles(
    sketches: DataFrame, *by: str, shares: Sequence[float] = (0.5, 0.9, 0.99), k: int = SKETCH_K
) -> DataFrame:
    """Percentiles of costs over all sketches of a group: rows (by, reports, physical_bytes, ratio).

    Each is an array, one value for each of ``shares``: the smallest value that so many
    of the values don't exceed; null where no report has the cost.
    """
    asked = F.array(*[F.lit(float(s)) for s in shares])
    merged = sketches.groupBy(*by).agg(
        F.sum("reports").alias("reports"),
        F.kll_merge_agg_bigint("bytes_sketch", F.lit(k)).alias("_b"), F.kll_merge_agg_double("ratio_sketch", F.lit(k)).alias("_r"),
    )
    return merged.select(
        *by, "reports",
        F.when(F.kll_sketch_get_n_bigint("_b") > 0, F.kll_sketch_get_quantile_bigint("_b", asked)).alias("physical_bytes"),
        F.when(F.kll_sketch_get_n_double("_r") > 0, F.kll_sketch_get_quantile_double("_r", asked)).alias("ratio"),
    )
