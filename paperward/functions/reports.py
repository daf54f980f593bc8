"""Columns over inspection reports.

A report arrives as open JSON.  :func:`read_report` pulls the few fields the
engine reads into one typed struct through VARIANT, so a field of an
unexpected type reads as missing instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Signal and severity names, policy verdicts.
INFO = "info"
REDACTION_SIGNAL = "redaction-exposure"

# Sentences of the one-line summaries.
NO_SIGNALS = ". No signals above info severity."
NO_STRUCTURAL = " No structural signals above info severity."
NOT_A_VERDICT = (
    " Risk signals are not a verdict — benign causes are documented per signal."
)
MARKERS = (
    " PROMPT-INJECTION MARKERS: ",
    " document field(s) carry text addressed to a machine reader,"
    " matching cue categories [",
    "]. The text itself is deliberately NOT returned through this tool —"
    " it is attacker-authored and reading it is the attack."
    " Fetch the report over the REST API without `?redact=payload`"
    " if a human needs to see the words.",
)
TRIAGE_CAVEAT = (
    " TRIAGE ONLY — the page-content walk did NOT run, so ",
    " page-content families (hidden text, redaction failure, altered arithmetic,"
    " glyph tampering, embedded-image anomalies, certification breaks) were not"
    " checked. A quiet result is not a clean document: run inspect_document for"
    " a full check.",
)
EXPOSED = (
    ": REDACTION FAILURE — text is still present under a covering shape, or redaction"
    " marks were left unapplied. The recovered words are in the findings below;"
    " anyone receiving this file can read them too."
)
NOT_EXPOSED = (
    ": no exposed text found under a covering shape, and no unapplied redaction"
    " marks. Blind spots remain: content inside form XObjects is not walked, and a"
    " flattened or image-only page has no text layer to search."
)
#: Why a report says nothing, where it gives no reason itself.
UNREADABLE = "unreadable report"
NO_REPORT = "no report"

FULL_REPORT = " (Full report — this medium has no separate cheap tier.)"


def _text(value: Column, path: str) -> Column:
    return F.try_variant_get(value, path, "string")


def _is(value: Column, path: str, kind: str) -> Column:
    """True where the value at ``path`` is of JSON type ``kind``."""
    got = F.schema_of_variant(F.try_variant_get(value, path, "variant"))
    kinds = {
        "boolean": got == "BOOLEAN",
        "string": got == "STRING",
        "array": F.startswith(got, F.lit("ARRAY")),
        "object": F.startswith(got, F.lit("OBJECT")),
        "number": got.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)"),
    }
    return F.coalesce(kinds[kind], F.lit(False))


def _number_text(value: Column, path: str) -> Column:
    """Number as a JSON reader prints it: no trailing ``.0``."""
    return F.regexp_replace(_text(value, path), r"\.0+$", "")


def read_report(body: Column) -> Column:
    """Typed view of the report fields the engine reads."""
    doc = F.try_parse_json(body)
    signals = F.coalesce(
        F.try_variant_get(doc, "$.signals", "array<variant>"),
        F.array().cast("array<variant>"),
    )
    view = F.transform(
        signals,
        lambda s: F.struct(
            _text(s, "$.id").alias("id"),
            _text(s, "$.severity").alias("severity"),
            (
                _is(s, "$.evidence.payloadIsUntrusted", "boolean")
                & (_text(s, "$.evidence.payloadIsUntrusted") == "true")
            ).alias("untrusted"),
            F.when(
                _is(s, "$.evidence.cueCategories", "array"),
                F.try_variant_get(s, "$.evidence.cueCategories", "array<string>"),
            ).alias("cue_categories"),
            F.when(
                _is(s, "$.evidence.fieldsMatched", "number"),
                F.try_variant_get(s, "$.evidence.fieldsMatched", "double"),
            ).alias("fields_matched"),
        ),
    )
    cost = F.struct(
        F.try_variant_get(doc, "$.summary.cost.physicalBytes", "bigint").alias(
            "physical_bytes"
        ),
        F.try_variant_get(doc, "$.summary.cost.expandedBytes", "bigint").alias(
            "expanded_bytes"
        ),
        _number_text(doc, "$.summary.cost.expansionRatio").alias("expansion_ratio"),
    )
    return F.struct(
        _number_text(doc, "$.summary.riskScore").alias("risk_score"),
        _text(doc, "$.summary.riskBand").alias("risk_band"),
        F.when(_is(doc, "$.summary.cost", "object"), cost).alias("cost"),
        view.alias("signals"),
        F.nullif(_text(doc, "$.policy.verdict"), F.lit("")).alias("verdict"),
        _is(doc, "$.triage", "object").alias("is_triage"),
        F.try_variant_get(doc, "$.triage.suppressedFamilies", "array<string>").alias(
            "suppressed_families"
        ),
        _text(doc, "$.mediaType").alias("media_type"),
        F.when(_is(doc, "$.error", "string"), _text(doc, "$.error")).alias("error"),
        _is(doc, "$", "object").alias("readable"),
    )


def not_analysed(report: Column) -> Column:
    """Why a report says nothing about its document; null where it does.

    A body that is missing, cut off or no object, has a key twice, or
    is too long to parse is unreadable.  It must never pass for a quiet one.
    """
    return F.when(~report["readable"], UNREADABLE).otherwise(report["error"])


def not_analysed_line(name: Column, report: Column) -> Column:
    return F.concat(name, F.lit(": not analysed ("), not_analysed(report), F.lit(")"))


# -- signals ----------------------------------------------------------------


def above_info(signals: Column) -> Column:
    """Signals that are not mere information; no severity counts as above."""
    return F.filter(signals, lambda s: ~s["severity"].eqNullSafe(F.lit(INFO)))


def signal_ids(signals: Column) -> Column:
    return F.array_join(
        F.transform(signals, lambda s: F.coalesce(s["id"], F.lit(""))), ", "
    )


def injection_signals(signals: Column) -> Column:
    """Signals of the injection families: untrusted and with cue categories.

    Comment families are untrusted too but carry no categories.
    """
    return F.filter(
        signals, lambda s: s["untrusted"] & s["cue_categories"].isNotNull()
    )


def injection_categories(signals: Column) -> Column:
    found = F.transform(injection_signals(signals), lambda s: s["cue_categories"])
    return F.array_sort(F.array_distinct(F.flatten(found)))


def injection_fields_matched(signals: Column) -> Column:
    return F.aggregate(
        injection_signals(signals),
        F.lit(0.0),
        lambda total, s: total + F.coalesce(s["fields_matched"], F.lit(0.0)),
    )


def redaction_signals(signals: Column) -> Column:
    return F.filter(signals, lambda s: s["id"].eqNullSafe(F.lit(REDACTION_SIGNAL)))


def js_number(value: Column) -> Column:
    """A double as text, whole numbers without a decimal point."""
    return F.when(value == F.floor(value), value.cast("bigint").cast("string")).otherwise(
        value.cast("string")
    )


# -- one-line summaries -----------------------------------------------------


def _headline(name: Column, report: Column) -> Column:
    return F.concat(
        name,
        F.lit(": risk "),
        F.coalesce(report["risk_score"], F.lit("?")),
        F.lit("/100 ("),
        F.coalesce(report["risk_band"], F.lit("?")),
        F.lit(")"),
    )


def summary_line(name: Column, report: Column) -> Column:
    """One line per report: score, band, verdict, signals, injection note.

    The note is made of category names and counts, never of recovered text.
    """
    signals = report["signals"]
    named = signal_ids(above_info(signals))
    verdict = report["verdict"]
    note = F.concat(
        F.lit(MARKERS[0]),
        js_number(injection_fields_matched(signals)),
        F.lit(MARKERS[1]),
        F.array_join(injection_categories(signals), ", "),
        F.lit(MARKERS[2]),
    )
    line = F.concat(
        _headline(name, report),
        F.when(
            verdict.isNotNull(), F.concat(F.lit(", your policy says "), verdict)
        ).otherwise(""),
        F.when(named != "", F.concat(F.lit(". Signals: "), named)).otherwise(NO_SIGNALS),
        F.when(F.size(injection_signals(signals)) > 0, note).otherwise(""),
        F.lit(NOT_A_VERDICT),
    )
    return F.when(not_analysed(report).isNotNull(), not_analysed_line(name, report)).otherwise(line)


def triage_line(name: Column, report: Column) -> Column:
    """One line per triage report: cost first, and what was not checked."""
    named = signal_ids(above_info(report["signals"]))
    cost = report["cost"]

    def shown(field: str) -> Column:
        return F.coalesce(cost[field].cast("string"), F.lit("?"))

    families = F.coalesce(F.size(report["suppressed_families"]), F.lit(0))
    line = F.concat(
        _headline(name, report),
        F.lit("."),
        F.when(
            cost.isNotNull(),
            F.concat(
                F.lit(" Cost: "), shown("physical_bytes"),
                F.lit(" bytes read, "), shown("expanded_bytes"),
                F.lit(" expanded (ratio "), shown("expansion_ratio"), F.lit(")."),
            ),
        ).otherwise(""),
        F.when(named != "", F.concat(F.lit(" Signals: "), named, F.lit("."))).otherwise(
            NO_STRUCTURAL
        ),
        F.when(
            report["is_triage"],
            F.concat(
                F.lit(TRIAGE_CAVEAT[0]), F.greatest(families, F.lit(0)).cast("string"),
                F.lit(TRIAGE_CAVEAT[1]),
            ),
        ).otherwise(FULL_REPORT),
    )
    return F.when(not_analysed(report).isNotNull(), not_analysed_line(name, report)).otherwise(line)


# -- decisions --------------------------------------------------------------


def policy_verdict(
    score: Column,
    ids: Column,
    review: Column,
    reject: Column,
    reject_on: Column,
    review_on: Column,
) -> Column:
    """``accept``, ``review`` or ``reject`` under one tenant's policy.

    Missing parts of a policy never trigger.  Reaching a threshold counts, and
    rejection is decided first.
    """

    def hit(threshold: Column, rules: Column) -> Column:
        return F.coalesce(score >= threshold, F.lit(False)) | F.coalesce(
            F.arrays_overlap(ids, rules), F.lit(False)
        )

    return (
        F.when(hit(reject, reject_on), "reject")
        .when(hit(review, review_on), "review")
        .otherwise("accept")
    )


def triage_route(
    score: Column, ratio: Column, reject_score: float = 75, reject_ratio: float = 100
) -> Column:
    """``reject`` now, or ``escalate`` to the full check; never ``clean``."""
    too_risky = F.coalesce(score >= reject_score, F.lit(False))
    too_large = F.coalesce(ratio >= reject_ratio, F.lit(False))
    return F.when(too_risky | too_large, "reject").otherwise("escalate")
