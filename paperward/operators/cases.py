"""Several documents of one case, judged together.

A case takes at most ten documents, so it fits one row.  :func:`assemble` turns
the document table into such rows with a single shuffle; every rule after it
works on the row.  Input that breaks the rule - a "case" holding millions of
documents - stays cheap: each of the ten slots is a ``max``, combined before
the shuffle, so no task ever holds a whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperward.functions import reports as R
from paperward.operators.redact import redact_reports
from paperward.sources.intake import check_manifest

# Case limits, finding codes, and the closing lines.
MIN_DOCUMENTS, MAX_DOCUMENTS = 2, 10
MAX_TOTAL_BYTES = 30 * 1024 * 1024
SAME_FILE = "same-file"
SAME_BASE_FILE = "same-base-file"
SAME_INSTANT = "shared-creation-instant"
NO_FINDINGS = (
    "Across the case: no inconsistencies between the documents. That is not proof"
    " they are independent or authentic."
)
SOME_FINDINGS = "Across the case, inconsistencies to review (not verdicts): "

_OPTIONAL = {
    "name": "string",
    "bytes": "bigint",
    "sha256": "string",
    "permanent_id": "string",
    "font_tags": "array<string>",
    "created": "timestamp",
    "load_error": "string",
}


def number_sources(cases: DataFrame, paths: str = "paths", urls: str = "urls") -> DataFrame:
    """One row per document: paths first, then URLs, in the order given."""

    def tagged(col: str, kind: str) -> Column:
        items = F.coalesce(F.col(col), F.array().cast("array<string>"))
        return F.transform(
            items, lambda x: F.struct(F.lit(kind).alias("source_kind"), x.alias("source"))
        )

    rest = [c for c in cases.columns if c not in (paths, urls)]
    numbered = cases.select(
        *rest,
        F.posexplode(F.concat(tagged(paths, "path"), tagged(urls, "url"))).alias(
            "doc_idx", "_s"
        ),
    )
    return numbered.select(*rest, "doc_idx", "_s.source_kind", "_s.source")


def assemble(documents: DataFrame, keys: tuple[str, ...] = ("case_id",)) -> DataFrame:
    """``(case_id, n_docs, numbered, docs)`` with at most ten documents in case order.

    ``numbered`` tells whether the documents are numbered 0 to n-1, each once; where
    they aren't, some of them are not in ``docs``, and :func:`validate` refuses the case.
    ``load_error``, if there is such a column, is why a document could not be loaded.
    """
    doc = F.struct(
        F.col("doc_idx").cast("int").alias("doc_idx"),
        *[
            (F.col(c) if c in documents.columns else F.lit(None)).cast(t).alias(c)
            for c, t in _OPTIONAL.items()
        ],
    )
    slots = [
        F.max(F.when(F.col("doc_idx") == i, doc)) for i in range(MAX_DOCUMENTS)
    ]
    index = F.col("doc_idx")
    places = [F.max(F.when(index == i, 1)) for i in range(MAX_DOCUMENTS)]
    filled = F.size(F.array_compact(F.array(*places)))
    numbered = (filled == F.count("*")) & (F.max(index) == F.count("*") - 1)
    return documents.groupBy(*keys).agg(
        F.count("*").alias("n_docs"),
        F.coalesce(numbered, F.lit(False)).alias("numbered"),
        F.array_compact(F.array(*slots)).alias("docs"),
    )


# -- size rules -------------------------------------------------------------


def running_bytes(docs: Column) -> Column:
    """``(doc_idx, bytes, running)`` per document, in case order."""
    return F.transform(
        docs,
        lambda d, i: F.struct(
            d["doc_idx"].alias("doc_idx"),
            d["bytes"].alias("bytes"),
            F.aggregate(
                F.slice(docs, F.lit(1), i + 1),
                F.lit(0).cast("bigint"),
                lambda total, x: total + F.coalesce(x["bytes"], F.lit(0)),
            ).alias("running"),
        ),
    )


def count_ok(n_docs: Column) -> Column:
    return n_docs.between(MIN_DOCUMENTS, MAX_DOCUMENTS)


# What a refused case says.
COUNT_ERROR = (
    f"a case takes {MIN_DOCUMENTS} to {MAX_DOCUMENTS} documents (paths and urls together);"
    " got %d. For one document, use inspect_document."
)
SIZE_ERROR = (
    "the documents of one case may add up to {limit} MB; this one is over that"
    " by document %d. Send fewer or smaller files."
)
# Our own words, for tables that no single request could make.
NUMBER_ERROR = "document numbers must be 0 to n-1, each once"
LOAD_ERROR = "document %d: %s"


def validate(cases: DataFrame, max_bytes: int = MAX_TOTAL_BYTES) -> DataFrame:
    """Add ``over_idx``, the first document past the size limit, and ``error``.

    The number of documents is judged first, then their numbering; a document that
    could not be loaded wins over the size rule where it comes no later.
    """
    over = F.filter(running_bytes(F.col("docs")), lambda d: d["running"] > max_bytes)
    fair = count_ok(F.col("n_docs")) & F.col("numbered")
    failed = F.get(F.filter("docs", lambda d: d["load_error"].isNotNull()), F.lit(0))
    cases = cases.withColumn("over_idx", F.when(fair, F.get(over, F.lit(0))["doc_idx"]))
    size_error = SIZE_ERROR.format(limit=max_bytes // (1024 * 1024))
    first = failed["doc_idx"] <= F.coalesce("over_idx", F.lit(MAX_DOCUMENTS))
    return cases.withColumn(
        "error",
        F.when(~count_ok(F.col("n_docs")), F.format_string(COUNT_ERROR, F.col("n_docs")))
        .when(~F.col("numbered"), NUMBER_ERROR)
        .when(first, F.format_string(LOAD_ERROR, failed["doc_idx"], failed["load_error"]))
        .when(F.col("over_idx").isNotNull(), F.format_string(size_error, F.col("over_idx"))),
    )


# -- cross-document findings ------------------------------------------------


def _groups(docs: Column, code: str, key, several_files: bool) -> Column:
    """Groups of two or more documents that share a non-null key."""
    keys = F.array_distinct(F.array_compact(F.transform(docs, key)))
    groups = F.transform(keys, lambda k: F.filter(docs, lambda d: key(d) == k))

    def kept(group: Column) -> Column:
        if not several_files:
            return F.size(group) > 1
        return F.size(F.array_distinct(F.transform(group, lambda d: d["sha256"]))) > 1

    return F.transform(
        F.filter(groups, kept),
        lambda g: F.struct(
            F.lit(code).alias("code"),
            F.transform(g, lambda d: d["doc_idx"]).alias("documents"),
        ),
    )


def _tag_set(doc: Column) -> Column:
    """Whole set of font tags as one value; an empty set matches nothing."""
    tags = F.array_join(F.array_sort(F.array_distinct(doc["font_tags"])), "\u001f")
    return F.when(tags != "", tags)


def same_file(docs: Column) -> Column:
    return _groups(docs, SAME_FILE, lambda d: d["sha256"], False)


def same_base_file(docs: Column) -> Column:
    """Different files with one permanent id or one whole set of font tags."""
    by_id = _groups(docs, SAME_BASE_FILE, lambda d: d["permanent_id"], True)
    by_tags = _groups(docs, SAME_BASE_FILE, _tag_set, True)
    return F.array_distinct(F.concat(by_id, by_tags))


def shared_instant(docs: Column) -> Column:
    return _groups(
        docs, SAME_INSTANT, lambda d: F.date_trunc("second", d["created"]), True
    )


def findings(docs: Column) -> Column:
    return F.concat(same_file(docs), same_base_file(docs), shared_instant(docs))


def with_findings(cases: DataFrame) -> DataFrame:
    """Add ``findings`` to assembled cases; null where the case is refused."""
    found = findings(F.col("docs"))
    return cases.withColumn("findings", F.when(F.col("error").isNull(), found))


def cross_line(found: Column) -> Column:
    """Closing line of a case: its findings, or an explicit none."""
    listed = F.array_join(
        F.transform(
            found,
            lambda f: F.concat(
                f["code"], F.lit(" ["),
                F.array_join(f["documents"].cast("array<string>"), ", "), F.lit("]"),
            ),
        ),
        "; ",
    )
    return F.when(F.size(found) == 0, F.lit(NO_FINDINGS)).otherwise(
        F.concat(F.lit(SOME_FINDINGS), listed, F.lit("."))
    )


def report_lines(documents: DataFrame, reports: DataFrame) -> DataFrame:
    """One line per document of a case, from its report or its error.

    ``documents (case_id, doc_idx, name)``, ``reports (case_id, doc_idx, body)``.  A
    document without a report keeps its line, which says that there is none.
    """
    report = F.col("_report")
    joined = documents.select("case_id", "doc_idx", "name").join(
        reports.select("case_id", "doc_idx", R.read_report(F.col("body")).alias("_report")),
        ["case_id", "doc_idx"],
        "left",
    )
    none = F.concat(F.col("name"), F.lit(f": not analysed ({R.NO_REPORT})"))
    line = F.when(report.isNull(), none).otherwise(R.summary_line(F.col("name"), report))
    return joined.select(
        "case_id", "doc_idx", F.concat(F.format_string("[%d] ", "doc_idx"), line).alias("line")
    )


def case_text(cases: DataFrame, lines: DataFrame) -> DataFrame:
    """Whole answer for a case: its document lines, then the closing line."""
    slots = [
        F.max(F.when(F.col("doc_idx") == i, F.col("line"))) for i in range(MAX_DOCUMENTS)
    ]
    per_case = lines.groupBy("case_id").agg(
        F.array_compact(F.array(*slots)).alias("_lines")
    )
    body = F.array_join(
        F.concat(
            F.coalesce(F.col("_lines"), F.array().cast("array<string>")),
            F.array(cross_line(F.col("findings"))),
        ),
        "\n",
    )
    return cases.join(per_case, "case_id", "left").select(
        "case_id",
        F.coalesce(F.col("error"), body).alias("text"),
        F.col("error").isNotNull().alias("refused"),
        "findings",
    )


def inspect_cases(documents: DataFrame, reports: DataFrame) -> DataFrame:
    """The answer about each case, built from redacted reports.

    ``(case_id, refused, text, findings)``; a case that breaks a size rule gets
    the rule as its text and no findings.
    """
    cases = validate(assemble(documents)).transform(with_findings)
    lines = report_lines(documents, redact_reports(reports))
    return case_text(cases, lines)


def inspect_case_files(files: DataFrame, reports: DataFrame, roots: Sequence[str] = ()) -> DataFrame:
    """The answers about cases whose documents are still files of a manifest.

    ``files (case_id, doc_idx, path, exists, is_file, length)``, with the further columns
    of :func:`assemble` where known.  A file that the intake rules refuse refuses its
    case, with the number of the document and the intake's message.
    """
    checked = check_manifest(files, roots)
    documents = checked.withColumns({"bytes": F.col("length"), "load_error": F.col("message")})
    return inspect_cases(documents, reports)
