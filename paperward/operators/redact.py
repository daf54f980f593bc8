"""Redaction of untrusted text inside open-schema report bodies.

Bodies are redacted where they stand: no shuffle, no grouping.  A cheap text
test keeps bodies that cannot hold a candidate away from Python, and cue
matching itself runs in the JVM on the candidate strings.

A body that may hold a candidate but cannot be read as JSON is withheld: it comes
out null, since nothing is known about what it would deliver.  Of one that has a key
twice the last value counts, as for a reader of it, and the text is written anew, so
what an earlier value held never gets out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperward.functions import cues as C
from paperward.functions import json_tree as J
from paperward.functions import text as T
from paperward.functions.net import let
from paperward.functions.unicode import for_python
from paperward.plans.shape import compute_once, materialize


def _may_hold(body: Column, *keys: str) -> Column:
    """False only where no key can be in the body, escaped spelling included."""
    test = F.contains(body, F.lit("\\u"))
    for key in keys:
        test = test | F.contains(body, F.lit(f'"{key}"'))
    return test


def _matches(candidate: Column) -> Column:
    """Does one candidate string classify as a finding?"""
    folded = T.folded_text(candidate["value"], candidate["plain"])
    return let(
        let(folded, lambda t: T.collapse_whitespace(t)),
        lambda norm: let(
            C.all_categories(C.cue_hits(norm), C.imperative_address(norm)),
            lambda cats: C.confidence(cats).isNotNull(),
        ),
    )


def _elide(df: DataFrame, body: str, gate: Column, read, write=None) -> DataFrame:
    """Bodies as ``read`` leaves them, with the strings that match elided by ``write``.

    Two Arrow nodes: one parses each body that passes the gate, once; the other gets
    only bodies in which a string matched.
    """
    text = F.col(body)
    df = df.withColumn("_read", read(for_python(text, gate)))
    unread = gate & F.col("_read.found").isNull()
    df = df.withColumn("_seen", F.coalesce("_read.body", text))
    if write is not None:
        df = compute_once(df, "_hits", F.transform(F.col("_read.found"), _matches))
        touched = F.coalesce(F.array_contains(F.col("_hits"), True), F.lit(False))
        new = write(for_python(F.col("_seen"), touched), F.when(touched, F.col("_hits")))
        df = df.withColumn("_new", new).withColumn("_seen", F.coalesce("_new", "_seen")).drop("_hits", "_new")
    kept = F.nullif(F.col("_seen"), F.lit(J.UNREADABLE))
    return df.withColumn(body, F.when(~unread, kept)).drop("_read", "_seen")


def redact_untrusted(df: DataFrame, body: str = "body") -> DataFrame:
    """Elide author-written strings of signals that flag themselves untrusted."""
    return _elide(df, body, _may_hold(F.col(body), J.UNTRUSTED_FLAG), J.read_untrusted)


def redact_recovered(df: DataFrame, body: str = "body") -> DataFrame:
    """Elide recovered text that reads as an instruction, in all signals."""
    gate = _may_hold(F.col(body), *J.RECOVERED_KEYS)
    return _elide(df, body, gate, J.read_recovered, J.write_recovered)


def redact_compare(df: DataFrame, body: str = "body") -> DataFrame:
    """Elide every string of a compare body that reads as an instruction."""
    return _elide(df, body, F.col(body).isNotNull(), J.read_compare, J.write_compare)


def redact_reports(df: DataFrame, body: str = "body") -> DataFrame:
    """Both passes over single reports, in order, on one parsed tree."""
    gate = _may_hold(F.col(body), J.UNTRUSTED_FLAG, *J.RECOVERED_KEYS)
    return _elide(df, body, gate, J.read_report, J.write_recovered)


# Entries of an object or array, null for anything else.
_CHILDREN = """coalesce(
    transform(map_entries(try_variant_get(value, '$', 'map<string,variant>')),
        m -> named_struct('pos', cast(null as int), 'key', m.key, 'value', m.value)),
    transform(try_variant_get(value, '$', 'array<variant>'),
        (x, i) -> named_struct('pos', i, 'key', cast(null as string), 'value', x)))"""


def _descend(df: DataFrame, report_id: str, first: int, levels: int) -> DataFrame:
    """Rows of containers replaced by rows of what they hold, ``levels`` times."""
    listed = ", ".join(f"'{k}'" for k in J.PAYLOAD_KEYS)
    for level in range(first, first + levels):
        df = df.selectExpr("*", f"explode_outer({_CHILDREN}) as c").selectExpr(
            f"`{report_id}`",
            "signal_idx",
            "if(c is null, path, array_append(path, coalesce(c.key, cast(c.pos as string)))) as path",
            "if(c is null, key, c.key) as key",
            f"if(c is null, depth, {level}) as depth",
            "if(c is null, in_array, c.key is null) as in_array",
            "if(c is null, under_listed, c.key is null and not in_array"
            f" and coalesce(key in ({listed}), false)) as under_listed",
            "if(c is null, value, c.value) as value",
        )
    return df


def evidence_leaves(
    reports: DataFrame, report_id: str, body: str = "body", step: int = 14
) -> DataFrame:
    """Scalar values of all evidence, one row each, however deep they lie.

    ``depth`` is the depth of the container a value sits in, evidence being 0.
    A pass goes down ``step`` levels with one generator each and no union; what is
    still a container then, and nothing else, goes through another pass.
    """
    doc = F.try_parse_json(F.col(body))
    df = reports.select(
        F.col(report_id),
        F.posexplode(F.try_variant_get(doc, "$.signals", "array<variant>")).alias(
            "signal_idx", "signal"
        ),
    )
    evidence = F.try_variant_get(F.col("signal"), "$.evidence", "variant")
    open_ = df.select(
        report_id,
        "signal_idx",
        F.array().cast("array<string>").alias("path"),
        F.lit(None).cast("string").alias("key"),
        F.lit(-1).alias("depth"),
        F.lit(False).alias("in_array"),
        F.lit(False).alias("under_listed"),
        evidence.alias("value"),
    )
    leaves, first = None, 0
    while True:
        rows = materialize(_descend(open_, report_id, first, step).withColumn("_open", F.expr(f"coalesce(size({_CHILDREN}), 0) > 0")))
        found = _scalars(rows.where("NOT _open"), report_id)
        leaves = found if leaves is None else leaves.unionByName(found)
        open_, first = rows.where("_open").drop("_open"), first + step
        if open_.isEmpty():
            return leaves


def _scalars(df: DataFrame, report_id: str) -> DataFrame:
    kind = F.schema_of_variant(F.col("value"))
    return (
        df.where("depth >= 0")
        .where(~kind.isin("OBJECT<>", "ARRAY<>", "ARRAY<VOID>") | kind.isNull())
        .select(
            report_id,
            "signal_idx",
            "path",
            "key",
            "depth",
            "in_array",
            "under_listed",
            kind.alias("type"),
            F.col("value").try_cast("string").alias("value"),
        )
    )
