"""Comparing a candidate document with the original already held."""

from __future__ import annotations

import hashlib
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from paperward.operators.redact import redact_compare
from paperward.plans.shape import compute_once, materialize

# Executors get the helper with the job; they need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The four relations and what each one means.
IDENTICAL = "identical"
EXTENDS = "candidate-extends-original"
TRUNCATES = "candidate-truncates-original"
REWRITTEN = "rewritten"
GLOSS = {
    IDENTICAL: "the files are byte-identical — this is the only result that is a proof",
    EXTENDS: "the candidate contains the original verbatim and appends revisions to it",
    TRUNCATES: "the candidate is a prefix of the original",
    REWRITTEN: "both files were written whole, so only a structural diff is possible",
}

# A money amount, with its sign or code.  Callers may pass their own pattern.
# It starts at the first digit of a number and never backs off, so a long run of
# digits costs no more than its length.
_AMOUNT = r"(?<![0-9])(?<![0-9][.,])[0-9]++(?:[.,][0-9]++)*+"
DEFAULT_TOKEN = rf"(?:[$€£]|R\$)\s?{_AMOUNT}|{_AMOUNT}\s?(?:[$€£]|USD|EUR|BRL)"


def relationship(original: Column, candidate: Column) -> Column:
    """Relation of two byte strings held in one row."""
    return (
        F.when(original == candidate, IDENTICAL)
        .when(F.startswith(candidate, original), EXTENDS)
        .when(F.startswith(original, candidate), TRUNCATES)
        .otherwise(REWRITTEN)
    )


def relation_line(original_name: Column, candidate_name: Column, relation: Column) -> Column:
    head = F.concat(original_name, F.lit(" vs "), candidate_name, F.lit(": "))
    known = F.when(F.lit(False), "")
    for name, meaning in GLOSS.items():
        known = known.when(relation == name, F.lit(f"{name} — {meaning}"))
    return F.concat(head, known.otherwise(F.coalesce(relation, F.lit("unknown"))))


#: Bytes of a block; what a prefix holds beyond its whole blocks is hashed for each length.
BLOCK = 16384


def _block_digests(content: Column, block: int) -> Column:
    """Digest of each whole block, in order."""
    whole = F.floor(F.octet_length(content) / block).cast("int")
    places = F.filter(F.sequence(F.lit(0), whole), lambda i: i < whole)
    return F.transform(places, lambda i: F.sha2(F.substring(content, i * block + 1, F.lit(block)), 256))


@F.pandas_udf(ArrayType(StringType()))
def _chains(digests: pd.Series) -> pd.Series:
    """Digest of the first k digests, for each k from 0."""

    def chain(items):
        if items is None:
            return None
        running = hashlib.sha256()
        out = [running.hexdigest()]
        for item in items:
            running.update(item.encode())
            out.append(running.hexdigest())
        return out

    return digests.map(chain)


def _composed(chain: Column, rest: Column) -> Column:
    """Digest of a prefix: that of its whole blocks' digests, and the bytes beyond them."""
    return F.sha2(F.concat(chain.cast("binary"), rest), 256)


def relate(pairs: DataFrame, originals: DataFrame, candidates: DataFrame, block: int = BLOCK) -> DataFrame:
    """Relation of each ``(pair_id, original_id, candidate_id)``.

    Documents are ``(id, content BINARY)``, one row for each id; ``length`` and
    ``sha256`` are used if the tables carry them.  Pairs meet digests and lengths, not
    files.  The digest of a prefix is made of the digests of its whole blocks and of the
    few bytes beyond, so the longer file of a pair is cut into blocks, each hashed once,
    and a length asked for meets only the block it ends in.  Lengths of one file, however
    many, are spread over its blocks; none are collected.  Equal digests are SHA-256 over
    SHA-256, as good as one.  The pair table is checkpointed between the steps.  Plain
    left joins, which adaptive execution splits where one document stands in much of the
    pairs.  A pair with a document that isn't there is ``unknown``.
    """

    def digests(docs: DataFrame, side: str) -> DataFrame:
        length = F.octet_length("content").cast("bigint")
        digest = F.sha2("content", 256)
        listed = F.array_join(_block_digests(F.col("content"), block), "")
        rest = F.substring(F.col("content"), length.cast("int") - (length % block).cast("int") + 1, F.lit(block))
        return docs.select(
            F.col("id").alias(f"{side}_id"),
            (F.col("length") if "length" in docs.columns else length).alias(f"{side}_len"),
            (F.col("sha256") if "sha256" in docs.columns else digest).alias(f"{side}_sha"),
            _composed(F.sha2(listed.cast("binary"), 256), rest).alias(f"{side}_own"),
        )

    known = materialize(
        pairs.join(digests(originals, "original"), "original_id", "left")
        .join(digests(candidates, "candidate"), "candidate_id", "left")
    )

    def prefixes(docs: DataFrame, long: str, short: str) -> DataFrame:
        asked = known.where(F.col(f"{long}_len") > F.col(f"{short}_len")).select(
            F.col(f"{long}_id").alias("id"), F.col(f"{short}_len").alias("size")
        ).distinct()
        asked = asked.withColumn("k", F.floor(F.col("size") / block).cast("int"))
        long_docs = docs.select("id", "content").join(asked.select("id").distinct(), "id", "left_semi")
        chained = compute_once(long_docs, "chains", _chains(_block_digests(F.col("content"), block)))
        blocks = chained.select("id", "content", F.posexplode("chains").alias("k", "chain")).select(
            "id", "k", "chain", F.substring(F.col("content"), F.col("k") * block + 1, F.lit(block)).alias("bytes")
        )
        rest = F.substring(F.col("bytes"), F.lit(1), (F.col("size") % block).cast("int"))
        return asked.join(blocks, ["id", "k"]).select(
            F.col("id").alias(f"{long}_id"), F.col("size").alias(f"{short}_len"),
            _composed(F.col("chain"), rest).alias(f"{long}_prefix"),
        )

    known = known.join(prefixes(candidates, "candidate", "original"), ["candidate_id", "original_len"], "left")
    known = known.join(prefixes(originals, "original", "candidate"), ["original_id", "candidate_len"], "left")
    relation = (
        F.when(F.col("original_sha") == F.col("candidate_sha"), IDENTICAL)
        .when(F.col("candidate_prefix") == F.col("original_own"), EXTENDS)
        .when(F.col("original_prefix") == F.col("candidate_own"), TRUNCATES)
        .when(F.col("original_sha").isNotNull() & F.col("candidate_sha").isNotNull(), REWRITTEN)
        .otherwise("unknown")
    )
    return known.select(*pairs.columns, relation.alias("relationship"))


def compare_answers(
    answers: DataFrame, body: str = "body", original: str = "original_name", candidate: str = "candidate_name"
) -> DataFrame:
    """The answer about each pair: its redacted compare body, ``relationship`` and ``line``.

    The relation is the body's own if it is a string, else ``unknown``; a body that
    can't be read is withheld and its relation unknown.  Both are taken from the redacted
    body, so an instruction in its place doesn't get out either.
    """
    safe = redact_compare(answers, body)
    doc = F.try_parse_json(F.col(body))
    told = F.try_variant_get(doc, "$.relationship", "variant")
    text = F.when(F.schema_of_variant(told) == "STRING", told.try_cast("string"))
    safe = compute_once(safe, "relationship", F.coalesce(text, F.lit("unknown")))
    return safe.withColumn("line", relation_line(F.col(original), F.col(candidate), F.col("relationship")))


def field_diff(original: DataFrame, candidate: DataFrame) -> DataFrame:
    """Field-by-field diff of ``(pair_id, field, value)`` tables."""
    joined = original.withColumnRenamed("value", "original").withColumn(
        "_o", F.lit(True)
    ).join(
        candidate.withColumnRenamed("value", "candidate").withColumn("_c", F.lit(True)),
        ["pair_id", "field"],
        "full_outer",
    )
    status = (
        F.when(F.col("_o").isNull(), "added")
        .when(F.col("_c").isNull(), "removed")
        .when(F.col("original").eqNullSafe(F.col("candidate")), "same")
        .otherwise("changed")
    )
    return joined.select("pair_id", "field", "original", "candidate", status.alias("status"))


def text_changes(before: Column, after: Column, token: str = DEFAULT_TOKEN) -> Column:
    """Typed tokens that vanished or appeared between two versions.

    ``before`` is null for an added value, ``after`` for a removed one.
    """
    old = F.array_distinct(F.regexp_extract_all(before, F.lit(token), F.lit(0)))
    new = F.array_distinct(F.regexp_extract_all(after, F.lit(token), F.lit(0)))
    nothing = F.lit(None).cast("string")
    gone = F.transform(
        F.array_sort(F.array_except(old, new)),
        lambda v: F.struct(v.alias("before"), nothing.alias("after")),
    )
    come = F.transform(
        F.array_sort(F.array_except(new, old)),
        lambda v: F.struct(nothing.alias("before"), v.alias("after")),
    )
    return F.concat(gone, come)
