"""Classification of text fields addressed to a machine reader.

Every operator here works row by row: one scan, no shuffle, one Arrow node
that receives nulls for all text the JVM can normalize itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from paperward.functions import cues as C
from paperward.functions import lexicon as L
from paperward.functions import text as T
from paperward.functions import unicode as U
from paperward.functions.automaton import finder
from paperward.plans.shape import compute_once, materialize


def with_matchable(
    df: DataFrame, text: str, out: str = "matchable", strip_isolates: bool = False
) -> DataFrame:
    """Add normalized text ``out`` and the composed form ``out_nfkc``."""
    raw = F.col(text)
    if strip_isolates:
        raw = F.regexp_replace(raw, f"[{U.ISOLATES}]", "")
    df = df.withColumn("_forms", U.unicode_forms(U.for_python(raw, U.needs_unicode(raw))))
    df = df.withColumn("_folded", T.folded_text(raw, F.col("_forms.plain")))
    df = df.withColumn(f"{out}_nfkc", F.coalesce(F.col("_forms.nfkc"), F.col(text)))
    matchable = T.collapse_whitespace(F.col("_folded"))
    return compute_once(df, out, matchable).drop("_forms", "_folded")


def with_normalized(
    df: DataFrame, text: str, out: str = "normalized", strip_isolates: bool = False
) -> DataFrame:
    """Add ``out``: struct of normalized text and sorted obfuscation flags."""
    df = with_matchable(df, text, "_m", strip_isolates)
    flags = T.obfuscation_flags(F.col(text), F.col("_m_nfkc"))
    value = F.struct(F.col("_m").alias("text"), flags.alias("obfuscation"))
    return df.withColumn(out, F.when(F.col(text).isNotNull(), value)).drop(
        "_m", "_m_nfkc"
    )


def with_match(
    df: DataFrame,
    text: str,
    out: str = "match",
    strip_isolates: bool = False,
    lexicon: Column | None = None,
) -> DataFrame:
    """Add ``out``: the match struct, or null where there is no finding.

    Filter the input before this call, not after, if rows can be left out.
    """
    df = with_matchable(df, text, "_m", strip_isolates)
    hits = C.cue_hits(F.col("_m")) if lexicon is None else lexicon
    df = compute_once(
        df, "_cats", C.all_categories(hits, C.imperative_address(F.col("_m")))
    )
    confidence = C.confidence(F.col("_cats"))
    # flags are only worked out for the few rows that match
    match = F.struct(
        F.col("_cats").alias("categories"),
        confidence.alias("confidence"),
        T.obfuscation_flags(F.col(text), F.col("_m_nfkc")).alias("obfuscation"),
    )
    return df.withColumn(out, F.when(confidence.isNotNull(), match)).drop(
        "_m", "_m_nfkc", "_cats"
    )


def field_findings(fields: DataFrame) -> DataFrame:
    """Findings of a table of text fields ``(…, kind, name, page, value)``.

    Other columns are kept; fields of unknown kind are left out, fields
    without a match too.
    """
    keep = [c for c in fields.columns if c not in ("kind", "name", "page", "value")]
    matched = with_match(fields.where(C.known_kind(F.col("kind"))), "value")
    return matched.where("match is not null").select(
        *keep,
        "kind",
        T.safe_payload(F.col("name"), T.MAX_NAME_CHARS).alias("name"),
        "page",
        "match",
        T.safe_payload(F.col("value")).alias("payload"),
        T.utf16_length(F.col("value")).alias("full_length"),
        F.lit(L.LEXICON_VERSION).alias("lexicon_version"),
    )


#: Bytes of the phrases of one automaton; as such it takes some forty times that.
LEXICON_PART_BYTES = 4 << 20


def match_lexicon(
    df: DataFrame, key: str, text: str, lexicon: DataFrame, part_bytes: int = LEXICON_PART_BYTES
) -> DataFrame:
    """Categories per key by a run-time lexicon ``(category, phrase)`` of any size.

    Phrases are normalized first, then found as substrings, all at once, by an automaton.
    The lexicon is dealt by a hash to parts of about ``part_bytes``; one part at a time is
    handed to the tasks, and each text is normalized and read once for each part where it
    stands.  Only keys and categories are shuffled.

    One row for each key: rows of one key are read as one, null being a key like others.
    Blank phrases and those without a category find nothing; a null text holds nothing.
    """
    norm = with_matchable(lexicon.select("category", "phrase"), "phrase", "_p")
    terms = norm.where("_p != '' AND category IS NOT NULL").select("category", F.col("_p").alias("phrase")).distinct()
    terms = materialize(terms)
    size = terms.agg(F.sum(F.octet_length("phrase"))).first()[0] or 0
    parts = size // part_bytes + 1
    texts = with_matchable(df.select(F.col(key).alias("key"), text), text, "_m").select("key", "_m")
    found = None
    for part in range(parts):
        rows = terms.where(F.pmod(F.xxhash64("phrase"), F.lit(parts)) == part).collect()
        names = sorted({r["category"] for r in rows})
        number = {c: i for i, c in enumerate(names)}
        handle = df.sparkSession.sparkContext.broadcast(
            ([r["phrase"] for r in rows], [number[r["category"]] for r in rows], names)
        )
        schema = StructType([StructField("key", df.schema[key].dataType), StructField("category", StringType())])
        hits = texts.mapInArrow(finder(handle), schema)
        if parts > 1:  # the next part takes this one's place
            hits = materialize(hits.distinct())
            handle.unpersist()
        found = hits if found is None else found.unionByName(hits)
    return found.groupBy(F.col("key").alias(key)).agg(F.array_sort(F.collect_set("category")).alias("categories"))
