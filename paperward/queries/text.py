"""Queries over text: normalization, cues, classification."""

from __future__ import annotations

from pyspark.sql import functions as F

from paperward.functions import cues as C
from paperward.functions import sql as names
from paperward.functions import text as T
from paperward.operators import classify as K
from paperward.operators import rates as A
from paperward.queries import planted as P
from paperward.queries import sqltext as S
from paperward.queries.registry import registry
from paperward.sources.tables import read_table

QUERIES, ORACLES, query = registry()


def _joined(col):
    return F.array_join(col, ",")


_DOC = S.planted("text", "doc_id")
_TURN = S.planted("text", "conv_id + turn")
_PAGE = S.planted("html", "page_id")


def _turns(spark, folder):
    return read_table(spark, folder, "conversations").withColumn(
        "value", P.planted(F.col("text"), F.col("conv_id") + F.col("turn"))
    )


def _pages(spark, folder):
    return read_table(spark, folder, "pages").withColumn(
        "value", P.planted(F.col("html"), F.col("page_id"))
    )


@query(f"""
    WITH src AS (SELECT doc_id, {_DOC} AS v FROM documents)
    SELECT doc_id, {S.normalized('v')} AS normalized, {S.flags('v')} AS obfuscation FROM src
""")
def normalize_text(spark, folder):
    out = K.with_normalized(P.planted_documents(spark, folder), "value")
    return out.select(
        "doc_id",
        F.col("normalized.text").alias("normalized"),
        _joined("normalized.obfuscation").alias("obfuscation"),
    )


@query(f"""
    WITH src AS (SELECT conv_id, turn, {_TURN} AS v FROM conversations)
    SELECT conv_id, turn, {S.stripped('v')} AS stripped FROM src
""")
def strip_invisible(spark, folder):
    return _turns(spark, folder).select(
        "conv_id", "turn", T.strip_invisible(F.col("value")).alias("stripped")
    )


@query(f"""
    WITH src AS (SELECT doc_id, {_DOC} AS v FROM documents)
    SELECT doc_id, {S.folded('v')} AS folded FROM src
""")
def fold_confusables(spark, folder):
    return P.planted_documents(spark, folder).select(
        "doc_id", T.fold_confusables(F.col("value")).alias("folded")
    )


@query(f"""
    WITH src AS (SELECT doc_id, {_DOC} AS v FROM documents)
    SELECT doc_id, strip_accents(v) AS deaccented FROM src
""")
def deaccent(spark, folder):
    return P.planted_documents(spark, folder).select(
        "doc_id", T.deaccent(F.col("value")).alias("deaccented")
    )


@query(f"""
    WITH src AS (SELECT page_id, {_PAGE} AS v FROM pages)
    SELECT page_id, {S.flags('v')} AS obfuscation FROM src
""")
def obfuscation_flags(spark, folder):
    out = K.with_normalized(_pages(spark, folder), "value")
    return out.select(
        "page_id", _joined("normalized.obfuscation").alias("obfuscation")
    )


@query(f"""
    WITH src AS (SELECT conv_id, turn, {_TURN} || chr(7) || 'x' AS v FROM conversations)
    SELECT conv_id, turn, {S.payload('v', 200)} AS payload, {S.payload('v', 80)} AS name
    FROM src
""")
def safe_payload(spark, folder):
    noisy = F.concat("value", F.lit("\x07x"))
    return _turns(spark, folder).select(
        "conv_id",
        "turn",
        T.safe_payload(noisy).alias("payload"),
        T.safe_payload(noisy, T.MAX_NAME_CHARS).alias("name"),
    )


@query(f"""
    WITH src AS (SELECT page_id, {_PAGE} || repeat('\U0001f600', CAST(page_id % 4 AS INT)) AS v FROM pages)
    SELECT page_id, {S.utf16_length('v')} AS full_length FROM src
""")
def payload_length(spark, folder):
    smileys = F.expr("repeat('\U0001f600', cast(page_id % 4 as int))")
    return _pages(spark, folder).select(
        "page_id", T.utf16_length(F.concat("value", smileys)).alias("full_length")
    )


@query("""
    SELECT page_id, regexp_replace(
        regexp_extract(url, '[^/]*$') || CASE page_id % 3 WHEN 0 THEN '"a' || chr(13) || chr(10)
        WHEN 1 THEN 'b''c' ELSE '' END, '["\\r\\n]', '_', 'g') AS safe_name
    FROM pages
""")
def safe_filename(spark, folder):
    tail = (
        F.when(F.col("page_id") % 3 == 0, '"a\r\n')
        .when(F.col("page_id") % 3 == 1, "b'c")
        .otherwise("")
    )
    name = F.concat(F.substring_index("url", "/", -1), tail)
    return read_table(spark, folder, "pages").select(
        "page_id", T.safe_filename(name).alias("safe_name")
    )


@query(f"""
    WITH {S.classified('documents', 'doc_id', _DOC)},
    cue AS (SELECT doc_id, string_agg(category, ',' ORDER BY category) AS categories
             FROM hits WHERE category <> 'imperative-address' GROUP BY doc_id)
    SELECT d.doc_id, coalesce(categories, '') AS categories
    FROM documents d LEFT JOIN cue ON d.doc_id = cue.doc_id
""")
def cue_hits(spark, folder):
    out = K.with_matchable(P.planted_documents(spark, folder), "value")
    return out.select("doc_id", _joined(C.cue_hits(F.col("matchable"))).alias("categories"))


@query(f"""
    WITH src AS (SELECT conv_id, turn, {_TURN} AS v FROM conversations),
    norm AS (SELECT conv_id, turn, {S.normalized('v')} AS t FROM src)
    SELECT conv_id, turn, {S.imperative('t')} AS imperative FROM norm
""")
def imperative_address(spark, folder):
    out = K.with_matchable(_turns(spark, folder), "value")
    return out.select(
        "conv_id", "turn", C.imperative_address(F.col("matchable")).alias("imperative")
    )


@query(f"""
    WITH {S.classified('documents', 'doc_id', _DOC)}
    SELECT doc_id, CASE WHEN confidence IS NULL THEN NULL ELSE categories END AS categories,
           confidence,
           CASE WHEN confidence IS NULL THEN NULL ELSE {S.flags('v')} END AS obfuscation
    FROM matched
""")
def injection_classify(spark, folder):
    out = K.with_match(P.planted_documents(spark, folder), "value")
    return out.select(
        "doc_id",
        _joined("match.categories").alias("categories"),
        F.col("match.confidence").alias("confidence"),
        _joined("match.obfuscation").alias("obfuscation"),
    )


def _kind_sql() -> str:
    return (
        f"CASE WHEN doc_id % 9 = 8 THEN 'other' ELSE {S.pick('doc_id', P.FIELD_KINDS)} END"
    )


FIELDS_SQL = f"""
    WITH {S.classified('documents', 'doc_id', _DOC)},
    named AS (SELECT *, {_kind_sql()} AS kind FROM matched)
    SELECT doc_id, kind, 'field_ ' || doc_id AS name,
           CASE WHEN kind = 'annotation' THEN doc_id % 5 + 1 END AS page,
           categories, confidence, {S.flags('v')} AS obfuscation,
           {S.payload('v', 200)} AS payload, {S.utf16_length('v')} AS full_length,
           CAST(1 AS BIGINT) AS lexicon_version
    FROM named WHERE confidence IS NOT NULL AND kind <> 'other'
"""


def flat_findings(found):
    return found.select(
        "doc_id",
        "kind",
        "name",
        F.col("page").cast("bigint").alias("page"),
        _joined("match.categories").alias("categories"),
        F.col("match.confidence").alias("confidence"),
        _joined("match.obfuscation").alias("obfuscation"),
        "payload",
        "full_length",
        F.col("lexicon_version").cast("bigint").alias("lexicon_version"),
    )


@query(FIELDS_SQL)
def injection_fields(spark, folder):
    return flat_findings(K.field_findings(P.fields(P.documents(spark, folder))))


@query(f"""
    SELECT doc_id, {_kind_sql()} AS kind, {_kind_sql()} IN ({', '.join(map(S.lit, P.FIELD_KINDS))}) AS known
    FROM documents
""")
def field_kind_check(spark, folder):
    return P.fields(read_table(spark, folder, "documents")).select(
        "doc_id", "kind", C.known_kind(F.col("kind")).alias("known")
    )


@query(f"""
    WITH items AS (SELECT 'item-' || (item_id % 7) AS category, {S.normalized('text')} AS phrase
                   FROM benchmark),
    docs AS (SELECT doc_id, {S.normalized('text')} AS t FROM documents),
    found AS (SELECT doc_id, string_agg(DISTINCT category, ',' ORDER BY category) AS categories
              FROM docs JOIN items ON contains(t, phrase) GROUP BY doc_id)
    SELECT docs.doc_id, coalesce(categories, '') AS categories
    FROM docs LEFT JOIN found ON docs.doc_id = found.doc_id
""")
def lexicon_join(spark, folder):
    """A lexicon that is a table: passages looked for in every document."""
    lexicon = read_table(spark, folder, "benchmark").select(
        F.concat(F.lit("item-"), F.col("item_id") % 7).alias("category"),
        F.col("text").alias("phrase"),
    )
    found = K.match_lexicon(P.documents(spark, folder), "doc_id", "text", lexicon)
    return found.select("doc_id", _joined("categories").alias("categories"))


@query(f"""
    WITH {S.classified('documents', 'doc_id', _DOC)},
    flat AS (SELECT d.lang, confidence, {S.flags('v')} AS f
             FROM matched JOIN documents d ON matched.doc_id = d.doc_id)
    SELECT CAST(1 AS BIGINT) AS lexicon_version, lang, count(*) AS fields,
           count(confidence) AS findings,
           count(*) FILTER (confidence = 'confident') AS confident,
           count(*) FILTER (confidence = 'tentative') AS tentative,
           count(*) FILTER (confidence IS NOT NULL AND f <> '') AS obfuscated,
           count(confidence) / count(*) AS rate
    FROM flat GROUP BY lang
""")
def injection_rates(spark, folder):
    matched = K.with_match(P.planted_documents(spark, folder), "value")
    rates = A.injection_rates(matched, "lang")
    return rates.withColumn("lexicon_version", F.col("lexicon_version").cast("bigint"))


@query(f"""
    WITH {S.classified('documents', 'doc_id', _DOC)},
    flat AS (SELECT CASE WHEN d.doc_id % 17 <> 0 THEN d.source END AS source, CASE WHEN d.doc_id % 13 <> 0 THEN d.lang END AS lang,
                    confidence, {S.flags('v')} AS f
             FROM matched JOIN documents d ON matched.doc_id = d.doc_id)
    SELECT CAST(1 AS BIGINT) AS lexicon_version, source, lang, CAST(grouping_id(source, lang) AS BIGINT) AS totals,
           count(*) AS fields, count(confidence) AS findings,
           count(*) FILTER (confidence = 'confident') AS confident,
           count(*) FILTER (confidence = 'tentative') AS tentative,
           count(*) FILTER (confidence IS NOT NULL AND f <> '') AS obfuscated,
           count(confidence) / count(*) AS rate
    FROM flat GROUP BY ROLLUP (source, lang)
""")
def injection_rates_rollup(spark, folder):
    """Sources and languages with totals; some keys are null."""
    key = F.col("doc_id")
    docs = P.planted_documents(spark, folder).withColumns({
        "source": F.when(key % 17 != 0, F.col("source")), "lang": F.when(key % 13 != 0, F.col("lang"))
    })
    rates = A.injection_rates_rollup(K.with_match(docs, "value"), "source", "lang")
    return rates.withColumn("lexicon_version", F.col("lexicon_version").cast("bigint"))


@query(f"""
    WITH {S.classified('documents', 'doc_id', _DOC)}
    SELECT d.source, category, count(*) AS findings
    FROM hits JOIN matched ON hits.doc_id = matched.doc_id
    JOIN documents d ON d.doc_id = hits.doc_id
    WHERE confidence IS NOT NULL GROUP BY d.source, category
""")
def injection_categories(spark, folder):
    matched = K.with_match(P.planted_documents(spark, folder), "value")
    return A.category_counts(matched, "source")


# -- the same rules called by name from SQL text ------------------------------


@query(f"""
    WITH src AS (SELECT doc_id, {_DOC} AS v FROM documents)
    SELECT doc_id, {S.normalized('v')} AS normalized FROM src
""")
def sql_normalize_text(spark, folder):
    names.register(spark)
    return spark.sql(
        "SELECT doc_id, normalize_text(value) AS normalized FROM {docs}", docs=P.planted_documents(spark, folder)
    )


@query(f"""
    WITH {S.classified('documents', 'doc_id', _DOC)}
    SELECT lang, confidence, categories, count(*) AS n
    FROM matched JOIN documents USING (doc_id) WHERE confidence IS NOT NULL GROUP BY ALL
""")
def sql_classify_injection(spark, folder):
    names.register(spark)
    return spark.sql(
        """SELECT lang, m.confidence, array_join(m.categories, ',') AS categories, count(*) AS n
        FROM (SELECT lang, classify_injection(value) AS m FROM {docs})
        WHERE m.confidence IS NOT NULL GROUP BY ALL""",
        docs=P.planted_documents(spark, folder),
    )
