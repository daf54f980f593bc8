"""op7: license notices in all documents."""

from __future__ import annotations

from paperward.llm.licenses import PHRASES, TEMPLATES, least_common, scan_licenses, template_words
from paperward.queries.registry import registry
from paperward.sources.tables import read_table

QUERIES, ORACLES, query = registry()

_BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _sql() -> str:
    phrases = ", ".join(f"({_list(p.split())}, '{label}')" for p, label in PHRASES.items())
    templates = ", ".join(
        f"('{label}', {_list(words)}, {least_common(len(words))})"
        for label, words in ((label, template_words(t)) for label, t in TEMPLATES)
    )
    return f"""WITH phrases(p, label) AS (VALUES {phrases}),
    templates(label, t, need) AS (VALUES {templates}),
    lower AS (SELECT doc_id, {_LOWER} AS l FROM documents),
    words AS (SELECT doc_id, l, list_filter(regexp_split_to_array(l, '{_BREAKS}'), lambda w: w <> '') AS w FROM lower),
    places AS (
        SELECT doc_id, label, unnest(list_filter(range(0, len(w) - len(p) + 1),
               lambda i: w[i + 1] = p[1] AND list_slice(w, i + 1, i + len(p)) = p)) AS i
        FROM words, phrases WHERE len(w) >= len(p)),
    base AS (
        SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word,
               list(DISTINCT label) AS labels FROM places GROUP BY doc_id),
    blocks AS (
        SELECT doc_id, list_distinct(regexp_split_to_array(b, '{_BREAKS}')) AS b
        FROM (SELECT doc_id, unnest(string_split(l, chr(10))) AS b FROM lower)),
    met AS (
        SELECT doc_id, label, len(list_intersect(b, t)) AS n, len(t) AS size
        FROM blocks, templates WHERE len(list_intersect(b, t)) >= need),
    best AS (SELECT doc_id, max(n / size) AS share, list(DISTINCT label) AS labels FROM met GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
           CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
           array_to_string(list_sort(coalesce(base.labels, [])), ',') AS base_labels,
           array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(best.labels, [])))), ',') AS labels,
           CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0)::DOUBLE END AS score
    FROM words LEFT JOIN base USING (doc_id) LEFT JOIN best USING (doc_id)"""


@query(_sql())
def op7_license_scan(spark, folder):
    return scan_licenses(read_table(spark, folder, "documents")).drop("blocks")
