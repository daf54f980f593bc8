"""op3: documents without the passages that a smaller document holds."""

from __future__ import annotations

from paperward.llm.substrings import cut_repeats
from paperward.queries.registry import registry
from paperward.sources.tables import read_table

QUERIES, ORACLES, query = registry()


@query("""WITH words AS (
        SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
        FROM documents),
    starts AS (
        SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM words WHERE len(w) >= 13),
    windows AS (SELECT doc_id, i, list_slice(w, i, i + 12) AS run FROM starts),
    firsts AS (SELECT run, min(doc_id) AS first FROM windows GROUP BY run),
    bad AS (SELECT doc_id, i FROM windows JOIN firsts USING (run) WHERE first < doc_id),
    gone AS (SELECT doc_id, list_distinct(flatten(list(range(i, i + 13)))) AS g FROM bad GROUP BY doc_id),
    kept AS (
        SELECT doc_id, w, coalesce(len(g), 0) AS n,
               CASE WHEN g IS NULL THEN w ELSE list_filter(w, lambda x, j: NOT list_contains(g, j)) END AS k
        FROM words LEFT JOIN gone USING (doc_id))
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(n AS BIGINT) AS n_removed,
           sha256(array_to_string(k, ' ')) AS kept_sha256 FROM kept
""")
def op3_substring_dedup(spark, folder):
    found = cut_repeats(read_table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")
