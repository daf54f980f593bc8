"""op11: spelling variants in the words of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperward.llm.spelling import LOWER, UPPER, count_words, letter_runs, variants
from paperward.queries.registry import registry
from paperward.sources.tables import read_table

QUERIES, ORACLES, query = registry()

LEAST_CHARS, LEAST_N, EVERY = 7, 2, 31


def thinned(runs: DataFrame) -> DataFrame:
    """The contract's runs: of one in 31, by a hash of document and run, a letter is deleted."""
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    runs = runs.withColumn("_h", h)
    at = (F.col("_h") % F.length("run")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    return runs.select(F.when(F.col("_h") % EVERY == 0, less).otherwise(F.col("run")).alias("run"))


def _sql() -> str:
    return f"""WITH RECURSIVE
    step(i, c) AS (
        SELECT i, CAST(i AS BIGINT) FROM range(256) t(i)),
    bits(i, k, c) AS (
        SELECT i, 0, c FROM step
        UNION ALL
        SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END FROM bits WHERE k < 8),
    crcs AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
    runs AS (
        SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
    held AS (
        SELECT doc_id, translate(run, '{UPPER}', '{LOWER}') AS run, count(*) AS n
        FROM runs WHERE length(run) >= {LEAST_CHARS} GROUP BY ALL),
    hashed AS (
        SELECT run, n, xor(4294967295, list_reduce(
            list_prepend(CAST(4294967295 AS BIGINT),
                list_transform(range(1, CAST(length(hex(doc_id || ':' || run)) AS BIGINT), 2),
                    lambda i: CAST(('0x' || substr(hex(doc_id || ':' || run), i, 2)) AS BIGINT))),
            lambda c, b: xor(c // 256, t[CAST(xor(c % 256, b) AS BIGINT) + 1]))) AS h
        FROM held, crcs),
    words AS (
        SELECT CASE WHEN h % {EVERY} = 0
               THEN left(run, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2)
               ELSE run END AS word, n FROM hashed),
    vocabulary AS (
        SELECT word, CAST(sum(n) AS BIGINT) AS n FROM words WHERE length(word) >= {LEAST_CHARS}
        GROUP BY word HAVING sum(n) >= {LEAST_N}),
    places AS (SELECT word, n, unnest(range(0, CAST(length(word) AS BIGINT))) AS i FROM vocabulary),
    less AS (SELECT word, n, i, left(word, CAST(i AS INTEGER)) || substr(word, CAST(i AS INTEGER) + 2) AS rest FROM places),
    near AS (
        SELECT a.word, b.word AS other, b.n FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
        UNION SELECT a.word, b.word, b.n FROM less a JOIN vocabulary b ON a.rest = b.word
        UNION SELECT b.word, a.word, a.n FROM less a JOIN vocabulary b ON a.rest = b.word),
    best AS (
        SELECT word, count(*) AS n_near, max(n) AS most FROM near GROUP BY word),
    forms AS (
        SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 10 * v.n THEN most END AS form_n,
               CASE WHEN most >= 10 * v.n THEN
                   (SELECT min(other) FROM near WHERE near.word = v.word AND near.n = most) END AS form
        FROM vocabulary v LEFT JOIN best USING (word)),
    chain(word, last) AS (
        SELECT word, word FROM forms
        UNION ALL
        SELECT chain.word, forms.form FROM chain JOIN forms ON forms.word = chain.last WHERE forms.form IS NOT NULL),
    ends AS (SELECT chain.word, last FROM chain JOIN forms ON forms.word = chain.last WHERE forms.form IS NULL)
    SELECT f.word, form, ends.last AS root, n, CAST(n_near AS BIGINT) AS n_near, form_n
    FROM forms f JOIN ends ON ends.word = f.word"""


@query(_sql())
def op11_spelling_variants(spark, folder):
    runs = thinned(letter_runs(read_table(spark, folder, "documents"), LEAST_CHARS))
    return variants(count_words(runs.where(F.length("run") >= LEAST_CHARS), LEAST_N))
