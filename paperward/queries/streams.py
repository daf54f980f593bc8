"""Streaming queries: the given tables read as streams, run until drained.

Results are what the stream has emitted by then, so the SQL leaves out windows
that the watermark has not closed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from paperward.operators import cases as K
from paperward.queries import planted as P
from paperward.operators.metering import usage_of_hours
from paperward.queries.intake import CALLS_SQL, USED_SQL, calls_of
from paperward.queries.network import URLS_SQL, urls_of
from paperward.queries.registry import registry
from paperward.queries.text import FIELDS_SQL, flat_findings
from paperward.plans.shape import shared_folder
from paperward.sources import sinks
from paperward.sources.tables import read_table, stream_table
from paperward.streaming import jobs as J

QUERIES, ORACLES, query = registry()


@query(FIELDS_SQL)
def stream_classify(spark, folder):
    docs = stream_table(spark, folder, "documents")
    found = J.classify_stream(P.fields(docs))
    return flat_findings(J.run_to_table(spark, found, "classify"))


@query(f"""WITH {CALLS_SQL},
    used AS ({USED_SQL}
        WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE
        GROUP BY ALL)
    SELECT *, documents > CASE WHEN anonymous THEN 10 ELSE 50 END AS over FROM used
""")
def stream_metering(spark, folder):
    """The batch's answer from the hours that have closed."""
    hours = J.metering_stream(calls_of(stream_table(spark, folder, "events")))
    used = usage_of_hours(J.run_to_table(spark, hours, "metering"))
    return used.withColumn("period", F.date_format("period", "yyyy-MM-dd HH:mm:ss"))


def _arrivals(spark, folder):
    """Turns of conversations arriving as documents of cases."""
    case, idx = F.col("conv_id"), F.col("turn")
    early = idx < 2
    return stream_table(spark, folder, "conversations").select(
        case.alias("case_id"),
        idx.cast("int").alias("doc_idx"),
        F.timestamp_seconds(F.lit(1704067200) + case * 1200 + idx * 60).alias("ts"),
        F.sha2(
            F.when((case % 3 == 0) & early, F.concat(F.lit("same"), case)).otherwise(F.col("text")),
            256,
        ).alias("sha256"),
        F.when((case % 3 == 1) & early, F.concat(F.lit("pid-"), case)).alias("permanent_id"),
        F.timestamp_seconds(
            case * 100 + F.when((case % 3 == 2) & early, 0).otherwise(idx)
        ).alias("created"),
        F.octet_length("text").cast("bigint").alias("bytes"),
    )


_ARRIVALS = """arrivals AS (SELECT conv_id AS case_id, turn AS doc_idx,
        1704067200 + conv_id * 1200 + turn * 60 AS t,
        sha256(CASE WHEN conv_id % 3 = 0 AND turn < 2 THEN 'same' || conv_id ELSE text END) AS sha
        FROM conversations),
    closed AS (SELECT max(t) - 600 AS mark FROM arrivals)"""


@query(f"""WITH {_ARRIVALS},
    sessions AS (SELECT case_id, min(t) AS opened, count(*) AS n FROM arrivals
                 GROUP BY case_id HAVING max(t) + 900 <= (SELECT mark FROM closed)),
    found AS (SELECT case_id, opened, NULL AS error, sha AS sha256,
                     string_agg(doc_idx, ',' ORDER BY doc_idx) AS documents
              FROM arrivals JOIN sessions USING (case_id) WHERE n BETWEEN 2 AND 10
              GROUP BY case_id, opened, sha HAVING count(*) > 1),
    refused AS (SELECT case_id, opened, 'a case takes 2 to 10 documents (paths and urls together); got ' || n
                       || '. For one document, use inspect_document.' AS error,
                       NULL AS sha256, NULL AS documents FROM sessions WHERE n NOT BETWEEN 2 AND 10)
    SELECT case_id, CAST(opened AS BIGINT) AS opened, error, sha256, documents
    FROM (SELECT * FROM found UNION ALL SELECT * FROM refused)
""")
def stream_same_file(spark, folder):
    found = J.same_file_stream(_arrivals(spark, folder))
    return J.run_to_table(spark, found, "same-file").select(
        "case_id",
        F.unix_seconds("opened").alias("opened"),
        "error",
        "sha256",
        F.array_join(F.col("documents").cast("array<string>"), ",").alias("documents"),
    )


@query(f"""WITH {_ARRIVALS}
    SELECT case_id, CAST(min(t) AS BIGINT) AS opened, count(*) AS n_docs,
        'Across the case, inconsistencies to review (not verdicts): ' || CASE case_id % 3 WHEN 0 THEN 'same-file'
        WHEN 1 THEN 'same-base-file' ELSE 'shared-creation-instant' END || ' [0, 1].' AS summary
    FROM arrivals GROUP BY case_id HAVING max(t) + 900 <= (SELECT mark FROM closed)
""")
def stream_case(spark, folder):
    found = J.case_stream(_arrivals(spark, folder))
    return J.run_to_table(spark, found, "case").select(
        "case_id",
        F.unix_seconds("opened").alias("opened"),
        "n_docs",
        F.coalesce("error", K.cross_line(F.col("findings"))).alias("summary"),
    )


@query(f"WITH {URLS_SQL} SELECT page_id, planted, host, verdict FROM urls")
def stream_url_screen(spark, folder):
    screened = J.url_screen_stream(urls_of(stream_table(spark, folder, "pages")))
    return J.run_to_table(spark, screened, "urls").select("page_id", "planted", "host", "verdict")


def rules_of(pages):
    """Ranges and an allow list, from the keys of all pages."""
    key = F.col("page_id")
    ranges = pages.where(key % 3 == 0).select(
        F.concat(F.lit("8."), key % 16, F.lit(".0.0/16")).alias("network"), F.lit(True).alias("blocked")
    )
    return ranges, pages.select(F.concat(F.lit("10.0.0."), key % 11).alias("ip"))


@query(f"""WITH {URLS_SQL},
    ranges AS (SELECT DISTINCT '8.' || (page_id % 16) || '.' AS lead FROM pages WHERE page_id % 3 = 0),
    allowed AS (SELECT DISTINCT '10.0.0.' || (page_id % 11) AS ip FROM pages)
    SELECT page_id, planted, host, CASE
        WHEN host IN (SELECT ip FROM allowed) THEN 'ok'
        WHEN verdict = 'ok' AND regexp_full_match(host, '[0-9.]+') AND EXISTS (SELECT 1 FROM ranges WHERE starts_with(host, lead)) THEN 'blocked'
        ELSE verdict END AS verdict
    FROM urls
""")
def stream_url_rules(spark, folder):
    """Both parts of the sink, after screening by two tables that were written before."""
    base = f"{shared_folder(spark)}/rules-{uuid.uuid4().hex}"
    for name, table in zip(("ranges", "allowed"), rules_of(read_table(spark, folder, "pages"))):
        table.write.parquet(f"{base}/{name}")
    urls = urls_of(stream_table(spark, folder, "pages"))
    J.screen_by_rules(
        urls, lambda s: s.read.parquet(f"{base}/ranges"), lambda s: s.read.parquet(f"{base}/allowed"),
        f"{base}/out", f"{base}/state",
    ).awaitTermination()
    schema = urls.select("page_id", "planted").schema.add("host", "string").add("verdict", "string")
    kept, refused = (sinks.read_results(spark, f"{base}/out", schema, p) for p in (sinks.RESULTS, sinks.REJECTS))
    return kept.unionByName(refused)
