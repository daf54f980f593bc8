"""Queries over intake, metering and the ledger."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from paperward.operators import metering as M
from paperward.plans.shape import shared_folder
from paperward.queries import planted as P
from paperward.queries import sqltext as S
from paperward.queries.registry import registry
from paperward.sources import intake as I
from paperward.sources import sinks
from paperward.sources.tables import read_table

QUERIES, ORACLES, query = registry()

ROOTS_SETTING = " /intake:/srv/docs/ , relative,/tmp/../box"

# Path, inside the roots above - the expected answer by hand.
PATH_PLANTS = [
    ("/intake/a.pdf", True),
    ("/intake", True),
    ("/intake/", True),
    ("/intake2/a.pdf", False),
    ("/intake/../etc/passwd", False),
    ("/intake/x/../../srv/docs/y.pdf", True),
    ("/intake/..hidden/y.pdf", False),
    ("/intake/x/..hidden/y.pdf", True),
    ("/srv/docs/sub//./z.pdf", True),
    ("/srv/doc/z.pdf", False),
    ("/box/q.pdf", True),
    ("/tmp/box/q.pdf", False),
]
_PATHS = [p for p, _ in PATH_PLANTS]

# Path, exists, is a file, length (-1: that of the page), reason.
MANIFEST_PLANTS = [
    ("/intake/ok.pdf", True, True, -1, "accepted"),
    ("in/rel.pdf", True, True, -1, "not-absolute"),
    ("in/rel.pdf", False, False, 0, "not-absolute"),
    ("/intake/none.pdf", False, False, 0, "missing"),
    ("/etc/none.pdf", False, False, 0, "missing"),
    ("/intake/folder", True, False, 0, "not-a-file"),
    ("/intake/empty.pdf", True, True, 0, "empty"),
    ("/etc/passwd", True, True, 99999999, "outside-allowed"),
    ("/etc/empty", True, True, 0, "empty"),
    ("/intake/big.pdf", True, True, 10485761, "too-large"),
    ("/intake/limit.pdf", True, True, 10485760, "accepted"),
    ("/intake/vast.pdf", True, True, 12976128, "too-large"),
]


def _pages(spark, folder):
    return read_table(spark, folder, "pages")


def _manifest(spark, folder):
    plants = F.array(*[
        F.struct(
            F.lit(p).alias("path"), F.lit(e).alias("exists"), F.lit(f).alias("is_file"),
            F.lit(n).cast("bigint").alias("length"),
        )
        for p, e, f, n, _ in MANIFEST_PLANTS
    ])
    m = F.element_at(plants, (F.col("page_id") % len(MANIFEST_PLANTS) + 1).cast("int"))
    return _pages(spark, folder).select("page_id", "html", m.alias("m")).select(
        "page_id",
        "m.path",
        "m.exists",
        "m.is_file",
        F.when(F.col("m.length") < 0, F.octet_length("html")).otherwise(F.col("m.length"))
        .cast("bigint").alias("length"),
    )


def _values(rows) -> str:
    def show(v):
        return S.lit(v) if isinstance(v, str) else str(v).upper()

    return ", ".join(
        "(" + ", ".join([str(i), *map(show, r)]) + ")" for i, r in enumerate(rows)
    )


@query(f"""
    WITH plant(i, path, ex, fi, length, reason) AS (VALUES {_values(MANIFEST_PLANTS)})
    SELECT page_id, reason, regexp_extract(path, '([^/]+)/*$', 1) AS name,
        CASE reason WHEN 'not-absolute' THEN 'path must be absolute, got "' || path || '"'
            WHEN 'missing' THEN 'no file at ' || path WHEN 'not-a-file' THEN path || ' is not a file'
            WHEN 'empty' THEN path || ' is empty'
            WHEN 'outside-allowed' THEN path || ' is outside the directories this server is allowed to read. Move the file into an allowed directory or send it by url.'
            WHEN 'too-large' THEN path || ' is ' || printf('%.1f', length / 1048576.0) || ' MB, over the 10 MB limit.'
        END AS message
    FROM pages JOIN plant ON page_id % {len(MANIFEST_PLANTS)} = i
""")
def intake_manifest(spark, folder):
    checked = I.check_manifest(_manifest(spark, folder), I.parse_roots("/intake"))
    return checked.select("page_id", "reason", "name", "message")


@query(f"""
    WITH plant(i, path, inside) AS (VALUES {_values(PATH_PLANTS)})
    SELECT page_id, path, inside FROM pages JOIN plant ON page_id % {len(PATH_PLANTS)} = i
""")
def intake_allowed_dirs(spark, folder):
    path = P.pick(F.col("page_id"), _PATHS)
    inside = I.inside_allowed(path, I.parse_roots(ROOTS_SETTING))
    return _pages(spark, folder).select(
        "page_id", path.alias("path"), inside.alias("inside")
    )


@query(f"""
    SELECT page_id,
        CASE WHEN page_id % 6 = 0 THEN '/in/' || page_id WHEN page_id % 6 = 5 THEN ' x ' END AS path,
        CASE WHEN page_id % 6 IN (1, 4) THEN url END AS url,
        CASE WHEN page_id % 6 = 2 THEN 'give either path or url, not both'
             WHEN page_id % 6 = 3 THEN 'give a document: either path (a file on this machine) or url (http/https)'
        END AS error
    FROM pages
""")
def intake_source_choice(spark, folder):
    turn = F.col("page_id") % 6
    path = (
        F.when(turn.isin(0, 2), F.concat(F.lit("/in/"), "page_id"))
        .when(turn == 3, "  ")
        .when(turn == 4, "\t ")
        .when(turn == 5, " x ")
    )
    url = F.when(turn.isin(1, 2), F.col("url")).when(
        turn == 4, F.concat(F.lit("  "), "url", F.lit("\n"))
    )
    choice = I.choose_source(path, url)
    return _pages(spark, folder).select("page_id", choice.alias("c")).select(
        "page_id", "c.path", "c.url", "c.error"
    )


def calls_of(events):
    """Every event as a call; a fifth of them without a key."""
    tools = {
        "view": "inspect_document",
        "signup": "triage_document",
        "click": "compare_documents",
        "purchase": "inspect_case",
        "error": "check_redaction",
    }
    tool = F.when(F.lit(False), "")
    for event, name in tools.items():
        tool = tool.when(F.col("event_type") == event, name)
    return events.select(
        F.col("event_id").alias("call_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(F.col("user_id") % 5 != 0, F.concat(F.lit("key-"), "user_id")).alias("key"),
        F.concat(F.lit("caller-"), F.col("event_id") % 50).alias("caller"),
        tool.alias("tool"),
        (F.col("event_id") % 9 + 2).alias("n_docs"),
    )


CALLS_SQL = """calls AS (SELECT event_id AS call_id, ts, event_id,
    CASE WHEN user_id % 5 <> 0 THEN 'key-' || user_id END AS key,
    'caller-' || (event_id % 50) AS caller,
    user_id % 5 = 0 AND event_type IN ('click', 'purchase') AS refused,
    CASE WHEN user_id % 5 = 0 AND event_type IN ('click', 'purchase') THEN 0
         WHEN event_type = 'click' THEN 2 WHEN event_type = 'purchase' THEN event_id % 9 + 2 ELSE 1 END AS cost
    FROM events)"""

USED_SQL = """SELECT coalesce(key, caller) AS account, key IS NULL AS anonymous,
        strftime(CASE WHEN key IS NULL THEN date_trunc('hour', ts) ELSE date_trunc('month', ts) END, '%Y-%m-%d %H:%M:%S') AS period,
        CAST(sum(cost) AS BIGINT) AS documents, count(*) FILTER (NOT refused) AS calls,
        count(*) FILTER (refused) AS refused FROM calls"""


@query(f"""WITH {CALLS_SQL},
    used AS ({USED_SQL} GROUP BY ALL)
    SELECT *, documents > CASE WHEN anonymous THEN 10 ELSE 50 END AS over FROM used
""")
def usage_metering(spark, folder):
    used = M.usage(calls_of(read_table(spark, folder, "events")))
    return used.withColumn("period", F.date_format("period", "yyyy-MM-dd HH:mm:ss"))


@query("""
    SELECT doc_id AS call_id, source AS tenant, CAST(1704067200 + doc_id * 60 AS BIGINT) AS ts,
           sha256(text) AS sha256,
           CASE doc_id % 3 WHEN 0 THEN '' WHEN 1 THEN 'macros' ELSE 'macros,links' END AS signal_ids,
           CAST(doc_id % 101 AS DOUBLE) AS score
    FROM documents
""")
def call_ledger(spark, folder):
    signals = F.slice(
        F.array(
            F.struct(F.lit("macros").alias("id"), F.col("text").alias("evidence")),
            F.struct(F.lit("links").alias("id"), F.col("text").alias("evidence")),
        ),
        F.lit(1),
        (F.col("doc_id") % 3).cast("int"),
    )
    done = P.documents(spark, folder).select(
        F.col("doc_id").alias("call_id"),
        F.col("source").alias("tenant"),
        F.timestamp_seconds(F.col("doc_id") * 60 + 1704067200).alias("ts"),
        F.encode("text", "UTF-8").alias("content"),
        signals.alias("signals"),
        (F.col("doc_id") % 101).alias("score"),
    )
    return M.ledger(done).withColumns({
        "signal_ids": F.array_join("signal_ids", ","),
        "ts": F.unix_seconds("ts"),
    })


@query("""
    WITH calls AS (SELECT doc_id AS call_id, lang AS tenant, sha256(text) AS sha256,
                          1704067200 + doc_id % 97 * 60 AS ts FROM documents)
    SELECT c.call_id, c.tenant, count(e.call_id) > 0 AS seen_before,
           arg_min(e.call_id, (e.ts, e.call_id)) AS first_call_id
    FROM calls c LEFT JOIN calls e ON c.tenant = e.tenant AND c.sha256 = e.sha256
         AND (e.ts, e.call_id) < (c.ts, c.call_id)
    GROUP BY c.call_id, c.tenant
""")
def tenant_matches(spark, folder):
    sent = P.documents(spark, folder).select(
        F.col("doc_id").alias("call_id"),
        F.col("lang").alias("tenant"),
        F.sha2("text", 256).alias("sha256"),
        F.timestamp_seconds(F.col("doc_id") % 97 * 60 + 1704067200).alias("ts"),
    )
    return M.tenant_matches(sent).select(
        "call_id", "tenant", "seen_before", "first_call_id"
    )


@query("""
    SELECT doc_id, lang, CASE WHEN n_chars < 500 THEN 'too short' END AS error,
           CASE WHEN n_chars < 500 THEN 'rejects' ELSE 'results' END AS part FROM documents
""")
def sink_roundtrip(spark, folder):
    """Two batches, one of them written twice: both parts add up to the input once."""
    location = f"{shared_folder(spark)}/sink-{uuid.uuid4().hex}"
    error = F.when(F.col("n_chars") < 500, "too short").cast("string")
    docs = P.documents(spark, folder).select("doc_id", "lang", error.alias("error"))
    for batch in ("even", "odd", "even"):
        mine = docs.where(F.col("doc_id") % 2 == (0 if batch == "even" else 1))
        sinks.write_results(mine, location, F.col("error"), batch, ("lang",))
    read = lambda part: sinks.read_results(spark, location, docs.schema, part).withColumn("part", F.lit(part))
    return read(sinks.RESULTS).unionByName(read(sinks.REJECTS))
