"""Queries over cases of several documents, and over compared pairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from paperward.operators import cases as K
from paperward.operators import compare as M
from paperward.queries import planted as P
from paperward.queries.registry import registry
from paperward.sources.tables import read_table

QUERIES, ORACLES, query = registry()


# -- the case table ---------------------------------------------------------


# Kind and index of the documents of added cases, and what keeps their ids apart.
_MORE = [(1, 0), (2, 1), (2, 2), (3, 0), (3, 1)]
_APART = 10_000_000


def case_documents(spark, folder):
    """Every conversation as a case, all its turns as documents.

    Some cases get more documents, up to ten or eleven; in others two documents share
    bytes, a base file or a second, and some are far too large together.  For every
    tenth conversation there are three more cases: one of a single document, one that is
    numbered from 1, and one whose second document could not be loaded.
    """
    turns = read_table(spark, folder, "conversations")
    case = F.col("case_id")
    idx = F.col("doc_idx")
    sizes = turns.groupBy(F.col("conv_id").alias("case_id")).agg(
        (F.max("turn") + 1).alias("n")
    )
    wanted = (
        F.when(case % 10 == 1, F.greatest("n", F.lit(10)))
        .when(case % 10 == 2, F.greatest("n", F.lit(11)))
        .otherwise(F.col("n"))
    )
    own = F.transform(
        F.sequence(F.lit(0), (wanted - 1).cast("int")),
        lambda i: F.struct(F.lit(0).alias("more"), i.alias("doc_idx")),
    )
    more = F.array(*[F.struct(F.lit(k).alias("more"), F.lit(i).alias("doc_idx")) for k, i in _MORE])
    numbered = sizes.select(
        "case_id", F.explode(F.when(case % 10 == 0, F.concat(own, more)).otherwise(own)).alias("_d")
    ).select((case + F.col("_d.more") * _APART).alias("case_id"), "_d.doc_idx")
    texts = turns.select(
        F.col("conv_id").alias("case_id"), F.col("turn").cast("int").alias("doc_idx"), "text"
    )
    docs = numbered.join(texts, ["case_id", "doc_idx"], "left").withColumn(
        "text", F.coalesce("text", F.concat_ws("-", F.lit("extra"), "case_id", "doc_idx"))
    )
    early = idx.isin(0, 1)
    own = F.concat_ws("-", "case_id", "doc_idx")
    bytes_ = F.length("text") * F.when(case % 6 == 5, 20000).otherwise(10)
    tags = F.when(
        (case % 4 == 3) & idx.isin(1, 2),
        F.when(idx == 1, F.array(F.lit("ABCDEF+Arial"), F.lit("GHIJKL+Times")))
        .otherwise(F.array(F.lit("GHIJKL+Times"), F.lit("ABCDEF+Arial"))),
    ).otherwise(F.array().cast("array<string>"))
    millis = case * 3600000 + F.when((case % 4 == 2) & early, idx * 100).otherwise(idx * 61000)
    return docs.select(
        "case_id",
        "doc_idx",
        F.format_string("doc_%d.pdf", idx).alias("name"),
        bytes_.cast("bigint").alias("bytes"),
        F.sha2(F.when((case % 4 == 0) & early, F.concat(F.lit("same"), case)).otherwise(F.col("text")), 256)
        .alias("sha256"),
        F.when((case % 4 == 1) & early, F.concat(F.lit("pid-"), case))
        .when(idx % 2 == 0, F.concat(F.lit("pid-"), own))
        .alias("permanent_id"),
        tags.alias("font_tags"),
        F.timestamp_millis(F.lit(1704067200000) + millis).alias("created"),
        F.when((F.floor(case / _APART) == 3) & (idx == 1), "not a file").alias("load_error"),
    )


_CASES = f"""
    sizes AS (SELECT conv_id AS case_id, max(turn) + 1 AS n FROM conversations GROUP BY conv_id),
    more(kind, idx) AS (VALUES {', '.join(map(str, _MORE))}),
    numbered AS (SELECT case_id, unnest(range(CASE case_id % 10 WHEN 1 THEN greatest(n, 10)
                 WHEN 2 THEN greatest(n, 11) ELSE n END)) AS doc_idx FROM sizes
                 UNION ALL
                 SELECT case_id + kind * {_APART}, idx FROM sizes, more WHERE case_id % 10 = 0),
    texts AS (SELECT n.case_id, n.doc_idx,
                     coalesce(c.text, 'extra-' || n.case_id || '-' || n.doc_idx) AS text
              FROM numbered n LEFT JOIN conversations c
              ON c.conv_id = n.case_id AND c.turn = n.doc_idx),
    docs AS (SELECT case_id, doc_idx, 'doc_' || doc_idx || '.pdf' AS name,
        length(text) * CASE WHEN case_id % 6 = 5 THEN 20000 ELSE 10 END AS bytes,
        sha256(CASE WHEN case_id % 4 = 0 AND doc_idx < 2 THEN 'same' || case_id ELSE text END) AS sha,
        CASE WHEN case_id % 4 = 1 AND doc_idx < 2 THEN 'pid-' || case_id
             WHEN doc_idx % 2 = 0 THEN 'pid-' || case_id || '-' || doc_idx END AS pid,
        CASE WHEN case_id % 4 = 3 AND doc_idx IN (1, 2) THEN 'ABCDEF+Arial GHIJKL+Times' END AS tags,
        case_id * 3600 + CASE WHEN case_id % 4 = 2 AND doc_idx < 2 THEN 0 ELSE doc_idx * 61 END AS second,
        case_id // {_APART} = 3 AND doc_idx = 1 AS failed
        FROM texts),
    running AS (SELECT *, sum(bytes) OVER (PARTITION BY case_id ORDER BY doc_idx) AS running,
                count(*) OVER (PARTITION BY case_id) AS n_docs FROM docs),
    judged AS (SELECT case_id, any_value(n_docs) AS n_docs,
              min(doc_idx) = 0 AND max(doc_idx) = count(*) - 1 AND count(DISTINCT doc_idx) = count(*) AS numbered,
              min(doc_idx) FILTER (running > 31457280) AS over_any, min(doc_idx) FILTER (failed) AS failed_idx
              FROM running GROUP BY case_id),
    valid AS (SELECT case_id, n_docs, CASE WHEN n_docs BETWEEN 2 AND 10 AND numbered THEN over_any END AS over_idx,
              CASE WHEN n_docs NOT BETWEEN 2 AND 10
                THEN 'a case takes 2 to 10 documents (paths and urls together); got '
                  || n_docs || '. For one document, use inspect_document.'
              WHEN NOT numbered THEN 'document numbers must be 0 to n-1, each once'
              WHEN failed_idx <= coalesce(over_any, 10) THEN 'document ' || failed_idx || ': not a file'
              WHEN over_any IS NOT NULL
                THEN 'the documents of one case may add up to 30 MB; this one is over that by document '
                  || over_any || '. Send fewer or smaller files.' END AS error
              FROM judged),
    good AS (SELECT case_id FROM valid WHERE error IS NULL),
    gdocs AS (SELECT docs.* FROM docs JOIN good ON docs.case_id = good.case_id),
    same AS (SELECT case_id, 'same-file' AS code, list(doc_idx ORDER BY doc_idx) AS documents
             FROM gdocs GROUP BY case_id, sha HAVING count(*) > 1),
    base AS (SELECT DISTINCT * FROM (
             SELECT case_id, 'same-base-file' AS code, list(doc_idx ORDER BY doc_idx) AS documents
             FROM gdocs WHERE pid IS NOT NULL GROUP BY case_id, pid HAVING count(DISTINCT sha) > 1
             UNION ALL
             SELECT case_id, 'same-base-file', list(doc_idx ORDER BY doc_idx)
             FROM gdocs WHERE tags IS NOT NULL GROUP BY case_id, tags HAVING count(DISTINCT sha) > 1)),
    instant AS (SELECT case_id, 'shared-creation-instant' AS code,
                list(doc_idx ORDER BY doc_idx) AS documents
                FROM gdocs GROUP BY case_id, second HAVING count(DISTINCT sha) > 1)"""


def _cases(spark, folder):
    return K.validate(K.assemble(case_documents(spark, folder)))


def _found(cases, rule):
    ok = cases.where("error is null")
    return ok.select("case_id", F.explode(rule(F.col("docs"))).alias("f")).select(
        "case_id", "f.code", F.array_join(F.col("f.documents").cast("array<string>"), ",").alias("documents")
    )


def _found_sql(table: str) -> str:
    return f"""WITH {_CASES}
    SELECT case_id, code, array_to_string(documents, ',') AS documents FROM {table}"""


@query(_found_sql("same"))
def case_same_file(spark, folder):
    return _found(_cases(spark, folder), K.same_file)


@query(_found_sql("base"))
def case_same_base_file(spark, folder):
    return _found(_cases(spark, folder), K.same_base_file)


@query(_found_sql("instant"))
def case_shared_instant(spark, folder):
    return _found(_cases(spark, folder), K.shared_instant)


@query(f"""WITH {_CASES}
    SELECT case_id, n_docs, over_idx, error FROM valid
""")
def case_validate(spark, folder):
    return _cases(spark, folder).select(
        "case_id", "n_docs", F.col("over_idx").cast("bigint").alias("over_idx"), "error"
    )


@query(f"""WITH {_CASES}
    SELECT case_id, doc_idx, bytes, CAST(running AS BIGINT) AS running FROM running
    JOIN judged USING (case_id) WHERE judged.n_docs BETWEEN 2 AND 10 AND numbered
""")
def case_running_bytes(spark, folder):
    cases = K.assemble(case_documents(spark, folder))
    cases = cases.where(K.count_ok(F.col("n_docs")) & F.col("numbered"))
    return cases.select(
        "case_id", F.explode(K.running_bytes(F.col("docs"))).alias("d")
    ).select(
        "case_id", F.col("d.doc_idx").cast("bigint").alias("doc_idx"), "d.bytes", "d.running"
    )


_LINES = """
    bodies AS (SELECT case_id, doc_idx, name, (case_id * 7 + doc_idx) % 101 AS score,
               CASE WHEN (case_id + doc_idx) % 11 = 10 THEN 3 ELSE (case_id + doc_idx) % 3 END AS kind FROM docs),
    lines AS (SELECT case_id, doc_idx, '[' || doc_idx || '] ' || name || CASE kind
        WHEN 0 THEN ': not analysed (unsupported)'
        WHEN 3 THEN ': not analysed (no report)'
        WHEN 1 THEN ': risk ' || score || '/100 (low). No signals above info severity. Risk signals'
             || ' are not a verdict — benign causes are documented per signal.'
        ELSE ': risk ' || score || '/100 (?), your policy says review. Signals: macros, links Risk signals'
             || ' are not a verdict — benign causes are documented per signal.' END AS line
        FROM bodies)"""


def _reports(docs):
    score = ((F.col("case_id") * 7 + F.col("doc_idx")) % 101).cast("string")
    kind = (F.col("case_id") + F.col("doc_idx")) % 3
    body = (
        F.when(kind == 0, '{"error":"unsupported"}')
        .when(
            kind == 1,
            F.concat(
                F.lit('{"summary":{"riskScore":'), score,
                F.lit(',"riskBand":"low"},"signals":[{"id":"x","severity":"info"}]}'),
            ),
        )
        .otherwise(
            F.concat(
                F.lit('{"summary":{"riskScore":'), score,
                F.lit(
                    '},"policy":{"verdict":"review"},"signals":[{"id":"macros","severity":"low"},{"id":"links"}]}'
                ),
            )
        )
    )
    # some documents have none
    there = docs.where((F.col("case_id") + F.col("doc_idx")) % 11 != 10)
    return there.select("case_id", "doc_idx", body.alias("body"))


@query(f"WITH {_CASES}, {_LINES} SELECT case_id, doc_idx, line FROM lines")
def case_report_lines(spark, folder):
    docs = case_documents(spark, folder)
    return K.report_lines(docs, _reports(docs)).withColumn(
        "doc_idx", F.col("doc_idx").cast("bigint")
    )


@query(f"""WITH {_CASES},
    found AS (SELECT *, 1 AS ord FROM same UNION ALL SELECT *, 2 FROM base
              UNION ALL SELECT *, 3 FROM instant),
    listed AS (SELECT case_id, string_agg(code || ' [' || array_to_string(documents, ', ') || ']', '; '
               ORDER BY ord, documents) AS listed FROM found GROUP BY case_id)
    SELECT good.case_id, CASE WHEN listed IS NULL
        THEN 'Across the case: no inconsistencies between the documents. That is not proof they are independent or authentic.'
        ELSE 'Across the case, inconsistencies to review (not verdicts): ' || listed || '.' END AS summary
    FROM good LEFT JOIN listed ON good.case_id = listed.case_id
""")
def case_summary(spark, folder):
    cases = _cases(spark, folder).transform(K.with_findings).where("error is null")
    return cases.select("case_id", K.cross_line(F.col("findings")).alias("summary"))


@query(f"""WITH {_CASES}, {_LINES},
    found AS (SELECT *, 1 AS ord FROM same UNION ALL SELECT *, 2 FROM base
              UNION ALL SELECT *, 3 FROM instant),
    listed AS (SELECT case_id, string_agg(code || ' [' || array_to_string(documents, ', ') || ']', '; '
               ORDER BY ord, documents) AS listed FROM found GROUP BY case_id),
    bodies2 AS (SELECT case_id, string_agg(line, chr(10) ORDER BY doc_idx) AS body FROM lines GROUP BY case_id)
    SELECT valid.case_id, good.case_id IS NULL AS refused, CASE
        WHEN good.case_id IS NOT NULL THEN body || chr(10) || CASE WHEN listed IS NULL
            THEN 'Across the case: no inconsistencies between the documents. That is not proof they are independent or authentic.'
            ELSE 'Across the case, inconsistencies to review (not verdicts): ' || listed || '.' END
        ELSE error END AS text
    FROM valid LEFT JOIN good ON valid.case_id = good.case_id
    LEFT JOIN listed ON valid.case_id = listed.case_id
    LEFT JOIN bodies2 ON valid.case_id = bodies2.case_id
""")
def case_answer(spark, folder):
    docs = case_documents(spark, folder)
    return K.inspect_cases(docs, _reports(docs)).drop("findings")


_FILES = """files AS (SELECT doc_id // 3 AS case_id, doc_id % 3 AS doc_idx, doc_id,
        CASE WHEN doc_id % 40 = 9 THEN 'rel/' WHEN doc_id % 30 = 11 THEN '/out/' ELSE '/in/' END || doc_id || '.pdf' AS path,
        doc_id % 20 = 7 AS missing, doc_id % 20 = 13 AS folder,
        CASE WHEN doc_id % 50 = 31 THEN 11534336 WHEN doc_id % 50 = 41 THEN 0 ELSE n_chars END AS length FROM documents),
    told AS (SELECT *, CASE WHEN path NOT LIKE '/%' THEN 'path must be absolute, got "' || path || '"'
        WHEN missing THEN 'no file at ' || path WHEN folder THEN path || ' is not a file'
        WHEN length = 0 THEN path || ' is empty'
        WHEN path LIKE '/out/%' THEN path || ' is outside the directories this server is allowed to read. Move the file into an allowed directory or send it by url.'
        WHEN length > 10485760 THEN path || ' is 11.0 MB, over the 10 MB limit.' END AS error FROM files)"""


@query(f"""WITH {_FILES},
    per_case AS (SELECT case_id, count(*) AS n, min(CASE WHEN error IS NOT NULL THEN doc_idx END) AS failed,
        min_by(error, doc_idx) FILTER (error IS NOT NULL) AS error,
        string_agg('[' || doc_idx || '] ' || doc_id || '.pdf: not analysed (unsupported)', chr(10) ORDER BY doc_idx) AS body
        FROM told GROUP BY case_id)
    SELECT case_id, n NOT BETWEEN 2 AND 10 OR error IS NOT NULL AS refused, CASE
        WHEN n NOT BETWEEN 2 AND 10 THEN 'a case takes 2 to 10 documents (paths and urls together); got ' || n || '. For one document, use inspect_document.'
        WHEN error IS NOT NULL THEN 'document ' || failed || ': ' || error
        ELSE body || chr(10) || 'Across the case: no inconsistencies between the documents. That is not proof they are independent or authentic.'
        END AS text FROM per_case
""")
def case_from_files(spark, folder):
    """Cases of three files each; some files are refused by the intake rules."""
    key = F.col("doc_id")
    lead = F.when(key % 40 == 9, "rel/").when(key % 30 == 11, "/out/").otherwise("/in/")
    files = read_table(spark, folder, "documents").select(
        F.floor(key / 3).alias("case_id"), (key % 3).alias("doc_idx"), F.concat(lead, key, F.lit(".pdf")).alias("path"),
        (key % 20 != 7).alias("exists"), (key % 20 != 13).alias("is_file"),
        F.when(key % 50 == 31, 11 << 20).when(key % 50 == 41, 0).otherwise(F.col("n_chars")).cast("bigint").alias("length"),
    )
    reports = files.select("case_id", "doc_idx", F.lit('{"error":"unsupported"}').alias("body"))
    return K.inspect_case_files(files, reports, ["/in"]).drop("findings")


@query("""
    WITH lists AS (SELECT doc_id, list_transform(range(doc_id % 4), lambda i: '/in/' || doc_id || '/' || i) AS paths,
        list_transform(range(doc_id % 3), lambda i: 'https://x.example/' || lang || i) AS urls FROM documents),
    pairs AS (SELECT doc_id, unnest(list_concat(paths, urls)) AS source,
              generate_subscripts(list_concat(paths, urls), 1) - 1 AS doc_idx,
              len(paths) AS n FROM lists)
    SELECT doc_id AS case_id, doc_idx, CASE WHEN doc_idx < n THEN 'path' ELSE 'url' END AS source_kind, source
    FROM pairs
""")
def case_numbering(spark, folder):
    docs = read_table(spark, folder, "documents").select(
        F.col("doc_id").alias("case_id"),
        F.expr(
            "transform(slice(array(0, 1, 2, 3), 1, cast(doc_id % 4 as int)),"
            " i -> concat('/in/', doc_id, '/', i))"
        ).alias("paths"),
        F.expr(
            "transform(slice(array(0, 1, 2), 1, cast(doc_id % 3 as int)),"
            " i -> concat('https://x.example/', lang, i))"
        ).alias("urls"),
    )
    return K.number_sources(docs).withColumn("doc_idx", F.col("doc_idx").cast("bigint"))


# -- comparisons ------------------------------------------------------------


def _versions(spark, folder):
    """Two versions of each document: same, longer, shorter, rewritten."""
    turn = F.col("doc_id") % 4
    tail = F.concat("text", F.lit(" appended revision"))
    return P.documents(spark, folder).select(
        "doc_id",
        F.when(turn == 2, tail).otherwise(F.col("text")).alias("original"),
        F.when(turn == 1, tail)
        .when(turn == 3, F.reverse("text"))
        .otherwise(F.col("text"))
        .alias("candidate"),
    )


_VERSIONS = """versions AS (SELECT doc_id,
        CASE WHEN doc_id % 4 = 2 THEN text || ' appended revision' ELSE text END AS original,
        CASE doc_id % 4 WHEN 1 THEN text || ' appended revision' WHEN 3 THEN reverse(text) ELSE text END
        AS candidate FROM documents)"""

_RELATION = """CASE WHEN original = candidate THEN 'identical'
        WHEN starts_with(candidate, original) THEN 'candidate-extends-original'
        WHEN starts_with(original, candidate) THEN 'candidate-truncates-original'
        ELSE 'rewritten' END"""


@query(f"WITH {_VERSIONS} SELECT doc_id AS pair_id, {_RELATION} AS relationship FROM versions")
def compare_relationship(spark, folder):
    """Versions kept in two tables, compared by digest and prefix digest."""
    v = _versions(spark, folder)
    pairs = v.select(
        F.col("doc_id").alias("pair_id"),
        F.col("doc_id").alias("original_id"),
        F.col("doc_id").alias("candidate_id"),
    )
    originals = v.select(
        F.col("doc_id").alias("id"), F.encode("original", "UTF-8").alias("content")
    )
    candidates = v.select(
        F.col("doc_id").alias("id"), F.encode("candidate", "UTF-8").alias("content")
    )
    return M.relate(pairs, originals, candidates).select("pair_id", "relationship")


@query(f"""WITH {_VERSIONS}, r AS (SELECT doc_id, {_RELATION} AS rel FROM versions)
    SELECT doc_id, 'a.pdf vs b.pdf: ' || rel || ' — ' || CASE rel
        WHEN 'identical' THEN 'the files are byte-identical — this is the only result that is a proof'
        WHEN 'candidate-extends-original' THEN 'the candidate contains the original verbatim and appends revisions to it'
        WHEN 'candidate-truncates-original' THEN 'the candidate is a prefix of the original'
        ELSE 'both files were written whole, so only a structural diff is possible' END AS line FROM r
""")
def compare_line(spark, folder):
    """Both versions in one row: no join at all."""
    v = _versions(spark, folder)
    rel = M.relationship(F.encode("original", "UTF-8"), F.encode("candidate", "UTF-8"))
    return v.select("doc_id", rel.alias("_r")).select(
        "doc_id",
        M.relation_line(F.lit("a.pdf"), F.lit("b.pdf"), F.col("_r")).alias("line"),
    )


def _metadata(spark, folder, side: str):
    """Long table of metadata fields; some vanish, appear or change."""
    key = F.col("doc_id")
    common = [("Producer", F.col("lang")), ("Title", F.col("source"))]
    if side == "original":
        fields = [*common, ("Creator", F.when(key % 3 != 0, F.lit("Writer"))),
                  ("Length", F.col("n_chars").cast("string"))]
        gone = key % 5 == 1
        absent = "Length"
    else:
        fields = [("Producer", F.when(key % 2 == 0, F.lit("Editor")).otherwise(F.col("lang"))),
                  common[1], ("Creator", F.when(key % 3 != 0, F.lit("Writer"))),
                  ("Length", F.col("n_chars").cast("string")), ("ModDate", F.lit("2024"))]
        gone = key % 5 == 2
        absent = "Length"
    entries = F.array(*[F.struct(F.lit(k).alias("field"), v.alias("value")) for k, v in fields])
    kept = F.filter(entries, lambda e: ~(gone & (e["field"] == absent)))
    return read_table(spark, folder, "documents").select(
        key.alias("pair_id"), F.inline(kept)
    )


@query("""
    WITH o AS (SELECT doc_id AS pair_id, 'Producer' AS field, lang AS value FROM documents
        UNION ALL SELECT doc_id, 'Title', source FROM documents
        UNION ALL SELECT doc_id, 'Creator', CASE WHEN doc_id % 3 <> 0 THEN 'Writer' END FROM documents
        UNION ALL SELECT doc_id, 'Length', CAST(n_chars AS VARCHAR) FROM documents WHERE doc_id % 5 <> 1),
    c AS (SELECT doc_id AS pair_id, 'Producer' AS field, CASE WHEN doc_id % 2 = 0 THEN 'Editor' ELSE lang END AS value
        FROM documents
        UNION ALL SELECT doc_id, 'Title', source FROM documents
        UNION ALL SELECT doc_id, 'Creator', CASE WHEN doc_id % 3 <> 0 THEN 'Writer' END FROM documents
        UNION ALL SELECT doc_id, 'Length', CAST(n_chars AS VARCHAR) FROM documents WHERE doc_id % 5 <> 2
        UNION ALL SELECT doc_id, 'ModDate', '2024' FROM documents)
    SELECT coalesce(o.pair_id, c.pair_id) AS pair_id, coalesce(o.field, c.field) AS field,
        o.value AS original, c.value AS candidate,
        CASE WHEN o.field IS NULL THEN 'added' WHEN c.field IS NULL THEN 'removed'
             WHEN o.value IS NOT DISTINCT FROM c.value THEN 'same' ELSE 'changed' END AS status
    FROM o FULL JOIN c ON o.pair_id = c.pair_id AND o.field = c.field
""")
def compare_field_diff(spark, folder):
    return M.field_diff(
        _metadata(spark, folder, "original"), _metadata(spark, folder, "candidate")
    )


_AMOUNT = "[0-9]+(?:[.,][0-9]+)*"
_TOKEN = rf"(?:[$€£]|R\$)\s?{_AMOUNT}|{_AMOUNT}\s?(?:[$€£]|USD|EUR|BRL)"


@query(f"""
    WITH v AS (SELECT doc_id, text || ' due $1,200.00, paid 35.10 EUR' AS a,
        text || ' due $1,' || (doc_id % 3 + 1) || '00.00, paid ' || (35 + doc_id % 2) || '.10 EUR' AS b FROM documents),
    t AS (SELECT doc_id, list_distinct(regexp_extract_all(a, '{_TOKEN}')) AS a,
          list_distinct(regexp_extract_all(b, '{_TOKEN}')) AS b FROM v)
    SELECT doc_id, unnest(list_filter(a, lambda x: NOT list_contains(b, x))) AS before, NULL AS after FROM t
    UNION ALL
    SELECT doc_id, NULL, unnest(list_filter(b, lambda x: NOT list_contains(a, x))) FROM t
""")
def revision_text_changes(spark, folder):
    key = F.col("doc_id")
    before = F.concat("text", F.lit(" due $1,200.00, paid 35.10 EUR"))
    after = F.concat(
        F.col("text"), F.lit(" due $1,"), key % 3 + 1, F.lit("00.00, paid "),
        key % 2 + 35, F.lit(".10 EUR"),
    )
    changes = M.text_changes(before, after)
    return P.documents(spark, folder).select("doc_id", F.inline(changes))
