"""What the plans of the queries must look like."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from paperward.operators import cases as K
from paperward.operators import classify as C
from paperward.operators import network as N
from paperward.operators.redact import redact_reports
from paperward.queries import all_queries
from paperward.queries import text as text_queries

FOLDER = "/root/testdata/sf0.001"
BATCH = [n for n in all_queries() if not n.startswith("stream_")]


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def nodes(plan, name):
    return len(re.findall(rf"^[\s:+\-|*()0-9]*{name}\b", plan, re.M))


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_joins(spark, name):
    plan = physical(entry.queries()[name](spark, FOLDER))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan


def test_text_is_normalized_once(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = C.with_match(docs, "text").where("match is not null and lang = 'en'")
    out = out.where("match.confidence = 'confident'").groupBy("match.confidence").count()
    plan = optimized(out)
    assert plan.count("unicode_forms(") == 1
    assert plan.count("translate(") == 1
    # one constant: the phrase, and the stem it is filed under
    assert plan.count("endoftext") == 2
    # other filters still reach the scan, other columns are not read
    scan = physical(out)
    assert "EqualTo(lang,en)" in scan
    assert "ReadSchema: struct<text:string,lang:string>" in scan


def test_classification_does_not_shuffle(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert nodes(physical(C.with_match(docs, "text")), "Exchange") == 0
    assert nodes(physical(redact_reports(docs, "text")), "Exchange") == 0


def test_case_rules_share_one_shuffle(spark):
    docs = spark.createDataFrame(
        [], "case_id int, doc_idx int, sha256 string, bytes bigint, permanent_id string, created timestamp"
    )
    plan = physical(K.validate(K.assemble(docs)).transform(K.with_findings))
    assert nodes(plan, "Exchange") == 1


def test_address_screen_needs_no_join(spark):
    ips = spark.createDataFrame([("h", "1.1.1.1")], "host string, ip string")
    plan = physical(N.screen_hosts(ips, ["::1"]))
    assert "Join" not in plan and nodes(plan, "Exchange") == 1
    assert "partial_bool_or" in plan or "partial_max" in plan


def test_triage_reads_no_text(spark):
    """Cheap questions must not pull the big column."""
    plan = physical(entry.queries()["field_kind_check"](spark, FOLDER))
    assert "text:string" not in plan.split("ReadSchema")[1]
    plan = physical(entry.queries()["case_numbering"](spark, FOLDER))
    assert "text:string" not in plan.split("ReadSchema")[1]


def test_ascii_text_crosses_to_python_as_null(spark):
    from paperward.functions import unicode as U

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert docs.where(U.needs_unicode(F.col("text"))).count() == 0


def test_queries_and_checks_pair_up():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(text_queries.QUERIES) >= 16


def test_entry(spark):
    out = entry.entry(spark)
    assert out.columns[:2] == ["lexicon_version", "lang"] and out.count() == 4


def test_sql_names_are_native(spark):
    """Arrow is for the Unicode tail alone; addresses need none."""
    plan = physical(entry.queries()["sql_classify_injection"](spark, FOLDER))
    arrow = [line for line in plan.splitlines() if "EvalPython" in line]
    assert arrow and all("ArrowEvalPython [paperward_plain_form(" in line for line in arrow)
    assert "EvalPython" not in physical(entry.queries()["sql_blocked_ip"](spark, FOLDER))
