"""Files, folders and sinks."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from paperward.operators.metering import ledger
from paperward.queries.intake import MANIFEST_PLANTS, PATH_PLANTS, ROOTS_SETTING
from paperward.sources import intake as I
from paperward.sources import sinks as S

LIMIT = 10 * 1024 * 1024


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    base = tmp_path_factory.mktemp("intake")
    (base / "a.pdf").write_bytes(b"x" * 10)
    (base / "empty.pdf").write_bytes(b"")
    (base / "sub").mkdir()
    (base / "sub" / "limit.pdf").write_bytes(b"x" * LIMIT)
    (base / "sub" / "big.pdf").write_bytes(b"x" * (LIMIT + 1))
    return base


def test_files_on_disk(spark, folder, tmp_path):
    (tmp_path / "secret").write_text("x")
    link = folder / "link.pdf"
    if not link.is_symlink():
        link.symlink_to(tmp_path / "secret")
    names = ["a.pdf", "empty.pdf", "sub/limit.pdf", "sub/big.pdf", "none.pdf", "sub", "link.pdf"]
    wanted = spark.createDataFrame([(f"{folder}/{n}",) for n in names] + [("rel.pdf",)], "path string")
    listed = I.check_manifest(I.manifest(wanted, I.scan_documents(spark, str(folder))))
    reasons = {r["path"].replace(f"{folder}/", ""): r["reason"] for r in listed.collect()}
    assert [reasons[n] for n in names[:5]] == ["accepted", "missing", "accepted", "too-large", "missing"]


def test_listing_opens_no_file(spark, folder):
    plan = I.scan_documents(spark, str(folder)).select("path", "length").where(f"length <= {LIMIT}")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "content" not in text.split("ReadSchema")[1]
    assert "LessThanOrEqual(length" in text


def test_loaded_documents(spark, folder):
    docs = I.load_documents(spark, str(folder))
    out = {r["name"]: r for r in docs.collect()}
    assert (out["a.pdf"]["length"], out["a.pdf"]["sha256"]) == (10, hashlib.sha256(b"x" * 10).hexdigest())
    assert out["limit.pdf"]["reason"] == "accepted" and len(out["limit.pdf"]["content"]) == LIMIT
    assert (out["big.pdf"]["reason"], out["big.pdf"]["content"], out["big.pdf"]["sha256"]) == ("too-large", None, None)


def test_manifest_by_hand(spark):
    rows = [(i, p, e, f, 5 if n < 0 else n) for i, (p, e, f, n, _) in enumerate(MANIFEST_PLANTS)]
    df = spark.createDataFrame(rows, "i int, path string, exists boolean, is_file boolean, length bigint")
    for r in I.check_manifest(df, ["/intake"]).collect():
        assert r["reason"] == MANIFEST_PLANTS[r["i"]][4]
    free = {r["i"]: r["reason"] for r in I.check_manifest(df).collect()}
    assert free[7] == "too-large"


def test_resolved_path_decides(spark):
    df = spark.createDataFrame([("/intake/link.pdf", "/etc/passwd", True, True, 5)],
                               "path string, real_path string, exists boolean, is_file boolean, length bigint")
    assert I.check_manifest(df, ["/intake"]).first()["reason"] == "outside-allowed"


def test_roots(spark):
    assert I.parse_roots(ROOTS_SETTING) == ["/intake", "/srv/docs", "/box"]
    assert I.parse_roots(None) == [] and I.parse_roots(" , :") == []
    df = spark.createDataFrame(PATH_PLANTS, "path string, want boolean")
    got = I.inside_allowed(F.col("path"), I.parse_roots(ROOTS_SETTING))
    assert df.where(got != F.col("want")).count() == 0
    assert df.where(~I.inside_allowed(F.col("path"), ["/"])).count() == 0


def test_source_choice(spark):
    rows = [("/a", None), (None, " u\n"), ("/a", "u"), (None, None), ("", " "), (" /a ", ""), (" ", "u")]
    df = spark.createDataFrame(rows, "p string, u string")
    out = [tuple(r["c"]) for r in df.select(I.choose_source(F.col("p"), F.col("u")).alias("c")).collect()]
    assert out == [
        ("/a", None, None), (None, "u", None), (None, None, I.BOTH), (None, None, I.NEITHER),
        (None, None, I.NEITHER), (" /a ", None, None), (None, "u", None),
    ]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "bad"), (3, None)], "id int, error string")
    out = str(tmp_path / "out")
    ids = lambda part: sorted(r["id"] for r in S.read_results(spark, out, df.schema, part).collect())
    S.write_results(df, out, F.col("error"), "a")
    assert ids(S.RESULTS) == [1, 3] and ids(S.REJECTS) == [2]
    S.write_results(df, out, F.col("error"), "a")  # a retry
    S.write_results(df.where("id = 3"), out, F.col("error"), 7)
    assert ids(S.RESULTS) == [1, 3, 3] and ids(S.REJECTS) == [2]
    S.write_results(df.where("id = 1"), out, F.col("error"), "a")  # nothing of the first attempt stays
    assert ids(S.RESULTS) == [1, 3] and ids(S.REJECTS) == []
    S.write_results(df.limit(0), out, F.col("error"), "a")
    assert ids(S.RESULTS) == [3]
    with pytest.raises(ValueError, match="batch name"):
        S.write_results(df, out, F.col("error"), "../a")


def test_sink_of_a_stream_that_runs_again(spark, tmp_path):
    """The state is lost and the stream runs anew: each micro-batch replaces itself."""
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    for i in range(3):
        spark.range(i * 10, i * 10 + 10).selectExpr("id", "if(id % 4 = 0, 'bad', null) AS error").coalesce(1).write.mode("append").parquet(src)
    schema = spark.read.parquet(src).schema
    for attempt in range(2):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
        stream.writeStream.foreachBatch(S.results_sink(out, F.col("error"))).option(
            "checkpointLocation", str(tmp_path / f"state{attempt}")
        ).trigger(availableNow=True).start().awaitTermination()
    parts = [{r["id"] for r in S.read_results(spark, out, schema, p).collect()} for p in (S.RESULTS, S.REJECTS)]
    assert len(parts[0]) == 22 and parts[0] | parts[1] == set(range(30)) and not parts[0] & parts[1]
    assert S.read_results(spark, out, schema).count() == 22


def test_ledger_sink(spark, tmp_path):
    calls = spark.createDataFrame(
        [(1, "t", dt.datetime(2024, 1, d), bytearray(b"x"), 3, [("a",)]) for d in (1, 2)],
        "call_id int, tenant string, ts timestamp, content binary, score int, signals array<struct<id string>>",
    )
    for batch in ("a", "b", "b"):
        S.append_ledger(ledger(calls), str(tmp_path / "ledger"), batch)
    back = spark.read.parquet(str(tmp_path / "ledger"))
    assert back.count() == 4 and sorted(p.name for p in (tmp_path / "ledger").glob("batch=a/day=*")) == [
        "day=2024-01-01", "day=2024-01-02"]
    assert set(back.columns) == {"call_id", "tenant", "ts", "sha256", "signal_ids", "score", "day", "batch"}
