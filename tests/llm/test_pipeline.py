"""The stages on a small table, each against its operator's promise."""

import sys
from pathlib import Path

import brute
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))
import check_oracles
import corpus_pipeline
from paperward.llm import queries

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    steps = [docs]
    for _, stage in corpus_pipeline.STAGES:
        steps.append(stage(spark, steps[-1], FOLDER).checkpoint())
    assert all(s.columns == docs.columns and s.schema["n_chars"].dataType == docs.schema["n_chars"].dataType for s in steps[:-1])
    rows = [{r["doc_id"]: r["text"] for r in s.collect()} for s in steps[:-1]]
    ruled, scored, single, cut = rows[1:]
    clean = [i for i, t in rows[0].items() if labels.get(i) == 1 and brute.counts(t)[0] >= 20]
    assert all(i in scored for i in clean)
    assert not [i for i in scored if labels.get(i) == 0]
    groups = brute.jaccard_components(scored.items())
    assert set(single) == {c if n else i for i, (n, c) in groups.items()}
    want = brute.cut(single.items())
    assert set(cut) == set(single)
    assert all((cut[i] == single[i]) == (want[i][1] == 0) for i in cut)
    packed = steps[-1].toPandas()
    assert set(packed["doc_id"]) == set(cut)
    assert corpus_pipeline.run(spark, FOLDER).count() == len(packed)


def test_empty_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
        assert docs.count() == 0


@pytest.mark.parametrize("name", list(queries.all_oracles()))
def test_sql(spark, name):
    result = check_oracles.compare(spark, check_oracles.database(FOLDER), FOLDER, name)
    assert result.startswith("ok"), result
