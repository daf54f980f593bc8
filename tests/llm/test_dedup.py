"""Near-duplicates, similar sets and repeated passages against brute force."""

import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from paperward.llm import jaccard, neardup, substrings
from paperward.llm.grams import runs_of_group
from paperward.llm.shared import components

DOCS = "doc_id long, text string, n_words long, class string, marks int"


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def corpus(seed=3, n=120):
    """Copies, near copies, shared passages, blank, null and short texts."""
    rng = random.Random(seed)
    base = [words(rng, rng.randrange(1, 80)) for _ in range(n // 3)]
    passage = words(rng, 60)
    texts = [" ".join(b) for b in base]
    for b in base:
        near = list(b)
        for _ in range(rng.randrange(3)):
            near[rng.randrange(len(near))] = "new"
        texts.append("\t".join(near).upper())
        at = rng.randrange(len(b) + 1)
        texts.append("\n".join(b[:at] + passage[: rng.randrange(10, 60)] + b[at:]))
    texts += [None, "", " \n\t", "one", "one", "ONE", "a b c d", "a b c d e", "é ü ß", " ".join(["same"] * 50)]
    order = list(range(len(texts)))
    rng.shuffle(order)
    return list(zip(order, texts))


def frame(spark, rows):
    """With further columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows], DOCS)


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)]
    groups = brute.Groups()
    for u, v in edges:
        groups.join(u, v)
    got = components(spark.createDataFrame([*edges, (None, 1), (7, None)], "u long, v long")).collect()
    assert {r["node"]: r["component"] for r in got} == {x: groups.root(x) for x in groups.up}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_jaccard(spark):
    rows = corpus()
    got = jaccard.jaccard_classes(frame(spark, rows)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"] if r["n_shingles"] else r["doc_id"]) for r in got} == (
        brute.jaccard_components(rows)
    )


def test_jaccard_in_small_blocks_with_hot_grams(spark):
    rows = corpus(5)
    got = jaccard.jaccard_classes(frame(spark, rows), group_runs=50, hot=3, block_grams=40).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute.jaccard_components(rows)


def test_jaccard_at_the_bound(spark):
    # 6 of 8 shingles: 100 * 6 >= 75 * 8; then 5 of 7.
    text = " ".join(f"a{i}" for i in range(12))
    rows = [(1, text), (2, text.replace("a11", "b").replace("a0 ", "a0 ")), (3, "x " + text[3:] + " y")]
    got = jaccard.jaccard_classes(frame(spark, rows)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute.jaccard_components(rows)


def test_jaccard_ids(spark):
    text = "a b c d e f g"
    got = jaccard.jaccard_classes(frame(spark, [(None, text), (4, text), (4, text), (None, "z"), (9, "z z")])).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in got) == [(0, 0), (0, 4), (4, 4), (4, 4), (9, 9)]
    assert jaccard.jaccard_classes(frame(spark, [])).count() == 0
    kept = jaccard.keep_one_of_each(frame(spark, [(7, text), (4, text), (4, text), (5, "z"), (None, text)]))
    assert sorted((r["doc_id"] or 0, r["marks"]) for r in kept.collect()) == [(0, 2), (4, 2), (5, 2)]


def test_block_links_is_a_forest_of_all_links():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 30, 20)) for _ in range(40)]
    sizes, offsets = np.array([len(s) for s in sets]), np.cumsum([0, *map(len, sets)])
    got, want = brute.Groups(), brute.Groups()
    for i, j in jaccard.block_links(sizes, np.concatenate(sets).astype(np.uint64), offsets, (50, 100)):
        got.join(i, j)
    for i in range(40):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 50 * (sizes[i] + sizes[j] - both):
                want.join(i, j)
    assert [got.root(i) for i in range(40)] == [want.root(i) for i in range(40)]


@pytest.mark.parametrize("settings", [{}, {"group_runs": 50}, {"group_runs": 500}])
def test_substrings(spark, settings):
    rows = corpus(7)
    got = substrings.cut_repeats(frame(spark, rows), **settings).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got} == brute.cut(rows)


def test_substrings_edges(spark):
    passage = " ".join(f"p{i}" for i in range(20))
    long = " ".join(f"q{i}" for i in range(60_000))
    rows = [(1, passage), (2, f"x {passage}\ny"), (None, passage), (3, passage), (3, f"z {passage}"), (4, long), (5, long + " end")]
    got = substrings.cut_repeats(frame(spark, rows))
    found = sorted((r["doc_id"] or 0, r["n_removed"], r["spans"]) for r in got.collect())
    assert found == [
        (0, 0, []), (1, 0, []), (2, 20, [[1, 21]]), (3, 20, [[0, 20]]), (3, 20, [[1, 21]]), (4, 0, []),
        (5, 60_000, [[0, 60_000]]),
    ]
    assert substrings.cut_repeats(frame(spark, [])).count() == 0
    left = substrings.without_repeats(frame(spark, rows[:3]))
    assert left.columns == ["doc_id", "text", "n_words", "class", "marks"]
    assert [tuple(r) for r in left.orderBy("doc_id").collect()] == [
        (None, passage, 1, "x", 2), (1, passage, 1, "x", 2), (2, "x y", 1, "x", 2)
    ]


def test_a_chunk_sends_each_first_range_once():
    texts = [b"a " * 5_000, b"b c " * 300 + b"a " * 20, b"short", b"a " * 13]
    batch = pa.RecordBatch.from_arrays([pa.array([7, 8, 9, 7]), pa.array(texts, pa.binary())], ["doc_id", "text"])
    none = np.zeros((2, 1 << 17), np.uint8)
    sent = [out.to_pylist() for out in substrings._first_ranges(13, 1, none)([batch])]
    assert len(sent) == 1 and [r["grp"] for r in sent[0]] == [0, 1]
    owners, prints = runs_of_group({c: [sent[0][0][c]] for c in ("owners", "counts", "prints")}, 4, True)
    # Of the second text: two turns of b and c, nine ranges of ten words over the seam; a alone is the first's.
    assert owners.tolist() == [7] + [8] * 11
    assert len(set(prints.tolist())) == 12
    owners, prints = runs_of_group({c: [sent[0][1][c]] for c in ("owners", "counts", "prints")}, 4, True)
    assert owners.tolist() == [7, 8] and len(set(prints.tolist())) == 1


@pytest.mark.parametrize("k, size", [(1, 10), (4, 10), (4, 37), (13, 100), (13, 1), (13, 10_000)])
def test_slices_hold_every_window_once(k, size):
    rng = random.Random(k * size)
    text = b"".join(rng.choice([b"a", b"bb", b"long-word-" * 5]) + rng.choice([b" ", b"\n ", b"\t"]) for _ in range(200))
    found = []
    for piece in substrings.slices(text, k, size):
        words = piece.split()
        found += [words[i : i + k] for i in range(len(words) - k + 1)]
    words = text.split()
    assert found == [words[i : i + k] for i in range(len(words) - k + 1)]


def test_deep_nodes_against_brute_force():
    rng = np.random.default_rng(2)
    rows = rng.integers(0, 3, (5, 300)).astype(np.uint64)
    order, depth = substrings.suffix_order(rows)
    starts, ends = substrings.deep_nodes(depth, 5)
    got = sorted(tuple(sorted(order[s:e].tolist())) for s, e in zip(starts, ends))
    same = {}
    for i, column in enumerate(map(tuple, rows.T.tolist())):
        same.setdefault(column, []).append(i)
    assert got == sorted(tuple(v) for v in same.values() if len(v) > 1)
    assert [len(x) for x in substrings.deep_nodes(np.zeros(0, np.int8), 5)] == [0, 0]


def test_one_prefix_in_every_document(spark, monkeypatch):
    """A prefix that all documents share is made longer, so no group gets all of it."""
    rng = random.Random(8)
    opening = " ".join(f"common{i}" for i in range(6))
    rows = [(i, " ".join([opening, *words(rng, 30)] * 3)) for i in range(400)]
    rows += [(i, rows[i - 400][1] + " end") for i in range(400, 420)]
    got = substrings.cut_repeats(frame(spark, rows), group_runs=400).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got} == brute.cut(rows)
    laid = substrings.Words([t.encode() for _, t in rows])
    at, _ = substrings.suffixes(laid, 13)
    frequent = substrings.frequent_prefixes(frame(spark, rows), 13, 64, 400)
    sizes = [np.bincount(substrings.groups_of(laid, at, 13, 64, f)).max() for f in (np.zeros_like(frequent), frequent)]
    assert sizes[1] < sizes[0] / 2


def test_long_texts_are_cut_in_slices(spark):
    rng = random.Random(4)
    text = " ".join(f"w{rng.randrange(10**6)}" for _ in range(700_000))
    middle = " ".join(text.split()[300_000:660_000])
    rows = [(1, text), (2, "x " + middle + " y " + "z" * 5_000_000), (3, "z" * 5_000_000 + " q")]
    got = substrings.cut_repeats(frame(spark, rows)).select("doc_id", "n_words", "n_removed", "spans").orderBy("doc_id")
    assert [tuple(r) for r in got.collect()] == [
        (1, 700_000, 0, []), (2, 360_003, 360_000, [[1, 360_001]]), (3, 2, 0, [])
    ]


def vectors(n=150, dim=16):
    rng = np.random.default_rng(4)
    out = []
    for i in range(n):
        if i % 3 and out:
            v = np.array(out[rng.integers(0, len(out))][1]) * rng.uniform(0.5, 2) + rng.normal(0, 0.06, dim)
        else:
            v = rng.normal(0, 1, dim)
        out.append((i, v.tolist(), int(i % 2)))
    return out


def test_embeddings(spark):
    rows = vectors()
    n = len(rows)
    rows += [(n + k, rows[0][1], rows[0][2]) for k in range(6)]  # copies
    nan, inf = float("nan"), float("inf")
    rows += [(500, None, 0), (501, [0.0] * 16, 0), (502, [nan] + [1.0] * 15, 0), (503, [inf] + [1.0] * 15, 0),
             (504, [], 0), (505, rows[0][1], None), (506, [1.0, 2.0], 0), (507, [2.0, 4.0], 0), (508, [None] + [1.0] * 15, 0)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, label int, copies int")
    want = brute.links(rows)
    for settings in ({}, {"block": 7}):
        got = {r["vec_id"]: r for r in neardup.near_duplicates(df, **settings).collect()}
        assert set(got) == set(want)
        total = sum(w[0] for w in want.values())
        assert 0.99 * total <= sum(r["n_links"] for r in got.values()) <= total
        assert sum(got[i]["component_id"] == c for i, (_, c) in want.items()) >= 0.99 * len(want)
        assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())
        assert all(got[i]["n_links"] == 0 for i in (500, 501, 502, 503, 504, 505, 508))
        assert got[507]["component_id"] == 506


def test_embeddings_without_rows_or_ids(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert neardup.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    got = neardup.near_duplicates(spark.createDataFrame([(None, [1.0, 1.0], 1), (3, [1.0, 1.0], 1), (3, [1.0, 1.0], 1)], schema))
    assert sorted((r["vec_id"] or 0, r["n_links"]) for r in got.collect()) == [(0, 0), (3, 1), (3, 1)]


def test_rows_of_one_text_are_many_tasks_work(spark):
    """80 % equal texts: no task has more than twice the mean of the answer's rows."""
    conf = {
        "spark.sql.shuffle.partitions": "16", "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.adaptive.skewJoin.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in conf}
    docs = spark.range(60_000).selectExpr("id AS doc_id", "if(id % 10 < 8, 'a b c d e f', concat('w', id % 900, ' x y z u v')) AS text")
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = jaccard.jaccard_classes(docs.repartition(8)).select("component_id", F.spark_partition_id().alias("p"))
        sizes = [r["n"] for r in out.groupBy("p").agg(F.count("*").alias("n"), F.max("component_id")).collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 60_000 and len(sizes) >= 8 and max(sizes) <= 2 * sum(sizes) / len(sizes), sizes
