"""Periodic runs against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from paperward.llm import periodic, periodic_queries


def brute(words, least=24, times=3):
    """All (start, length, period), from the equal places of every period."""
    n, found = len(words), []
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, times * q):
                found.append((i, j + q - i, q))
            i = j
    return sorted((s, n, q) for s, n, q in found if not any(o == (s, n) and p < q for *o, p in [(a, b, c) for a, b, c in found] for o in [tuple(o)]))


def sample(rng):
    """Texts of words with runs of many periods, nested and next to each other."""
    kind = rng.randrange(6)
    few = [f"w{i}" for i in range(rng.choice([1, 2, 3, 8, 300]))]
    pick = lambda n: [rng.choice(few) for _ in range(n)]
    if kind == 0:
        return pick(rng.randrange(160))
    out = []
    for _ in range(rng.randrange(1, 5)):
        unit = pick(rng.randrange(1, rng.choice([3, 9, 40])))
        if kind == 1:
            unit = unit * rng.randrange(1, 10) + pick(rng.randrange(3))
        out += unit * rng.randrange(1, 12) + unit[: rng.randrange(len(unit) + 1)] + pick(rng.randrange(6))
        if kind == 2:
            out += out
        if kind == 3:
            out[rng.randrange(len(out))] = "odd"
    if kind == 4:
        a, b = ["a"], ["b"]
        for _ in range(9):  # a word of many overlapping squares
            a, b = a + b, a
        out += a
    return out[:1500]


def runs_of(texts, **more):
    names = {w: i for i, w in enumerate(sorted({w for t in texts for w in t}))}
    ids = np.array([names[w] for t in texts for w in t], np.int64)
    bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    start, end, period = periodic.find_runs(ids, bounds, **more)
    at = np.searchsorted(bounds, start, "right") - 1
    out = [[] for _ in texts]
    for i, s, e, q in zip(at.tolist(), start.tolist(), end.tolist(), period.tolist()):
        out[i].append((s - int(bounds[i]), e - s, q))
    return out


@pytest.mark.parametrize("seed", range(12))
@pytest.mark.parametrize("block", [periodic.BLOCK, 37])
def test_find_runs(seed, block):
    rng = random.Random(seed)
    texts = [sample(rng) for _ in range(25)] + [[], ["one"], ["a"] * 23, ["a"] * 24, ["a", "b"] * 500]
    for text, got in zip(texts, runs_of(texts, block=block)):
        assert got == brute(text), text


def test_pieces_of_arrays_make_no_difference(monkeypatch):
    texts = [sample(random.Random(s)) for s in range(20)]
    monkeypatch.setattr(periodic, "PIECE", 64)
    assert runs_of(texts) == [brute(t) for t in texts]


def test_long_texts_of_one_word_and_of_no_repeats():
    n = 300_000
    assert runs_of([["a"] * n]) == [[(0, n, 1)]]
    assert runs_of([[str(i) for i in range(n)]]) == [[]]
    unit = ["x"] * 5 + ["y"]
    assert runs_of([unit * 20_000]) == [[(0, 120_000, 6)]]


def test_grammar_leaves_no_pair_twice():
    rng = np.random.default_rng(5)
    ids = rng.integers(0, 4, 3000)
    grammar = periodic.Grammar(ids.copy(), np.zeros(3000, np.int64), 0)
    left, bound, right = grammar.rules
    rule, at = grammar.places
    for r in range(len(left)):  # every place of a nonterminal spells the same words
        for p in at[rule == r]:
            assert (ids[p : p + right[r] - left[r]] == ids[left[r] : right[r]]).all()
    assert (np.bincount(rule) >= 2).all() and ((left < bound) & (bound < right)).all()
    spelt = {}
    ends = np.append(grammar.starts, 3000)
    symbols = [spelt.setdefault(tuple(ids[s:e]), len(spelt)) for s, e in zip(ends, ends[1:])]
    pairs = list(zip(symbols, symbols[1:]))
    apart = [p for i, p in enumerate(pairs) if i < 1 or pairs[i - 1] != p]
    assert len(set(apart)) == len(apart)


def expected(doc_id, text):
    """The query's row, said plainly."""
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and n and (h := zlib.crc32(str(doc_id).encode())) % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = (None,) * 4
    for s, n, q in runs:
        if best[0] is None or n * best[2] > best[1] * q:
            best = (s, n, q, 1000 * n // q)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *best, sha(b"".join(b"%d,%d,%d\n" % r for r in runs)),
            sha(b" ".join(w for i, w in enumerate(words) if i not in gone)))


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query(spark, tmp_path):
    rng = random.Random(9)
    texts = [" ".join(sample(rng)) for _ in range(150)]
    texts += [None, "", " \n\t ", "  one\x0btwo  ", "é ü " * 40, "\n".join(["same"] * 30), "a b c " * 30]
    rows = [(i, t, 1, "c", [1]) for i, t in enumerate(texts)] + [(7, texts[3], 1, "c", [1]), (None, "a " * 40, 1, "", [2])]
    spark.createDataFrame(rows, "doc_id long, text string, n_words int, collapsed string, runs array<int>").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    got = periodic_queries.QUERIES["op13_periodic_runs"](spark, str(tmp_path)).select(COLUMNS).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[-1])
    assert sorted(map(tuple, got), key=key) == sorted((expected(i, t) for i, t, *_ in rows), key=key)


def test_query_on_given_documents(spark):
    folder = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = periodic_queries.QUERIES["op13_periodic_runs"](spark, folder).select(COLUMNS).collect()
    some = [r for r in got if len((docs[r[0]] or "").split()) < 1500]
    assert len(got) == len(docs) and len(some) > 100
    assert [tuple(r) for r in some] == [expected(r[0], docs[r[0]]) for r in some]


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert periodic.periodic_runs(empty).collect() == []
