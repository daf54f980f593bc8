"""Spelling variants against brute force."""

import collections
import random
import re
import zlib

import pytest

from paperward.llm import spelling, spelling_queries


def near(a, b):
    """Exactly one code point inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def brute(counts, times=10):
    out = {}
    for w, n in counts.items():
        others = [(-m, x) for x, m in counts.items() if near(w, x)]
        low, form = min(others, default=(0, None))
        good = bool(others) and -low >= times * n
        out[w] = [form if good else None, None, n, len(others), -low if good else None]
    for w, row in out.items():
        end = w
        while out[end][0] is not None:
            end = out[end][0]
        row[1] = end
    return {w: tuple(row) for w, row in out.items()}


def edited(rng, word, letters="abcdeéßz"):
    i = rng.randrange(len(word) + 1)
    return rng.choice([word[:i] + rng.choice(letters) + word[i:], word[:i] + word[i + 1 :], word[:i] + rng.choice(letters) + word[i + 1 :]])


def vocabulary(seed):
    rng = random.Random(seed)
    counts = {}
    for _ in range(14):
        word = "".join(rng.choice("abcdeéßzÀ") for _ in range(rng.choice([0, 1, 2, 7, 9, 12, 29, 30, 31, 32, 33, 64, 90])))
        counts[word] = rng.choice([1, 10, 100, 1000, 10**6])
        for _ in range(12):
            new = edited(rng, rng.choice([word, edited(rng, word)]))
            counts[new] = rng.choice([1, 2, 9, 10, 11, 100])
    return counts


def rows_of(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


@pytest.mark.parametrize("seed", range(4))
def test_variants(spark, seed):
    counts = vocabulary(seed)
    rows = [(w, n, "x", 1) for w, n in counts.items()]
    df = spark.createDataFrame(rows, "word string, n long, root string, code int").repartition(6)
    found = spelling.variants(df)
    assert rows_of(found) == brute(counts) and found.count() == len(counts)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_all_short_words(spark):
    """Each pair of short words over letters that share symbols and that don't."""
    words = [a + b + c for a in ["", *"abée"] for b in ["", *"abée"] for c in ["", *"ab"]]
    counts = {w: i + 1 for i, w in enumerate(dict.fromkeys(words))}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert rows_of(spelling.variants(df, times=2)) == brute(counts, times=2)


def test_chains_are_followed(spark):
    word = "abcdefghij"
    counts = {word[: len(word) - i] + "x" * i: 10 ** (9 - i) for i in range(9)}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = rows_of(spelling.variants(df))
    assert found == brute(counts) and {r[1] for r in found.values()} == {word}


def test_nulls_repeats_and_nothing(spark):
    df = spark.createDataFrame([(None, 5), ("abcdefg", None), ("abcdefg", 3), ("abcdefg", 4), ("abcdefgh", 100)], "word string, n long")
    assert rows_of(spelling.variants(df)) == brute({"abcdefg": 7, "abcdefgh": 100})
    assert spelling.variants(df.limit(0)).collect() == []


def contract(rows):
    counts = collections.Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return brute({w: n for w, n in counts.items() if len(w) >= 7 and n >= 2})


def test_query(spark, tmp_path):
    rng = random.Random(4)
    base = ["".join(rng.choice("abcdeÉé") for _ in range(rng.randrange(5, 12))) for _ in range(25)]
    texts = ["\n".join(rng.choice([w, w, w.upper(), edited(rng, w)]) + rng.choice(" -7_") for w in rng.choices(base, k=200)) for _ in range(40)]
    texts += [None, "", " ", "ÀÖ×÷ßÿabc " * 4, "x" * 50_000 + " " + "x" * 49_999 + " " + ("x" * 50_000), "aĀbcdefgh abcdefgh"]
    rows = list(enumerate(texts)) + [(1, texts[1]), (None, texts[2])]
    spark.createDataFrame([(i, t, 1, "a") for i, t in rows], "doc_id long, text string, n int, word string").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    got = spelling_queries.QUERIES["op11_spelling_variants"](spark, str(tmp_path))
    want = contract(rows)
    assert rows_of(got) == want and len(want) > 100
