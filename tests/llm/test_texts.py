"""Sharding, rules, licenses, packing, tokens, pieces and the classifier."""

import collections
import random
import zlib

import brute
import numpy as np
import public_tokenizers
import pytest

from pyspark.sql import functions as F

from paperward.llm import crf, licenses, packing, quality, sentencepieces, sharding, token_counts
from paperward.llm.pretokens import Encoder

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

ODD = [
    "", " ", "  a", "a   b    c\n  e\n\n f ", "\n", "don't I'll we've 'S 'T ''s x''ve! it's' 'reality 'm5 'd",
    "a<|endoftext|>b<|startoftext|> c", "Σίσυφος ΟΔΟΣ İstanbul ﬁ ½ ²³ x²", "naïve œuvre “quotes” … ÷×ß ẞ Å Å é",
    "a\x00b\x1cc\x7fd \x85e\xa0f", "日本語 テスト 한국어 😀😀", "aaaaaaaaaaaaaaaaaaa aaa aaaa", "1234567 12a34", "!!!???'''s",
    "ÀÉÎÕÜ Þþ Ÿÿ", "'", "''", "' s", "x" * 20000, "é" * 501 + "1", "▁x ▁", "<s> </s> <unk> <0x0A>", "\ttab\r\n", " " * 40 + "b",
]


def documents(spark, folder="/root/testdata/sf0.001"):
    return spark.read.parquet(f"{folder}/documents.parquet")


def frame(spark, texts, ids=None):
    rows = [(i, t, 1, 2) for i, t in zip(ids or range(len(texts)), texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, length long, _row int")


# Sharding


def test_differencing_is_tighter_than_greedy():
    rng = random.Random(1)
    sizes = sorted((rng.randrange(1, 10_000) for _ in range(500)), reverse=True)
    shard = sharding.difference(np.array(sizes), 8)
    got = [sum(s for s, k in zip(sizes, shard) if k == j) for j in range(8)]
    greedy = [0] * 8
    for s in sizes:
        greedy[greedy.index(min(greedy))] += s
    assert sum(got) == sum(sizes)
    assert max(got) - min(got) <= max(greedy) - min(greedy)
    # 8-7, 6-5, 4-1, 3-1: the sums differ by 2.
    two = sharding.difference(np.array([8, 7, 6, 5, 4]), 2)
    assert abs(sum(s if k else -s for s, k in zip([8, 7, 6, 5, 4], two))) == 2
    assert len(sharding.difference(np.array([]), 3)) == 0 and list(sharding.difference(np.array([5]), 3)) == [0]


def test_shards(spark):
    texts = [f"text {i % 300}" * (i % 37) for i in range(2000)] + [None, "", "big " * 2000]
    rows = frame(spark, texts).selectExpr("doc_id", "coalesce(text, '') AS g", "octet_length(coalesce(text, '')) + 1L AS size", "_row")
    for lumps in (sharding.LUMPS, 40):
        got = sharding.shard_by_bytes(rows, "g", "size", ["doc_id"], lumps=lumps).collect()
        assert len(got) == len(texts)
        where = collections.defaultdict(set)
        for r in got:
            where[r["g"]].add(r["shard"])
        assert all(len(s) == 1 for s in where.values())
        for j in range(8):
            slots = sorted(r["slot"] for r in got if r["shard"] == j)
            assert slots == list(range(len(slots)))
    bytes_ = collections.Counter()
    for r in got:
        bytes_[r["shard"]] += r["size"]
    assert max(bytes_.values()) - min(bytes_.values()) < 0.2 * sum(bytes_.values()) / 8
    assert sharding.shard_by_bytes(rows.limit(0), "g", "size", ["doc_id"]).count() == 0


# Quality rules


def plain_search(rows, p):
    """(determinant's logarithm, centre, covariance) that each start ends at, by numpy."""
    x = np.array(rows, float) / quality.GRID
    floor = np.diag([t * t for t in quality.TOLERANCE.values()])

    def point(v, share):
        return np.sort(v)[int(np.ceil(share * len(v) - 1e-9)) - 1]

    def moments(near, scale):
        return near.mean(axis=0), np.cov(near.T, bias=True) * scale + floor

    m = np.array([point(c, 0.5) for c in x.T])
    sd = np.array([(point(c, 0.75) - point(c, 0.25)) / 1.349 for c in x.T])
    starts = [(m, np.diag(sd**2) + floor), moments(x, 1.0)]
    inside = quality.chi_square_point(quality.SUPPORT, p)
    scale = quality.SUPPORT / quality.chi_square(inside, p + 2)
    for m, cov in starts:
        best = None
        for _ in range(quality.STEPS):
            d = np.einsum("ni,ij,nj->n", x - m, np.linalg.inv(cov), x - m)
            far = np.floor(np.log2(d + 1) * 64)
            m, cov = moments(x[far <= point(far, quality.SUPPORT)], scale)
            det = np.linalg.slogdet(cov)[1]
            if best is not None and det >= best[0] - quality.STILL:
                break
            best = det, m, cov
        yield best


def plain_distances(rows, p):
    """By the best model of one group."""
    x = np.array(rows, float) / quality.GRID
    _, m, cov = min(plain_search(rows, p), key=lambda t: t[0])
    return np.einsum("ni,ij,nj->n", x - m, np.linalg.inv(cov), x - m)


def test_quality_search_takes_the_smallest_determinant(spark):
    """Two clouds: the starts end at different models, and the best of all is taken."""
    rng = np.random.default_rng(8)
    p = len(quality.STATISTICS)
    groups = {}
    for g in range(3):
        wide = rng.normal(0, 3, (60 + 10 * g, p))
        tight = rng.normal(5, 0.3, (90, p)) * np.where(np.arange(p) == g, 4, 1)
        groups[f"g{g}"] = np.round(np.concatenate([wide, tight]) * quality.GRID).astype(int).tolist()
    rows = spark.createDataFrame([(g, x) for g, xs in groups.items() for x in xs], "est string, x array<bigint>")
    found = quality.search(rows).toPandas()
    assert sorted(zip(found["est"], found["start"])) == [(g, s) for g in sorted(groups) for s in range(quality.STARTS)]
    for g, xs in groups.items():
        want = [w[0] for w in plain_search(xs, p)]
        got = found[found["est"] == g].sort_values("start")["logdet"].tolist()
        assert np.allclose(got, want, atol=1e-5)
        assert max(want) - min(want) >= 0


def test_rows_of_one_group_are_many_tasks_work(spark):
    """80 % of the rows in one language and source: no task of a step has more than twice the mean."""
    conf = {
        "spark.sql.shuffle.partitions": "16", "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.adaptive.skewJoin.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in conf}
    rows = spark.range(200_000).selectExpr(
        "if(id % 10 < 8, 'hot', concat('g', id % 40)) AS est",
        f"transform(sequence(1, {len(quality.STATISTICS)}), i -> pmod(xxhash64(id, i), 5000)) AS x",
    )
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        model = quality._quartiles(rows, len(quality.STATISTICS))
        met = quality.attach(rows, model, ["est"], "size", ["x"])
        sizes = [r["n"] for r in met.where("m IS NOT NULL").groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 200_000 and len(sizes) >= 8 and max(sizes) <= 2 * sum(sizes) / len(sizes), sizes


def test_quality_counts_and_distances(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    got = quality.quality_rules(docs).toPandas()
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in got.itertuples():
        assert tuple(getattr(r, c) for c in quality.COUNTS) == brute.counts(text[r.doc_id])
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
    # Every group has 50 rows at most: the languages' groups are used.
    p = len(quality.STATISTICS)
    size = got.groupby(["lang", "source"])["doc_id"].transform("size")
    english = got[(got["lang"] == "en") & (size < quality.LEAST)]
    want = plain_distances(english["x"].tolist(), p)
    assert np.allclose(english["distance"], want, rtol=1e-6)
    limit = quality.chi_square_point(quality.CUT, p)
    assert (english["kept"] == (~english["base_failed"] & (want <= limit))).all()


def test_quality_keeps_clean_and_drops_junk(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet").toPandas().set_index("doc_id")["quality"]
    got = quality.quality_rules(documents(spark, folder)).toPandas().set_index("doc_id")
    got["quality"] = labels
    fair = got[~got["base_failed"]]
    assert fair[fair["quality"] == 1]["kept"].mean() >= 0.995
    assert fair[fair["quality"] == 0]["kept"].mean() <= 0.3


def test_quality_edges(spark):
    run = "a b c d e f g h "
    texts = [None, "", "x", run * 4, "z " * 20 + run + "y " + run, " \n \n", "l\nl\n\nl \nm", "w" * 100_000, "<a> | $5"]
    rows = [(i % 3 or None, t, None if i % 2 else "en", None, "q", 0) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, x string, n_words int")
    got = quality.quality_rules(df).collect()
    assert sorted(tuple(r[c] for c in quality.COUNTS) for r in got) == sorted(brute.counts(t) for t in texts)
    assert quality.quality_rules(df.limit(0)).count() == 0
    assert quality.keep_good(df).columns == df.columns


def test_chi_square():
    assert quality.chi_square_point(0.95, 2) == pytest.approx(5.991, abs=1e-3)
    assert quality.chi_square_point(0.999, 7) == pytest.approx(24.322, abs=1e-3)


# Licenses


def test_licenses(spark):
    mit = "Released under the MIT License."
    texts = [
        None, "", "plain words", "All rights\nreserved. CC-BY cc by", "CC BY cc by, all rights reserved", f"a\n{mit}\nb",
        "license the, under MIT x released", "mit license", "ACC BY x", "General Public License " * 2, "İ all RIGHTS reserved é",
    ]
    got = [tuple(r) for r in licenses.scan_licenses(frame(spark, texts)).drop("blocks").orderBy("doc_id").collect()]
    assert got[:5] == [
        (0, 0, 0, None, None, "", "", 0.0), (1, 0, 0, None, None, "", "", 0.0), (2, 2, 0, None, None, "", "", 0.0),
        (3, 7, 3, 0, 5, "cc-by,reserved", "cc-by,reserved", 1.0), (4, 7, 3, 0, 4, "cc-by,reserved", "cc-by,reserved", 1.0),
    ]
    assert got[5][1:] == (7, 0, None, None, "", "mit", 1.0)
    assert got[6][6:] == ("mit", 1.0) and got[7][6:] == ("", 0.0) and got[8][2] == 0
    assert got[9][1:6] == (6, 2, 0, 3, "gpl") and got[10][3] == 1
    assert licenses.scan_licenses(frame(spark, [])).count() == 0


def test_license_join_is_exact(spark):
    rng = random.Random(5)
    vocabulary = [f"v{i}" for i in range(14)]
    templates = [(f"t{k}", " ".join(rng.sample(vocabulary, rng.randrange(2, 9)))) for k in range(12)]
    texts = ["\n".join(" ".join(rng.choices(vocabulary, k=rng.randrange(1, 9))) for _ in range(4)) for _ in range(80)]
    for share in ((1, 2), (8, 10)):
        got = licenses.scan_licenses(frame(spark, texts), {"no such": "n"}, templates, share).collect()
        for r in got:
            want = set()
            for b, line in enumerate(texts[r["doc_id"]].split("\n")):
                for label, t in templates:
                    t = set(t.split())
                    n = len(t & set(line.split()))
                    if n * share[1] >= len(t) * share[0]:
                        want.add((label, b, n / len(t)))
            assert {tuple(x) for x in r["blocks"] or []} == want


def test_wrapped_licenses(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and its files"
    bsd = (
        "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that"
    )
    notices = [mit, bsd, "# " + mit.replace("\n", "\n# "), mit.replace(" ", "\n"), f"Some words of the file. {bsd}"]
    texts = [f"x y\n{n}\nz" for n in notices] + [mit.replace("copy\n", "copy\n\n"), bsd.replace("\n", "\nx\n*\n")]
    got = licenses.scan_licenses(frame(spark, texts)).orderBy("doc_id").collect()
    found = [(r["labels"], r["score"]) for r in got]
    assert found == [("mit", 1.0), ("bsd", 1.0), ("mit", 1.0), ("mit", 1.0), ("bsd", 1.0), ("", 0.0), ("", 0.0)]


def test_license_runs_are_exact(spark):
    rng = random.Random(6)
    vocabulary = [f"v{i}" for i in range(14)]
    templates = [(f"t{k}", " ".join(rng.sample(vocabulary, rng.randrange(2, 7)))) for k in range(12)]
    longest = max(len(t.split()) for _, t in templates)
    texts = ["\n".join(" ".join(rng.choices(vocabulary, k=rng.randrange(5))) for _ in range(9)) for _ in range(80)]
    for r in licenses.scan_licenses(frame(spark, texts), {"no such": "n"}, templates, (8, 10), runs=True).collect():
        lines = [set(x.split()) for x in texts[r["doc_id"]].split("\n")]
        want = set()
        for b in range(len(lines)):
            held, between = set(lines[b]), 0
            for x in lines[b + 1 :] if lines[b] else []:
                if not x or between >= longest:
                    break
                held |= x
                between += len(x)
            for label, t in templates:
                t = set(t.split())
                if len(t & held) * 10 >= len(t) * 8:
                    want.add((label, b, len(t & held) / len(t)))
        assert {tuple(x) for x in r["runs"] or []} == want
        assert r["score"] == max((x[2] for x in want), default=0.0)


# Tokens


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORD_BPE)


def test_token_counts(spark):
    texts = [*ODD, None, *(r["text"] for r in documents(spark).collect())]
    want = [len(e.ids) for e in library().encode_batch([t or "" for t in texts], add_special_tokens=False)]
    got = token_counts.count_tokens(frame(spark, texts), WORD_BPE).orderBy("doc_id").collect()
    assert [r["n_tokens"] for r in got] == want
    assert [r["n_bytes"] for r in got] == [len((t or "").encode()) for t in texts]
    assert [r["over_limit"] for r in got] == [n > 2048 for n in want]
    repeated = token_counts.count_tokens(frame(spark, ["a b", "a b", None], [1, 1, None]), WORD_BPE).collect()
    assert sorted((r["doc_id"] or 0, r["n_tokens"]) for r in repeated) == [(0, 0), (1, 2), (1, 2)]
    assert token_counts.count_tokens(frame(spark, []), WORD_BPE).count() == 0


def test_encoder_starts_anew_when_full():
    encoder = Encoder(WORD_BPE)
    encoder.kept.limit = 3
    want = [e.ids for e in library().encode_batch(ODD, add_special_tokens=False)]
    for _ in range(2):
        assert [x.tolist() for part in ODD for x in encoder.ids([part.encode()])] == want


def test_first_fit():
    rng = random.Random(3)
    lengths = sorted((rng.randrange(1, 101) for _ in range(300)), reverse=True)
    room, want = [], []
    for length in lengths:
        k = next((i for i, r in enumerate(room) if r >= length), len(room))
        if k == len(room):
            room.append(100)
        room[k] -= length
        want.append(k)
    assert packing.first_fit(lengths, 100) == want
    assert packing.first_fit([], 5) == []


def test_packing(spark):
    texts = [*ODD, None, "", *(r["text"] for r in documents(spark).collect())]
    ids = [e.ids + [1] for e in library().encode_batch([t or "" for t in texts], add_special_tokens=False)]
    for group in (packing.GROUP, 40):
        got = packing.pack_documents(frame(spark, texts), WORD_BPE, group=group).toPandas()
        for i, one in got.groupby("doc_id"):
            at = 0
            for r in one.sort_values("start").itertuples():
                part = np.array(ids[i][at : at + r.length], "<u4").tobytes()
                assert (r.start, r.ids_crc32, r.doc_tokens) == (at, zlib.crc32(part), len(ids[i]))
                at += r.length
            assert at == len(ids[i])
        for _, one in got.groupby("sequence_id"):
            one = one.sort_values("offset")
            assert one["offset"].tolist() == [0, *np.cumsum(one["length"])[:-1]]
            assert one["length"].sum() <= 2048
        assert got["doc_id"].nunique() == len(texts)
    full = packing.pack_documents(documents(spark, "/root/testdata/sf0.01"), WORD_BPE).toPandas()
    assert full["length"].sum() >= 0.98 * 2048 * full["sequence_id"].nunique()
    assert packing.pack_documents(frame(spark, []), WORD_BPE).count() == 0


def test_packing_carries_columns_and_repeated_rows(spark):
    rows = spark.createDataFrame([(1, 5, [1, 2])] * 3 + [(None, 9, None)], "bin int, length int, ids array<int>")
    got = packing.pack(rows, 10)
    assert got.columns == ["bin", "length", "ids", "sequence_id", "offset"] and got.count() == 4


# SentencePiece


def test_sentencepieces(spark):
    import sentencepiece

    other = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = [*ODD, None, *(r["text"] for r in documents(spark).collect())]
    want = other.encode([t or "" for t in texts])
    got = sentencepieces.encode_documents(frame(spark, texts), PIECES).orderBy("doc_id").collect()
    for r, ids, t in zip(got, want, texts):
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        assert r["n_byte_tokens"] == sum(other.is_byte(i) for i in ids)
        assert r["round_trip"] == ("▁" not in (t or ""))
    assert sum(r["n_unlike"] for r in got) == 0
    assert sentencepieces.encode_documents(frame(spark, []), PIECES).count() == 0


def unigram_model():
    """A small unigram model file, written field by field."""
    def number(n, v):
        return bytes([n << 3 & 127 | (128 if n > 15 else 0), *([n >> 4] if n > 15 else []), v])

    def block(n, data):
        return bytes([n << 3 | 2, len(data)]) + data

    def piece(text, score, kind):
        return block(1, block(1, text.encode()) + bytes([2 << 3 | 5]) + np.float32(score).tobytes() + number(3, kind))

    pieces = [("<unk>", 0, 2)] + [(f"<0x{b:02X}>", 0, 6) for b in range(256)]
    pieces += [("▁", -3, 1), ("a", -3, 1), ("b", -3.5, 1), ("ab", -4, 1), ("▁a", -4.5, 1), ("▁ab", -5, 1), ("ba", -6, 1)]
    trainer = number(3, 1) + number(35, 1) + number(40, 0)
    normal = number(3, 1) + number(4, 0) + number(5, 1)
    return b"".join(piece(*p) for p in pieces) + block(2, trainer) + block(3, normal)


def test_unigram_model(spark, tmp_path):
    import sentencepiece

    path = tmp_path / "small.model"
    path.write_bytes(unigram_model())
    model = sentencepieces.Model(unigram_model())
    assert model.kind == sentencepieces.UNIGRAM and model.byte_fallback and not model.cut_spaces
    other = sentencepiece.SentencePieceProcessor(model_proto=unigram_model())
    texts = ["ab ba abab", "a  b\n é", "", None, "bbb aab"]
    got = sentencepieces.encode_documents(frame(spark, texts), str(path)).orderBy("doc_id").collect()
    assert [r["ids"] for r in got] == other.encode([t or "" for t in texts])
    assert all(r["round_trip"] for r in got)


# Classifier


def test_marginals_by_enumeration():
    rng = np.random.default_rng(1)
    offsets, good, pairs = np.array([0, 3, 3, 4, 9]), rng.normal(size=9), rng.normal(size=(2, 2))
    p, both, log_z = crf.marginals(good, pairs, offsets)
    want, want_both, want_z = np.zeros(9), np.zeros((2, 2)), 0.0
    for a, b in zip(offsets, offsets[1:]):
        total, one, two = 0.0, np.zeros(b - a), np.zeros((2, 2))
        for y in np.ndindex(*[2] * (b - a)):
            w = np.exp(sum(good[a + i] for i, v in enumerate(y) if v) + sum(pairs[u, v] for u, v in zip(y, y[1:])))
            total += w
            one += w * np.array(y)
            for u, v in zip(y, y[1:]):
                two[u, v] += w
        want[a:b], want_both, want_z = one / total, want_both + two / total, want_z + np.log(total)
    assert np.allclose(p, want) and np.allclose(both, want_both) and np.isclose(log_z, want_z)


def test_line_features_do_not_cross_texts():
    texts = [b"One two.\n\nTHREE!! THREE!!\nx | y", b"", b"\n \n", b"x | y\nx | y"]
    whole, sizes, offsets = crf.line_features(texts)
    assert offsets.tolist() == [0, 3, 3, 3, 5]
    for i, t in enumerate(texts):
        alone, size, _ = crf.line_features([t])
        assert np.allclose(alone, whole[offsets[i] : offsets[i + 1]])
        assert size.tolist() == sizes[offsets[i] : offsets[i + 1]].tolist()


def test_classifier_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = crf.score_documents(documents(spark, folder), labels).toPandas()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got.itertuples())
    joined = got.merge(labels.toPandas(), on="doc_id")
    joined = joined[joined["held_out"]]
    assert (joined["predicted"] == joined["quality"]).mean() >= 0.97
    assert got["score"].between(0, 1).all()


def test_classifier_edges(spark):
    texts = [None, "", " \n", "Clean words here.", "THE!! THE!!", "w " * 50_000]
    labels = spark.createDataFrame([(3, 1), (3, 1), (None, 0), (4, None)], "doc_id long, quality int")
    got = crf.score_documents(frame(spark, texts, [None, 1, 2, 3, 4, 4]), labels).collect()
    assert len(got) == 6 and all(0 <= r["score"] <= 1 for r in got)
    assert crf.score_documents(frame(spark, []), labels.limit(0)).count() == 0
    chain = crf.fit(frame(spark, texts), labels)
    kept = crf.keep_good(frame(spark, texts).withColumnRenamed("length", "score"), chain, 0.0)
    assert kept.columns == ["doc_id", "text", "score", "_row"] and kept.count() == 6
