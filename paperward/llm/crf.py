"""Document quality from a linear-chain conditional random field over lines.

Every line with a word is good or bad.  What speaks for good is linear in the line's own
features and in those of the lines before and after it; two neighbouring lines have a
weight for each pair of labels.  The chain is trained on labelled documents, whose lines
all carry the document's label.  A document's quality is the mean of its lines' forward-
backward marginals for good, weighted by their bytes.

Training takes at most ``SAMPLE`` labelled documents, the first by hash of the id, none
longer than ``LONGEST`` bytes: a bound on what reaches the driver.  Scoring reads whole
texts.  Features are counted on bytes, all lines of a batch at once; chains of a batch are
walked side by side.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperward.llm.arrays import U64, Words, chunks, hash_spans, mix
from paperward.llm.shared import give_back, lean, tune, utf8

SAMPLE = 4000
LONGEST = 200_000
CUT = 0.7

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&<>"]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_MARK = np.zeros(256, bool)
_MARK[33:48] = _MARK[58:65] = _MARK[91:97] = _MARK[123:127] = True
_MARK &= ~_SYMBOL
_MARK[[ord("!"), ord("|")]] = False

OWN = (
    "size", "words", "word_size", "capitals", "symbols", "bangs", "bars", "digits", "marks",
    "repeated_words", "repeated_line",
)
N_FEATURES = 3 + 3 * len(OWN)  # bias, first line, last line; own, before, after


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines that have a word, their bytes, and offsets of the texts' lines."""
    words = Words(texts)
    buf = words.buf
    ends = np.flatnonzero(buf == 10)
    starts = np.concatenate(([0], ends[:-1] + 1)) if len(ends) else ends
    # The newline after each text ends its last line, so no line is in two texts.
    text_ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    n_words = np.bincount(np.searchsorted(ends, words.starts), minlength=len(ends))
    keep = np.flatnonzero(n_words)
    starts, ends, n_words = starts[keep], ends[keep], n_words[keep].astype(float)
    owner = np.searchsorted(text_ends, ends)
    offsets = np.searchsorted(owner, np.arange(len(texts) + 1))

    def share(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
        return (total[ends] - total[starts]) / np.maximum(1.0, chars)

    sizes = (ends - starts).astype(float)
    word_sizes = np.concatenate(([0], np.cumsum(words.ends - words.starts)))
    first = np.searchsorted(words.starts, starts)
    last = np.searchsorted(words.starts, ends)
    chars = (word_sizes[last] - word_sizes[first]).astype(float)
    line_of = np.repeat(np.arange(len(keep)), last - first)
    inside = mix(words.hashes ^ mix(line_of.astype(U64)))
    _, at = np.unique(inside, return_index=True)
    distinct = np.bincount(line_of[at], minlength=len(keep))
    whole = mix(hash_spans(buf, starts, ends) ^ mix(owner.astype(U64)))
    fresh = np.zeros(len(keep), bool)
    fresh[np.unique(whole, return_index=True)[1]] = True
    own = np.stack([
        np.log1p(sizes) / 10, np.log1p(n_words) / 5, chars / np.maximum(1, n_words) / 10,
        share(_UPPER[buf]), np.sqrt(share(_SYMBOL[buf])), np.sqrt(share(buf == 33)), np.sqrt(share(buf == 124)),
        share(_DIGIT[buf]), share(_MARK[buf]),
        1 - distinct / np.maximum(1, n_words), (~fresh).astype(float),
    ], axis=1)
    opens, closes = np.zeros(len(keep)), np.zeros(len(keep))
    some = offsets[:-1] < offsets[1:]
    opens[offsets[:-1][some]] = 1
    closes[offsets[1:][some] - 1] = 1
    before = np.concatenate([np.zeros((1, len(OWN))), own[:-1]])[: len(own)] * (1 - opens)[:, None]
    after = np.concatenate([own[1:], np.zeros((1, len(OWN)))])[: len(own)] * (1 - closes)[:, None]
    ones = np.ones(len(keep))
    return np.concatenate([np.stack([ones, opens, closes], axis=1), own, before, after], axis=1), sizes, offsets


@dataclass
class Chain:
    """Weights for good against bad, and of a pair of neighbours (bad, good) x (bad, good)."""

    weights: np.ndarray
    pairs: np.ndarray


def marginals(good: np.ndarray, pairs: np.ndarray, offsets: np.ndarray):
    """P(good) of each line, sums of P(pair) per chain, and log Z of each chain.

    ``good`` is the lines' score for good; that for bad is 0.  Chains are walked side by
    side, the longest first, so a step takes the chains that still have a line.
    """
    n = np.diff(offsets)
    order = np.argsort(-n, kind="stable")
    begin, n = offsets[:-1][order], n[order]
    steps = int(n[0]) if len(n) else 0
    live = np.searchsorted(-n, -np.arange(steps), "left")  # chains longer than t
    top = np.maximum(good, 0)
    emit = np.stack([np.exp(-top), np.exp(good - top)], axis=1)
    move = np.exp(pairs)
    ahead, scale = np.empty((len(good), 2)), np.ones(len(good))
    for t in range(steps):
        at = begin[: live[t]] + t
        a = emit[at] if t == 0 else (ahead[at - 1] @ move) * emit[at]
        scale[at] = a.sum(axis=1)
        ahead[at] = a / scale[at][:, None]
    back = np.ones((len(good), 2))
    for t in range(steps - 2, -1, -1):
        at = begin[: live[t + 1]] + t
        back[at] = (emit[at + 1] * back[at + 1] / scale[at + 1][:, None]) @ move.T
    p = ahead * back
    inner = np.ones(len(good), bool)
    inner[offsets[1:][np.diff(offsets) > 0] - 1] = False
    at = np.flatnonzero(inner)
    both = np.einsum("li,ij,lj->ij", ahead[at], move, emit[at + 1] * back[at + 1] / scale[at + 1][:, None])
    both = both if len(at) else np.zeros((2, 2))
    log_z = float((np.log(scale) + top).sum())
    return p[:, 1] / p.sum(axis=1), both, log_z


def train(x: np.ndarray, offsets: np.ndarray, label: np.ndarray, rounds: int = 150, ridge: float = 1e-3) -> Chain:
    """Weights by Adam on the mean log likelihood of a line with a ridge; needs both labels."""
    line_label = np.repeat(label, np.diff(offsets))
    center, spread = x.mean(axis=0), x.std(axis=0)
    center[0], spread[spread < 1e-9] = 0.0, 1.0
    z = (x - center) / spread
    theta = np.zeros(x.shape[1] + 4)
    inner = np.diff(offsets)
    pairs = np.array([[np.maximum(inner - 1, 0)[label == a].sum() if a == b else 0 for b in (0, 1)] for a in (0, 1)], float)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        p, both, _ = marginals(z @ theta[:-4], theta[-4:].reshape(2, 2), offsets)
        gain = np.concatenate([z.T @ (line_label - p), (pairs - both).ravel()]) / len(x) - ridge * theta
        m, v = 0.9 * m + 0.1 * gain, 0.999 * v + 0.001 * gain * gain
        theta += 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    weights = theta[:-4] / spread
    weights[0] -= (weights[1:] * center[1:]).sum()
    return Chain(weights, theta[-4:].reshape(2, 2))


def flat_chain(good: int, n: int) -> Chain:
    """Without both labels: every line as good as the labels' share, smoothed."""
    weights = np.zeros(N_FEATURES)
    weights[0] = np.log((good + 1) / (n - good + 1))
    return Chain(weights, np.zeros((2, 2)))


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Chain:
    """Train on ``docs(doc_id, text)`` with ``labels(doc_id, quality)``, held-out rows left out.

    Labels other than 0 and 1, null ids and texts without a word are left out.
    """
    tune(docs.sparkSession)
    usable = labels.where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    chosen = (
        usable.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    rows = docs.select("doc_id", utf8().alias("text")).where(F.octet_length("text") <= LONGEST)

    def features(batches):
        for batch in batches:
            quality = batch.column("quality").to_pylist()
            for first, texts in chunks(batch.column("text").to_pylist()):
                x, _, offsets = line_features(texts)
                parts = [x[a:b].tobytes() for a, b in zip(offsets, offsets[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(quality[first : first + len(texts)], pa.int32()), pa.array(parts, pa.binary())], ["quality", "x"]
                )

    # At most ``sample`` documents of bounded size, in an order of their own.
    found = rows.join(F.broadcast(chosen), "doc_id").select("quality", "text").mapInArrow(lean(features), "quality int, x binary")
    found = found.where(F.octet_length("x") > 0).toPandas().sort_values(["quality", "x"])
    if found["quality"].nunique() < 2:
        return flat_chain(int(found["quality"].sum()), len(found))
    label = found["quality"].to_numpy()
    offsets = np.cumsum([0, *(len(raw) // (8 * N_FEATURES) for raw in found["x"])])
    x = np.frombuffer(b"".join(found["x"])).reshape(-1, N_FEATURES)
    del found
    chain = train(x, offsets, label)
    del x
    give_back()
    return chain


def document_scores(chain: Chain, texts: list[bytes]) -> np.ndarray:
    """Quality from 0 to 1; a text without a word has 0."""
    x, sizes, offsets = line_features(texts)
    if not len(x):
        return np.zeros(len(texts))
    p, _, _ = marginals(x @ chain.weights, chain.pairs, offsets)
    total = np.concatenate(([0.0], np.cumsum(p * sizes)))
    weight = np.concatenate(([0.0], np.cumsum(sizes)))
    weight = np.diff(weight[offsets])
    return np.clip(np.diff(total[offsets]) / np.maximum(weight, 1.0), 0.0, 1.0)


def with_scores(docs: DataFrame, chain: Chain, name: str = "score") -> DataFrame:
    """``docs``, all columns, and a column ``name``; only ``text`` is read.

    A null text has no word.  Rows are scored each by itself; no rows give no rows.
    """
    tune(docs.sparkSession)
    columns = docs.columns

    def run(batches):
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
            scores = [document_scores(chain, part) for _, part in chunks(texts)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.concatenate([np.empty(0), *scores]))], [*columns, name]
            )

    return docs.mapInArrow(lean(run), T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def _ids_and_scores(docs: DataFrame, chain: Chain) -> DataFrame:
    def run(batches):
        for batch in batches:
            scores = [document_scores(chain, part) for _, part in chunks(batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.concatenate([np.empty(0), *scores]))], ["doc_id", "score"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("text"))
    return rows.mapInArrow(lean(run), "doc_id long, score double")


def score_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, cut: float = CUT) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted), one for each of ``docs(doc_id, text)``.

    A row without an id is scored and counts as not held out.  Other columns are left out.
    """
    chain = fit(docs, labels, sample)
    return _ids_and_scores(docs, chain).select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= cut).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, chain: Chain, cut: float = CUT) -> DataFrame:
    """The rows of ``docs`` that score ``cut`` or more, with all their columns."""
    name = "_".join(["score", *docs.columns])  # longer than any of them
    return with_scores(docs, chain, name).where(F.col(f"`{name}`") >= cut).drop(name)
