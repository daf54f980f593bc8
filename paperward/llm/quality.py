"""Robust multivariate outliers among text statistics, in DataFrame functions alone.

Each text gives counts (words, their characters, symbols, repeated lines and word runs)
and from them a vector of transformed statistics.  For every language and source the
minimum covariance determinant tells where the vectors of most texts lie.  The search has
two starts: medians and quartiles, and mean and covariance of all rows.  From each, a step
takes the ``SUPPORT`` share of rows that are
nearest by Mahalanobis distance and their mean and covariance anew, until no determinant
falls any more or ``STEPS`` steps are done; of all models of a group the one with the
smallest determinant is taken.  A text whose distance passes the ``CUT`` quantile of the
chi-square law is rejected.

* Statistics are rounded to 1/1024, so the sums behind means and covariances are sums of
  whole numbers: the same on every run and after every lost executor.
* The nearest share is found from a count per group and step of distance, not by a sort.
* Junk is often plain zero for whole groups of clean texts.  Each variance gets the square
  of ``TOLERANCE`` added, so a group may be flat in some direction.  That is the regularised
  form of the estimator, whose steps lower the determinant of the regularised covariance;
  as the share is cut at a step of distance, not at a row, a determinant may also rise a
  little, and then the model before it stays.
* A step is one pass where the rows stand; only sums per group and step of distance are
  shuffled, combined before.
* A group of fewer than ``LEAST`` rows is judged with the other small groups of its
  language, and if they are too few, with all such; fewer than that have no verdict.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperward.plans.shape import materialize
from paperward.plans.skew import attach

SPACES = r"[\x20\x09-\x0D]+"
_SPACE_CHARS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
RUN = 8

GRID = 1024
#: Statistic and the spread that is always allowed.
TOLERANCE = {
    "length": 0.5,  # ln(1 + words)
    "word_length": 0.12,  # ln(characters in a word)
    "symbols": 0.06,  # root of the share of symbols
    "dup_lines": 0.15,  # share of lines
    "repeats": 0.12,  # share of words
    "capitals": 0.06,  # share of word characters
    "marks": 0.06,  # share of word characters that are neither letter nor digit
}
STATISTICS = tuple(TOLERANCE)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SUPPORT = 0.75
STEPS = 8
#: A determinant stands still when its logarithm falls by less.
STILL = 1e-3
STARTS = 2
#: Models that are broadcast at most: 8 MB.
MODELS = 20_000
CUT = 0.9999
LEAST = 50


def chi_square(x: float, k: int) -> float:
    """Share of the chi-square law of ``k`` degrees below ``x``."""
    if x <= 0:
        return 0.0
    a, x = k / 2, x / 2
    term = total = 1 / a
    n = 0
    while term > total * 1e-15:
        n += 1
        term *= x / (a + n)
        total += term
    return min(1.0, total * math.exp(-x + a * math.log(x) - math.lgamma(a)))


def chi_square_point(share: float, k: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, k) < share else (low, mid)
    return low


def bind(value: Column, body) -> Column:
    """``body`` of a value that is worked out once for a row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeated_words(words: Column, n: Column) -> Column:
    """Words in runs of ``RUN`` words that the text holds twice or more."""
    hashes = F.transform(F.sequence(F.lit(1), n - (RUN - 1)), lambda i: F.xxhash64(F.slice(words, i, RUN)))

    def count(starts: Column) -> Column:
        sizes = F.transform(starts, lambda x, j: F.least(F.lit(RUN), F.coalesce(F.get(starts, j + 1) - x, F.lit(RUN))))
        return F.aggregate(sizes, F.lit(0).cast("long"), lambda a, x: a + x)

    def again(ordered: Column) -> Column:
        same = lambda j, e: F.coalesce(F.get(ordered, j)["h"] == e["h"], F.lit(False))
        starts = F.transform(ordered, lambda e, j: F.when(same(j - 1, e) | same(j + 1, e), e["i"]))
        return bind(F.array_sort(F.array_compact(starts)), count)

    def some(h: Column) -> Column:
        ordered = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(bind(ordered, again))

    return F.when(n < RUN, F.lit(0).cast("long")).otherwise(bind(hashes, some))


def with_counts(docs: DataFrame) -> DataFrame:
    """Add the counts and transformed statistics of ``text``; a null text has no words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    without = lambda chars: F.length(F.translate(text, chars, ""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(_SPACE_CHARS)) != "")
    line_counts = bind(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")))
    word_counts = bind(
        F.array_remove(F.split(text, SPACES), ""),
        lambda w: F.struct(F.size(w).alias("n"), repeated_words(w, F.size(w)).alias("again")),
    )
    out = docs.withColumns({
        "_w": word_counts, "_l": line_counts, "word_chars": without(_SPACE_CHARS).cast("long"),
        "n_symbols": (F.length(text) - without(SYMBOLS)).cast("long"),
        "_upper": F.length(text) - F.length(F.regexp_replace(text, r"\p{Lu}+", "")),
        "_marks": F.length(F.regexp_replace(text, r"[\p{L}\p{M}\p{N}\x20\x09-\x0D]+", "")),
    })
    out = out.withColumns({
        "n_words": F.col("_w.n").cast("long"), "n_dup_lines": F.col("_l.dup").cast("long"),
        "n_repeat_words": F.col("_w.again"), "_lines": F.col("_l.n"),
    })
    chars = F.greatest("word_chars", F.lit(1))
    values = {
        "length": F.log1p("n_words"),
        "word_length": F.log(chars / F.greatest("n_words", F.lit(1))),
        "symbols": F.sqrt(F.col("n_symbols") / chars),
        "dup_lines": F.col("n_dup_lines") / F.greatest("_lines", F.lit(1)),
        "repeats": F.col("n_repeat_words") / F.greatest("n_words", F.lit(1)),
        "capitals": F.col("_upper") / chars,
        "marks": F.col("_marks") / chars,
    }
    out = out.withColumn("x", F.array(*[F.round(values[s] * GRID).cast("long") for s in STATISTICS]))
    failed = (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    return out.withColumn("base_failed", failed).drop("_w", "_l", "_upper", "_marks", "_lines")


# Below, whole matrices are written as SQL text: a few thousand cells are built faster so.


def _cell(i: int, j: int) -> str:
    return f"c_{min(i, j)}_{max(i, j)}"


def _cells(p: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(p) for j in range(i, p)]


def _sweep(model: DataFrame, p: int) -> DataFrame:
    """Columns ``c_i_j`` (a positive definite matrix) turned into its inverse, and its log determinant."""
    others = [f"m_{i}" for i in range(p)]
    model = model.selectExpr("*", "0D AS logdet")
    for k in range(p):
        pivot = _cell(k, k)
        new = []
        for i, j in _cells(p):
            if i == j == k:
                value = f"-1 / {pivot}"
            elif k in (i, j):
                value = f"{_cell(i, j)} / {pivot}"
            else:
                value = f"{_cell(i, j)} - {_cell(i, k)} * {_cell(k, j)} / {pivot}"
            new.append(f"{value} AS {_cell(i, j)}")
        model = model.selectExpr("est", "start", "size", *others, f"logdet + ln({pivot}) AS logdet", *new)
    return model.selectExpr("est", "start", "size", *others, "logdet", *[f"-{_cell(i, j)} AS {_cell(i, j)}" for i, j in _cells(p)])


def _model(moments: DataFrame, scale: float, p: int) -> DataFrame:
    """Per group and start: centre ``m`` and inverse covariance ``q``, from whole-number sums."""
    out = [f"s_{i} / n / {GRID}D AS m_{i}" for i in range(p)]
    for i, j in _cells(p):
        floor = TOLERANCE[STATISTICS[i]] ** 2 if i == j else 0.0
        out.append(f"(s_{i}_{j} - s_{i} / n * s_{j}) / n / {GRID * GRID}D * {scale!r}D + {floor!r}D AS {_cell(i, j)}")
    return _packed(_sweep(moments.selectExpr("est", "start", "size", *out), p), p)


def _packed(model: DataFrame, p: int) -> DataFrame:
    m, q = (", ".join(x) for x in ([f"m_{i}" for i in range(p)], [_cell(i, j) for i, j in _cells(p)]))
    return model.selectExpr("est", "start", "size", f"array({m}) AS m", f"array({q}) AS q", "logdet")


def distance(p: int = len(STATISTICS)) -> Column:
    """Square of the Mahalanobis distance of ``x`` from a model's columns."""
    d = [f"(x[{i}] / {GRID}D - m[{i}])" for i in range(p)]
    terms = [f"q[{n}] * {1 if i == j else 2} * {d[i]} * {d[j]}" for n, (i, j) in enumerate(_cells(p))]
    return F.expr(f"greatest({' + '.join(terms)}, 0D)")


def _quartiles(rows: DataFrame, p: int) -> DataFrame:
    """A first model: medians, and spreads from the quartiles, no covariance."""
    values = rows.select("est", F.posexplode("x").alias("i", "v")).groupBy("est", "i", "v").agg(F.count("*").alias("n"))
    below = Window.partitionBy("est", "i").orderBy("v")
    whole = Window.partitionBy("est", "i")
    ranked = values.select("est", "i", "v", F.sum("n").over(below).alias("upto"), F.sum("n").over(whole).alias("all"))
    at = lambda share: F.min(F.when(F.col("upto") >= F.col("all") * share, F.col("v"))) / GRID
    per = ranked.groupBy("est", F.col("all").alias("size")).pivot("i", list(range(p))).agg(
        at(0.5).alias("m"), ((at(0.75) - at(0.25)) / 1.349).alias("sd")
    )
    spread = [f"(`{i}_sd` * `{i}_sd` + {TOLERANCE[STATISTICS[i]] ** 2!r}D)" for i in range(p)]
    cells = [f"`{i}_m` AS m_{i}" for i in range(p)]
    cells += [(f"1 / {spread[i]}" if i == j else "0D") + f" AS {_cell(i, j)}" for i, j in _cells(p)]
    logdet = " + ".join(f"ln({x})" for x in spread)
    return _packed(per.selectExpr("est", "0 AS start", "size", *cells, f"{logdet} AS logdet"), p)


def _sums(p: int) -> dict[str, str]:
    return {f"s_{i}": f"x[{i}]" for i in range(p)} | {f"s_{i}_{j}": f"x[{i}] * x[{j}]" for i, j in _cells(p)}


def _aggregates(p: int) -> list[Column]:
    return [F.count("*").alias("n"), *[F.expr(f"sum({v}) AS {k}") for k, v in _sums(p).items()]]


def _with_model(rows: DataFrame, model: DataFrame, keys: list[str], few: bool) -> DataFrame:
    """Each row with the model of its group.

    A model has some 400 bytes, so up to ``MODELS`` of them, ``few``, are broadcast; more
    are attached by a salted join, so that a large group is many tasks' work.
    """
    if few:
        return rows.join(F.broadcast(model.drop("size")), keys)
    return attach(rows, model, keys, "size", ["x"])


def _nearest_sums(rows: DataFrame, model: DataFrame, support: float, p: int, few: bool) -> DataFrame:
    """Sums over the rows within the smallest step of distance that holds ``support`` of their group.

    Sums are taken per step of distance; the steps of a group, a few thousand at most, are
    then cut and added up.
    """
    far = F.floor(F.log2(distance() + 1) * 64)
    rows = rows.select("est", "x", F.explode(F.array(*map(F.lit, range(STARTS)))).alias("start"))
    rows = _with_model(rows, model, ["est", "start"], few).withColumn("far", far)
    steps = rows.groupBy("est", "start", "far").agg(*_aggregates(p))
    group = Window.partitionBy("est", "start")
    before = F.sum("n").over(group.orderBy("far").rowsBetween(Window.unboundedPreceding, -1))
    steps = steps.withColumns({"_before": F.coalesce(before, F.lit(0)), "size": F.sum("n").over(group)})
    inside = steps.where(F.col("_before") < F.col("size") * support)
    return inside.groupBy("est", "start").agg(F.max("size").alias("size"), *[F.sum(c).alias(c) for c in ("n", *_sums(p))])


def search(rows: DataFrame, support: float = SUPPORT, steps: int = STEPS) -> DataFrame:
    """Models (est, start, size, m, q, logdet) that each start of each group of ``rows(est, x)`` ends at."""
    p = len(STATISTICS)
    consistent = support / chi_square(chi_square_point(support, p), p + 2)
    quartiles = materialize(_quartiles(rows, p))
    few = quartiles.count() * STARTS <= MODELS
    whole = rows.groupBy("est").agg(*_aggregates(p)).withColumns({"start": F.lit(1), "size": F.col("n")})
    model = quartiles.unionByName(_model(whole, 1.0, p))
    model = materialize(model)
    best = materialize(_model(_nearest_sums(rows, model, support, p, few), consistent, p))
    for _ in range(steps - 1):
        model = _model(_nearest_sums(rows, best, support, p, few), consistent, p)
        old = best.select("est", "start", F.col("m").alias("_m"), F.col("q").alias("_q"), F.col("logdet").alias("_logdet"))
        falls = F.col("logdet") < F.col("_logdet") - STILL
        both = materialize(model.join(old, ["est", "start"]).withColumn("_falls", falls))
        keep = lambda new: F.when(F.col("_falls"), F.col(new)).otherwise(F.col("_" + new)).alias(new)
        best = both.select("est", "start", "size", keep("m"), keep("q"), keep("logdet"), "_falls")
        if best.where("_falls").isEmpty():
            break
        best = best.drop("_falls")
    return best.select("est", "start", "size", "m", "q", "logdet")


def estimates(counted: DataFrame, support: float = SUPPORT, steps: int = STEPS, least: int = LEAST) -> DataFrame:
    """A model (lang, source, m, q, logdet) for every language and source in ``counted``.

    Null languages and sources are groups like others.  Groups that have no verdict are
    left out.
    """
    p = len(STATISTICS)
    sizes = counted.groupBy("lang", "source").agg(F.count("*").alias("n"))
    small = F.col("n") < least
    by_lang = F.sum(F.when(small, F.col("n"))).over(Window.partitionBy("lang"))
    name = lambda *cols: F.concat_ws("\x01", *[F.coalesce(F.concat(F.lit("="), c), F.lit("null")) for c in cols])
    sizes = sizes.withColumn("small_n", by_lang).withColumn(
        "est",
        F.when(~small, F.concat(F.lit("s"), name("lang", "source")))
        .when(F.col("small_n") >= least, F.concat(F.lit("l"), name("lang"))).otherwise("all"),
    ).select("lang", "source", "est", "n")
    sizes = materialize(sizes)
    enough = sizes.groupBy("est").agg(F.sum("n").alias("n")).where(F.col("n") >= min(least, 2 * p)).select("est")
    named = sizes.join(enough, "est").select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), "est")
    rows = counted.select("lang", "source", "x").join(
        named, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    ).select("est", "x")
    rows = materialize(rows)
    model = search(rows, support, steps).groupBy("est").agg(
        F.min_by(F.struct("m", "q", "logdet"), F.struct("logdet", "start")).alias("best")
    ).select("est", "best.*")
    return named.join(model, "est").select("_lang", "_source", "m", "q", "logdet")


def judge(counted: DataFrame, models: DataFrame, cut: float = CUT) -> DataFrame:
    """``counted`` with ``distance`` (null without a model) and ``kept``."""
    limit = chi_square_point(cut, len(STATISTICS))
    joined = counted.join(
        models, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left"
    )
    joined = joined.withColumn("distance", distance())
    kept = ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= limit)
    return joined.withColumn("kept", kept).drop("_lang", "_source", "m", "q", "logdet")


def quality_rules(docs: DataFrame, cut: float = CUT) -> DataFrame:
    """Counts and verdict for each row of ``docs(doc_id, text, lang, source)``.

    A null or empty text fails the base rule.  Rows with one id are judged each by
    itself, nulls in ``lang`` and ``source`` form groups of their own, other columns are
    left out, and no rows give no rows.
    """
    counted = with_counts(docs.select("doc_id", "text", "lang", "source")).drop("text")
    counted = materialize(counted)
    return judge(counted, estimates(counted), cut)


def keep_good(docs: DataFrame, cut: float = CUT) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns.

    Rows are written with their counts, so that nothing is counted twice.
    """
    whole = docs.select(F.struct("*").alias("_doc"), "text", "lang", "source")
    counted = materialize(with_counts(whole).select("_doc", "lang", "source", "x", "base_failed"))
    return judge(counted, materialize(estimates(counted)), cut).where("kept").select("_doc.*")
