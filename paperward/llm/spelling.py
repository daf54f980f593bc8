"""Spelling variants: words one edit apart, found over a reduced alphabet.

Letters are hashed to four symbols, so a word of up to 31 letters is one long: a leading 1
and two bits a letter.  Two words that differ by one inserted, deleted or replaced letter
have reduced words that are equal or differ by one such edit.  Every distinct reduced word
generates its full one-edit neighbourhood, some seven strings a letter, by shifts, and
these are joined with the reduced vocabulary by equality.  Many words share a reduced
word, so far fewer neighbourhoods are generated than there are words, and a row of one is
two longs.  Words are then put in for the reduced ones, and what meets is verified on the
original strings: Levenshtein distance 1, by code points.  Every ordered pair meets once,
since a neighbourhood is a set and a word has one reduced word.

Words of more than ``LONG`` letters don't fit a long.  An edit leaves their first or their
last ``END`` letters as they are, so these are their keys instead, and a pair that agrees
in both counts by the first.

The vocabulary is one row a word, counted with partial sums, so copies of a text and
frequent words weigh nothing after it.  Counts of near words and the best form are partial
aggregates over the verified pairs; no list of a word's near words is made.  Forms are
followed by doubling steps: each form is ``TIMES`` as frequent as its word, so chains have
the logarithm of the largest count as length at most.

Defined cases: null, empty and blank texts have no words; null words, and words without
a count, are left out; a word that stands in several rows of the vocabulary counts once,
with the sum of its rows; no rows give no rows; other columns are left out.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperward.plans.shape import materialize

#: Longest word with a neighbourhood; letters that stand for each end of a longer one.
LONG, END = 30, 15
TIMES = 10

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = UPPER + LOWER + "".join(map(chr, range(0xC0, 0x100)))


def letter_runs(docs: DataFrame, least: int) -> DataFrame:
    """Rows (doc_id, run) of the maximal runs of ``least`` letters or more; only A-Z are lower-cased."""
    runs = F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0))
    return docs.select("doc_id", F.explode(runs).alias("run")).select(
        "doc_id", F.translate("run", UPPER, LOWER).alias("run")
    )


def count_words(runs: DataFrame, least_n: int) -> DataFrame:
    """Rows (word, n) of the runs that stand ``least_n`` times or more."""
    counted = runs.groupBy(F.col("run").alias("word")).agg(F.count("*").alias("n"))
    return counted.where((F.col("n") >= least_n) & F.col("word").isNotNull())


def reduced(word: Column) -> Column:
    """The word over four symbols as a long; what isn't a letter is a 0."""
    symbols = "".join(str(zlib.crc32(x.encode()) % 4) for x in LETTERS)
    plain = F.regexp_replace(word, f"(?s)[^{LETTERS}]", LETTERS[0])
    return F.conv(F.concat(F.lit("1"), F.translate(plain, LETTERS, symbols)), 4, 10).cast("bigint")


def neighbourhood(code: str, size: str) -> Column:
    """All reduced words one edit or none away; places count from the last letter, from 0."""
    places = f"filter(sequence(0, {size}), i -> i < {size})"
    below = f"({code} & (shiftleft(1L, 2 * i) - 1))"
    symbols = "array(0L, 1L, 2L, 3L)"
    return F.expr(f"""array_distinct(concat(
        array({code}),
        transform({places}, i -> shiftleft(shiftright({code}, 2 * i + 2), 2 * i) | {below}),
        flatten(transform({places}, i -> transform({symbols}, x ->
            shiftleft(shiftleft(shiftright({code}, 2 * i + 2), 2) | x, 2 * i) | {below}))),
        flatten(transform(sequence(0, {size}), i -> transform({symbols}, x ->
            shiftleft(shiftleft(shiftright({code}, 2 * i), 2) | x, 2 * i) | {below})))))""")


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """Rows (word, other, other_n): every ordered pair of different words one edit apart, once."""
    other = vocabulary.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    return _short_pairs(vocabulary, other).unionByName(_long_pairs(vocabulary, other))


def _apart(met: DataFrame) -> DataFrame:
    """Rows of words one edit apart.  Half of such a word stays as it is, which is seen sooner."""
    half = F.shiftright(F.length("word") - 1, 1)
    same = (F.left("word", half) == F.left("other", half)) | (F.right("word", half) == F.right("other", half))
    return met.where(same & (F.levenshtein("word", "other", 1) == 1)).select("word", "other", "other_n")


def _short_pairs(vocabulary: DataFrame, other: DataFrame) -> DataFrame:
    sized = vocabulary.select("word", F.length("word").alias("size")).where(F.col("size") <= LONG)
    sized = sized.withColumn("code", reduced(F.col("word")))
    asked = sized.select("code", "size").distinct().select("code", F.explode(neighbourhood("code", "size")).alias("near"))
    targets = other.where(F.length("other") <= LONG + 1).withColumn("near", reduced(F.col("other")))
    met = asked.join(targets, "near").select("code", "other", "other_n")
    return _apart(met.join(sized.select("word", "code"), "code"))


def _long_pairs(vocabulary: DataFrame, other: DataFrame) -> DataFrame:
    def keyed(df, name, least):
        ends = [F.struct(F.lit(i).alias("end"), side(name, F.lit(END)).alias("key")) for i, side in enumerate((F.left, F.right))]
        rows = df.where(F.length(name) >= least).select("*", F.explode(F.array(*ends)).alias("_at"))
        return rows.select(*df.columns, "_at.end", "_at.key")

    met = keyed(vocabulary.select("word"), "word", LONG + 1).join(keyed(other, "other", LONG), ["end", "key"])
    twice = (F.col("end") == 1) & (F.left("word", F.lit(END)) == F.left("other", F.lit(END)))
    return _apart(met.where(~twice))


def variants(words: DataFrame, times: int = TIMES) -> DataFrame:
    """Each word of ``words(word, n)`` with its form, root, and counts.

    ``n_near`` counts the words one edit apart.  ``form`` is the most frequent of them,
    the first in code-point order among equals, if it stands at least ``times`` as often
    as the word, with ``form_n`` its count; else null.  ``root`` is where forms end.
    """
    words = words.where("word IS NOT NULL AND n IS NOT NULL").groupBy("word").agg(F.sum("n").cast("long").alias("n"))
    words = materialize(words)
    near = near_pairs(words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("low"), "other")).alias("best")
    )
    joined = words.join(near, "word", "left")
    frequent = -F.col("best.low") >= times * F.col("n")
    judged = materialize(joined.select(
        "word", F.when(frequent, F.col("best.other")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(frequent, -F.col("best.low")).alias("form_n"),
    ))
    return judged.join(_roots(judged.where("form IS NOT NULL").select("word", "form")), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _roots(forms: DataFrame) -> DataFrame:
    """Where the forms of each word end: rows (word, root)."""
    roots = forms.select("word", F.col("form").alias("root"))
    open_ = True
    while open_:
        step = roots.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        roots = materialize(roots.join(step, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_open")))
        open_ = not roots.where("_open").isEmpty()
        roots = roots.drop("_open")
    return roots
