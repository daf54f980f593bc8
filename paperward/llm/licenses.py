"""License notices in texts, in DataFrame functions alone.

Phrases are counted where their words stand one after the other.  Beyond these, an exact
set-similarity join finds every block that holds at least ``THRESHOLD`` of the distinct
words of a notice's template, in any order and among any others.  A block is a line, or a
line with those after it, as notices are wrapped: lines are added up to one without words
and until the lines between the first and the last hold as many words as the longest
template.  So a notice stands whole in a block at whatever column it is wrapped.

* Words are ordered by how many blocks of the whole corpus hold them, rarest first.  A
  template of ``n`` words that needs ``need`` of them in a block can miss ``n - need``,
  so a block that meets it holds one of its ``n - need + 1`` rarest words (prefix).
* A block with fewer than ``need`` words of any template can't meet it (length).
* Where a common word stands at places i and j of the two ordered sets, of n and m words,
  no more than ``min(i, j) + 1 + min(n - i - 1, m - j - 1)`` can be common (position).

The templates are a parameter of bounded size.  Counting needs one row per template
word, so the order is a small table, and blocks are joined to the prefixes by it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperward.llm.quality import bind
from paperward.plans.shape import compute_once, materialize

_BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("gpl", "This work is licensed under the GNU General Public License"),
    ("lgpl", "Licensed under the GNU Lesser General Public License"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution International License"),
    ("cc0", "To the extent possible under law the author has waived all copyright and related rights"),
    ("bsd", "Redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("reserved", "No part of this publication may be reproduced without the prior written permission of the publisher"),
]
THRESHOLD = (9, 10)


def words_line(text: Column) -> Column:
    """All words with one space around each; a single space if there are none."""
    lower = F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())
    return F.regexp_replace(F.concat(F.lit(" "), lower, F.lit(" ")), _BREAKS, " ")


def template_words(text: str) -> list[str]:
    lower = text.translate(str.maketrans(_UPPER, _UPPER.lower()))
    return sorted({w for w in re.split(_BREAKS, lower) if w})


def least_common(n: int, threshold: tuple[int, int] = THRESHOLD) -> int:
    return max(1, -(-n * threshold[0] // threshold[1]))


def _spaces(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit("")))


def phrase_columns(docs: DataFrame, phrases: dict[str, str]) -> DataFrame:
    """Add n_words, n_base, first_word, last_word, base (labels) from the column ``_line``.

    ``_line`` has a space on either side of each word.
    """
    line = F.col("_line")
    places, first, last, labels = [], [], [], []
    for phrase, label in phrases.items():
        spaced = f" {phrase} "
        held = F.contains(line, F.lit(spaced))
        count = F.regexp_count(line, F.lit(f"(?<= ){phrase}(?= )"))
        before = _spaces(F.substring(line, F.lit(1), F.instr(line, spaced))) - 1
        back = F.instr(F.reverse(line), spaced[::-1])
        behind = _spaces(F.substring(line, F.lit(1), F.length(line) - back - len(spaced) + 2)) - 1
        places.append(F.when(held, count).otherwise(0))
        first.append(F.when(held, before))
        last.append(F.when(held, behind))
        labels.append(F.when(held, F.lit(label)))
    pick = lambda f, cs: (f(*cs) if len(cs) > 1 else cs[0]).cast("long")
    return docs.withColumns({
        "n_words": (_spaces(line) - 1).cast("long"),
        "n_base": sum(places[1:], places[0]).cast("long"),
        "first_word": pick(F.least, first), "last_word": pick(F.greatest, last),
        "base": F.array_sort(F.array_distinct(F.array_compact(F.array(*labels)))),
    })


def line_words(text: Column) -> Column:
    """The distinct words of every line."""
    lower = F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())
    return F.transform(F.split(lower, "\n"), lambda x: F.array_distinct(F.split(x, _BREAKS)))


def _runs(lines: Column, longest: int) -> Column:
    """For every line, the words held by the run of lines that starts there.

    ``lines`` has (n, held): a line's distinct words, counted, and those of the vocabulary.
    """

    def start(line: Column) -> Column:
        go_on = line["n"] > 0
        return F.struct(line["held"].alias("held"), F.lit(0).alias("between"), go_on.alias("go_on"))

    def add(run: Column, line: Column) -> Column:
        more = run["go_on"] & (line["n"] > 0)
        between = run["between"] + line["n"]
        held = F.when(more, F.array_union(run["held"], line["held"])).otherwise(run["held"])
        return F.struct(held.alias("held"), between.alias("between"), (more & (between < longest)).alias("go_on"))

    return F.transform(lines, lambda line, i: F.aggregate(
        F.slice(lines, i + 2, F.lit(longest)), start(line), add, lambda run: run["held"]
    ))


def word_order(docs: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """How many lines hold each word of the vocabulary: one row a word."""
    known = F.array(*[F.lit(w) for w in vocabulary])
    held = F.flatten(F.transform(line_words(F.col("text")), lambda b: F.array_intersect(b, known)))
    rows = docs.select(F.explode(held).alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()
    counts = {r["word"]: r["n"] for r in rows}
    return {w: counts.get(w, 0) for w in vocabulary}


def _prefixes(spark: SparkSession, templates, counts: dict[str, int], threshold) -> DataFrame:
    """Rows (word, place i, template, its words, label, n, need): a few for each template."""
    order = lambda w: (counts[w], w)
    rows = []
    for t, (label, text) in enumerate(templates):
        ordered = sorted(template_words(text), key=order)
        need = least_common(len(ordered), threshold)
        for i, word in enumerate(ordered[: len(ordered) - need + 1]):
            rows.append((word, i, t, ordered, label, len(ordered), need))
    return spark.createDataFrame(rows, "word string, i int, t int, words array<string>, label string, n int, need int")


def scan_licenses(
    docs: DataFrame, phrases: dict[str, str] = PHRASES, templates=tuple(TEMPLATES),
    threshold: tuple[int, int] = THRESHOLD, runs: bool = False,
) -> DataFrame:
    """Phrase places, labels and score for each row of ``docs(doc_id, text)``.

    ``score`` is 1 where a phrase stands, else the largest share of a met template's
    words that a block holds, else 0; ``blocks`` has (label, line number, share) of every
    line that meets a template by itself and, if ``runs``, ``runs`` the same of every run
    of lines, by its first line.  A null text has no words.  Rows are judged each by
    itself, also where ids repeat or are null; other columns are left out; no rows give
    no rows.
    """
    spark = docs.sparkSession
    vocabulary = sorted({w for _, text in templates for w in template_words(text)})
    counts = word_order(docs, vocabulary)
    prefixes = _prefixes(spark, templates, counts, threshold)
    rare = F.array(*[F.lit(w) for w in sorted({r["word"] for r in prefixes.select("word").collect()})])
    known = F.array(*[F.lit(w) for w in sorted(vocabulary, key=lambda w: (counts[w], w))])
    fewest = min(least_common(len(template_words(t)), threshold) for _, t in templates)
    longest = max(sum(w != "" for w in re.split(_BREAKS, t)) for _, t in templates)
    # Lines as their words of the vocabulary, rarest first, and how many words they have.
    lines = F.transform(line_words(F.col("text")), lambda b: F.struct(
        F.size(F.array_remove(b, "")).alias("n"), F.array_intersect(known, b).alias("held")
    ))
    docs = compute_once(docs.select("doc_id", "text"), "_lines", lines)
    held = F.transform("_lines", lambda x: x["held"])
    # No run has a rare word where no line has one; blocks below every bound go here.
    some = F.exists(held, lambda x: F.arrays_overlap(x, rare))
    numbered = lambda sets, run: F.transform(sets, lambda x, i: F.struct(
        i.alias("block"), F.lit(run).alias("run"), (F.array_intersect(known, x) if run else x).alias("held")
    ))
    both = F.concat(numbered(held, False), numbered(_runs(F.col("_lines"), longest), True))
    able = F.when(some, F.filter(both, lambda b: (F.size(b["held"]) >= fewest) & F.arrays_overlap(b["held"], rare)))
    rows = phrase_columns(docs.select("doc_id", words_line(F.col("text")).alias("_line"), able.alias("able")), phrases)
    rows = materialize(rows.drop("_line").withColumn("_row", F.monotonically_increasing_id()))
    met = _met(rows, prefixes)
    best = met.groupBy("_row").agg(
        F.max("share").alias("share"), F.array_sort(F.collect_set("label")).alias("found"),
        *(F.array_sort(F.collect_list(F.when(F.col("run") == run, F.struct("label", "block", "share")))).alias(name)
          for name, run in (("blocks", False), ("runs", True))),
    )
    out = rows.drop("able").join(best, "_row", "left")
    found = F.coalesce("found", F.array().cast("array<string>"))
    score = F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0)))
    return out.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", found)), ",").alias("labels"),
        score.alias("score"), "blocks", *(["runs"] if runs else []),
    )


def _met(rows: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Rows (_row, block, run, t, label, share) of the blocks that meet a template."""
    block = rows.select("_row", F.explode("able").alias("b")).select("_row", "b.block", "b.run", "b.held")
    probe = block.select("_row", "block", "run", "held", F.posexplode("held").alias("j", "word"))
    left = F.least(F.col("n") - F.col("i"), F.size("held") - F.col("j"))
    pairs = probe.join(F.broadcast(prefixes), "word").where(F.size("held") >= F.col("need"))
    common = F.size(F.array_intersect("held", "words"))
    pairs = pairs.where(left >= F.col("need") - F.least("i", "j")).where(common >= F.col("need"))
    return pairs.groupBy("_row", "block", "run", "t", "label").agg(F.max(common / F.col("n")).alias("share"))
