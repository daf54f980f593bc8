"""Many phrases in one pass over a text, by an Aho-Corasick automaton."""

from __future__ import annotations

import sys

import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def build(phrases: list[str], categories: list[int]):
    """An automaton that yields, at each end of a phrase, the numbers of its categories."""
    import ahocorasick

    filed: dict[str, set[int]] = {}
    for phrase, category in zip(phrases, categories):
        filed.setdefault(phrase, set()).add(category)
    automaton = ahocorasick.Automaton()
    for phrase, numbers in filed.items():
        automaton.add_word(phrase, tuple(numbers))
    automaton.make_automaton()
    return automaton


def finder(lexicon):
    """Rows (key, category) of Arrow batches (key, text): each category once a text, null for none.

    ``lexicon`` is a broadcast ``(phrases, category of each, names)``.
    """

    def find(batches):
        phrases, categories, names = lexicon.value
        automaton = build(phrases, categories) if phrases else None
        for batch in batches:
            rows, found = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                held: set[int] = set()
                if text and automaton:
                    for _, numbers in automaton.iter(text):
                        held.update(numbers)
                        if len(held) == len(names):
                            break
                rows += [i] * (len(held) or 1)
                found += [names[c] for c in held] or [None]
            keys = batch.column(0).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([keys, pa.array(found, pa.string())], ["key", "category"])

    return find
