"""Cue matching over normalized text."""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperward.functions import lexicon as L


def _stems(phrase: str) -> set[str]:
    """Substrings that may stand for a phrase: parts of one longer word.

    Parts across words would be mostly common little words, found in any text.
    """
    for pattern, size in ((r"\S{5,}", 5), (r".+", 7)):
        parts = {
            word[i:j]
            for word in re.findall(pattern, phrase)
            for i in range(len(word) - size + 1)
            for j in range(i + size, min(len(word), i + 12) + 1)
        }
        if parts:
            return parts
    return {phrase}


def stem_groups(
    entries: Iterable[tuple[str, str]],
) -> list[tuple[str, list[tuple[str, str]]]]:
    """Group ``(category, phrase)`` pairs under shared substrings.

    A text that lacks the stem lacks every phrase of the group, so one search
    stands for many.  Greedy: the stem covering most open phrases goes first.
    """
    left = list(dict.fromkeys(entries))
    groups = []
    while left:
        cover: dict[str, int] = {}
        for _, phrase in left:
            for stem in _stems(phrase):
                cover[stem] = cover.get(stem, 0) + 1
        stem = min(cover, key=lambda s: (-cover[s], -len(s), s))
        groups.append((stem, [e for e in left if stem in e[1]]))
        left = [e for e in left if stem not in e[1]]
    return groups


def word_groups(
    entries: Iterable[tuple[str, str]],
) -> list[tuple[str, list[tuple[str, str]]]]:
    """Group phrases by their longest word: quick for lexicons of any size."""
    groups: dict[str, list[tuple[str, str]]] = {}
    for entry in sorted(set(entries)):
        stem = max(entry[1].split() or [entry[1]], key=len)
        groups.setdefault(stem, []).append(entry)
    return list(groups.items())


@functools.lru_cache(maxsize=1)
def _compiled() -> tuple[tuple[str, tuple[tuple[str, str], ...]], ...]:
    entries = [(cat, phrase) for cat, _, phrase in L.phrases()]
    return tuple((stem, tuple(group)) for stem, group in stem_groups(entries))


_STEM_TABLE = "array<struct<stem string, cues array<struct<category string, phrase string>>>>"


def _stem_table(groups) -> Column:
    """The lexicon as one constant; the optimizer folds it into a literal."""
    rows = [
        {"stem": stem, "cues": [{"category": c, "phrase": p} for c, p in group]}
        for stem, group in groups
    ]
    return F.from_json(F.lit(json.dumps(rows)), _STEM_TABLE)


def cue_hits(normalized: Column, groups=None) -> Column:
    """Sorted distinct cue categories found in normalized text.

    The whole lexicon is one constant array, so ``normalized`` appears in two
    places only, however many phrases there are.
    """
    near = F.filter(
        _stem_table(groups or _compiled()), lambda g: F.contains(normalized, g["stem"])
    )
    found = F.filter(
        F.flatten(F.transform(near, lambda g: g["cues"])),
        lambda cue: F.contains(normalized, cue["phrase"]),
    )
    return F.array_sort(F.array_distinct(F.transform(found, lambda c: c["category"])))


def imperative_patterns() -> tuple[str, str]:
    """Patterns of a clause that opens with a listed verb, and of a second person."""
    verbs = "|".join(dict.fromkeys(L.IMPERATIVE_VERBS))
    breaks = L.CLAUSE_BREAKS.replace("\n", r"\n")
    lead = L.CLAUSE_LEAD.replace("[", r"\[")
    opens = rf"(?:^|[{breaks}])[{lead}]*(?:{verbs})(?![a-z])"
    # spelled out, because \b counts non-ASCII letters as word characters
    return opens, rf"(?<![A-Za-z0-9_])(?:{'|'.join(L.SECOND_PERSON)})(?![A-Za-z0-9_])"


def imperative_address(normalized: Column) -> Column:
    """Some clause opens with a listed verb, and a second person is named.

    The verb test rejects nearly all text, so it runs first.
    """
    opens, person = imperative_patterns()
    return normalized.rlike(opens) & normalized.rlike(person)


def all_categories(cues: Column, imperative: Column) -> Column:
    """Cue categories plus the imperative one, sorted."""
    more = F.when(imperative, F.array(F.lit(L.IMPERATIVE))).otherwise(
        F.array().cast("array<string>")
    )
    return F.array_sort(F.concat(cues, more))


def confidence(categories: Column) -> Column:
    """Two categories are confident; one strong category is tentative."""
    return F.when(F.size(categories) >= 2, L.CONFIDENT).when(
        F.get(categories, F.lit(0)).isin(*L.HIGH_CONFIDENCE), L.TENTATIVE
    )


def known_kind(kind: Column) -> Column:
    return F.coalesce(kind.isin(*L.FIELD_KINDS), F.lit(False))
