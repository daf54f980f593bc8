"""Plain models of the operators, for small tables."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import re


class Groups:
    def __init__(self):
        self.up = {}

    def root(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, x, y):
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)


def shingles(text, k=5):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) or frozenset([tuple(words)])


def jaccard_components(rows, k=5, similar=(75, 100)):
    """{doc_id: (size, component)} of (doc_id, text) rows with distinct ids."""
    sets = {i: shingles(t, k) for i, t in rows}
    groups = Groups()
    for i, j in itertools.combinations(sets, 2):
        a, b = sets[i], sets[j]
        if a and b and similar[1] * len(a & b) >= similar[0] * len(a | b):
            groups.join(i, j)
    return {i: (len(s), groups.root(i)) for i, s in sets.items()}


def cut(rows, k=13):
    """{doc_id: (words, removed, sha256 of the kept)} of rows with distinct ids."""
    words = {i: (t or "").encode().split() for i, t in rows}
    first = {}
    for i, w in words.items():
        for j in range(len(w) - k + 1):
            run = tuple(w[j : j + k])
            first[run] = min(first.get(run, i), i)
    out = {}
    for i, w in words.items():
        gone = set()
        for j in range(len(w) - k + 1):
            if first[tuple(w[j : j + k])] < i:
                gone.update(range(j, j + k))
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept).hexdigest())
    return out


def links(rows, threshold=0.93):
    """{vec_id: (links, component)} of (vec_id, vector, label) rows with distinct ids."""
    def able(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    groups, n = Groups(), collections.Counter()
    for i, *_ in rows:
        groups.root(i)
    for (i, v, a), (j, w, b) in itertools.combinations(rows, 2):
        if a is None or a != b or not able(v) or not able(w) or len(v) != len(w):
            continue
        dot = math.fsum(x * y for x, y in zip(v, w))
        if dot / math.sqrt(math.fsum(x * x for x in v) * math.fsum(x * x for x in w)) >= threshold:
            groups.join(i, j)
            n[i] += 1
            n[j] += 1
    return {i: (n[i], groups.root(i)) for i, *_ in rows}


def counts(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    at = collections.defaultdict(list)
    for i in range(len(words) - 7):
        at[tuple(words[i : i + 8])].append(i)
    again = {k for v in at.values() if len(v) > 1 for i in v for k in range(i, i + 8)}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again)
    )
