"""Periodic runs of words, found on a grammar of each text (Re-Pair).

A run is a stretch of words with smallest period ``q``, at least ``least`` words and
``times`` periods long, that no neighbouring word extends.

1. Grammar.  Word ids are paired: the pair that stands most often in a block (ties by a
   fixed shuffle) becomes a nonterminal wherever it stands, until no pair stands twice.
   A step takes all pairs at once of which no neighbour in any place ranks higher, which
   gives what one after the other would.  Each replacement notes where it stands, so the
   derivation positions of a nonterminal are known.  What is left of the blocks of a text
   is its start rule, split in halves at symbol bounds, nonterminals that stand once.
2. Runs at a boundary, once for each nonterminal.  A run inside ``X = AB`` that crosses
   the bound of A and B has a period at most a third of X, and the words at the bound
   stand again one period to the right or to the left, four of them at least.  Periods
   with equal four-word hashes there are compared word by word as far as they reach in X.
   A multiple of a period found, inside its stretch, gives the same stretch and isn't
   compared.
3. Every run lies in a smallest nonterminal, where it is found whole.  Runs of a
   nonterminal are carried to its derivation positions; what is contained in a run of the
   same or a smaller period is a part of it, and goes.

Texts are worked on where they are read: nothing is shuffled.  A text costs about
``n log n`` compared hashes, and each period tried the words that it holds for.  Blocks
of a grammar have ``BLOCK`` words at most; runs cross blocks by the start rule.

Defined cases: a null, empty or blank text has no words and no runs; rows of one id, or
without one, are answered each by its own; no rows give no rows; other columns are left
out.  Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperward.llm.arrays import IS_SPACE, U64, Words, chunks, mix
from paperward.llm.shared import lean, tune, utf8

LEAST, TIMES = 24, 3
#: Words of one grammar, and items handled by one array operation.
BLOCK, PIECE = 1 << 20, 1 << 21
#: Words at a bound that stand again a period away: half of a run's words less a period.
GRAM = 4

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_ROW = "doc_id long, n_words long, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


class Grammar:
    """Rules (left, bound, right) at their first place, all their places, and start symbols."""

    def __init__(self, symbols: np.ndarray, block: np.ndarray, first: int):
        rules, places, self.starts = [], [], []
        n = len(symbols)
        at = np.arange(first, first + n)
        state = [symbols, block, at, at + 1]
        fresh, n_rules = int(symbols.max(initial=0)) + 1, 0
        while True:
            found = _next_pairs(*state[:2])
            if found is None:
                break
            kind, where, n_kinds, live = found
            symbols, block, at, end = state
            rule = np.unique(kind, return_index=True)[1]
            rules.append(np.stack([at[where[rule]], at[where[rule] + 1], end[where[rule] + 1]]))
            places.append(np.stack([kind + n_rules, at[where]]))
            symbols[where], end[where] = kind + fresh, end[where + 1]
            keep = np.ones(len(at), bool)
            keep[where + 1] = False
            fresh, n_rules = fresh + n_kinds, n_rules + n_kinds
            done = keep & ~live
            self.starts.append(at[done])
            keep &= live
            state = [x[keep] for x in state]
        self.starts.append(state[2])
        self.starts = np.sort(np.concatenate(self.starts))
        self.rules = np.concatenate([np.empty((3, 0), np.int64), *rules], axis=1)
        self.places = np.concatenate([np.empty((2, 0), np.int64), *places], axis=1)


def _next_pairs(symbols: np.ndarray, block: np.ndarray):
    """(number of the pair, place) of what one step replaces, how many pairs, and which symbols stay open."""
    if len(symbols) < 2:
        return None
    places = np.flatnonzero(block[1:] == block[:-1])
    left, right = symbols[places], symbols[places + 1]
    pairs, kind = np.unique(left << 32 | right, return_inverse=True)
    # Of a stretch a a a a every second place counts.
    usable = np.ones(len(places), bool)
    if (twin := left == right).any():
        fresh = np.ones(len(places), bool)
        fresh[1:] = ~(twin[1:] & twin[:-1] & (left[1:] == left[:-1]) & (places[1:] == places[:-1] + 1))
        begun = np.maximum.accumulate(np.where(fresh, np.arange(len(places)), 0))
        usable = (np.arange(len(places)) - begun) % 2 == 0
    counts = np.bincount(kind[usable], minlength=len(pairs))
    rank = np.empty(len(pairs), np.int64)
    rank[np.lexsort((mix(pairs.view(U64)), counts))] = np.arange(1, len(pairs) + 1)
    rank[counts < 2] = 0
    if not rank.any():
        return None
    here = np.zeros(len(symbols) + 1, np.int64)
    here[places + 1] = rank[kind]
    beaten = here[places + 1] < np.maximum(here[places], here[np.minimum(places + 2, len(symbols))])
    chosen = rank > 0
    chosen[kind[beaten]] = False
    taken = np.flatnonzero(chosen[kind] & usable)
    number = np.cumsum(chosen) - 1
    open_blocks = block[places[rank[kind] > 0]]
    live = np.isin(block, np.unique(open_blocks))
    return number[kind[taken]], places[taken], int(chosen.sum()), live


def _halves(starts: np.ndarray, bounds: np.ndarray, least: int) -> np.ndarray:
    """Nodes (left, bound, right) of the start rules of all texts, split in halves."""
    ends = np.append(starts, bounds[-1])
    low, high = np.searchsorted(starts, bounds[:-1]), np.searchsorted(starts, bounds[1:])
    nodes = [np.empty((3, 0), np.int64)]
    while len(low):
        fit = (high - low >= 2) & (ends[high] - ends[low] >= least)
        low, high = low[fit], high[fit]
        middle = np.searchsorted(starts, (ends[low] + ends[high]) // 2)
        middle = np.clip(middle, low + 1, high - 1)
        nodes.append(np.stack([ends[low], ends[middle], ends[high]]))
        low, high = np.concatenate([low, middle]), np.concatenate([middle, high])
    return np.concatenate(nodes, axis=1)


def _pieces(sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, 0..size-1) of all rows, ``PIECE`` items at a time."""
    ends = np.cumsum(sizes)
    for s in range(0, int(ends[-1]) if len(ends) else 0, PIECE):
        item = np.arange(s, min(s + PIECE, int(ends[-1])))
        row = np.searchsorted(ends, item, "right")
        yield row, item - (ends[row] - sizes[row])


def _reach(ids: np.ndarray, at: np.ndarray, period: np.ndarray, step: int, limit: np.ndarray) -> np.ndarray:
    """How many words from ``at`` on, in steps of ``step``, equal those a period later; ``limit`` at most."""
    out = np.zeros(len(at), np.int64)
    todo, width = np.flatnonzero(limit > 0), 4
    while len(todo):
        width = max(4, min(2 * width, 1 << 20))
        rest = []
        for s in range(0, len(todo), max(1, PIECE // width)):
            mine = todo[s : s + max(1, PIECE // width)]
            ahead = out[mine, None] + np.arange(width)
            inside = ahead < limit[mine, None]
            place = at[mine, None] + step * np.where(inside, ahead, 0)
            equal = inside & (ids[place] == ids[place + period[mine, None]])
            whole = equal.all(axis=1)
            out[mine] += np.where(whole, width, np.argmin(equal, axis=1))
            rest.append(mine[whole])
        todo = np.concatenate(rest)
    return out


def _crossing(ids: np.ndarray, grams: np.ndarray, nodes: np.ndarray, least: int, times: int) -> np.ndarray:
    """(node, start, end, period) of the runs inside each node that cross its bound."""
    left, bound, right = nodes
    most = (right - left) // times
    found = [np.empty((4, 0), np.int64)]
    for side in (0, 1):
        # words at the bound are looked for a period to the right, or to the left
        own = bound if side == 0 else bound - GRAM
        room = right - GRAM - bound if side == 0 else own - left
        hits = []
        for node, q in _pieces(np.maximum(np.minimum(most, room), 0)):
            q += 1
            there = own[node] + q if side == 0 else own[node] - q
            same = grams[there] == grams[own[node]]
            hits.append((node[same], q[same]))
        if not hits:
            continue
        node, q = (np.concatenate(x) for x in zip(*hits))
        share = 1
        while len(node):
            # the first periods of each node, twice as many each time
            fresh = np.concatenate(([True], node[1:] != node[:-1]))
            nth = np.arange(len(node)) - np.maximum.accumulate(np.where(fresh, np.arange(len(node)), 0))
            now = nth < share
            x, p = node[now], q[now]
            base = bound[x] if side == 0 else bound[x] - p
            up = _reach(ids, base, p, 1, right[x] - p - base)
            down = _reach(ids, base - 1, p, -1, base - left[x])
            start, end = base - down, base + up + p
            run = end - start >= np.maximum(least, times * p)
            found.append(np.stack([x, start, end, p])[:, run])
            # multiples of the period with the longest stretch of each node
            order = np.lexsort((start - end, x))
            best = order[np.concatenate(([True], x[order][1:] != x[order][:-1]))]
            node, q = node[~now], q[~now]
            by = best[np.minimum(np.searchsorted(x[best], node), len(best) - 1)]
            base = bound[node] if side == 0 else bound[node] - q
            inside = (base >= start[by]) & (base + q < end[by])
            other = ~((x[by] == node) & (q % p[by] == 0) & inside)
            node, q, share = node[other], q[other], 2 * share
    return np.concatenate(found, axis=1)


def _maximal(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches in no other of the same or a smaller period, by start, then period."""
    order = np.lexsort((-end, start, period))
    start, end, period = start[order], end[order], period[order]
    # Per period: those that reach beyond all that started before.
    keep = np.ones(len(start), bool)
    cuts = np.flatnonzero(np.concatenate(([True], period[1:] != period[:-1]))).tolist() if len(start) else []
    for s, e in zip(cuts, [*cuts[1:], len(start)]):
        keep[s + 1 : e] = end[s + 1 : e] > np.maximum.accumulate(end[s:e])[:-1]
    start, end, period = start[keep], end[keep], period[keep]
    order = np.lexsort((period, -end, start))
    # Across periods few stretches that hold three periods overlap, so few are open at a time.
    alive, out = [], []
    for i in order.tolist():
        s, e, p = start[i], end[i], period[i]
        alive = [j for j in alive if end[j] > s]
        if not any(end[j] >= e and period[j] <= p for j in alive):
            alive.append(i)
            out.append(i)
    out = np.array(out, np.int64)
    out = out[np.lexsort((period[out], start[out]))]
    return start[out], end[out], period[out]


def find_runs(
    ids: np.ndarray, bounds: np.ndarray, least: int = LEAST, times: int = TIMES, block: int = BLOCK
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and period of all runs of the texts ``ids[bounds[i]:bounds[i+1]]``, laid end to end.

    ``least`` must be 24 and ``times`` 3 at least: then half a run holds four words more than a period.
    """
    assert times >= TIMES and least >= LEAST
    bounds = bounds.astype(np.int64)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    inside = np.arange(len(ids)) - bounds[text]
    unit = np.cumsum(np.concatenate(([0], (inside[1:] % block == 0).astype(np.int64)))) if len(ids) else inside
    grammars, s = [], 0
    while s < len(ids):
        e = len(ids)
        if e - s > 2 * block:
            e = int(np.searchsorted(unit, unit[s + 2 * block] if unit[s + 2 * block] > unit[s] else unit[s] + 1))
        symbols = np.unique(unit[s:e] << 32 | ids[s:e], return_inverse=True)[1].astype(np.int64)
        grammars.append(Grammar(symbols, unit[s:e], s))
        s = e
    if not grammars:
        return (np.empty(0, np.int64),) * 3
    grams = np.zeros(len(ids), np.uint32)
    total = np.zeros(max(len(ids) - GRAM + 1, 0), U64)
    for j in range(GRAM):
        total = mix(total + U64(j + 1)) + ids[j : len(ids) - GRAM + 1 + j].astype(U64)
    grams[: len(total)] = (mix(total) >> U64(32)).astype(np.uint32)
    found = []
    for grammar in grammars:
        nodes = grammar.rules
        wide = np.flatnonzero(nodes[2] - nodes[0] >= least)
        node, start, end, period = _crossing(ids, grams, nodes[:, wide], least, times)
        # carried to every place of the nonterminal
        rule, at = grammar.places
        order = np.argsort(rule, kind="stable")
        rule, at = rule[order], at[order]
        low, high = np.searchsorted(rule, wide[node]), np.searchsorted(rule, wide[node], "right")
        for row, nth in _pieces(high - low):
            shift = at[low[row] + nth] - nodes[0, wide[node[row]]]
            found.append(_unique(start[row] + shift, end[row] + shift, period[row]))
    tops = _halves(np.concatenate([g.starts for g in grammars]), bounds, least)
    found.append(_crossing(ids, grams, tops, least, times)[1:])
    return _maximal(*np.concatenate(found, axis=1))


def _unique(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> np.ndarray:
    return np.stack(_within_period(start, end, period))


def _within_period(start, end, period):
    order = np.lexsort((-end, start, period))
    start, end, period = start[order], end[order], period[order]
    same = (period[1:] == period[:-1]) & (start[1:] == start[:-1])
    keep = np.concatenate(([True], ~same)) if len(start) else np.ones(0, bool)
    return start[keep], end[keep], period[keep]


def collapsed(words: Words, dropped: np.ndarray) -> list[bytes]:
    """The words that stay of each text, joined by one space."""
    spaced = np.where(IS_SPACE[words.buf], np.uint8(32), words.buf)
    stays = ~IS_SPACE[words.buf]
    stays[words.ends] = True
    if dropped.any():
        change = np.zeros(len(stays) + 2, np.int8)
        change[words.starts[dropped]] += 1
        change[words.ends[dropped] + 1] -= 1
        stays &= np.cumsum(change, dtype=np.int8)[: len(stays)] == 0
    data = spaced[stays].tobytes()
    sizes = np.where(dropped, 0, words.ends - words.starts + 1)
    at = np.concatenate(([0], np.cumsum(sizes)))[words.first]
    return [data[s : max(s, e - 1)] for s, e in zip(at[:-1].tolist(), at[1:].tolist())]


def _detector(least: int, times: int):
    def detect(batches):
        for batch in batches:
            for s, texts in chunks(batch.column("text").to_pylist()):
                words = Words(texts)
                ids = np.unique(words.hashes, return_inverse=True)[1]
                start, end, period = find_runs(ids, words.first, least, times)
                change = np.zeros(len(ids) + 1, np.int64)
                np.add.at(change, start + period, 1)
                np.add.at(change, end, -1)
                text = np.searchsorted(words.first, start, "right") - 1
                runs = pa.StructArray.from_arrays(
                    [pa.array(x) for x in (start - words.first[text], end - start, period)], fields=list(_RUN)
                )
                offsets = np.searchsorted(text, np.arange(len(texts) + 1)).astype(np.int32)
                kept = collapsed(words, np.cumsum(change)[:-1] > 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(s, len(texts)), pa.array(words.counts, pa.int64()),
                        pa.ListArray.from_arrays(offsets, runs), pa.array(kept, pa.binary()).cast(pa.string()),
                    ],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    return detect


def periodic_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: its words, its runs by start and period, and the text without repeats.

    ``start`` numbers words from 0.  ``collapsed`` has the words that stand in no run
    beyond its first period, joined by one space.
    """
    tune(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("text"))
    return rows.mapInArrow(lean(_detector(least, times)), _ROW)
