"""Passages that repeat across documents, by prefix-partitioned suffix trees.

Each word position of a text with a whole window of words behind it starts a suffix.  Its
prefix names its group: the fewest words that hold 24 bytes; where many suffixes share
that prefix, those that hold 48; where many share that too, all words of the first range.
Which prefixes are too frequent is two bit tables of fixed size, filled from a sample.
They only balance: whether a prefix is made longer depends on the prefix alone, so suffixes
that begin alike always meet in one group.

The trees are built by ranges of symbols, and only suffixes that are not yet told apart
send the next one:

1. The first range, all words of a window but the last three, goes to the group as one
   symbol.  A suffix that shares it with no other document is a leaf below no deep node.
2. The others send their window's symbols.  The group sorts its suffixes by them, takes
   the depth to which neighbours in that order agree, and reads the deep internal nodes
   off it: maximal intervals in which neighbours agree to the depth of a whole window.
   The leaves of a node, but those of its smallest document, are repeats.

Neighbouring repeats of a document run together to the maximal repeats, whose words go.

Texts that stand in one chunk are settled there first: of equal suffixes only the one of
the smallest document is sent on, the others are repeats already.  So however many
documents share a window, its group gets one suffix for 4 MB of text.  A long text is cut
in slices that overlap by a window less one word.  Symbols have 40 bits, a word's hash each.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperward.llm.arrays import CHUNK, U64, Words, chunks, mix
from paperward.llm.grams import BLOBS, GROUP_RUNS, blobs, group_count, is_in, owners_of_group, runs_of_group, unpack
from paperward.llm.jaccard import _ragged
from paperward.llm.shared import lean, lean_group, tune, utf8

WINDOW = 13
#: Bytes of a prefix, and of one that replaces a frequent prefix.
PREFIX_BYTES = (24, 48)
#: Words of a window that follow its first range.
LAST = 3
#: Prefixes share the slots of a bit table by their first bits.
SLOT_BITS = 20
#: Text from which frequent prefixes are told; only the balance of groups rests on it.
SAMPLE_BYTES = 64 << 20
_FIRST_WIDTH, _WIDTH, _NAME_WIDTH = 4, 5, 7
_SYMBOL = U64((1 << 8 * _WIDTH) - 1)
_FIRST = U64((1 << 8 * _FIRST_WIDTH) - 1)
_NAME = U64((1 << 8 * _NAME_WIDTH) - 1)
_FOLD = U64(0xC2B2AE3D27D4EB4F)
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def slices(text: bytes, k: int, size: int = CHUNK):
    """``text`` in pieces of about ``size`` bytes; a piece begins with the last ``k - 1`` words before it."""
    at, end = 0, size
    while end < len(text) and (space := _SPACE.search(text, end)):
        end = space.start()
        held = text[at:end].rsplit(None, k - 1) if k > 1 else [text[at:end]]
        if len(held) < k:  # very long words
            end += size
            continue
        yield text[at:end]
        at += len(held[0])
        end += size
    yield text[at:]


def laid_out(batch: pa.RecordBatch, k: int):
    """(row in the batch of every text, their words) for chunks of the texts or their slices."""
    rows, texts = [], []
    for row, text in enumerate(batch.column("text").to_pylist()):
        for piece in slices(text or b"", k):
            rows.append(row)
            texts.append(piece)
    for first, part in chunks(texts):
        yield np.array(rows[first : first + len(part)], np.int64), Words(part)


def suffixes(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and text number of every suffix that has ``k`` words or more."""
    n = len(words.hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    text = np.repeat(np.arange(len(words.counts)), words.counts)
    at = np.flatnonzero(text[:n] == text[k - 1 :])
    return at, text[at]


def first_range(k: int) -> int:
    return max(1, k - LAST)


def range_symbols(words: Words, at: np.ndarray, k: int) -> np.ndarray:
    """One symbol for the first range of each suffix."""
    total = words.hashes[at]
    for j in range(1, first_range(k)):
        total = total * _FOLD + words.hashes[at + j]
    return mix(total + U64(k))


def symbols(words: Words, at: np.ndarray, k: int) -> np.ndarray:
    """A row for the first range and one for each word after it, up to ``k`` words."""
    rest = [words.hashes[at + j] for j in range(first_range(k), k)]
    return np.stack([range_symbols(words, at, k), *rest]) & _SYMBOL


def names(rows: np.ndarray) -> np.ndarray:
    """One 56-bit name for the symbols of each window; it is only looked up in one document."""
    total = rows[0]
    for row in rows[1:]:
        total = mix(total * _FOLD + row)
    return total & _NAME


def prefix_hashes(words: Words, at: np.ndarray, most: int, size: int) -> np.ndarray:
    """Hash of the first words of each suffix, up to ``size`` bytes or ``most`` words."""
    sizes = words.ends - words.starts
    total, held = words.hashes[at], sizes[at]
    open_ = np.flatnonzero(held < size)
    for j in range(1, most):
        if not len(open_):
            break
        next_ = at[open_] + j
        total[open_] = total[open_] * _FOLD + words.hashes[next_]
        held[open_] += sizes[next_]
        open_ = open_[held[open_] < size]
    return mix(total)


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> U64(64 - SLOT_BITS)).astype(np.int64)


def frequent_prefixes(docs: DataFrame, k: int, groups: int, group_runs: int) -> np.ndarray:
    """For each size of a prefix, a bit for each slot: do its prefixes hold much of a group?

    Two tables of 128 kB, however large the corpus.  The sample is counted by Spark, and at
    most one row a slot comes back.
    """
    share = min(1.0, SAMPLE_BYTES / (6 * groups * group_runs))

    def counted(batches):
        for batch in batches:
            for _, words in laid_out(batch, k):
                at, _ = suffixes(words, k)
                for level, size in enumerate(PREFIX_BYTES):
                    slots, n = np.unique(_slot(prefix_hashes(words, at, first_range(k), size)), return_counts=True)
                    columns = [pa.array(np.full(len(n), level), pa.int32()), pa.array(slots), pa.array(n, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, ["level", "slot", "n"])

    rows = docs.where(F.rand(11) < share).select(utf8().alias("text"))
    found = (
        rows.mapInArrow(lean(counted), "level int, slot long, n long").groupBy("level", "slot").agg(F.sum("n").alias("n"))
        .where(F.col("n") > share * group_runs / 8).select("level", "slot").toPandas()
    )
    bits = np.zeros((len(PREFIX_BYTES), 1 << SLOT_BITS), bool)
    bits[found["level"].to_numpy(np.int64), found["slot"].to_numpy(np.int64)] = True
    return np.packbits(bits, axis=1)


def groups_of(words: Words, at: np.ndarray, k: int, groups: int, frequent: np.ndarray) -> np.ndarray:
    """Group of each suffix by its prefix, which is longer where it is frequent."""
    bits = np.unpackbits(frequent, axis=1).view(bool)
    out = np.empty(len(at), U64)
    left = np.arange(len(at))
    for size, often in zip(PREFIX_BYTES, bits):
        out[left] = prefix_hashes(words, at[left], first_range(k), size)
        left = left[often[_slot(out[left])]]
    out[left] = range_symbols(words, at[left], k)
    return (out & U64(groups - 1)).astype(np.int64)


def settled(names_: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of equal names: the places of one of the smallest owner, of one of each other owner,
    and which of the first have such others.
    """
    order = np.lexsort((owners, names_))
    n, o = names_[order], owners[order]
    new = np.ones(len(n), bool)
    new[1:] = n[1:] != n[:-1]
    fresh = new.copy()
    fresh[1:] |= o[1:] != o[:-1]
    at = np.cumsum(new) - 1
    other = fresh & (o != o[new][at])
    some = np.zeros(int(new.sum()), bool)
    some[at[other]] = True
    return order[new], order[other], some


def _first_ranges(k: int, groups: int, frequent: np.ndarray):
    """Blobs of first ranges; groups from ``groups`` on hold those that are shared in a chunk."""

    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            for rows, words in laid_out(batch, k):
                at, text = suffixes(words, k)
                owners = ids[rows[text]]
                prints = range_symbols(words, at, k)
                first, other, some = settled(prints, owners)
                place = np.concatenate([first, other, first[some]])
                group = np.full(len(place), groups + int(rows[0] + ids[0]) % groups)
                group[: len(first)] = groups_of(words, at[first], k, groups, frequent)
                order = np.argsort(owners[place], kind="stable")
                place = place[order]
                yield blobs(group[order], owners[place], prints[place], _FIRST_WIDTH, True)

    return run


def _replies(owners: np.ndarray, prints: np.ndarray, name: str, width: int) -> pa.Table:
    """(doc_id, its distinct prints of ``width`` bytes)."""
    order = np.lexsort((prints, owners))
    owners, prints = owners[order], prints[order]
    fresh = np.ones(len(owners), bool)
    fresh[1:] = (owners[1:] != owners[:-1]) | (prints[1:] != prints[:-1])
    owners, prints = owners[fresh], prints[fresh]
    at = np.flatnonzero(np.concatenate(([True], owners[1:] != owners[:-1]))) if len(owners) else np.empty(0, int)
    narrow = np.ascontiguousarray(prints.view(np.uint8).reshape(-1, 8)[:, :width]).view(f"V{width}").ravel()
    found = _ragged(narrow, np.append(at, len(owners)))
    return pa.Table.from_arrays([pa.array(owners[at], pa.int64()), found], ["doc_id", name])


def told(replies: list[bytes], width: int) -> np.ndarray:
    """The distinct prints of a document's replies, in order."""
    narrow = np.frombuffer(b"".join(replies), np.uint8).reshape(-1, width)
    wide = np.zeros((len(narrow), 8), np.uint8)
    wide[:, :width] = narrow
    return np.unique(wide.view(U64).ravel())


def _not_told_apart(groups: int):
    def run(table: pa.Table) -> pa.Table:
        """Of a group, the suffixes whose first range another document has."""
        held = {c: table.column(c).to_pylist() for c in ("owners", "counts", "prints")}
        owners, prints = runs_of_group(held, _FIRST_WIDTH, True)
        if table.column("grp")[0].as_py() < groups:
            order = np.argsort(prints)
            owners, prints = owners[order], prints[order]
            nodes = np.flatnonzero(np.concatenate(([True], prints[1:] != prints[:-1])))
            several = np.minimum.reduceat(owners, nodes) != np.maximum.reduceat(owners, nodes)
            shared = np.repeat(several, np.diff(np.append(nodes, len(owners))))
            owners, prints = owners[shared], prints[shared]
        return _replies(owners, prints, "shared", _FIRST_WIDTH)

    return run


def _windows(k: int, groups: int, frequent: np.ndarray):
    """Blobs of the symbols of suffixes that share their first range; groups from ``groups``
    on hold the names of windows that stand in a smaller document of the chunk.
    """

    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            shared = batch.column("shared").to_pylist()
            for rows, words in laid_out(batch, k):
                at, text = suffixes(words, k)
                first = range_symbols(words, at, k) & _FIRST
                keep = np.zeros(len(at), bool)
                edge = np.searchsorted(text, np.arange(len(rows) + 1))
                for row, s, e in zip(rows, edge, edge[1:]):
                    if s < e and shared[row]:
                        keep[s:e] = is_in(first[s:e], told(shared[row], _FIRST_WIDTH))
                at, owners = at[keep], ids[rows[text[keep]]].astype(np.int64)
                found = symbols(words, at, k)
                name = names(found)
                place, other, _ = settled(name, owners)
                place = place[np.argsort(owners[place], kind="stable")]
                other = other[np.argsort(owners[other], kind="stable")]
                group = groups_of(words, at[place], k, groups, frequent)
                yield blobs(group, owners[place], found[:, place], _WIDTH, True)
                group = np.full(len(other), groups + int(rows[0] + (owners[0] if len(owners) else 0)) % groups)
                yield blobs(group, owners[other], name[other], _NAME_WIDTH, True)

    return run


def suffix_order(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of suffixes by their symbols, and how many symbols each shares with the one before."""
    order = np.lexsort(rows[::-1])
    depth = np.zeros(len(order), np.int8)
    same = np.ones(max(0, len(order) - 1), bool)
    for row in rows:
        row = row[order]
        same &= row[1:] == row[:-1]
        depth[1:] += same
    return order, depth


def deep_nodes(depth: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """First leaf and end of the internal nodes of a tree that are ``least`` symbols deep or more
    and have no such node above them.  ``depth`` is that of :func:`suffix_order`.
    """
    joined = np.concatenate((depth >= least, [False]))
    starts = np.flatnonzero(~joined[:-1] & joined[1:])
    ends = np.flatnonzero(joined[:-1] & ~joined[1:]) + 1
    return starts, ends


def _repeats(k: int, groups: int):
    height = k - first_range(k) + 1

    def run(table: pa.Table) -> pa.Table:
        """Of a group, (doc_id, names) of the windows that a smaller document has."""
        owners = owners_of_group({c: table.column(c).to_pylist() for c in ("owners", "counts")}, True)
        prints = table.column("prints").to_pylist()
        if table.column("grp")[0].as_py() >= groups:
            return _replies(owners, np.concatenate([unpack(p, _NAME_WIDTH) for p in prints]), "marks", _NAME_WIDTH)
        rows = np.concatenate([unpack(p, _WIDTH).reshape(height, -1) for p in prints], axis=1)
        del prints, table
        order, depth = suffix_order(rows)
        starts, ends = deep_nodes(depth, height)
        sizes = ends - starts
        first = np.cumsum(sizes) - sizes
        leaves = order[np.repeat(starts - first, sizes) + np.arange(sizes.sum())]
        below = owners[leaves]
        if len(starts):
            leaves = leaves[below > np.repeat(np.minimum.reduceat(below, first), sizes)]
        return _replies(owners[leaves], names(rows[:, leaves]), "marks", _NAME_WIDTH)

    return run


def merged(starts: np.ndarray, k: int) -> np.ndarray:
    """First word and end of every maximal run of words in windows of ``k`` at ``starts``, which rise."""
    if not len(starts):
        return np.empty((0, 2), np.int64)
    new = np.flatnonzero(np.diff(starts) > k) + 1
    return np.stack([starts[np.append(0, new)], starts[np.append(new - 1, len(starts) - 1)] + k], axis=1)


def without(text: bytes, spans: np.ndarray) -> tuple[bytes, int]:
    """The words of ``text`` outside ``spans`` joined by one space, and how many words it has."""
    out, n = [], 0
    for piece in slices(text, 1):
        words = piece.split()
        here = spans[(spans[:, 1] > n) & (spans[:, 0] < n + len(words))] - n
        n += len(words)
        for s, e in here[::-1].tolist():
            del words[max(0, s) : e]
        if words:
            out.append(b" ".join(words))
    return b" ".join(out), n


def _cut(k: int, whole: bool):
    """Words counted, cut and hashed; texts that change or, if ``whole``, all texts."""

    def run(batches):
        for batch in batches:
            marks = batch.column("marks").to_pylist()
            texts = [t or b"" for t in batch.column("text").to_pylist()]
            starts: dict[int, list] = {}
            begun: dict[int, int] = {}
            marked = [t if m else b"" for t, m in zip(texts, marks)]
            for rows, words in laid_out(pa.RecordBatch.from_arrays([pa.array(marked, pa.binary())], ["text"]), k):
                at, text = suffixes(words, k)
                name = names(symbols(words, at, k))
                edge = np.searchsorted(text, np.arange(len(rows) + 1))
                for i, row in enumerate(rows.tolist()):
                    if not marks[row]:
                        continue
                    s, e = edge[i], edge[i + 1]
                    found = at[s:e][is_in(name[s:e], told(marks[row], _NAME_WIDTH))]
                    before = begun.get(row, 0)
                    starts.setdefault(row, []).append(found - words.first[i] + before)
                    begun[row] = before + int(words.counts[i]) - k + 1
            out: list[list] = [[] for _ in range(5)]
            for row, text in enumerate(texts):
                spans = merged(np.concatenate(starts[row]) if row in starts else np.empty(0, np.int64), k)
                removed = int((spans[:, 1] - spans[:, 0]).sum())
                kept, n = without(text, spans)
                out[0].append(n)
                out[1].append(removed)
                out[2].append(kept if removed else text if whole else None)
                out[3].append(hashlib.sha256(kept).hexdigest())
                out[4].append(spans.tolist())
            span = pa.list_(pa.list_(pa.int64()))
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.string(), span]
            made = ["n_words", "n_removed", "_kept", "kept_sha256", "spans"]
            held = [c for c in batch.schema.names if c not in ("text", "marks")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in held), *(pa.array(o, t) for o, t in zip(out, kinds))], [*held, *made]
            )

    return run


def cut_repeats(
    docs: DataFrame, k: int = WINDOW, group_runs: int = GROUP_RUNS, whole: bool = False, columns: tuple[str, ...] = (),
) -> DataFrame:
    """Rows (doc_id, n_words, n_removed, kept_sha256, kept, spans) for ``docs(doc_id, text)``.

    Words are runs of bytes other than ASCII white space.  A word is removed if a window
    of ``k`` words around it also starts in a document of smaller id.  ``kept`` are the
    words left, joined by one space; where nothing goes it is null or, if ``whole``, the
    text as it is.  ``spans`` are the first word and end of each maximal repeat removed.  A null text has no
    words.  A row without an id is no smaller document to any and stays whole; rows with
    one id count as one document.  No rows give no rows; other columns are left out,
    but for ``columns``, which come first in the result.
    """
    spark = docs.sparkSession
    tune(spark)
    others = [F.struct(*columns).alias("_others")] if columns else []
    docs = docs.select(*others, F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    groups = group_count(docs, group_runs)
    frequent = frequent_prefixes(docs, k, groups, group_runs)
    held = ["_others"] if columns else []
    made = "doc_id long, n_words long, n_removed long, _kept binary, kept_sha256 string, spans array<array<long>>"
    out = T.StructType([*(docs.schema[c] for c in held), *T.StructType.fromDDL(made)])
    named = docs.where("doc_id IS NOT NULL").select("doc_id", utf8().alias("text"))
    shared = (
        named.mapInArrow(lean(_first_ranges(k, groups, frequent)), BLOBS)
        .groupBy("grp").applyInArrow(lean_group(_not_told_apart(groups)), "doc_id long, shared binary")
        .groupBy("doc_id").agg(F.collect_list("shared").alias("shared"))
    )
    # Both joins have the same left side, so texts are dealt by document once.
    rows = docs.select(*held, "doc_id", utf8().alias("text"))
    marks = (
        rows.join(shared, "doc_id", "left").select(*held, "doc_id", "text", "shared")
        .mapInArrow(lean(_windows(k, groups, frequent)), BLOBS)
        .groupBy("grp").applyInArrow(lean_group(_repeats(k, groups)), "doc_id long, marks binary")
        .groupBy("doc_id").agg(F.collect_list("marks").alias("marks"))
    )
    cut = rows.join(marks, "doc_id", "left").select(*held, "doc_id", "text", "marks").mapInArrow(lean(_cut(k, whole)), out)
    found = ["doc_id", "n_words", "n_removed", "kept_sha256", F.col("_kept").cast("string").alias("kept"), "spans"]
    return cut.select(*(F.col(f"_others.`{c}`") for c in columns), *found)


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the texts that are left; ``n_chars``, if there is one, is counted anew.

    All rows and columns stay.  A text in which nothing repeats is unchanged; one of which
    nothing is left is empty; a null text is empty.
    """
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text", "n_chars"))
    cut = cut_repeats(docs, whole=True, columns=others)
    # By place, as a column of ``others`` may be named like one of the result's.
    place = {c: F.col(f"_{i}") for i, c in reversed(list(enumerate([*others, *cut.columns[len(others):]])))}
    text = F.col(f"_{cut.columns.index('kept', len(others))}")
    new = {"doc_id": F.col(f"_{len(others)}"), "text": text, "n_chars": F.length(text).cast("long")}
    return cut.toDF(*[f"_{i}" for i in range(len(cut.columns))]).select(*[
        (place[c] if c in others else new[c]).alias(c) for c in docs.columns
    ])
