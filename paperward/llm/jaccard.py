"""All documents whose sets of word n-grams have a Jaccard similarity of 0.75 or more.

The document by n-gram incidence matrix is multiplied with its transpose in blocks;
what keeps it sparse are bounds that follow from the sizes alone.

1. A task reads whole texts, takes each text's set of n-grams and gives equal sets one
   class, named by a 64-bit sum over the set and its size.  The incidences go, packed,
   to groups by n-gram (:mod:`grams`).
2. A group keeps the columns of two classes or more: an n-gram of one class can't add
   to any product.  It says how many classes each column has.
3. Back by class: two sets link only if they share ``need = ceil(0.75 * size)`` n-grams
   of either.  A class with fewer shared columns goes.  Of the others, in an order of
   the n-grams by rising count, two that link must share one of the first
   ``size - need + 1``; n-grams of no other class stand first in that order.
4. Along each of these columns, sizes that differ by more than 3 to 4 are cut apart; what
   stays in touch is one part of the product, found as a connected component.
5. A part is a block of rows; a large part is cut in row blocks and every pair of them
   is a task's work.  A row times the block gives its overlaps with all rows; links are
   decided exactly and come back as a forest.  Rows that are already connected needn't
   be multiplied, so a group of near copies costs little more than its rows.
6. The links' components are the answer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperward.llm.arrays import U64, Words, chunks, mix, span_sums
from paperward.llm.grams import (
    BLOBS, GROUP_RUNS, HOT_RUNS, blobs, group_count, hot_runs, is_in, runs_of_group,
)
from paperward.llm.neardup import Forest
from paperward.llm.shared import components, lean, lean_group, tune, utf8
from paperward.plans.shape import materialize
from paperward.plans.skew import attach

WORDS = 5
#: Similarity as a ratio of whole numbers, compared without rounding.
SIMILAR = (75, 100)
#: n-grams of the rows of one block.
BLOCK_GRAMS = 2_000_000
_WIDTH = 5


def text_sets(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """n-grams of all sets laid end to end, each set's offsets, each set's class.

    A text of fewer than ``k`` words has its whole word sequence as its only member.
    """
    words = Words(texts, lower=True)
    prints, owner, _ = words.windows(k)
    short = np.flatnonzero((words.counts > 0) & (words.counts < k))
    if len(short):
        whole = []
        for i in short:
            total = U64(0)
            with np.errstate(over="ignore"):
                for h in words.hashes[words.first[i] : words.first[i + 1]]:
                    total = total * U64(0x9E3779B97F4A7C15) + h
            whole.append(total + U64(words.counts[i]))
        prints = np.concatenate([prints, mix(np.array(whole, U64))])
        owner = np.concatenate([owner, short])
    order = np.argsort(prints)
    order = order[np.argsort(owner[order].astype(np.uint16 if len(texts) < 1 << 16 else np.int64), kind="stable")]
    prints, owner = prints[order], owner[order]
    new = np.ones(len(prints), bool)
    new[1:] = (prints[1:] != prints[:-1]) | (owner[1:] != owner[:-1])
    prints, owner = prints[new], owner[new]
    offsets = np.searchsorted(owner, np.arange(len(texts) + 1))
    sizes = np.diff(offsets)
    names = mix(span_sums(mix(prints ^ U64(0xA5A5A5A5)), offsets) + sizes.astype(U64))
    return prints, offsets, names.view(np.int64)


def _column_ids(prints: np.ndarray, shift: U64) -> np.ndarray:
    """The group's number above the fingerprint's low bits."""
    return (prints >> shift) << U64(8 * _WIDTH) | prints & U64((1 << 8 * _WIDTH) - 1)


def _incidences(k: int, groups: int, hot: np.ndarray):
    """Blobs of the n-grams of classes that are new in a batch, and blobs that name each text's class.

    The latter hold ids, classes and sizes in their three parts and have negative group
    numbers.  Hot n-grams go to groups beyond the others, dealt by class.
    """
    shift = U64(65 - groups.bit_length())

    def run(batches):
        for batch in batches:
            ids = batch.column("_id").to_numpy()
            for first, texts in chunks(batch.column("text").to_pylist()):
                prints, offsets, names = text_sets(texts, k)
                sizes = np.diff(offsets)
                mine = ids[first : first + len(texts)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([-1 - int(names[0].view(U64) >> shift)], pa.int32()),
                     *(pa.array([x.astype(np.int64).tobytes()], pa.binary()) for x in (mine, names, sizes))],
                    ["grp", "owners", "counts", "prints"],
                )
                once = np.zeros(len(texts), bool)
                once[np.unique(names, return_index=True)[1]] = True
                keep = np.repeat(once, sizes)
                owners, prints = np.repeat(names, sizes)[keep], prints[keep]
                common = is_in(prints, hot)
                yield blobs((prints[~common] >> shift).astype(np.int64), owners[~common], prints[~common], _WIDTH)
                to = groups + (owners[common].view(U64) >> shift).astype(np.int64)
                yield blobs(to, owners[common], prints[common], 8)

    return run


def _ragged(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary column whose rows are ``values[offsets[i]:offsets[i+1]]``."""
    at = (offsets * values.itemsize).astype(np.int32)
    data = np.ascontiguousarray(values)
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(data)])


CELLS = "doc_id long, class long, size long, cols binary, dfs binary"
_CELL_NAMES = ["doc_id", "class", "size", "cols", "dfs"]


def _shared_columns(groups: int):
    shift = U64(65 - groups.bit_length())

    def run(table: pa.Table) -> pa.Table:
        """Of a group, the columns of two classes or more, by class; named classes as they are."""
        grp = table.column("grp")[0].as_py()
        rows = {c: table.column(c).to_pylist() for c in ("owners", "counts", "prints")}
        if grp < 0:
            parts = [np.frombuffer(b"".join(rows[c]), np.int64) for c in ("owners", "counts", "prints")]
            empty = pa.nulls(len(parts[0]), pa.binary())
            return pa.Table.from_arrays([*map(pa.array, parts), empty, empty], _CELL_NAMES)
        owners, cols = runs_of_group(rows, _WIDTH if grp < groups else 8)
        if grp >= groups:
            cols = _column_ids(cols, shift)
        else:
            cols = cols | U64(grp << 8 * _WIDTH)
            order = np.argsort(cols)
            owners, cols = owners[order], cols[order]
            new = np.concatenate(([True], cols[1:] != cols[:-1], [True]))
            often = ~(new[1:] & new[:-1])
            owners, cols = owners[often], cols[often]
        order = np.lexsort((owners, cols))
        owners, cols = owners[order], cols[order]
        new = np.ones(len(cols), bool)
        new[1:] = (cols[1:] != cols[:-1]) | (owners[1:] != owners[:-1])
        owners, cols = owners[new], cols[new]
        if grp >= groups:
            dfs = np.full(len(cols), np.iinfo(np.uint32).max, np.uint32)
        else:
            starts = np.flatnonzero(np.concatenate(([True], cols[1:] != cols[:-1]))) if len(cols) else np.empty(0, int)
            size = np.diff(np.append(starts, len(cols)))
            dfs = np.repeat(size, size).astype(np.uint32)
            owners, cols, dfs = owners[dfs > 1], cols[dfs > 1], dfs[dfs > 1]
        order = np.argsort(owners, kind="stable")
        owners, cols, dfs = owners[order], cols[order], dfs[order]
        at = np.flatnonzero(np.concatenate(([True], owners[1:] != owners[:-1]))) if len(owners) else np.empty(0, int)
        offsets = np.append(at, len(owners))
        nulls = pa.nulls(len(at), pa.int64())
        return pa.Table.from_arrays(
            [nulls, pa.array(owners[at]), nulls, _ragged(cols, offsets), _ragged(dfs, offsets)], _CELL_NAMES
        )

    return run


def need(size, similar=SIMILAR):
    """Fewest n-grams that a set of this size shares with a similar one."""
    return -(-size * similar[0] // similar[1])


def _lead(similar):
    def run(batches):
        """The matrix row of each class that can link, and the leading columns in it."""
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for name, size, parts in zip(*(batch.column(c).to_pylist() for c in ("class", "size", "parts"))):
                cols = np.frombuffer(b"".join(p["cols"] for p in parts), U64)
                short = len(cols) - need(size, similar)
                if short < 0:
                    continue
                dfs = np.frombuffer(b"".join(p["dfs"] for p in parts), np.uint32)
                lead = cols[np.lexsort((cols, dfs))[: short + 1]]
                for held, x in zip(out, (name, size, cols.tobytes(), lead.tobytes())):
                    held.append(x)
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(out, kinds)], ["class", "size", "cols", "lead"]
            )

    return run


def _postings(batches):
    for batch in batches:
        lead = batch.column("lead").to_pylist()
        n = np.array([len(x) // 8 for x in lead], np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.frombuffer(b"".join(lead), np.int64)),
             pa.array(np.repeat(batch.column("class").to_numpy(), n)),
             pa.array(np.repeat(batch.column("size").to_numpy(), n))],
            ["col", "class", "size"],
        )


def block_links(sizes: np.ndarray, cols: np.ndarray, offsets: np.ndarray, similar=SIMILAR) -> list[tuple[int, int]]:
    """A spanning forest of the links among the rows of one block of the matrix.

    Each step multiplies one row with the whole block.  Rows of the largest component
    so far wait: once all others have been multiplied, every pair that could still
    connect two components has been seen.
    """
    n, found = len(sizes), []
    names, column = np.unique(cols, return_inverse=True)
    inside = np.zeros(len(names), np.int64)
    label, waiting = np.arange(n), np.ones(n, bool)
    while True:
        largest = np.bincount(label, minlength=n).argmax()
        todo = np.flatnonzero(waiting & (label != largest))
        if not len(todo):
            return found
        r = todo[0]
        waiting[r] = False
        mine = column[offsets[r] : offsets[r + 1]]
        inside[mine] = 1
        both = span_sums(inside[column], offsets)
        inside[mine] = 0
        union = sizes[r] + sizes - both
        for j in np.flatnonzero((both * similar[1] >= similar[0] * union) & (label != label[r])):
            if label[j] != label[r]:
                found.append((int(r), int(j)))
                label[label == label[j]] = label[r]


def _blocks(similar):
    def run(table: pa.Table) -> pa.Table:
        """Of all blocks in a group: links, or for a part in one block each row and its first."""
        table = table.sort_by("block")
        block, names, sizes, alone = (table.column(c).to_numpy() for c in ("block", "class", "size", "alone"))
        raws = table.column("cols").to_pylist()
        cuts = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), len(block)]
        ends: list[tuple[int, int]] = []
        whole: list[bool] = []
        for s, e in zip(cuts, cuts[1:]):
            if e - s < 2:
                continue
            offsets = np.cumsum([0, *(len(x) // 8 for x in raws[s:e])])
            cols = np.frombuffer(b"".join(raws[s:e]), U64)
            forest = block_links(sizes[s:e], cols, offsets, similar)
            if alone[s]:
                sets = Forest(e - s)
                for i, j in forest:
                    sets.join(i, j)
                forest = [(i, sets.root(i)) for i in sorted({i for link in forest for i in link})]
            ends += [(names[s + i], names[s + j]) for i, j in forest]
            whole += [bool(alone[s])] * len(forest)
        u, v = np.array(ends, np.int64).reshape(-1, 2).T
        return pa.Table.from_arrays([pa.array(u), pa.array(v), pa.array(whole, pa.bool_())], ["u", "v", "alone"])

    return run


_NO_ID = -(1 << 63)


def jaccard_classes(
    docs: DataFrame, k: int = WORDS, similar: tuple[int, int] = SIMILAR, group_runs: int = GROUP_RUNS,
    hot: int = HOT_RUNS, block_grams: int = BLOCK_GRAMS,
) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id), one for each row of ``docs(doc_id, text)``.

    Words are runs of bytes other than ASCII white space with A-Z lower-cased.  Two
    texts link when the similarity of their sets is at least ``similar[0] /
    similar[1]``; ``component_id`` is the smallest id reachable.  A null or blank text
    has no n-gram and links with nothing.  A row without an id links as any other but
    names no component; one without a linked id has a null component.  Rows with one
    id stay apart.  No rows give no rows; other columns are left out.
    """
    spark = docs.sparkSession
    tune(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    groups = group_count(docs, group_runs)
    common = hot_runs(docs, k, True, hot)
    cells = docs.select(F.coalesce("doc_id", F.lit(_NO_ID)).alias("_id"), utf8().alias("text")).mapInArrow(
        lean(_incidences(k, groups, common)), BLOBS
    )
    cells = materialize(cells.groupBy("grp").applyInArrow(lean_group(_shared_columns(groups)), CELLS))
    named = cells.where("doc_id IS NOT NULL").select(
        F.nullif("doc_id", F.lit(_NO_ID)).alias("doc_id"), "class", "size"
    )
    part = F.when(F.col("cols").isNotNull(), F.struct("cols", "dfs"))
    rows = (
        cells.where("size IS NULL OR size > 0").groupBy("class")
        .agg(F.max("size").alias("size"), F.collect_list(part).alias("parts"))
        .where(F.size("parts") > 0)
        .mapInArrow(lean(_lead(similar)), "class long, size long, cols binary, lead binary")
    )
    rows = materialize(rows)
    found = _components_of(rows, similar, block_grams)
    first = named.groupBy("class").agg(F.min("doc_id").alias("first"), F.count("*").alias("_n"))
    label = found.join(first, found["node"] == first["class"])
    label = label.groupBy("component").agg(F.min("first").alias("component_id"))
    by_class = found.join(label, "component").select(F.col("node").alias("class"), "component_id")
    component = F.coalesce("component_id", "first").alias("component_id")
    answer = materialize(first.join(by_class, "class", "left").select("class", component, "_n"))
    own = F.when(F.col("size") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return attach(named, answer, ["class"], "_n", ["doc_id"]).select(
        "doc_id", F.col("size").alias("n_shingles"), own.alias("component_id")
    )


def _components_of(rows: DataFrame, similar: tuple[int, int], block_grams: int) -> DataFrame:
    """Rows (node, component) of the classes in ``rows`` that have a link.

    A part that fits in one block is answered there; of larger ones the blocks' links
    are put together.
    """
    along = Window.partitionBy("col").orderBy("size", "class")
    near = F.coalesce(F.lag("size").over(along) * similar[1] >= F.col("size") * similar[0], F.lit(False))
    runs = rows.mapInArrow(_postings, "col long, class long, size long").withColumn("near", near)
    # every class of a run is tied to its first, so a part is a few stars deep
    start = F.last(F.when(~F.col("near"), F.col("class")), ignorenulls=True).over(along)
    touch = runs.select(start.alias("u"), F.col("class").alias("v")).where("u <> v")
    parts = components(touch.select("u", "v")).select(F.col("node").alias("class"), F.col("component").alias("part"))
    rows = materialize(rows.drop("lead").join(parts, "class"))
    grams = F.octet_length("cols") / 8
    sizes = rows.groupBy("part").agg(F.ceil(F.sum(grams) / block_grams).alias("blocks"))
    cut = rows.join(sizes, "part").withColumn("mine", F.pmod(F.xxhash64("class"), "blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("_o")
    cut = cut.select("*", other).withColumn(
        "block", F.xxhash64("part", F.least("_o", "mine"), F.greatest("_o", "mine"))
    )
    n = cut.agg(F.sum(grams)).first()[0] or 0
    group = F.pmod("block", F.lit(int(n // block_grams) + 1)).alias("_g")
    links = materialize(
        cut.select("block", "class", "size", "cols", (F.col("blocks") == 1).alias("alone"), group).groupBy("_g")
        .applyInArrow(lean_group(_blocks(similar)), "u long, v long, alone boolean")
    )
    done = links.where("alone").select(F.col("u").alias("node"), F.col("v").alias("component"))
    return done.unionByName(components(links.where("NOT alone").select("u", "v")))


def keep_one_of_each(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that stand for their group of similar texts, with all their columns.

    That is the row with the group's smallest id; of rows that agree in id and text one
    stays.  Rows without an id stay, as they can't be told from others of their group.
    """
    keys = jaccard_classes(docs, **settings).where("doc_id = component_id").select("doc_id").distinct()
    named = docs.where("doc_id IS NOT NULL").join(keys, "doc_id", "left_semi")
    return named.dropDuplicates(["doc_id", "text"]).unionByName(docs.where("doc_id IS NULL"))
