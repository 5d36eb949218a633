"""N-gram Jaccard join on count vectors in R-trees.

A document is the set of its distinct ``k``-word shingles. Shingles are hashed into ``GROUPS`` groups,
and the counts by group are a point. The overlap of two sets is at most the sum of the smaller counts
over the groups, and that of two boxes of points at most the sum of the smaller upper corners. A tree
packs points into leaves and boxes into boxes, and is walked with itself from the top; pairs that this
bound leaves are verified on the sets themselves.

One tree over all points would compare nearly all documents of a size: a box over a few random points
is about as large as the space. The forest is therefore split by content. A linked pair differs in few
shingles, so if shingles are dealt into M finer groups, with M in proportion to the size, some group
holds the same shingles in both. Each document goes to the trees named by the contents of such groups:
all M of them if M is at most ``KEYS``, else the first ``KEYS`` (each is equal in a linked pair with
probability 0.38 or more, so a pair shares none with probability below 1e-9). Documents with very
few shingles also go to the trees of empty groups, where full ones may not suffice.

Equal sets are one node from the start. Each tree first asks for its least node only. Where all nodes
of a tree are then in one component, no other pair can change the result; all other trees are joined
with themselves, passing over boxes and pairs within a component. First, in every fourth tree, each
point asks only for its best partner by bound, as long as that finds links, so that a group of copies
grows together in a few rounds of few pairs; then all pairs that are left in all trees are verified. Trees with many points are cut into blocks,
and pairs of blocks are dealt out. Verification streams the texts of a node's partners past its set, at
most about ``PARTNERS`` per unit of work.

Cases: a NULL or blank text has no shingles, is linked with nothing and is a component of its own; with
fewer than k words the whole text is the one shingle; repeated rows and rows that share an id are
documents of their own, equal sets being linked; rows with NULL ids link others but are never a
component's id (NULL only if no row has one); other columns are ignored. Sets are told apart by a
64-bit hash of theirs, shingles by one of theirs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm import hashing, storage
from tidepool.llm.components import components
from tidepool.llm.hashing import Texts, Windows

SHINGLE_WORDS = 5
PERCENT = 80
GROUPS = 256
KEYS = 48
#: Points of a tree block, of a leaf, and partners per unit of verification.
BLOCK, LEAF, PARTNERS = 2048, 16, 64


def shingle_sets(texts: Texts, k: int) -> Windows:
    words = hashing.words_of(texts)
    return hashing.distinct_in_rows(hashing.window_hashes(hashing.word_hashes(texts, words, lower=True), words.bounds, k, short=True))


def differing(n: np.ndarray, percent: int) -> np.ndarray:
    """Most shingles in which a set of ``n`` can differ from a linked one."""
    # |x| + |y| - 2 |both| <= (|x| + |y|) (100 - p) / (100 + p), and |y| <= |x| 100 / p
    return (n + n * 100 // percent) * (100 - percent) // (100 + percent)


def _levels(n: np.ndarray, percent: int) -> np.ndarray:
    """log2 of the fine groups: as many as keep the expected differences per group at 0.88 or less."""
    per_group = 0.88 / ((100 - percent) / (100 + percent) * (1 + 100 / percent))
    return np.ceil(np.log2(np.maximum(n / per_group, 1))).astype(np.int64)


def set_nodes(sets: Windows) -> np.ndarray:
    """64-bit hash of each set, 0 for empty ones."""
    mixed = hashing.mixed(sets.hashes ^ np.uint64(0xA0761D6478BD642F))
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(mixed)])
    n = np.diff(sets.bounds)
    return np.where(n > 0, hashing.mixed(sums[sets.bounds[1:]] - sums[sets.bounds[:-1]] + n.astype(np.uint64)), np.uint64(0))


def tree_keys(sets: Windows, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of the trees that each set goes to."""
    n = np.diff(sets.bounds)
    own, lower = _levels(n, percent), _levels(-(-n * percent // 100), percent)
    of = np.repeat(np.arange(len(n)), n)
    inner = hashing.mixed(sets.hashes ^ np.uint64(0xE7037ED1A0B428DB))
    rows, keys = [], []
    for second in (False, True):  # a pair meets at the level of its smaller set
        takes = (n > 0) & ((own != lower) if second else True)
        level = lower if second else own
        groups = (np.int64(1) << level).astype(np.int64)
        used = np.where(takes, np.minimum(groups, KEYS), 0)
        base = np.concatenate([[0], np.cumsum(used)])
        group = (inner & (groups[of] - 1).astype(np.uint64)).astype(np.int64)
        keep = takes[of] & (group < used[of])
        slot = base[of[keep]] + group[keep]
        content, full = np.zeros(base[-1], dtype=np.uint64), np.zeros(base[-1], dtype=bool)
        np.add.at(content, slot, hashing.mixed(sets.hashes[keep] + np.uint64(0x8EBC6AF09C88C6E3)))
        full[slot] = True
        row = np.repeat(np.arange(len(n)), used)
        empty = used - np.bincount(row[full], minlength=len(n))
        # few enough full groups that a linked pair may agree in empty ones only
        also = (groups <= KEYS) & (empty >= groups - differing(n, percent))
        emit = full | also[row]
        number = np.arange(base[-1]) - base[row]
        name = hashing.mixed((level[row] << 32 | number).astype(np.uint64)) ^ content
        rows.append(row[emit])
        keys.append(hashing.mixed(name[emit]))
    return np.concatenate(rows), np.concatenate(keys)


def _point_column(counts: np.ndarray) -> pa.Array:
    offsets = np.arange(len(counts) + 1, dtype=np.int32) * GROUPS * 4
    return pa.BinaryArray.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(counts))])


def _point_array(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<i4").reshape(-1, GROUPS)


def _points(batches, k: int, percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for texts in hashing.text_slices(batch.column(1)):
            sets = shingle_sets(texts, k)
            n, nodes = np.diff(sets.bounds), set_nodes(sets)
            row = np.repeat(np.arange(texts.rows), n)
            group = (sets.hashes >> np.uint64(64 - int(math.log2(GROUPS)))).astype(np.int64)
            counts = np.bincount(row * GROUPS + group, minlength=texts.rows * GROUPS).astype("<i4")
            of, keys = tree_keys(sets, percent)
            order = np.argsort(of, kind="stable")
            ends = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=texts.rows))])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys[order].view(np.int64)))
            points = _point_column(counts.reshape(-1, GROUPS))
            columns = [batch.column(0).slice(texts.first, texts.rows), pa.array(nodes.view(np.int64), mask=n == 0), pa.array(n), points, lists]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "node", "n", "counts", "keys"])


def _bounded(pairs: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that the summed minima of their counts leave."""
    of_a = points.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("counts").alias("c_a"))
    of_b = points.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("counts").alias("c_b"))

    def check(batches):
        for batch in batches:
            n = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            most = np.minimum(_point_array(batch.column(4)), _point_array(batch.column(5))).sum(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(most * (100 + percent) >= n * percent))

    return pairs.join(of_a, "a").join(of_b, "b").select("a", "b", "n_a", "n_b", "c_a", "c_b").mapInArrow(check, "a bigint, b bigint")


def _verified(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs whose sets are similar; ``texts`` is (node, text)."""
    degree = pairs.groupBy("a").agg(F.ceil(F.count("*") / PARTNERS).cast("bigint").alias("parts"))
    dealt = pairs.join(degree, "a").withColumn("part", F.pmod(F.xxhash64("b"), "parts"))
    first = dealt.select("a", "part", F.lit(0).alias("role"), F.col("a").alias("node")).distinct()
    needed = first.unionByName(dealt.select("a", "part", F.lit(1).alias("role"), F.col("b").alias("node")))
    rows = needed.join(texts, "node").repartition("a", "part").sortWithinPartitions("a", "part", "role")

    def check(batches):
        lead, own = None, None
        for batch in batches:
            heads, roles = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            nodes, hits = batch.column(2).to_numpy(), []
            for texts in hashing.text_slices(batch.column(3)):
                sets = shingle_sets(texts, k)
                for r in range(texts.rows):
                    at, values = texts.first + r, sets.hashes[sets.bounds[r] : sets.bounds[r + 1]]
                    if roles[at] == 0:
                        lead, own = heads[at], values
                        continue
                    if lead != heads[at]:
                        raise ValueError("a node came before the one it is compared with")
                    shared = len(np.intersect1d(own, values, assume_unique=True))
                    if shared * (100 + percent) >= (len(own) + len(values)) * percent:
                        hits.append(at)
            yield pa.RecordBatch.from_arrays([pa.array(heads[hits]), pa.array(nodes[hits])], names=["a", "b"])

    return rows.select("a", "role", "node", "text").mapInArrow(check, "a bigint, b bigint")


class Boxes(NamedTuple):
    """Upper corner, least and greatest size, and the label (-1: several) of each box of a level."""

    corner: np.ndarray
    least: np.ndarray
    most: np.ndarray
    label: np.ndarray

    def packed(self) -> Boxes:
        """The level above: a box around each run of LEAF boxes."""
        starts = np.arange(0, len(self.least), LEAF)
        low, high = np.minimum.reduceat(self.label, starts), np.maximum.reduceat(self.label, starts)
        label = np.where((low == high) & (low >= 0), low, -1)
        return Boxes(np.maximum.reduceat(self.corner, starts, axis=0), np.minimum.reduceat(self.least, starts), np.maximum.reduceat(self.most, starts), label)

    def near(self, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
        """Which pairs of boxes may hold a linked pair of points with different labels."""
        near = (self.most[j] * 100 >= self.least[i] * percent) & (self.most[i] * 100 >= self.least[j] * percent)
        near &= (self.label[i] < 0) | (self.label[j] < 0) | (self.label[i] != self.label[j])
        for a in range(0, len(i), 4096):
            at = np.flatnonzero(near[a : a + 4096]) + a
            overlap = np.minimum(self.corner[i[at]], self.corner[j[at]]).sum(axis=1, dtype=np.int64)
            near[at] = overlap * (100 + percent) >= (self.least[i[at]] + self.least[j[at]]) * percent
        return near


def tree_levels(counts: np.ndarray, sizes: np.ndarray, labels: np.ndarray) -> list[Boxes]:
    """Levels of the tree, leaves first; the last has at most LEAF boxes."""
    levels = [Boxes(counts, sizes, sizes, labels).packed()]
    while len(levels[-1].least) > LEAF:
        levels.append(levels[-1].packed())
    return levels


def near_leaves(levels: list[Boxes], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of leaves (the first not behind the second, in order) that the tree, walked with itself from the top, leaves."""
    i, j = np.triu_indices(len(levels[-1].least))
    for depth in range(len(levels) - 1, -1, -1):
        near = levels[depth].near(i, j, percent)
        i, j = i[near], j[near]
        if depth:
            within = np.arange(LEAF)
            below = len(levels[depth - 1].least)
            i, j = (np.repeat(i, LEAF * LEAF) * LEAF + np.tile(np.repeat(within, LEAF), len(i)), np.repeat(j, LEAF * LEAF) * LEAF + np.tile(within, LEAF * len(j)))
            there = (i <= j) & (i < below) & (j < below)
            i, j = i[there], j[there]
    order = np.lexsort((j, i))
    return i[order], j[order]


def packed_order(counts: np.ndarray, sizes: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Sort-tile order of points: by component and size, then in tiles by the coordinates that vary most."""
    order = np.lexsort((sizes, labels))
    axes = np.argsort(-counts.var(axis=0))[:3]
    out = []
    for a in range(0, len(order), LEAF * LEAF):
        tile = order[a : a + LEAF * LEAF]
        out.append(tile[np.lexsort([counts[tile, x] for x in axes[::-1]])])
    return np.concatenate(out) if out else order


def tree_join(counts: np.ndarray, sizes: np.ndarray, labels: np.ndarray, sides: np.ndarray, percent: int, best_only: bool = False) -> np.ndarray:
    """Index pairs of points with different labels that the bounds leave: boxes first, then points.

    ``sides`` is 0 for points to be joined with all and with each other, or 1 and 2 for points to be
    joined across. ``best_only`` leaves to each point the pair with the highest bound for its size.
    """
    if not len(sizes):
        return np.zeros((0, 2), dtype=np.int64)
    order = packed_order(counts, sizes, labels)
    counts, sizes, labels, sides = counts[order], sizes[order].astype(np.int64), labels[order], sides[order]
    found: list[np.ndarray] = []
    best, partner = np.zeros(len(sizes)), np.full(len(sizes), -1)
    if len(sizes) <= LEAF:  # most trees are one leaf
        first = second = np.zeros(1, dtype=np.int64)
    else:
        first, second = near_leaves(tree_levels(counts, sizes, labels), percent)
    begins = np.flatnonzero(np.diff(first, prepend=-1))
    for begin, end in zip(begins, np.append(begins[1:], len(first))[: len(begins)], strict=True):
        i = int(first[begin])
        mine = np.arange(i * LEAF, min((i + 1) * LEAF, len(sizes)))
        others = (second[begin:end, None] * LEAF + np.arange(LEAF)[None]).ravel()
        others = others[others < len(sizes)]
        for a in range(0, len(others), 512):
            other = others[a : a + 512]
            bound = np.minimum(counts[mine][:, None], counts[other][None]).sum(axis=2, dtype=np.int64)
            total = sizes[mine][:, None] + sizes[other][None]
            ok = (bound * (100 + percent) >= total * percent) & (labels[mine][:, None] != labels[other][None])
            ok &= (sides[mine][:, None] != sides[other][None]) | (sides[mine][:, None] == 0)
            ok &= mine[:, None] < other[None]
            if not best_only:
                x, y = np.nonzero(ok)
                found.append(np.stack([mine[x], other[y]], axis=1))
            elif ok.any():
                share = np.where(ok, bound / total, 0)
                for own, theirs, along in ((mine, other, 1), (other, mine, 0)):
                    top = share.max(axis=along)
                    better = top > best[own]
                    best[own[better]], partner[own[better]] = top[better], theirs[share.argmax(axis=along)[better]]
    if best_only:
        own = np.flatnonzero(partner >= 0)
        found = [np.unique(np.sort(np.stack([own, partner[own]], axis=1), axis=1), axis=0)]
    return order[np.concatenate(found)] if found else np.zeros((0, 2), dtype=np.int64)


def _join_trees(batches, percent: int, best_only: bool) -> Iterator[pa.RecordBatch]:
    """Rows sorted by tree and pair of blocks; one such unit is held at a time."""

    def joined(table: pa.Table) -> pa.RecordBatch:
        nodes, first, second, own = (table.column(c).to_numpy() for c in ("node", "first", "second", "block"))
        counts = _point_array(table.column("counts").combine_chunks())
        sides = np.where(first == second, 0, np.where(own == first, 1, 2))
        pairs = tree_join(counts, table.column("n").to_numpy(), table.column("root").to_numpy(), sides, percent, best_only)
        return pa.RecordBatch.from_arrays([pa.array(nodes[pairs].min(axis=1)), pa.array(nodes[pairs].max(axis=1))], names=["a", "b"])

    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        unit = np.stack([batch.column(c).to_numpy() for c in ("key", "first", "second")], axis=1)
        borders = [0, *(np.flatnonzero((unit[1:] != unit[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
        for a, b in zip(borders[:-1], borders[1:], strict=True):
            if last is not None and tuple(unit[a]) != last:
                yield joined(pa.Table.from_batches(held))
                held = []
            held.append(batch.slice(a, b - a))
            last = tuple(unit[a])
    if held:
        yield joined(pa.Table.from_batches(held))


def _across(members: DataFrame, points: DataFrame, roots: DataFrame, percent: int, best_only: bool) -> DataFrame:
    """Pairs (a, b) of different components that share a tree and that the bounds leave."""
    rooted = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = (
        rooted.groupBy("key")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("size"))
        .where(F.col("low") != F.col("high"))
        .select("key", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    )
    rows = rooted.join(mixed, "key").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    # a block meets itself and every other one once
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = rows.withColumn("other", other).select(
        "key", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"), "block", "node", "root"
    )
    rows = rows.join(points, "node").select("key", "first", "second", "block", "node", "root", "n", "counts")
    units = rows.repartition("key", "first", "second").sortWithinPartitions("key", "first", "second")
    return units.mapInArrow(lambda batches: _join_trees(batches, percent, best_only), "a bigint, b bigint").distinct()


def similar_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row; component_id is the least id reachable by links."""
    of_id = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = f"doc_id {of_id}, node bigint, n bigint, counts binary, keys array<bigint>"
    every = storage.written(rows.mapInArrow(lambda batches: _points(batches, k, percent), schema), "points")
    dealt = every.select("node", F.explode("keys").alias("key"))
    shared = dealt.groupBy("key").agg(F.min("node").alias("lead"), F.max("node").alias("last")).where(F.col("lead") != F.col("last"))
    members = storage.written(dealt.join(shared.select("key", "lead"), "key").distinct(), "tree-members")
    candidates = members.select("node").distinct()
    # one row per node; which of equal sets speaks for a node doesn't matter
    sizes = every.select("node", "n", "counts").join(candidates, "node", "left_semi").dropDuplicates(["node"])
    points = storage.written(sizes, "tree-points")
    speakers = every.where(F.col("node").isNotNull()).groupBy("node").agg(F.min("doc_id").alias("doc_id")).join(candidates, "node", "left_semi")
    named = rows.join(speakers, "doc_id").transform(lambda df: _of_their_node(df, k))
    # sets that only rows without an id have are found by their texts; an id would not tell these rows apart
    nameless = _with_node(rows.where(F.col("doc_id").isNull()), k).join(speakers.where(F.col("doc_id").isNull()).select("node"), "node", "left_semi")
    texts = storage.written(named.unionByName(nameless.dropDuplicates(["node"])), "candidate-texts")

    asked = members.where(F.col("node") != F.col("lead")).select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct()
    links = storage.written(_verified(_bounded(asked, points, percent), texts, k, percent), "links")
    roots = components(links, "a", "b")
    best_only = True
    while True:
        trees = members.select("key", "node")
        if best_only:  # a pair shares many trees; the last round looks into all
            trees = trees.where(F.pmod("key", F.lit(4)) == 0)
        asked = storage.written(_across(trees, points, roots, percent, best_only), "pairs")
        more = storage.written(_verified(asked, texts, k, percent), "more-links")
        grows = bool(more.head(1))
        if grows:
            # the components so far, as stars, and what the round adds
            stars = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
            roots = components(stars.unionByName(more), "a", "b")
        if not best_only:
            break
        best_only = grows
    rooted = every.select("doc_id", "n", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.where(F.col("root").isNotNull()).groupBy("root").agg(F.min("doc_id").alias("least"))
    return rooted.join(least, "root", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))


def _of_their_node(rows: DataFrame, k: int) -> DataFrame:
    """(node, text) of rows whose text has the set that ``node`` names; ids may repeat."""

    def match(batches):
        for batch in batches:
            nodes = batch.column(1).to_numpy()
            keep = np.zeros(batch.num_rows, dtype=bool)
            for texts in hashing.text_slices(batch.column(0)):
                part = slice(texts.first, texts.first + texts.rows)
                keep[part] = set_nodes(shingle_sets(texts, k)).view(np.int64) == nodes[part]
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(0)], names=["node", "text"]).filter(pa.array(keep))

    return rows.select("text", "node").mapInArrow(match, "node bigint, text string")


def _with_node(rows: DataFrame, k: int) -> DataFrame:
    """(node, text) of all rows."""

    def nodes(batches):
        for batch in batches:
            for texts in hashing.text_slices(batch.column(0)):
                node = set_nodes(shingle_sets(texts, k)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(node), batch.column(0).slice(texts.first, texts.rows)], names=["node", "text"])

    return rows.select("text").mapInArrow(nodes, "node bigint, text string")
