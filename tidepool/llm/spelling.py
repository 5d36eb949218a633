"""Spelling variants: words one edit apart, found in a trie of letter-group counts.

Code points are dealt into ``GROUPS`` groups (each of a-z has its own). A word is the vector of its
counts per group, and the trie arranges words by successive counts, the most varied group first. One
inserted, deleted or replaced code point raises at most one count by one and lowers at most one by one.
So a depth-first search from a word's own path follows, at each level, the child of its own count and,
while the surplus and the deficit of one each are unspent, those of one more and one less. The words of
the leaves it reaches are verified letter by letter.

The trie is cut into subtrees of at most ``NODE_WORDS`` words where counts allow: a node with more is
split at the next of ``DEPTHS``. Every word lives in one subtree and visits those that its budget can
reach; of two subtrees that can reach each other only the words of the smaller key visit, so a pair is
found once. A task holds the words of one subtree at a time and lets visitors pass in blocks. Node keys
are hashes; if two nodes share one, their words are searched together, and results are the same.

A word's form is its near word of largest count, if that is at least ``ratio`` times its own; its root
is the last word that forms lead to. Counts grow along forms, so these are no cycles.

Cases: words that are NULL or empty take no part; a word that stands in several rows counts as their
sum; words of one code point can be near the empty word, which isn't there; counts beyond 255 of a group
are cut there, which keeps every bound; words that share all counts lie in one leaf, where halves of
the words are compared first if they are many; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm import hashing, storage

GROUPS = 32
#: Levels at which the trie may be cut, and words up to which a node isn't.
DEPTHS = (4, 8, 16, GROUPS)
NODE_WORDS = 1 << 14
#: Search states, visitors and candidate pairs worked on at a time; word pairs of two leaves that are simply compared.
_STATES, _VISITORS, _PAIRS, _CROWDED = 1 << 19, 1 << 15, 1 << 17, 1 << 12
#: Longer words are compared one by one.
_WIDTH = 64


class Spelled(NamedTuple):
    """Words as code points one after another, with the bounds of each."""

    points: np.ndarray
    bounds: np.ndarray

    @property
    def lengths(self) -> np.ndarray:
        return np.diff(self.bounds)


def spelled(words: pa.Array) -> Spelled:
    text = "".join(words.to_pylist())
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return Spelled(points, np.concatenate([[0], np.cumsum(pc.utf8_length(words).to_numpy(zero_copy_only=False))]).astype(np.int64))


def group_counts(words: Spelled) -> np.ndarray:
    """Count of each group, at most 255, in a row per word."""
    letter = (words.points >= 97) & (words.points < 123)
    group = np.where(letter, words.points.astype(np.int64) - 97, 26 + words.points.astype(np.int64) % (GROUPS - 26))
    n = len(words.bounds) - 1
    of = np.repeat(np.arange(n), words.lengths)
    return np.minimum(np.bincount(of * GROUPS + group, minlength=n * GROUPS), 255).reshape(n, GROUPS).astype(np.int16)


def _node_keys(prefixes: np.ndarray) -> np.ndarray:
    """Key of the node that each row of counts leads to; nodes of different depth differ, too."""
    key = np.full(len(prefixes), prefixes.shape[1], dtype=np.uint64)
    for level in range(prefixes.shape[1]):
        key = hashing.mixed(key ^ (prefixes[:, level].astype(np.uint64) + np.uint64(1)))
    return key


def _within_budget(counts: np.ndarray, depth: int, of: np.ndarray, surplus: np.ndarray, deficit: np.ndarray, first: int) -> tuple[np.ndarray, ...]:
    """Prefixes of ``depth`` levels that states reach by changing levels from ``first`` on: (state, level raised, level lowered); -1: none."""
    more = [-1, *range(first, depth)]
    up, down = (x.ravel() for x in np.meshgrid(more, more, indexing="ij"))
    sound = (up != down) | (up < 0)
    up, down = up[sound], down[sound]
    state = np.repeat(np.arange(len(of)), len(up))
    up, down = np.tile(up, len(of)), np.tile(down, len(of))
    own = counts[of[state]]
    fits = ((up < 0) | (surplus[state] < 0)) & ((down < 0) | (deficit[state] < 0))
    fits &= (down < 0) | (own[np.arange(len(state)), np.maximum(down, 0)] > 0)
    return state[fits], up[fits], down[fits]


def visits(counts: np.ndarray, large: np.ndarray, depths: tuple[int, ...] = DEPTHS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Subtree of each row of counts, and (row, subtree) for the others that its budget reaches, where they have the greater key."""
    n = len(counts)
    home = np.zeros(n, dtype=np.uint64)
    open_rows = np.arange(n)
    for depth in depths:
        key = _node_keys(counts[open_rows, :depth])
        home[open_rows] = key
        if depth == depths[-1]:
            break
        open_rows = open_rows[np.isin(key, large)]
    rows, nodes = [], []
    of, surplus, deficit, first = np.arange(n), np.full(n, -1), np.full(n, -1), 0
    for depth in depths:
        state, up, down = _within_budget(counts, depth, of, surplus, deficit, first)
        of, surplus, deficit = of[state], np.maximum(surplus[state], up), np.maximum(deficit[state], down)
        prefix = counts[of, :depth].copy()
        at = np.arange(len(of))
        for change, by in ((surplus, 1), (deficit, -1)):
            has = change >= 0
            prefix[at[has], change[has]] += by
        np.minimum(prefix, 255, out=prefix)
        key = _node_keys(prefix)
        goes_on = np.isin(key, large) if depth != depths[-1] else np.zeros(len(key), dtype=bool)
        ends = ~goes_on & (key > home[of])
        rows.append(of[ends])
        nodes.append(key[ends])
        of, surplus, deficit, first = of[goes_on], surplus[goes_on], deficit[goes_on], depth
    return home, np.concatenate(rows), np.concatenate(nodes)


class Trie:
    """Distinct rows of counts as a trie: per level the child of each node by count, shifted by one."""

    def __init__(self, counts: np.ndarray):
        order = np.lexsort(counts.T[::-1])
        rows = counts[order]
        changed = np.zeros(rows.shape, dtype=bool)
        changed[1:] = rows[1:] != rows[:-1]
        changed[:1] = True
        new = np.logical_or.accumulate(changed, axis=1)
        node = np.cumsum(new, axis=0) - 1  # of each row, at each level
        self.children: list[np.ndarray] = []
        for level in range(rows.shape[1]):
            begin = np.flatnonzero(new[:, level])
            before = node[begin, level - 1] if level else np.zeros(len(begin), dtype=np.int64)
            table = np.full((int(before.max()) + 1, int(rows[:, level].max()) + 3), -1, dtype=np.int32)
            table[before, rows[begin, level] + 1] = node[begin, level]
            self.children.append(table)
        # rows of each leaf
        self.order, self.leaf_bounds = order, np.append(np.flatnonzero(new[:, -1]), len(rows))

    def search(self, counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row of ``counts``, leaf) of all leaves within one surplus and one deficit; the deepest blocks of states come first."""
        step = max(1, _STATES // 16)
        for first in range(0, len(counts), step):
            n = min(step, len(counts) - first)
            zero = np.zeros(n, dtype=np.int32)
            stack = [(0, np.arange(first, first + n, dtype=np.int32), zero, zero.astype(np.int8))]
            while stack:
                level, row, node, spent = stack.pop()
                if level == len(self.children):
                    yield row, node
                    continue
                states = self._below(level, counts[row, level], row, node, spent)
                if not len(states[0]):
                    continue
                for a in range(0, len(states[0]), _STATES):
                    stack.append((level + 1, *(x[a : a + _STATES] for x in states)))

    def _below(self, level: int, own: np.ndarray, row: np.ndarray, node: np.ndarray, spent: np.ndarray) -> tuple[np.ndarray, ...]:
        table, found = self.children[level], []
        for by, bit in ((0, 0), (1, 1), (-1, 2)):
            free = np.ones(len(row), dtype=bool) if not bit else (spent & bit) == 0
            at = own + by + 1
            free &= at < table.shape[1]
            r, s = row[free], spent[free] | np.int8(bit)
            child = table[node[free], at[free]]
            there = child >= 0
            found.append((r[there], child[there], s[there]))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _matrix(words: Spelled, which: np.ndarray, width: int, right: bool) -> np.ndarray:
    """Code points of some words, from the left or from the right, filled up with zeros."""
    n = words.lengths[which]
    at = np.arange(width)[None, :]
    place = (words.bounds[1:][which] - 1)[:, None] - at if right else words.bounds[:-1][which][:, None] + at
    inside = at < n[:, None]
    return np.where(inside, words.points[np.where(inside, place, 0)], 0)


def one_edit_apart(a: Spelled, i: np.ndarray, b: Spelled, j: np.ndarray) -> np.ndarray:
    """Which pairs of words (i-th of ``a``, j-th of ``b``) differ by exactly one inserted, deleted or replaced code point."""
    m, n = a.lengths[i], b.lengths[j]
    longest = np.maximum(m, n)
    out = np.zeros(len(i), dtype=bool)
    close = np.abs(m - n) <= 1
    short = np.flatnonzero(close & (longest <= _WIDTH))
    for first in range(0, len(short), _PAIRS):
        at = short[first : first + _PAIRS]
        width = int(longest[at].max())
        shared = []
        for right in (False, True):
            differ = _matrix(a, i[at], width, right) != _matrix(b, j[at], width, right)
            shared.append(np.where(differ.any(axis=1), differ.argmax(axis=1), longest[at]))
        same = (shared[0] >= longest[at]) & (m[at] == n[at])
        out[at] = ~same & (shared[0] + shared[1] >= longest[at] - 1)
    for p in np.flatnonzero(close & (longest > _WIDTH)):
        x, y = a.points[a.bounds[i[p]] : a.bounds[i[p] + 1]], b.points[b.bounds[j[p]] : b.bounds[j[p] + 1]]
        least = min(len(x), len(y))
        left = np.append(np.flatnonzero(x[:least] != y[:least]), least)[0]
        end = np.append(np.flatnonzero(x[::-1][:least] != y[::-1][:least]), least)[0]
        out[p] = not (len(x) == len(y) and left == least) and left + end >= max(len(x), len(y)) - 1
    return out


def _by_halves(a: Spelled, i: np.ndarray, b: Spelled, j: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of two crowded leaves that share their first or last half, as one edit leaves one of them alone."""
    half = int(min(a.lengths[i].min(), b.lengths[j].min())) // 2
    for right in (False, True):
        by_half: dict[bytes, list[int]] = {}
        for w in j.tolist():
            at = b.bounds[w + 1] - half if right else b.bounds[w]
            by_half.setdefault(b.points[at : at + half].tobytes(), []).append(w)
        for w in i.tolist():
            at = a.bounds[w + 1] - half if right else a.bounds[w]
            near = np.array(by_half.get(a.points[at : at + half].tobytes(), []), dtype=np.int64)
            if not right:
                yield np.full(len(near), w), near
                continue
            # those that share the first half came before
            first = a.points[a.bounds[w] : a.bounds[w] + half]
            fresh = [x for x in near.tolist() if (b.points[b.bounds[x] : b.bounds[x] + half] != first).any()]
            yield np.full(len(fresh), w), np.array(fresh, dtype=np.int64)


def near_pairs(queries: Spelled, counts: np.ndarray, words: Spelled, trie: Trie) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, word) of all pairs one edit apart; ``trie`` is that of the words."""
    own = Trie(counts)  # queries of equal counts search once
    vectors = counts[own.order[own.leaf_bounds[:-1]]]
    for row, leaf in trie.search(vectors):
        n_own, n_words = np.diff(own.leaf_bounds)[row], np.diff(trie.leaf_bounds)[leaf]
        crowded = n_own * n_words > _CROWDED
        for r, x in zip(row[crowded].tolist(), leaf[crowded].tolist(), strict=True):
            i, j = own.order[own.leaf_bounds[r] : own.leaf_bounds[r + 1]], trie.order[trie.leaf_bounds[x] : trie.leaf_bounds[x + 1]]
            for some_i, some_j in _by_halves(queries, i, words, j):
                near = one_edit_apart(queries, some_i, words, some_j)
                yield some_i[near], some_j[near]
        row, leaf, sizes = row[~crowded], leaf[~crowded], (n_own * n_words)[~crowded]
        ends = np.cumsum(sizes)
        first = 0
        while first < len(row):
            last = max(first + 1, int(np.searchsorted(ends, ends[first] - sizes[first] + _PAIRS, side="right")))
            part = slice(first, last)
            n = sizes[part]
            which = np.repeat(np.arange(len(n)), n)
            number = np.arange(len(which)) - np.repeat(ends[part] - n - (ends[first] - sizes[first]), n)
            per = n_words[~crowded][part][which]
            i = own.order[own.leaf_bounds[row[part]][which] + number // per]
            j = trie.order[trie.leaf_bounds[leaf[part]][which] + number % per]
            near = one_edit_apart(queries, i, words, j)
            yield i[near], j[near]
            first = last


def _levels(words: DataFrame) -> np.ndarray:
    """Groups in order of how much their counts vary, the most varied first."""

    def measured(batches):
        for batch in batches:
            counts = group_counts(spelled(batch.column(0))).astype(np.int64)
            columns = [np.arange(GROUPS), np.full(GROUPS, len(counts)), counts.sum(axis=0), (counts * counts).sum(axis=0)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["level", "n", "total", "squares"])

    sums = words.select("word").mapInArrow(measured, "level bigint, n bigint, total bigint, squares bigint").groupBy("level")
    spread = np.zeros(GROUPS)
    for r in sums.agg(*(F.sum(c).alias(c) for c in ("n", "total", "squares"))).collect():
        spread[r.level] = r.squares / r.n - (r.total / r.n) ** 2
    return np.argsort(-spread, kind="stable")


def _large_nodes(words: DataFrame, levels: np.ndarray, most: int) -> np.ndarray:
    """Keys of nodes with more than ``most`` words; for each cut but the last fewer than words / most."""

    def keyed(batches):
        for batch in batches:
            counts = group_counts(spelled(batch.column(0)))[:, levels]
            for depth in DEPTHS[:-1]:
                key, n = np.unique(_node_keys(counts[:, :depth]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n, pa.int64())], names=["node", "n"])

    nodes = words.select("word").mapInArrow(keyed, "node bigint, n bigint").groupBy("node").agg(F.sum("n").alias("n"))
    large = nodes.where(F.col("n") > most).select("node").toArrow()
    return large.column("node").to_numpy().view(np.uint64)


def _dealt(held):
    def deal(batches):
        levels, large = held.value
        for batch in batches:
            for first in range(0, batch.num_rows, 2048):
                part = batch.slice(first, 2048)
                home, row, node = visits(group_counts(spelled(part.column(0)))[:, levels], large)
                at = pa.array(np.concatenate([np.arange(len(home)), row]))
                role = pa.array(np.repeat(np.array([0, 1], dtype=np.int8), [len(home), len(row)]))
                keys = pa.array(np.concatenate([home, node]).view(np.int64))
                yield pa.RecordBatch.from_arrays([keys, role, part.column(0).take(at), part.column(1).take(at)], names=["node", "role", "word", "n"])

    return deal


def _runs(batches) -> Iterator[tuple[tuple[int, int], pa.RecordBatch]]:
    """Runs of one node and role, cut at batch borders."""
    for batch in batches:
        if batch.num_rows:
            keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1)], axis=1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                yield (int(keys[a, 0]), int(keys[a, 1])), batch.slice(a, b - a)


class _Home:
    """The words of one subtree."""

    def __init__(self, parts: list[pa.RecordBatch], levels: np.ndarray):
        table = pa.Table.from_batches(parts).combine_chunks()
        self.words, self.n = (table.column(c).chunk(0) for c in ("word", "n"))
        self.spelled = spelled(self.words)
        self.counts = group_counts(self.spelled)[:, levels]
        self.trie = Trie(self.counts)

    def inner(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for i, j in near_pairs(self.spelled, self.counts, self.spelled, self.trie):
            yield i[i < j], j[i < j]


def _search(held):
    def rows(a: pa.Array, n_a: pa.Array, i: np.ndarray, b: pa.Array, n_b: pa.Array, j: np.ndarray) -> pa.RecordBatch:
        i, j = pa.array(i), pa.array(j)
        return pa.RecordBatch.from_arrays([a.take(i), n_a.take(i), b.take(j), n_b.take(j)], names=["a", "n_a", "b", "n_b"])

    def inner(home: _Home):
        for i, j in home.inner():
            yield rows(home.words, home.n, i, home.words, home.n, j)

    def search(batches):
        levels, _ = held.value
        node, waiting, home = None, [], None
        for (key, role), part in _runs(batches):
            if key != node:
                if waiting:
                    yield from inner(_Home(waiting, levels))
                node, waiting, home = key, [], None
            if role == 0:
                waiting.append(part)
                continue
            if waiting:  # the words that live there came first
                home, waiting = _Home(waiting, levels), []
                yield from inner(home)
            for first in range(0, part.num_rows if home is not None else 0, _VISITORS):
                block = part.slice(first, _VISITORS)
                own = spelled(block.column(2))
                for i, j in near_pairs(own, group_counts(own)[:, levels], home.spelled, home.trie):
                    yield rows(block.column(2), block.column(3), i, home.words, home.n, j)
        if waiting:
            yield from inner(_Home(waiting, levels))

    return search


def near_words(words: DataFrame, node_words: int = NODE_WORDS) -> DataFrame:
    """(a, n_a, b, n_b): each pair of the distinct words (word, n) that are one edit apart, once."""
    spark, levels = words.sparkSession, _levels(words)
    held = spark.sparkContext.broadcast((levels, _large_nodes(words, levels, node_words)))
    dealt = words.select("word", "n").mapInArrow(_dealt(held), "node bigint, role tinyint, word string, n bigint")
    placed = dealt.repartition("node").sortWithinPartitions("node", "role")
    pairs = storage.written(placed.mapInArrow(_search(held), "a string, n_a bigint, b string, n_b bigint"), "near-words")
    held.destroy()
    return pairs


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form; each round doubles the steps that are followed."""
    roots = storage.written(forms.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = storage.written(roots.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if step.where("moved").isEmpty():
            return roots
        roots = step.select("word", "root")


def spelling_variants(words: DataFrame, ratio: int = 10, word: str = "word", n: str = "n", node_words: int = NODE_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every distinct word of (word, n)."""
    counted = words.where(F.col(word) != "").groupBy(F.col(word).alias("word")).agg(F.sum(n).cast("bigint").alias("n"))
    known = storage.written(counted, "words")
    side = lambda w, of, times: F.struct(F.col(w).alias("word"), (-F.col(times)).alias("less"), F.col(of).alias("near"))
    both = near_words(known, node_words).select(F.explode(F.array(side("a", "b", "n_b"), side("b", "a", "n_a"))).alias("x")).select("x.*")
    # least of (-n, word): the largest count, then the first word in the order of code points
    near = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct("less", "near")).alias("top"))
    large = -F.col("top.less") >= ratio * F.col("n")
    forms = known.join(near, "word", "left").select(
        "word",
        F.when(large, F.col("top.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(large, -F.col("top.less")).alias("form_n"),
    )
    forms = storage.written(forms, "forms")
    return forms.join(_roots(forms), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


LETTERS = r"A-Za-z\u00C0-\u00FF"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def letter_runs(docs: DataFrame, least: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, run): every run of at least ``least`` letters, A-Z as a-z."""
    runs = F.regexp_extract_all(F.translate(F.col(text).cast("string"), _UPPER, _LOWER), F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0))
    return docs.select(F.col(doc_id).alias("doc_id"), F.explode(runs).alias("run"))
