"""Spelling variants against brute force."""

import collections
import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import brute, data
from tidepool.llm import queries, spelling


def near(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants(counts: dict[str, int], ratio: int = 10) -> list[tuple]:
    found = collections.defaultdict(list)
    for a, b in itertools.combinations(counts, 2):
        if near(a, b):
            found[a].append(b)
            found[b].append(a)
    form = {}
    for w in counts:
        best = min(found[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(found[w]), counts[form[w]] if form[w] is not None else None))
    return sorted(out)


def _words(seed: int, n: int) -> dict[str, int]:
    rng = random.Random(seed)
    letters = "eeeaaainrstéÿ日\U0001f600"
    out = {}
    while len(out) < n:
        w = "".join(rng.choice(letters) for _ in range(rng.randint(1, 7)))
        for _ in range(rng.randint(1, 4)):
            out[w] = rng.choice((1, 2, 3, 30, 400, 5000))
            at = rng.randrange(len(w) + 1)
            w = rng.choice((w[:at] + rng.choice(letters) + w[at:], w[:at] + w[at + 1 :], w[:at] + rng.choice(letters) + w[at + 1 :])) or "e"
    return out


def _frame(spark, counts):
    return spark.createDataFrame([(w, n, "x", 1) for w, n in counts], "word string, n bigint, form string, node int")


@pytest.mark.parametrize("node_words", [spelling.NODE_WORDS, 3])
def test_variants_against_brute_force(spark, node_words):
    counts = _words(3, 700)
    counts |= {"e" * 300: 5, "e" * 299 + "a": 60, "e" * 299: 2, "e" * 301: 800, "a" * 80: 4, "a" * 40 + "b" + "a" * 40: 40}
    docs = _frame(spark, list(counts.items())).repartition(5)
    assert sorted(map(tuple, spelling.spelling_variants(docs, node_words=node_words).collect())) == variants(counts)
    rows = sorted(map(tuple, spelling.spelling_variants(docs, ratio=3, node_words=node_words).collect()))
    assert rows == variants(counts, 3) and len({r[2] for r in rows if r[1] not in (None, r[2])}) > 5  # forms of forms


def test_variants_of_repeated_and_none(spark):
    docs = _frame(spark, [("plane", 3), ("plane", 40), ("planes", 4), (None, 5), ("", 6), ("p", 1)])
    want = [("p", None, "p", 1, 0, None), ("plane", None, "plane", 43, 1, None), ("planes", "plane", "plane", 4, 1, 43)]
    assert sorted(map(tuple, spelling.spelling_variants(docs).collect())) == want
    assert spelling.spelling_variants(docs.limit(0)).count() == 0


def test_crowded_leaf():
    rng = random.Random(4)
    letters = list("aaaaacccccgggggttttt")
    words = {"".join(rng.sample(letters, len(letters))) for _ in range(150)}
    words |= {w[:7] + w[8] + w[7] + w[9:] for w in words} | {w[:-1] for w in words} | {w + "a" for w in words}
    words = sorted(words)
    own = spelling.spelled(pa.array(words))
    counts = spelling.group_counts(own)
    got = sorted((int(a), int(b)) for i, j in spelling.near_pairs(own, counts, own, spelling.Trie(counts)) for a, b in zip(i, j, strict=True))
    assert got == [(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if near(a, b)]


def test_visits_reach_every_near_word():
    words = list(_words(9, 600))
    counts = spelling.group_counts(spelling.spelled(pa.array(words)))[:, np.argsort(-np.arange(spelling.GROUPS))]
    large = np.unique(np.concatenate([spelling._node_keys(counts[::2, :d]) for d in spelling.DEPTHS[:-1]]))
    home, row, node = spelling.visits(counts, large)
    seen = set(zip(row.tolist(), node.tolist(), strict=True))
    for i, j in itertools.combinations(range(len(words)), 2):
        if near(words[i], words[j]) and home[i] != home[j]:
            assert ((i, home[j]) in seen) != ((j, home[i]) in seen)


def test_query_against_brute_force(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    extra = spark.createDataFrame(data.rows([*data.awkward(), None, "×÷Þßàáâ " * 3], 10**6), data.SCHEMA).select(docs.columns)
    docs.unionByName(extra).write.parquet(f"{tmp_path}/documents.parquet")
    counts = collections.Counter()
    import re

    for r in docs.unionByName(extra).collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""):
            run = run.translate(brute.LOWER)
            h = zlib.crc32(f"{r.doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= 2}
    got = sorted(map(tuple, queries.op13_spelling(spark, str(tmp_path)).collect()))
    keys = collections.defaultdict(set)
    for w in counts:
        keys[w, -1].add(w)
        for i in range(len(w)):
            keys[w[:i] + w[i + 1 :], i].add(w)
            keys[w[:i] + w[i + 1 :], -1].add(w)
    groups = {frozenset(x for x in g) for g in keys.values() if len(g) > 1}
    found = collections.defaultdict(set)
    for g in groups:
        for a, b in itertools.combinations(g, 2):
            if near(a, b):
                found[a].add(b)
                found[b].add(a)
    assert [r[0] for r in got] == sorted(counts)
    for word, form, _, n, n_near, form_n in got:
        best = min(found[word], key=lambda x: (-counts[x], x), default=None)
        best = best if best is not None and counts[best] >= 10 * n else None
        assert (n, n_near, form, form_n) == (counts[word], len(found[word]), best, counts.get(best))
