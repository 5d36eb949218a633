"""Decontamination and the similarity join."""

import pickle
import random
import time

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tests.llm import brute, data
from tidepool.llm import components, decontamination, similarity, storage


def _frame(spark, texts, first=0):
    return spark.createDataFrame(data.rows(texts, first), data.SCHEMA)


def _items(spark, texts):
    return spark.createDataFrame([(100 + i, t, "z") for i, t in enumerate(texts)], "item_id bigint, text string, doc_id string")


def test_leaks_against_brute_force(spark):
    rng = random.Random(3)
    items = [data.prose(50 + i, n) for i, n in enumerate((1, 2, 3, 4, 5, 6, 8, 12, 20, 33, 50, 90, 130))] + [None, "", "one"]
    texts = data.awkward()
    for i, item in enumerate(items[:13]):
        words = item.split(" ")
        texts.append(data.prose(200 + i, 700) + " " + item + "\t" + data.prose(300 + i, 900))
        for share in (0.1, 0.25):  # some shingles spoiled, on both sides of the threshold
            spoiled = [(w[:1].upper() + w[1:] if w[:1].isascii() else w) if rng.random() > share / 3 else "spoiled" for w in words]
            texts.append(data.prose(400 + i, 200) + " " + " ".join(spoiled) + " " + data.prose(500 + i, 50))
    for block_bytes in (4 << 20, 200):
        got = decontamination.contaminated_pairs(_frame(spark, texts), _items(spark, items), block_bytes=block_bytes).collect()
        want = brute.leaks(list(enumerate(texts)), [(100 + i, t) for i, t in enumerate(items)])
        assert sorted((r.doc_id, r.item_id, r.n_shingles, r.n_shared) for r in got) == sorted(want)
        assert len(want) > 15
    kept = decontamination.decontaminated(_frame(spark, texts), _items(spark, items))
    assert kept.columns == _frame(spark, texts).columns
    assert {r.doc_id for r in kept.collect()} == set(range(len(texts))) - {d for d, *_ in want}


def test_leaks_of_repeated_rows_and_empty_tables(spark):
    docs = spark.createDataFrame([(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "A b c d e f"), (1, "A b c d e f"), (None, "q")], "item_id bigint, text string")
    got = decontamination.contaminated_pairs(docs, items).collect()
    assert sorted((r.doc_id is None, r.item_id) for r in got) == [(False, 1)] * 4 + [(True, 1)] * 2
    assert decontamination.contaminated_pairs(docs.limit(0), items).count() == 0
    assert decontamination.contaminated_pairs(docs, items.limit(0)).count() == 0
    assert decontamination.decontaminated(docs, items.limit(0)).count() == 3


def test_similar_documents_against_brute_force(spark):
    rng = random.Random(8)
    texts = data.awkward()
    for i, n in enumerate((4, 6, 7, 9, 12, 16, 24, 40, 75, 150, 300, 900)):
        base = data.prose(700 + i, n).split(" ")
        for edits in (0, 0, 1, 1, 2, 3, 5, 9):
            words = list(base)
            for _ in range(edits):
                at = rng.randrange(len(words))
                words[at : at + 1] = rng.choice([["new"], [], ["two", "words"]])
            texts.append(" ".join(words))
    for k, percent in ((5, 80), (4, 85), (2, 50)):
        got = {r.doc_id: r for r in similarity.similar_documents(_frame(spark, texts), k=k, percent=percent).collect()}
        want = brute.similar(texts, k, percent)
        assert len(got) == len(texts)
        assert [got[i].component_id for i in range(len(texts))] == want
        assert [got[i].n_shingles for i in range(len(texts))] == [len(brute.shingles(t, k)) for t in texts]


def test_similar_documents_odd_ids(spark):
    base = data.prose(1, 60)
    rows = [(5, base), (5, base), (5, "other text of its own entirely"), (None, base), (2, base + " more"), (None, None), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(((r.doc_id or 0, r.component_id, r.n_shingles) for r in similarity.similar_documents(docs).collect()), key=str)
    assert got == sorted([(5, 2, 56), (5, 2, 56), (5, 5, 2), (0, 2, 56), (2, 2, 57), (0, None, 0), (9, 9, 0)], key=str)
    assert similarity.similar_documents(docs.limit(0)).count() == 0


def test_a_row_without_id_links_named_ones(spark):
    base = data.prose(1, 60).split(" ")
    left, middle, right = base[:52], base[:56], base[:60]
    left[0], right[-1] = "left", "right"
    texts = [" ".join(w) for w in (left, right, middle)]
    assert brute.similar(texts[:2], 5, 88) == [0, 1] and brute.similar(texts, 5, 88) == [0, 0, 0]
    rows = [(7, texts[0]), (4, texts[1]), (None, texts[2]), (None, texts[2].replace(" ", "  ")), (None, None), (None, data.prose(2, 60))]
    got = similarity.similar_documents(spark.createDataFrame(rows, "doc_id bigint, text string"), percent=88).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in got) == [(0, 0), (0, 0), (0, 4), (0, 4), (4, 4), (7, 4)]


def test_a_tree_cut_into_blocks_gives_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(similarity, "BLOCK", 4)
    texts = [f"{i} " + data.prose(11, 12) for i in range(12)] + [data.prose(11, 12) + f" {i}" for i in range(8)]
    got = {r.doc_id: r.component_id for r in similarity.similar_documents(_frame(spark, texts), k=2, percent=70).collect()}
    assert [got[i] for i in range(len(texts))] == brute.similar(texts, 2, 70)


def test_tree_join_is_every_pair_within_the_bound():
    rng = np.random.default_rng(4)
    counts = rng.poisson(3, (90, similarity.GROUPS))
    counts[45:] = counts[:45] + rng.integers(0, 2, (45, similarity.GROUPS))
    sizes, labels = counts.sum(axis=1), rng.integers(0, 30, 90)
    for sides in (np.zeros(90, dtype=int), rng.integers(1, 3, 90)):
        got = {tuple(sorted(p)) for p in similarity.tree_join(counts, sizes, labels, sides, 80).tolist()}
        want = set()
        for a in range(90):
            for b in range(a):
                bound = np.minimum(counts[a], counts[b]).sum()
                near = bound * 180 >= (sizes[a] + sizes[b]) * 80
                ratio = max(sizes[a], sizes[b]) * 80 <= min(sizes[a], sizes[b]) * 100
                if near and ratio and labels[a] != labels[b] and (sides[a] != sides[b] or sides[a] == 0):
                    want.add((b, a))
        assert want <= got and want
        # what is left over the size ratio is only looked at by box
        assert all(np.minimum(counts[a], counts[b]).sum() * 180 >= (sizes[a] + sizes[b]) * 80 for a, b in got)


def test_differing_shingles_bound():
    for percent in (50, 80, 85, 99):
        n = np.arange(1, 400)
        bound = similarity.differing(n, percent)
        for x in range(1, 60):
            for y in range(1, 60):
                both = -(-(x + y) * percent // (100 + percent))  # least overlap of a linked pair
                if both <= min(x, y):
                    assert x + y - 2 * both <= max(bound[x - 1], bound[y - 1]) if x != y else x + y - 2 * both <= bound[x - 1]
                    assert x + y - 2 * both <= bound[min(x, y) - 1]


def test_components_of_a_long_chain(spark):
    order = list(range(200))
    random.Random(1).shuffle(order)
    links = [(order[i], order[i + 1]) for i in range(120)] + [(order[i], order[199]) for i in range(130, 160)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a bigint, b bigint"), "a", "b").collect()}
    first, second = set(order[:121]), {*order[130:160], order[199]}
    assert got == {x: min(first) for x in first} | {x: min(second) for x in second}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint"), "a", "b").count() == 0


def test_leaks_of_a_low_percentage(spark):
    items = [data.prose(70 + i, n) for i, n in enumerate((40, 90, 130))]
    words = [t.split(" ") for t in items]
    texts = [data.prose(80 + i, 500) + " " + " ".join(w[: len(w) // 4]) + " " + data.prose(90 + i, 500) for i, w in enumerate(words)]
    got = decontamination.contaminated_pairs(_frame(spark, texts), _items(spark, items), percent=15).collect()
    want = brute.leaks(list(enumerate(texts)), [(100 + i, t) for i, t in enumerate(items)], percent=15)
    assert sorted((r.doc_id, r.item_id, r.n_shingles, r.n_shared) for r in got) == sorted(want) and len(want) >= 3
    assert decontamination._minima(128, 15, 1e-6) > 256  # as many as the bound asks for


def test_minima_cover_the_worst_passage():
    for width in (1, 2, 4, 8, 16, 32, 64, 128):
        assert 1 <= decontamination._minima(width, 80, 1e-6) <= 128
    assert pa.array([1]).type == pa.int64()


def test_written_tables_leave_no_shuffle_files(spark):
    def left():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {str(files.apply(i).getName()) for i in range(files.size()) if str(files.apply(i).getName()).startswith("shuffle_")}

    before = left()
    got = storage.written(spark.range(1000).repartition(5).groupBy((F.col("id") % 10).alias("k")).count(), "counted")
    deadline = time.time() + 20  # files go in the background
    while left() - before and time.time() < deadline:
        time.sleep(0.2)
    assert not left() - before
    assert got.count() == 10 and spark.conf.get(storage.CLEANUP) == "false"


def test_filters_are_not_sent_with_a_block(spark):
    texts = [" ".join(f"w{i * j}" for j in range(n)) for i, n in enumerate((3, 9, 40, 200), 1)]
    block = decontamination.index_items(pa.array(range(4)), pa.array(texts), decontamination.SHINGLE_WORDS, decontamination.PERCENT, decontamination.MISS)
    sent = pickle.dumps(block)
    assert len(sent) < sum(s.seen.nbytes for c in block.classes for s in c.signatures) / 20
    for mine, theirs in zip(block.classes, pickle.loads(sent).classes, strict=True):
        assert all(np.array_equal(a, b) for s, t in zip(mine.signatures, theirs.signatures, strict=True) for a, b in zip(s, t, strict=True))
