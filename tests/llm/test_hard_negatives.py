"""Hard negatives against brute force."""

import random

import numpy as np
import pytest

from tidepool.llm import hard_negatives


def _brute(rows, n_positives, n_negatives, least, most, anchors):
    sound = [(i, la, [int(256 * x // 1) for x in v]) for i, la, v in rows if i is not None and la is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, label, code in {(i, la, tuple(v)) for i, la, v in sound if anchors(i)}:
        others = sorted((-sum(x * y for x, y in zip(code, v, strict=True)), i, la) for i, la, v in sound if i != a and len(v) == len(code))
        for s, p, _ in [x for x in others if x[2] == label][:n_positives]:
            inside = [(n, i) for n, i, la in others if la != label and least * -s <= 100 * -n <= most * -s]
            out += [(a, p, r + 1, i, -s, -n) for r, (n, i) in enumerate(inside[:n_negatives])]
    return sorted(out)


def _frame(spark, rows):
    return spark.createDataFrame([(i, la, v, "x", 1) for i, la, v in rows], "vec_id bigint, label int, embedding array<double>, anchor string, rank int")


@pytest.mark.parametrize("block_bytes", [1 << 20, 3000])
def test_hard_negatives_against_brute_force(spark, block_bytes):
    rng = np.random.default_rng(8)
    means = rng.normal(size=(4, 20))
    rows = [(i, i % 4, (means[i % 4] * 0.4 + rng.normal(size=20) * 0.3 + 0.2).tolist()) for i in range(600)]
    rows += [(600 + i, i % 3, rows[5][2]) for i in range(40)]  # one vector that many rows share
    rows += [(700, 1, None), (701, None, rows[0][2]), (702, 1, [None] * 20), (703, 1, [float("nan")] * 20), (704, 0, [0.0] * 20), (None, 1, rows[0][2])]
    rows += [(705, 0, [1.0, 2.0]), (706, 0, [1.0, 2.5]), (707, 1, [0.5, 1.0]), (708, 1, []), (709, 2, []), rows[9], rows[9]]
    docs = _frame(spark, rows).repartition(5)
    anchors = lambda i: i % 10 == 0 or i > 703
    got = hard_negatives.hard_negatives(docs, docs.where("vec_id % 10 = 0 OR vec_id > 703"), block_bytes=block_bytes)
    assert sorted(map(tuple, got.collect())) == _brute(rows, 5, 10, 30, 90, anchors)
    few = hard_negatives.hard_negatives(docs, docs.where("vec_id = 20"), 2, 3, 10, 99, block_bytes=block_bytes)
    assert sorted(map(tuple, few.collect())) == _brute(rows, 2, 3, 10, 99, lambda i: i == 20)


def test_hard_negatives_of_large_numbers_and_none(spark):
    rng = random.Random(2)
    rows = [(i, i % 2, [rng.choice((1, 0.9, 0.7)) * 4e6, rng.random() * 3e6, rng.random()]) for i in range(80)]
    rows += [(80 + i, i % 2, [rng.random() for _ in range(3)]) for i in range(40)]
    docs = _frame(spark, rows).coalesce(1).sortWithinPartitions("vec_id")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 16)  # large and small ones in batches of their own
    got = hard_negatives.hard_negatives(docs, docs.where("vec_id < 6 OR vec_id > 116"))
    got.count(), spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = _brute(rows, 5, 10, 30, 90, lambda i: i < 6 or i > 116)
    assert sorted(map(tuple, got.collect())) == want and max(r[4] for r in want) > 1 << 53
    assert hard_negatives.hard_negatives(docs.limit(0), docs).count() == 0
    assert hard_negatives.hard_negatives(docs, docs.limit(0)).count() == 0
    alone = _frame(spark, [(0, 1, [1.0]), (1, 2, [1.0]), (2, 1, [-1.0])])  # a positive of negative score
    assert hard_negatives.hard_negatives(alone, alone).count() == 0


def test_bounds_leave_few_candidates():
    rng = np.random.default_rng(1)
    decay = np.array([1.0] * 4 + [0.02] * 28)
    vectors = rng.normal(size=(4000, 32)) * decay
    columns = hard_negatives.Columns(np.arange(4000), np.zeros(4000, dtype=np.int64), vectors)
    anchor, looked = hard_negatives.coded(vectors[:1])[0], []

    def stays(low, high):
        keep = high >= hard_negatives._kth(low, 5)
        looked.append(int(keep.sum()))
        return keep

    at, scores = hard_negatives.vertical_scan(anchor, columns, [(0, 4000)], stays)
    exact = anchor @ columns.values
    assert looked[0] < 2000
    assert (exact[at] == scores).all() and set(np.argsort(-exact)[:5]) <= set(at)
