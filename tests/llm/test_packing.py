"""Packing: exact coverage, full windows, and neighbours by BM25."""

import collections
import math
import zlib

import numpy as np
import pytest

from tests.llm import data
from tidepool.llm import packing, queries, wordpieces

PATH = wordpieces.tokenizer_path()


def _check(pieces, want: list[list[int]], window=packing.WINDOW):
    """``pieces`` of (document, start, length, sequence, offset, ids) cover every id once, in gapless sequences."""
    covered, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for doc, start, length, sequence, offset, ids in pieces:
        assert length > 0 and ids == want[doc][start : start + length]
        covered[doc].append((start, length))
        sequences[sequence].append((offset, length))
    for doc, ids in enumerate(want):
        at = 0
        for start, length in sorted(covered[doc]):
            assert start == at
            at += length
        assert at == len(ids)
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    assert padding == 0
    return sequences


@pytest.mark.parametrize("shard_tokens", [packing.SHARD_TOKENS, 3000])
def test_every_id_lies_in_one_piece(spark, shard_tokens):
    texts = [*data.awkward(), *(data.prose(30 + i, n) for i, n in enumerate((1, 40, 700, 2500, 6000, 90, 90))), data.prose(36, 90), "7" * 9000]
    docs = spark.createDataFrame(data.rows(texts), data.SCHEMA).repartition(3)
    library = wordpieces.tokenizer(PATH)
    want = [library.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]
    rows = packing.packed(docs, PATH, shard_tokens=shard_tokens, task_tokens=20_000).collect()
    assert all(r.doc_tokens == len(want[r.doc_id]) for r in rows)
    _check([(r.doc_id, r.start, r.length, r.sequence_id, r.offset, np.frombuffer(r.ids, "<u4").tolist()) for r in rows], want)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(None, "a b"), (None, "a b"), (3, "a b"), (3, "c"), (3, None)], "doc_id bigint, text string")
    rows = packing.packed(docs, PATH).collect()
    assert sum(r.length for r in rows) == 3 + 3 + 3 + 2 + 1
    assert packing.packed(docs.limit(0), PATH).count() == 0


def _brute_scores(lists, seed, idf, mean):
    out = []
    for ids in lists:
        n = collections.Counter(ids)
        out.append(sum(idf[t] * n[t] * 2.2 / (n[t] + 1.2 * (0.25 + 0.75 * len(ids) / mean)) for t in set(lists[seed]) if n[t]))
    return out


def test_scores_and_greedy_choice():
    rng = np.random.default_rng(2)
    lists = [np.concatenate([rng.integers(0, 40, rng.integers(1, 30)), np.full(8, 40 + i % 5)]).astype(np.uint16) for i in range(60)]
    df = np.bincount([t for x in lists for t in set(x.tolist())], minlength=50)
    idf = np.log1p((60 - df + 0.5) / (df + 0.5))
    statistics = packing.Statistics(idf, float(np.mean([len(x) for x in lists])))
    index = packing.Index(lists, statistics)
    plain = [x.tolist() for x in lists]
    for seed in (0, 7, 59):
        assert np.allclose(index.scores(seed), _brute_scores(plain, seed, idf, statistics.mean_length))
    pieces = list(packing.pack(lists, statistics, window=64))
    _check([(p.doc, p.start, p.length, p.sequence, p.offset, plain[p.doc][p.start : p.start + p.length]) for p in pieces], plain, 64)
    first = [p.doc for p in pieces if p.sequence == 0]
    # the first window: the seed, then whole neighbours in order of score while they fit, then the best one cut
    ranked, free, chosen = np.argsort(-index.scores(0), kind="stable"), 64 - len(lists[0]), [0]
    while free:
        ranked = [d for d in ranked if d not in chosen]
        fits = [d for d in ranked if len(lists[d]) <= free]
        chosen.append(int(fits[0] if fits else ranked[0]))
        free -= min(free, len(lists[chosen[-1]]))
    assert first == chosen
    # neighbours share the seed's marked term more often than chance
    same = [p.doc % 5 == first_doc % 5 for s, first_doc in {p.sequence: p.doc for p in pieces if p.offset == 0}.items() for p in pieces if p.sequence == s and p.offset]
    assert np.mean(same) > 0.35


def test_windows_of_powers_of_two():
    lists = [np.arange(n, dtype=np.uint16) % 50 for n in (4096, 8195, 1, 600, 4095 * 2)]
    pieces = list(packing.pack(lists, packing.Statistics(np.ones(50), 3.0)))
    sequences = _check([(p.doc, p.start, p.length, p.sequence, p.offset, lists[p.doc][p.start : p.start + p.length].tolist()) for p in pieces], [x.tolist() for x in lists])
    total = sum(map(len, lists))
    assert len(sequences) == total // 4096 + (total % 4096).bit_count()


def test_statistics_count_every_document(spark):
    texts = data.awkward() * 3
    docs = spark.createDataFrame(data.rows(texts), data.SCHEMA).repartition(4)
    library = wordpieces.tokenizer(PATH)
    lists = [library.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]
    got = packing.statistics_of(packing.token_lists(docs, PATH), PATH)
    df = collections.Counter(t for x in lists for t in set(x))
    assert got.mean_length == pytest.approx(np.mean([len(x) for x in lists]))
    for t in (2, lists[5][0], lists[9][7], 49000):
        assert got.idf[t] == pytest.approx(math.log1p((len(lists) - df[t] + 0.5) / (df[t] + 0.5)))


def test_query(spark, sf_dir):
    rows = queries.op11_packing(spark, sf_dir).collect()
    library = wordpieces.tokenizer(PATH)
    want = {r.doc_id: library.encode(r.text or "", add_special_tokens=False).ids + [2] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(np.array(want[r.doc_id][r.start : r.start + r.length], dtype="<u4").tobytes())
    names = sorted(want)
    place = {d: i for i, d in enumerate(names)}
    _check([(place[r.doc_id], r.start, r.length, r.sequence_id, r.offset, want[r.doc_id][r.start : r.start + r.length]) for r in rows], [want[d] for d in names])
