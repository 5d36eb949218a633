"""URL lists, neighbours, the pipeline, and queries against their SQL."""

import glob
import os
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from check_oracle import canonical
from tests.llm import brute, data
from tidepool.llm import bpe, neighbours, quality, queries, url_lists, wordpieces

# URL lists


def _entries(spark, rows):
    return spark.createDataFrame(rows, "list string, effect string, kind string, value string, at bigint, action string")


def _evaluate(spark, captures, entries):
    docs = spark.createDataFrame([(i, u, t, "c") for i, (u, t) in enumerate(captures)], "id int, url string, fetched_at bigint, rule_ string")
    return [(r.blocked, r.rule, list(r.lists)) for r in url_lists.evaluated(docs, _entries(spark, entries)).orderBy("id").collect()]


def test_entries_count_as_of_the_fetch_time(spark):
    entries = [
        ("bad", "block", "host", "x.org", 10, "add"),
        ("bad", "block", "host", "x.org", 20, "remove"),
        ("bad", "block", "host", "x.org", 30, "add"),
        ("bad", "block", "host", "x.org", 30, "add"),
        ("bad", "block", "host", "x.org", 15, "add"),
        ("ok", "allow", "prefix", "a.x.org/good", 5, "add"),
        ("worse", "block", "prefix", "a.x.org/good/bad", 40, "add"),
        ("worse", "block", "host", "y.org", 40, "remove"),
        ("worse", "block", "host", "y.org", 40, "add"),
        (None, "block", "host", "y.org", 1, "add"),
        ("odd", "other", "host", "y.org", 1, "add"),
        ("odd", "block", "host", "y.org", None, "add"),
    ]
    captures = [(f"http://a.X.org:80/{p}", t) for p in ("z", "good/w?q#f", "good/bad/x") for t in (9, 10, 19, 20, 29, 30, 40)]
    got = dict(zip(captures, _evaluate(spark, captures, entries), strict=True))
    for (url, t), (blocked, rule, lists) in got.items():
        listed = 10 <= t < 20 or t >= 30
        good, bad = "/good" in url, "/good/bad" in url and t >= 40
        assert blocked == (bad or (listed and not good))
        assert rule == ("a.x.org/good/bad" if bad else "a.x.org/good" if good else "x.org" if listed else None)
        assert lists == sorted(["bad"] * listed + ["ok"] * good + ["worse"] * bad)
    assert _evaluate(spark, [("http://y.org/", 50), (None, 50), ("http://x.org", None), ("no url", 50), ("", 50)], entries) == [(False, None, [])] * 5


def test_url_lists_of_empty_and_repeated(spark):
    entries = [("bad", "block", "host", "x.org", 0, "add")]
    assert _evaluate(spark, [("http://x.org", 1)] * 3, entries) == [(True, "x.org", ["bad"])] * 3
    assert _evaluate(spark, [("http://x.org", 1)], []) == [(False, None, [])]
    assert _evaluate(spark, [], entries) == []
    long = "http://" + "a." * 60 + "x.org/" + "p/" * 500
    assert _evaluate(spark, [(long, 1), ("https://user@x.org./", 1)], entries) == [(True, "x.org", ["bad"])] * 2


def test_url_lists_with_clashing_names_and_a_hot_rule(spark, monkeypatch):
    monkeypatch.setattr(url_lists, "HOT_ROWS", 3)
    entries = _entries(spark, [("bad", "block", "host", "org", 10, "add"), ("ok", "allow", "host", "x3.org", 0, "add"), ("bad", "block", "host", "org", 40, "remove")])
    rows = [(i, f"http://x{i % 7}.org/{i}", i, "own", "own", "own", "own", 1, "k") for i in range(60)]
    docs = spark.createDataFrame(rows, "id int, url string, fetched_at bigint, rule string, blocked string, lists string, verdict_url string, salt int, kind string")
    got = url_lists.evaluated(docs, entries)
    got.write.format("noop").mode("overwrite").save()
    assert sorted(got.columns) == sorted(docs.columns)
    for r in got.collect():
        listed, allowed = 10 <= r.id < 40, r.id % 7 == 3
        assert (r.blocked, r.rule, r.verdict_url) == (listed and not allowed, "x3.org" if allowed else "org" if listed else None, "own")
        assert list(r.lists) == ["bad"] * listed + ["ok"] * allowed
    with pytest.raises(ValueError):
        url_lists.evaluated(docs, entries, at="rule")


# neighbours


def _brute_nearest(rows, k):
    sound = {i: np.array(v, dtype=np.float64) for i, v in rows if v is not None and None not in v and np.isfinite(v).all() and np.any(v)}
    out = []
    for q in sound:
        near = sorted((float(np.sqrt(((sound[q] - v) ** 2).sum())), i) for i, v in sound.items() if i != q and len(v) == len(sound[q]))
        out += [(q, r + 1, i, d) for r, (d, i) in enumerate(near[:k])]
    return sorted(out)


@pytest.mark.parametrize("block_bytes", [1 << 20, 9000])
def test_neighbours_are_exact(spark, block_bytes):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).round(2).tolist()) for i in range(300)] + [(300 + i, (np.ones(8) * s).tolist()) for i, s in enumerate((1e-3, 1e5, -1e5, 1, 1, 1))]
    rows += [(400, None), (401, [0.0] * 8), (402, [float("nan")] + [1.0] * 7), (403, [float("inf")] * 8), (404, [1.0, None] + [1.0] * 6), (405, [1.0, 2.0]), (406, [1.0, 5.0])]
    docs = spark.createDataFrame([(i, v, "l", 1) for i, v in rows], "vec_id bigint, embedding array<double>, id string, dim int")
    got = sorted(tuple(r) for r in neighbours.nearest(docs, docs, k=5, block_bytes=block_bytes).collect())
    want = _brute_nearest(rows, 5)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], rtol=1e-12)


def test_neighbours_of_few_repeated_and_none(spark):
    docs = spark.createDataFrame([(1, [1.0]), (2, [3.0]), (2, [3.0]), (None, [2.0])], "vec_id bigint, embedding array<float>")
    got = sorted(tuple(r) for r in neighbours.nearest(docs, docs, k=10).collect())
    assert got == [(1, 1, 2, 2.0), (1, 2, 2, 2.0), (2, 1, 1, 2.0)]  # every row is a candidate
    assert neighbours.nearest(docs.limit(0), docs).count() == 0
    assert neighbours.nearest(docs, docs.limit(0)).count() == 0


def test_neighbours_of_any_finite_size(spark):
    rows = [(0, [1e155, 1.0]), (1, [1e155 + 1e148, 1.0]), (2, [1e155, 5.0]), (3, [-1e155, 1.0]), (4, [1e-170, 0.0]), (5, [3e-170, 0.0]), (6, [1e308, -1e308]), (7, [-1e308, 1e308])]
    docs = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    exact = {i: [Fraction(x) for x in v] for i, v in rows}
    for got in (neighbours.nearest(docs, docs, k=7).collect(), neighbours.nearest(docs, docs.where("vec_id < 3"), k=2).collect()):
        for q in {r.query_id for r in got}:
            near = sorted((sum((a - b) ** 2 for a, b in zip(exact[q], exact[i], strict=True)), i) for i in exact if i != q)
            own = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
            for rank, i, score in own:
                want = near[rank - 1][0]
                assert near[rank - 1][1] == i or score in {s for _, j, s in own if j != i} or score == float("inf")
                if want < Fraction(1e300) ** 2:
                    assert abs(Fraction(score) ** 2 - want) <= want * Fraction(1, 10**12)


def test_code_bounds_hold():
    rng = np.random.default_rng(5)
    a, b = (neighbours.Codes(rng.normal(size=(40, 24)) * s) for s in (1.0, 30.0))
    dots = a.products(slice(0, 40), b, slice(0, 40)) * a.scale[:, None] * b.scale[None]
    near = np.sqrt(np.maximum(a.norm2[:, None] + b.norm2[None] - 2 * dots, 0))
    real = np.sqrt(((a.vectors[:, None] - b.vectors[None]) ** 2).sum(axis=2))
    assert (np.abs(near - real) <= a.rest[:, None] + b.rest[None] + 1e-9).all()


# pipeline


def _plain_pipeline(spark, sf_dir):
    """The stages, one document after another."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = queries.quality_model(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    good = {r.doc_id for r in quality.scored(docs, model).where("score >= 0.3").collect()}
    rows = [(r.doc_id, r.text) for r in docs.orderBy("doc_id").collect() if r.doc_id in good]
    rows = [(d, t) for d, t, n in brute.cut_lines(rows) if not n or brute.words(t)]
    root = brute.similar([t for _, t in rows], 5, 80)
    rows = [x for i, x in enumerate(rows) if root[i] == i]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    bad = {d for d, *_ in brute.leaks(rows, items)}
    library = wordpieces.tokenizer(wordpieces.tokenizer_path())
    return {d: library.encode(t or "", add_special_tokens=False).ids for d, t in rows if d not in bad}


def test_pipeline_against_plain_stages(spark, sf_dir):
    got = {r.doc_id: list(r.ids) for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert got == _plain_pipeline(spark, sf_dir)
    assert 100 < len(got) < 200


def test_stages_take_awkward_and_empty_tables(spark, sf_dir):
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    rows = data.rows(data.awkward()) + data.rows(data.awkward()) + [(None, "no id", None, None, None, "k", 1, 1, "x")]
    docs = spark.createDataFrame(rows, data.SCHEMA)
    for frame in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, sf_dir)
            assert out.count() <= frame.count()
            assert name == "tokens" or out.columns == frame.columns
    assert set(names) <= set(docs.columns)
    kept = corpus_pipeline.similarity_stage(spark, docs, sf_dir).collect()
    assert sum(r.text == "no id" for r in kept) == 1
    assert len({r.doc_id for r in kept}) == len(kept)


def test_stage_list():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "lines", "similarity", "decontamination", "tokens"]
    assert bpe.HEAD_BYTES > 0


# SQL


@pytest.mark.parametrize("name", [n for n, (_, sql) in queries.QUERIES.items() if sql])
def test_queries_against_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    query, sql = queries.QUERIES[name]
    df = query(spark, sf_dir)
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert canonical(df.columns, df.collect()) == canonical(columns, cursor.fetchall())


def test_queries_without_sql_keep_every_document(spark, sf_dir):
    n = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    got = queries.op3_similarity(spark, sf_dir).collect()
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()]
    assert [r.component_id for r in sorted(got)] == brute.similar(texts, 4, 85) and len(got) == n
    rows = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in queries.op9_repeats(spark, sf_dir).collect()}
    import hashlib

    want = [(a, b, hashlib.sha256(t.encode()).hexdigest()) for a, b, t in brute.without_repeats(texts, 35)]
    assert [rows[i] for i in range(n)] == want
    assert queries.op2_lines(spark, sf_dir).agg(F.count("*")).first()[0] == n
