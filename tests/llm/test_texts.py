"""Operators on single documents: lines, repeats, tokens, files, quality, language."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import brute, data
from tidepool.llm import bpe, hashing, language, lines, quality, queries, repeats, similarity, storage, token_files, wordpieces

PATH = wordpieces.tokenizer_path()


def _frame(spark, texts, first=0):
    return spark.createDataFrame(data.rows(texts, first), data.SCHEMA)


def _by_id(df):
    return {r.doc_id: r for r in df.collect()}


def _library_ids(text):
    return wordpieces.tokenizer(PATH).encode(text or "", add_special_tokens=False).ids


# line dedup


def _logs():
    rng = random.Random(2)
    texts = data.awkward()
    for i in range(24):
        own = [data.prose(800 + i * 7 + j, rng.randint(1, 14)) for j in range(rng.randint(0, 4))]
        common = [f"User {i} logged in from {rng.choice(data.vocabulary(2))} at noon today sharp", "All rights reserved.", "", f"err {i}", "  All   rights reserved."]
        some = [f"Copied by {rng.choice('abc')} for use in the great hall", "never twice " + str(i) * 3 + " " + data.prose(i, 3)]
        picked = own + rng.sample(common, 3) + rng.sample(some, 1)
        rng.shuffle(picked)
        texts.append("\n".join(picked))
    return texts


@pytest.mark.parametrize("most", [1 << 20, 0])
def test_lines_against_brute_force(spark, most, monkeypatch):
    monkeypatch.setattr(lines, "BROADCAST_LEAVES", most)
    docs = _frame(spark, _logs())
    monkeypatch.setattr(lines.recurring_lines, "__defaults__", (*lines.recurring_lines.__defaults__[:-1], most))
    got = _by_id(lines.without_recurring_lines(docs))
    want = brute.cut_lines(list(enumerate(_logs())))
    assert [(d, got[d].text, got[d].n_dropped_lines) for d, _, _ in want] == want
    assert sum(n for _, _, n in want) > 40
    assert set(docs.columns) < set(lines.without_recurring_lines(docs).columns)


def test_leading_tokens_alone_make_no_template(spark):
    own = [f"Was it here {w}" for w in data.vocabulary(3)[:7]]  # texts of their own behind three shared words
    numbered = [f"See page number {n}" for n in range(7)]
    found = lines.recurring_lines(_frame(spark, own + numbered)).collect()
    assert {r.template for r in found} == {"See page number <*>"} and len(found) == 7
    kept = _by_id(lines.without_recurring_lines(_frame(spark, own + numbered)))
    assert [kept[i].text for i in range(8)] == [*own, numbered[0]] and all(kept[i].text == "" for i in range(8, 14))


def test_templates_generalise_fields(spark):
    texts = [f"User {n} logged in from {w} at noon today sharp" for n, w in enumerate(data.vocabulary(3)[:7])]
    found = lines.recurring_lines(_frame(spark, texts)).collect()
    assert {r.template for r in found} == {"User <*> logged in from <*> at noon today sharp"}
    assert [r.doc_id for r in found if r.first] == [0] and {r.docs for r in found} == {7}


def test_lines_of_repeated_rows_and_null_ids(spark):
    rows = [(None, "x y\nsame old line"), (None, "same old line"), (1, "same old line"), (1, "same old line"), (2, "same old line\nz"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = lines.without_recurring_lines(docs, min_docs=3).collect()
    assert sorted((r.doc_id or 0, "NULL" if r.text is None else r.text, r.n_dropped_lines) for r in got if r.doc_id) == [(1, "", 1), (1, "", 1), (2, "z", 1), (3, "NULL", 0)]
    assert sorted(r.n_dropped_lines for r in got if r.doc_id is None) == [0, 1]
    assert lines.without_recurring_lines(docs, min_docs=4).agg(F.sum("n_dropped_lines")).first()[0] == 0
    assert lines.without_recurring_lines(docs.limit(0)).count() == 0


# repeats


def test_repeats_against_brute_force(spark):
    rng = random.Random(9)
    texts = data.awkward()
    passages = [data.prose(900 + i, n) for i, n in enumerate((34, 35, 36, 60, 140))]
    for i in range(30):
        parts = [data.prose(1000 + i, rng.randint(0, 60)), rng.choice(passages), data.prose(1100 + i, rng.randint(0, 8)), rng.choice(passages)]
        texts.append(" ".join(parts))
    texts += ["ab " * 60, "ab " * 34, "ab " * 35, data.prose(1, 35), data.prose(1, 36), data.prose(1, 90)[3:]]
    for window, anchor in ((35, 6), (8, 6), (3, 6)):
        got = _by_id(repeats.without_repeats(_frame(spark, texts), window=window, anchor=anchor))
        want = brute.without_repeats(texts, window)
        assert [(got[i].n_words, got[i].n_removed, got[i].text) for i in range(len(texts))] == want


def test_repeats_of_odd_ids(spark):
    base = data.prose(4, 50)
    docs = spark.createDataFrame([(None, base), (7, base), (7, base), (7, "own words only"), (8, None)], "doc_id bigint, text string")
    got = sorted((r.doc_id or 0, r.n_words, r.n_removed, r.text) for r in repeats.without_repeats(docs).collect())
    assert got == [(0, 50, 50, ""), (7, 3, 0, "own words only"), (7, 50, 50, ""), (7, 50, 50, ""), (8, 0, 0, "")]
    assert repeats.without_repeats(docs.limit(0)).count() == 0


def test_pieces_sent_stay_few(spark):
    docs = _frame(spark, [data.prose(4, 80)] * 200)
    sent = docs.select("doc_id", F.hash("doc_id").alias("row_hash"), "text").coalesce(1).mapInArrow(
        lambda b: repeats._send(b, 35, 6), "key bigint, doc_id bigint, row_hash int, start int, n int, windows binary"
    )
    per_piece = sent.where("windows IS NOT NULL").groupBy("key", "start").count().agg(F.max("count")).first()[0]
    assert per_piece <= 2
    assert _by_id(repeats.without_repeats(docs))[150].n_removed == 80


def _frequent_line():
    """A line between differing words, a passage of many documents, one word over and over, and exact copies."""
    line, passage = data.prose(40, 20), data.prose(41, 50)
    texts = [f"{data.prose(2000 + i, 40)} {line} {data.prose(3000 + i, 40)}" for i in range(150)]
    texts += [f"{data.prose(4000 + i, 5)} {passage} {data.prose(5000 + i, 5)}" for i in range(50)]
    return texts + ["na " * 400, "na " * 50] + texts[:3] + data.awkward()


@pytest.mark.parametrize("partitions", [1, 7])
def test_repeats_of_crowded_anchors(spark, partitions):
    texts = _frequent_line()
    docs = _frame(spark, texts).repartition(partitions)
    want = brute.without_repeats(texts, 35)
    for most in (0, 60, repeats.ANCHOR_WINDOWS):
        got = _by_id(repeats.without_repeats(docs, most=most))
        assert [(got[i].n_words, got[i].n_removed, got[i].text) for i in range(len(texts))] == want


def test_no_key_gathers_a_crowded_anchor(spark):
    docs = _frame(spark, _frequent_line()).repartition(7)

    def largest(most):
        sent = repeats.dealt_pieces(docs, most=most).where("windows IS NOT NULL")
        return sent.groupBy("key").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0]

    assert largest(1 << 40) > 1000  # all windows of an anchor by its one key
    assert largest(60) <= 60


# tokens


@pytest.mark.parametrize("rare", ["local", "join"])
@pytest.mark.parametrize("head_bytes", [64 << 20, 3000])
def test_bpe_against_the_library(spark, head_bytes, rare):
    docs = _frame(spark, data.awkward())
    head = bpe.head_of(docs, PATH, head_bytes=head_bytes)
    got = _by_id(bpe.decoded(bpe.encoded(docs, PATH, head=head, rare=rare), PATH))
    library = wordpieces.tokenizer(PATH)
    for i, text in enumerate(data.awkward()):
        ids = _library_ids(text)
        assert list(got[i].ids) == ids
        assert got[i].decoded == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("rare", ["local", "join"])
def test_bpe_of_a_word_with_many_ids(spark, rare):
    digits = "<" + "".join(random.Random(3).choice("0123456789") for _ in range(69_999))  # the bracket keeps the word whole
    texts = [data.prose(i, 200) for i in range(20)] + [f"before {digits} after", digits]
    assert len(_library_ids(digits)) == 70_000
    docs = _frame(spark, texts)
    head = bpe.head_of(docs, PATH)
    assert head.lengths.max() == 70_000 and head.lengths.sum(dtype=np.int64) == len(head.values)
    got = _by_id(bpe.decoded(bpe.encoded(docs, PATH, head=head, rare=rare), PATH))
    library = wordpieces.tokenizer(PATH)
    for i, text in enumerate(texts):
        assert list(got[i].ids) == _library_ids(text)
        assert got[i].decoded == library.decode(_library_ids(text), skip_special_tokens=False)


def test_bpe_of_odd_ids_and_numbers(spark):
    docs = spark.createDataFrame([(None, "Some words"), (4, "Some words"), (4, "Some words"), (4, "others here"), (5, None)], "doc_id bigint, text string")
    want = [(0, "Some words"), (4, "Some words"), (4, "Some words"), (4, "others here"), (5, None)]
    for rare in ("local", "join"):
        got = sorted((r.doc_id or 0, list(r.ids)) for r in bpe.encoded(docs, PATH, rare=rare).collect())
        assert got == sorted((i, _library_ids(t)) for i, t in want)
        assert bpe.encoded(docs.limit(0), PATH, rare=rare).count() == 0
    odd = spark.createDataFrame([(1, [320, -5, 10**8, 49407]), (2, None), (3, [])], "k int, ids array<int>")
    assert [r.decoded for r in bpe.decoded(odd, PATH).orderBy("k").collect()] == ["a</w> <|endoftext|>", "", ""]


def test_words_of_random_texts_encode_like_the_whole():
    rng = random.Random(6)
    letters = "aAbB'ſİıßé́ ̈  ​.,-19²日本\U0001f600<|>\t"
    encoder = wordpieces.WordEncoder(PATH, most=50)
    import pyarrow as pa

    from tidepool.llm import hashing

    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(300)] + ["it's we'll <|endoftext|>x"]
    for part in hashing.text_slices(pa.array(texts), 500):
        ids, bounds = encoder.ids(part, hashing.words_of(part))
        for r in range(part.rows):
            assert ids[bounds[r] : bounds[r + 1]].tolist() == _library_ids(texts[part.first + r])


# token files


@pytest.mark.parametrize("layout", [token_files.Layout(), token_files.Layout(dictionary=False, row_group=4096, page=512, page_rows=10)])
def test_token_files_round_trip(spark, layout):
    texts = data.awkward()
    folder = storage.shared_folder(spark, "files")
    token_files.write_token_files(_frame(spark, texts), folder, PATH, layout, partitions=3)
    got = _by_id(token_files.read_tokens(spark, folder))
    index = _by_id(token_files.read_metadata(spark, folder))
    start = 0
    for i, text in enumerate(texts):
        want = [*_library_ids(text), 1]
        assert list(got[i].ids) == want
        assert (index[i].start, index[i].n_tokens) == (start, len(want))
        start += len(want)
    some = token_files.read_tokens(spark, folder, 4, 6)
    assert sorted(r.doc_id for r in some.collect()) == [4, 5, 6]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(doc_id), GreaterThanOrEqual(doc_id,4), LessThanOrEqual(doc_id,6)]" in plan


def test_token_file_encodings(spark):
    import glob

    import pyarrow.parquet as pq

    folder = storage.shared_folder(spark, "files")
    token_files.write_token_files(_frame(spark, data.awkward()), folder, PATH, token_files.Layout(dictionary=False), partitions=1)
    file = pq.ParquetFile(glob.glob(folder.removeprefix("file:") + "/tokens/part-*")[0])
    columns = {file.metadata.row_group(0).column(i).path_in_schema: file.metadata.row_group(0).column(i) for i in range(3)}
    assert "DELTA_BINARY_PACKED" in columns["n_tokens"].encodings
    assert "DELTA_BINARY_PACKED" in columns["ids.list.element"].encodings
    assert columns["ids.list.element"].has_offset_index and columns["doc_id"].has_column_index


def test_token_files_of_odd_ids(spark):
    docs = spark.createDataFrame([(3, "b"), (None, "n"), (3, "a"), (3, None)], "doc_id bigint, text string")
    folder = storage.shared_folder(spark, "files")
    token_files.write_token_files(docs, folder, PATH, partitions=2)
    rows = token_files.read_metadata(spark, folder).orderBy("start").collect()
    assert [(r.doc_id, r.n_tokens) for r in rows] == [(None, 2), (3, 1), (3, 2), (3, 2)]
    folder = storage.shared_folder(spark, "files")
    token_files.write_token_files(docs.limit(0), folder, PATH)
    assert token_files.read_metadata(spark, folder).count() == 0


def test_query_of_token_files(spark, sf_dir):
    got = _by_id(queries.op8_token_files(spark, sf_dir))
    start = 0
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect():
        ids = np.array([*_library_ids(r.text), 1], dtype="<u4")
        assert (got[r.doc_id].start, got[r.doc_id].n_tokens, got[r.doc_id].ids_crc32) == (start, len(ids), zlib.crc32(ids))
        start += len(ids)


def test_query_of_bpe(spark, sf_dir):
    got = _by_id(queries.op4_bpe(spark, sf_dir))
    library = wordpieces.tokenizer(PATH)
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        ids = _library_ids(r.text)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


# quality


def test_gradient_of_attention():
    rng = np.random.default_rng(0)
    model = quality.train([rng.normal(size=(n, quality.N_FEATURES)) for n in (1, 2, 3, 4)], np.array([0.0, 1, 0, 1]), 0.5, epochs=1)
    x, bounds, y = rng.normal(size=(7, quality.N_FEATURES)), np.array([0, 2, 3, 7]), np.array([1.0, 0, 1])
    weight = np.array([1.0, 2, 0.5])

    def loss(w):
        logit = quality._forward(w, x, bounds)["logit"]
        return (weight * (np.log1p(np.exp(logit)) - y * logit)).mean()

    grad = quality._gradient(model.weights, x, bounds, y, weight)
    for name, value in model.weights.items():
        at = tuple(rng.integers(0, s) for s in value.shape)
        up, down = dict(model.weights), dict(model.weights)
        step = np.zeros_like(value)
        step[at] = 1e-5
        up[name], down[name] = value + step, value - step
        assert grad[name][at] == pytest.approx((loss(up) - loss(down)) / 2e-5, rel=1e-3, abs=1e-7)


def test_quality_on_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.1"
    scores = queries.op6_quality(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").where("held_out")
    counts = scores.groupBy((F.col("predicted") == F.col("quality")).alias("right")).count().collect()
    n = {r.right: r["count"] for r in counts}
    assert n[True] / sum(n.values()) > 0.97


def test_quality_cases(spark):
    good, junk = [data.prose(i, 90) for i in range(40)], ["!!! ### " * 30 + str(i) for i in range(40)]
    docs = _frame(spark, [*good, *junk, None, "", " \n"])
    labels = spark.createDataFrame([(i, int(i < 40), None) for i in range(80)] + [(999, 1, 1), (0, None, 1), (None, 1, 1)], "doc_id bigint, quality int, text int")
    model = quality.fit(docs, labels)
    got = _by_id(quality.scored(docs, model))
    assert all(got[i].score > 0.5 for i in range(40)) and all(got[i].score < 0.3 for i in range(40, 80))
    assert [got[i].score for i in (80, 81, 82)] == [model.base] * 3 and got[80].top_passage == -1
    kept = quality.accepted(docs, model, 0.3)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {*range(40), 80, 81, 82}
    one_class = quality.fit(docs, labels.where("quality = 1"))
    assert {r.score for r in quality.scored(docs, one_class).collect()} == {1.0}
    assert {r.score for r in quality.scored(docs, quality.fit(docs, labels.limit(0))).collect()} == {0.5}
    assert quality.scored(docs.limit(0), model).count() == 0
    assert quality.scored(docs.union(docs), model).count() == 2 * docs.count()


def _plain_features(words):
    """Shares of kinds of bytes and statistics of the words of a passage."""
    raw, whole = [w.encode() for w in words], " ".join(words).encode()  # blanks between the words count as bytes
    size, n = len(whole), len(words)
    punctuation = lambda b: 33 <= b < 127 and not chr(b).isalnum()
    kinds = [lambda b: 65 <= b < 91, lambda b: 97 <= b < 123, lambda b: 48 <= b < 58, punctuation, lambda b: b >= 128, lambda b: b == 10]
    shares = [sum(map(kind, whole)) / size for kind in kinds]
    mean = sum(map(len, raw)) / n
    low = [brute.words(w, lower=True)[0] for w in words]
    return shares + [
        math.log1p(n), mean, math.sqrt(max(0.0, sum(len(w) ** 2 for w in raw) / n - mean**2)),
        sum(a == b for a, b in zip(low, low[1:])) / n, 1 - len(set(low)) / n, sum(punctuation(w[-1]) for w in raw) / n,
    ]


def test_quality_scores_against_plain_sums():
    rng = np.random.default_rng(3)
    shapes = {"encode": (quality.N_FEATURES, quality.ENCODED), "tanh": (quality.ENCODED, quality.ATTENTION), "gate": (quality.ENCODED, quality.ATTENTION),
        "attend": (quality.ATTENTION,), "out": (quality.ENCODED,), "encode_bias": (quality.ENCODED,), "out_bias": ()}
    weights = {k: rng.normal(size=shape) for k, shape in shapes.items()}
    model = quality.Model(0.4, rng.normal(size=quality.N_FEATURES) * 0.1, rng.uniform(0.5, 2, quality.N_FEATURES), weights, 0.3)
    texts = [data.prose(1, 200) + " Wow Wow. 12%", "", "one", data.prose(2, 64), "É é ab AB, ab!"]
    part = next(iter(hashing.text_slices(pa.array(texts))))
    score, n, top = quality.score_slice(model, part)
    x, bounds = quality.passages(part)
    for i, text in enumerate(texts):
        words = brute.words(text)
        cut = [words[a : a + 64] for a in range(0, len(words), 64)]
        assert n[i] == len(cut)
        if not cut:
            assert score[i] == model.base and top[i] == -1
            continue
        own = x[bounds[i] : bounds[i + 1]].astype(np.float64)
        for f, passage in zip(own, cut, strict=True):
            assert np.allclose(f[:12], _plain_features(passage), atol=1e-5)
            size = len(" ".join(passage).encode())
            assert f[12:].sum() == pytest.approx((size - 1) / size, abs=1e-5)  # every pair of neighbours is in one bin
        hidden, raw = [], []
        for f in own:
            f = (f - model.mean) / model.spread
            h = [max(0.0, sum(f[a] * weights["encode"][a][b] for a in range(len(f))) + weights["encode_bias"][b]) for b in range(quality.ENCODED)]
            gated = [math.tanh(np.dot(h, weights["tanh"][:, c])) / (1 + math.exp(-np.dot(h, weights["gate"][:, c]))) for c in range(quality.ATTENTION)]
            hidden.append(h)
            raw.append(np.dot(gated, weights["attend"]))
        a = np.exp(np.array(raw) - max(raw))
        a /= a.sum()
        logit = np.dot((a[:, None] * np.array(hidden)).sum(axis=0), weights["out"]) + weights["out_bias"] + model.shift
        assert score[i] == pytest.approx(1 / (1 + math.exp(-max(-40, min(40, logit)))), rel=1e-6)
        assert top[i] == int(np.argmax(a))


def test_learning_leaves_the_held_out_fold_alone(spark):
    docs = _frame(spark, [data.prose(i, 30) for i in range(30)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id bigint, quality int")
    held = [i for i in range(30) if zlib.crc32(str(i).encode()) % 5 == 0]
    flipped = labels.withColumn("quality", F.when(F.col("doc_id").isin(held), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, other = queries.quality_model(docs, labels), queries.quality_model(docs, flipped)
    assert all(np.array_equal(one.weights[k], other.weights[k]) for k in one.weights)


# language


def test_language_on_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    found = queries.op7_language(spark, sf_dir).join(docs, "doc_id").where("held_out").where("lang_pred <> 'und'")
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.98
    assert found.agg(F.min("score"), F.max("score")).where("`min(score)` < 0 OR `max(score)` > 1").count() == 0


def test_language_cases(spark):
    a, b = ["aba baa aab " * 5 + str(i) for i in range(20)], ["zyx xyz yzz " * 5 + str(i) for i in range(20)]
    rows = [(i, t, "aa" if i < 20 else "zz") for i, t in enumerate(a + b)] + [(50, None, "aa"), (51, "zyx", None), (52, "12 34 !", "aa"), (53, "", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language.fit(docs)
    assert model.languages == ["aa", "zz"]
    got = _by_id(language.identify(docs, model))
    assert [got[i].lang_pred for i in range(40)] == ["aa"] * 20 + ["zz"] * 20
    assert [(got[i].lang_pred, got[i].score) for i in (50, 52, 53)] == [("und", 0.0)] * 3
    assert got[51].lang_pred == "zz" and 0.5 < got[51].score <= 1
    nothing = language.fit(docs.limit(0))
    assert {(r.lang_pred, r.score) for r in language.identify(docs, nothing).collect()} == {("und", 0.0)}
    assert language.identify(docs.limit(0), model).count() == 0
    bounded = language.fit(docs, fit_docs=5)
    assert bounded.languages == ["aa", "zz"] and language.identify(docs, bounded).where("doc_id < 20 AND lang_pred = 'aa'").count() == 20


def _plain_buckets(text):
    """Hashed n-grams of a text's letters in lower case, anything else a blank; only those with a letter."""
    codes = [ord(c) if c.isalpha() else 32 for c in text.lower()]
    factors, out = [int(f) for f in language._FACTORS], []
    for n in language.ORDERS:
        for i in range(len(codes) - n + 1):
            if any(c != 32 for c in codes[i : i + n]):
                h = (n + sum(c * f for c, f in zip(codes[i : i + n], factors))) % 2**64
                out.append(int(hashing.mixed(np.array([h], dtype=np.uint64))[0]) >> 64 - language.BUCKET_BITS)
    return out


def test_language_model_against_plain_counts(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("Das Öl, 12!", "de"), ("la mer é", "fr"), ("der Tag", "de"), ("", "fr"), (None, "fr"), ("x", None), ("ße", "de")])]
    model = language.fit(spark.createDataFrame(rows, "doc_id int, text string, lang string"))
    assert model.languages == ["de", "fr"]
    assert np.allclose(np.exp(model.prior), [3 / 5, 2 / 5])
    for i, name in enumerate(model.languages):
        counts = collections.Counter(b for _, t, lang in rows if lang == name and t is not None for b in _plain_buckets(t))
        total = sum(counts.values()) + language.SMOOTHING * (1 << language.BUCKET_BITS)
        plain = np.full(1 << language.BUCKET_BITS, math.log(language.SMOOTHING / total))
        for b, n in counts.items():
            plain[b] = math.log((n + language.SMOOTHING) / total)
        assert np.allclose(model.matrix[:, i], plain, atol=1e-5)


def test_language_score_is_the_posterior():
    rng = np.random.default_rng(1)
    model = language.Model(["a", "b", "c"], np.log([0.2, 0.3, 0.5]), np.log(rng.dirichlet(np.ones(1 << language.BUCKET_BITS), 3).T).astype(np.float32))
    texts = ["Ab c", "", "xyz 9"]
    posterior, has = language.score_texts(model, texts)
    assert has.tolist() == [True, False, True]
    for i, text in enumerate(texts):
        buckets, _, _ = language.ngram_buckets([text])
        plain = model.prior + model.matrix[buckets].astype(np.float64).sum(axis=0)
        plain = np.exp(plain - plain.max())
        assert np.allclose(posterior[i], plain / plain.sum())


# words and rows that weak hashes mix up


def _thue_morse(n):
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_words_whose_letters_cancel_out(spark):
    one, two = _thue_morse(1024)
    texts = [one, two, f"{one} x", f"{two} x"] + [" ".join([w, *data.prose(3, 40).split(" ")]) for w in (one, two)]
    docs = _frame(spark, texts)
    for rare in ("local", "join"):
        for head_bytes in (64 << 20, 1):
            head = bpe.head_of(docs, PATH, head_bytes=head_bytes)
            got = _by_id(bpe.encoded(docs, PATH, head=head, rare=rare))
            assert [list(got[i].ids) for i in range(len(texts))] == [_library_ids(t) for t in texts]
    encoded = _by_id(token_files.encoded(docs, PATH))
    assert [list(encoded[i].ids) for i in range(len(texts))] == [[*_library_ids(t), 1] for t in texts]
    similar = _by_id(similarity.similar_documents(docs, k=4, percent=85))
    assert [similar[i].component_id for i in range(len(texts))] == brute.similar(texts, 4, 85)
    kept = _by_id(repeats.without_repeats(docs))
    assert [(kept[i].n_words, kept[i].n_removed, kept[i].text) for i in range(len(texts))] == brute.without_repeats(texts, 35)


def test_rows_without_id_are_told_apart(spark):
    """Two rows whose 32-bit hashes agree; only one of them repeats another text."""
    base, n = data.prose(17, 40), 200_000
    made = spark.range(n).select(
        F.explode(F.array(F.concat(F.lit(base + " "), F.col("id").cast("string")), F.concat(F.lit("solo "), F.col("id").cast("string")))).alias("text")
    )
    hashed = made.withColumn("h", F.hash(F.lit(None).cast("bigint"), "text"))
    left, right = hashed.where("text NOT LIKE 'solo%'"), hashed.where("text LIKE 'solo%'").withColumnRenamed("text", "other")
    pair = left.join(right, "h").first()
    docs = spark.createDataFrame([(None, pair.text), (None, pair.other), (1, base)], "doc_id bigint, text string")
    got = {r.text: (r.n_words, r.n_removed) for r in repeats.without_repeats(docs).collect()}
    assert got[pair.other] == (2, 0)
    assert sorted(n for _, n in got.values()) == [0, 40, 40]
    for rare in ("local", "join"):
        ids = sorted(list(r.ids) for r in bpe.encoded(docs, PATH, rare=rare).collect())
        assert ids == sorted(map(_library_ids, (pair.text, pair.other, base)))


def test_lines_of_tables_with_a_column_named_like_the_count(spark):
    docs = _frame(spark, _logs()).withColumn("n_dropped_lines", F.lit("own"))
    got = lines.without_recurring_lines(docs)
    got.write.format("noop").mode("overwrite").save()
    assert sorted(got.columns) == sorted(docs.columns) and got.schema["n_dropped_lines"].dataType.simpleString() == "bigint"
    assert got.agg(F.sum("n_dropped_lines")).first()[0] > 40
