"""Each operator as a query over its whole table, and its SQL where SQL can state it."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import bpe, decontamination, hard_negatives, language, lines, neighbours, packing, quality, repeats, similarity, spelling, storage, token_files, url_lists, wordpieces


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    storage.bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) leak."""
    return decontamination.contaminated_pairs(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def _remainder(doc_id: str, of: int):
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(of))


def op2_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines of recurring templates."""
    kept = lines.without_recurring_lines(_read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_dropped_lines", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op3_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of four-word shingles are similar to 85 percent."""
    return similarity.similar_documents(_read(spark, sf_dir, "documents"), k=4, percent=85)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text and the text they decode to, digested."""
    path = wordpieces.tokenizer_path()
    texts = bpe.decoded(bpe.encoded(_read(spark, sf_dir, "documents"), path), path)
    digest = F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256)
    return texts.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        digest.alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def _number(text: Column) -> Column:
    """0 to 65535 from a text, the same in SQL."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 4), 16, 10).cast("int")


def captures_of(pages: DataFrame) -> DataFrame:
    """Pages with the second of 2024 at which each counts as fetched."""
    return pages.select("page_id", "url", (F.lit(1704067200) + F.pmod(F.col("page_id") * 7919, F.lit(31536000))).alias("fetched_at"))


def entries_of(pages: DataFrame) -> DataFrame:
    """Dated list entries on the pages' own hosts and path prefixes."""
    host = url_lists.host_of(F.col("url"))
    hosts = pages.select(F.lit("host").alias("kind"), host.alias("value")).where(F.col("value") != "").distinct()
    domains = hosts.select("kind", F.regexp_replace("value", r"^[^.]*\.", "").alias("value")).distinct()
    prefixes = pages.select(F.lit("prefix").alias("kind"), F.explode(url_lists.rules_of(F.col("url"))).alias("r")).where(F.col("r.kind") == "prefix").select("kind", "r.value").distinct()
    rules = hosts.unionByName(domains).unionByName(prefixes).distinct().withColumn("x", _number(F.concat("kind", "value")))
    start, day = F.lit(1704067200), 86400
    entry = lambda name, effect, at, action: F.struct(F.lit(name).alias("list"), F.lit(effect).alias("effect"), (start + at * day).alias("at"), F.lit(action).alias("action"))
    x = F.col("x")
    entries = F.array(
        F.when(x % 3 == 0, entry("abuse", "block", x % 200, "add")),
        F.when(x % 6 == 0, entry("abuse", "block", x % 200 + 60, "remove")),
        F.when(x % 12 == 0, entry("abuse", "block", x % 200 + 90, "add")),
        F.when(x % 5 == 0, entry("partners", "allow", x % 300, "add")),
        F.when(x % 7 == 0, entry("adult", "block", x % 100, "add")),
        F.when(x % 14 == 0, entry("adult", "block", x % 100, "remove")),
    )
    return rules.select("kind", "value", F.explode(F.filter(entries, lambda e: e.isNotNull())).alias("e")).select("e.*", "kind", "value")


def op5_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page against the list entries active when it was fetched."""
    pages = _read(spark, sf_dir, "pages").select("page_id", "url")
    return url_lists.evaluated(captures_of(pages), entries_of(pages)).withColumn("lists", F.array_join("lists", ","))


ACCEPTED_SCORE = 0.3


def quality_model(docs: DataFrame, labels: DataFrame) -> quality.Model:
    """Learned from the labels outside the held-out fold."""
    return quality.fit(docs, labels.where(_remainder("doc_id", 5) != 0))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every text."""
    docs = _read(spark, sf_dir, "documents")
    scores = quality.scored(docs, quality_model(docs, _read(spark, sf_dir, "labels")))
    return scores.select(
        "doc_id",
        F.coalesce(_remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= ACCEPTED_SCORE).cast("int").alias("predicted"),
        "n_passages",
        "top_passage",
    )


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text, learned from the documents outside the held-out fold."""
    docs = _read(spark, sf_dir, "documents")
    model = language.fit(docs.where(_remainder("doc_id", 4) != 2))
    return language.identify(docs, model).select("doc_id", F.coalesce(_remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of windows that start elsewhere, too."""
    kept = repeats.without_repeats(_read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth id."""
    vectors = _read(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where(F.col("vec_id") % 100 == 0), k=10)


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document in windows of 4096 tokens, its ids digested."""
    pieces = packing.packed(_read(spark, sf_dir, "documents"), wordpieces.tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth id, for each of its positives."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = _read(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives.hard_negatives(vectors, vectors.where(F.col("vec_id") % 100 == 0))


def misspelt(runs: DataFrame) -> DataFrame:
    """``runs`` (doc_id, run) with one code point less in every 31st, by hash of both."""
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")))
    at = (h % F.char_length("run")).cast("int")
    return runs.withColumn("run", F.when(h % 31 == 0, F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.char_length("run")))).otherwise(F.col("run")))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among all words of seven letters or more that occur twice."""
    runs = misspelt(spelling.letter_runs(_read(spark, sf_dir, "documents"), 7))
    words = runs.where(F.char_length("run") >= 7).groupBy(F.col("run").alias("word")).agg(F.count("*").alias("n")).where(F.col("n") >= 2)
    return spelling.spelling_variants(words)


def _crc32(batches):
    for batch in batches:
        ids = batch.column("ids")
        values = ids.flatten().to_numpy(zero_copy_only=False).astype("<u4")
        bounds = np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy(zero_copy_only=False))])
        sums = [zlib.crc32(values[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        columns = [batch.column("file"), batch.column("row"), pa.array(sums, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["file", "row", "ids_crc32"])


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the token files of all documents and digests what is read back."""
    folder = storage.shared_folder(spark, "token-files")
    token_files.write_token_files(_read(spark, sf_dir, "documents"), folder, wordpieces.tokenizer_path())
    tokens = token_files.read_tokens(spark, folder).select(
        "ids", F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file"), F.col("_metadata.row_index").alias("row")
    )
    sums = tokens.mapInArrow(_crc32, "file string, row bigint, ids_crc32 bigint")
    return (
        token_files.read_metadata(spark, folder)
        .join(sums, ["file", "row"])
        .select("doc_id", F.col("start").cast("bigint").alias("start"), "n_tokens", "ids_crc32")
    )


OP1_SQL = r"""
WITH texts AS (
    SELECT 'd' AS side, doc_id AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
    UNION ALL
    SELECT 'b', item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') FROM benchmark
),
shingles AS (
    SELECT DISTINCT side, id, s FROM (
        SELECT side, id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
            WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
        FROM texts)
),
sizes AS (SELECT id, count(*) AS n FROM shingles WHERE side = 'b' GROUP BY id)
SELECT d.id AS doc_id, b.id AS item_id, any_value(n) AS n_shingles, count(*) AS n_shared, count(*) / any_value(n) AS containment
FROM shingles b JOIN shingles d ON d.s = b.s AND d.side = 'd' JOIN sizes ON sizes.id = b.id
WHERE b.side = 'b'
GROUP BY d.id, b.id HAVING 100 * count(*) >= 80 * any_value(n)
"""

OP2_SQL = r"""
WITH lines AS (
    SELECT doc_id, generate_subscripts(l, 1) AS line, unnest(l) AS body FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
),
parsed AS (
    SELECT *, concat_ws(' ', len(t), array_to_string(t[1:3], ' ')) AS leaf FROM (
        SELECT doc_id, line, list_transform(regexp_extract_all(body, '[^\x20\x09-\x0D]+'),
            lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END) AS t
        FROM lines)
    WHERE len(t) > 0
),
places AS (SELECT doc_id, line, leaf, generate_subscripts(t, 1) AS place, unnest(t) AS token FROM parsed),
constants AS (
    SELECT leaf, place, token FROM places WHERE place > 3 AND token <> '<*>' GROUP BY ALL HAVING count(DISTINCT doc_id) >= 5
),
general AS (
    SELECT p.doc_id, p.line, count(*) AS n,
        count(*) FILTER (WHERE p.place <= 3 AND p.token <> '<*>' OR c.token IS NOT NULL) AS constant,
        count(c.token) > 0 OR count(*) FILTER (WHERE p.place > 3 AND p.token <> '<*>') = 0 AS evident,
        string_agg(p.token, ' ' ORDER BY p.place) AS whole,
        string_agg(CASE WHEN p.place <= 3 OR c.token IS NOT NULL THEN p.token ELSE '<*>' END, ' ' ORDER BY p.place) AS masked
    FROM places p LEFT JOIN constants c ON c.leaf = p.leaf AND c.place = p.place AND c.token = p.token
    GROUP BY p.doc_id, p.line
),
templates AS (SELECT doc_id, line, CASE WHEN constant * 100 >= n * 60 AND evident THEN masked ELSE whole END AS template FROM general),
recurring AS (SELECT template, min((doc_id, line)) AS at FROM templates GROUP BY template HAVING count(DISTINCT doc_id) >= 5),
dropped AS (SELECT t.doc_id, t.line FROM templates t JOIN recurring r ON r.template = t.template WHERE (t.doc_id, t.line) <> r.at)
SELECT l.doc_id, count(d.line) AS n_dropped_lines,
    sha256(coalesce(string_agg(CASE WHEN d.line IS NULL THEN l.body END, chr(10) ORDER BY l.line), '')) AS kept_sha256
FROM lines l LEFT JOIN dropped d ON d.doc_id = l.doc_id AND d.line = l.line GROUP BY l.doc_id
"""

OP5_SQL = r"""
WITH p AS (
    SELECT page_id, url, 1704067200 + (page_id * 7919) % 31536000 AS fetched_at,
        regexp_replace(regexp_extract(lower(url), '^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^:/?#@]+)', 1), '\.$', '') AS host,
        list_filter(string_split(regexp_extract(url, '^[^:/?#]*://[^/?#]*(/[^?#]*)', 1), '/'), lambda x: x <> '') AS parts
    FROM pages
),
asked AS (
    SELECT DISTINCT page_id, 'host' AS kind, array_to_string(string_split(host, '.')[i:], '.') AS value
    FROM p, unnest(range(1, len(string_split(host, '.')) + 1)) AS t(i) WHERE host <> ''
    UNION
    SELECT DISTINCT page_id, 'prefix', host || '/' || array_to_string(parts[1:i], '/')
    FROM p, unnest(range(1, len(parts) + 1)) AS t(i) WHERE host <> ''
),
rules AS (
    SELECT *, CAST('0x' || substr(md5(kind || value), 1, 4) AS INTEGER) AS x FROM (
        SELECT DISTINCT 'host' AS kind, host AS value FROM p WHERE host <> ''
        UNION SELECT DISTINCT 'host', regexp_replace(host, '^[^.]*\.', '') FROM p WHERE host <> ''
        UNION SELECT DISTINCT kind, value FROM asked WHERE kind = 'prefix')
),
entries AS (
    SELECT 'abuse' AS list, 'block' AS effect, kind, value, x % 200 AS day, 'add' AS action FROM rules WHERE x % 3 = 0
    UNION ALL SELECT 'abuse', 'block', kind, value, x % 200 + 60, 'remove' FROM rules WHERE x % 6 = 0
    UNION ALL SELECT 'abuse', 'block', kind, value, x % 200 + 90, 'add' FROM rules WHERE x % 12 = 0
    UNION ALL SELECT 'partners', 'allow', kind, value, x % 300, 'add' FROM rules WHERE x % 5 = 0
    UNION ALL SELECT 'adult', 'block', kind, value, x % 100, 'add' FROM rules WHERE x % 7 = 0
    UNION ALL SELECT 'adult', 'block', kind, value, x % 100, 'remove' FROM rules WHERE x % 14 = 0
),
latest AS (
    -- the last entry of each rule up to the fetch time
    SELECT a.page_id, e.list, e.effect, e.value, arg_max(e.action, (e.day, e.action)) AS action
    FROM asked a JOIN p USING (page_id) JOIN entries e ON e.kind = a.kind AND e.value = a.value AND 1704067200 + e.day * 86400 <= p.fetched_at
    GROUP BY a.page_id, e.list, e.effect, e.kind, e.value
),
verdict AS (
    SELECT page_id, max((length(value), effect = 'allow', value)) AS best, string_agg(DISTINCT list, ',' ORDER BY list) AS lists
    FROM latest WHERE action = 'add' GROUP BY page_id
)
SELECT page_id, url, fetched_at, coalesce(NOT best[2], false) AS blocked, best[3] AS rule, coalesce(lists, '') AS lists
FROM p LEFT JOIN verdict USING (page_id)
"""

OP10_SQL = """
WITH v AS (
    SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM (
        SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
            sqrt(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: (q.e[i] - c.e[i]) * (q.e[i] - c.e[i])))) AS score
        FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0))
WHERE rank <= 10
"""

OP3_SQL = r"""
WITH RECURSIVE t AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
),
sets AS (
    SELECT DISTINCT doc_id, s FROM (
        SELECT doc_id, unnest(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
            WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
        FROM t)
),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM sets a JOIN sets b ON b.s = a.s AND b.doc_id <> a.doc_id
        JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))
),
reached(doc_id, least) AS (
    SELECT doc_id, doc_id FROM t
    UNION
    SELECT l.b, r.least FROM reached r JOIN links l ON l.a = r.doc_id WHERE r.least < l.b
)
SELECT t.doc_id, coalesce(max(n), 0) AS n_shingles, min(least) AS component_id
FROM t LEFT JOIN sizes USING (doc_id) JOIN reached USING (doc_id) GROUP BY t.doc_id
"""

OP9_SQL = r"""
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS body FROM t, unnest(range(1, len(w) - 33)) AS u(i)
),
repeated AS (SELECT body FROM windows GROUP BY body HAVING count(*) > 1),
covered AS (SELECT DISTINCT doc_id, p FROM windows JOIN repeated USING (body), unnest(range(i, i + 35)) AS u(p)),
places AS (SELECT doc_id, generate_subscripts(w, 1) AS p, unnest(w) AS word FROM t)
SELECT t.doc_id, CAST(len(any_value(t.w)) AS BIGINT) AS n_words, count(c.p) AS n_removed,
    sha256(coalesce(string_agg(CASE WHEN c.p IS NULL THEN x.word END, ' ' ORDER BY x.p), '')) AS kept_sha256
FROM t LEFT JOIN places x ON x.doc_id = t.doc_id LEFT JOIN covered c ON c.doc_id = x.doc_id AND c.p = x.p
GROUP BY t.doc_id
"""

# the checksum is computed byte by byte from its table of 256 codes
OP13_SQL = r"""
WITH codes AS (
    SELECT list(c ORDER BY i) AS t FROM (
        SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS c FROM range(256) AS r(i))
),
runs AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{00C0}-\x{00FF}]{7,}')) AS run FROM documents
),
counted AS (SELECT doc_id, run, count(*) AS n, hex(encode(concat(doc_id, ':', run))) AS x FROM runs GROUP BY ALL),
hashed AS (
    SELECT run, n, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, len(x), 2), lambda i: CAST('0x' || x[i:i + 1] AS BIGINT))),
        lambda a, b: xor(t[xor(a, b) % 256 + 1], a >> 8))) AS h
    FROM counted, codes
),
words AS (
    SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
        SELECT n, CASE WHEN h % 31 = 0 THEN concat(run[1:h % length(run)], run[h % length(run) + 2:]) ELSE run END AS word FROM hashed)
    WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
),
cuts AS (SELECT word, n, i, concat(word[1:i - 1], word[i + 1:]) AS rest FROM words, unnest(range(1, length(word) + 1)) AS u(i)),
near AS (
    SELECT a.word AS word, b.word AS other, b.n FROM cuts a JOIN cuts b ON b.rest = a.rest AND b.i = a.i AND b.word <> a.word
    UNION SELECT w.word, c.word, c.n FROM words w JOIN cuts c ON c.rest = w.word
    UNION SELECT c.word, w.word, w.n FROM words w JOIN cuts c ON c.rest = w.word
),
best AS (SELECT word, count(*) AS n_near, min((-n, other)) AS top FROM near GROUP BY word),
forms AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -top[1] >= 10 * n THEN top[2] END AS form, CASE WHEN -top[1] >= 10 * n THEN -top[1] END AS form_n
    FROM words LEFT JOIN best USING (word)
),
chain AS (
    WITH RECURSIVE steps(word, spot) AS (
        SELECT word, word FROM forms UNION ALL SELECT s.word, f.form FROM steps s JOIN forms f ON f.word = s.spot WHERE f.form IS NOT NULL
    ) SELECT s.word, s.spot AS root FROM steps s JOIN forms f ON f.word = s.spot WHERE f.form IS NULL
)
SELECT word, form, root, n, n_near, CAST(form_n AS BIGINT) AS form_n FROM forms JOIN chain USING (word)
"""

OP12_SQL = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
pairs AS (
    SELECT a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS same,
        CAST(coalesce(list_sum(list_transform(range(1, len(a.e) + 1), lambda i: a.e[i] * c.e[i])), 0) AS BIGINT) AS score
    FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.e) = len(c.e) WHERE a.vec_id % 100 = 0
),
positives AS (
    SELECT anchor_id, id, score FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS place FROM pairs WHERE same) WHERE place <= 5
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM (
    SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) AS rank
    FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score)
WHERE rank <= 10
"""

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op1_decontamination": (op1_decontamination, OP1_SQL),
    "op2_lines": (op2_lines, OP2_SQL),
    "op3_similarity": (op3_similarity, OP3_SQL),
    "op4_bpe": (op4_bpe, None),
    "op5_url_lists": (op5_url_lists, OP5_SQL),
    "op6_quality": (op6_quality, None),
    "op7_language": (op7_language, None),
    "op8_token_files": (op8_token_files, None),
    "op9_repeats": (op9_repeats, OP9_SQL),
    "op10_neighbours": (op10_neighbours, OP10_SQL),
    "op11_packing": (op11_packing, None),
    "op12_hard_negatives": (op12_hard_negatives, OP12_SQL),
    "op13_spelling": (op13_spelling, OP13_SQL),
}
