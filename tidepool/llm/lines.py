"""Line dedup with a log-template tree.

Every line is parsed to a fixed depth: first its token count, then its first ``DEPTH`` tokens, where a
token with a digit reads as the wildcard. Lines that meet in a leaf are generalised: a later token
stays a constant if it stands at its place in at least ``min_docs`` documents of the leaf, and is a
variable field otherwise. If at least ``constant_percent`` of a line's tokens are constants, those and
wildcards are its template; else the line, with digits generalised, is its own. The leading tokens alone
don't make words behind them a field: that takes a constant behind them, too. A template that occurs
in ``min_docs`` or more documents recurs, and every line of it after its first occurrence, by document
id and place, is dropped.

Only leaves that hold ``min_docs`` documents can hold a recurring template, so the first pass sends a
few numbers per line, and the text of lines is looked at in frequent leaves only. Templates are made
once per distinct sequence of tokens. Documents per leaf, field and template are counted by Spark from
distinct pairs, dealt out by both, so that no leaf is gathered in one task.

Cases: blank lines are kept and are no template; a NULL text stays NULL; a document keeps its row even
if no line is left (text empty); rows that share an id are one document for counts, and each is cut on
its own; NULL ids count as one document; other columns are kept, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.llm import hashing, storage
from tidepool.llm.hashing import Texts

DEPTH = 3
MIN_DOCS = 5
CONSTANT_PERCENT = 60
#: Frequent leaves, 8 bytes each, up to which they are broadcast; more are joined by shuffle.
BROADCAST_LEAVES = 1 << 20
WILDCARD = "<*>"
_DIGIT = np.zeros(256, dtype=np.int64)
_DIGIT[48:58] = 1
_WILD_HASH = np.uint64(0x5851F42D4C957F2D)


def line_leaves(texts: Texts, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, line number and leaf of each line that isn't blank."""
    starts = np.unique(np.concatenate([texts.offsets[:-1], np.flatnonzero(texts.data == 10) + 1]))
    starts = starts[starts < len(texts.data)]
    row = np.searchsorted(texts.offsets, starts, side="right") - 1
    number = np.arange(len(starts)) - np.searchsorted(starts, texts.offsets[:-1])[row]
    words = hashing.words_of(texts)
    hashes = hashing.word_hashes(texts, words)
    if len(hashes):
        digits = np.concatenate([[0], np.cumsum(_DIGIT[texts.data])])
        hashes[digits[words.ends] > digits[words.starts]] = _WILD_HASH
    bounds = np.searchsorted(words.starts, np.append(starts, len(texts.data)))
    full = np.flatnonzero(np.diff(bounds))
    low, n = bounds[:-1][full], np.diff(bounds)[full]
    leaf = hashing.mixed(n.astype(np.uint64))
    for d in range(depth):
        has = n > d
        leaf[has] = hashing.mixed(leaf[has] ^ (hashes[low[has] + d] + np.uint64(d)))
    return row[full], number[full], leaf


def _leaves(batches, depth: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for texts in hashing.text_slices(batch.column(2)):
            row, number, leaf = line_leaves(texts, depth)
            where = pa.array(row + texts.first)
            columns = [batch.column(0).take(where), batch.column(1).take(where), pa.array(number.astype(np.int32)), pa.array(leaf.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "row_hash", "line", "leaf"])


def tokens_of(line: Column) -> Column:
    """Tokens of a line, those with a digit generalised."""
    words = F.filter(F.split(line, r"[\x20\x09-\x0D]+"), lambda t: t != "")
    return F.transform(words, lambda t: F.when(t.rlike("[0-9]"), F.lit(WILDCARD)).otherwise(t))


def _documents(df: DataFrame, *keys: str) -> DataFrame:
    """Documents of each key: first distinct pairs, dealt by both, then counts that tasks combine."""
    return df.select(*keys, "doc_id").distinct().groupBy(*keys).agg(F.count("*").alias("docs"))


def _lines_by_broadcast(rows: DataFrame, frequent: DataFrame, depth: int) -> DataFrame:
    """(doc_id, row_hash, line, body) of lines in frequent leaves, found where they lie."""
    leaves = np.sort(frequent.toArrow().column("leaf").to_numpy().view(np.uint64))
    held = rows.sparkSession.sparkContext.broadcast(leaves)

    def pick(batches):
        for batch in batches:
            for texts in hashing.text_slices(batch.column(2)):
                row, number, leaf = line_leaves(texts, depth)
                keep = np.isin(leaf, held.value)
                where, bodies, split = row[keep], [], (-1, [])
                for r, i in zip(where.tolist(), number[keep].tolist(), strict=True):
                    if split[0] != r:
                        split = (r, texts.text(r).split("\n"))
                    bodies.append(split[1][i])
                at = pa.array(where + texts.first)
                columns = [batch.column(0).take(at), batch.column(1).take(at), pa.array(number[keep].astype(np.int32)), pa.array(bodies, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "row_hash", "line", "body"])

    return rows.mapInArrow(pick, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, row_hash binary, line int, body string")


def _lines_by_join(rows: DataFrame, lines: DataFrame, frequent: DataFrame) -> DataFrame:
    """The same by shuffle joins, for any number of frequent leaves."""
    wanted = (
        lines.join(frequent, "leaf", "left_semi")
        .groupBy("doc_id", "row_hash")
        .agg(F.collect_set("line").alias("wanted"))
        .withColumnsRenamed({"doc_id": "of_doc", "row_hash": "of_row"})
    )
    found = rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("row_hash") == F.col("of_row")))
    texts = found.withColumn("lines", F.split("text", "\n")).select("doc_id", "row_hash", "lines", F.explode("wanted").alias("line"))
    return texts.select("doc_id", "row_hash", "line", F.element_at("lines", F.col("line") + 1).alias("body"))


def recurring_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", depth: int = DEPTH, min_docs: int = MIN_DOCS,
    constant_percent: int = CONSTANT_PERCENT, broadcast_leaves: int = BROADCAST_LEAVES,
) -> DataFrame:
    """(doc_id, row_hash, line, template, docs, first): the lines of recurring templates; ``first`` marks the one to keep."""
    of_id = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), storage.row_hash(doc_id, text).alias("row_hash"), F.col(text).cast("string").alias("text"))
    lines = rows.mapInArrow(lambda batches: _leaves(batches, depth), f"doc_id {of_id}, row_hash binary, line int, leaf bigint")
    frequent = storage.written(_documents(lines, "leaf").where(F.col("docs") >= min_docs).select("leaf"), "frequent-leaves")
    found = _lines_by_broadcast(rows, frequent, depth) if frequent.count() <= broadcast_leaves else _lines_by_join(rows, lines, frequent)
    tokens = tokens_of(F.col("body"))
    parsed = found.select("doc_id", "row_hash", "line", F.concat_ws(" ", tokens).alias("whole")).withColumn("sequence", F.xxhash64("whole"))
    parsed = storage.written(parsed, "frequent-lines")

    # a template is made per distinct sequence of tokens, whichever lines have it
    sequences = storage.written(
        parsed.groupBy("sequence").agg(F.min("whole").alias("whole")).join(_documents(parsed, "sequence"), "sequence").withColumn("tokens", F.split("whole", " ")),
        "sequences",
    )
    leaf = F.concat_ws(" ", F.size("tokens").cast("string"), F.slice("tokens", 1, depth))  # tokens hold no blanks
    places = (
        sequences.select("sequence", "docs", leaf.alias("leaf"), F.posexplode("tokens").alias("place", "token"))
        .where((F.col("place") >= depth) & (F.col("token") != WILDCARD))
        .select("sequence", "docs", "place", F.xxhash64("leaf", "place", "token").alias("field"))
    )
    # a sequence in enough documents settles its fields; only those of rarer ones are counted by document
    settled = places.where(F.col("docs") >= min_docs).select("field")
    rare = places.where(F.col("docs") < min_docs).join(parsed.select("sequence", "doc_id").distinct(), "sequence")
    constants = settled.unionByName(_documents(rare, "field").where(F.col("docs") >= min_docs).select("field")).distinct()
    kept = places.join(constants, "field").groupBy("sequence").agg(F.collect_set("place").alias("kept"))
    both = sequences.join(kept, "sequence", "left").withColumn("kept", F.coalesce("kept", F.array().cast("array<int>")))
    general = F.transform("tokens", lambda t, i: F.when((i < depth) | F.array_contains("kept", i), t).otherwise(WILDCARD))
    constant = F.size("kept") + F.size(F.filter(F.slice("tokens", 1, depth), lambda t: t != WILDCARD))
    behind = F.exists(F.slice("tokens", depth + 1, F.size("tokens")), lambda t: t != WILDCARD)
    evident = (F.size("kept") > 0) | ~behind
    template = F.when((constant * 100 >= F.size("tokens") * constant_percent) & evident, general).otherwise(F.col("tokens"))
    templates = parsed.select("doc_id", "row_hash", "line", "sequence").join(both.select("sequence", F.concat_ws(" ", template).alias("template")), "sequence").drop("sequence")
    order = F.struct(F.col("doc_id").isNotNull(), "doc_id", "row_hash", "line")
    counted = (
        templates.groupBy("template", "doc_id")
        .agg(F.min(order).alias("at"))
        .groupBy("template")
        .agg(F.count("*").alias("docs"), F.min("at").alias("at"))
        .where(F.col("docs") >= min_docs)
    )
    return templates.join(counted, "template").select("doc_id", "row_hash", "line", "template", "docs", (order == F.col("at")).alias("first"))


def _cut(batches, column: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Rebuilds texts without their dropped lines (last column)."""
    for batch in batches:
        dropped = batch.column(batch.num_columns - 1).to_pylist()
        texts = batch.column(column).to_pylist()
        n = [0] * len(texts)
        for i, lines in enumerate(dropped):
            if lines and texts[i] is not None:
                gone, parts = set(lines), texts[i].split("\n")
                texts[i], n[i] = "\n".join(p for j, p in enumerate(parts) if j not in gone), len(gone)
        columns = [pa.array(texts, pa.string()) if i == column else batch.column(i) for i in range(batch.num_columns - 1)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(n, pa.int64())], names=names)


def without_recurring_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", depth: int = DEPTH, min_docs: int = MIN_DOCS,
    constant_percent: int = CONSTANT_PERCENT, count: str = "n_dropped_lines",
) -> DataFrame:
    """``docs`` with recurring lines dropped from the text, and how many were; a column of that name gives way to the count."""
    lines = recurring_lines(docs, doc_id, text, depth, min_docs, constant_percent).where(~F.col("first"))
    # names that no column of docs has
    of_doc, of_row, gone = "__dropped_of", "__dropped_row", "__dropped_lines"
    dropped = lines.groupBy(F.col("doc_id").alias(of_doc), F.col("row_hash").alias(of_row)).agg(F.collect_set("line").alias(gone))
    if count in (doc_id, text):
        raise ValueError(f"{count!r} can't name the count")
    docs = docs.drop(count)
    joined = docs.join(dropped, F.col(doc_id).eqNullSafe(F.col(of_doc)) & (storage.row_hash(doc_id, text) == F.col(of_row)), "left").drop(of_doc, of_row)
    schema = T.StructType([*docs.schema.fields, T.StructField(count, T.LongType())])
    column = docs.columns.index(text)
    return joined.mapInArrow(lambda batches: _cut(batches, column, schema.names), schema)
