"""Token-id files: Parquet list columns with dictionary or delta encoding, row groups and page indexes.

``write_token_files`` encodes texts and writes them in ascending document order: the texts are dealt
into id ranges, sorted within each, and written by Spark's Parquet writer with the encodings, row
group size and page size of a ``Layout``. Format v2 gives delta encoding to the number columns and,
where a dictionary no longer pays, to the ids; every column chunk carries page indexes. A second,
small table holds each document's start, so that a reader finds a token range from metadata alone:
``read_metadata`` reads no ids, and ``read_tokens`` with an id range reads only the row groups and
pages that hold it.

Cases: a NULL or empty text has only its end id; repeated ids keep all rows, ordered by text; a NULL
id comes first; an empty table gives empty files; other columns are not read. Starts come from counts
per written file, of which there are as many as partitions, and a running sum within each file.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepool.llm import hashing, wordpieces

END_ID = 1


@dataclass(frozen=True)
class Layout:
    """How the files are laid out; sizes in bytes."""

    dictionary: bool = True  # False: delta encoding for ids, too
    row_group: int = 16 << 20
    page: int = 256 << 10
    page_rows: int = 2000
    codec: str = "zstd"

    def options(self) -> dict[str, str]:
        return {
            "parquet.writer.version": "v2",
            "parquet.enable.dictionary": str(self.dictionary).lower(),
            "parquet.dictionary.page.size": str(1 << 20),
            "parquet.block.size": str(self.row_group),
            "parquet.page.size": str(self.page),
            "parquet.page.row.count.limit": str(self.page_rows),
            "compression": self.codec,
        }


def encoded(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", end_id: int = END_ID) -> DataFrame:
    """(doc_id, n_tokens, ids) per row, in the order of the rows."""
    schema = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, n_tokens bigint, ids array<int>"

    def encode(batches):
        encoder = wordpieces.worker_encoder(path)
        for batch in batches:
            for texts in hashing.text_slices(batch.column(1)):
                ids, bounds = encoder.ids(texts, hashing.words_of(texts))
                ids = np.insert(ids, bounds[1:], end_id).astype(np.int32)
                bounds = bounds + np.arange(len(bounds))
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids))
                rows = batch.column(0).slice(texts.first, texts.rows)
                yield pa.RecordBatch.from_arrays([rows, pa.array(np.diff(bounds)), lists], names=["doc_id", "n_tokens", "ids"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(encode, schema)


def write_token_files(
    docs: DataFrame, folder: str, path: str, layout: Layout = Layout(), doc_id: str = "doc_id", text: str = "text",
    end_id: int = END_ID, partitions: int | None = None,
) -> None:
    """Writes ``folder/tokens`` (doc_id, n_tokens, ids) and ``folder/index`` (doc_id, start, n_tokens, file)."""
    spark = docs.sparkSession
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = source.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    encoded(ordered, path, "doc_id", "text", end_id).write.options(**layout.options()).parquet(f"{folder}/tokens")
    _index(spark, folder).write.options(**layout.options()).parquet(f"{folder}/index")


def _index(spark: SparkSession, folder: str) -> DataFrame:
    """Starts from the written files: tokens of all earlier files, then a running sum within the file."""
    rows = spark.read.parquet(f"{folder}/tokens").select(
        "doc_id", "n_tokens", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")
    )
    # part-NNNNN is the place of a file in the order of ids; one row per file
    files = rows.groupBy("file").agg(F.sum("n_tokens").alias("in_file"))
    before = files.select("file", (F.sum("in_file").over(Window.orderBy("file")) - F.col("in_file")).alias("before"))
    within = Window.partitionBy("file").orderBy("row")
    running = rows.withColumn("start", F.sum("n_tokens").over(within) - F.col("n_tokens"))
    return running.join(F.broadcast(before), "file").select(
        "doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", F.element_at(F.split("file", "/"), -1).alias("file"), "row"
    )


def read_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, file, row) of each document; no ids are read."""
    return spark.read.parquet(f"{folder}/index")


def read_tokens(spark: SparkSession, folder: str, first=None, last=None) -> DataFrame:
    """(doc_id, n_tokens, ids) of the documents with ``first`` <= id <= ``last``, from the pages that hold them."""
    tokens = spark.read.parquet(f"{folder}/tokens")
    if first is not None:
        tokens = tokens.where(F.col("doc_id") >= first)
    return tokens if last is None else tokens.where(F.col("doc_id") <= last)
