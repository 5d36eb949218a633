"""Ordered buffer between the batch maths and the stateful stream.

Rows are keyed JSON messages in event order, in files or in a Kafka topic (which
needs the Kafka connector on the classpath).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.operators.staging import shuffles_removed
from tidepool.streaming.sink import TableFiles

MESSAGE = "key STRING, value STRING"
#: Stored bytes of files that a micro-batch takes; what a batch shuffles does not grow with the buffer.
BATCH_BYTES = 512 << 20


def messages(df: DataFrame, key: str = "address", order: str = "logId") -> DataFrame:
    """Key and JSON value of every row, globally sorted by ``order``."""
    return df.select(F.col(key).alias("key"), F.to_json(F.struct("*")).alias("value"), F.col(order).alias("__order")).orderBy(
        "__order"
    ).drop("__order")


def write_buffer(
    df: DataFrame, target: str, kafka: Mapping[str, str] | None = None, key: str = "address", order: str = "logId"
) -> None:
    """Append the rows in order to a folder, or to a topic with ``kafka`` options.

    Files are stamped in their order, as a stream of files reads them by their time.
    """
    ordered = messages(df, key, order)
    if kafka is None:
        files = TableFiles(df.sparkSession, target)
        before = set(files.below(target)) if files.exists(target) else set()
        with shuffles_removed(df.sparkSession):
            ordered.write.mode("append").option("compression", "gzip").json(target)
        newest = max((files.time(f"{target}/{name}") for name in before), default=0)
        files.stamp([f"{target}/{name}" for name in sorted(set(files.below(target)) - before)], newest)
    else:
        ordered.write.format("kafka").options(**kafka).option("topic", target).save()


def read_buffer(spark: SparkSession, source: str, kafka: Mapping[str, str] | None = None) -> DataFrame:
    """Stream of messages from the earliest on; many files come in several micro-batches."""
    if kafka is None:
        return spark.readStream.schema(MESSAGE).option("maxBytesPerTrigger", BATCH_BYTES).json(source)
    stream = spark.readStream.format("kafka").options(**kafka).option("subscribe", source)
    raw = stream.option("startingOffsets", "earliest").load()
    return raw.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def decode(stream: DataFrame, schema: T.StructType) -> DataFrame:
    """Typed columns of JSON messages."""
    return stream.select(F.from_json(F.col("value").cast("string"), schema).alias("d")).select("d.*")
