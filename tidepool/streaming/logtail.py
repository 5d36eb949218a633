"""Container log stream: parse lines, roll JSON files by date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidepool.sources.logs import parse_container_lines
from tidepool.streaming.sink import with_trigger

# Fixed value: pod, namespace and container in a container log's file name.
FILE_FORM = r"([^/]+?)_([^_/]+)_([^/]+)-[^-/]+\.log"


def tail_logs(spark: SparkSession, path: str, pods: DataFrame | None = None, form: str = FILE_FORM) -> DataFrame:
    """Stream of parsed log lines; ``pods`` (pod_name, labels) adds labels by pod, ``form`` finds the pod in a file's name."""
    files = spark.readStream.schema("value STRING").text(path)
    lines = files.select("value", F.regexp_extract("_metadata.file_path", form, 1).alias("pod_name"))
    rows = parse_container_lines(lines, keep=("pod_name",))
    return rows if pods is None else rows.join(pods, "pod_name", "left")


def roll_logs(stream: DataFrame, path: str, checkpoint: str, live: bool = False) -> StreamingQuery:
    """Append JSON files by date."""
    writer = stream.writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint)
    return with_trigger(writer.partitionBy("date"), live).start()
