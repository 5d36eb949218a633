"""Streaming upsert into date partitions, and running a stream to its end."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidepool.operators.staging import shuffles_removed
from tidepool.operators.upsert import latest_per_key

#: Seconds between two requests to collect the driver's garbage.
COLLECT_S = 20
#: Stored bytes of a batch's partitions that are merged at a time.
GROUP_BYTES = 256 << 20


def existing(spark: SparkSession, path: str, schema) -> DataFrame | None:
    """The table at ``path``, or None where nothing was written yet; any other error is raised."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


class TableFiles:
    """Few calls on the file system of a table: a merge moves and deletes whole files."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark._jvm
        self.fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def of_uri(self, uri: str):
        """Path of an encoded name, as scans report it."""
        return self.jvm.org.apache.hadoop.fs.Path(self.jvm.java.net.URI(uri))

    def exists(self, name: str) -> bool:
        return self.fs.exists(self._path(name))

    def delete(self, name: str) -> None:
        self.fs.delete(self._path(name), True)

    def forget(self, uri: str) -> None:
        self.fs.delete(self.of_uri(uri), False)

    def below(self, name: str) -> list[str]:
        """Data files in the folders of ``name``, relative to it."""
        top, found = self._path(name), []
        root = self.fs.makeQualified(top).toUri().getPath()
        files = self.fs.listFiles(top, True)
        while files.hasNext():
            at = files.next().getPath()
            if not at.getName().startswith(("_", ".")):
                found.append(at.toUri().getPath()[len(root) + 1 :])
        return found

    def groups(self, name: str, most: int) -> Iterator[list[str]]:
        """Folders right below ``name``, in groups of about ``most`` bytes."""
        group, held = [], 0
        for status in self.fs.listStatus(self._path(name)) if self.exists(name) else []:
            if status.isDirectory():
                size = self.fs.getContentSummary(status.getPath()).getLength()
                if group and held + size > most:
                    yield group
                    group, held = [], 0
                group.append(status.getPath().toString())
                held += size
        if group:
            yield group

    def move(self, source: str, target: str) -> None:
        """Renames a file; a move that was made before is left as it is."""
        if self.exists(source):
            self.fs.mkdirs(self._path(target).getParent())
            if not self.fs.rename(self._path(source), self._path(target)):
                raise OSError(f"{source} can't be moved to {target}")

    def time(self, name: str) -> int:
        return self.fs.getFileStatus(self._path(name)).getModificationTime()

    def stamp(self, names: list[str], after: int) -> None:
        """Gives files times that follow their order and ``after``."""
        start = max(after + 1, self.jvm.java.lang.System.currentTimeMillis())
        for i, name in enumerate(names):
            self.fs.setTimes(self._path(name), start + i, -1)

    def write(self, name: str, text: str) -> None:
        """A file that appears whole or not at all."""
        out = self.fs.create(self._path(f"{name}.part"), True)
        out.write(bytearray(text.encode()))
        out.close()
        self.move(f"{name}.part", name)

    def read(self, name: str) -> str:
        stream = self.fs.open(self._path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()


def _apply(files: TableFiles, path: str, staging: str) -> None:
    """Moves the written files of a merge into the table and deletes those they replace; may be run again."""
    replaced = json.loads(files.read(f"{staging}/_replaced"))
    for name in files.below(f"{staging}/files"):
        files.move(f"{staging}/files/{name}", f"{path}/{name}")
    for uri in replaced:
        files.forget(uri)
    files.delete(staging)


def upsert_path(
    batch: DataFrame,
    path: str,
    keys: Sequence[str] = ("date", "logId"),
    partition: str = "date",
    sequence: str | None = None,
    batch_id: int | str = "batch",
) -> None:
    """Merge a batch into a partitioned Parquet table: update matches, insert the rest.

    Only partitions present in the batch are searched, and of them only files that hold a
    matching row are rewritten, once; all others stay as they are. The batch is staged by
    partition, and some partitions at a time are merged, so that little is shuffled at once.
    New files are written beside the table. When all are there, the list of those they replace is written, files
    are moved in and the replaced ones deleted. A merge that was interrupted before that list
    starts anew when it is run again; one interrupted after it is carried on. Without
    ``sequence`` a key may occur only once in a batch, else the merge fails.
    """
    spark, files = batch.sparkSession, TableFiles(batch.sparkSession, path)
    staging = f"{path}/_staging/{batch_id}"
    if files.exists(f"{staging}/_replaced"):
        return _apply(files, path, staging)
    files.delete(staging)
    # read to find the files and to merge them
    rows = _by_partition(batch, partition, f"{staging}/rows")
    if sequence is None and not rows.groupBy(*keys).count().where("count > 1").isEmpty():
        raise ValueError("several rows of one key in a batch; give a sequence")
    replaced = []
    for folders in files.groups(f"{staging}/rows", GROUP_BYTES):
        part = spark.read.schema(rows.schema).option("basePath", f"{staging}/rows").parquet(*folders)
        replaced += _merge(part, path, f"{staging}/files", keys, partition, sequence)
        for folder in folders:
            files.delete(folder)
    if files.exists(f"{staging}/files"):
        files.write(f"{staging}/_replaced", json.dumps(replaced))
        _apply(files, path, staging)
    else:
        files.delete(staging)


def _by_partition(batch: DataFrame, partition: str, folder: str) -> DataFrame:
    """The batch written by partition, as Parquet, and read back."""
    with shuffles_removed(batch.sparkSession):
        batch.write.option("compression", "zstd").partitionBy(partition).parquet(folder)
    return batch.sparkSession.read.schema(batch.schema).parquet(folder).select(batch.columns)


def _merge(rows: DataFrame, path: str, target_files: str, keys: Sequence[str], partition: str, sequence: str | None) -> list[str]:
    """Writes what some partitions hold after the merge; returns the files that it replaces."""
    spark = rows.sparkSession
    touched = [r[0] for r in rows.select(partition).distinct().collect()]
    merged, replaced = rows if sequence is None else latest_per_key(rows, keys, sequence), []
    target = existing(spark, path, rows.schema)
    if target is not None:
        searched = target.where(F.col(partition).isin(*touched))
        matching = searched.withColumn("__file", F.col("_metadata.file_path")).join(rows.select(*keys), list(keys), "left_semi")
        replaced = [r[0] for r in matching.select("__file").distinct().collect()]
        if replaced:
            rest = searched.where(F.col("_metadata.file_path").isin(*replaced))
            merged = rest.join(rows.select(*keys), list(keys), "left_anti").select(rows.columns).unionByName(merged)
    with shuffles_removed(spark):
        # files by the measured size of each partition
        merged.hint("rebalance", partition).write.mode("append").option("compression", "zstd").partitionBy(partition).parquet(target_files)
    return replaced


def upsert_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str] = ("date", "logId"),
    live: bool = False,
    sequence: str | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Start a stream whose micro-batches are merged into ``path``.

    ``prepare`` runs steps without state on every micro-batch.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        upsert_path(prepare(batch) if prepare else batch, path, keys, sequence=sequence, batch_id=batch_id)

    writer = df.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return with_trigger(writer, live).start()


def with_trigger(writer, live: bool, interval: str = "30 seconds"):
    """Keep running when live, else process what there is and stop."""
    return writer.trigger(processingTime=interval) if live else writer.trigger(availableNow=True)


def drain(query: StreamingQuery, timeout: int | None = None) -> None:
    """Wait for a backfill stream to process everything available.

    Shuffle files of batches that ended go only when the driver collects its garbage, which is asked for now and then.
    """
    began = time.monotonic()
    while not query.awaitTermination(max(1, min(COLLECT_S, timeout - int(time.monotonic() - began)) if timeout else COLLECT_S)):
        if timeout and time.monotonic() - began >= timeout:
            query.stop()
            raise TimeoutError(f"stream still running after {timeout} seconds")
        SparkSession.getActiveSession()._jvm.System.gc()
