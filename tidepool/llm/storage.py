"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``; a local session without one gets a temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="corpus-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Whether a query's shuffle files go when it ends; else they stay until the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: later plans start from files, not lineage."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of texts or ids that one Arrow batch holds; a worker holds a few batches at a time.
BATCH_BYTES = "8m"


def bounded_batches(spark: SparkSession) -> None:
    """Cuts Arrow batches by bytes, as ten thousand long texts in one would fill a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def row_hash(*columns: str) -> Column:
    """128 bits that tell rows apart by ``columns``, NULLs told from empty texts."""
    parts = [F.coalesce(F.concat(F.octet_length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-")) for c in columns]
    return F.unhex(F.md5(F.concat(*parts).cast("binary")))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it, in whatever case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def joined_tables(spark: SparkSession, parts: list[DataFrame], schema: str) -> DataFrame:
    """Written tables of one schema as one; their files are read in a single scan."""
    files = [f for part in parts for f in part.inputFiles()]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
