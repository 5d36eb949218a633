"""Container logs and operation profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.functions.scalars import ubi_parse
from tidepool.operators.slicing import carry_last

# Log table, profile records and the line form of container logs.
LOG_SCHEMA = (
    "log STRING, time TIMESTAMP, stream STRING, "
    "kubernetes STRUCT<pod_name: STRING, labels: STRUCT<app: STRING, `spark-role`: STRING>>"
)
_PART_SIZES = "STRUCT<den: STRUCT<b: BIGINT, p: BIGINT>, num: STRUCT<b: BIGINT, p: BIGINT>>"
PROFILE_SCHEMAS = {
    "op": f"STRUCT<child: {_PART_SIZES}, left: {_PART_SIZES}, ns: BIGINT, op: STRING, right: {_PART_SIZES}, t1: BIGINT, t2: BIGINT, t3: BIGINT>",
    "operate": "STRUCT<fn: STRING, ns: BIGINT, t1: BIGINT, t2: BIGINT>",
    "scale": "STRUCT<fn: STRING, ns: BIGINT, t1: BIGINT>",
    "scale2": "STRUCT<fn: STRING, ns: BIGINT, scale: BIGINT, t1: BIGINT, t2: BIGINT>",
    "gcd": "STRUCT<compute: BIGINT, gcd: BIGINT, search: BIGINT>",
    "resolve": f"STRUCT<arg: {_PART_SIZES}, fn: STRING, ns: BIGINT, t1: BIGINT, t2: BIGINT, t3: BIGINT>",
}
PROFILE_PATTERNS = {
    "op": '%"op"%',
    "operate": '%"fn":"operate"%',
    "scale": '%"fn":"scale"%',
    "scale2": '%"fn":"scale2"%',
    "gcd": '%"gcd"%',
    "resolve": '%"resolve"%',
}
LINE_FORM = r"^([^ ]+) (stdout|stderr) ([^ ]*) (.*)$"


def log_table(spark: SparkSession, path: str, view: str = "log") -> DataFrame:
    """JSON logs as a frame and a temporary view for SQL."""
    df = spark.read.schema(LOG_SCHEMA).json(path)
    df.createOrReplaceTempView(view)
    return df


def declare_log_table(spark: SparkSession, path: str, view: str = "log", corrupt: str = "corrupt") -> DataFrame:
    """The log table declared in DDL over JSON files; lines that aren't JSON come back whole in ``corrupt``."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY VIEW {view} ({LOG_SCHEMA}, {corrupt} STRING) USING json "
        f"OPTIONS (path '{path}', mode 'PERMISSIVE', columnNameOfCorruptRecord '{corrupt}')"
    )
    return spark.table(view)


def pods(logs: DataFrame, like: str) -> DataFrame:
    """Pods whose name matches, with their labels, number of lines and first time."""
    return (
        logs.where(F.col("kubernetes.pod_name").like(like))
        .groupBy(
            F.col("kubernetes.pod_name").alias("pod_name"),
            F.col("kubernetes.labels.app").alias("app"),
            F.col("kubernetes.labels.`spark-role`").alias("role"),
        )
        .agg(F.count(F.lit(1)).alias("logs"), F.min("time").alias("start_time"))
        .orderBy(F.desc("logs"), "pod_name")
    )


def executor_of(pod_name: Column) -> Column:
    """Executor number: the sixth dash-separated part of a pod name, NULL where there is none."""
    return F.get(F.split(pod_name, "-"), F.lit(5))


def matching_lines(logs: DataFrame, pod_like: str, line_like: str) -> DataFrame:
    """Lines of one run's executors that match; limit them as wanted."""
    return logs.where(F.col("kubernetes.pod_name").like(pod_like) & F.col("log").like(line_like)).select(
        executor_of(F.col("kubernetes.pod_name")).alias("exec"), "log"
    )


def profile_records(logs: DataFrame, pod_like: str, kind: str) -> DataFrame:
    """Profile lines of one kind as columns: prefix stripped, JSON parsed."""
    raw = logs.where(F.col("kubernetes.pod_name").like(pod_like) & F.col("log").like("%{%}%")).select(
        executor_of(F.col("kubernetes.pod_name")).alias("exec"),
        F.regexp_replace("log", "^.+INFO root: ", "").alias("payload"),
    )
    parsed = raw.where(F.col("payload").like(PROFILE_PATTERNS[kind])).select(
        "exec", F.from_json("payload", PROFILE_SCHEMAS[kind]).alias("record")
    )
    return parsed.select("exec", "record.*")


def cache_as(df: DataFrame, name: str) -> DataFrame:
    """Keep a projection in memory under a view name."""
    cached = df.cache()
    cached.createOrReplaceTempView(name)
    return cached


def cache_lazily(df: DataFrame, name: str) -> DataFrame:
    """Keep a projection under a table name; it is computed when first read, and later plans read the copy."""
    spark, source = df.sparkSession, f"{name}_source"
    df.createOrReplaceTempView(source)
    spark.sql(f"CACHE LAZY TABLE {name} AS SELECT * FROM {source}")
    return spark.table(name)


def operation_costs(profile: DataFrame) -> DataFrame:
    """Number, total and mean cost per operation, dearest first."""
    return (
        profile.groupBy("op")
        .agg(F.count(F.lit(1)).alias("ops"), F.sum("ns").alias("total_ns"), F.avg("ns").alias("avg_ns"))
        .orderBy(F.desc("total_ns"), "op")
    )


def phase_costs(profile: DataFrame, op: str) -> DataFrame:
    """Mean cost of the phases of one operation."""
    return profile.where(F.col("op") == op).agg(*(F.avg(t).alias(f"avg_{t}") for t in ("t1", "t2", "t3")))


def operand_sizes(df: DataFrame, *columns: str) -> DataFrame:
    """Digits, scale and bits of both parts of fraction columns, as columns."""
    sizes = {}
    for c in columns:
        f = ubi_parse(c)
        for prefix, part in (("num", ""), ("den", "d")):
            sizes[f"{c}_{prefix}_digits"] = F.length(F.ltrim(f[f"{part}n"], F.lit("-")))
            sizes[f"{c}_{prefix}_scale"] = f[f"{part}s"]
            sizes[f"{c}_{prefix}_bits"] = f[f"{part}b"]
    return df.withColumns(sizes)


def parse_container_lines(lines: DataFrame, column: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Container log lines in JSON or plain form as ``time, stream, log, date``."""
    line = F.col(column)
    as_json = F.from_json(line, "log STRING, stream STRING, time TIMESTAMP")
    plain_time = F.try_to_timestamp(F.nullif(F.regexp_extract(line, LINE_FORM, 1), F.lit("")))
    is_json = line.startswith("{")
    return lines.select(
        *keep,
        F.when(is_json, as_json["time"]).otherwise(plain_time).alias("time"),
        F.when(is_json, as_json["stream"]).otherwise(F.nullif(F.regexp_extract(line, LINE_FORM, 2), F.lit(""))).alias("stream"),
        F.when(is_json, as_json["log"]).otherwise(F.regexp_extract(line, LINE_FORM, 4)).alias("log"),
    ).withColumn("date", F.to_date("time"))


def counter_rates(
    samples: DataFrame, series: list[str], by: list[str], seconds: int = 30, slices: int | None = None
) -> DataFrame:
    """Per-second increase of counters per time window, summed over series.

    ``samples`` has the series columns, ``time`` and ``value``. A drop in value is a
    counter reset: the new value is the increase.
    """
    before = carry_last(samples, series, ["time"], F.col("value"), "__before", slices)
    rise = F.when(F.col("__before").isNull(), F.lit(0.0)).when(
        F.col("value") < F.col("__before"), F.col("value")
    ).otherwise(F.col("value") - F.col("__before"))
    window = F.window("time", f"{seconds} seconds")
    return (
        before.groupBy(window.alias("window"), *by)
        .agg((F.sum(rise) / seconds).alias("rate"))
        .select(F.col("window.start").alias("start"), *by, "rate")
    )


def latest_gauges(samples: DataFrame, series: list[str], by: list[str], negate: bool = False) -> DataFrame:
    """Sum over series of each series' latest value; ``negate`` plots an outflow below zero."""
    latest = samples.groupBy(*dict.fromkeys([*series, *by])).agg(F.max_by("value", "time").alias("value"))
    total = F.sum("value")
    return latest.groupBy(*by).agg((-total if negate else total).alias("value"))


