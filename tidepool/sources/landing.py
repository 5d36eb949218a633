"""Landing jobs: raw logs and blocks to partitioned tables, discovery of pools and tokens.

Jobs start from rows already fetched; network clients are not part of this package.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.operators.joins import dimension_join
from tidepool.operators.market import EPOCH_LENGTH

# Width of a data word in hex digits, event and template of a factory.
WORD = 64
POOL_EVENT = "PoolCreated"
POOL_TEMPLATE = "Pool"
FACTORIES = ("Factory",)


# -- sources -------------------------------------------------------------------


# The parts of a contract's entry that landing reads.
CONTRACTS = """ARRAY<STRUCT<name: STRING, source: STRUCT<address: STRING, abi: STRING, startBlock: BIGINT>,
    mapping: STRUCT<abis: ARRAY<STRUCT<name: STRING, file: STRING>>, eventHandlers: ARRAY<STRUCT<event: STRING>>>>>"""


def _configured(spark: SparkSession, entries: Sequence[Mapping]) -> DataFrame:
    """Entries of a configuration with the file of the ABI that each names, and its events."""
    texts = spark.createDataFrame([(json.dumps(list(entries)),)], "text string")
    rows = texts.select(F.inline(F.from_json("text", CONTRACTS)))
    own = F.filter("mapping.abis", lambda abi: abi["name"] == F.col("source.abi"))
    return rows.select("name", "source", F.element_at(own, -1)["file"].alias("abi"), F.col("mapping.eventHandlers.event").alias("events"))


def contract_sources(spark: SparkSession, config: Mapping) -> DataFrame:
    """Contracts of a configuration with their ABI file, events and factory flag."""
    return _configured(spark, config["dataSources"]).select(
        "source.address", "source.startBlock", F.col("source.abi").alias("name"), "abi", "events", F.col("source.abi").isin(*FACTORIES).alias("is_factory")
    )


def contract_templates(spark: SparkSession, config: Mapping) -> DataFrame:
    """ABI file and events per template name."""
    return _configured(spark, config["templates"]).select("name", "abi", "events")


def attach_templates(contracts: DataFrame, templates: DataFrame) -> DataFrame:
    """ABI file and events of discovered contracts by template name."""
    return dimension_join(contracts, templates, ["name"], ["address"])


# -- events --------------------------------------------------------------------


def land_events(logs: DataFrame, contracts: DataFrame, topics: Sequence[str], args: Sequence[str] | None = None) -> DataFrame:
    """Logs of known contracts with a wanted first topic, tagged by contract and epoch.

    ``contracts`` has ``address`` and ``contract``. Argument columns, where given,
    become one JSON text so that no integer overflows.
    """
    wanted = logs.where(F.col("topic").isin(*topics))
    known = contracts.select("address", "contract").dropDuplicates(["address"])
    spread = [c for c in ("blockNumber", "logIndex") if c in logs.columns]
    tagged = dimension_join(wanted, known, ["address"], spread or ["topic"]).where(F.col("contract").isNotNull())
    tagged = tagged.withColumn("epoch", epoch_of("blockNumber"))
    if args:
        tagged = tagged.withColumn("args", F.to_json(F.struct(*args))).drop(*args)
    return tagged


def epoch_of(block: str | Column) -> Column:
    block = F.col(block) if isinstance(block, str) else block
    return F.floor(block / EPOCH_LENGTH).cast("int")


def write_partitioned(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Overwrite just the partitions present in ``df``.

    Rows are rebalanced by partition: adaptive execution splits a large one over tasks
    and joins small ones, by their measured size.
    """
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*by)
        .parquet(path)
    )


# A word is read in parts of fifteen hex digits; decimal limbs hold 18 digits, so a product fits a decimal and its carry a long.
_PART_HEX, _PARTS, _LIMB_DIGITS, _LIMBS = 15, 5, 18, 5
_LIMB_TYPE = "decimal(20,0)"


def _whole(n: int) -> Column:
    return F.lit(str(n)).cast(f"decimal({len(str(n))},0)")


def _appended(limbs: Column, part: Column) -> Column:
    """Limbs of ``2^60 * value + part``; the carry of a limb goes into the next."""
    base, carry, out = _whole(10**_LIMB_DIGITS), part, []
    for i in range(_LIMBS):
        total = (limbs[f"l{i}"] * _whole(1 << 4 * _PART_HEX) + carry).cast("decimal(38,0)")
        out.append((total % base).cast(_LIMB_TYPE).alias(f"l{i}"))
        carry = F.call_function("div", total, base).cast(_LIMB_TYPE)
    return F.struct(*out)


def _digits(limbs: Column) -> Column:
    padded = F.concat(*(F.lpad(limbs[f"l{i}"].cast("string"), _LIMB_DIGITS, "0") for i in reversed(range(_LIMBS))))
    return F.regexp_replace(padded, "^0+(?=.)", "")


def word_number(word: Column, signed: bool) -> Column:
    """Decimal text of a word of up to 256 bits in hex, native: two's complement where ``signed``; NULL for an empty word."""
    clean = F.when(word.rlike("^[0-9a-fA-F]+$"), F.lpad(F.lower(word), WORD, "0")).when(word != "", F.raise_error(F.lit("a data word isn't hex")).cast("string"))

    def number(w: Column) -> Column:
        negative = w >= "8" if signed else F.lit(False)
        # a negative number's size is the complement and one
        size = F.when(negative, F.translate(w, "0123456789abcdef", "fedcba9876543210")).otherwise(w)
        size = F.lpad(size, _PARTS * _PART_HEX, "0")
        last = _PARTS - 1

        def part(k: Column) -> Column:
            value = F.conv(size.substr(k * _PART_HEX + 1, F.lit(_PART_HEX)), 16, 10).cast(_LIMB_TYPE)
            return (value + F.when(negative & (k == last), 1).otherwise(0)).cast(_LIMB_TYPE)

        nothing = F.struct(*(F.lit(0).cast(_LIMB_TYPE).alias(f"l{i}") for i in range(_LIMBS)))
        text = _digits(F.aggregate(F.transform(F.sequence(F.lit(0), F.lit(last)), part), nothing, _appended))
        return F.when(w.isNotNull(), F.concat(F.when(negative, "-").otherwise(""), text))

    whole = F.transform(F.array(clean), number)[0]  # the array names the word, so that it is cut out once
    # most numbers lie in the last part; what is left out before it is all sign
    head, tail = WORD - _PART_HEX, rf"[0-9a-fA-F]{{{_PART_HEX}}}$"
    last_part = F.conv(word.substr(head + 1, _PART_HEX), 16, 10).cast("bigint")
    short = F.when(word.rlike(rf"^0{{{head}}}{tail}"), last_part.cast("string"))
    if signed:
        short = short.when(word.rlike(rf"^[fF]{{{head}}}{tail}"), (last_part - (1 << 4 * _PART_HEX)).cast("string"))
    return short.otherwise(whole)


def decode_words(data: str | Column, fields: Mapping[str, str]) -> Column:
    """Struct of 256-bit words of hex event data as decimal text.

    ``fields`` maps a name to ``int`` (two's complement), ``uint`` or ``address``. Nothing leaves the JVM.
    """
    data = F.col(data) if isinstance(data, str) else data
    body = F.regexp_replace(data, "^0x", "")
    return F.struct(
        *(
            (word_address(data, i) if kind == "address" else word_number(F.substring(body, i * WORD + 1, WORD), kind == "int")).alias(name)
            for i, (name, kind) in enumerate(fields.items())
        )
    )


def word_address(data: Column, index: int) -> Column:
    """Address in the low 20 bytes of a data word."""
    body = F.regexp_replace(data, "^0x", "")
    return F.concat(F.lit("0x"), F.substring(body, index * WORD + 25, 40))


# -- discovery -------------------------------------------------------------------


def discover_pools(factory_events: DataFrame, epoch: int, lookahead: DataFrame | None = None) -> DataFrame:
    """Pools created before ``epoch`` and, where given, in the epoch's look-ahead."""
    created = factory_events.where((F.col("event") == POOL_EVENT) & (F.col("epoch") < epoch)).select("args", "blockNumber")
    if lookahead is not None:
        created = created.unionByName(lookahead.select("args", "blockNumber"))
    address = F.get_json_object("args", "$.pool")
    return created.select(
        address.alias("address"), F.col("blockNumber").alias("startBlock"), F.lit(POOL_TEMPLATE).alias("name")
    ).where(F.col("address").isNotNull())


def start_epoch(contracts: DataFrame) -> DataFrame:
    """First epoch holding any contract's start block."""
    return contracts.agg(epoch_of(F.min("startBlock")).alias("epoch"))


def hash_partition(df: DataFrame, key: str, n: int) -> DataFrame:
    """Worker number of each key among ``n``."""
    return df.withColumn("worker", F.pmod(F.hash(key), F.lit(n)))


def discover_tokens(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Distinct values of plain columns and of ``args.x`` JSON fields."""
    picked = [F.get_json_object(f.split(".", 1)[0], "$." + f.split(".", 1)[1]) if "." in f else F.col(f) for f in fields]
    return df.select(F.explode(F.array(*picked)).alias("address")).where(F.col("address").isNotNull()).distinct()


def token_metadata(addresses: DataFrame, looked_up: DataFrame) -> DataFrame:
    """Symbol and decimals per token; failed look-ups give the address and 0."""
    joined = dimension_join(addresses, looked_up.select("address", "symbol", "decimals"), ["address"], ["address"])
    return joined.select(
        "address",
        F.coalesce("symbol", "address").alias("symbol"),
        F.coalesce("decimals", F.lit(0)).cast("int").alias("decimals"),
    )


# -- blocks ------------------------------------------------------------------------


def land_blocks(blocks: DataFrame) -> DataFrame:
    """Blocks with their transactions nested, wide integers as text, tagged by epoch."""
    element = blocks.schema["transactions"].dataType.elementType
    as_text = F.transform(
        "transactions",
        lambda t: F.struct(
            *(
                (t[f.name].cast("string") if f.name == "value" else t[f.name]).alias(f.name)
                for f in element.fields
            )
        ),
    )
    return blocks.withColumns(
        {
            "totalDifficulty": F.col("totalDifficulty").cast("string"),
            "transactions": as_text,
            "epoch": epoch_of("number"),
        }
    )


# -- progress ------------------------------------------------------------------------


def next_epoch(markers: DataFrame, epoch: int) -> DataFrame:
    """First epoch from ``epoch`` on that is not yet safely behind the chain head.

    ``markers`` has ``epoch`` and ``last_block``; an epoch is skipped while its last
    marker is at least two epochs ahead. The run of skipped epochs ends at the first
    gap.
    """
    ahead = EPOCH_LENGTH * (F.col("epoch").cast("bigint") + 2)  # blocks outgrow the type of epochs
    done = (
        markers.groupBy("epoch")
        .agg(F.max("last_block").alias("last_block"))
        .where((F.col("epoch") >= epoch) & (F.col("last_block") >= ahead))
    )
    # the first epoch whose predecessor is done while it is not
    after = done.select((F.col("epoch") + 1).alias("epoch"))
    starts = done.sparkSession.range(1).select(F.lit(epoch).cast(markers.schema["epoch"].dataType).alias("epoch"))
    candidates = reduce(lambda a, b: a.unionByName(b), [starts, after]).join(done.select("epoch"), "epoch", "left_anti")
    return candidates.agg(F.min("epoch").alias("epoch"))
