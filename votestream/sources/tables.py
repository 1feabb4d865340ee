"""Votes derived from the star-schema tables, for queries, tests and benchmarks."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import micros_of_timestamp, vote_id
from ..schema import STATES
from .backlog import read_bounded

# Two codes outside the state list, so that some votes must be turned away.
CODES = STATES + ("DC", "PR")
FIRST_STREAM = 5555


# The columns read here, so that opening a table needs no look into its files.
EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"
LINES = (
    "l_orderkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_linestatus string, l_shipdate timestamp_ntz"
)


def _pick(codes, column: str) -> Column:
    """The code a number stands for, counting around the list."""
    listed = ", ".join(f"'{code}'" for code in codes)
    return F.expr(f"element_at(array({listed}), cast({column} % {len(codes)} + 1 as int))")


def votes_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One vote per event: two streams, all states, some unknown states and parties."""
    return _votes_of(spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet"))


def vote_stream_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same votes as a stream."""
    # A pattern, as a stream does not take the name of a single file.
    return _votes_of(spark.readStream.schema(EVENTS).parquet(f"{sf_dir}/events.parque[t]"))


def bounded_stream_view(spark: SparkSession, sf_dir: str, rows: int) -> DataFrame:
    """The same votes as a stream that takes in so many rows at a time."""
    return _votes_of(read_bounded(spark, f"{sf_dir}/events.parquet", rows, EVENTS))


def party_flags_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Votes whose party is still a flag, 0 or 1."""
    events = spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")
    return events.select("event_id", (F.col("user_id") % 2).alias("flag"))


def _votes_of(events: DataFrame) -> DataFrame:
    stream = F.lit(FIRST_STREAM) + F.col("event_id") % 2
    kind = F.col("event_type")
    event_us = micros_of_timestamp("ts")
    return events.select(
        vote_id(stream, F.expr("event_id div 2")).alias("id"),
        stream.alias("stream"),
        _pick(CODES, "user_id").alias("state"),
        F.when(kind.isin("click", "purchase"), "D").when(kind == "error", "I").otherwise("R")
        .alias("party"),
        event_us.alias("event_us"),
        (event_us + F.rint(F.col("value") * 1000).cast("bigint")).alias("arrival_us"),
    )


def repeated_votes_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One vote per order line; many ids occur more than once."""
    lines = spark.read.schema(LINES).parquet(f"{sf_dir}/lineitem.parquet")
    event_us = micros_of_timestamp("l_shipdate")
    return lines.select(
        vote_id("l_orderkey", "l_linenumber").alias("id"),
        _pick(STATES, "l_suppkey").alias("state"),
        F.when(F.col("l_linestatus") == "F", "D").otherwise("R").alias("party"),
        event_us.alias("event_us"),
        (event_us + (F.col("l_quantity") * 1000).cast("bigint")).alias("arrival_us"),
    )
