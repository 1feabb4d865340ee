"""The running jobs: count votes tick by tick, and keep the reports fresh."""

import time

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.counting import count_votes, national_totals, seed_totals
from ..operators.flushing import HELD, carry_flushes, flush_partials
from ..operators.latency import latency_rows
from ..operators.reporting import map_table, winners
from ..operators.validity import classified_votes, valid_votes
from ..schema import PARTIAL, TICK_SECONDS
from ..sources.states import states_df
from .ledger import (
    compact_latencies,
    compact_ledger,
    compact_sketches,
    files_for,
    read_held,
    write_held,
    write_latencies,
    write_partials,
    write_rejects,
    write_report,
    write_sketches,
)

# One micro-batch is one tick, whatever the clock says, when votes are cut by count.
_ONE_TICK_US = 1 << 62


# The running totals of the reports have a row per listed state, and a state store each.
FEW_PARTITIONS = 8
_PARTITIONS = "spark.sql.shuffle.partitions"

#: Micro-batches between two compactions.
COMPACT_EVERY = 100
#: The k of quantile sketches: a rank is off by 0.87% at most, 99 times of 100.
SKETCH_SIZE = 400


def _start(
    writer,
    spark: SparkSession,
    checkpoint: str,
    tick_seconds: int,
    available_now: bool,
    partitions: int | None,
) -> StreamingQuery:
    """Start a query. It keeps a copy of the settings it is started under."""
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{tick_seconds} seconds")
    usual = spark.conf.get(_PARTITIONS)
    spark.conf.set(_PARTITIONS, usual if partitions is None else partitions)
    try:
        return writer.option("checkpointLocation", checkpoint).start()
    finally:
        spark.conf.set(_PARTITIONS, usual)


def start_counting(
    votes: DataFrame,
    ledger: str,
    latencies: str,
    checkpoint: str,
    tick_seconds: int = TICK_SECONDS,
    cap: int | None = None,
    rejects: str | None = None,
    states: DataFrame | None = None,
    available_now: bool = False,
    partitions: int | None = None,
    held: str | None = None,
    trigger_seconds: int | None = None,
    compact_every: int = COMPACT_EVERY,
    sketches: str | None = None,
    sketch_size: int = SKETCH_SIZE,
) -> StreamingQuery:
    """Count a stream of votes into ``ledger``, one flush per micro-batch.

    Each micro-batch is a tick: its counts per (stream, state) are written, and a
    state without votes has no row. With a ``cap`` a count is also closed
    whenever it holds ``cap + 1`` votes, in order of arrival (of event time where the
    votes have no ``arrival_us``). How long each count took since its newest vote goes to
    ``latencies``, votes that cannot be counted go to ``rejects`` if given.

    With a path ``held`` counters outlive the micro-batch, which may then be shorter than a tick
    (``trigger_seconds``): a count is closed when it holds ``cap + 1`` votes, over however many
    micro-batches they came, and with the first micro-batch of a later tick. What counters hold is kept at
    the path and not yet in ``ledger``. An input that pauses leaves votes held until it goes on.

    With a path ``sketches`` each micro-batch also leaves a quantile sketch of its latencies per stream there, which
    ``live_summary`` reports from, however long the log is.

    Every ``compact_every`` micro-batches the folders of those before are merged.

    No watermark is involved: a vote counts however late it is. ``partitions`` of shuffles are
    those of the session unless given; a stream keeps the number it was first started with.
    """

    if held is not None and cap is None:
        raise ValueError("counters hold votes up to a cap; without one every micro-batch is a tick")

    def flush(batch: DataFrame, batch_id: int) -> None:
        count(batch, batch_id)
        # The engine has committed all batches before this one.
        if batch_id and batch_id % compact_every == 0:
            compact_ledger(batch.sparkSession, ledger, batch_id - 1)
            compact_latencies(batch.sparkSession, latencies, batch_id - 1)
            if sketches is not None:
                compact_sketches(batch.sparkSession, sketches, batch_id - 1)

    def count(batch: DataFrame, batch_id: int) -> None:
        if rejects is None and cap is None:
            write(valid_votes(batch, states), None, batch_id)
            return
        # Votes are needed more than once, so they are parsed and told apart once.
        told = classified_votes(batch, states).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            turned_away = told.where(F.col("reason").isNotNull())
            kept = [c for c in batch.columns if c not in ("malformed", "line", "event_time")]
            write(told.where(F.col("reason").isNull()).select(*kept), turned_away, batch_id)
        finally:
            told.unpersist()

    def write(counted_votes: DataFrame, turned_away, batch_id: int) -> None:
        if held is None:
            counted = _count_tick(counted_votes, cap).persist()
        else:
            counted = _count_held(counted_votes, cap, held, batch_id, tick_seconds).persist()
        try:
            files = files_for(counted.count())
            # The clock is read after counting, when this next query is planned.
            arrived = counted.withColumn("time_us", F.unix_micros(F.current_timestamp()))
            write_times(latency_rows(arrived), batch_id, files)
            write_partials(counted, batch_id, ledger, files)
            if rejects is not None:
                write_rejects(turned_away, batch_id, rejects)
        finally:
            counted.unpersist()

    def write_times(timed: DataFrame, batch_id: int, files: int) -> None:
        if sketches is None:
            write_latencies(timed, batch_id, latencies, files)
            return
        timed.persist()  # the log and the sketches tell of one reading of the clock
        try:
            write_latencies(timed, batch_id, latencies, files)
            write_sketches(timed, batch_id, sketches, sketch_size)
        finally:
            timed.unpersist()

    return _start(
        votes.writeStream.foreachBatch(flush),
        votes.sparkSession,
        checkpoint,
        tick_seconds if trigger_seconds is None else trigger_seconds,
        available_now,
        partitions=partitions,
    )


def _count_tick(votes: DataFrame, cap: int | None) -> DataFrame:
    if cap is None:
        return count_votes(votes, ["stream", "state"])
    return flush_partials(_arrived(votes), _ONE_TICK_US, cap)


def _arrived(votes: DataFrame) -> DataFrame:
    if "arrival_us" in votes.columns:
        return votes
    return votes.withColumn("arrival_us", F.col("event_us"))


def _count_held(votes: DataFrame, cap: int, path: str, batch_id: int, tick_seconds: int) -> DataFrame:
    """The counts that are closed in this micro-batch; the others are held."""
    spark = votes.sparkSession
    before = read_held(spark, path, batch_id - 1)
    tick = F.lit(int(time.time()) // tick_seconds).cast("bigint") if tick_seconds else F.lit(0).cast("bigint")
    over = F.col("tick") < tick
    flushed, rest = carry_flushes(_arrived(votes), before.where(~over).select(*HELD), cap)
    write_held(rest.select(*HELD, tick.alias("tick")), batch_id, path)
    return flushed.unionByName(before.where(over).select(*HELD)).select(*PARTIAL.fieldNames())


def start_reporting(
    votes: DataFrame,
    reports: str,
    checkpoint: str,
    tick_seconds: int = TICK_SECONDS,
    states: DataFrame | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Keep ``winners``, ``national`` and ``map`` below ``reports`` up to date.

    The running totals are the query's own state, one row per state, so a refresh
    costs the same however long the stream has been running.
    """
    listed = states_df(votes.sparkSession) if states is None else states

    def refresh(totals: DataFrame, batch_id: int) -> None:
        seeded = seed_totals(listed, totals).persist()
        try:
            write_report(winners(seeded), batch_id, f"{reports}/winners")
            write_report(national_totals(seeded), batch_id, f"{reports}/national")
            write_report(map_table(seeded), batch_id, f"{reports}/map")
        finally:
            seeded.unpersist()

    running = count_votes(valid_votes(votes, states), ["state"])
    writer = running.writeStream.outputMode("complete").foreachBatch(refresh)
    return _start(
        writer, votes.sparkSession, checkpoint, tick_seconds, available_now, FEW_PARTITIONS
    )
