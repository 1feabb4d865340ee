"""The named queries: each takes a session and a folder of tables.

Queries over flushes use a tick of a day and a cap of two votes. The tables span
a month with few votes per state, so that both kinds of flush occur.
"""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import encode_party, seconds_of_micros
from ..operators import (
    attach,
    by_run,
    count_votes,
    dedup_stream,
    dedup_votes,
    flush_partials,
    in_micros,
    in_seconds,
    ingest_audit,
    latency_histogram,
    latency_points,
    latency_rows,
    latency_summary,
    map_table,
    materialise,
    merge_partials,
    missing_ranges,
    national_totals,
    rejected_votes,
    seed_totals,
    trim_warmup,
    valid_votes,
    votes_by_stream_and_state,
    winners,
)
from ..operators.latency import quantile_name
from ..schema import MICROS, QUANTILES, TICK_SECONDS, flush_cap, row_budget
from ..session import scratch_path
from ..sources import (
    bounded_stream_view,
    encode_votes,
    export_latencies,
    parse_votes,
    party_flags_view,
    read_latencies,
    repeated_votes_view,
    states_df,
    vote_stream_view,
    votes_view,
)
from ..sources.latencies import run_path
from ..sources.tables import FIRST_STREAM
from ..streaming import (
    last_committed,
    live_summary,
    read_held,
    read_latency_log,
    read_ledger,
    read_report,
    read_sketches,
    read_totals,
    roll_up,
    start_counting,
    start_reporting,
    write_partials,
)

DAY_US = 86_400_000_000
CAP = 2
RUN = ["stream"]
# Votes of every seventh day have no id in the query that drops repetitions.
NO_ID = 7 * DAY_US

# Micro-batches of the queries that take in so many rows at a time.
STEPS, FEW_STEPS = 6, 3
# Counters that hold up to so many votes over several micro-batches.
WIDE_CAP = 9
# How far the rank of a quantile from sketches may be off.
SKETCH_ERROR = 0.02

# A run's settings, for the query that takes them from a file path.
NODES, RATE = 2, 30_000

# Settings of the two runs of the run report, by stream.
RUNS = {FIRST_STREAM: (1, 22_000), FIRST_STREAM + 1: (2, 30_000)}


# --- totals ------------------------------------------------------------------


def state_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = count_votes(valid_votes(votes_view(spark, sf_dir)))
    return counted.select(
        "state", "Dvotes", "Rvotes", seconds_of_micros("event_us").alias("time")
    )


def state_totals_full(spark, sf_dir):
    return seed_totals(states_df(spark), count_votes(valid_votes(votes_view(spark, sf_dir))))


def winners_by_state(spark, sf_dir):
    return winners(state_totals_full(spark, sf_dir))


def national(spark, sf_dir):
    return national_totals(state_totals_full(spark, sf_dir))


def state_map(spark, sf_dir):
    return map_table(state_totals_full(spark, sf_dir))


# --- votes -------------------------------------------------------------------


def valid(spark, sf_dir):
    return valid_votes(votes_view(spark, sf_dir)).select(
        "id", "stream", "state", "party", "event_us", "arrival_us"
    )


def rejects(spark, sf_dir):
    return rejected_votes(votes_view(spark, sf_dir))


def json_roundtrip(spark, sf_dir):
    votes = votes_view(spark, sf_dir)
    return valid_votes(parse_votes(encode_votes(votes))).select(
        "id", "stream", "state", "party", "event_us"
    )


def dedup(spark, sf_dir):
    """Some votes have lost their id; none of those is a repetition of another."""
    lost = F.col("event_us") % NO_ID == 0
    votes = repeated_votes_view(spark, sf_dir)
    return dedup_votes(votes.withColumn("id", F.when(~lost, F.col("id"))))


def bad_times(spark, sf_dir):
    """Rejects of votes some of which are pushed out of the range of times."""
    votes = votes_view(spark, sf_dir)
    far = F.when(F.col("event_us") % 3 == 0, 1 << 62).when(F.col("event_us") % 3 == 1, -(1 << 62))
    return rejected_votes(votes.withColumn("event_us", F.coalesce(far, "event_us")))


def party_codes(spark, sf_dir):
    return party_flags_view(spark, sf_dir).select("event_id", encode_party("flag").alias("party"))


def audit(spark, sf_dir):
    return ingest_audit(votes_view(spark, sf_dir), row_budget(RATE, NODES))


def missing(spark, sf_dir):
    """The row numbers of votes that were turned away, found as gaps among the others."""
    return missing_ranges(valid_votes(votes_view(spark, sf_dir)))


def audit_by_state(spark, sf_dir):
    return votes_by_stream_and_state(votes_view(spark, sf_dir))


# --- flushes -----------------------------------------------------------------


def partials(spark, sf_dir):
    return flush_partials(valid_votes(votes_view(spark, sf_dir)), DAY_US, CAP)


def partials_json(spark, sf_dir):
    """The same from JSON text, with the time of arrival carried beside it."""
    lines = encode_votes(votes_view(spark, sf_dir), ["arrival_us"])
    return flush_partials(valid_votes(parse_votes(lines)), DAY_US, CAP)


def partials_default(spark, sf_dir):
    """The flushes of the default settings."""
    votes = valid_votes(votes_view(spark, sf_dir))
    return flush_partials(votes, TICK_SECONDS * MICROS, flush_cap(RATE, NODES))


def merged_partials(spark, sf_dir):
    return merge_partials(partials(spark, sf_dir))


def ledger_totals(spark, sf_dir):
    ledger = scratch_path(spark, "ledger")
    flushed = materialise(partials(spark, sf_dir))
    for batch_id in (0, 1, 1):  # the last one is a replay
        write_partials(flushed.where(F.col("batch") % 2 == batch_id), batch_id, ledger)
    return read_totals(spark, ledger)


# --- latencies ---------------------------------------------------------------


def latencies(spark, sf_dir):
    return in_seconds(latency_rows(partials(spark, sf_dir)))


def _latencies(spark, sf_dir) -> DataFrame:
    """Statistics pass over the latencies more than once, the flushes are found only once."""
    return materialise(latency_rows(partials(spark, sf_dir)))


def summary(spark, sf_dir):
    return latency_summary(_latencies(spark, sf_dir), RUN)


def trimmed(spark, sf_dir):
    kept = trim_warmup(_latencies(spark, sf_dir), RUN)
    return in_seconds(kept.select("stream", "state", "tick", "batch", "time_us", "latency_us"))


def trimmed_summary(spark, sf_dir):
    return latency_summary(trim_warmup(_latencies(spark, sf_dir), RUN), RUN)


def histogram(spark, sf_dir):
    return latency_histogram(trim_warmup(_latencies(spark, sf_dir), RUN), RUN)


def points(spark, sf_dir):
    return latency_points(trim_warmup(_latencies(spark, sf_dir), RUN), RUN)


def csv_roundtrip(spark, sf_dir):
    folder = scratch_path(spark, "latencies")
    export_latencies(
        in_seconds(_latencies(spark, sf_dir)), run_path(folder, NODES, RATE)
    )
    return read_latencies(spark, f"{folder}/*nodes/*.res")


def run_summary(spark, sf_dir):
    """The report over the logs of several runs, read back from their files."""
    folder = scratch_path(spark, "runs")
    logged = in_seconds(_latencies(spark, sf_dir))
    for stream, (nodes, rate) in RUNS.items():
        own = logged.where(F.col("stream") == stream)
        export_latencies(own, run_path(folder, nodes, rate))
    log = in_micros(read_latencies(spark, f"{folder}/*nodes/*.res"))
    return by_run(latency_summary(log, ["nodes", "rate"]))


# --- streams -----------------------------------------------------------------


def _streamed(spark, sf_dir) -> DataFrame:
    """Votes as JSON text, made and parsed again within the stream."""
    lines = encode_votes(vote_stream_view(spark, sf_dir), ["arrival_us"])
    return parse_votes(lines)


def _counted(spark, sf_dir) -> str:
    out = scratch_path(spark, "counting")
    start_counting(
        _streamed(spark, sf_dir),
        ledger=f"{out}/ledger",
        latencies=f"{out}/latencies",
        checkpoint=f"{out}/checkpoint",
        rejects=f"{out}/rejects",
        available_now=True,
    ).awaitTermination()
    return out


def stream_totals(spark, sf_dir):
    return read_totals(spark, f"{_counted(spark, sf_dir)}/ledger")


def stream_latencies(spark, sf_dir):
    """The log of a stream: which counts it has. How long they took is the clock's matter."""
    log = read_latency_log(spark, f"{_counted(spark, sf_dir)}/latencies")
    newest = (F.col("time_us") - F.col("latency_us")).alias("event_us")
    return log.select("stream", "state", newest, (F.col("latency_us") > 0).alias("later"))


def stream_rejects(spark, sf_dir):
    rejected = spark.read.parquet(f"{_counted(spark, sf_dir)}/rejects")
    return rejected.select("id", "state", "event_us", "arrival_us", "reason")


def _rows_of(spark, sf_dir, parts: int) -> int:
    """The rows of a micro-batch that takes this part of the votes."""
    return -(-votes_view(spark, sf_dir).count() // parts)


def _in_steps(spark, votes, **more) -> str:
    """Counts a stream to its end, in as many micro-batches as its source makes of it."""
    out = scratch_path(spark, "steps")
    query = start_counting(
        votes,
        ledger=f"{out}/ledger",
        latencies=f"{out}/latencies",
        checkpoint=f"{out}/checkpoint",
        trigger_seconds=0,
        **{k: f"{out}/{v}" if k in ("held", "sketches") else v for k, v in more.items()},
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return out


def stream_bounded(spark, sf_dir):
    """What each micro-batch counted of a stream that takes in so many rows at a time."""
    votes = bounded_stream_view(spark, sf_dir, _rows_of(spark, sf_dir, STEPS))
    ledger = read_ledger(spark, f"{_in_steps(spark, votes)}/ledger")
    return ledger.groupBy("batch_id").agg(F.sum("Dvotes").alias("Dvotes"), F.sum("Rvotes").alias("Rvotes"))


def ledger_compacted(spark, sf_dir):
    """Totals of a ledger whose old batches have been merged while it was written."""
    votes = bounded_stream_view(spark, sf_dir, _rows_of(spark, sf_dir, STEPS))
    return read_totals(spark, f"{_in_steps(spark, votes, compact_every=2)}/ledger")


def stream_quantiles(spark, sf_dir):
    """Whether the report from sketches, merged while they are written, agrees with the log it does not read."""
    votes = bounded_stream_view(spark, sf_dir, _rows_of(spark, sf_dir, STEPS))
    out = _in_steps(spark, votes, compact_every=2, sketches="sketches")
    log = read_latency_log(spark, f"{out}/latencies")
    exact = latency_summary(log, RUN).select(
        "stream", *[F.col(c).alias(f"_{c}") for c in ("samples", "avg_latency", "min_latency", "max_latency")])
    live = live_summary(read_sketches(spark, f"{out}/sketches"))
    both = attach(live, materialise(exact), RUN)
    ranks = {}
    for p in QUANTILES:
        own, found = seconds_of_micros("latency_us"), F.col(quantile_name(p))
        below, upto = F.count_if(own < found) / F.col("samples"), F.count_if(own <= found) / F.col("samples")
        ranks[p] = ((below <= p + SKETCH_ERROR) & (upto >= p - SKETCH_ERROR)).alias(f"{quantile_name(p)}_close")
    figures = ["samples", "avg_latency", "min_latency", "max_latency"]
    agree = reduce(lambda a, b: a & b, (F.col(c) == F.col(f"_{c}") for c in figures)).alias("figures_agree")
    told = materialise(both.select("stream", "samples", agree, *map(quantile_name, QUANTILES)))
    rows = attach(log.select("stream", "latency_us"), told, RUN)
    return rows.groupBy("stream", "samples", "figures_agree", *map(quantile_name, QUANTILES)).agg(
        *ranks.values()).drop(*map(quantile_name, QUANTILES))


def stream_flushes(spark, sf_dir):
    """Counts closed by number over several micro-batches, and those still held at the end."""
    votes = bounded_stream_view(spark, sf_dir, _rows_of(spark, sf_dir, FEW_STEPS))
    out = _in_steps(spark, votes, cap=WIDE_CAP, held="held", tick_seconds=0)
    columns = ["stream", "state", "Dvotes", "Rvotes", "event_us"]
    closed = read_ledger(spark, f"{out}/ledger").select(*columns, F.lit(True).alias("full"))
    held = read_held(spark, f"{out}/held", last_committed(spark, f"{out}/checkpoint"))
    return closed.unionByName(held.select(*columns, F.lit(False).alias("full")))


def stream_dedup(spark, sf_dir):
    """Totals of a stream in which every vote comes twice, most of them in different micro-batches."""
    once, again = (bounded_stream_view(spark, sf_dir, _rows_of(spark, sf_dir, n)) for n in (FEW_STEPS, 2))
    votes = dedup_stream(valid_votes(once.unionByName(again)))
    return read_totals(spark, f"{_in_steps(spark, votes, partitions=4)}/ledger")


def ledger_rolled(spark, sf_dir):
    out = _counted(spark, sf_dir)
    roll_up(spark, f"{out}/ledger", f"{out}/rolled", f"{out}/checkpoint",
            f"{out}/latencies", f"{out}/rolled-latencies")
    return read_totals(spark, f"{out}/rolled")


def stream_winners(spark, sf_dir):
    out = scratch_path(spark, "reporting")
    start_reporting(
        _streamed(spark, sf_dir),
        reports=f"{out}/reports",
        checkpoint=f"{out}/checkpoint",
        available_now=True,
    ).awaitTermination()
    return read_report(spark, f"{out}/reports/winners")


QUERIES = {
    "state_totals": state_totals,
    "state_totals_full": state_totals_full,
    "winners": winners_by_state,
    "national_totals": national,
    "map_table": state_map,
    "valid_votes": valid,
    "rejects": rejects,
    "json_roundtrip": json_roundtrip,
    "bad_times": bad_times,
    "party_codes": party_codes,
    "dedup_votes": dedup,
    "ingest_audit": audit,
    "ingest_states": audit_by_state,
    "missing_ranges": missing,
    "partials": partials,
    "partials_json": partials_json,
    "partials_default": partials_default,
    "merge_partials": merged_partials,
    "ledger_totals": ledger_totals,
    "latency_rows": latencies,
    "latency_summary": summary,
    "latency_trimmed": trimmed,
    "latency_trimmed_summary": trimmed_summary,
    "latency_histogram": histogram,
    "latency_points": points,
    "csv_roundtrip": csv_roundtrip,
    "run_summary": run_summary,
    "stream_totals": stream_totals,
    "stream_latencies": stream_latencies,
    "stream_rejects": stream_rejects,
    "stream_bounded": stream_bounded,
    "stream_flushes": stream_flushes,
    "stream_quantiles": stream_quantiles,
    "stream_dedup": stream_dedup,
    "ledger_compacted": ledger_compacted,
    "ledger_rolled": ledger_rolled,
    "stream_winners": stream_winners,
}
