"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the number of cores.

The tables hold few votes, so most of each time is the fixed cost of starting jobs.
``sustained`` therefore counts every vote COPIES times over, in batch and as a stream
of JSON lines, and gives the votes counted per second and the longest micro-batch.
``live`` counts votes as Spark's rate source makes them, RATES a second, with the default
tick, and gives the latencies that the job itself has logged.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F

from votestream.operators import count_votes, flush_partials, latency_summary, valid_votes
from votestream.plans import QUERIES
from votestream.schema import MICROS, STATES, TICK_SECONDS, flush_cap
from votestream.session import local_session, scratch_path
from votestream.sources import read_vote_stream, votes_view, write_votes
from votestream.streaming import read_latency_log, start_counting

# Rows of these queries come from another table than the votes.
TABLES = {"dedup_votes": "lineitem"}

HEADLINE = (
    "state_totals",
    "state_totals_full",
    "winners",
    "national_totals",
    "map_table",
    "valid_votes",
    "rejects",
    "json_roundtrip",
    "dedup_votes",
    "bad_times",
    "party_codes",
    "ingest_audit",
    "ingest_states",
    "missing_ranges",
    "partials",
    "partials_json",
    "partials_default",
    "merge_partials",
    "ledger_totals",
    "latency_rows",
    "latency_summary",
    "latency_trimmed",
    "latency_trimmed_summary",
    "latency_histogram",
    "latency_points",
    "csv_roundtrip",
    "run_summary",
    "stream_totals",
    "stream_latencies",
    "stream_rejects",
    "stream_bounded",
    "stream_flushes",
    "ledger_compacted",
    "stream_dedup",
    "stream_winners",
    "ledger_rolled",
)


COPIES = 20
MICRO_BATCHES = 5
RATES = (22_000, 30_000)
LIVE_SECONDS = 24


def sustained(spark, sf_dir) -> dict:
    path = scratch_path(spark, "bench")
    copies = F.explode(F.sequence(F.lit(1), F.lit(COPIES)))
    votes_view(spark, sf_dir).withColumn("copy", copies).drop("copy").write.parquet(f"{path}/votes")
    votes = spark.read.parquet(f"{path}/votes")
    rows = votes.count()
    write_votes(votes.repartition(8 * MICRO_BATCHES), f"{path}/lines")

    def rate(action) -> int:
        begin = time.perf_counter()
        action()
        return round(rows / (time.perf_counter() - begin))

    stream = start_counting(
        read_vote_stream(spark, f"{path}/lines", max_files=8),
        f"{path}/ledger", f"{path}/latencies", f"{path}/checkpoint", available_now=True,
    )
    streamed = rate(stream.awaitTermination)
    batches = [p["durationMs"]["triggerExecution"] / 1000 for p in stream.recentProgress]
    valid = valid_votes(votes)

    def flush() -> None:
        flushed = flush_partials(valid, TICK_SECONDS * MICROS, flush_cap(30_000, 2))
        flushed.write.format("noop").mode("overwrite").save()

    return {
        "votes": rows,
        "batch_votes_per_second": rate(lambda: count_votes(valid).collect()),
        "flush_votes_per_second": rate(flush),
        "stream_votes_per_second": streamed,
        "longest_micro_batch_seconds": max(batches),
    }


def live(spark, rate: int) -> dict:
    path = scratch_path(spark, "live")
    made = spark.readStream.format("rate").option("rowsPerSecond", rate).load()
    states = ", ".join(f"'{s}'" for s in STATES)
    votes = made.select(
        F.concat(F.lit("1-"), F.col("value").cast("string")).alias("id"),
        F.lit(1).cast("bigint").alias("stream"),
        F.expr(f"element_at(array({states}), cast(value % {len(STATES)} + 1 as int))").alias("state"),
        F.when(F.col("value") % 3 == 0, "D").otherwise("R").alias("party"),
        F.unix_micros("timestamp").alias("event_us"),
    )
    query = start_counting(votes, f"{path}/ledger", f"{path}/latencies", f"{path}/checkpoint")
    time.sleep(LIVE_SECONDS)
    query.stop()
    found = latency_summary(read_latency_log(spark, f"{path}/latencies"), ["stream"]).first()
    return {k: round(v, 3) for k, v in found.asDict().items() if k != "stream"}


def main(names) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores)

    def run(name: str) -> float:
        begin = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begin

    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t in ("events", "lineitem")}
    votes = tables["events"]
    run(names[0])  # starts the executors' threads and compiles
    seconds = {name: round(min(run(name) for _ in range(2)), 3) for name in names}
    rates = {n: round(tables[TABLES.get(n, "events")] / taken) for n, taken in seconds.items()}
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "votes": votes,
                "votes_per_second": rates,
                "sustained": sustained(spark, sf_dir),
                "live": {str(rate): live(spark, rate) for rate in RATES},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:] or HEADLINE)
