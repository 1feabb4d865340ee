"""Results of micro-batches, kept so that a replayed batch changes nothing.

Each micro-batch owns one folder, named after its batch id, in each output. The
stream's checkpoint ties a batch id to its input, so a batch that is run again
after a failure overwrites its own folder with the same counts. Totals are the
sum over all folders. Counts and latencies go to separate paths, which may be on
separate storage. Old folders are merged while the job runs (``compaction``).
"""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions import seconds_of_micros
from ..operators.counting import merge_partials, seed_totals
from ..operators.flushing import HELD
from ..operators.latency import quantile_name
from ..schema import PARTIAL, QUANTILES
from ..sources.states import states_df
from .compaction import BATCH, compact, compacted_to, read_batches

ROWS_PER_FILE = 1_000_000

_LEDGER = T.StructType(PARTIAL.fields + [T.StructField(BATCH, T.LongType())])
_HELD = T.StructType(
    [T.StructField(c, T.StringType() if c == "state" else T.LongType()) for c in (*HELD, "tick", BATCH)]
)
_LATENCIES = T.StructType([
    T.StructField("stream", T.LongType()),
    T.StructField("state", T.StringType()),
    T.StructField("time_us", T.LongType()),
    T.StructField("latency_us", T.LongType()),
    T.StructField(BATCH, T.LongType()),
])
_SKETCHES = T.StructType([
    T.StructField("stream", T.LongType()),
    T.StructField("samples", T.LongType()),
    T.StructField("total_us", T.DecimalType(38, 0)),
    T.StructField("least_us", T.LongType()),
    T.StructField("greatest_us", T.LongType()),
    T.StructField("sketch", T.BinaryType()),
    T.StructField(BATCH, T.LongType()),
])


def files_for(rows: int) -> int:
    """Files to write so many rows to. Within a micro-batch nothing else merges
    the small outputs of many shuffle partitions."""
    return 1 + rows // ROWS_PER_FILE


def _write_batch(df: DataFrame, batch_id: int, path: str, files: int | None = None) -> None:
    if 0 <= batch_id <= compacted_to(df.sparkSession, path):
        raise ValueError(
            f"batch {batch_id} of {path} has been merged; a new checkpoint needs a new ledger"
        )
    if files is not None:
        df = df.coalesce(files)
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{BATCH}={batch_id}")


def write_partials(
    partials: DataFrame, batch_id: int, path: str, files: int | None = None
) -> None:
    _write_batch(partials.select(*PARTIAL.fieldNames()), batch_id, path, files)


def write_latencies(
    latencies: DataFrame, batch_id: int, path: str, files: int | None = None
) -> None:
    rows = latencies.select("stream", "state", "time_us", "latency_us")
    _write_batch(rows, batch_id, path, files)


def write_rejects(rejects: DataFrame, batch_id: int, path: str) -> None:
    _write_batch(rejects, batch_id, path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Every partial count written so far, with its batch id."""
    return read_batches(spark, path, _LEDGER)


def read_latency_log(spark: SparkSession, path: str) -> DataFrame:
    return read_batches(spark, path, _LATENCIES)


def compact_ledger(spark: SparkSession, path: str, upto: int) -> None:
    """Merges the counts of all batches up to ``upto``, which must be committed, into one a counter."""

    def merge(rows: DataFrame, last: int) -> DataFrame:
        merged = merge_partials(rows, ["stream", "state"])
        return merged.withColumn(BATCH, F.lit(last).cast("bigint")).select(*_LEDGER.fieldNames()).coalesce(1)

    compact(spark, path, upto, _LEDGER, merge, whole=True)


def compact_latencies(spark: SparkSession, path: str, upto: int) -> None:
    """Puts the latencies of batches up to ``upto`` into few files; every row is kept as it is."""

    def merge(rows: DataFrame, last: int) -> DataFrame:
        return rows.coalesce(files_for(rows.count()))

    compact(spark, path, upto, _LATENCIES, merge, whole=False)


# --- latencies as sketches ---------------------------------------------------
# A row per stream and micro-batch, however many latencies it stands for. Merged sketches have the same
# bound on their error as one over all rows.


def write_sketches(latencies: DataFrame, batch_id: int, path: str, size: int) -> None:
    """What a micro-batch adds to the quantiles of each stream, with ``size`` as the sketch's k."""
    rows = latencies.groupBy("stream").agg(
        F.count("latency_us").alias("samples"),
        F.sum(F.col("latency_us").cast("decimal(19,0)")).cast("decimal(38,0)").alias("total_us"),
        F.min("latency_us").alias("least_us"),
        F.max("latency_us").alias("greatest_us"),
        F.kll_sketch_agg_bigint("latency_us", size).alias("sketch"),
    )
    _write_batch(rows, batch_id, path, 1)


def _merge_sketches(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.sum("samples").alias("samples"),
        F.sum("total_us").cast("decimal(38,0)").alias("total_us"),
        F.min("least_us").alias("least_us"),
        F.max("greatest_us").alias("greatest_us"),
        F.kll_merge_agg_bigint("sketch").alias("sketch"),
    )


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    """The sketch of each stream over all micro-batches so far."""
    return _merge_sketches(read_batches(spark, path, _SKETCHES), "stream")


def live_summary(sketches: DataFrame, probabilities=QUANTILES) -> DataFrame:
    """``latency_summary`` of each stream from its sketch: no row of the log is read.

    Number, mean, least and greatest latency are exact. A quantile is some latency whose rank is within the
    sketch's error of the wanted one (1.65% for a k of 200, 99 times of 100), not interpolated.
    """
    named = [
        seconds_of_micros(F.kll_sketch_get_quantile_bigint("sketch", F.lit(float(p)))).alias(quantile_name(p))
        for p in probabilities
    ]
    mean = F.col("total_us").cast("double") / F.col("samples")
    return sketches.where("samples > 0").select(
        "stream", "samples", seconds_of_micros(mean).alias("avg_latency"),
        seconds_of_micros("least_us").alias("min_latency"),
        seconds_of_micros("greatest_us").alias("max_latency"), *named,
    )


def compact_sketches(spark: SparkSession, path: str, upto: int) -> None:
    """Merges the sketches of batches up to ``upto`` into one a stream."""

    def merge(rows: DataFrame, last: int) -> DataFrame:
        merged = _merge_sketches(rows, "stream").withColumn(BATCH, F.lit(last).cast("bigint"))
        return merged.select(*_SKETCHES.fieldNames()).coalesce(1)

    compact(spark, path, upto, _SKETCHES, merge, whole=True)


def read_totals(spark: SparkSession, path: str, states: DataFrame | None = None) -> DataFrame:
    """Totals of every listed state."""
    totals = merge_partials(read_ledger(spark, path))
    return seed_totals(states_df(spark) if states is None else states, totals)


def last_committed(spark: SparkSession, checkpoint: str) -> int:
    """The newest batch that a stream's checkpoint knows to be complete; -1 if none is."""
    commits = spark.read.format("text").option("pathGlobFilter", "[0-9]*").option(
        "recursiveFileLookup", "true").load(f"{checkpoint.rstrip('/')}/commits")
    newest = commits.select(F.col("_metadata.file_name").try_cast("bigint").alias("id"))
    found = newest.agg(F.max("id")).first()[0]
    return -1 if found is None else found


def roll_up(
    spark: SparkSession,
    path: str,
    target: str,
    checkpoint: str,
    latencies: str | None = None,
    latency_target: str | None = None,
) -> None:
    """Copy a long ledger to ``target``, its batches merged into a single one.

    For a stopped stream that goes on with ``target`` as its ledger: batch ids count on
    from where they were, and the merged batch has an id none of them use. A batch that
    was written but not committed will be run again under its own id, so it is left out.
    The log of latencies is copied into few files the same way, if given.
    """
    pairs = [(path, target), *([(latencies, latency_target)] if latencies is not None else [])]
    if any(b is None or a.rstrip("/") == b.rstrip("/") for a, b in pairs):
        raise ValueError("a ledger is rolled up into another folder than its own")
    done = F.col(BATCH) <= last_committed(spark, checkpoint)
    merged = merge_partials(read_ledger(spark, path).where(done), ["stream", "state"])
    write_partials(merged, -1, target)
    if latencies is not None:
        log = read_latency_log(spark, latencies).where(done)
        write_latencies(log, -1, latency_target, files_for(log.count()))


# --- counters that hold votes ------------------------------------------------
# A counter holds its votes from one micro-batch to the next. Two folders take turns: a batch reads
# what the one before it has left, and when it is run again that is still there.


def write_held(held: DataFrame, batch_id: int, path: str) -> None:
    rows = held.withColumn(BATCH, F.lit(batch_id).cast("bigint")).coalesce(1)
    rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/slot={batch_id % 2}")


def read_held(spark: SparkSession, path: str, batch_id: int) -> DataFrame:
    """What the counters hold after a batch; nothing after -1, the beginning."""
    if batch_id < 0:
        return spark.createDataFrame([], _HELD)
    rows = spark.read.schema(_HELD).parquet(f"{path.rstrip('/')}/slot={batch_id % 2}")
    return rows.where(F.col(BATCH) == batch_id)


# --- reports -----------------------------------------------------------------
# Only the newest report matters. Two folders take turns, so that the newest
# complete one stays in place while the next is written. A report has at most a row
# per listed state.


def write_report(report: DataFrame, batch_id: int, path: str) -> None:
    stamped = report.withColumn(BATCH, F.lit(batch_id).cast("bigint")).coalesce(1)
    stamped.write.mode("overwrite").parquet(f"{path.rstrip('/')}/slot={batch_id % 2}")


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """The newest report, also while the one before it is being replaced."""
    reports = spark.read.option("ignoreMissingFiles", True).parquet(path)
    newest = reports.agg(F.max(BATCH).alias("newest")).first()["newest"]
    return reports.where(F.col(BATCH) == newest).drop(BATCH, "slot")
