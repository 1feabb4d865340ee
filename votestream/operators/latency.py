"""Latency rows and their statistics.

Rows come in two shapes, told apart by their columns: bigint microseconds
(``time_us``, ``latency_us``) where this package made them, so that sums do not
depend on order, and double seconds (``time``, ``latency``) where they were read
from a log. ``keys`` name the run a row belongs to.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import seconds_of_micros
from ..schema import HISTOGRAM_BINS, MICROS, QUANTILES, WARMUP_FRACTION
from .joining import attach, materialise, ordered
from .quantiles import exact_quantiles


@dataclass(frozen=True)
class _Shape:
    time: str
    latency: str
    per_second: float

    def seconds(self, column) -> Column:
        column = F.col(column) if isinstance(column, str) else column
        return seconds_of_micros(column) if self.per_second != 1 else column


_MICRO_ROWS = _Shape("time_us", "latency_us", float(MICROS))
_SECOND_ROWS = _Shape("time", "latency", 1.0)


def _shape(latencies: DataFrame) -> _Shape:
    return _MICRO_ROWS if "latency_us" in latencies.columns else _SECOND_ROWS


def latency_rows(partials: DataFrame) -> DataFrame:
    """One row per partial count: when it was flushed, and how long after its newest vote.

    Clocks may disagree, so a latency may be negative and is kept so.
    """
    latency_us = F.col("time_us") - F.col("event_us")
    return partials.withColumn("latency_us", latency_us).drop("Dvotes", "Rvotes", "event_us")


def in_seconds(latencies: DataFrame) -> DataFrame:
    """Microsecond rows as ``time`` and ``latency`` in seconds, for the output edge."""
    rest = [c for c in latencies.columns if c not in ("time_us", "latency_us")]
    return latencies.select(
        *rest,
        seconds_of_micros("time_us").alias("time"),
        seconds_of_micros("latency_us").alias("latency"),
    )


def in_micros(latencies: DataFrame) -> DataFrame:
    """Second rows, as a log has them, as microsecond rows, whose sums are exact."""
    rest = [c for c in latencies.columns if c not in ("time", "latency")]
    micros = lambda c: F.rint(F.col(c) * float(MICROS)).cast("bigint")
    return latencies.select(
        *rest, micros("time").alias("time_us"), micros("latency").alias("latency_us")
    )


def relative_time(latencies: DataFrame, keys: list[str]) -> DataFrame:
    """Adds ``since_start`` and ``duration`` of the run, in the unit of the rows."""
    shape = _shape(latencies)
    runs = latencies.groupBy(*keys).agg(
        F.min(shape.time).alias("run_start"),
        (F.max(shape.time) - F.min(shape.time)).alias("duration"),
        F.count(F.lit(1)).alias("_rows"),
    )
    return (
        attach(latencies, materialise(runs), keys, sizes="_rows")
        .withColumn("since_start", F.col(shape.time) - F.col("run_start"))
        .drop("run_start")
    )


def trim_warmup(
    latencies: DataFrame, keys: list[str], fraction: float = WARMUP_FRACTION
) -> DataFrame:
    """Rows later than the first ``fraction`` of their run's duration."""
    timed = relative_time(latencies, keys)
    return timed.where(F.col("since_start") > F.lit(float(fraction)) * F.col("duration"))


def latency_points(latencies: DataFrame, keys: list[str]) -> DataFrame:
    """Scatter points of each run in time order: seconds since start, latency.

    Feed it ``relative_time`` or ``trim_warmup``.
    """
    shape = _shape(latencies)
    points = latencies.select(
        *keys,
        shape.seconds("since_start").alias("runtime"),
        shape.seconds(shape.latency).alias("latency"),
    )
    return ordered(points, *keys, "runtime", "latency")


def latency_summary(
    latencies: DataFrame,
    keys: list[str],
    probabilities=QUANTILES,
    approximate: bool = False,
) -> DataFrame:
    """Per run, in seconds: rows, mean, least and greatest latency, and quantiles.

    Quantiles are exact with linear interpolation, or sketched in the same pass
    as the other figures when ``approximate``.
    """
    shape = _shape(latencies)
    value = F.col(shape.latency)
    if approximate:
        sketched = F.percentile_approx(value, list(map(float, probabilities)), 10_000)
        figures = _figures(shape, F.lit(1).cast("bigint"))
        summary = latencies.where(value.isNotNull()).groupBy(*keys).agg(
            *figures, sketched.alias("quantiles")
        )
    else:
        figures = _figures(shape, F.col("times"))
        summary = exact_quantiles(latencies, keys, shape.latency, probabilities, figures)
    named = [
        shape.seconds(F.col("quantiles")[i].cast("double")).alias(quantile_name(p))
        for i, p in enumerate(probabilities)
    ]
    return summary.select(
        *keys, "samples", "avg_latency", "min_latency", "max_latency", *named
    )


def _figures(shape: _Shape, times: Column) -> list[Column]:
    value = F.col(shape.latency)
    # As decimals, whole microseconds add up exactly and cannot overflow.
    exact = value.cast("decimal(19,0)") * times.cast("decimal(19,0)")
    total = F.sum(exact if shape.per_second != 1 else value * times)
    samples = F.sum(times)
    return [
        samples.alias("samples"),
        shape.seconds(total.cast("double") / samples).alias("avg_latency"),
        shape.seconds(F.min(value)).alias("min_latency"),
        shape.seconds(F.max(value)).alias("max_latency"),
    ]


def quantile_name(probability: float) -> str:
    return f"p{probability * 100:g}".replace(".", "_")


def by_run(summary: DataFrame) -> DataFrame:
    """A summary of logged runs as it is read: few nodes first, high rates first."""
    return summary.orderBy("nodes", F.desc("rate"))


def latency_histogram(
    latencies: DataFrame, keys: list[str], bins: int = HISTOGRAM_BINS
) -> DataFrame:
    """Per run, rows in each of ``bins`` equal bins between least and greatest latency.

    The last bin includes its upper end, and empty bins are listed. When all
    latencies of a run are equal, the bins span half a second to each side.
    """
    shape = _shape(latencies)
    latencies = latencies.where(F.col(shape.latency).isNotNull())
    least, greatest = F.col("least"), F.col("greatest")
    margin = F.when(least == greatest, 0.5 * shape.per_second).otherwise(0.0)
    runs = materialise(
        latencies.groupBy(*keys)
        .agg(
            F.min(shape.latency).cast("double").alias("least"),
            F.max(shape.latency).cast("double").alias("greatest"),
            F.count(F.lit(1)).alias("_rows"),
        )
        .select(*keys, (least - margin).alias("least"), (greatest + margin).alias("greatest"), "_rows")
    )
    value = F.col(shape.latency).cast("double")
    bucket = F.width_bucket(value, least, greatest, F.lit(bins))
    binned = (
        attach(latencies, runs, keys, sizes="_rows")
        .select(*keys, F.least(bucket, F.lit(bins)).cast("int").alias("bin"))
        .groupBy(*keys, "bin")
        .agg(F.count(F.lit(1)).alias("frequency"))
    )
    empty = runs.select(
        *keys,
        F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"),
        F.lit(0).cast("bigint").alias("frequency"),
        "least",
        "greatest",
    )
    width = (F.max("greatest") - F.max("least")) / F.lit(float(bins))
    return (
        binned.unionByName(empty, allowMissingColumns=True)
        .groupBy(*keys, "bin")
        .agg(
            F.sum("frequency").alias("frequency"),
            shape.seconds(F.max("least") + (F.col("bin") - 1) * width).alias("bin_start"),
        )
    )
