"""Exact quantiles of runs of any length and width.

The built-in exact percentile keeps every distinct value of a group in one task.
Here equal values are counted together before anything is put in order. A key that
still has too many different values to order in one task is narrowed down: the range of its
values is divided into buckets, those that hold a wanted position are divided again by the
range of their own values, and so on until a bucket can be ordered. Each division
separates the least value from the greatest, so it ends whatever the values are.
"""

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..schema import QUANTILES
from .joining import BROADCAST_ROWS, attach, materialise

# A bucket with at most this many different values has them ordered in one task.
SORT_VALUES = 2_000_000
# Buckets that a range is divided into; they are put in order in one task.
BUCKETS = 4_096


def exact_quantiles(
    rows: DataFrame,
    keys: list[str],
    value: str,
    probabilities=QUANTILES,
    figures=(),
    sort_values: int = SORT_VALUES,
    broadcast_rows: int = BROADCAST_ROWS,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Per key, an array ``quantiles`` of linearly interpolated quantiles of ``value``.

    ``value`` is a whole number or a double; NULLs are left out, NaN is greater than any number.

    ``figures`` are further aggregates to return. They see each different value
    once, in a row with the number of ``times`` it occurs.
    """
    counted = materialise(
        rows.where(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(F.count(F.lit(1)).alias("times"))
    )
    whole = materialise(
        counted.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("in_key"), F.sum("times").alias("rows"),
            F.min(value).alias("least"), F.max(value).alias("greatest"),
        )
    )
    if (whole.agg(F.max("in_key")).first()[0] or 0) <= sort_values:
        placed = _placed(counted, keys, value, F.lit(0))
        placed = placed.withColumn("rows", F.sum("times").over(Window.partitionBy(*keys)))
        return _pick(placed, keys, value, probabilities, figures)

    ranges, narrow = whole.withColumns({"from": F.lit(0).cast("bigint"), "values": F.col("in_key")}), []
    while True:
        wide = F.col("values") > max(sort_values, 1)
        narrow.append(ranges.where(~wide))
        if ranges.where(wide).isEmpty():
            break
        ranges = materialise(_divided(counted, ranges.where(wide), keys, value, probabilities, broadcast_rows, buckets))
    inside = _in_ranges(counted, reduce(DataFrame.unionByName, narrow), keys, value, broadcast_rows)
    placed = _placed(inside, [*keys, "from"], value, F.col("from"))
    picked = _pick(placed, keys, value, probabilities)
    if not figures:
        return picked
    return attach(counted.groupBy(*keys).agg(*figures), materialise(picked), keys, broadcast_rows)


def _in_ranges(counted, ranges, keys, value, broadcast_rows):
    """The values within the ranges of their key, each with its range. A key has few, and they do not overlap."""
    own = ranges.groupBy(*keys).agg(
        F.collect_list(F.struct("from", "least", "greatest")).alias("ranges"),
        F.max("rows").alias("rows"), F.max("in_key").alias("in_key"), F.max("in_key").alias("_size"))
    both = attach(counted, materialise(own), keys, broadcast_rows, sizes="_size")
    holds = F.filter("ranges", lambda r: F.col(value).between(r["least"], r["greatest"]))
    found = both.withColumn("range", F.get(holds, F.lit(0))).drop("ranges")
    return found.where(F.col("range").isNotNull()).select("*", "range.*").drop("range")


def _bucket(kind, value, buckets):
    """Where a value lies between ``least`` and ``greatest``; the two are in the first and the last bucket."""
    least, greatest = F.col("least"), F.col("greatest")
    if isinstance(kind, (T.DoubleType, T.FloatType)):  # by halves, which cannot overflow
        place, width = value / 2 - least / 2, greatest / 2 - least / 2
    else:
        exact = lambda c: c.cast("decimal(20,0)")
        place = (exact(value) - exact(least)).cast("double")
        width = (exact(greatest) - exact(least)).cast("double")
    usual = (width > 0) & (width < F.lit(float("inf")))  # NaN is above that
    share = F.floor(F.try_divide(place, width) * F.lit(float(buckets))).cast("bigint")
    last = F.lit(buckets - 1).cast("bigint")
    return (
        F.when(value == least, F.lit(0).cast("bigint")).when(value == greatest, last)
        .when(usual, F.least(share, last)).otherwise(F.lit(1).cast("bigint"))
    )


def _divided(counted, ranges, keys, value, probabilities, broadcast_rows, buckets):
    """The buckets of ``ranges`` that hold a wanted position, as ranges."""
    inside = _in_ranges(counted, ranges, keys, value, broadcast_rows)
    before = (
        Window.partitionBy(*keys, "from").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    holds = F.lit(False)
    for probability in probabilities:
        position = _position(probability)
        for edge in (F.floor(position), F.ceil(position)):
            holds = holds | _holds(edge)
    return (
        inside.withColumn("bucket", _bucket(counted.schema[value].dataType, F.col(value), buckets))
        .groupBy(*keys, "rows", "in_key", "from", "bucket")
        .agg(F.sum("times").alias("times"), F.count(F.lit(1)).alias("values"),
             F.min(value).alias("least"), F.max(value).alias("greatest"))
        .withColumn("begins", F.col("from") + F.coalesce(F.sum("times").over(before), F.lit(0)))
        .where(holds)
        .select(*keys, "rows", "in_key", F.col("begins").alias("from"), "values", "least", "greatest")
    )


def _placed(counted, keys, value, offset):
    """Adds the position, counted from zero, at which each value first occurs."""
    before = (
        Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    )
    return counted.withColumn("begins", offset + F.coalesce(F.sum("times").over(before), F.lit(0)))


def _position(probability):
    return F.lit(float(probability)) * (F.col("rows") - 1)


def _holds(edge, begins="begins"):
    return (edge >= F.col(begins)) & (edge < F.col(begins) + F.col("times"))


def _pick(placed, keys, value, probabilities, figures=()):
    def value_at(edge):
        return F.max(F.when(_holds(edge), F.col(value).cast("double")))

    ends = []
    for i, probability in enumerate(probabilities):
        position = _position(probability)
        ends.append(value_at(F.floor(position)).alias(f"below_{i}"))
        ends.append(value_at(F.ceil(position)).alias(f"above_{i}"))
    picked = placed.groupBy(*keys).agg(F.max("rows").alias("rows"), *ends, *figures)

    def between(i):
        # From the nearer end, which is the form that rounds least.
        position = _position(probabilities[i])
        part = position - F.floor(position)
        below, above = F.col(f"below_{i}"), F.col(f"above_{i}")
        step = above - below
        usual = F.when(part < 0.5, below + step * part).otherwise(above - step * (1.0 - part))
        return F.when(below == above, below).otherwise(usual)  # infinite ones have no step

    quantiles = F.array(*map(between, range(len(probabilities)))).alias("quantiles")
    dropped = {"rows", *(f"{end}_{i}" for i in range(len(probabilities)) for end in ("below", "above"))}
    kept = [c for c in picked.columns if c not in dropped]
    return picked.select(*kept, quantiles)
