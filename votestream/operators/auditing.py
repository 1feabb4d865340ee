"""What each input stream delivered.

Row numbers are gathered as bitmaps, one for each stream and ``BUCKET`` consecutive numbers, formed
before the shuffle. So what is shuffled is a bitmap of 4 KiB per task and bucket, however
often its votes came.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import is_democrat, sequence_of
from ..schema import MICROS
from .joining import attach, materialise

#: Row numbers in a bitmap, as Spark's bitmap functions have it.
BUCKET = 32_768


def _by_bucket(votes: DataFrame, *figures: Column) -> DataFrame:
    """``figures`` and the ``bits`` of row numbers per stream and ``bucket``, which counts from 0.

    Votes without a row number have a NULL bucket, and no bit.
    """
    # The functions count from 1, so that 0 would have a bucket to itself.
    numbered = votes.withColumn("_sequence", sequence_of("id"))
    bucket = (F.bitmap_bucket_number(F.col("_sequence") + 1) - 1).alias("bucket")
    position = F.when(F.col("_sequence").isNotNull(), F.bitmap_bit_position(F.col("_sequence") + 1))
    return numbered.groupBy("stream", bucket).agg(
        F.max("_sequence").alias("top"), F.bitmap_construct_agg(position).alias("bits"), *figures
    )


def ingest_audit(votes: DataFrame, budget: int | None = None) -> DataFrame:
    """Per stream: rows by party, span, achieved rate, and rows that are missing.

    Row numbers count up from zero, so those up to the highest that never came
    are missing. With a row ``budget`` the shortfall against it is given too.
    """
    democrat = is_democrat("party")
    span = F.col("last_us") - F.col("first_us")
    seconds = F.nullif(span, F.lit(0).cast("bigint")).cast("double") / F.lit(float(MICROS))
    buckets = _by_bucket(
        votes,
        F.count(F.lit(1)).alias("votes"),
        F.count_if(democrat).alias("Dvotes"),
        F.count_if(~democrat).alias("Rvotes"),
        F.min("event_us").alias("first_us"),
        F.max("event_us").alias("last_us"),
    )
    came = F.sum(F.when(F.col("bucket").isNotNull(), F.bitmap_count("bits")).otherwise(0))
    audit = (
        buckets.groupBy("stream")
        .agg(
            *[F.sum(c).alias(c) for c in ("votes", "Dvotes", "Rvotes")],
            F.min("first_us").alias("first_us"),
            F.max("last_us").alias("last_us"),
            (F.max("top") + 1 - came).alias("missing"),
        )
        .withColumn("votes_per_second", F.col("votes").cast("double") / seconds)
    )
    if budget is not None:
        audit = audit.withColumn("short_of_budget", F.lit(budget) - F.col("votes"))
    return audit


def missing_ranges(votes: DataFrame) -> DataFrame:
    """Per stream the row numbers up to its highest that never came, as ranges from ``first`` to ``last``.

    Gaps are found within bitmaps. Only those that reach the edge of a bucket, at most two of each, and
    the buckets of which nothing came are put together along a stream.
    """
    buckets = materialise(_by_bucket(votes).where("bucket is not null"))
    tops = materialise(buckets.groupBy("stream").agg(F.max("top").alias("top")))
    partly = attach(buckets.where(F.bitmap_count("bits") < BUCKET).drop("top"), tops, ["stream"])
    start = F.col("bucket") * BUCKET
    size = F.least(F.lit(BUCKET).cast("bigint"), F.col("top") + 1 - start).cast("int")
    octets = F.transform(
        F.sequence(F.lit(0), F.lit(BUCKET // 8 - 1)),
        lambda k: F.conv(F.hex(F.substring("bits", k + 1, F.lit(1))), 16, 10).cast("int"),
    )

    def gaps(seen: Column) -> Column:
        """``seen`` holds the octets of one bitmap; as a lambda's variable it is worked out once."""
        def came(i: Column) -> Column:
            octet = F.get(seen, F.call_function("div", i, F.lit(8)).cast("int"))
            return F.call_function("getbit", octet, i % 8) == 1

        every = F.sequence(F.lit(0), size - 1)
        first = F.filter(every, lambda i: ~came(i) & ((i == 0) | came(i - 1)))
        last = F.filter(every, lambda i: ~came(i) & ((i == size - 1) | came(i + 1)))
        return F.arrays_zip(first.alias("first"), last.alias("last"))

    found = F.get(F.transform(F.array(octets), gaps), F.lit(0))
    within = partly.select("stream", start.alias("start"), F.inline(found).alias("first", "last")).select(
        "stream", (F.col("start") + F.col("first")).alias("first"), (F.col("start") + F.col("last")).alias("last")
    )
    along = Window.partitionBy("stream").orderBy("bucket")
    before = F.coalesce(F.lag("bucket").over(along), F.lit(-1).cast("bigint"))
    absent = buckets.select("stream", "bucket", before.alias("before")).where("bucket - before > 1").select(
        "stream", ((F.col("before") + 1) * BUCKET).alias("first"), (F.col("bucket") * BUCKET - 1).alias("last")
    )
    ranges = materialise(within.unionByName(absent))
    edge = (F.col("first") % BUCKET == 0) | (F.col("last") % BUCKET == BUCKET - 1)
    return ranges.where(~edge).unionByName(_joined(ranges.where(edge)))


def _joined(ranges: DataFrame) -> DataFrame:
    """Ranges that follow each other without a number between them as one."""
    along = Window.partitionBy("stream").orderBy("first")
    opens = F.coalesce(F.col("first") > F.lag("last").over(along) + 1, F.lit(True)).cast("bigint")
    run = F.sum("opens").over(along).alias("run")
    runs = ranges.withColumn("opens", opens).select("stream", "first", "last", run)
    return runs.groupBy("stream", "run").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("run")


def votes_by_stream_and_state(votes: DataFrame) -> DataFrame:
    """Per stream and state: rows by party, as they came in."""
    democrat = is_democrat("party")
    return votes.groupBy("stream", "state").agg(
        F.count(F.lit(1)).alias("votes"),
        F.count_if(democrat).alias("Dvotes"),
        F.count_if(~democrat).alias("Rvotes"),
    )
