"""Record shapes and default settings shared by the whole package."""

from pyspark.sql import types as T

# The 50 state codes, in the order of the state list.
STATES = (
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA",
    "HI", "ID", "IL", "IN", "IA", "KS", "KY", "LA", "ME", "MD",
    "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ",
    "NM", "NY", "NC", "ND", "OH", "OK", "OR", "PA", "RI", "SC",
    "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY",
)

# Party labels and the colours a map shows them in.
DEMOCRAT = "Democrat"
REPUBLICAN = "Republican"
PARTY_COLOURS = {DEMOCRAT: "#346fed", REPUBLICAN: "#bd3428"}

# Default settings.
TICK_SECONDS = 4  # a partial count is flushed at least this often
BATCH_SECONDS = 6  # the row cap of a flush is this many seconds of one stream
BACKLOG_TICKS = 10  # a stream may be this many ticks of rows ahead
WARMUP_FRACTION = 0.10  # share of a run's duration dropped as warm-up
QUANTILES = (0.9, 0.95, 0.99)
HISTOGRAM_BINS = 100
RUN_SECONDS = 300  # planned duration of a run, sets the row budget

MICROS = 1_000_000

VOTE_JSON = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("party", T.StringType()),
    T.StructField("event_time", T.DoubleType()),
])

PARTIAL = T.StructType([
    T.StructField("stream", T.LongType()),
    T.StructField("state", T.StringType()),
    T.StructField("Dvotes", T.LongType()),
    T.StructField("Rvotes", T.LongType()),
    T.StructField("event_us", T.LongType()),
])

LATENCY = T.StructType([
    T.StructField("time", T.DoubleType()),
    T.StructField("latency", T.DoubleType()),
])


def rate_per_stream(votes_per_second: int, streams: int) -> int:
    """Rows a single stream is expected to carry each second (halves round up)."""
    return (2 * votes_per_second + streams) // (2 * streams)


def flush_cap(votes_per_second: int, streams: int) -> int:
    """Rows a counter may hold before it flushes without waiting for the tick."""
    return BATCH_SECONDS * rate_per_stream(votes_per_second, streams)


def backlog_rows(votes_per_second: int, streams: int) -> int:
    """Rows of one stream that may be in flight at once."""
    return BACKLOG_TICKS * TICK_SECONDS * rate_per_stream(votes_per_second, streams)


def row_budget(votes_per_second: int, streams: int, seconds: int = RUN_SECONDS) -> int:
    """Rows each stream is expected to deliver over a whole run."""
    return votes_per_second * seconds // streams
