"""Scalar rules of the vote model, as columns."""

from pyspark.sql import Column, functions as F

from ..schema import DEMOCRAT, MICROS, PARTY_COLOURS, REPUBLICAN


def _col(column) -> Column:
    return F.col(column) if isinstance(column, str) else column


# --- time ---------------------------------------------------------------

# Times reach to the end of the year 9999, and as far into the past. Sums and differences of a
# few of them fit a bigint, so no later step can overflow.
MAX_SECONDS = 253_402_300_800
MAX_US = MAX_SECONDS * MICROS


def in_time(micros) -> Column:
    """Whether microseconds are within the times a vote may have; NULL for NULL."""
    return _col(micros).between(-MAX_US, MAX_US)


def micros_of_seconds(seconds) -> Column:
    """Epoch seconds (double) as bigint microseconds; NULL when not a time a vote may have."""
    seconds = _col(seconds)
    usable = ~F.isnan(seconds) & (F.abs(seconds) <= F.lit(float(MAX_SECONDS)))
    return F.when(usable, F.rint(seconds * F.lit(float(MICROS))).cast("bigint"))


def seconds_of_micros(micros) -> Column:
    """Bigint microseconds as double seconds, for the output edge."""
    return _col(micros).cast("double") / F.lit(float(MICROS))


def micros_of_timestamp(ts) -> Column:
    """Microseconds since 1970 of a zone-less timestamp, whatever the session zone.

    A cast to ``timestamp`` would read the value in the session time zone;
    the difference to a zone-less epoch does not.
    """
    elapsed = _col(ts) - F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    return F.call_function("div", elapsed, F.expr("interval '0.000001' second"))


def floor_div(value, step: int) -> Column:
    """Whole steps below a bigint value, rounding down for negatives too."""
    value = _col(value)
    whole = F.call_function("div", value - F.pmod(value, F.lit(step)), F.lit(step))
    return whole.cast("bigint")


# --- vote id -------------------------------------------------------------


def vote_id(stream, sequence) -> Column:
    return F.concat_ws("-", _col(stream).cast("string"), _col(sequence).cast("string"))


def stream_of(id_column) -> Column:
    """Stream number in front of the dash; NULL if it is not a number."""
    return F.substring_index(_col(id_column), "-", 1).try_cast("bigint")


def sequence_of(id_column) -> Column:
    """Row number behind the dash; NULL if it is not a number."""
    return F.split_part(_col(id_column), F.lit("-"), F.lit(2)).try_cast("bigint")


# --- party ---------------------------------------------------------------


def encode_party(flag) -> Column:
    """0/1 flag of a raw vote as a party code."""
    return F.when(_col(flag).cast("boolean"), F.lit("D")).otherwise(F.lit("R"))


def is_democrat(party) -> Column:
    """Only ``D`` counts as Democrat; every other code is a Republican vote."""
    return _col(party) == F.lit("D")


def winner_of(democrat_votes, republican_votes) -> Column:
    """A tie, also at zero votes, goes to the Democrat."""
    ahead = _col(republican_votes) > _col(democrat_votes)
    return F.when(ahead, F.lit(REPUBLICAN)).otherwise(F.lit(DEMOCRAT))


def colour_of(winner) -> Column:
    choice = F.lit(None).cast("string")
    for party, colour in PARTY_COLOURS.items():
        choice = F.when(_col(winner) == party, F.lit(colour)).otherwise(choice)
    return choice


# --- validity ------------------------------------------------------------


def reject_reason(columns, known_state) -> Column:
    """Why a row cannot be counted, or NULL when it can.

    ``columns`` are the columns the row has; ``malformed`` and ``event_time``
    only exist where votes came in as text.
    """
    reason = F.when(~F.coalesce(_col(known_state), F.lit(False)), F.lit("unknown_state"))
    bad_time = ~in_time("event_us")
    if "arrival_us" in columns:
        bad_time = bad_time | ~in_time("arrival_us")
    if "event_time" in columns:
        missing_time = F.col("event_time").isNull()
        bad_time = bad_time | F.col("event_us").isNull()
    else:
        missing_time = F.col("event_us").isNull()
    reason = F.when(F.coalesce(bad_time, F.lit(False)), F.lit("bad_time")).otherwise(reason)
    missing = F.col("state").isNull() | F.col("party").isNull() | missing_time
    reason = F.when(missing, F.lit("missing_field")).otherwise(reason)
    if "malformed" in columns:
        reason = F.when(F.col("malformed"), F.lit("malformed")).otherwise(reason)
    return reason
