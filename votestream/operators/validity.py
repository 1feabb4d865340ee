"""Telling votes that can be counted from votes that cannot."""

from pyspark.sql import DataFrame, functions as F

from ..functions import in_time, reject_reason
from ..sources.states import states_df

_CARRIED = ("malformed", "line", "event_time")


def _listed(votes: DataFrame, states: DataFrame | None) -> DataFrame:
    # The built-in list has 50 rows and may be broadcast; how to join a caller's
    # list is left to the planner.
    if states is None:
        return states_df(votes.sparkSession)
    return states.select("state").distinct()


def valid_votes(votes: DataFrame, states: DataFrame | None = None) -> DataFrame:
    """Votes with every field, times that can be reckoned with, and a listed state."""
    complete = F.col("party").isNotNull() & in_time("event_us")
    if "arrival_us" in votes.columns:
        complete = complete & F.coalesce(in_time("arrival_us"), F.lit(True))
    if "malformed" in votes.columns:
        complete = complete & ~F.col("malformed")
    listed = _listed(votes, states)
    if states is None:
        listed = F.broadcast(listed)
    kept = [c for c in votes.columns if c not in _CARRIED]
    return votes.where(complete).join(listed, "state", "left_semi").select(*kept)


def classified_votes(votes: DataFrame, states: DataFrame | None = None) -> DataFrame:
    """All votes, with the ``reason`` to turn them away, or NULL."""
    listed = _listed(votes, states).select("state", F.lit(True).alias("listed"))
    if states is None:
        listed = F.broadcast(listed)
    return votes.join(listed, "state", "left").select(
        *votes.columns, reject_reason(votes.columns, "listed").alias("reason")
    )


def rejected_votes(votes: DataFrame, states: DataFrame | None = None) -> DataFrame:
    """All other votes, with the ``reason`` each one is turned away for."""
    return classified_votes(votes, states).where(F.col("reason").isNotNull())


def split_valid(votes: DataFrame, states: DataFrame | None = None):
    """``(valid, rejects)``; each vote is in exactly one of them."""
    return valid_votes(votes, states), rejected_votes(votes, states)
