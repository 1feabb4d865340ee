"""Counting votes and merging counts."""

from pyspark.sql import DataFrame, functions as F

from ..functions import is_democrat


def count_votes(votes: DataFrame, keys=("state",)) -> DataFrame:
    """``Dvotes``, ``Rvotes`` and newest event time for each key.

    Counts are formed before the shuffle, so it moves at most one row per key
    and task, however uneven the keys are.
    """
    democrat = is_democrat("party")
    return votes.groupBy(*keys).agg(
        F.count_if(democrat).alias("Dvotes"),
        F.count_if(~democrat).alias("Rvotes"),
        F.max("event_us").alias("event_us"),
    )


def merge_partials(partials: DataFrame, keys=("state",)) -> DataFrame:
    """Partial counts of a key added up."""
    return partials.groupBy(*keys).agg(
        F.sum("Dvotes").alias("Dvotes"),
        F.sum("Rvotes").alias("Rvotes"),
        F.max("event_us").alias("event_us"),
    )


def seed_totals(states: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """A row for every listed state, at zero where nothing was counted.

    Totals of a state that is not listed have no row to be added to.
    """
    if totals is None:
        return states.select("state", F.lit(0).cast("bigint").alias("Dvotes"),
                             F.lit(0).cast("bigint").alias("Rvotes"))
    return states.join(totals, "state", "left").select(
        "state",
        F.coalesce("Dvotes", F.lit(0).cast("bigint")).alias("Dvotes"),
        F.coalesce("Rvotes", F.lit(0).cast("bigint")).alias("Rvotes"),
    )


def national_totals(totals: DataFrame) -> DataFrame:
    """One row: votes of each party and of both over all states."""
    democrat = F.coalesce(F.sum("Dvotes"), F.lit(0).cast("bigint"))
    republican = F.coalesce(F.sum("Rvotes"), F.lit(0).cast("bigint"))
    return totals.agg(
        democrat.alias("Democrat"),
        republican.alias("Republican"),
        (democrat + republican).alias("Total"),
    )
