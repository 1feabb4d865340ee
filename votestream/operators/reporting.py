"""Reports over the totals of the states."""

from pyspark.sql import DataFrame

from ..functions import colour_of, winner_of


def winners(totals: DataFrame) -> DataFrame:
    """Totals with the party ahead in each state."""
    return totals.withColumn("winner", winner_of("Dvotes", "Rvotes"))


def map_table(totals: DataFrame) -> DataFrame:
    """What a map of the states shows: winner, its colour and the counts."""
    return winners(totals).select(
        "state", "winner", "Rvotes", "Dvotes", colour_of("winner").alias("colour")
    )
