"""The list of states that may be counted."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schema import STATES


def states_df(spark: SparkSession) -> DataFrame:
    """The built-in list: 50 rows, always, so it is safe to broadcast."""
    listed = ", ".join(f"('{code}')" for code in STATES)
    return spark.sql(f"select state from values {listed} as listed(state)")


def read_states(spark: SparkSession, path: str) -> DataFrame:
    """A state list kept as text, one code per line."""
    code = F.trim("value")
    return spark.read.text(path).select(code.alias("state")).where(code != "").distinct()
