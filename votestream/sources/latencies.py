"""Latency logs as CSV with a ``time,latency`` header."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schema import LATENCY

# Fixed format: a run's settings are in its path, <n>nodes/<rate>_<n>node.res
RUN_PATH = r"(\d+)nodes/(\d+)_\d+node\.res"


def export_latencies(latencies: DataFrame, path: str) -> None:
    latencies.select("time", "latency").write.mode("overwrite").option("header", True).csv(path)


def read_latencies(spark: SparkSession, path) -> DataFrame:
    """Latency rows with the ``nodes`` and ``rate`` of the run they belong to.

    ``path`` may be a glob over many runs. The settings are NULL for a file
    whose path does not carry them.
    """
    origin = F.col("_metadata.file_path")
    setting = lambda group: F.regexp_extract(origin, RUN_PATH, group).try_cast("int")
    return (
        spark.read.schema(LATENCY)
        .option("header", True)
        .csv(path)
        .select(setting(1).alias("nodes"), setting(2).alias("rate"), "time", "latency")
    )


def run_path(root: str, nodes: int, rate: int) -> str:
    """Where the log of a run with these settings belongs."""
    return f"{root.rstrip('/')}/{nodes}nodes/{rate}_{nodes}node.res"
