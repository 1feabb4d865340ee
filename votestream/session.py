"""Session set-up and the scratch folder shared by driver and executors."""

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", partitions: int = 8, **conf) -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("votestream")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    A folder of this machine is only made where the setting is missing and the whole
    application runs in one process. On a cluster a missing setting is an error.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if current is None:
        if configured is None:
            if re.match(r"local(\[|$)", context.master) is None:
                raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
            configured = tempfile.mkdtemp(prefix="votestream-")
        context.setCheckpointDir(configured)
        current = context.getCheckpointDir()
    return configured or current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing exists there yet."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
