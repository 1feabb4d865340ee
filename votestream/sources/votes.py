"""Votes as JSON lines, in batch and as a stream."""

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions import micros_of_seconds, seconds_of_micros, stream_of
from ..schema import VOTE_JSON

_CORRUPT = "_corrupt"
# Columns that parsing makes; those of the same name are not passed on.
_OWN = ("value", "id", "state", "party", "event_time", "stream", "event_us", "malformed", "line",
        _CORRUPT)
_LENIENT = T.StructType(VOTE_JSON.fields + [T.StructField(_CORRUPT, T.StringType())])


def parse_votes(lines: DataFrame, strict: bool = False) -> DataFrame:
    """JSON text lines to votes.

    Lenient parsing keeps every line: what cannot be read has ``malformed`` set
    and its text in ``line``. Strict parsing fails the query on such a line.
    Both leave missing fields as NULL and blank lines ``malformed``, to be told
    apart by ``split_valid``. Other columns of ``lines``, such as ``arrival_us``, are
    passed on, unless a vote has a field of that name.
    """
    if strict:
        vote = F.from_json("value", VOTE_JSON, {"mode": "FAILFAST"})
        unreadable = F.lit(False)
    else:
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
        vote = F.from_json("value", _LENIENT, options)
        unreadable = F.col(_CORRUPT).isNotNull()
    # Taken apart by inline, a line is parsed once. As a plain projection it would
    # be parsed again by every filter that is pushed below it.
    carried = [c for c in lines.columns if c not in _OWN]
    fields = lines.select(*carried, F.col("value").alias("line"), F.inline(F.array(vote)))
    # A blank line parses to nothing without being reported. Only lines that gave
    # nothing are looked at again.
    nothing = F.coalesce("id", "state", "party", F.col("event_time").cast("string")).isNull()
    blank = nothing & F.coalesce(F.col("line").rlike(r"^\s*$"), F.lit(True))
    return fields.select(
        "id",
        "state",
        "party",
        "event_time",
        stream_of("id").alias("stream"),
        micros_of_seconds("event_time").alias("event_us"),
        (unreadable | blank).alias("malformed"),
        "line",
        *carried,
    )


def encode_votes(votes: DataFrame, carried=()) -> DataFrame:
    """Votes to JSON text lines in a column ``value``, beside the ``carried`` columns."""
    return votes.select(
        F.to_json(
            F.struct("id", "state", "party", seconds_of_micros("event_us").alias("event_time"))
        ).alias("value"),
        *carried,
    )


def _arrived(files: DataFrame) -> DataFrame:
    """Lines of files, with the time their file was written as the time of arrival."""
    written = F.unix_micros(F.col("_metadata.file_modification_time"))
    return files.select("value", written.alias("arrival_us"))


def read_votes(spark: SparkSession, path, strict: bool = False) -> DataFrame:
    """All votes below ``path`` (a folder, a glob, or a list of them).

    A vote arrives when its file is written.
    """
    return parse_votes(_arrived(spark.read.text(path)), strict)


def read_vote_stream(
    spark: SparkSession,
    path: str,
    max_files: int | None = None,
    max_bytes: str | None = None,
    strict: bool = False,
) -> DataFrame:
    """Votes from files as they appear below ``path``.

    ``max_files`` or ``max_bytes`` bound what one micro-batch may take in. A vote arrives
    when its file is written. A message queue is read the same way: hand ``parse_votes`` its text as
    ``value`` and the time of a message in microseconds as ``arrival_us``.
    """
    reader = spark.readStream.format("text").schema("value string")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return parse_votes(_arrived(reader.load(path)), strict)


def merge_streams(streams: Iterable[DataFrame]) -> DataFrame:
    """Votes of several inputs as one, where a path glob cannot name them all."""
    return reduce(DataFrame.unionByName, streams)


def write_votes(votes: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """Votes as JSON line files of at most ``rows_per_file`` rows."""
    writer = encode_votes(votes).write.mode("overwrite")
    writer.option("maxRecordsPerFile", rows_per_file).text(path)
