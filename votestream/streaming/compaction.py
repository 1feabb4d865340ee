"""Merging the folders of old micro-batches while the job that writes them runs.

A long job leaves a folder for every micro-batch. ``compact`` merges those up to a committed one into a
segment, ``_segments/<first>-<last>``, and then publishes a manifest: the list of segments that stand for
all batches up to the last of them. A manifest is written under another name and renamed, so it is
there as a whole or not at all, and the one with the highest number counts. Readers take the segments it
names and the folders of later batches. So nothing is counted twice:

- A crash before the manifest is published leaves a segment that none names; it is written over or
  removed later.
- A crash after it leaves folders of batches that readers already pass over.

What a manifest replaces is removed when the next one is published, so that whoever has just read the
older one can still finish. With a compaction every ``n`` batches there are at most about 2n folders of
batches at any time.

Segments of a log are merged in steps: ``FAN`` of one size make one of the next. So a row is
copied about as often as the logarithm of the number of batches.
"""

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

BATCH = "batch_id"
#: Segments of one size that are merged into one of the next.
FAN = 8


@dataclass(frozen=True, order=True)
class Segment:
    """Batches ``first`` to ``last``; ``level`` is how often its rows have been merged."""

    first: int
    last: int
    level: int

    def folder(self, path: str) -> str:
        return f"{path}/_segments/{self.first}-{self.last}"


class _Folder:
    """What is below a path, by Hadoop's file systems, so in any store Spark writes to."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark._jvm, path.rstrip("/")
        self.system = self._at(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def names(self, below: str = "") -> list[str]:
        at = self._at(f"{self.path}/{below}" if below else self.path)
        if not self.system.exists(at):
            return []
        return [status.getPath().getName() for status in self.system.listStatus(at)]

    def batches(self) -> list[int]:
        found = (n.removeprefix(f"{BATCH}=") for n in self.names() if n.startswith(f"{BATCH}="))
        return sorted(int(n) for n in found if n.lstrip("-").isdigit())

    def manifests(self) -> list[int]:
        return sorted(int(n) for n in self.names("_manifests") if n.isdigit())

    def read(self, number: int) -> list[Segment]:
        stream = self.system.open(self._at(f"{self.path}/_manifests/{number:012d}"))
        try:
            text = self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return [Segment(*s) for s in json.loads(text)]

    def publish(self, number: int, segments: list[Segment]) -> None:
        text = json.dumps([[s.first, s.last, s.level] for s in segments])
        draft = self._at(f"{self.path}/_manifests/.draft-{number:012d}")
        stream = self.system.create(draft, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if not self.system.rename(draft, self._at(f"{self.path}/_manifests/{number:012d}")):
            raise RuntimeError(f"manifest {number} of {self.path} has been published by another job")

    def remove(self, name: str) -> None:
        self.system.delete(self._at(f"{self.path}/{name}"), True)


def segments(spark: SparkSession, path: str) -> list[Segment]:
    """The segments of the newest manifest."""
    folder = _Folder(spark, path)
    numbers = folder.manifests()
    return folder.read(numbers[-1]) if numbers else []


def read_batches(spark: SparkSession, path: str, schema) -> DataFrame:
    """All rows, of segments and of the batches behind them, with their batch id.

    Rows of merged counts have the id of the last batch in them. ``schema`` has the columns with the id.
    """
    path = path.rstrip("/")
    folder, merged = _Folder(spark, path), segments(spark, path)
    last = merged[-1].last if merged else None
    if last is None:
        return spark.read.schema(schema).parquet(path)
    later = [f"{path}/{BATCH}={n}" for n in folder.batches() if n > last]
    rows = spark.read.schema(schema).parquet(*[s.folder(path) for s in merged])
    if later:
        rows = rows.unionByName(spark.read.schema(schema).option("basePath", path).parquet(*later))
    return rows


def compacted_to(spark: SparkSession, path: str) -> int:
    """The newest batch that is part of a segment; -1 if none is."""
    merged = segments(spark, path)
    return merged[-1].last if merged else -1


def compact(
    spark: SparkSession,
    path: str,
    upto: int,
    schema,
    merge: Callable[[DataFrame, int], DataFrame],
    whole: bool,
) -> None:
    """Replaces the batches up to ``upto``, all of them committed, by segments.

    ``merge`` takes rows and the last batch they are from, and gives the rows of a segment. With
    ``whole`` there is one segment, else they are kept apart by size.
    """
    path = path.rstrip("/")
    folder = _Folder(spark, path)
    numbers = folder.manifests()
    old = folder.read(numbers[-1]) if numbers else []
    begin = old[-1].last + 1 if old else 0
    fresh = [n for n in folder.batches() if begin <= n <= upto]
    if not fresh:
        return
    new, taken, level = list(old), [], 0
    if whole:
        new, taken = [], new
    while not whole and sum(s.level == level for s in new) >= FAN - 1:
        taken = [s for s in new if s.level == level] + taken
        new = [s for s in new if s.level != level]
        level += 1
    target = Segment(taken[0].first if taken else begin, upto, level)
    rows = spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/{BATCH}={n}" for n in fresh])
    if taken:
        rows = rows.unionByName(spark.read.schema(schema).parquet(*[s.folder(path) for s in taken]))
    merge(rows, upto).write.mode("overwrite").parquet(target.folder(path))
    number = numbers[-1] + 1 if numbers else 0
    folder.publish(number, [*new, target])
    # What only older manifests than the last two need can go.
    named = {s.folder(path).rpartition("/")[2] for s in [*old, *new, target]}
    for n in folder.batches():
        if n < begin:
            folder.remove(f"{BATCH}={n}")
    for name in folder.names("_segments"):
        if name not in named:
            folder.remove(f"_segments/{name}")
    for n in numbers[:-1]:
        folder.remove(f"_manifests/{n:012d}")
