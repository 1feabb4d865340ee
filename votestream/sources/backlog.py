"""Votes from files, so many rows of each stream at a time.

A stream is a folder of Parquet files (or a single file). Its offset is a file and a row of it. Files
are taken in the order of their names, so names must grow, as those with a time or a number in front
do. A micro-batch goes on by at most ``rows`` rows of each stream, so a job that has fallen behind
catches up in steps it can hold. The driver reads the footers of files only; tasks read
ranges of rows, cut at row groups.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

NAME = "bounded_votes"

# Workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass
class Rows(InputPartition):
    """Rows ``first`` to ``last`` (not included) of the row group ``group``."""

    file: str
    group: int
    first: int
    last: int


class BoundedVotes(DataSource):
    """Options: ``path``, and ``rows`` to take in of each stream in a micro-batch."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Reader(self.options["path"], int(self.options["rows"]), schema)


class _Reader(DataSourceStreamReader):
    """Offsets: for each stream the file it is at (its name) and the rows of it that are done.

    The engine does not say where it is when it asks how far to go. It starts from the initial offset, or
    after a restart plans the last batch of its log first, so the end of that is known.
    """

    def __init__(self, path: str, rows: int, schema):
        if rows < 1:
            raise ValueError("a micro-batch must be allowed at least one row")
        self.path, self.rows, self.schema = path, rows, schema
        self.at: dict | None = None
        self._counts: dict[str, list[int]] = {}

    # --- in the driver

    def _files(self) -> dict[str, list[str]]:
        """The files of each stream, in order."""
        system, root = fs.FileSystem.from_uri(self.path)
        if system.get_file_info(root).type == fs.FileType.File:
            return {"": [root]}
        found: dict[str, list[str]] = {}
        for info in system.get_file_info(fs.FileSelector(root, recursive=True)):
            parts = info.path.removeprefix(root).strip("/").split("/")
            if info.type == fs.FileType.File and not any(p.startswith(("_", ".")) for p in parts):
                found.setdefault("/".join(parts[:-1]), []).append(info.path)
        return {stream: sorted(files) for stream, files in sorted(found.items())}

    def _groups(self, file: str) -> list[int]:
        """Rows of each row group of a file; files do not change once they are there."""
        if file not in self._counts:
            system, _ = fs.FileSystem.from_uri(self.path)
            footer = pq.read_metadata(file, filesystem=system)
            self._counts[file] = [footer.row_group(i).num_rows for i in range(footer.num_row_groups)]
        return self._counts[file]

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        at = dict(self.initialOffset() if self.at is None else self.at)
        for stream, files in self._files().items():
            file, done = at.get(stream, ["", 0])
            left = self.rows
            for name in files:
                base = name.rpartition("/")[2]
                if base < file or not left:
                    continue
                done = done if base == file else 0
                step = min(left, sum(self._groups(name)) - done)
                if step > 0:
                    file, done, left = base, done + step, left - step
            if file:
                at[stream] = [file, done]
        self.at = at
        return at

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        if self.at is None:
            self.at = end
        out = []
        for stream, files in self._files().items():
            (file, done), (to, until) = start.get(stream, ["", 0]), end.get(stream, ["", 0])
            for name in files:
                base = name.rpartition("/")[2]
                if not file <= base <= to:
                    continue
                groups = self._groups(name)
                low, high = done if base == file else 0, until if base == to else sum(groups)
                begin = 0
                for group, size in enumerate(groups):
                    first, last = max(low - begin, 0), min(high - begin, size)
                    if first < last:
                        out.append(Rows(name, group, first, last))
                    begin += size
        return out

    def commit(self, end: dict) -> None:
        kept = {file for file, _ in end.values()}
        self._counts = {f: n for f, n in self._counts.items() if f.rpartition("/")[2] in kept}

    # --- in the tasks

    def read(self, partition: Rows) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        system, _ = fs.FileSystem.from_uri(self.path)
        wanted = to_arrow_schema(self.schema)
        begin = 0
        with pq.ParquetFile(partition.file, filesystem=system) as file:
            for batch in file.iter_batches(row_groups=[partition.group], columns=wanted.names):
                first, last = max(partition.first - begin, 0), min(partition.last - begin, len(batch))
                begin += len(batch)
                if first < last:
                    rows = pa.Table.from_batches([batch.slice(first, last - first)]).select(wanted.names)
                    yield from rows.cast(wanted).to_batches()


def read_bounded(spark: SparkSession, path: str, rows: int, schema: str) -> DataFrame:
    """Rows of the Parquet files at ``path`` as a stream, at most ``rows`` of each stream a micro-batch.

    ``backlog_rows`` gives the usual bound. ``path`` is one that Arrow can open on every machine. Columns
    are those of ``schema``; others of the files are not read.
    """
    spark.dataSource.register(BoundedVotes)
    return spark.readStream.format(NAME).schema(schema).option("path", path).option("rows", rows).load()
