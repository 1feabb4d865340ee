"""Dropping repeated deliveries of a vote. Never done unless asked for.

A vote without an id cannot be told to be a repetition, so all of those are kept.
"""

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions import sequence_of, stream_of, vote_id

_ORDER = ("event_us", "state", "party", "arrival_us")

#: Row numbers remembered together.
BUCKET = 32_768
#: Parts that ids of another form, and votes without one, are dealt out to.
SPREAD = 1_024

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def dedup_votes(votes: DataFrame, order=_ORDER) -> DataFrame:
    """One row per vote id: the first in ``order``; and every row without an id.

    The smallest row is kept by an aggregate rather than by ranking, so copies
    are dropped before the shuffle. Rows without an id are dealt out by a number of their own.
    """
    order = [c for c in order if c in votes.columns]
    rest = [c for c in votes.columns if c != "id" and c not in order]
    first = F.min(F.struct(*order, *rest)).alias("first")
    own = F.when(F.col("id").isNull(), F.monotonically_increasing_id()).alias("_own")
    kept = votes.select("*", own).groupBy("id", "_own").agg(first)
    return kept.select("id", "first.*").select(*votes.columns)


# --- in a stream -------------------------------------------------------------


def pack(places: np.ndarray) -> bytes:
    """Ascending places within a bucket: two bytes each while they are few, else a bit for every place."""
    if len(places) * 16 < BUCKET:
        return places.astype("<u2").tobytes()
    bits = np.zeros(BUCKET, np.uint8)
    bits[places] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def unpack(packed: bytes) -> np.ndarray:
    if len(packed) < BUCKET // 8:
        return np.frombuffer(packed, "<u2").astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(packed, np.uint8), bitorder="little"))


class _Unseen(StatefulProcessor):
    """Passes on the first vote of each id; remembers the places of one bucket, or ids as they are."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "places binary")
        self.others = handle.getMapState("others", "id string", "seen boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        own = self._unnumbered(rows) if pd.isna(key[0]) else self._numbered(rows)
        for chunk in own:
            if len(chunk):
                yield chunk.drop(columns=["of_stream", "of_bucket", "of_place"])

    def _numbered(self, rows):
        seen = np.zeros(BUCKET, bool)
        if self.seen.exists():
            seen[unpack(self.seen.get()[0])] = True
        for chunk in rows:
            places = chunk["of_place"].to_numpy()
            _, first = np.unique(places, return_index=True)
            fresh = np.sort(first[~seen[places[first]]])
            seen[places[fresh]] = True
            yield chunk.iloc[fresh]
        self.seen.update((pack(np.flatnonzero(seen)),))

    def _unnumbered(self, rows):
        for chunk in rows:
            none = chunk["id"] == ""
            fresh = none | ~chunk["id"].duplicated()
            for i in chunk.index[fresh & ~none]:
                if self.others.containsKey((chunk.at[i, "id"],)):
                    fresh[i] = False
                else:
                    self.others.updateValue((chunk.at[i, "id"],), (True,))
            yield chunk[fresh]

    def close(self) -> None:
        pass


def dedup_stream(votes: DataFrame) -> DataFrame:
    """Streaming twin: passes on the first delivery of each id, however late it comes.

    No vote is lost, so every id is remembered for as long as the stream runs, in a bit: the row numbers
    of a stream are kept in buckets of ``BUCKET``, each of at most 4 KiB. This state needs RocksDB, on the
    disks of the executors, so the session is set to it for streams started from here on. Ids that are not a stream's number, a dash and
    a row number, written without leading zeros, are remembered as they are. Votes without an id
    are all passed on.

    Takes votes that ``valid_votes`` has let through, as rejects often have no id of their own.
    """
    if "malformed" in votes.columns:
        raise ValueError("dedup_stream takes valid votes; apply valid_votes first")
    votes.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
    known = F.coalesce(vote_id(stream_of("id"), sequence_of("id")) == F.col("id"), F.lit(False))
    sequence = F.when(known, sequence_of("id"))
    spread = F.pmod(F.xxhash64("id", "event_us"), F.lit(SPREAD))  # without an id, the time decides
    bucket = F.when(known, F.call_function("div", sequence, F.lit(BUCKET)))
    # Names that begin with an underscore do not reach the processor. Votes pass through pandas as
    # text behind a mark, and NULL as nothing: other kinds do not stay what they are there.
    placed = votes.select(
        *[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")).alias(c) for c in votes.columns],
        F.when(known, stream_of("id")).alias("of_stream"),
        F.coalesce(bucket, F.when(F.col("id").isNull(), spread), F.pmod(F.xxhash64("id"), F.lit(SPREAD))).alias("of_bucket"),
        F.coalesce(sequence % BUCKET, F.lit(-1)).alias("of_place"),
    )
    text = T.StructType([T.StructField(c, T.StringType()) for c in votes.columns])
    once = placed.groupBy("of_stream", "of_bucket").transformWithStateInPandas(
        statefulProcessor=_Unseen(), outputStructType=text, outputMode="append", timeMode="none"
    )
    back = lambda f: F.when(F.col(f.name) != "", F.expr(f"substring(`{f.name}`, 2)")).cast(f.dataType)
    return once.select(*[back(f).alias(f.name) for f in votes.schema.fields])
