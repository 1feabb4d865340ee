"""Removal of long byte strings that occur more than once, by a suffix sort.

A byte goes if it lies in a string of ``length`` bytes that also starts elsewhere, be it in
the same text. The suffixes in question are found, then sorted.

1. Anchors (``anchors``) stand for runs of windows. A window whose anchor's bytes occur
   once in the corpus occurs once itself, so most anchors drop out by a count.
2. A run of windows is a block of text. Of blocks that are equal (by 128 bits of two
   polynomial hashes) all windows are repeated, and one copy is kept for comparison. If an
   anchor has one kind of block only, that is all: copies of whole texts end here.
3. Other anchors have several kinds, mostly at the ends of repeated passages. The suffixes that
   begin in their blocks are sorted by merging runs. Two suffixes are compared by the
   length of their common beginning: a binary search over prefix hashes finds it. Neighbours
   that agree in ``length`` bytes by hash are compared byte by byte.
4. An anchor with more than ``SORT_BLOCKS`` kinds of blocks is not sorted in one task. The hashes of its
   windows are counted instead, by all tasks, which also is exact (128 bits).

Bytes are shuffled twice, compressed: to cut blocks out, and to remove what is repeated.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, functions as F, types as T

from ..operators import materialise
from ..session import scratch_path
from .anchors import BLOCK, anchor_runs
from .arrays import SECOND_POWERS, Rolling, mixed, ranges, utf8
from .shipping import in_arrow

LENGTH = 200
SORT_BLOCKS = 2_000
#: Bytes of blocks that are sorted together.
SORT_BYTES = 1 << 20

_U = np.uint64
_DOC = ["doc_id", "tag"]
_PLACE = ["lo", "windows", "off"]
_LONGS = lambda *names: T.StructType([T.StructField(n, T.LongType()) for n in names])


def _texts(documents: DataFrame) -> DataFrame:
    """Texts by doc_id and a small hash, which tells texts with the same doc_id apart."""
    text = F.coalesce(F.col("text"), F.lit(""))
    tag = F.pmod(F.xxhash64(text), F.lit(1 << 31)).alias("tag")
    return documents.select(F.col("doc_id").cast("bigint"), tag, text.alias("text"))


def _pieces(data: np.ndarray, offsets: np.ndarray, length: int):
    """Blocks of texts for ``anchor_runs``: index of the first text, bytes, offsets, shift.

    A text larger than a block is taken in pieces that overlap by all but one byte of a window.
    """
    first, texts = 0, len(offsets) - 1
    while first < texts:
        last = int(np.searchsorted(offsets, offsets[first] + BLOCK, "right")) - 1
        if last > first:
            own = offsets[first : last + 1]
            yield first, data[own[0] : own[-1]], own - own[0], 0
            first = last
            continue
        begin, end = int(offsets[first]), int(offsets[first + 1])
        step = BLOCK - length + 1
        for at in range(begin, max(begin + 1, end - length + 1), step):
            own = data[at : min(end, at + BLOCK)]
            yield first, own, np.array([0, len(own)]), at - begin
        first += 1


_ANCHORS = _LONGS("key", "digest", *_DOC, *_PLACE)


def anchors(texts: DataFrame, length: int) -> DataFrame:
    """One row per run of windows with the same anchor.

    ``key`` is a hash of the anchor's bytes and ``digest`` one of all bytes of the run's
    windows. ``lo`` is the first window, ``off`` how far behind it the anchor lies.
    """

    def find(batches):
        for batch in batches:
            ids, tags = batch.column(0), batch.column(1)
            data, offsets = utf8(batch.column(2))
            for first, own, places, shift in _pieces(data, offsets, length):
                begin, end, anchor, key = anchor_runs(own, places, length)
                if not len(begin):
                    continue
                digest = mixed(Rolling(own, SECOND_POWERS).of(begin, end + length))
                text = np.searchsorted(places, begin, "right") - 1
                at = pa.array(text + first)
                columns = [begin - places[text] + shift, end - begin + 1, anchor - begin]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(digest.view(np.int64)),
                     ids.take(at), tags.take(at), *map(pa.array, columns)], _ANCHORS.names)

    return in_arrow(texts, find, _ANCHORS)


_PACKED = T.StructType([*_LONGS(*_DOC).fields, T.StructField("packed", T.BinaryType())])


def _packed(texts: DataFrame) -> DataFrame:
    """Texts compressed, for shuffles."""

    def pack(batches):
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            view = memoryview(data)
            packed = [press.compress(view[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(packed, pa.binary())], _PACKED.names)

    return in_arrow(texts, pack, _PACKED)


_BLOCKS = T.StructType([
    *_LONGS("key", "digest", "copies", *_DOC, "lo").fields, T.StructField("hot", T.BooleanType()),
    T.StructField("bytes", T.BinaryType()),
])


def _cut_out(blocks: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    """``blocks`` with their bytes."""
    wanted = blocks.groupBy(*_DOC).agg(F.collect_list(
        F.struct("key", "digest", "copies", "lo", "windows", "hot")).alias("wanted"))

    def cut(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for one in range(batch.num_rows):
                text = unpack.decompress(batch.column(2)[one].as_py())
                rows = batch.column(3)[one].as_py()
                for row in rows:
                    row["bytes"] = text[row["lo"] : row["lo"] + row.pop("windows") + length - 1]
                    row["doc_id"], row["tag"] = batch.column(0)[one].as_py(), batch.column(1)[one].as_py()
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    arrow = pa.schema([(f.name, {T.LongType: pa.int64(), T.BooleanType: pa.bool_(),
                                 T.BinaryType: pa.binary()}[type(f.dataType)]) for f in _BLOCKS])
    joined = _on_document(_packed(texts), wanted, "inner").select(*_DOC, "packed", "wanted")
    return in_arrow(joined, cut, _BLOCKS)


def _on_document(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    right = right.withColumnsRenamed({c: f"_{c}" for c in _DOC})
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("tag") == F.col("_tag"))
    return left.join(right, same, how).drop("_doc_id", "_tag")


class Suffixes:
    """Suffixes of blocks, compared over their first ``length`` bytes."""

    def __init__(self, data: np.ndarray, places: np.ndarray, length: int):
        self.data, self.places, self.length = data, places, length
        self.rolling = Rolling(data)
        self.whole = self.rolling.of(places, places + length)

    def before(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 as suffix ``x`` sorts before, like or behind suffix ``y``."""
        order = np.zeros(len(x), np.int8)
        other = np.flatnonzero(self.whole[x] != self.whole[y])
        a, b = self.places[x[other]], self.places[y[other]]
        low, high = np.zeros(len(a), np.int64), np.full(len(a), self.length - 1)
        while len(a) and (low < high).any():  # the longest common beginning
            middle = (low + high + 1) // 2
            same = self.rolling.of(a, a + middle) == self.rolling.of(b, b + middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        order[other] = np.where(self.data[a + low] < self.data[b + low], -1, 1)
        return order

    def sorted(self, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes in order within segments of ``groups``, and the segment of each.

        Segments also have their first bytes in common; those of one suffix are left out.
        """
        head = np.zeros(len(self.places), _U)
        for i in range(8):
            head = (head << _U(8)) | self.data[self.places + i].astype(_U)
        order = np.lexsort((head, groups))
        fresh = np.empty(len(order), bool)
        fresh[:1] = True
        fresh[1:] = (groups[order][1:] != groups[order][:-1]) | (head[order][1:] != head[order][:-1])
        segment = np.cumsum(fresh) - 1
        several = np.bincount(segment, minlength=1)[segment] > 1
        order, segment = order[several], segment[several]
        if not len(order):
            return order, segment
        first = np.flatnonzero(np.append(True, segment[1:] != segment[:-1]))
        sizes = np.diff(np.append(first, len(order)))
        begin, end = np.repeat(first, sizes), np.repeat(first + sizes, sizes)
        width = 1
        while width < sizes.max():
            order = self._merge(order, begin, end, width)
            width *= 2
        return order, segment

    def _merge(self, order, begin, end, width):
        """Merges neighbouring runs of ``width`` suffixes within each segment."""
        index = np.arange(len(order))
        run = (index - begin) // width
        left = run % 2 == 0
        own = begin + run * width
        other = np.where(left, own + width, own - width)
        low, high = np.minimum(other, end), np.minimum(other + width, end)
        merged, base = np.empty_like(order), np.where(left, own, other)
        floor = low.copy()
        open_ = np.flatnonzero(low < high)
        while len(open_):
            middle = (low[open_] + high[open_]) // 2
            order_of = self.before(order[middle], order[open_])
            # Of equal suffixes, those of the left run come first.
            goes_before = np.where(left[open_], order_of < 0, order_of <= 0)
            low[open_] = np.where(goes_before, middle + 1, low[open_])
            high[open_] = np.where(goes_before, high[open_], middle)
            open_ = open_[low[open_] < high[open_]]
        merged[base + (index - own) + (low - floor)] = order
        return merged

    def repeated(self, groups: np.ndarray) -> np.ndarray:
        """Which suffixes agree in ``length`` bytes with another one of their group."""
        order, segment = self.sorted(groups)
        found = np.zeros(len(self.places), bool)
        near = np.flatnonzero((segment[1:] == segment[:-1])
                              & (self.whole[order[1:]] == self.whole[order[:-1]]))
        for at in range(0, len(near), 4096):
            x, y = order[near[at : at + 4096]], order[near[at : at + 4096] + 1]
            across = np.arange(self.length)
            same = (self.data[self.places[x][:, None] + across]
                    == self.data[self.places[y][:, None] + across]).all(axis=1)
            found[x[same]] = found[y[same]] = True
        return found


_FOUND = _LONGS(*_DOC, "first", "end")


def _sorted_blocks(blocks: DataFrame, length: int) -> DataFrame:
    """Repeated ranges of bytes in blocks without a copy. Blocks come in order of key."""

    def search(batches):
        held = []
        for batch in batches:
            held.append(batch)
            if sum(b.column("bytes").nbytes for b in held) > SORT_BYTES:
                rows = pa.Table.from_batches(held).combine_chunks()
                keys = rows.column("key").to_numpy()
                earlier = np.flatnonzero(keys != keys[-1])
                last = int(earlier[-1]) + 1 if len(earlier) else 0
                if last:  # the last key may go on in the next batch
                    yield from whole(rows.slice(0, last))
                    held = rows.slice(last).to_batches()
        if held:
            yield from whole(pa.Table.from_batches(held).combine_chunks())

    def whole(rows):
        keys = rows.column("key").to_numpy()
        sizes = pc.binary_length(rows.column("bytes")).to_numpy().astype(np.int64)
        cuts, at = [0], 0
        bounds = np.append(np.flatnonzero(np.diff(keys)) + 1, len(keys)).tolist()
        for bound in bounds:  # a few groups at a time
            if sizes[at:bound].sum() > SORT_BYTES:
                cuts.append(bound)
                at = bound
        cuts = sorted({*cuts, len(keys)})
        for a, b in zip(cuts[:-1], cuts[1:]):
            found = part(rows.slice(a, b - a), keys[a:b], sizes[a:b])
            if found is not None:
                yield found

    def part(rows, keys, sizes):
        data = np.frombuffer(b"".join(rows.column("bytes").to_pylist()), np.uint8)
        windows = sizes - length + 1
        begin = np.cumsum(sizes) - sizes
        block = np.repeat(np.arange(len(sizes)), windows)
        inner = np.arange(len(block)) - np.repeat(np.cumsum(windows) - windows, windows)
        group = np.cumsum(np.append(0, np.diff(keys) != 0))
        found = Suffixes(data, begin[block] + inner, length).repeated(group[block])
        found &= (rows.column("copies").to_numpy() == 1)[block]
        hit = np.flatnonzero(found)
        if not len(hit):
            return None
        fresh = np.append(True, (np.diff(hit) > 1) | (np.diff(block[hit]) > 0))
        first = hit[fresh]
        last = hit[np.append(np.flatnonzero(fresh)[1:], len(hit)) - 1]
        at = pa.array(block[first])
        lo = rows.column("lo").to_numpy()[block[first]]
        return pa.RecordBatch.from_arrays(
            [_one(rows.column("doc_id")).take(at), _one(rows.column("tag")).take(at),
             pa.array(lo + inner[first]), pa.array(lo + inner[last] + length)], _FOUND.names)

    dealt = blocks.repartition("key").sortWithinPartitions("key")
    return in_arrow(dealt, search, _FOUND)


def _one(column):
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _counted_windows(blocks: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many kinds of blocks, by counting hashes."""
    schema = T.StructType([*_LONGS("key", "window", "copies", *_DOC, "first").fields])

    def spell(batches):
        for batch in batches:
            for row in batch.select(["key", "copies", *_DOC, "lo", "bytes"]).to_pylist():
                data = np.frombuffer(row["bytes"], np.uint8)
                at = np.arange(len(data) - length + 1)
                hashes = mixed(Rolling(data, SECOND_POWERS).of(at, at + length)).view(np.int64)
                same = lambda v: pa.array([v] * len(at), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [same(row["key"]), pa.array(hashes), same(row["copies"]), same(row["doc_id"]),
                     same(row["tag"]), pa.array(at + row["lo"])], schema.names)

    windows = materialise(in_arrow(blocks, spell, schema))
    again = windows.groupBy("key", "window").agg(F.sum("copies").alias("n")).where("n > 1")
    own = windows.where("copies = 1").join(again, ["key", "window"])
    return own.select(*_DOC, "first", (F.col("first") + length).alias("end"))


def repeated_spans(documents: DataFrame, length: int = LENGTH, sort_blocks: int = SORT_BLOCKS) -> DataFrame:
    """``doc_id``, ``tag``, ``first``, ``end``: ranges of repeated bytes, which may overlap."""
    spark = documents.sparkSession
    path = scratch_path(spark, "suffix-dedup")
    texts = _texts(documents)
    runs = anchors(texts, length)
    seen = runs.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    runs.join(seen, "key").write.parquet(f"{path}/runs")
    runs = spark.read.schema(_ANCHORS).parquet(f"{path}/runs")

    kinds = runs.groupBy("key", "digest").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct(*_DOC, *_PLACE)).alias("one")
    )
    kinds = materialise(kinds.select("key", "digest", "copies", "one.*"))
    by_key = kinds.groupBy("key").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    unlike = kinds.join(by_key, "key").withColumn("hot", F.col("kinds") > sort_blocks)
    _cut_out(unlike, texts, length).write.parquet(f"{path}/blocks")
    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")

    copied = kinds.where("copies > 1").select("key", "digest")
    end = F.col("lo") + F.col("windows") + (length - 1)
    equal = runs.join(copied, ["key", "digest"]).select(*_DOC, F.col("lo").alias("first"), end.alias("end"))
    found = equal.unionByName(_sorted_blocks(blocks.where(~F.col("hot")), length))
    return found.unionByName(_counted_windows(blocks.where("hot"), length))


_KEPT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()),
    T.StructField("spans", T.ArrayType(_LONGS("first", "end"))), T.StructField("kept", T.BinaryType()),
])


def without_repeats(documents: DataFrame, length: int = LENGTH, sort_blocks: int = SORT_BLOCKS) -> DataFrame:
    """Per document: ``n_bytes``, the maximal removed ``spans`` of bytes, and the ``kept`` bytes.

    What is kept need not be UTF-8, since spans are ranges of bytes. A NULL text is empty; it
    and a text under ``length`` bytes lose nothing. Each row is a text of its own, so of two
    equal rows both lose what they share. A NULL doc_id is an id like any other.
    """
    spans = repeated_spans(documents, length, sort_blocks).groupBy(*_DOC).agg(
        F.collect_set(F.struct("first", "end")).alias("spans"))
    joined = _on_document(_packed(_texts(documents)), spans, "left")

    def cut(batches):
        unpack = zstandard.ZstdDecompressor()
        arrow = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            sizes, kept, cuts = [], [], []
            for packed, found in zip(batch.column(1), batch.column(2)):
                text = unpack.decompress(packed.as_py())
                sizes.append(len(text))
                own = sorted((s["first"], s["end"]) for s in found.as_py() or ())
                own = list(zip(*(x.tolist() for x in ranges(*np.array(own).T)))) if own else []
                rest, at = [], 0
                for first, end in own:
                    rest.append(text[at:first])
                    at = end
                kept.append(b"".join([*rest, text[at:]]))
                cuts.append([{"first": a, "end": b} for a, b in own])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(cuts, arrow),
                 pa.array(kept, pa.binary())], _KEPT.names)

    return in_arrow(joined.select("doc_id", "packed", "spans"), cut, _KEPT)
