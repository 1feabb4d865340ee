"""Spelling variants: words that differ by one inserted, deleted or replaced code point.

Two words are that near if their common beginning and their common end, together, are as long
as the longer word less one. All pairs of a block are compared at once, as padded
matrices of code points, one aligned to the beginnings and one to the ends.

Blocks hold few words: let the shorter word have ``a`` code points, and cut them into ``PIECES``
pieces. The edit lies in one of the pieces, and both words have what is before it at their
beginning and what is behind it at their end. So words with the same beginning and end around
some piece are a block, once for each piece, and once as the shorter and once as the longer
word. A pair is reported only by the block of the piece in which its common beginning ends,
so it is found once. Blocks of more than ``TILE`` words are cut into tiles, and the pairs of
tiles are compared by different tasks.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..operators import attach, materialise
from ..operators.joining import leave_out
from .shipping import in_arrow

PIECES = 4
TILE = 4_096
#: Code points compared at a time.
CELLS = 1 << 22
#: How many times as frequent the form of a word is, at least.
RATIO = 10

WORD = r"[A-Za-zÀ-ÿ]+"

_PAIR = "word string, other string, n_other bigint"


# --- words -------------------------------------------------------------------


def runs(documents: DataFrame, pattern: str = WORD) -> DataFrame:
    """``doc_id`` and ``word`` of every maximal run, with A-Z as a-z. A NULL text has none."""
    upper, lower = (bytes(range(c, c + 26)).decode() for c in (65, 97))
    text = F.translate(F.col("text"), upper, lower)
    return documents.select("doc_id", F.explode(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).alias("word"))


def with_slips(found: DataFrame, one_in: int = 31) -> DataFrame:
    """Deletes a code point of words whose hash ``one_in`` divides. Without a doc_id a word stays."""
    h = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("word")).cast("binary"))
    at = F.pmod(h, F.length("word")).cast("int")
    cut = F.concat(
        F.substring(F.col("word"), F.lit(1), at), F.substring(F.col("word"), at + 2, F.length("word"))
    )
    return found.withColumn("word", F.when(F.pmod(h, F.lit(one_in)) == 0, cut).otherwise(F.col("word")))


def vocabulary(found: DataFrame, least_chars: int = 7, least_n: int = 2) -> DataFrame:
    """Distinct words with their number ``n``, of so many code points and occurrences at least."""
    long = found.where(F.length("word") >= least_chars)
    return long.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_n)


# --- pairs -------------------------------------------------------------------


def _keys(words: DataFrame, pieces: int) -> DataFrame:
    """A row for each block of a word: ``key``, ``size`` of its shorter words and ``piece``."""
    word, size = F.col("word"), F.length("word")

    def key(a: Column, k: Column) -> Column:
        before = F.floor(k * a / pieces).cast("int")
        behind = a - F.floor((k + 1) * a / pieces).cast("int")
        parts = F.xxhash64(a, k, F.substring(word, F.lit(1), before), F.right(word, behind))
        return F.struct(parts.alias("key"), a.alias("size"), k.alias("piece"))

    own = F.flatten(F.transform(
        F.array(size, size - 1),
        lambda a: F.transform(F.sequence(F.lit(0), F.lit(pieces - 1)), lambda k: key(a, k)),
    ))
    return words.select("word", "n", F.inline(own))


def near_pairs(words: DataFrame, pieces: int = PIECES, tile: int = TILE) -> DataFrame:
    """``word``, ``other`` and ``n_other`` for every two near words, once for each of the two.

    ``words`` has distinct, not empty ``word`` and a number ``n``.
    """
    keyed = _keys(words, pieces)
    large = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("in_block")).where(F.col("in_block") > tile)
    large = materialise(large.select("key", F.ceil(F.col("in_block") / tile).cast("int").alias("tiles")))
    columns = ["key", "size", "piece", "word", "n"]
    if large.isEmpty():
        cut = keyed.select(*columns, F.lit(0).alias("own"), F.lit(0).alias("left"), F.lit(0).alias("right"))
    else:
        whole = leave_out(keyed, large, ["key"]).select(
            *columns, F.lit(0).alias("own"), F.lit(0).alias("left"), F.lit(0).alias("right")
        )
        split = attach(keyed, large, ["key"]).withColumn("own", F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int"))
        other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
        split = split.select(*columns, "own", other).select(
            *columns, "own", F.least("own", "other").alias("left"), F.greatest("own", "other").alias("right")
        )
        cut = whole.unionByName(split)
    block = ["key", "left", "right"]
    dealt = cut.repartition(*block).sortWithinPartitions(*block)
    return in_arrow(dealt.select(*block, "own", "size", "piece", "word", "n"), _compare(pieces), _PAIR)


def code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths, and two matrices padded with zeros: code points from the beginning, and from the end."""
    every = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    if every.max(initial=0) < 256:
        every = every.astype(np.uint8)
    size = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(size)
    width = int(size.max(initial=0))
    column = np.arange(width)
    inside = column < size[:, None]
    every = np.append(every, every.dtype.type(0))
    forward = np.where(inside, every[np.minimum((ends - size)[:, None] + column, len(every) - 1)], 0)
    backward = np.where(inside, every[np.maximum(ends[:, None] - 1 - column, 0)], 0)
    return size, forward, backward


def agreeing(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many leading columns agree, for every row of ``left`` with every row of ``right``.

    The last two axes of both are rows and columns; those before them are stacked blocks.
    """
    same = left[..., :, None, :] == right[..., None, :, :]
    first = same.argmin(axis=-1)
    return np.where(same.all(axis=-1), left.shape[-1], first)


def _compare(pieces: int):
    """Reads rows in order of their blocks, and yields the near pairs of each block."""

    def blocks(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table]).combine_chunks()
            key = np.stack([held.column(i).to_numpy() for i in range(3)])
            fresh = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            if len(fresh):  # all but the last block are whole
                yield held.slice(0, fresh[-1]), np.append(0, fresh)
                held = held.slice(fresh[-1]).combine_chunks()
        if held is not None and held.num_rows:
            yield held, np.array([0, held.num_rows])

    def compare(batches):
        for rows, edges in blocks(batches):
            count = np.diff(edges)
            several = count > 1
            if not several.any():
                continue
            start, count = edges[:-1][several], count[several]
            picked = np.repeat(start - np.append(0, np.cumsum(count)[:-1]), count) + np.arange(count.sum())
            rows = rows.take(pa.array(picked))
            start = np.append(0, np.cumsum(count)[:-1])
            columns = {c: rows.column(c).to_numpy() for c in ("left", "right", "own", "size", "piece")}
            chars, forward, backward = code_points(rows.column("word").to_pylist())
            found = [
                pair
                for n in np.unique(count)
                for pair in _in_blocks(start[count == n], int(n), chars, forward, backward, columns, pieces)
            ]
            if not found:
                continue
            a, b = (np.concatenate(x) for x in zip(*found))
            one, two = pa.array(np.append(a, b)), pa.array(np.append(b, a))
            word, n = rows.column("word").combine_chunks(), rows.column("n").combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [word.take(one), word.take(two), n.take(two)], names=["word", "other", "n_other"]
            )

    return compare


def _in_blocks(start, n, chars, forward, backward, columns, pieces):
    """The near pairs of blocks of ``n`` rows each, as two arrays of row numbers."""
    width = forward.shape[1]
    blocks = max(1, CELLS // (n * n * width))
    strip = n if blocks > 1 else max(1, CELLS // (n * width))
    for at in range(0, len(start), blocks):
        rows = start[at : at + blocks, None] + np.arange(n)
        for top in range(0, n, strip):
            left = rows[:, top : top + strip]
            p = agreeing(forward[left], forward[rows])
            s = agreeing(backward[left], backward[rows])
            x, y = left[:, :, None], rows[:, None, :]
            a, k = columns["size"][x], columns["piece"][x].astype(np.int64)
            longer = np.maximum(chars[x], chars[y])
            near = (x != y) & (p + s >= longer - 1) & (np.minimum(chars[x], chars[y]) == a) & (longer <= a + 1)
            # Rows of other blocks whose key has the same hash are told apart here.
            near &= (columns["size"][y] == a) & (columns["piece"][y] == k)
            near &= (p >= k * a // pieces) & ((p < (k + 1) * a // pieces) | (k == pieces - 1))
            # Within a tile each pair is met twice, between two tiles one of them is on the left.
            apart = columns["left"][x] != columns["right"][x]
            near &= np.where(apart, (columns["own"][x] == columns["left"][x]) & (columns["own"][y] == columns["right"][y]), x < y)
            i, j, m = np.nonzero(near)
            if len(i):
                yield left[i, j], rows[i, m]


# --- forms -------------------------------------------------------------------


def spelling_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """Per word of ``words`` (``word`` and ``n``): ``form``, ``root``, ``n_near`` and ``form_n``.

    The form of a word is the most frequent word near it (ties: the smallest in code-point
    order), if that is at least ``ratio`` times as frequent, and else NULL. The root is the last word
    that following forms leads to. As every step multiplies the number, there are no circles,
    and few steps.

    Words must be distinct; a NULL or empty word is left out, and so is one without a number.
    Other columns are not looked at. An empty table gives an empty one.
    """
    words = materialise(words.where("length(word) > 0 and n is not null").select("word", F.col("n").cast("bigint")))
    own = words.select("word", "n", F.lit(None).cast("string").alias("other"), F.lit(None).cast("bigint").alias("n_other"))
    pairs = near_pairs(words).select("word", F.lit(None).cast("bigint").alias("n"), "other", "n_other")
    most = F.min(F.when(F.col("other").isNotNull(), F.struct((-F.col("n_other")).alias("down"), "other")))
    found = own.unionByName(pairs).groupBy("word").agg(
        F.max("n").alias("n"), F.count("other").alias("n_near"), most.alias("most")
    )
    enough = -F.col("most.down") >= ratio * F.col("n")
    found = materialise(found.select(
        "word", "n", "n_near", F.when(enough, F.col("most.other")).alias("form"),
        F.when(enough, -F.col("most.down")).alias("form_n"),
    ))
    ends = _last(found.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")))
    return found.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _last(steps: DataFrame) -> DataFrame:
    """Where following ``word`` to ``root`` leads in the end; each round doubles the steps."""
    while True:
        further = steps.toDF("root", "next")
        doubled = materialise(
            steps.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        )
        steps = doubled.select("word", "root")
        if doubled.where("moved").isEmpty():
            return steps
