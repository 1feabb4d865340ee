"""Document fingerprints: digests of improbable features in chained Bloom filters.

1. Every window of ``WINDOW`` bytes of a text has an entropy. How often each class of entropies
   occurs is counted over all texts; the rarer its class, the better a window ranks. Windows of
   next to no entropy, such as runs of one character, are left out.
2. A window that is the best ranked (the leftmost of equal ones) in ``LEAST`` or more of the stretches of
   ``STRETCH`` neighbouring windows is a feature. Features depend on the bytes around them alone, so an
   edit elsewhere leaves them as they are.
3. The distinct features of a text go, in order, into Bloom filters of ``BITS`` bits with ``HASHES``
   bits a feature; after ``IN_FILTER`` features the next filter begins.
4. Two filters are as alike as their common bits exceed what chance lets them share, from 0 (no
   more than that) to 1 (one holds all bits of the other). For each filter of the text with
   fewer of them the most alike one of the other text counts.

A text of fewer bytes than a window, or without a ranked window, has itself as its only feature.
An empty text has none.
"""

import base64
import hashlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .anchors import window_minima
from .arrays import Rolling, blocks, mixed, utf8
from .shipping import in_arrow

WINDOW = 32
STRETCH = 32  # at most WINDOW, so that a stretch never reaches windows of two texts
LEAST = 8
CLASSES = 1_000
#: Classes below this one carry no information.
FAINT = 100
BITS = 2_048
HASHES = 5
IN_FILTER = 160

#: Bytes a task works on at a time; a longer text is worked on alone.
BLOCK_BYTES = 1 << 18
#: Ranges of documents for each shuffle partition.
RANGES = 4

_U = np.uint64
_NO_RANK = 1 << 20
_ONE = 1 << 20  # entropies are whole numbers of this part of a bit


def _weights() -> np.ndarray:
    """What the pair of a byte and its k-th last occurrence adds to the sum of c * log2(c)."""
    c = np.arange(1, WINDOW + 1)
    f = np.concatenate([[0], np.rint(c * np.log2(c) * _ONE).astype(np.int64)])
    return np.concatenate([[0, 0], f[2:] - 2 * f[1:-1] + f[:-2]])[1:]


_WEIGHTS = _weights()
_MOST = int(round(WINDOW * np.log2(WINDOW) * _ONE))


def entropy_classes(data: np.ndarray) -> np.ndarray:
    """The class of every window's entropy, 0 to ``CLASSES``.

    A window with ``c`` equal bytes has c - k pairs of one of them and the k-th before it. Weights
    by ``k`` make them add up to c * log2(c). A pair counts for the windows that hold both.
    """
    n = len(data)
    if n < WINDOW:
        return np.zeros(0, np.int64)
    order = np.argsort(data, kind="stable")
    value = data[order]
    change = np.zeros(n + WINDOW + 1, np.int64)
    place = np.arange(n)
    for k in range(1, WINDOW):
        place = place[place >= k] if k == 1 else place[np.searchsorted(place, k):]
        here, before = order[place], order[place - k]
        near = (value[place] == value[place - k]) & (here - before < WINDOW)
        place, here, before = place[near], here[near], before[near]
        if not len(place):
            break
        change[here + 1] += _WEIGHTS[k]
        change[before + WINDOW + 1] -= _WEIGHTS[k]
    sums = np.cumsum(change)[WINDOW:n + 1]
    return (_MOST - sums) * CLASSES // _MOST


def _inside(offsets: np.ndarray, size: int) -> np.ndarray:
    """Which windows of all bytes lie within one text."""
    starts = np.arange(size)
    text = np.searchsorted(offsets, starts, "right") - 1
    return starts + WINDOW <= offsets[text + 1]


def class_counts(documents: DataFrame) -> DataFrame:
    """How many windows of all texts have each class: ``class`` and ``n``, a row a class."""

    def count(batches):
        total = np.zeros(CLASSES + 1, np.int64)
        for batch in batches:
            for _, _, data, offsets in blocks(*utf8(batch.column(0).fill_null("")), BLOCK_BYTES):
                found = entropy_classes(data)
                total += np.bincount(found[_inside(offsets, len(found))], minlength=len(total))
        here = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(here), pa.array(total[here])], names=["class", "n"])

    counted = in_arrow(documents.select("text"), count, "class bigint, n bigint")
    return counted.groupBy("class").agg(F.sum("n").alias("n"))


def learn_ranks(documents: DataFrame) -> np.ndarray:
    """The rank of each class, rarest first; equally rare ones share a rank.

    Only one number for each of the ``CLASSES`` comes to the driver.
    """
    n = np.zeros(CLASSES + 1, np.int64)
    for row in class_counts(documents).collect():
        n[row["class"]] = row["n"]
    ranks = np.searchsorted(np.unique(n), n)
    ranks[:FAINT] = _NO_RANK
    return ranks


class Digest:
    """Chained filters of one text: how many features each has, and its bits."""

    __slots__ = ("counts", "filters")

    def __init__(self, counts: np.ndarray, filters: np.ndarray):
        self.counts, self.filters = counts, filters

    def __str__(self) -> str:
        return "-".join(
            f"{n}:{base64.b64encode(bits.tobytes()).decode()}" for n, bits in zip(self.counts.tolist(), self.filters)
        )

    @classmethod
    def parse(cls, text: str) -> "Digest":
        parts = [p.split(":") for p in text.split("-")] if text else []
        bits = b"".join(base64.b64decode(b) for _, b in parts)
        return cls(np.array([int(n) for n, _ in parts], np.int64), np.frombuffer(bits, np.uint8).reshape(-1, BITS // 8))


def likeness(a: Digest, b: Digest) -> float:
    """How alike two digests are, from 0 to 1. Two without features are alike."""
    if not len(a.counts) or not len(b.counts):
        return float(len(a.counts) == len(b.counts))
    if len(a.counts) > len(b.counts):
        a, b = b, a
    x, y = (np.ascontiguousarray(d.filters).view(_U) for d in (a, b))
    step = max(1, (1 << 20) // y.size)
    rows = [np.bitwise_count(x[i : i + step, None] & y).sum(axis=-1, dtype=np.int64) for i in range(0, len(x), step)]
    common = np.concatenate(rows)
    own, other = (np.bitwise_count(f).sum(axis=-1, dtype=np.int64) for f in (x, y))
    chance = own[:, None] * other / BITS
    room = np.minimum(own[:, None], other) - chance
    alike = np.where(room > 0, (common - chance) / np.where(room > 0, room, 1), 1.0).clip(0, 1)
    score = float(alike.max(axis=1) @ a.counts / a.counts.sum())
    if len(a.counts) == len(b.counts):  # neither comes first
        score = (score + float(alike.max(axis=0) @ b.counts / b.counts.sum())) / 2
    return min(1.0, score)


def digests(data: np.ndarray, offsets: np.ndarray, ranks: np.ndarray) -> list[Digest]:
    """The digest of every text."""
    texts = len(offsets) - 1
    found = entropy_classes(data)
    rank = np.where(_inside(offsets, len(found)), ranks[found], _NO_RANK)
    edge = np.full(STRETCH - 1, _NO_RANK)
    keys = np.concatenate([edge, rank, edge]).astype(_U) << _U(40)
    keys |= np.arange(len(keys), dtype=_U)
    none = np.zeros(0, np.int64)
    if len(rank):
        least = window_minima(keys, STRETCH)
        best = (least & _U((1 << 40) - 1)).astype(np.int64)[(least >> _U(40)) < _U(_NO_RANK)] - len(edge)
        places = np.flatnonzero(np.bincount(best, minlength=len(rank)) >= LEAST) if len(best) else none
    else:
        places = none
    owner = np.searchsorted(offsets, places, "right") - 1
    # Texts without a feature so far, but not empty ones, are one themselves.
    bare = np.flatnonzero((np.bincount(owner, minlength=texts) == 0) & (np.diff(offsets) > 0))
    rolling = Rolling(data)
    starts = np.concatenate([places, offsets[bare]])
    ends = np.concatenate([places + WINDOW, offsets[bare + 1]])
    owner = np.concatenate([owner, bare])
    value = mixed(rolling.of(starts, ends) + (ends - starts).astype(_U) * _U(0xD6E8FEB86659FD93))
    order = np.lexsort((starts, value, owner))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (value[order][1:] != value[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    order = order[fresh]
    order = order[np.lexsort((starts[order], owner[order]))]
    value, owner = value[order], owner[order]
    first = np.searchsorted(owner, np.arange(texts + 1))
    chained = -(-np.diff(first) // IN_FILTER)  # filters of each text
    begin = np.concatenate([[0], np.cumsum(chained)])
    own = begin[owner] + (np.arange(len(owner)) - first[owner]) // IN_FILTER
    bits = np.zeros((begin[-1], BITS), bool)
    wide = BITS.bit_length() - 1
    for i in range(HASHES):
        bits[own, ((value >> _U(wide * i)) & _U(BITS - 1)).astype(np.int64)] = True
    packed = np.packbits(bits, axis=1, bitorder="little")
    counts = np.bincount(own, minlength=begin[-1])
    return [Digest(counts[a:b], packed[a:b]) for a, b in zip(begin[:-1], begin[1:])]


def digests_of(texts: list[str], ranks: np.ndarray) -> list[Digest]:
    column = pa.array(texts, pa.string())
    parts = (digests(data, offsets, ranks) for _, _, data, offsets in blocks(*utf8(column), BLOCK_BYTES))
    return list(chain.from_iterable(parts))


def fingerprints(documents: DataFrame, ranks: np.ndarray) -> DataFrame:
    """``doc_id`` and the ``fingerprint`` of its text, one row for each row.

    A NULL text is empty, and an empty text has the fingerprint ''. Rows that share a doc_id are texts of
    their own. Other columns are not looked at; an empty table gives an empty one.
    """

    def sign(batches):
        for batch in batches:
            texts = batch.column(1).fill_null("")
            found = [str(d) for _, _, data, at in blocks(*utf8(texts), BLOCK_BYTES) for d in digests(data, at, ranks)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], names=["doc_id", "fingerprint"])

    return in_arrow(documents.select(F.col("doc_id").cast("bigint"), "text"), sign, "doc_id bigint, fingerprint string")


# --- neighbours --------------------------------------------------------------


def _below(splits: list[int], value: Column) -> Column:
    """How many of the ascending ``splits`` are at most ``value``, looking at few of them."""
    step = max(1, round(len(splits) ** 0.5))
    listed = F.lit(splits).cast("array<bigint>")
    coarse = F.lit(splits[step - 1 :: step]).cast("array<bigint>")
    whole = F.size(F.filter(coarse, lambda s: s <= value)) * step
    return whole + F.size(F.filter(F.slice(listed, whole + 1, F.lit(step)), lambda s: s <= value))


def in_order(documents: DataFrame) -> DataFrame:
    """Texts dealt out by ranges of doc_id, in order; behind each range the row that comes next.

    Columns: ``part``, ``guest``, ``doc_id``, ``text``. A guest belongs to the next range, or for the last one
    to the first. A NULL doc_id comes first, rows that share one follow each other by their text. The
    limits of the ranges come from a sketch of all ids, and are ids that occur.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    parts = RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [(i + 1) / parts for i in range(parts - 1)] or [0.5]
    seen = rows.agg(
        F.percentile_approx("doc_id", shares, max(10_000, 10 * parts)).alias("splits"),
        F.min("doc_id").alias("least"), F.count_if(F.col("doc_id").isNull()).alias("nulls"),
    ).first()
    splits = sorted(set(seen.splits or [seen.least or 0]) - ({seen.least} if not seen.nulls else set())) or [seen.least or 0]
    own = F.coalesce(_below(splits, F.col("doc_id")), F.lit(0))
    first = F.col("doc_id").isNull() if seen.nulls else F.col("doc_id").eqNullSafe(F.lit(seen.least))
    opens = F.array_contains(F.lit(splits).cast("array<bigint>"), F.col("doc_id"))
    none = F.lit(None).cast("int")
    places = F.array(
        F.struct(F.col("own").alias("part"), F.lit(0).alias("guest")),
        F.struct(F.when(opens, F.col("own") - 1).otherwise(none).alias("part"), F.lit(1).alias("guest")),
        F.struct(F.when(first, F.lit(len(splits))).otherwise(none).alias("part"), F.lit(1).alias("guest")),
    )
    dealt = rows.withColumn("own", own.cast("int")).select(F.inline(places), "doc_id", "text").where("part is not null")
    return dealt.repartition("part").sortWithinPartitions("part", "guest", "doc_id", "text")


_COMPARED = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by as many from the beginning of ``following``."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def compared_fingerprints(documents: DataFrame, ranks: np.ndarray) -> DataFrame:
    """Fingerprints of every text and its edited text, and how alike texts are.

    The edited text has its last quarter replaced by the beginning of the next document, by ascending
    doc_id; after the last comes the first, and a single document is its own next one. ``near_edited`` is the
    likeness to the edited text's fingerprint and ``near_next`` to the next document's.

    A NULL text is empty, and so is its edited text. For ids that are NULL or repeated see ``in_order``.
    Other columns are not looked at; an empty table gives an empty one.
    """

    def runs(batches):
        for batch in batches:
            texts = batch.column(3)
            for first, last, data, offsets in blocks(*utf8(texts), BLOCK_BYTES):
                size = last - first
                own = (batch.column(i).slice(first, size).to_pylist() for i in range(4))
                yield list(zip(*own, digests(data, offsets, ranks)))

    def compare(batches):
        held = []
        for run in runs(batches):
            held += run
            pairs = [(x, y) for x, y in zip(held[:-1], held[1:]) if not x[1]]
            held = held[-1:]
            if not pairs:
                continue
            changed = [edited(x[3], y[3]) for x, y in pairs]
            after = digests_of(changed, ranks)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x[2] for x, _ in pairs], pa.int64()),
                    pa.array([len(x[3]) for x, _ in pairs], pa.int64()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]),
                    pa.array([str(x[4]) for x, _ in pairs]),
                    pa.array([str(d) for d in after]),
                    pa.array([likeness(x[4], d) for (x, _), d in zip(pairs, after)]),
                    pa.array([likeness(x[4], y[4]) for x, y in pairs]),
                ],
                names=[c.split()[0] for c in _COMPARED.split(", ")],
            )

    return in_arrow(in_order(documents), compare, _COMPARED)
