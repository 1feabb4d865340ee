"""Hard negatives of anchors, by slots between the scores of their positives.

The score of a row is the inner product of its whole-number vector with the anchor's. An anchor's
positives are its best rows of the same label. Each positive opens a window of scores,
from ``least`` percent of its own score up to that score, and asks for the best rows of other
labels in it. The windows of one anchor overlap. Their upper limits cut the scores into disjoint
slots, and a row belongs to one slot only. So a row is looked at once however many windows
it lies in:

1. Every task keeps the best few rows of each (anchor, slot) it has seen, and only those are
   shuffled.
2. Merging the slots from the lowest one up gives, for every upper limit, the best rows at or below
   it. A window's answer is what of these reaches its lower limit, as rows are listed from the
   highest score down.

Anchors are taken in blocks of about ``ANCHORS``; the block at work is all that is sent to the
tasks. All rows are read for each block.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators import materialise
from ..session import scratch_path
from .shipping import in_arrow

#: Anchors in a block, on average.
ANCHORS = 1_024
#: Scores a task works out at a time.
SCORES = 1 << 20

_FOUND = "anchor_id bigint, slot int, vec_id bigint, score bigint"
_RESULT = (
    "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, "
    "positive_score bigint, negative_score bigint"
)
_NOTHING = np.iinfo(np.int64).min


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two matrices of whole numbers held as doubles.

    One that does not fit 64 bits is an error.
    """
    reach = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1]
    if reach < 2**53:
        return (a @ b.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    return np.dot(whole(a), whole(b).T).astype(np.int64)


class Best:
    """The ``k`` best rows of each group so far: highest score first, then smallest id."""

    def __init__(self, groups: int, k: int):
        self.k = k
        self.group, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.floor = np.full(groups, _NOTHING)  # of full groups, the least score that may still get in

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        fits = score >= self.floor[group]
        group, score, ids = (
            np.concatenate([old, new[fits]])
            for old, new in ((self.group, group), (self.score, score), (self.id, ids))
        )
        order = np.lexsort((ids, -score, group))
        group, score, ids = group[order], score[order], ids[order]
        place = np.arange(len(group)) - np.searchsorted(group, group)
        kept = place < self.k
        self.group, self.score, self.id = group[kept], score[kept], ids[kept]
        full = place == self.k - 1
        self.floor[group[full]] = score[full]


class Block:
    """Some anchors with their scores' limits, if known, by the length of their vectors."""

    def __init__(self, rows: list, limits: dict | None, k: int):
        self.k = k
        self.ids = np.array([r.vec_id for r in rows], np.int64)
        self.labels = np.array([r.label for r in rows], np.int64)
        sizes = np.array([len(r.vector) for r in rows], np.int64)
        self.by_size = {
            int(n): (at := np.flatnonzero(sizes == n), np.array([rows[i].vector for i in at], float).reshape(len(at), n))
            for n in np.unique(sizes)
        }
        self.limits = None
        if limits is not None:
            own = [limits.get(r.vec_id, ((), _NOTHING)) for r in rows]
            # Descending upper limits; those that are missing are below any score.
            self.limits = np.full((len(rows), max([1, *(len(x) for x, _ in own)])), _NOTHING)
            for i, (x, _) in enumerate(own):
                self.limits[i, : len(x)] = x
            self.least = np.array([low for _, low in own], np.int64)

    @property
    def slots(self) -> int:
        return 1 if self.limits is None else self.limits.shape[1]

    def search(self, batches):
        """What this task's rows add: the best of each anchor and slot."""
        best = Best(len(self.ids) * self.slots, self.k)
        for batch in batches:
            vectors = batch.column(2)
            at, values = vectors.offsets.to_numpy(), vectors.values.to_numpy()
            sizes = np.diff(at)
            ids, labels = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for size, (anchors, matrix) in self.by_size.items():
                same_size = np.flatnonzero(sizes == size)
                step = max(1, SCORES // len(anchors))
                for first in range(0, len(same_size), step):
                    rows = same_size[first : first + step]
                    picked = values[at[rows][:, None] + np.arange(size)]
                    self._look(best, anchors, inner_products(picked, matrix), ids[rows], labels[rows])
        if len(best.group):
            yield pa.RecordBatch.from_arrays(
                [pa.array(self.ids[best.group // self.slots]), pa.array((best.group % self.slots).astype(np.int32)),
                 pa.array(best.id), pa.array(best.score)],
                names=["anchor_id", "slot", "vec_id", "score"],
            )

    def _look(self, best, anchors, scores, ids, labels) -> None:
        floors = best.floor.reshape(-1, self.slots)[anchors].min(axis=1)
        same = labels[:, None] == self.labels[anchors]
        if self.limits is None:
            wanted = same & (ids[:, None] != self.ids[anchors]) & (scores >= floors)
        else:
            limits = self.limits[anchors]
            wanted = ~same & (scores <= limits[:, 0]) & (scores >= np.maximum(self.least[anchors], floors))
        row, column = np.nonzero(wanted)
        score = scores[row, column]
        slot = 0 if self.limits is None else (score[:, None] <= limits[column]).sum(axis=1) - 1
        best.add(anchors[column] * self.slots + slot, score, ids[row])


def _usable(vectors: DataFrame, scale: int) -> DataFrame:
    """Rows that take part, with their vectors as whole numbers."""
    own = vectors.select(
        F.col("vec_id").cast("bigint"), F.col("label").cast("bigint"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = own.where("vec_id is not null and label is not null and vector is not null").where(~odd)

    def floors(batches):
        for batch in batches:
            vector = batch.column(2)
            values = pa.array(np.floor(scale * vector.values.to_numpy()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.ListArray.from_arrays(vector.offsets, values)],
                names=["vec_id", "label", "vector"],
            )

    return in_arrow(whole, floors, "vec_id bigint, label bigint, vector array<double>")


def _best(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of what the tasks have found for each anchor and slot."""
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).drop("place")


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column | str,
    positives: int = 5,
    negatives: int = 5,
    least: int = 80,
    scale: int = 256,
) -> DataFrame:
    """Per anchor and positive, the best ``negatives`` rows of another label in its window.

    ``vectors`` has ``vec_id``, ``label`` and ``embedding``; other columns are not looked at. A component
    ``x`` counts as ``floor(scale * x)``. A window holds scores ``s`` with
    ``least * p <= 100 * s <= 100 * p`` for the positive's score ``p``, so a negative ``p`` has none.
    Ties of scores go to the smaller vec_id.

    A NULL in any of the three columns, or a NULL, NaN or infinite component, keeps a row out altogether.
    Rows that share a vec_id are rows of their own among positives and negatives; as an anchor,
    the smallest of them (label, then vector) stands for all, and none of them is its positive.
    Vectors of another length than the anchor's are not scored. An anchor without positives, or
    windows without rows, give no rows; so do empty tables. Scores beyond 64 bits are an error.
    """
    spark = vectors.sparkSession
    rows = _usable(vectors, scale)
    one = F.min(F.struct("label", "vector")).alias("one")
    anchors = materialise(
        rows.where(is_anchor).groupBy("vec_id").agg(one).select("vec_id", "one.label", "one.vector")
    )
    blocks = math.ceil(anchors.count() / ANCHORS)
    if not blocks:
        return spark.createDataFrame([], _RESULT)
    numbered = anchors.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
    path = scratch_path(spark, "negatives")
    for number in range(blocks):
        own = numbered.where(F.col("block") == number).drop("block").collect()
        found = _best(in_arrow(rows, Block(own, None, positives).search, _FOUND), positives)
        by_anchor = F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("down"), "vec_id")))
        listed = found.groupBy("anchor_id").agg(by_anchor.alias("best"))
        listed.write.parquet(f"{path}/positives/block={number}")
        limits = {}
        for r in spark.read.schema(listed.schema).parquet(f"{path}/positives/block={number}").collect():
            upper = sorted({-p.down for p in r.best if p.down <= 0}, reverse=True)
            if upper:
                limits[r.anchor_id] = (upper, -(-least * upper[-1] // 100))
        found = in_arrow(rows, Block(own, limits, negatives).search, _FOUND)
        _best(found, negatives).write.parquet(f"{path}/negatives/block={number}")
    chosen = spark.read.schema(listed.schema).parquet(f"{path}/positives")
    slots = spark.read.schema(_FOUND).parquet(f"{path}/negatives")
    return _windows(chosen, slots, negatives, least)


def _windows(chosen: DataFrame, slots: DataFrame, negatives: int, least: int) -> DataFrame:
    """The answer of every window, from the best rows of disjoint slots."""
    best = F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("down"), "vec_id")))
    by_slot = slots.groupBy("anchor_id", "slot").agg(best.alias("top"))
    # The lowest slot, which has the highest number, comes first.
    down = F.sort_array(F.collect_list(F.struct("slot", "top")), asc=False)
    listed = by_slot.groupBy("anchor_id").agg(down.alias("slots"))
    merged = F.aggregate(
        "slots",
        F.lit(None).cast("array<struct<slot:int,top:array<struct<down:bigint,vec_id:bigint>>>>"),
        lambda done, s: F.array_append(
            F.coalesce(done, F.array().cast("array<struct<slot:int,top:array<struct<down:bigint,vec_id:bigint>>>>")),
            F.struct(
                s["slot"].alias("slot"),
                F.slice(
                    F.concat(s["top"], F.coalesce(F.try_element_at(done, F.lit(-1))["top"], F.array().cast("array<struct<down:bigint,vec_id:bigint>>"))),
                    1, negatives,
                ).alias("top"),
            ),
        ),
    )
    below = listed.select("anchor_id", merged.alias("below"))
    scores = F.array_distinct(F.transform("best", lambda p: p["down"]))
    each = chosen.withColumn("limits", scores).select(
        "anchor_id", "limits", F.inline("best")
    ).select(
        "anchor_id", F.col("vec_id").alias("positive_id"), (-F.col("down")).alias("positive_score"),
        (F.array_position("limits", F.col("down")) - 1).cast("int").alias("own"),
    )
    at = F.try_element_at(F.filter("below", lambda b: b["slot"] >= F.col("own")), F.lit(-1))["top"]
    inside = F.filter(at, lambda n: -100 * n["down"] >= least * F.col("positive_score"))
    picked = each.where("positive_score >= 0").join(below, "anchor_id").withColumn("found", inside)
    return picked.select("anchor_id", "positive_id", "positive_score", F.posexplode("found").alias("i", "n")).select(
        "anchor_id", "positive_id", (F.col("i") + 1).alias("rank"), F.col("n.vec_id").alias("negative_id"),
        "positive_score", (-F.col("n.down")).alias("negative_score"),
    )
