"""Hard negatives against plain Python, and their edge cases."""

import math
import random

import numpy as np
import pytest

from votestream.llm import negatives
from votestream.llm.negatives import Best, hard_negatives, inner_products

SCHEMA = "vec_id bigint, label int, embedding array<float>, score string, anchor_id int, slot int"
ANCHOR = "vec_id % 10 = 0"


def table(spark, rows):
    floats = lambda v: v and [None if x is None else float(x) for x in v]
    return spark.createDataFrame([(i, label, floats(v), "x", 7, 8) for i, label, v in rows], SCHEMA)


def expected(rows, positives=5, negatives=5, least=80, scale=256):
    good = [
        (i, label, [math.floor(scale * float(np.float32(x))) for x in v]) for i, label, v in rows
        if None not in (i, label, v) and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for anchor in sorted({i for i, _, _ in good if i % 10 == 0}):
        own = min((label, v) for i, label, v in good if i == anchor)
        scored = sorted(
            (-sum(x * y for x, y in zip(v, own[1])), i, label) for i, label, v in good if len(v) == len(own[1])
        )
        best = [(-s, i) for s, i, label in scored if label == own[0] and i != anchor][:positives]
        for p, positive in best:
            inside = [(-s, i) for s, i, label in scored if label != own[0] and least * p <= -100 * s <= 100 * p]
            out += [(anchor, positive, k + 1, i, p, s) for k, (s, i) in enumerate(inside[:negatives])]
    return sorted(out)


def found(df):
    return sorted(map(tuple, df.select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()))


def vectors(seed, n, labels=3, spread=1.0):
    r = random.Random(seed)
    # Whole directions, so that scores often tie.
    return [(i, r.randrange(labels), [r.choice([0.25, 0.5, -0.125, spread]) for _ in range(4)]) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(negatives, "ANCHORS", 8)  # several blocks
    monkeypatch.setattr(negatives, "SCORES", 100)
    rows = vectors(seed, 160)
    wanted = expected(rows)
    assert len(wanted) > 100
    assert found(hard_negatives(table(spark, rows).repartition(3), ANCHOR)) == wanted


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(3, 40) + [
        (50, None, [1.0, 0, 0, 0]), (51, 1, None), (None, 1, [1.0, 0, 0, 0]), (52, 1, [nan, 0, 0, 0]),
        (53, 1, [inf, 0, 0, 0]), (54, 1, [None, 0, 0, 0]), (60, 1, [1.0, 2.0]), (61, 1, [1.0, 1.0]), (62, 2, [1.0, 1.0]),
        (70, 1, []), (71, 2, []), (80, 9, [1.0, 1, 1, 1]),
        # repeated rows, also of an anchor, and equal vectors
        (10, 0, [1.0, 1, 1, 1]), (10, 0, [1.0, 1, 1, 1]), (11, 2, [1.0, 1, 1, 1]), (11, 2, [1.0, 1, 1, 1]),
        (90, 5, [-1.0, 0, 0, 0]), (91, 5, [1.0, 0, 0, 0]),
    ]
    assert found(hard_negatives(table(spark, rows), ANCHOR)) == expected(rows)


def test_few_and_none(spark):
    rows = vectors(4, 60)
    assert found(hard_negatives(table(spark, rows), ANCHOR, positives=2, negatives=1, least=50)) == expected(rows, 2, 1, 50)
    assert hard_negatives(table(spark, []), ANCHOR).count() == 0
    assert hard_negatives(table(spark, [(1, 1, [1.0])]), ANCHOR).count() == 0


def test_large_numbers_are_exact():
    big = np.array([[2.0**40, 1.0]])
    assert inner_products(big, np.array([[2.0**20, 3.0]])).tolist() == [[2**60 + 3]]
    with pytest.raises(OverflowError):
        inner_products(big, big)


def test_combiner_keeps_the_best():
    best = Best(2, 2)
    for score, ids in (([5, 7], [3, 4]), ([7, 7], [2, 9]), ([8, 1], [8, 1])):
        best.add(np.zeros(2, np.int64), np.array(score), np.array(ids))
    assert list(zip(best.score.tolist(), best.id.tolist())) == [(8, 8), (7, 2)]
