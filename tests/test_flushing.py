"""Flushes against a plain replay of a counter, also where every size limit is tiny."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from votestream.operators import count_votes, flush_partials, merge_partials
from votestream.operators import flushing

from rows import tuples, votes

COLUMNS = ("stream", "state", "tick", "batch", "Dvotes", "Rvotes", "event_us", "time_us", "full")


def replay(rows, tick_us, cap):
    """What a counter per (stream, state) sends on, vote by vote."""
    ticks = defaultdict(list)
    for state, party, event_us, arrival_us, stream in rows:
        ticks[stream, state, arrival_us // tick_us].append((arrival_us, event_us, party == "D"))
    sent = []
    for (stream, state, tick), held in ticks.items():
        held.sort()
        for batch, at in enumerate(range(0, len(held), cap + 1)):
            flush = held[at : at + cap + 1]
            democrat = sum(d for _, _, d in flush)
            full = len(flush) == cap + 1
            sent.append((
                stream, state, tick, batch, democrat, len(flush) - democrat,
                max(e for _, e, _ in flush),
                max(a for a, _, _ in flush) if full else (tick + 1) * tick_us,
                full,
            ))
    return sorted(sent, key=repr)


def spread(n, seed, span=1000, states=("CA", "TX")):
    rng = random.Random(seed)
    return [
        (rng.choice(states), rng.choice("DRI"), rng.randrange(span), rng.randrange(span),
         rng.choice((1, 2)))
        for _ in range(n)
    ]


CASES = {
    "spread": spread(400, 1),
    "few_instants": spread(400, 2, span=6),
    "one_hot_group": spread(60, 3) + [("NY", "D", i % 50, i % 97, 1) for i in range(400)],
    "one_hot_instant": spread(60, 4) + [("NY", "DR"[i % 2], i % 83, 5, 1) for i in range(400)],
    "copies": spread(60, 5) + [("NY", "D", 3, 5, 1)] * 400,
    "negative_times": [(s, p, e - 500, a - 500, st) for s, p, e, a, st in spread(200, 6)],
}


@pytest.mark.parametrize("sort_rows, broadcast_rows", [(1_000_000, 1000), (1_000_000, 0), (10, 1000), (0, 0)])
@pytest.mark.parametrize("name", sorted(CASES))
def test_same_as_replay(spark, monkeypatch, name, sort_rows, broadcast_rows):
    monkeypatch.setattr(flushing, "EVENT_SLICE_US", 16)
    monkeypatch.setattr(flushing, "BLOCK", 3)
    rows = CASES[name]
    tick_us, cap = (2000, 10) if name == "spread" else (300, 2)
    flushed = flush_partials(votes(spark, rows), tick_us, cap, sort_rows, broadcast_rows)
    assert tuples(flushed, *COLUMNS) == replay(rows, tick_us, cap)


@pytest.mark.parametrize("n, flushes", [(1, 1), (2, 1), (3, 1), (4, 2), (6, 2), (7, 3)])
def test_cap_is_exceeded_by_one(spark, n, flushes):
    rows = [("CA", "D", i, i, 1) for i in range(n)]
    assert flush_partials(votes(spark, rows), 1000, 2).count() == flushes


def test_no_cap_flushes_each_tick_once(spark):
    rows = spread(300, 7)
    flushed = flush_partials(votes(spark, rows), 100)
    assert tuples(flushed, *COLUMNS[:-1]) == [r[:-1] for r in replay(rows, 100, 10**9)]


def test_no_votes_no_rows(spark):
    none = votes(spark, [("CA", "D", 1)]).where("false")
    assert flush_partials(none, 100, 2).count() == 0
    assert flush_partials(none, 100).count() == 0


@pytest.mark.parametrize("tick_us, cap", [(7, 0), (50, 3), (10_000, 30)])
def test_merge_is_independent_of_flushing(spark, tick_us, cap):
    rows = votes(spark, spread(300, 8))
    columns = ("state", "Dvotes", "Rvotes", "event_us")
    merged = merge_partials(flush_partials(rows, tick_us, cap))
    assert tuples(merged, *columns) == tuples(count_votes(rows), *columns)


def test_a_cap_out_of_reach_needs_one_aggregation(spark):
    """No vote is looked at twice when no group reaches the cap."""
    rows = votes(spark, spread(100, 9))
    flushed = flush_partials(rows, 300, 1000)
    plan = flushed._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Join" not in plan and "Aggregate" not in plan
    assert flushed.agg(F.sum(F.col("Dvotes") + F.col("Rvotes"))).first()[0] == 100
