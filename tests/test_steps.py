"""Row-bounded input, counters and memories that outlive a micro-batch, merged ledgers."""

import random
from bisect import bisect
from functools import reduce
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from votestream.operators import (
    carry_flushes, count_votes, dedup_stream, ingest_audit, latency_summary, missing_ranges, valid_votes,
)
from votestream.operators.dedup import BUCKET, pack, unpack
from votestream.operators.flushing import HELD
from votestream.schema import STATES
from votestream.sources import read_bounded
from votestream.sources.backlog import _Reader
from votestream.streaming import compact_latencies, compact_ledger, compaction, ledger, read_held, start_counting
from votestream.streaming.compaction import Segment, segments

from rows import tuples, votes

VOTES = "id string, stream bigint, state string, party string, event_us bigint, arrival_us bigint"


def write(path, rows, group=50):
    """Votes (stream, sequence) as a Parquet file with small row groups."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    table = pa.table({
        "id": [f"{s}-{q}" for s, q in rows], "stream": [s for s, _ in rows],
        "state": [STATES[q % 3] for _, q in rows], "party": ["DR"[q % 2] for _, q in rows],
        "event_us": [q for _, q in rows], "arrival_us": [q for _, q in rows], "more": ["x"] * len(rows),
    })
    pq.write_table(table, path, row_group_size=group)


def run(spark, source, root, **more):
    query = start_counting(source, f"{root}/ledger", f"{root}/latencies", f"{root}/checkpoint", trigger_seconds=0, **more)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]


# --- bounded input -----------------------------------------------------------


def rows_between(reader, start, end):
    found = []
    for part in reader.partitions(start, end):
        for batch in reader.read(part):
            found += batch.column("id").to_pylist()
    return found


def test_every_row_once_within_the_bound(spark, tmp_path):
    write(tmp_path / "in/a/001.parquet", [(1, q) for q in range(130)])
    write(tmp_path / "in/a/002.parquet", [])
    write(tmp_path / "in/a/003.parquet", [(1, q) for q in range(130, 150)])
    write(tmp_path / "in/b/001.parquet", [(2, q) for q in range(35)])
    write(tmp_path / "in/_hidden/001.parquet", [(9, 9)])
    schema = spark.createDataFrame([], "id string, state string").schema
    reader = _Reader(str(tmp_path / "in"), 40, schema)
    at, seen, steps = reader.initialOffset(), [], 0
    while (end := reader.latestOffset()) != at:
        new = rows_between(reader, at, end)
        assert max(sum(i.startswith(f"{s}-") for i in new) for s in (1, 2)) <= 40
        at, seen, steps = end, seen + new, steps + 1
        if steps == 2:  # a restart: the engine plans the last batch again
            reader = _Reader(str(tmp_path / "in"), 40, schema)
            assert rows_between(reader, before, at) == new  # noqa: F821
        before = at  # noqa: F841
    assert sorted(seen) == sorted([f"1-{q}" for q in range(150)] + [f"2-{q}" for q in range(35)]) and steps == 4
    write(tmp_path / "in/b/002.parquet", [(2, 35)])
    assert rows_between(reader, at, reader.latestOffset()) == ["2-35"]
    with pytest.raises(ValueError):
        _Reader(str(tmp_path), 0, schema)


def test_no_micro_batch_takes_more(spark, tmp_path):
    write(tmp_path / "in/001.parquet", [(1, q) for q in range(100)])
    source = lambda: read_bounded(spark, str(tmp_path / "in"), 40, VOTES)
    assert run(spark, source(), tmp_path) == [40, 40, 20]
    write(tmp_path / "in/002.parquet", [(1, q) for q in range(100, 150)])
    assert run(spark, source(), tmp_path) == [40, 10]
    found = ledger.read_ledger(spark, f"{tmp_path}/ledger").agg({"Dvotes": "sum", "Rvotes": "sum"}).first()
    assert sum(found) == 150


# --- row numbers -------------------------------------------------------------


def test_missing_ranges(spark):
    r = random.Random(1)
    came = {
        1: {0, 1, 5, BUCKET - 1, BUCKET, 3 * BUCKET + 7, 7 * BUCKET},
        2: {q for q in range(2 * BUCKET + 10) if r.random() < 0.7},
        3: {BUCKET * 2}, 4: set(range(10)), 5: {BUCKET - 1},
    }
    rows = [(f"{s}-{q}", s, "CA", "D", 1, 1) for s, qs in came.items() for q in qs for _ in range(1 + (q % 97 == 0))]
    table = spark.createDataFrame(rows + [("junk", 4, "CA", "D", 1, 1), (None, 4, "CA", "D", 1, 1)], VOTES)
    wanted = []
    for s, qs in came.items():
        gone = sorted(set(range(max(qs))) - qs)
        cuts = [0, *(i for i in range(1, len(gone)) if gone[i] != gone[i - 1] + 1), len(gone)]
        wanted += [(s, gone[a], gone[b - 1]) for a, b in zip(cuts, cuts[1:]) if a < b]
    found = missing_ranges(table)
    assert sorted(map(tuple, found.select("stream", "first", "last").collect())) == sorted(wanted)
    audit = {r.stream: r for r in ingest_audit(table, budget=100).collect()}
    assert {s: audit[s].missing for s in came} == {s: max(qs) + 1 - len(qs) for s, qs in came.items()}
    assert audit[4].votes == 13 and audit[4].short_of_budget == 87


def test_audit_shuffles_bitmaps_and_not_votes(spark):
    table = votes(spark, [("CA", "D", i) for i in range(50)])
    plan = ingest_audit(table)._jdf.queryExecution().executedPlan().toString()
    assert "bitmap_construct_agg" in plan and "distinct" not in plan.lower()


# --- memory of a stream ------------------------------------------------------


@pytest.mark.parametrize("n", [0, 1, 100, 2047, 2048, BUCKET])
def test_packed_places(n):
    places = np.sort(np.random.default_rng(n).choice(BUCKET, n, replace=False))
    packed = pack(places)
    assert unpack(packed).tolist() == places.tolist() and len(packed) <= BUCKET // 8


def test_repeats_in_later_micro_batches_and_after_a_restart(spark, tmp_path):
    write(tmp_path / "in/001.parquet", [(1, q % 30) for q in range(90)] + [(2, BUCKET * 3 + 1)] * 2)
    source = lambda: dedup_stream(valid_votes(read_bounded(spark, str(tmp_path / "in"), 40, VOTES)))
    assert len(run(spark, source(), tmp_path, partitions=2)) == 3
    total = lambda: sum(ledger.read_ledger(spark, f"{tmp_path}/ledger").agg({"Dvotes": "sum", "Rvotes": "sum"}).first())
    assert total() == 31
    write(tmp_path / "in/002.parquet", [(1, q) for q in (5, 29, 30)] + [(2, BUCKET * 3 + 1)])
    run(spark, source(), tmp_path, partitions=2)
    assert total() == 32


def test_ids_of_another_form(spark, tmp_path):
    ids = ["1-1", "1-01", "x", "x", "x", None, None, "1-1", "-5", "1-2-3", "1-2-3"]
    folder = tmp_path / "in"
    folder.mkdir()
    for n, part in enumerate((ids, ids[:8])):
        pq.write_table(pa.table({
            "id": part, "stream": [1] * len(part), "state": ["CA"] * len(part), "party": ["D"] * len(part),
            "event_us": [n] * len(part), "arrival_us": pa.array([None] * len(part), pa.int64()),
        }), folder / f"{n}.parquet")
    source = dedup_stream(valid_votes(read_bounded(spark, str(folder), 11, VOTES)))
    run(spark, source, tmp_path / "out", partitions=2)
    found = ledger.read_ledger(spark, f"{tmp_path}/out/ledger").agg({"Dvotes": "sum"}).first()[0]
    assert found == len({i for i in ids if i}) + 2 + 2  # votes without an id all count


# --- counters ----------------------------------------------------------------


def test_a_cap_reached_over_two_micro_batches_is_one_flush(spark, tmp_path):
    write(tmp_path / "in/001.parquet", [(1, 3 * i) for i in range(10)])  # all in one state
    run(spark, read_bounded(spark, str(tmp_path / "in"), 4, VOTES), tmp_path, cap=5, held=f"{tmp_path}/held", tick_seconds=0)
    (closed,) = ledger.read_ledger(spark, f"{tmp_path}/ledger").collect()
    assert (closed.Dvotes + closed.Rvotes, closed.event_us, closed.batch_id) == (6, 15, 1)
    (held,) = read_held(spark, f"{tmp_path}/held", 2).collect()
    assert (held.votes, held.event_us) == (4, 27)


def test_a_later_tick_closes_what_is_held(spark, tmp_path, monkeypatch):
    from votestream.streaming import jobs

    write(tmp_path / "in/001.parquet", [(1, 0), (1, 3), (1, 6)])
    source = lambda: read_bounded(spark, str(tmp_path / "in"), 2, VOTES)
    clock = iter([100, 104])
    monkeypatch.setattr(jobs.time, "time", lambda: next(clock))
    run(spark, source(), tmp_path, cap=9, held=f"{tmp_path}/held", tick_seconds=4)
    assert [r.Dvotes + r.Rvotes for r in ledger.read_ledger(spark, f"{tmp_path}/ledger").collect()] == [2]
    assert [r.votes for r in read_held(spark, f"{tmp_path}/held", 1).collect()] == [1]


@pytest.mark.parametrize("sort_rows, broadcast_rows", [(10**6, 10**5), (2, 10**5), (10**6, 0)])
def test_carried_counts_equal_a_count_one_by_one(spark, sort_rows, broadcast_rows):
    r = random.Random(7)
    held, closed, counters = spark.createDataFrame([], "stream long, state string, votes long, Dvotes long, Rvotes long, event_us long"), [], {}
    expected = []
    for _ in range(3):
        new = sorted((r.randrange(60), r.randrange(60), r.choice("DR"), r.choice(["CA", "NY"])) for _ in range(40))
        for arrival, event, party, state in sorted(new, key=lambda v: (v[0], v[1], v[2] == "D")):
            mine = counters.setdefault(state, [])
            mine.append((event, party))
            if len(mine) == 8:
                expected.append((state, sum(p == "D" for _, p in mine), max(mine)[0]))
                mine.clear()
        batch = votes(spark, [(state, party, event, arrival, 1) for arrival, event, party, state in new])
        flushed, held = carry_flushes(batch, held, 7, sort_rows, broadcast_rows)
        closed += [(f.state, f.Dvotes, f.event_us) for f in flushed.collect()]
    assert sorted(closed) == sorted(expected)
    assert {h.state: (h.votes, h.Dvotes) for h in held.collect()} == {
        s: (len(m), sum(p == "D" for _, p in m)) for s, m in counters.items() if m}
    assert set(HELD) <= set(held.columns)
    with pytest.raises(ValueError):
        start_counting(batch, "a", "b", "c", held="d")


# --- merged folders ----------------------------------------------------------


@pytest.fixture
def partials(spark):
    return count_votes(votes(spark, [("CA", "D", 1), ("CA", "R", 2), ("NY", "D", 3)]), ["stream", "state"]).persist()


def folders(path):
    return len(list(Path(path).glob("batch_id=*"))) + len(list(Path(path).glob("_segments/*")))


def totals(spark, path):
    return {r.state: (r.Dvotes, r.Rvotes) for r in ledger.read_totals(spark, path).collect() if r.Dvotes}


def test_a_long_ledger_stays_short(spark, partials, tmp_path, monkeypatch):
    monkeypatch.setattr(compaction, "FAN", 3)
    path, log = str(tmp_path / "ledger"), str(tmp_path / "log")
    stamped = partials.selectExpr("stream", "state", "event_us as time_us", "1L as latency_us").persist()
    most = 0
    for n in range(41):
        ledger.write_partials(partials, n, path, 1)
        ledger.write_latencies(stamped, n, log, 1)
        if n and n % 4 == 0:
            compact_ledger(spark, path, n - 1)
            compact_latencies(spark, log, n - 1)
        most = max(most, folders(path))
    assert most <= 2 * 4 + 4 and folders(log) <= 2 * 4 + 8
    assert totals(spark, path) == {"CA": (41, 41), "NY": (41, 0)}
    assert ledger.read_latency_log(spark, log).groupBy("state").count().collect() and ledger.read_latency_log(spark, log).count() == 82
    assert {r.batch_id for r in ledger.read_latency_log(spark, log).collect()} == set(range(41))
    kept = segments(spark, log)
    assert kept[0].first == 0 and all(a.last + 1 == b.first for a, b in zip(kept, kept[1:])) and len(kept) <= 6
    with pytest.raises(ValueError, match="merged"):
        ledger.write_partials(partials, 3, path, 1)


def test_a_crash_counts_nothing_twice(spark, partials, tmp_path, monkeypatch):
    path = str(tmp_path)
    for n in range(6):
        ledger.write_partials(partials, n, path, 1)
    compact_ledger(spark, path, 1)

    def lost(*_):
        raise RuntimeError("lost")

    # Between the segment and its manifest.
    monkeypatch.setattr(compaction._Folder, "publish", lost)
    with pytest.raises(RuntimeError):
        compact_ledger(spark, path, 3)
    assert totals(spark, path) == {"CA": (6, 6), "NY": (6, 0)} and segments(spark, path) == [Segment(0, 1, 0)]
    monkeypatch.undo()
    # Between the manifest and the removal of what it replaces.
    monkeypatch.setattr(compaction._Folder, "remove", lost)
    with pytest.raises(RuntimeError):
        compact_ledger(spark, path, 3)
    assert totals(spark, path) == {"CA": (6, 6), "NY": (6, 0)} and segments(spark, path) == [Segment(0, 3, 0)]
    monkeypatch.undo()
    before = ledger.read_ledger(spark, path)  # planned before the next compaction
    compact_ledger(spark, path, 4)
    assert before.agg({"Dvotes": "sum"}).first()[0] == 12
    assert totals(spark, path) == {"CA": (6, 6), "NY": (6, 0)}
    compact_ledger(spark, path, 4)  # nothing new
    assert segments(spark, path) == [Segment(0, 4, 0)]


def test_sketches_of_many_batches(spark, tmp_path):
    """Merged while they are written, run again, and compared with the ranks of all values."""
    path, every = str(tmp_path / "sketches"), []
    for n in range(9):
        first = spark.range(n * 3000, n * 3000 + 3000)
        rows = first.select((F.col("id") % 2).alias("stream"), (F.xxhash64("id") % 1_000_000).alias("latency_us"))
        for _ in range(2 if n % 3 == 0 else 1):  # a batch that is run again counts once
            ledger.write_sketches(rows, n, path, 400)
        if n and n % 4 == 0:
            ledger.compact_sketches(spark, path, n - 1)
        every.append(rows)
    every = reduce(lambda a, b: a.unionByName(b), every)
    wanted = (0.0, 0.1, 0.5, 0.9, 0.99, 1.0)
    found = {r.stream: r for r in ledger.live_summary(ledger.read_sketches(spark, path), wanted).collect()}
    exact = {r.stream: r for r in latency_summary(every, ["stream"], wanted).collect()}
    values = {s: sorted(r.latency_us / 1e6 for r in every.where(F.col("stream") == s).collect()) for s in (0, 1)}
    assert set(found) == {0, 1}
    for s, row in found.items():
        for c in ("samples", "avg_latency", "min_latency", "max_latency"):
            assert row[c] == exact[s][c]
        for p, c in zip(wanted, ("p0", "p10", "p50", "p90", "p99", "p100")):
            assert abs(bisect(values[s], row[c]) / len(values[s]) - p) <= 0.02
    assert segments(spark, path) and ledger.read_sketches(spark, path).count() == 2


def test_sketches_of_nothing(spark, tmp_path):
    none = spark.createDataFrame([], "stream bigint, latency_us bigint")
    ledger.write_sketches(none, 0, str(tmp_path), 400)
    assert ledger.live_summary(ledger.read_sketches(spark, str(tmp_path))).count() == 0
    ledger.write_sketches(spark.createDataFrame([(None, 5), (1, None)], none.schema), 1, str(tmp_path), 400)
    rows = ledger.live_summary(ledger.read_sketches(spark, str(tmp_path))).collect()
    assert [(r.stream, r.samples, r.p90) for r in rows] == [(None, 1, 5e-6)]
