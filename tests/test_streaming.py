"""Streams against batch, and what happens when a batch is run again."""

import time

import pytest

from votestream.operators import (
    count_votes,
    dedup_stream,
    flush_partials,
    seed_totals,
    valid_votes,
    winners,
)
from votestream.schema import STATES
from votestream.sources import merge_streams, read_vote_stream, read_votes, states_df, write_votes
from votestream.streaming import (
    jobs,
    read_latency_log,
    read_ledger,
    read_report,
    read_totals,
    roll_up,
    start_counting,
    start_reporting,
    write_partials,
)

from rows import tuples, votes

TOTALS = ("state", "Dvotes", "Rvotes")


def cast(spark, n, seed=0, stream=1):
    known = STATES + ("ZZ",)
    return votes(spark, [
        (known[(i * 7 + seed) % len(known)], "DRI"[(i + seed) % 3], 1_000_000 + i * 1000, 0, stream)
        for i in range(n)
    ])


@pytest.fixture
def source(spark, tmp_path):
    folder = str(tmp_path / "votes")
    write_votes(cast(spark, 700), folder, rows_per_file=60)
    return folder


class Paths:
    def __init__(self, root):
        self.ledger, self.latencies, self.checkpoint, self.rejects = (
            str(root / name) for name in ("ledger", "latencies", "checkpoint", "rejects")
        )

    def count(self, spark, source, max_files=2, **more):
        query = start_counting(
            read_vote_stream(spark, source, max_files=max_files),
            self.ledger, self.latencies, self.checkpoint, available_now=True, **more,
        )
        assert query.awaitTermination(120)
        return query


def batch_totals(spark, source):
    return seed_totals(states_df(spark), count_votes(valid_votes(read_votes(spark, source))))


def test_stream_equals_batch(spark, source, tmp_path):
    paths = Paths(tmp_path)
    paths.count(spark, source, rejects=paths.rejects)
    ledger = read_ledger(spark, paths.ledger)
    batches = ledger.select("batch_id").distinct().count()
    assert batches > 1
    assert len(ledger.inputFiles()) == batches  # one small file each
    assert tuples(read_totals(spark, paths.ledger), *TOTALS) == tuples(
        batch_totals(spark, source), *TOTALS)
    # One latency row per partial count, stamped after its newest vote.
    log = read_latency_log(spark, paths.latencies)
    assert log.count() == ledger.count()
    assert log.where("latency_us <= 0 or time_us <= latency_us").count() == 0
    rejected = spark.read.parquet(paths.rejects)
    counted = sum(r.Dvotes + r.Rvotes for r in ledger.collect())
    assert counted + rejected.count() == 700
    assert {r.reason for r in rejected.collect()} == {"unknown_state"}


def test_stream_with_a_cap(spark, source, tmp_path):
    paths = Paths(tmp_path)
    paths.count(spark, source, max_files=100, cap=2)
    partials = read_ledger(spark, paths.ledger)
    assert partials.where("Dvotes + Rvotes > 3").count() == 0
    assert partials.where("Dvotes + Rvotes = 3").count() > 0
    assert tuples(read_totals(spark, paths.ledger), *TOTALS) == tuples(
        batch_totals(spark, source), *TOTALS)
    # The same cuts as a replay of the same votes within one tick.
    replayed = flush_partials(
        valid_votes(read_votes(spark, source)), 1 << 62, 2)
    columns = ("stream", "state", "Dvotes", "Rvotes", "event_us")
    assert tuples(partials, *columns) == tuples(replayed, *columns)


def test_restart_goes_on_where_it_stopped(spark, source, tmp_path):
    paths = Paths(tmp_path)
    paths.count(spark, source)
    before = read_ledger(spark, paths.ledger).count()
    paths.count(spark, source)  # nothing new
    assert read_ledger(spark, paths.ledger).count() == before
    more = cast(spark, 100, seed=3, stream=2)
    more.selectExpr(
        "to_json(struct(id, state, party, event_us / 1e6 as event_time)) as value"
    ).write.mode("append").text(source)
    paths.count(spark, source)
    assert tuples(read_totals(spark, paths.ledger), *TOTALS) == tuples(
        batch_totals(spark, source), *TOTALS)


def test_failed_batch_is_run_again_without_counting_twice(spark, source, tmp_path, monkeypatch):
    paths = Paths(tmp_path)
    real, calls = jobs.write_partials, []

    def fails_after_writing(partials, batch_id, path, files):
        real(partials, batch_id, path, files)
        calls.append(batch_id)
        if len(calls) == 2:
            raise RuntimeError("lost after the write")

    monkeypatch.setattr(jobs, "write_partials", fails_after_writing)
    with pytest.raises(Exception, match="lost after the write"):
        paths.count(spark, source)
    paths.count(spark, source)
    assert calls[1] == calls[2]  # the failed batch came again under its id
    assert tuples(read_totals(spark, paths.ledger), *TOTALS) == tuples(
        batch_totals(spark, source), *TOTALS)
    log = read_latency_log(spark, paths.latencies)
    assert log.count() == read_ledger(spark, paths.ledger).count()


def test_same_batch_id_twice(spark, tmp_path):
    partials = count_votes(votes(spark, [("CA", "D", 1), ("CA", "R", 2)]), ["stream", "state"])
    for batch_id in (0, 1, 1, 1):
        write_partials(partials, batch_id, str(tmp_path))
    totals = {r.state: r for r in read_totals(spark, str(tmp_path)).collect()}
    assert (totals["CA"].Dvotes, totals["CA"].Rvotes) == (2, 2)
    assert len(totals) == 50


def test_rolled_up_ledger_goes_on(spark, source, tmp_path):
    paths = Paths(tmp_path)
    paths.count(spark, source)
    rolled = str(tmp_path / "rolled")
    log = str(tmp_path / "rolled-log")
    roll_up(spark, paths.ledger, rolled, paths.checkpoint, paths.latencies, log)
    assert read_latency_log(spark, log).count() == read_latency_log(spark, paths.latencies).count()
    with pytest.raises(ValueError):
        roll_up(spark, paths.ledger, paths.ledger, paths.checkpoint)
    assert read_ledger(spark, rolled).select("batch_id").distinct().collect() == [(-1,)]
    assert tuples(read_totals(spark, rolled), *TOTALS) == tuples(
        read_totals(spark, paths.ledger), *TOTALS)
    write_votes(cast(spark, 50, stream=3), str(tmp_path / "later"))
    spark.read.text(str(tmp_path / "later")).write.mode("append").text(source)
    paths.ledger = rolled
    paths.count(spark, source)
    assert tuples(read_totals(spark, rolled), *TOTALS) == tuples(
        batch_totals(spark, source), *TOTALS)


def test_roll_up_leaves_out_what_will_be_run_again(spark, source, tmp_path, monkeypatch):
    paths = Paths(tmp_path)
    real, calls = jobs.write_partials, []

    def fails_after_writing(partials, batch_id, path, files):
        real(partials, batch_id, path, files)
        calls.append(batch_id)
        if len(calls) == 2:
            raise RuntimeError("lost after the write")

    monkeypatch.setattr(jobs, "write_partials", fails_after_writing)
    with pytest.raises(Exception, match="lost after the write"):
        paths.count(spark, source)
    rolled = str(tmp_path / "rolled")
    roll_up(spark, paths.ledger, rolled, paths.checkpoint)
    paths.ledger = rolled
    paths.count(spark, source)
    assert tuples(read_totals(spark, rolled), *TOTALS) == tuples(
        batch_totals(spark, source), *TOTALS)


@pytest.mark.parametrize("cap", [None, 2])
def test_times_out_of_range_are_rejected(spark, tmp_path, cap):
    folder = str(tmp_path / "votes")
    line = '{"id":"1-%d","state":"CA","party":"D","event_time":%s}'
    texts = [line % (i, t) for i, t in enumerate(("-9.2233e12", "5e12", "1e9", "1e9"))]
    spark.createDataFrame([(t,) for t in texts], "value string").write.text(folder)
    paths = Paths(tmp_path)
    paths.count(spark, folder, rejects=paths.rejects, cap=cap)
    assert [r.reason for r in spark.read.parquet(paths.rejects).collect()] == ["bad_time"] * 2
    assert sum(r.Dvotes for r in read_ledger(spark, paths.ledger).collect()) == 2


def test_reports_follow_the_stream(spark, source, tmp_path):
    reports = str(tmp_path / "reports")
    query = start_reporting(
        read_vote_stream(spark, source, max_files=2), reports, str(tmp_path / "checkpoint"),
        available_now=True)
    assert query.awaitTermination(180)
    totals = batch_totals(spark, source)
    columns = (*TOTALS, "winner")
    assert tuples(read_report(spark, f"{reports}/winners"), *columns) == tuples(
        winners(totals), *columns)
    national = read_report(spark, f"{reports}/national").first()
    assert national.Total == sum(r.Dvotes + r.Rvotes for r in totals.collect())
    assert read_report(spark, f"{reports}/map").columns == [
        "state", "winner", "Rvotes", "Dvotes", "colour"]


def test_inputs_merge_into_one_count(spark, tmp_path):
    folders = [str(tmp_path / name) for name in ("first", "second")]
    for stream, folder in enumerate(folders):
        write_votes(cast(spark, 120, seed=stream, stream=stream), folder)
    paths = Paths(tmp_path)
    merged = merge_streams(read_vote_stream(spark, folder) for folder in folders)
    query = start_counting(
        merged, paths.ledger, paths.latencies, paths.checkpoint, available_now=True)
    assert query.awaitTermination(120)
    assert tuples(read_totals(spark, paths.ledger), *TOTALS) == tuples(
        batch_totals(spark, folders), *TOTALS)
    assert {r.stream for r in read_ledger(spark, paths.ledger).collect()} == {0, 1}


def test_ticks_by_the_clock(spark, source, tmp_path):
    paths = Paths(tmp_path)
    query = start_counting(
        read_vote_stream(spark, source, max_files=4),
        paths.ledger, paths.latencies, paths.checkpoint, tick_seconds=1)
    try:
        wanted = tuples(batch_totals(spark, source), *TOTALS)
        deadline = time.time() + 90
        found = None
        while found != wanted and time.time() < deadline:
            time.sleep(1)
            if query.lastProgress and query.lastProgress["batchId"] > 0:
                found = tuples(read_totals(spark, paths.ledger), *TOTALS)
        assert found == wanted
    finally:
        query.stop()


def test_repeated_votes_of_a_stream_are_dropped_on_request(spark, tmp_path):
    folder = str(tmp_path / "votes")
    once = cast(spark, 40)
    write_votes(once.union(once), folder)
    query = (
        dedup_stream(valid_votes(read_vote_stream(spark, folder)))
        .writeStream.format("memory").queryName("once")
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True).start())
    assert query.awaitTermination(120)
    assert tuples(spark.table("once"), "id") == tuples(valid_votes(once), "id")


def test_late_votes_and_votes_without_an_id_are_kept(spark, tmp_path):
    folder = str(tmp_path / "votes")
    line = '{"id":%s,"state":"CA","party":"D","event_time":%d}'
    for rows in ([('"1-1"', 10**9), ("null", 5)], [('"1-2"', 5), ('"1-1"', 7), ("null", 5), ("null", 5)]):
        texts = [(line % row,) for row in rows]
        spark.createDataFrame(texts, "value string").coalesce(1).write.mode("append").text(folder)
    query = (
        dedup_stream(valid_votes(read_vote_stream(spark, folder, max_files=1)))
        .writeStream.format("memory").queryName("late")
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True).start())
    assert query.awaitTermination(120)
    ids = [r.id for r in spark.table("late").collect()]
    assert sorted(map(str, ids)) == ["1-1", "1-2", "None", "None", "None"]
    with pytest.raises(ValueError):
        dedup_stream(read_vote_stream(spark, folder))
