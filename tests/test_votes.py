"""Parsing, validity, counting and reports on hand-made rows."""

import pytest

from votestream.functions import encode_party
from votestream.operators import (
    count_votes,
    dedup_votes,
    ingest_audit,
    map_table,
    merge_partials,
    national_totals,
    rejected_votes,
    seed_totals,
    split_valid,
    valid_votes,
    votes_by_stream_and_state,
    winners,
)
from votestream.schema import STATES, backlog_rows, flush_cap, rate_per_stream, row_budget
from votestream.sources import (
    encode_votes,
    parse_votes,
    read_states,
    read_votes,
    states_df,
    write_votes,
)

from rows import VOTE, line, lines, tuples, votes

GOOD = dict(id="5555-0", state="CA", party="D", event_time=1608029980.33)


def without(field):
    return {k: v for k, v in GOOD.items() if k != field}


@pytest.mark.parametrize(
    "text, reason",
    [
        (line(**GOOD), None),
        ("  \t" + line(**GOOD) + " \r", None),
        (line(**{**GOOD, "party": "I"}), None),
        (line(**{**GOOD, "event_time": 3}), None),
        (line(**{**GOOD, "extra": 1}), None),
        (line(**{**GOOD, "state": "ZZ"}), "unknown_state"),
        (line(**without("party")), "missing_field"),
        (line(**without("event_time")), "missing_field"),
        (line(**without("state")), "missing_field"),
        (line(**{**GOOD, "event_time": "NaN"}), "bad_time"),
        (line(**{**GOOD, "event_time": float("nan")}), "bad_time"),
        (line(**{**GOOD, "event_time": "Infinity"}), "bad_time"),
        (line(**{**GOOD, "event_time": 1e300}), "bad_time"),
        (line(**{**GOOD, "event_time": "3.5"}), "malformed"),
        ("junk", "malformed"),
        ("", "malformed"),
        (" \r", "malformed"),
        (None, "malformed"),
    ],
)
def test_each_line_is_valid_or_rejected(spark, text, reason):
    valid, rejects = split_valid(parse_votes(lines(spark, [text])))
    assert valid.count() == (reason is None)
    assert [r.reason for r in rejects.collect()] == ([] if reason is None else [reason])


def test_rejects_keep_the_line(spark):
    text = line(**{**GOOD, "state": "ZZ"})
    rejects = rejected_votes(parse_votes(lines(spark, [text, "junk"])))
    assert tuples(rejects, "line", "reason") == sorted(
        [(text, "unknown_state"), ("junk", "malformed")], key=repr
    )


def test_strict_parsing_fails_on_junk_only(spark):
    blank = parse_votes(lines(spark, [line(**GOOD), "", line(**without("party"))]), strict=True)
    assert tuples(rejected_votes(blank), "reason") == [("malformed",), ("missing_field",)]
    for junk in ("junk", line(**{**GOOD, "event_time": "3.5"})):
        with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING"):
            parse_votes(lines(spark, [junk]), strict=True).collect()


def test_json_keeps_microseconds(spark):
    times = [0, 1, 1608029980330001, 1704067207179575, 4102444800999999]
    rows = votes(spark, [("CA", "D", t) for t in times])
    back = parse_votes(encode_votes(rows))
    assert tuples(back, "id", "stream", "event_us") == tuples(rows, "id", "stream", "event_us")


def test_votes_written_and_read(spark, tmp_path):
    rows = votes(spark, [(s, "D", i) for i, s in enumerate(STATES)])
    write_votes(rows, str(tmp_path / "votes"), rows_per_file=7)
    back = valid_votes(read_votes(spark, str(tmp_path / "votes")))
    assert tuples(back, "id", "state", "event_us") == tuples(rows, "id", "state", "event_us")


def test_streams_merge_by_path_list(spark, tmp_path):
    for stream in (1, 2):
        write_votes(votes(spark, [("CA", "D", 1, 1, stream)]), str(tmp_path / str(stream)))
    paths = [str(tmp_path / "1"), str(tmp_path / "2")]
    assert tuples(read_votes(spark, paths), "stream") == [(1,), (2,)]
    assert read_votes(spark, str(tmp_path / "*")).count() == 2


def test_own_state_list(spark, tmp_path):
    (tmp_path / "states.txt").write_text("AA\n BB \n\nAA\n")
    states = read_states(spark, str(tmp_path / "states.txt"))
    assert tuples(states, "state") == [("AA",), ("BB",)]
    valid, rejects = split_valid(votes(spark, [("AA", "D", 1), ("CA", "D", 1)]), states)
    assert tuples(valid, "state") == [("AA",)]
    assert tuples(rejects, "state", "reason") == [("CA", "unknown_state")]


def test_builtin_states(spark):
    assert [r.state for r in states_df(spark).collect()] == list(STATES)
    assert len(set(STATES)) == 50


def test_party_rule(spark):
    counted = count_votes(votes(spark, [("CA", "D", 5), ("CA", "R", 9), ("CA", "I", 7), ("CA", "d", 1)]))
    assert tuples(counted, "state", "Dvotes", "Rvotes", "event_us") == [("CA", 1, 3, 9)]
    flags = spark.createDataFrame([(0,), (1,)], "flag int")
    assert tuples(flags.select(encode_party("flag").alias("p")), "p") == [("D",), ("R",)]


def test_totals_winners_and_map(spark):
    cast = [("CA", "D", 1), ("CA", "R", 1), ("TX", "R", 1), ("NY", "D", 1), ("ZZ", "R", 1)]
    totals = seed_totals(states_df(spark), count_votes(votes(spark, cast)))
    assert totals.count() == 50
    by_state = {r.state: r for r in winners(totals).collect()}
    assert by_state["CA"].winner == "Democrat"  # a tie
    assert by_state["AL"].winner == "Democrat"  # no votes
    assert (by_state["AL"].Dvotes, by_state["AL"].Rvotes) == (0, 0)
    assert by_state["TX"].winner == "Republican"
    assert national_totals(totals).collect() == [(2, 2, 4)]
    colours = {r.state: r.colour for r in map_table(totals).collect()}
    assert (colours["TX"], colours["NY"]) == ("#bd3428", "#346fed")


def test_seed_without_votes(spark):
    seeded = seed_totals(states_df(spark))
    assert seeded.count() == 50
    assert national_totals(seeded).collect() == [(0, 0, 0)]
    assert national_totals(seeded.where("false")).collect() == [(0, 0, 0)]


def test_merge_equals_direct_count(spark):
    rows = votes(spark, [(STATES[i % 7], "DR"[i % 3 == 0], i) for i in range(200)])
    parts = count_votes(rows, ["stream", "state"]).union(count_votes(rows, ["stream", "state"]))
    merged = merge_partials(parts)
    twice = count_votes(rows.union(rows))
    columns = ("state", "Dvotes", "Rvotes", "event_us")
    assert tuples(merged, *columns) == tuples(twice, *columns)


def test_dedup_keeps_the_first(spark):
    rows = [("1-0", 1, "CA", "D", 5, 9), ("1-0", 1, "CA", "D", 5, 8), ("1-0", 1, "CA", "D", 4, 11),
            ("1-1", 1, "TX", "R", 1, 1), ("1-1", 1, "TX", "R", 1, 1)]
    once = dedup_votes(spark.createDataFrame(rows, VOTE))
    assert once.columns == ["id", "stream", "state", "party", "event_us", "arrival_us"]
    assert tuples(once, "*") == [("1-0", 1, "CA", "D", 4, 11), ("1-1", 1, "TX", "R", 1, 1)]


def test_audit(spark):
    rows = [("7-0", 7, "CA", "D", 1_000_000, 0), ("7-3", 7, "CA", "R", 3_000_000, 0),
            ("7-3", 7, "TX", "R", 3_000_000, 0), ("8-0", 8, "CA", "D", 5, 0)]
    cast = spark.createDataFrame(rows, VOTE)
    audit = {r.stream: r for r in ingest_audit(cast, budget=10).collect()}
    assert (audit[7].votes, audit[7].Dvotes, audit[7].Rvotes) == (3, 1, 2)
    assert (audit[7].missing, audit[7].votes_per_second, audit[7].short_of_budget) == (2, 1.5, 7)
    assert (audit[8].missing, audit[8].votes_per_second) == (0, None)
    assert tuples(votes_by_stream_and_state(cast), "stream", "state", "votes") == [
        (7, "CA", 2), (7, "TX", 1), (8, "CA", 1)]


def test_settings():
    assert rate_per_stream(30_000, 2) == 15_000
    assert rate_per_stream(5, 2) == 3  # halves round up
    assert flush_cap(22_000, 1) == 132_000
    assert backlog_rows(22_000, 1) == 880_000
    assert row_budget(22_000, 1) == 6_600_000


def test_dedup_keeps_every_vote_without_an_id(spark):
    rows = [(None, 1, "CA", "D", 5, 5)] * 3 + [("1-1", 1, "CA", "D", 5, 5)] * 2
    once = dedup_votes(spark.createDataFrame(rows, VOTE))
    assert sorted(str(r.id) for r in once.collect()) == ["1-1", "None", "None", "None"]
