"""Latency statistics against numpy."""

import numpy as np
import pytest

from votestream.operators import (
    by_run,
    exact_quantiles,
    in_seconds,
    joining,
    latency_histogram,
    latency_points,
    latency_rows,
    latency_summary,
    quantiles,
    relative_time,
    trim_warmup,
)
from votestream.operators import latency as latency_module
from votestream.sources import export_latencies, read_latencies
from votestream.sources.latencies import run_path

from rows import tuples

SECONDS = "run string, time double, latency double"
MICROS = "run string, time_us bigint, latency_us bigint"


@pytest.fixture(params=["small", "large"])
def join_way(request, monkeypatch):
    """With the usual size limits, and as if everything were beyond them."""
    if request.param == "large":
        limits = (joining.BROADCAST_ROWS, quantiles.SORT_VALUES)
        for function in (joining.attach, exact_quantiles):
            defaults = tuple(0 if d in limits else d for d in function.__defaults__)
            monkeypatch.setattr(function, "__defaults__", defaults)


def logs(seed=0):
    rng = np.random.default_rng(seed)
    return {
        "a": (1.6e9 + rng.uniform(0, 300, 257), rng.gamma(2, 0.05, 257)),
        "b": (1.6e9 + rng.uniform(0, 10, 100), np.round(rng.normal(0.01, 0.01, 100), 3)),
        "one": (np.array([5.0]), np.array([0.25])),
        "same": (np.array([1.0, 2.0, 3.0]), np.array([0.5, 0.5, 0.5])),
    }


def second_rows(spark, runs):
    return spark.createDataFrame(
        [(k, float(t), float(x)) for k, (ts, xs) in runs.items() for t, x in zip(ts, xs)], SECONDS
    )


def micro_rows(spark, runs):
    return spark.createDataFrame(
        [
            (k, int(t * 1e6), int(x * 1e6))
            for k, (ts, xs) in runs.items()
            for t, x in zip(ts, xs)
        ],
        MICROS,
    )


def test_summary_of_seconds(spark, join_way):
    runs = logs()
    for row in latency_summary(second_rows(spark, runs), ["run"]).collect():
        values = runs[row.run][1]
        assert row.samples == len(values)
        assert row.avg_latency == pytest.approx(values.mean(), rel=1e-12)
        assert (row.min_latency, row.max_latency) == (values.min(), values.max())
        assert [row.p90, row.p95, row.p99] == list(np.quantile(values, [0.9, 0.95, 0.99]))


def test_summary_of_micros(spark, join_way):
    runs = logs(1)
    for row in latency_summary(micro_rows(spark, runs), ["run"]).collect():
        values = (runs[row.run][1] * 1e6).astype(np.int64)
        assert row.avg_latency == values.sum() / len(values) / 1e6
        wanted = np.quantile(values.astype(float), [0.9, 0.95, 0.99]) / 1e6
        assert [row.p90, row.p95, row.p99] == list(wanted)


@pytest.mark.parametrize("buckets", [3, 64, 4096])
@pytest.mark.parametrize("sort_values", [0, 20])
def test_quantiles_do_not_depend_on_buckets(spark, buckets, sort_values):
    runs = logs(2)
    wanted = (0.0, 0.25, 0.5, 0.999, 1.0)
    if buckets == 3:
        runs["a"] = tuple(x[:40] for x in runs["a"])
    for row in exact_quantiles(
        second_rows(spark, runs), ["run"], "latency", wanted, sort_values=sort_values, buckets=buckets
    ).collect():
        assert row.quantiles == list(np.quantile(runs[row.run][1], wanted))


def test_quantiles_of_a_run_that_spans_years(spark):
    """Microseconds over 30 years, most of them within a second, and the ends of the type."""
    rng = np.random.default_rng(5)
    near = 10**15 + rng.integers(0, 10**6, 3000)
    far = rng.integers(0, 10**15, 200)
    values = np.concatenate([near, far, [-(2**63), 2**63 - 1]]).tolist()
    table = spark.createDataFrame([("a", int(v)) for v in values], "run string, latency bigint")
    wanted = (0.0, 0.1, 0.5, 0.9, 1.0)
    found = exact_quantiles(table, ["run"], "latency", wanted, sort_values=50).first().quantiles
    ordered = sorted(values)
    for p, q in zip(wanted, found):
        at = p * (len(ordered) - 1)
        low, high = float(ordered[int(at)]), float(ordered[min(int(at) + 1, len(ordered) - 1)])
        assert low <= q <= high


def test_quantiles_of_numbers_of_every_size(spark):
    inf = float("inf")
    values = [-inf, -1e308, -1e-310, 0.0, 5e-324, 1e-300, 1e-10, 1.0, 2.0, 3.0, 1e308, 1.5e308, inf, float("nan")]
    table = spark.createDataFrame([("a", v) for v in values], "run string, latency double")
    for buckets in (3, 1000):
        found = exact_quantiles(table, ["run"], "latency", [0.0, 3 / 13, 1.0], sort_values=1, buckets=buckets).first()
        assert found.quantiles[0] == -inf and found.quantiles[1] == pytest.approx(0.0)
        assert np.isnan(found.quantiles[2])


def test_sketched_quantiles(spark):
    runs = logs(3)
    sketched = latency_summary(second_rows(spark, runs), ["run"], approximate=True)
    for row in sketched.collect():
        assert row.p90 == pytest.approx(np.quantile(runs[row.run][1], 0.9), abs=0.02)


def test_trim(spark, join_way):
    runs = logs(4)
    kept = trim_warmup(second_rows(spark, runs), ["run"])
    wanted = []
    for name, (times, values) in runs.items():
        since = times - times.min()
        late = since > 0.10 * since.max()
        wanted += [(name, float(t), float(x)) for t, x in zip(since[late], values[late])]
    assert tuples(kept, "run", "since_start", "latency") == sorted(wanted, key=repr)
    assert not any(name == "one" for name, _, _ in wanted)  # 0 > 0 is false


def test_points_are_in_time_order(spark):
    runs = logs(5)
    points = latency_points(relative_time(second_rows(spark, runs), ["run"]), ["run"]).collect()
    assert [tuple(p) for p in points] == sorted(
        (name, float(t - times.min()), float(x))
        for name, (times, values) in runs.items()
        for t, x in zip(times, values)
    )


@pytest.mark.parametrize("bins", [100, 7])
def test_histogram(spark, join_way, bins):
    runs = logs(6)
    found = {}
    for row in latency_histogram(second_rows(spark, runs), ["run"], bins).collect():
        found.setdefault(row.run, {})[row.bin] = row
    for name, (_, values) in runs.items():
        rows = [found[name][b] for b in range(1, bins + 1)]
        assert sum(r.frequency for r in rows) == len(values)
        wanted, edges = np.histogram(values, bins)
        assert [r.bin_start for r in rows] == pytest.approx(list(edges[:-1]))
        # A value on an edge may round to either side of it.
        assert sum(abs(r.frequency - w) for r, w in zip(rows, wanted)) <= 0.04 * len(values)
        if name != "b":
            assert [r.frequency for r in rows] == list(wanted)


def test_latency_may_be_negative(spark):
    partial = spark.createDataFrame(
        [("CA", 1, 2, 2_000_000, 1_500_000)],
        "state string, Dvotes bigint, Rvotes bigint, event_us bigint, time_us bigint",
    )
    rows = in_seconds(latency_rows(partial))
    assert tuples(rows, "state", "time", "latency") == [("CA", 1.5, -0.5)]


def test_logs_of_runs(spark, tmp_path):
    runs = logs(7)
    for (nodes, rate), name in {(1, 11000): "a", (2, 9000): "b", (2, 30000): "same"}.items():
        log = second_rows(spark, {name: runs[name]})
        export_latencies(log, run_path(str(tmp_path), nodes, rate))
    (tmp_path / "2nodes" / "notes.txt").write_text("time,latency\n1,1\n")
    read = read_latencies(spark, f"{tmp_path}/*nodes/*.res")
    summary = by_run(latency_summary(read, ["nodes", "rate"])).collect()
    assert [(r.nodes, r.rate, r.samples) for r in summary] == [
        (1, 11000, 257), (2, 30000, 3), (2, 9000, 100)]
    a = runs["a"][1]
    assert summary[0].p99 == np.quantile(a, 0.99)


def test_one_log_file(spark, tmp_path):
    log = tmp_path / "1nodes" / "500_1node.res"
    log.parent.mkdir()
    log.write_text("time,latency\n1.608029980358e+09,0.027497053146362305\n1.60803e9,-0.002\n")
    read = read_latencies(spark, str(log))
    assert tuples(read, "nodes", "rate", "time", "latency") == [
        (1, 500, 1608029980.358, 0.027497053146362305), (1, 500, 1608030000.0, -0.002)]
    elsewhere = tmp_path / "log.csv"
    elsewhere.write_text("time,latency\n1,2\n")
    no_run = read_latencies(spark, str(elsewhere))
    assert tuples(no_run, "nodes", "rate") == [(None, None)]
    # Rows of no known run are still summarised together.
    assert latency_summary(no_run, ["nodes", "rate"]).first().samples == 1


def test_quantile_names():
    assert [latency_module.quantile_name(p) for p in (0.9, 0.99, 0.999)] == ["p90", "p99", "p99_9"]
