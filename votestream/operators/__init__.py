"""Operators: functions from DataFrames to DataFrames."""

from .auditing import ingest_audit, missing_ranges, votes_by_stream_and_state
from .counting import count_votes, merge_partials, national_totals, seed_totals
from .dedup import dedup_stream, dedup_votes
from .flushing import carry_flushes, flush_partials
from .joining import attach, materialise, ordered
from .latency import (
    by_run,
    in_micros,
    in_seconds,
    latency_histogram,
    latency_points,
    latency_rows,
    latency_summary,
    relative_time,
    trim_warmup,
)
from .quantiles import exact_quantiles
from .reporting import map_table, winners
from .validity import classified_votes, rejected_votes, split_valid, valid_votes

__all__ = [
    "attach",
    "by_run",
    "carry_flushes",
    "classified_votes",
    "count_votes",
    "dedup_stream",
    "dedup_votes",
    "exact_quantiles",
    "flush_partials",
    "in_micros",
    "in_seconds",
    "ingest_audit",
    "latency_histogram",
    "latency_points",
    "latency_rows",
    "latency_summary",
    "map_table",
    "materialise",
    "merge_partials",
    "missing_ranges",
    "national_totals",
    "ordered",
    "rejected_votes",
    "relative_time",
    "seed_totals",
    "split_valid",
    "trim_warmup",
    "valid_votes",
    "votes_by_stream_and_state",
    "winners",
]
