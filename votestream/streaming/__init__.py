"""Structured Streaming jobs and the outputs they keep."""

from .jobs import start_counting, start_reporting
from .ledger import (
    compact_latencies,
    compact_ledger,
    compact_sketches,
    last_committed,
    live_summary,
    read_held,
    read_latency_log,
    read_ledger,
    read_report,
    read_sketches,
    read_totals,
    roll_up,
    write_latencies,
    write_partials,
    write_rejects,
    write_report,
    write_sketches,
)

__all__ = [
    "compact_latencies",
    "compact_ledger",
    "compact_sketches",
    "last_committed",
    "live_summary",
    "read_held",
    "read_latency_log",
    "read_ledger",
    "read_report",
    "read_sketches",
    "read_totals",
    "roll_up",
    "start_counting",
    "start_reporting",
    "write_latencies",
    "write_partials",
    "write_rejects",
    "write_report",
    "write_sketches",
]
