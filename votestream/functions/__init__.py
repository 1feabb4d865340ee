"""Column expressions; all of them stay inside whole-stage code generation."""

from .votes import (
    colour_of,
    encode_party,
    floor_div,
    in_time,
    is_democrat,
    micros_of_seconds,
    micros_of_timestamp,
    reject_reason,
    seconds_of_micros,
    sequence_of,
    stream_of,
    vote_id,
    winner_of,
)

__all__ = [
    "colour_of",
    "encode_party",
    "floor_div",
    "in_time",
    "is_democrat",
    "micros_of_seconds",
    "micros_of_timestamp",
    "reject_reason",
    "seconds_of_micros",
    "sequence_of",
    "stream_of",
    "vote_id",
    "winner_of",
]
