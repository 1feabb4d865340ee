"""Where rows come from and go to: votes, the state list, latency logs."""

from .backlog import read_bounded
from .latencies import export_latencies, read_latencies
from .states import read_states, states_df
from .tables import (
    bounded_stream_view,
    party_flags_view,
    repeated_votes_view,
    vote_stream_view,
    votes_view,
)
from .votes import (
    encode_votes,
    merge_streams,
    parse_votes,
    read_vote_stream,
    read_votes,
    write_votes,
)

__all__ = [
    "bounded_stream_view",
    "encode_votes",
    "export_latencies",
    "merge_streams",
    "parse_votes",
    "party_flags_view",
    "read_bounded",
    "read_latencies",
    "read_states",
    "read_vote_stream",
    "read_votes",
    "repeated_votes_view",
    "states_df",
    "vote_stream_view",
    "votes_view",
    "write_votes",
]
