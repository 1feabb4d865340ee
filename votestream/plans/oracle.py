"""Each query as SQL over the same tables, for an engine to check it against."""

from ..schema import (HISTOGRAM_BINS, MICROS, PARTY_COLOURS, QUANTILES, STATES, TICK_SECONDS,
                      WARMUP_FRACTION, flush_cap, row_budget)
from ..sources.tables import CODES, FIRST_STREAM
from .queries import (CAP, DAY_US, FEW_STEPS, NO_ID, NODES, RATE, RUNS, STEPS, WIDE_CAP)


def _list(codes) -> str:
    return "[" + ", ".join(f"'{code}'" for code in codes) + "]"


VOTES = f"""
votes as (
  select concat(cast({FIRST_STREAM} + event_id % 2 as varchar), '-',
                cast(event_id // 2 as varchar)) as id,
         {FIRST_STREAM} + event_id % 2 as stream,
         ({_list(CODES)})[user_id % {len(CODES)} + 1] as state,
         case when event_type in ('click', 'purchase') then 'D'
              when event_type = 'error' then 'I' else 'R' end as party,
         epoch_us(ts) as event_us,
         epoch_us(ts) + cast(round(value * 1000) as bigint) as arrival_us
  from events),
states as (select unnest({_list(STATES)}) as state),
valid as (select * from votes where state in (select state from states))"""

TOTALS = f"""{VOTES},
counted as (
  select state,
         cast(sum(case when party = 'D' then 1 else 0 end) as bigint) as Dvotes,
         cast(sum(case when party <> 'D' then 1 else 0 end) as bigint) as Rvotes,
         max(event_us) as event_us
  from valid group by state),
totals as (
  select s.state, coalesce(c.Dvotes, 0) as Dvotes, coalesce(c.Rvotes, 0) as Rvotes
  from states s left join counted c on s.state = c.state),
won as (
  select state, Dvotes, Rvotes,
         case when Rvotes > Dvotes then 'Republican' else 'Democrat' end as winner
  from totals)"""

def _flushes(tick: int, cap: int) -> str:
    return f"""{VOTES},
numbered as (
  select stream, state, arrival_us // {tick} as tick, party, event_us, arrival_us,
         (row_number() over (partition by stream, state, arrival_us // {tick}
                             order by arrival_us, event_us, party = 'D') - 1)
           // {cap + 1} as batch
  from valid),
partials as (
  select stream, state, tick, batch,
         cast(sum(case when party = 'D' then 1 else 0 end) as bigint) as Dvotes,
         cast(sum(case when party <> 'D' then 1 else 0 end) as bigint) as Rvotes,
         max(event_us) as event_us,
         case when count(*) = {cap + 1} then max(arrival_us)
              else (tick + 1) * {tick} end as time_us,
         count(*) = {cap + 1} as "full"
  from numbered group by stream, state, tick, batch),
lat as (
  select stream, state, tick, batch, time_us, time_us - event_us as latency_us
  from partials),
timed as (
  select *, time_us - min(time_us) over (partition by stream) as since_start,
         max(time_us) over (partition by stream)
           - min(time_us) over (partition by stream) as duration
  from lat),
trimmed as (
  select * from timed where since_start > cast({WARMUP_FRACTION} as double) * duration)"""


FLUSHES = _flushes(DAY_US, CAP)
DEFAULT_FLUSHES = _flushes(TICK_SECONDS * MICROS, flush_cap(RATE, NODES))


def _seconds(expression: str) -> str:
    return f"cast({expression} as double) / cast(1000000 as double)"


def _quantile(p: float) -> str:
    # Written out: built-in quantiles of two engines may round differently.
    position = f"cast(max(samples) - 1 as double) * cast({p} as double)"
    below = f"max(case when place = floor(cast(samples - 1 as double) * cast({p} as double)) then x end)"
    above = f"max(case when place = ceil(cast(samples - 1 as double) * cast({p} as double)) then x end)"
    part = f"({position} - floor({position}))"
    return f"""case when {part} < 0.5 then {below} + ({above} - {below}) * {part}
            else {above} - ({above} - {below}) * (cast(1 as double) - {part}) end
       / cast(1000000 as double) as p{p * 100:g}"""


def _summary(rows: str, key: str = "stream") -> str:
    quantiles = ",\n       ".join(map(_quantile, QUANTILES))
    return f""",
placed as (
  select {key}, latency_us, cast(latency_us as double) as x,
         row_number() over (partition by {key} order by latency_us) - 1 as place,
         count(*) over (partition by {key}) as samples
  from {rows})
select {key}, count(*) as samples,
       cast(sum(latency_us) as double) / count(*) / cast(1000000 as double) as avg_latency,
       {_seconds('min(latency_us)')} as min_latency,
       {_seconds('max(latency_us)')} as max_latency,
       {quantiles}
from placed group by {key}"""


_COLOURS = " ".join(
    f"when winner = '{party}' then '{colour}'" for party, colour in PARTY_COLOURS.items()
)
_FULL_TOTALS = f"with {TOTALS} select state, Dvotes, Rvotes from totals"
_WINNERS = f"with {TOTALS} select state, Dvotes, Rvotes, winner from won"

_AUDIT_COUNTS = """
       count(*) as votes,
       cast(sum(case when party = 'D' then 1 else 0 end) as bigint) as Dvotes,
       cast(sum(case when party <> 'D' then 1 else 0 end) as bigint) as Rvotes"""

ORACLE_SQL = {
    "state_totals": f"""with {TOTALS}
select state, Dvotes, Rvotes, {_seconds('event_us')} as time from counted""",
    "state_totals_full": _FULL_TOTALS,
    "winners": _WINNERS,
    "national_totals": f"""with {TOTALS}
select cast(sum(Dvotes) as bigint) as Democrat, cast(sum(Rvotes) as bigint) as Republican,
       cast(sum(Dvotes + Rvotes) as bigint) as Total
from totals""",
    "map_table": f"""with {TOTALS}
select state, winner, Rvotes, Dvotes, case {_COLOURS} end as colour from won""",
    "valid_votes": f"""with {VOTES}
select id, stream, state, party, event_us, arrival_us from valid""",
    "rejects": f"""with {VOTES}
select id, stream, state, party, event_us, arrival_us, 'unknown_state' as reason
from votes where state not in (select state from states)""",
    "json_roundtrip": f"with {VOTES} select id, stream, state, party, event_us from valid",
    "dedup_votes": f"""with delivered as (
  select case when epoch_us(l_shipdate) % {NO_ID} <> 0 then
           concat(cast(l_orderkey as varchar), '-', cast(l_linenumber as varchar)) end as id,
         ({_list(STATES)})[l_suppkey % {len(STATES)} + 1] as state,
         case when l_linestatus = 'F' then 'D' else 'R' end as party,
         epoch_us(l_shipdate) as event_us,
         epoch_us(l_shipdate) + cast(l_quantity * 1000 as bigint) as arrival_us
  from lineitem),
ranked as (
  select *, row_number() over (partition by id
                               order by event_us, state, party, arrival_us) as place
  from delivered)
select id, state, party, event_us, arrival_us from ranked where place = 1 or id is null""",
    "bad_times": f"""with {VOTES},
pushed as (
  select id, stream, state, party, arrival_us,
         case event_us % 3 when 0 then {1 << 62} when 1 then -{1 << 62} else event_us end as event_us
  from votes)
select id, stream, state, party, event_us, arrival_us,
       case when abs(event_us) = {1 << 62} then 'bad_time' else 'unknown_state' end as reason
from pushed where abs(event_us) = {1 << 62} or state not in (select state from states)""",
    "party_codes": """
select event_id, case when user_id % 2 = 1 then 'D' else 'R' end as party from events""",
    "ingest_audit": f"""with {VOTES},
sequenced as (select *, cast(split_part(id, '-', 2) as bigint) as sequence from votes)
select stream, {_AUDIT_COUNTS},
       min(event_us) as first_us, max(event_us) as last_us,
       max(sequence) + 1 - count(distinct sequence) as missing,
       cast(count(*) as double)
         / (cast(nullif(max(event_us) - min(event_us), 0) as double)
            / cast(1000000 as double)) as votes_per_second,
       {row_budget(RATE, NODES)} - count(*) as short_of_budget
from sequenced group by stream""",
    "ingest_states": f"""with {VOTES}
select stream, state, {_AUDIT_COUNTS} from votes group by stream, state""",
    "missing_ranges": f"""with {VOTES},
numbered as (select stream, cast(split_part(id, '-', 2) as bigint) as sequence from valid),
expected as (
  select stream, unnest(range(top + 1)) as sequence
  from (select stream, max(sequence) as top from numbered group by stream)),
gone as (
  select *, sequence - row_number() over (partition by stream order by sequence) as run
  from expected anti join numbered using (stream, sequence))
select stream, min(sequence) as first, max(sequence) as last from gone group by stream, run""",
    "partials": f"with {FLUSHES} select * from partials",
    "partials_json": f"with {FLUSHES} select * from partials",
    "partials_default": f"with {DEFAULT_FLUSHES} select * from partials",
    "merge_partials": f"""with {FLUSHES}
select state, cast(sum(Dvotes) as bigint) as Dvotes, cast(sum(Rvotes) as bigint) as Rvotes,
       max(event_us) as event_us
from partials group by state""",
    "ledger_totals": _FULL_TOTALS,
    "latency_rows": f"""with {FLUSHES}
select stream, state, tick, batch, "full", {_seconds('time_us')} as time,
       {_seconds('time_us - event_us')} as latency
from partials""",
    "latency_summary": f"with {FLUSHES} {_summary('lat')}",
    "latency_trimmed": f"""with {FLUSHES}
select stream, state, tick, batch, {_seconds('time_us')} as time,
       {_seconds('latency_us')} as latency
from trimmed""",
    "latency_trimmed_summary": f"with {FLUSHES} {_summary('trimmed')}",
    "latency_histogram": f"""with {FLUSHES},
ranges as (
  select stream, cast(min(latency_us) as double) as low,
         cast(max(latency_us) as double) as high
  from trimmed group by stream),
spans as (
  select stream, case when low = high then low - 500000 else low end as least,
         case when low = high then high + 500000 else high end as greatest
  from ranges),
bins as (
  select stream, least, greatest, cast(unnest(range(1, {HISTOGRAM_BINS + 1})) as integer) as bin
  from spans),
binned as (
  select t.stream,
         least({HISTOGRAM_BINS},
               cast(floor(cast({HISTOGRAM_BINS} as double)
                          * (cast(t.latency_us as double) - s.least)
                          / (s.greatest - s.least)) as integer) + 1) as bin
  from trimmed t join spans s on t.stream = s.stream)
select b.stream, b.bin, count(n.bin) as frequency,
       (b.least + (b.bin - 1) * ((b.greatest - b.least) / cast({HISTOGRAM_BINS} as double)))
         / cast(1000000 as double) as bin_start
from bins b left join binned n on b.stream = n.stream and b.bin = n.bin
group by b.stream, b.bin, b.least, b.greatest""",
    "latency_points": f"""with {FLUSHES}
select stream, {_seconds('since_start')} as runtime, {_seconds('latency_us')} as latency
from trimmed""",
    "csv_roundtrip": f"""with {FLUSHES}
select {NODES} as nodes, {RATE} as rate, {_seconds('time_us')} as time,
       {_seconds('latency_us')} as latency
from lat""",
    "run_summary": f"""with {FLUSHES},
logged as (
  select case stream {" ".join(f"when {s} then {n}" for s, (n, _) in RUNS.items())} end as nodes,
         case stream {" ".join(f"when {s} then {r}" for s, (_, r) in RUNS.items())} end as rate,
         latency_us
  from lat)
{_summary("logged", "nodes, rate")}""",
    "stream_totals": _FULL_TOTALS,
    "stream_latencies": f"""with {VOTES}
select stream, state, max(event_us) as event_us, true as later from valid group by stream, state""",
    "stream_rejects": f"""with {VOTES}
select id, state, event_us, arrival_us, 'unknown_state' as reason
from votes where state not in (select state from states)""",
    "stream_bounded": f"""with {VOTES},
taken as (
  select *, cast(split_part(id, '-', 2) as bigint) * 2 + stream - {FIRST_STREAM} as place,
         (select cast(ceil(count(*) / {STEPS}) as bigint) from events) as step
  from valid)
select cast(place // step as bigint) as batch_id,
       cast(sum(case when party = 'D' then 1 else 0 end) as bigint) as Dvotes,
       cast(sum(case when party <> 'D' then 1 else 0 end) as bigint) as Rvotes
from taken group by all""",
    "stream_quantiles": f"""with {VOTES},
taken as (
  select distinct stream, state, (cast(split_part(id, '-', 2) as bigint) * 2 + stream - {FIRST_STREAM})
              // (select cast(ceil(count(*) / {STEPS}) as bigint) from events) as step
  from valid)
select stream, count(*) as samples, true as figures_agree, true as p90_close, true as p95_close, true as p99_close
from taken group by stream""",
    "stream_flushes": f"""with {VOTES},
taken as (
  select *, (cast(split_part(id, '-', 2) as bigint) * 2 + stream - {FIRST_STREAM})
              // (select cast(ceil(count(*) / {FEW_STEPS}) as bigint) from events) as step
  from valid),
numbered as (
  select *, (row_number() over (partition by stream, state
                                order by step, arrival_us, event_us, party = 'D') - 1)
              // {WIDE_CAP + 1} as batch
  from taken)
select stream, state, cast(sum(case when party = 'D' then 1 else 0 end) as bigint) as Dvotes,
       cast(sum(case when party <> 'D' then 1 else 0 end) as bigint) as Rvotes,
       max(event_us) as event_us, count(*) = {WIDE_CAP + 1} as "full"
from numbered group by stream, state, batch""",
    "ledger_compacted": _FULL_TOTALS,
    "stream_dedup": _FULL_TOTALS,
    "ledger_rolled": _FULL_TOTALS,
    "stream_winners": _WINNERS,
}
