"""Count-or-tick flushes: the partial counts a running counter would have sent on.

A counter of a (stream, state) sends its count when a tick ends, and before that
whenever it holds ``cap + 1`` votes. Replayed over stored votes, that is: order
the votes of each (stream, state, tick) by arrival and cut them into runs of
``cap + 1``.

Votes that arrive in the same microsecond are taken in order of event time, then
party. Votes equal in these three cannot be told apart in any result, so the vote
id is not needed and never leaves the scan.

Numbering the votes of a whole group needs them in one task, which no group of
unknown size may have. So a group is numbered by counting instead. Its votes
are counted in consecutive pieces, and the counts before a piece give the
position it begins at. A piece that lies inside one flush is finished with just
its counts. Only pieces that a flush boundary cuts through are looked into: sorted
if they are small, else divided into finer pieces. Each division is into a number
of pieces bounded by the clock, not by the data:

    group > time slices > microseconds of arrival > event slices > equal votes

With a cap no group reaches, which is how the default settings work out, nothing
is ever cut and a single aggregation answers the query.
"""

from functools import reduce
from math import isqrt

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import floor_div, is_democrat
from ..schema import MICROS, TICK_SECONDS
from .joining import BROADCAST_ROWS, attach, leave_out, materialise

GROUP = ["stream", "state", "tick"]
ARRIVAL_ORDER = ["arrival_us", "event_us", "democrat"]

# A cut piece with at most this many votes is sorted in one task.
SORT_ROWS = 2_000_000
# Event slices are this wide, so that one holds a bounded number of distinct votes.
EVENT_SLICE_US = 1 << 26
# Time slices are the square root of the tick, so that a tick has about as many
# slices as a slice has microseconds; beyond a day they get no wider.
LONGEST_TICK_US = 86_400 * MICROS
# Flushes filled by one set of equal votes are listed in blocks of this many.
BLOCK = 10_000


def flush_partials(
    votes: DataFrame,
    tick_us: int = TICK_SECONDS * MICROS,
    cap: int | None = None,
    sort_rows: int = SORT_ROWS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Partial counts of each flush, one row per (stream, state, tick, batch).

    ``votes`` must be valid, and need ``stream``, ``state``, ``party``, ``event_us``
    and ``arrival_us``. Without a ``cap`` only ticks flush. ``time_us`` is when the
    flush happens: at its last vote if that filled it, else at the end of the tick.
    """
    arrived = votes.select(
        "stream",
        "state",
        floor_div("arrival_us", tick_us).alias("tick"),
        "arrival_us",
        "event_us",
        is_democrat("party").alias("democrat"),
    )
    if cap is None:
        groups = _count(arrived.groupBy(*GROUP)).withColumn("batch", F.lit(0).cast("bigint"))
        return _flush_rows(groups, tick_us, None)

    size = cap + 1
    groups = _cut_by_count(_count(arrived.groupBy(*GROUP)), F.lit(0).cast("bigint"), size)
    finished, pieces = _cut(arrived, groups, size, tick_us, sort_rows, broadcast_rows)
    if pieces:
        finished = finished.unionByName(
            _add_up(reduce(DataFrame.unionByName, pieces), GROUP + ["batch"])
        )
    return _flush_rows(finished, tick_us, size)


HELD = ["stream", "state", "votes", "Dvotes", "Rvotes", "event_us"]


def carry_flushes(
    votes: DataFrame,
    held: DataFrame,
    cap: int,
    sort_rows: int = SORT_ROWS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """Counts that reach the cap with these votes, and what the counters hold after them.

    ``held`` has a row (``HELD``) for each counter, that is (stream, state), that holds votes: at
    most ``cap`` of them, which came before ``votes``. A counter goes on from there, in order of arrival. The
    flushed counts have ``cap + 1`` votes each and the columns of ``HELD``. There is one row of ``held`` for a
    counter at most, so only counts are joined to it and never votes.
    """
    size = cap + 1
    arrived = votes.select(
        "stream", "state", F.lit(0).cast("bigint").alias("tick"), "arrival_us", "event_us",
        is_democrat("party").alias("democrat"),
    )
    before = held.select(F.col("stream").alias("_stream"), F.col("state").alias("_state"), F.col("votes").alias("before"))
    same = F.col("stream").eqNullSafe(F.col("_stream")) & F.col("state").eqNullSafe(F.col("_state"))
    counted = _count(arrived.groupBy(*GROUP)).join(before, same, "left").drop("_stream", "_state")
    groups = _cut_by_count(counted, F.coalesce("before", F.lit(0)), size, "before")
    finished, pieces = _cut(arrived, groups, size, 1 << 62, sort_rows, broadcast_rows, carried=True)
    carried = held.select(
        "stream", "state", F.lit(0).cast("bigint").alias("tick"), F.lit(0).cast("bigint").alias("batch"),
        "votes", "Dvotes", "Rvotes", F.col("event_us").alias("newest_us"),
        F.lit(None).cast("bigint").alias("arrived_us"),
    )
    every = _add_up(reduce(DataFrame.unionByName, [finished, carried, *pieces]), GROUP + ["batch"])
    every = materialise(every.select("stream", "state", "votes", "Dvotes", "Rvotes", F.col("newest_us").alias("event_us")))
    return every.where(F.col("votes") == size), every.where(F.col("votes") < size)


def _cut(arrived, groups, size, tick_us, sort_rows, broadcast_rows, carried=False):
    """Flushes found complete, and pieces of flushes still to be added up.

    ``groups`` are counted, and say at which position of a flush each begins: 0, unless counts are
    ``carried`` over.
    """
    width = isqrt(min(tick_us, LONGEST_TICK_US)) + 1
    whole = groups.where("not cut").select(*_PIECE)
    small, large = _cut_sizes(groups, sort_rows)
    if small > broadcast_rows:
        # Most groups are cut: sort all that can be, without looking up which.
        huge = groups.where(F.col("votes") > sort_rows)
        whole = huge.where("not cut").select(*_PIECE)
        sortable = leave_out(arrived, huge, GROUP, broadcast_rows, "votes")
        if carried:
            facts = groups.where(F.col("votes") <= sort_rows).select(*GROUP, "start", "votes")
            sortable = attach(sortable, facts, GROUP, broadcast_rows, sizes="votes")
        else:
            sortable = sortable.withColumn("start", F.lit(0).cast("bigint"))
        whole = whole.unionByName(_sort_and_cut(sortable, GROUP, size))
    elif small:
        facts = groups.where(F.col("cut") & (F.col("votes") <= sort_rows)).select(*GROUP, "start", "votes")
        sortable = attach(arrived, facts, GROUP, broadcast_rows, small, "votes")
        whole = whole.unionByName(_sort_and_cut(sortable, GROUP, size))

    pieces, keys, nodes = [], GROUP, groups
    remaining = arrived.withColumn("slice", floor_div("arrival_us", width)).withColumn(
        "event_slice", floor_div("event_us", EVENT_SLICE_US)
    )
    for division in (["slice"], ["arrival_us"], ["event_slice"], ["event_us", "democrat"]):
        if not large:
            return whole, pieces
        facts = nodes.where(F.col("cut") & (F.col("votes") > sort_rows)).select(*keys, "start", "votes")
        remaining = attach(remaining, facts, keys, broadcast_rows, large, "votes")
        before = (
            Window.partitionBy(*keys)
            .orderBy(*division)
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        start = F.col("start") + F.coalesce(F.sum("votes").over(before), F.lit(0))
        keys = keys + division
        nodes = _cut_by_count(_count(remaining.groupBy(*keys, "start")), start, size)
        remaining = remaining.drop("start")
        pieces.append(nodes.where("not cut").select(*_PIECE))
        if "democrat" in division:
            break
        small, large = _cut_sizes(nodes, sort_rows)
        if small:
            facts = nodes.where(F.col("cut") & (F.col("votes") <= sort_rows)).select(*keys, "start", "votes")
            sortable = attach(remaining, facts, keys, broadcast_rows, small, "votes")
            pieces.append(_sort_and_cut(sortable, keys, size))
    pieces.append(_spread_equal_votes(nodes.where("cut"), size))
    return whole, pieces


def _cut_by_count(counted, start, size, *spare):
    """Counts per piece, where it starts, and whether a flush boundary cuts it."""
    return materialise(
        counted.withColumn("start", start)
        .drop(*spare)
        .withColumn("batch", _div("start", size))
        .withColumn("last_batch", _div(F.col("start") + F.col("votes") - 1, size))
        .withColumn("cut", F.col("batch") < F.col("last_batch"))
    )


def _cut_sizes(pieces, sort_rows):
    """How many cut pieces can be sorted, and how many are too large for that."""
    sortable = F.col("votes") <= sort_rows
    found = pieces.where("cut").agg(F.count_if(sortable), F.count_if(~sortable)).first()
    return found[0], found[1]


_PIECE = GROUP + ["batch"] + ["votes", "Dvotes", "Rvotes", "newest_us", "arrived_us"]


def _div(column, step):
    return F.call_function("div", F.col(column) if isinstance(column, str) else column, F.lit(step))


def _count(grouped):
    return grouped.agg(
        F.count(F.lit(1)).alias("votes"),
        F.count_if("democrat").alias("Dvotes"),
        F.count_if(~F.col("democrat")).alias("Rvotes"),
        F.max("event_us").alias("newest_us"),
        F.max("arrival_us").alias("arrived_us"),
    )


def _add_up(pieces, keys):
    return pieces.groupBy(*keys).agg(
        F.sum("votes").alias("votes"),
        F.sum("Dvotes").alias("Dvotes"),
        F.sum("Rvotes").alias("Rvotes"),
        F.max("newest_us").alias("newest_us"),
        F.max("arrived_us").alias("arrived_us"),
    )


def _sort_and_cut(votes, keys, size):
    """Cut pieces small enough to be sorted: number their votes one by one."""
    in_order = Window.partitionBy(*keys).orderBy(*ARRIVAL_ORDER)
    position = F.col("start") + F.row_number().over(in_order) - 1
    numbered = votes.withColumn("batch", _div(position, size))
    return _count(numbered.groupBy(*GROUP, "batch"))


def _spread_equal_votes(cut, size):
    """Votes equal in all that counts, over the flushes they fill.

    One such set may fill very many flushes, so they are listed block by block
    and the blocks dealt out to tasks before each is listed in full.
    """
    first, last = F.col("batch"), F.col("last_batch")
    blocks = cut.withColumn("block", F.explode(F.sequence(_div(first, BLOCK), _div(last, BLOCK))))
    dealt = blocks.repartition(*GROUP, "start", "block")
    flush = F.explode(
        F.sequence(
            F.greatest(first, F.col("block") * BLOCK),
            F.least(last, F.col("block") * BLOCK + (BLOCK - 1)),
        )
    )
    end = F.col("start") + F.col("votes")
    share = F.least(end, (F.col("flush") + 1) * size) - F.greatest(
        F.col("start"), F.col("flush") * size
    )
    return (
        dealt.withColumn("flush", flush)
        .withColumn("share", share)
        .select(
            *GROUP,
            F.col("flush").alias("batch"),
            F.col("share").alias("votes"),
            F.when(F.col("democrat"), F.col("share")).otherwise(0).alias("Dvotes"),
            F.when(F.col("democrat"), 0).otherwise(F.col("share")).alias("Rvotes"),
            "newest_us",
            "arrived_us",
        )
    )


def _flush_rows(flushes, tick_us, size):
    tick_end = (F.col("tick") + 1) * tick_us
    full = F.lit(False) if size is None else F.col("votes") == size
    return flushes.select(
        *GROUP,
        "batch",
        "Dvotes",
        "Rvotes",
        F.col("newest_us").alias("event_us"),
        F.when(full, F.col("arrived_us")).otherwise(tick_end).alias("time_us"),
        full.alias("full"),
    )
