"""Joining a small table of per-key facts onto many rows, without trusting its size."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from ..session import shared_dir

# A keyed fact is a handful of numbers, so this many stay around ten megabytes.
BROADCAST_ROWS = 100_000
# A key with more rows than this is joined in several tasks.
HOT_ROWS = 1_000_000
# At most about this many keys are, so that they can be broadcast.
HOT_KEYS = 10_000

_SALT, _SALTS, _SIZE = "_salt", "_salts", "_size"
_NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType)


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there.

    The copy outlives any executor, and what is built on it is not recomputed.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint()


def attach(
    rows: DataFrame,
    facts: DataFrame,
    keys: list[str],
    broadcast_rows: int = BROADCAST_ROWS,
    count: int | None = None,
    sizes: str | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Inner join of ``rows`` with one row of ``facts`` per key; NULL keys match.

    The rows of ``facts`` are counted first unless their ``count`` is known, so
    they should be materialised. They are broadcast when there are at most
    ``broadcast_rows``. Beyond that both sides are shuffled. Keys of more than ``hot_rows``
    rows are spread over salts, as many as their size asks for, and only their facts are
    copied. ``sizes`` names the column of ``facts``, not returned, that has the number of rows of a
    key; without it they are counted, which reads ``rows`` once more.
    """
    if count is None:
        count = facts.limit(broadcast_rows + 1).count()
    return _join(rows, facts, keys, count <= broadcast_rows, "inner", sizes, hot_rows)


def leave_out(
    rows: DataFrame,
    facts: DataFrame,
    keys: list[str],
    broadcast_rows: int = BROADCAST_ROWS,
    sizes: str | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``rows`` whose key is not among ``facts``, joined the way ``attach`` does."""
    few = facts.limit(broadcast_rows + 1).count() <= broadcast_rows
    needed = facts.select(*keys, *([sizes] if sizes else []))
    return _join(rows, needed, keys, few, "left_anti", sizes, hot_rows)


def _same(keys):
    return reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys))


def _join(rows, facts, keys, few, how, sizes, hot_rows):
    kept = own = rows.columns
    if how == "inner":
        kept = own + [c for c in facts.columns if c not in keys and c != sizes]
    hot = None if few else _hot_keys(rows, facts, keys, sizes, hot_rows)
    facts = facts.drop(sizes) if sizes else facts
    same = _same(keys)
    if hot is not None:
        # Equal rows of one partition stay together, so that a task that is run again deals them alike.
        plain = [f.name for f in rows.schema if not isinstance(f.dataType, _NESTED)]
        dealt = F.pmod(F.xxhash64(F.spark_partition_id(), *plain), F.col(_SALTS))
        rows = rows.join(hot, same, "left").withColumn(_SALT, F.coalesce(dealt, F.lit(0).cast("bigint")))
        rows = rows.select(*own, _SALT)
        last = F.coalesce(F.col(_SALTS), F.lit(1).cast("bigint")) - 1
        copies = F.explode(F.sequence(F.lit(0).cast("bigint"), last))
        facts = facts.join(hot, same, "left").withColumn(f"_{_SALT}", copies).drop(*hot.columns)
        same = same & (F.col(_SALT) == F.col(f"_{_SALT}"))
    facts = facts.withColumnsRenamed({k: f"_{k}" for k in keys})
    return rows.join(F.broadcast(facts) if few else facts, same, how).select(*kept)


def _hot_keys(rows, facts, keys, sizes, hot_rows):
    """Keys with more than ``hot_rows`` rows, each with its number of salts; None if there are none.

    Where over ``HOT_KEYS`` keys are that large, only those are hot that hold more than that part
    of their rows, so there are never more of them.
    """
    if sizes is None:
        sized = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(_SIZE))
    else:
        sized = facts.select(*keys, F.col(sizes).alias(_SIZE))
    large = materialise(sized.where(F.col(_SIZE) > hot_rows))
    total = large.agg(F.sum(_SIZE)).first()[0]
    if not total:
        return None
    share = max(hot_rows, total // HOT_KEYS, 1)
    salts = F.ceil(F.col(_SIZE) / F.lit(share)).cast("bigint").alias(_SALTS)
    hot = large.where(F.col(_SIZE) > share).select(*[F.col(k).alias(f"_{k}") for k in keys], salts)
    return F.broadcast(hot)


def ordered(df: DataFrame, *columns) -> DataFrame:
    """``df`` sorted by ``columns``, also where one value fills many partitions.

    Rows equal in ``columns`` are told apart by the partition they come from, so
    that the range partitioning can split them.
    """
    origin = "_origin"
    tagged = df.withColumn(origin, F.spark_partition_id())
    return tagged.orderBy(*columns, origin).drop(origin)
