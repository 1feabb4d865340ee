"""Connected components of a graph given as a table of edges."""

from pyspark.sql import DataFrame, functions as F

from ..operators import materialise


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, its smallest node reachable, for all nodes of ``edges``.

    ``edges`` has two bigint columns. Alternates large and small stars: every node is
    hung onto the smallest node it knows until nothing changes, which takes about the
    logarithm of the longest path. A round only joins minima by node; they are formed
    before the shuffle, so a node with very many edges is no single task's work. Loops
    and NULLs are left out, repeated edges count once, no edges give no rows.
    """
    a, b = edges.columns
    stars = edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    )
    stars = materialise(stars.distinct())
    before = _fingerprint(stars)
    while before[0]:
        stars = materialise(_small_star(_large_star(stars)))
        after = _fingerprint(stars)
        if after == before:
            break
        before = after
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.distinct()
    )


def _fingerprint(stars):
    mark = F.xxhash64("u", "v").cast("decimal(20,0)")
    return tuple(stars.agg(F.count(F.lit(1)), F.sum(mark)).first())


def _large_star(stars):
    """Hangs the larger neighbours of every node onto the smallest one."""
    both = stars.select("u", "v").unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(
        "u", F.least("u", "m").alias("m")
    )
    hung = both.join(least, "u").where(F.col("v") > F.col("u"))
    return hung.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(stars):
    """Hangs the smaller neighbours of every node, and itself, onto the smallest one."""
    least = stars.groupBy("u").agg(F.min("v").alias("m"))
    hung = stars.join(least, "u").where(F.col("v") != F.col("m"))
    return (
        hung.select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(least.select("u", F.col("m").alias("v")))
        .distinct()
    )
