"""Cross-site boilerplate: lines that stand on many sites are kept once.

A line is known by 128 bits of hashes of its trimmed text. The sites it stands on are
counted by a HyperLogLog sketch per line; partial sketches merge on the way, so a line
found everywhere costs one sketch per task. Where the estimate is within ``MARGIN``
standard errors of the limit, sites are counted exactly. Of a boilerplate line the first
occurrence stays, by doc_id and place; all others are removed.

All of it is DataFrame operations.
"""

from functools import reduce
from math import ceil, floor

from pyspark.sql import DataFrame, functions as F

from ..operators import attach, materialise

#: A line on at least so many sites is boilerplate.
MIN_SITES = 10
#: Shorter lines are common by chance.
MIN_CHARS = 20
SKETCH_BITS = 10
MARGIN = 4.0
_KEY = ["line", "line2"]
_DOC = ["doc_id", "text_hash"]


def lines_of(documents: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per line with ``min_chars`` characters: document, site, place and hashes.

    Lines are parted by line feeds, and ASCII white space around them does not count.
    """
    at = documents.select(
        "doc_id", "source", F.xxhash64("text").alias("text_hash"),
        F.posexplode(F.split("text", "\n", -1)).alias("place", "own"),
    )
    trimmed = F.trim(F.col("own"), F.lit(" \t\r\x0b\x0c"))
    return at.withColumn("own", trimmed).where(F.length("own") >= min_chars).select(
        *_DOC, "source", "place", F.xxhash64("own").alias("line"),
        F.xxhash64(F.lit(1), "own").alias("line2"),
    )


def site_sketches(lines: DataFrame, bits: int = SKETCH_BITS) -> DataFrame:
    """Per line: a sketch of its sites and its first occurrence. NULL is no site."""
    return lines.groupBy(*_KEY).agg(
        F.hll_sketch_agg(F.xxhash64("source"), bits).alias("sites"),
        F.count("source").alias("rows"),
        F.min(F.struct(*_DOC, "place")).alias("first"),
    )


def merged_sketches(*sketches: DataFrame) -> DataFrame:
    """Sketches of several parts of a corpus as those of the whole."""
    every = reduce(DataFrame.unionByName, sketches)
    return every.groupBy(*_KEY).agg(
        F.hll_union_agg("sites").alias("sites"), F.sum("rows").alias("rows"),
        F.min("first").alias("first"),
    )


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES, bits: int = SKETCH_BITS) -> DataFrame:
    """Lines on at least ``min_sites`` sites, with their first occurrence."""
    error = MARGIN * 1.04 / 2 ** (bits / 2)
    low, high = floor(min_sites * (1 - error)), ceil(min_sites * (1 + error))
    known = lines.where("source is not null")
    sketched = site_sketches(known, bits).where(F.col("rows") >= min_sites)
    spread = F.hll_sketch_estimate("sites")
    likely = materialise(
        sketched.select(*_KEY, "first", spread.alias("estimate")).where(F.col("estimate") >= low)
    )
    near = likely.where(F.col("estimate") <= high).select(*_KEY)
    counted = attach(known.select(*_KEY, "source"), near, _KEY).groupBy(*_KEY).agg(
        F.count_distinct("source").alias("exact")
    )
    sure = likely.where(F.col("estimate") > high).select(*_KEY, "first")
    exact = likely.join(counted.where(F.col("exact") >= min_sites).select(*_KEY), _KEY)
    return materialise(sure.unionByName(exact.select(*_KEY, "first")))


def without_boilerplate(
    documents: DataFrame, min_sites: int = MIN_SITES, min_chars: int = MIN_CHARS
) -> DataFrame:
    """``documents`` without repeated boilerplate lines, plus ``n_lines`` and ``n_removed``.

    A text without such lines stays as it is; a NULL or empty one has no lines. A row
    without a source, or with a NULL source, adds no site, but its lines are removed like
    others. Rows equal in doc_id and text are one occurrence and are treated alike.
    ``text`` is replaced, columns named ``n_lines`` or ``n_removed`` too, others pass through.
    """
    columns = [c for c in documents.columns if c not in ("n_lines", "n_removed")]
    lines = lines_of(documents.select("doc_id", "source", "text"), min_chars)
    repeated = attach(lines.drop("source"), boilerplate(lines, min_sites), _KEY).where(
        ~F.struct(*_DOC, "place").eqNullSafe(F.col("first"))
    )
    drop = repeated.groupBy(*_DOC).agg(F.collect_set("place").alias("_drop")).select(
        F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash"), "_drop"
    )
    hashed = documents.select(*[f"`{c}`" for c in columns], F.xxhash64("text").alias("_text_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_text_hash") == F.col("_hash"))
    joined = hashed.join(drop, same, "left")
    own = F.split("text", "\n", -1)
    places = F.array_except(F.sequence(F.lit(0), F.size(own) - 1), F.col("_drop"))
    rest = F.array_join(F.transform(places, lambda i: F.get(F.col("_lines"), i)), "\n")
    filled = F.coalesce(F.col("text"), F.lit("")) != ""
    return (
        joined.withColumn("_lines", F.when(F.col("_drop").isNotNull(), own))
        .withColumn("n_lines", F.when(filled, F.size(own)).otherwise(0).cast("bigint"))
        .withColumn("n_removed", F.coalesce(F.size("_drop"), F.lit(0)).cast("bigint"))
        .withColumn("n_removed", F.greatest("n_removed", F.lit(0).cast("bigint")))
        .withColumn("text", F.when(F.col("_drop").isNotNull(), rest).otherwise(F.col("text")))
        .select(*[f"`{c}`" for c in columns], "n_lines", "n_removed")
    )
