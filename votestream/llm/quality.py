r"""Quality rules: robust multivariate outliers of a document's statistics.

Statistics of a text (its words are ``[^\x20\x09-\x0D]+``) are turned into a vector of
``VECTOR`` with a roughly even spread. For every language and source the location and the
covariance of the central ``SHARE`` of vectors are estimated: the minimum covariance
determinant, by concentration steps from a start of medians and median deviations. Each step
keeps the share with the smallest distances and estimates anew from it, which never
makes the determinant larger but by rounding of the share. A group takes steps as long as they lower the logarithm of its
determinant by ``SETTLED``; since the floors below bound it, that ends. The fit with the smallest determinant counts.
A vector is rejected if its squared Mahalanobis distance exceeds ``LIMIT``, which a normal
vector does with a chance of ``CHANCE``.

Most documents have no symbols or repeated lines at all. So each variance has a floor
(``FLOORS``) added to it: a deviation of a few floors is of no consequence, however little
the other documents vary. Groups of under ``LEAST_GROUP`` documents are judged with the rest
of their language that is in such groups, and those of small languages together. If still
fewer are left, nothing is rejected.

All of it is column expressions; a group's figures are sums and sketches that are formed
before any shuffle.
"""

from math import exp

from pyspark.sql import Column, DataFrame, functions as F

from ..operators import attach, materialise
from ..session import scratch_path

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
SHARE = 0.75
SETTLED = 0.01
CHANCE = 4e-5
LEAST_GROUP = 100

#: Names of the vector's parts and the standard deviation that is added to each.
FLOORS = {
    "word_length": 0.08,  # logarithm of the mean
    "symbols": 0.3,  # logarithm of 1 + symbols in 100 characters
    "repeats": 0.12,  # share of repeated words
    "lines": 0.15,  # share of repeated lines
    "capitals": 0.06,  # share of upper-case letters
    "marks": 0.3,  # logarithm of 1 + marks in 10 words
}
VECTOR = list(FLOORS)
STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _beyond(x: float, dimensions: int) -> float:
    """The chance that a chi-square value of an even number of dimensions exceeds ``x``."""
    term = total = exp(-x / 2)
    for k in range(1, dimensions // 2):
        term *= x / (2 * k)
        total += term
    return total


def _quantile(chance: float, dimensions: int) -> float:
    """The value that is exceeded with ``chance``."""
    low, high = 0.0, 1000.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if _beyond(middle, dimensions) > chance else (low, middle)
    return high


LIMIT = _quantile(CHANCE, len(VECTOR))
# The mean squared distance within the central share of normal vectors is smaller than over all of them
# by this factor.
_CONSISTENCY = SHARE / (1 - _beyond(_quantile(1 - SHARE, len(VECTOR)), len(VECTOR) + 2))

_SPACE = r"[ \t\n\x0B\f\r]+"
_GROUP = ["judged_lang", "judged_source"]


def with_statistics(documents: DataFrame) -> DataFrame:
    """``documents`` with the statistics, ``base_failed`` and the vector of every text.

    A NULL text is empty and has no words. Two 3-word windows are taken as equal if their
    64-bit hashes are, which within a text is as good as certain.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.withColumn("_words", F.array_remove(F.split(text, _SPACE), ""))
    n = F.size("_words")
    windows = F.transform(
        F.sequence(F.lit(0), n - 3),
        lambda i: F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)),
    )
    none = F.array().cast("array<bigint>")
    rows = rows.withColumn("_windows", F.when(n >= 3, windows).otherwise(none))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.rlike(x, F.lit(r"[^ \t\n\x0B\f\r]")))
    rows = rows.withColumn("_lines", lines)
    repeated = F.size(F.array_distinct("_windows")) < F.size("_windows")
    rows = rows.withColumn("_repeated", repeated)
    # Equal windows side by side, with their places; only for texts that have any.
    placed = F.sort_array(F.transform("_windows", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    rows = rows.withColumn("_placed", F.when(F.col("_repeated"), placed))
    again = F.filter("_placed", lambda p, k: _same(p, k - 1) | _same(p, k + 1))
    rows = rows.withColumn("_again", F.sort_array(F.transform(again, lambda p: p["i"])))
    covered = F.aggregate(
        "_again",
        F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
        lambda done, i: F.struct(
            i.alias("last"), (done["n"] + F.least(F.lit(3), i - done["last"])).alias("n")
        ),
    )["n"]
    rows = rows.withColumns({
        "n_words": n.cast("bigint"),
        "word_chars": F.length(F.array_join("_words", "")).cast("bigint"),
        "n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("bigint"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
        "n_repeat_words": F.when(F.col("_repeated"), covered).otherwise(0).cast("bigint"),
        "_n_lines": F.size("_lines"),
        "_capitals": F.regexp_count(text, F.lit(r"\p{Lu}")),
        "_marks": F.regexp_count(text, F.lit(r"[!?]")),
    })
    words, chars = (F.greatest(F.col(c), F.lit(1)).cast("double") for c in ("n_words", "word_chars"))
    vector = {
        "word_length": F.log(F.greatest("word_chars", F.lit(1)) / words),
        "symbols": F.log1p(100 * F.col("n_symbols") / chars),
        "repeats": F.col("n_repeat_words") / words,
        "lines": F.col("n_dup_lines") / F.greatest("_n_lines", F.lit(1)),
        "capitals": F.col("_capitals") / chars,
        "marks": F.log1p(10 * F.col("_marks") / words),
    }
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )
    return rows.select(
        *[f"`{c}`" for c in documents.columns], *STATISTICS, failed.alias("base_failed"),
        F.struct(*[v.alias(k) for k, v in vector.items()]).alias("vector"),
    )


def _same(p: Column, k: Column) -> Column:
    """Whether the neighbour at ``k`` is an equal window."""
    return F.coalesce(F.get("_placed", k)["w"] == p["w"], F.lit(False))


def _grouped(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """``rows`` with the group they are judged in."""
    return attach(rows, sizes, ["lang", "source"])


def _groups(vectors: DataFrame) -> DataFrame:
    """Per language and source, the group to judge with: itself, the language, or all."""
    sizes = materialise(vectors.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n")))
    large = F.col("n") >= LEAST_GROUP
    small = sizes.where(~large).groupBy("lang").agg(F.sum("n").alias("in_lang"))
    in_lang = F.coalesce(F.col("in_lang") >= LEAST_GROUP, F.lit(False))
    # NULL as a language or source is a value like any other.
    key = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit("null"))
    small = small.withColumnRenamed("lang", "_lang")
    return materialise(
        sizes.join(small, F.col("lang").eqNullSafe(F.col("_lang")), "left").select(
            "lang", "source",
            F.when(large | in_lang, key("lang")).otherwise("all").alias(_GROUP[0]),
            F.when(large, key("source")).otherwise("all").alias(_GROUP[1]),
        )
    )


def _moments(rows: DataFrame) -> DataFrame:
    """Per group: the mean and the Cholesky factor of the covariance with floors."""
    d = len(VECTOR)
    x = [F.col(f"vector.{c}") for c in VECTOR]
    sums = [F.avg(x[i]).alias(f"m{i}") for i in range(d)]
    sums += [F.covar_pop(x[i], x[j]).alias(f"c{i}{j}") for i in range(d) for j in range(i + 1)]
    out = rows.groupBy(*_GROUP).agg(F.count(F.lit(1)).alias("n"), *sums)
    floors = list(FLOORS.values())
    for i in range(d):
        for j in range(i + 1):
            value = F.col(f"c{i}{j}") * _CONSISTENCY
            if i == j:
                value = value + floors[i] ** 2
            for k in range(j):
                value = value - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            # Rounding must not make a variance smaller than its floor allows.
            value = F.sqrt(F.greatest(value, F.lit(floors[i] ** 2 / 4))) if i == j else value / F.col(f"l{j}{j}")
            out = out.withColumn(f"l{i}{j}", value)
    kept = [f"m{i}" for i in range(d)] + [f"l{i}{j}" for i in range(d) for j in range(i + 1)]
    return materialise(out.select(*_GROUP, F.struct(*kept).alias("fit")))


def _spread(fit: str) -> Column:
    """The logarithm of the determinant of the covariance."""
    return 2 * sum((F.log(F.col(f"{fit}.l{i}{i}")) for i in range(1, len(VECTOR))), F.log(F.col(f"{fit}.l00")))


def _start(rows: DataFrame) -> DataFrame:
    """The first estimate: medians and median deviations, taken as independent."""
    d = len(VECTOR)
    medians = rows.groupBy(*_GROUP).agg(
        *[F.percentile_approx(f"vector.{c}", 0.5, 1000).alias(f"m{i}") for i, c in enumerate(VECTOR)]
    )
    medians = materialise(medians.select(*_GROUP, F.struct(*[f"m{i}" for i in range(d)]).alias("at")))
    apart = attach(rows, medians, _GROUP).groupBy(*_GROUP, "at").agg(*[
        F.percentile_approx(F.abs(F.col(f"vector.{c}") - F.col(f"at.m{i}")), 0.5, 1000).alias(f"s{i}")
        for i, c in enumerate(VECTOR)
    ])
    spread = [
        F.sqrt((1.4826 * F.col(f"s{i}")) ** 2 + f**2) for i, f in enumerate(FLOORS.values())
    ]
    lower = [
        (spread[i] if i == j else F.lit(0.0)).alias(f"l{i}{j}") for i in range(d) for j in range(i + 1)
    ]
    means = [F.col(f"at.m{i}").alias(f"m{i}") for i in range(d)]
    return materialise(apart.select(*_GROUP, F.struct(*means, *lower).alias("fit")))


def distance(vector: str = "vector", fit: str = "fit") -> Column:
    """Squared Mahalanobis distance, by solving with the Cholesky factor."""
    solved: list[Column] = []
    for i, name in enumerate(VECTOR):
        rest = F.col(f"{vector}.{name}") - F.col(f"{fit}.m{i}")
        for j in range(i):
            rest = rest - F.col(f"{fit}.l{i}{j}") * solved[j]
        solved.append(rest / F.col(f"{fit}.l{i}{i}"))
    return sum((z * z for z in solved[1:]), solved[0] * solved[0])


def estimates(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The groups by language and source, and the fit of each group that is large enough.

    ``vectors`` has ``lang``, ``source`` and ``vector``, of documents that pass the base rules.
    """
    groups = _groups(vectors)
    rows = materialise(attach(vectors.select("lang", "source", "vector"), groups, ["lang", "source"])
                       .select(*_GROUP, "vector"))
    fit, best, moving = _start(rows), None, rows
    while True:
        measured = attach(moving, fit, _GROUP).select(*_GROUP, "vector", distance().alias("d"))
        cut = measured.groupBy(*_GROUP).agg(F.percentile_approx("d", SHARE, 1000).alias("cut"))
        fit = _moments(attach(measured, materialise(cut), _GROUP).where("d <= cut"))
        if best is None:
            best = fit
            continue
        both = fit.join(best.withColumnRenamed("fit", "old"), _GROUP, "right")
        fell = F.coalesce(_spread("fit") <= _spread("old") - SETTLED, F.lit(False))
        better = F.coalesce(_spread("fit") < _spread("old"), F.lit(False))
        both = materialise(both.select(
            *_GROUP, F.when(better, F.col("fit")).otherwise(F.col("old")).alias("fit"), fell.alias("fell")))
        best, fit = both.drop("fell"), both.where("fell").drop("fell")
        if fit.isEmpty():
            break
        moving = moving.join(fit.select(*_GROUP), _GROUP, "left_semi")
    fit = best
    sizes = rows.groupBy(*_GROUP).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_GROUP)
    return groups, materialise(fit.join(sizes.select(*_GROUP), _GROUP))


def judged(rows: DataFrame, groups: DataFrame, fits: DataFrame, limit: float = LIMIT) -> DataFrame:
    """``rows`` (with statistics) with ``distance`` and ``kept``.

    A row of a group without a fit has no distance and is kept if the base rules pass it.
    """
    known = materialise(groups.join(fits, _GROUP).select("lang", "source", "fit"))
    fitted = _left(rows, known)
    far = F.coalesce(F.col("distance") > limit, F.lit(False))
    return (
        fitted.withColumn("distance", distance())
        .withColumn("kept", ~F.col("base_failed") & ~far)
        .drop("fit")
    )


def _left(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Every row, with the fit of its language and source or NULL."""
    every = rows.select("lang", "source").distinct().join(
        known.withColumnsRenamed({"lang": "_lang", "source": "_source"}),
        F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")),
        "left",
    ).select("lang", "source", "fit")
    return attach(rows, materialise(every), ["lang", "source"])


def quality(documents: DataFrame, limit: float = LIMIT) -> DataFrame:
    """Per document: the statistics, ``base_failed``, ``distance`` and ``kept``."""
    own = documents.select("doc_id", "text", "lang", "source")
    rows = materialise(with_statistics(own).drop("text"))
    groups, fits = estimates(rows.where(~F.col("base_failed")))
    return judged(rows, groups, fits, limit)


def of_quality(documents: DataFrame, limit: float = LIMIT) -> DataFrame:
    """The documents that ``quality`` keeps, with their columns as they are.

    Every text is measured once, and what is measured is written beside the row before anything is
    filtered: a filter on an unwritten statistic would be pushed below its parts, and evaluate
    them anew for every word.
    """
    carried = F.struct(*[f"`{c}`" for c in documents.columns]).alias("_row")
    measured = with_statistics(documents.select("lang", "source", "text", carried)).select(
        "lang", "source", "base_failed", "vector", "_row"
    )
    path = scratch_path(documents.sparkSession, "quality")
    measured.write.parquet(path)
    rows = documents.sparkSession.read.schema(measured.schema).parquet(path)
    groups, fits = estimates(rows.where(~F.col("base_failed")))
    return judged(rows, groups, fits, limit).where("kept").select("_row.*")
