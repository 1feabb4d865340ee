"""Near-duplicate documents by HyperMinHash.

A document is the set of its word shingles. Its hashes are dealt into ``REGISTERS``
buckets, and of the smallest hash of each bucket a register keeps the number of leading
zeros and the ``MANTISSA_BITS`` bits behind the first one. Empty registers borrow from
another one, picked by their own number alone. Registers agree about as often as the
sets overlap.

1. Documents with equal sets are one class from here on.
2. Bands of registers put classes into buckets. In each bucket all are paired with the
   smallest one only. Pairs whose sizes or registers rule out a link are dropped; the
   registers' estimate is corrected for chance collisions and has a margin of
   ``MARGIN`` standard errors. The others are verified on their full sets.
3. Links join classes into components. A bucket whose classes are in one component by now
   is done. The classes of all others are compared once more, by an exact prefix filter over
   their rarest shingles, and only with classes of other components.

So no pair of a bucket is left out unless its two classes are known to be connected.
"""

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..operators import materialise
from ..session import scratch_path
from .arrays import blocks, mixed, shingle_sets, utf8
from .graph import components
from .shipping import in_arrow

REGISTERS = 128
_BUCKET_BITS = 7
_VALUE_BITS = 64 - _BUCKET_BITS
MANTISSA_BITS = 10
#: Chance that all bands of a pair at the threshold differ, at most.
MISS = 1e-6
#: Standard errors by which an estimate must miss the threshold before a pair is dropped.
MARGIN = 5.0

_U = np.uint64
_BORROWS = 64


def band_rows(threshold: float) -> int:
    """Registers in a band: as many as keep the chance of a miss below ``MISS``."""
    rows = 1
    while (1 - threshold ** (rows + 1)) ** (REGISTERS // (rows + 1)) <= MISS:
        rows += 1
    return rows


@cache
def _lenders() -> np.ndarray:
    """Which register an empty one asks, by attempt."""
    asked = mixed(np.arange(_BORROWS * REGISTERS, dtype=_U) + _U(0x5851F42D4C957F2D))
    return (asked % _U(REGISTERS)).astype(np.int64).reshape(_BORROWS, REGISTERS)


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """Compressed registers (uint16) of ascending, distinct, non-empty hash sets."""
    values = np.full((len(sets), REGISTERS), np.iinfo(_U).max, _U)
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    slot = owner * REGISTERS + (every >> _U(_VALUE_BITS)).astype(np.int64)
    first = np.empty(len(slot), bool)  # hashes ascend, so the first of a bucket is its least
    first[0], first[1:] = True, slot[1:] != slot[:-1]
    values.reshape(-1)[slot[first]] = every[first] & _U((1 << _VALUE_BITS) - 1)
    filled = values != np.iinfo(_U).max
    fraction, exponent = np.frexp(values.astype(np.float64))
    zeros = np.clip(_VALUE_BITS - exponent, 0, _VALUE_BITS)
    mantissa = ((fraction * 2 - 1).clip(0) * (1 << MANTISSA_BITS)).astype(np.int64)
    packed = (zeros << MANTISSA_BITS) + np.minimum(mantissa, (1 << MANTISSA_BITS) - 1)
    return _borrow(packed.astype(np.uint16), filled)


def _borrow(packed: np.ndarray, filled: np.ndarray) -> np.ndarray:
    out, done = packed.copy(), filled.copy()
    rows = np.flatnonzero(~done.all(axis=1))
    for asked in _lenders():
        if not len(rows):
            return out
        can = filled[rows][:, asked] & ~done[rows]
        out[rows] = np.where(can, packed[rows][:, asked], out[rows])
        done[rows] |= can
        rows = rows[~done[rows].all(axis=1)]
    for row in rows:  # very small sets: the next filled one to the right
        own = np.flatnonzero(filled[row])
        empty = np.flatnonzero(~done[row])
        out[row, empty] = packed[row, own[np.searchsorted(own, empty) % len(own)]]
    return out


def collision_rate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Chance that registers of unlike sets of these sizes agree.

    Their values fall into the same cell of relative width 2**-MANTISSA_BITS with a
    chance of about 0.72 * 2**-MANTISSA_BITS * ab / (a + b)**2.
    """
    return 0.72 / (1 << MANTISSA_BITS) * a * b / (a + b) ** 2


def estimate(agree: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the share of agreeing registers, less chance collisions."""
    chance = collision_rate(a, b)
    return (agree - chance) / (1 - chance)


_SIGNED = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("n_shingles", T.LongType()),
    T.StructField("digest", T.LongType()),
    T.StructField("digest2", T.LongType()),
    T.StructField("registers", T.BinaryType()),
])
DIGEST = ["digest", "digest2", "n_shingles"]


def signatures(documents: DataFrame, size: int) -> DataFrame:
    """Per document: the size of its shingle set, a digest of the set, its registers."""

    def sign(batches):
        for batch in batches:
            sizes, sums, sums2, packed = [], [], [], []
            text = batch.column(1).fill_null("")
            for _, _, data, offsets in blocks(*utf8(text)):
                sets = shingle_sets(data, offsets, size)
                sizes += [len(s) for s in sets]
                sums += [int(mixed(s).sum()) if len(s) else 0 for s in sets]
                sums2 += [int(mixed(s ^ _U(0xA0761D6478BD642F)).sum()) if len(s) else 0 for s in sets]
                full = [s for s in sets if len(s)]
                own = iter(registers(full) if full else ())
                packed += [next(own).tobytes() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), _signed(sums), _signed(sums2),
                 pa.array(packed, pa.binary())],
                names=_SIGNED.names,
            )

    return in_arrow(documents.select(F.col("doc_id").cast("bigint"), "text"), sign, _SIGNED)


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, dtype=_U).view(np.int64))


def near_duplicates(
    documents: DataFrame, size: int = 5, threshold: float = 0.8
) -> DataFrame:
    """Per document: ``n_shingles``, ``component_id`` and whether it is ``kept``.

    Documents are linked if the sets of their shingles of ``size`` words have a Jaccard
    similarity of ``threshold`` (in hundredths) or more. ``component_id`` is the
    smallest doc_id reachable over links, and the document with that id is kept.

    A NULL text is empty. A document without words is linked with nothing and kept. Rows
    that share a doc_id are one document with several texts, reported row by row. A row
    without a doc_id is not linked onwards: it has the component of the documents with
    the very same set, or NULL and is kept. Other columns are not looked at.
    """
    spark = documents.sparkSession
    path = scratch_path(spark, "near-dedup")
    signatures(documents, size).write.parquet(f"{path}/signed")
    signed = spark.read.schema(_SIGNED).parquet(f"{path}/signed")
    full = signed.where("n_shingles > 0")
    classes = full.groupBy(*DIGEST).agg(
        F.min("doc_id").alias("rep"), F.any_value("registers").alias("registers")
    )
    classes.write.parquet(f"{path}/classes")
    classes = spark.read.schema(classes.schema).parquet(f"{path}/classes")
    reps = classes.where("rep is not null")

    links = _links(reps, documents, size, threshold, path)
    known = full.join(classes.select(*DIGEST, "rep"), DIGEST).where("doc_id <> rep")
    # Rows that share a doc_id hold their classes together.
    links = links.unionByName(known.select(F.col("rep").alias("a"), F.col("doc_id").alias("b")))
    found = components(links)
    placed = full.select("doc_id", *DIGEST).join(classes.select(*DIGEST, "rep"), DIGEST).join(
        found.withColumnRenamed("node", "rep"), "rep", "left"
    ).select("doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
    empty = signed.where("n_shingles = 0").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id")
    )
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    return placed.unionByName(empty).withColumn("kept", kept)


def _links(reps: DataFrame, documents: DataFrame, size: int, threshold: float, path: str) -> DataFrame:
    """Links (a, b) that connect all classes which any links would connect."""
    spark = documents.sparkSession
    rows = band_rows(threshold)
    bands = F.array(*[
        F.xxhash64(F.lit(i), F.expr(f"substring(registers, {2 * rows * i + 1}, {2 * rows})"))
        for i in range(REGISTERS // rows)
    ])
    members = reps.select("rep", F.explode(bands).alias("band"))
    led = members.groupBy("band").agg(F.min("rep").alias("lead"), F.max("rep").alias("most"))
    led = led.where("lead < most").select("band", "lead")
    members.join(led, "band").write.parquet(f"{path}/buckets")
    buckets = spark.read.schema("band bigint, rep bigint, lead bigint").parquet(f"{path}/buckets")
    # From here on only the texts of classes that share a bucket are of interest.
    wanted = buckets.select(F.col("rep").alias("id")).distinct()
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    documents.select(F.col("doc_id").cast("bigint").alias("id"), text).join(
        wanted, "id", "left_semi"
    ).write.parquet(f"{path}/texts")
    texts = spark.read.schema("id bigint, text string").parquet(f"{path}/texts")

    pairs = buckets.where("rep <> lead").select(F.col("lead").alias("a"), F.col("rep").alias("b"))
    links = _verified(pairs.distinct(), reps, texts, size, threshold)
    labels = components(links).withColumnRenamed("node", "rep")
    labelled = buckets.where("rep <> lead").join(labels, "rep", "left").select(
        "band", "rep", F.coalesce("component", "rep").alias("component")
    )
    several = labelled.groupBy("band").agg(
        F.min("component").alias("least"), F.max("component").alias("most")
    ).where("least < most").select("band")
    apart = materialise(labelled.join(several, "band").select("rep", "component").distinct())
    more = _prefix_pairs(apart, texts, size, threshold)
    return links.unionByName(_verified(more, reps, texts, size, threshold))


def _prefix_pairs(apart: DataFrame, texts: DataFrame, size: int, threshold: float) -> DataFrame:
    """Pairs of classes of different components that may be links, among those in ``apart``.

    Exact: two sets of ``n`` shingles or more with this similarity share one of the rarest
    ``n - ceil(threshold * n) + 1`` of either, if both are put in the same order. Rare
    is what few of these classes have, so what only one has ends no pair. That leaves few
    pairs even of a large group of texts that are all a bit too unlike each other.
    """
    cent = round(threshold * 100)

    def spell(batches):
        for batch in batches:
            for first, last, data, offsets in blocks(*utf8(batch.column(2))):
                sets = shingle_sets(data, offsets, size)
                counts = [len(s) for s in sets]
                at = pa.array(np.repeat(np.arange(first, last), counts))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at),
                     pa.array(np.repeat(np.array(counts, np.int64), counts)),
                     pa.array(np.concatenate(sets).view(np.int64))],
                    names=["rep", "component", "n", "shingle"],
                )

    own = apart.join(texts.withColumnRenamed("id", "rep"), "rep").select("rep", "component", "text")
    spelt = in_arrow(own, spell, "rep bigint, component bigint, n bigint, shingle bigint")
    spelt = materialise(spelt)
    common = spelt.groupBy("shingle").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    # Shingles of one class only come first; how many they are follows from the others.
    known = spelt.join(common, "shingle").groupBy("rep", "component", "n").agg(
        F.sort_array(F.collect_list(F.struct("df", "shingle"))).alias("shared")
    )
    prefix = F.col("n") - F.ceil(F.lit(cent) * F.col("n") / 100) + 1
    alone = F.col("n") - F.size("shared")
    left = (prefix - alone).cast("int")
    listed = F.posexplode(F.slice("shared", F.lit(1), left)).alias("i", "s")
    rare = materialise(
        known.where(left > 0)
        .select("rep", "component", "n", alone.alias("alone"), listed)
        .select("rep", "component", "n", (F.col("n") - F.col("alone") - F.col("i")).alias("rest"),
                F.col("s.shingle").alias("shingle"))
    )
    other = rare.toDF("b", "of_b", "n_b", "rest_b", "shingle")
    fits = 100 * F.least("n", "n_b") >= cent * F.greatest("n", "n_b")
    # From the first shingle they share on, enough must be left of both.
    fits &= (100 + cent) * F.least("rest", "rest_b") >= cent * (F.col("n") + F.col("n_b"))
    met = rare.join(other, "shingle").where((F.col("rep") < F.col("b")) & fits)
    return met.where("component <> of_b").select(F.col("rep").alias("a"), "b").distinct()


def _verified(pairs, reps, texts, size, threshold) -> DataFrame:
    """The pairs (a, b) that are links: first by size and registers, then by their sets."""
    cent = round(threshold * 100)
    sides = reps.select("rep", "n_shingles", "registers")
    both = pairs
    for side in ("a", "b"):
        both = both.join(
            sides.toDF(side, f"n_{side}", f"registers_{side}"), side
        )
    least, most = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    both = both.where(100 * least >= cent * most)

    def likely(batches):
        for batch in batches:
            columns = batch.to_pydict()
            if not columns["a"]:
                continue
            mine, other = (
                np.frombuffer(b"".join(columns[f"registers_{s}"]), np.uint16).reshape(-1, REGISTERS)
                for s in "ab"
            )
            n_a, n_b = (np.array(columns[f"n_{s}"], float) for s in "ab")
            guess = estimate((mine == other).mean(axis=1), n_a, n_b)
            # Registers of a small set are borrowed, so there are fewer independent ones.
            count = np.minimum(REGISTERS * (1 - np.exp(-np.minimum(n_a, n_b) / REGISTERS)), REGISTERS)
            error = np.sqrt(threshold * (1 - threshold) / np.maximum(count, 1))
            near = guess >= threshold - MARGIN * error
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(pa.array(near)), batch.column(1).filter(pa.array(near))],
                names=["a", "b"],
            )

    columns = ["a", "b", "n_a", "n_b", "registers_a", "registers_b"]
    candidates = materialise(in_arrow(both.select(*columns), likely, "a bigint, b bigint"))
    both = candidates.join(texts.toDF("b", "text_b"), "b").join(texts.toDF("a", "text_a"), "a")

    def alike(batches):
        for batch in batches:
            near = []
            for first, last, data, offsets in blocks(*utf8(batch.column(2))):
                left = shingle_sets(data, offsets, size)
                right = []
                other = batch.column(3).slice(first, last - first)
                for _, _, more, places in blocks(*utf8(other)):
                    right += shingle_sets(more, places, size)
                for x, y in zip(left, right):
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    near.append(len(x) > 0 and 100 * common >= cent * (len(x) + len(y) - common))
            keep = pa.array(near, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"]
            )

    return materialise(in_arrow(both.select("a", "b", "text_a", "text_b"), alike, "a bigint, b bigint"))
