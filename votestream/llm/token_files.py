"""Token ids in ORC files, in ascending order of documents.

ORC packs integers by run-length encoding, keeps minima and maxima for every stripe and
every ``ROWS_IN_INDEX`` rows, and here also Bloom filters on the document ids. Stripes
are read in parallel, and a reader that asks for some documents skips the others by
this metadata.
"""

import struct
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T
from tokenizers import Tokenizer

from ..operators import materialise
from .pretokens import Encoder
from .shipping import in_arrow

END_ID = 0
STRIPE_BYTES = 16 << 20
ROWS_IN_INDEX = 1_000
FALSE_POSITIVES = 0.01

ROWS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("ids", T.ArrayType(T.IntegerType())),
    T.StructField("before", T.LongType()),  # ids of this file in front of the row
])
#: Words whose ids a task remembers; invented or rare words make up much of a large corpus.
MEMORY = 1_000_000


@cache
def _encoder(path: str) -> Encoder:
    tokenizer = Tokenizer.from_file(path)
    # The library finds these anywhere in a text, also within a word.
    added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]

    def whole(text: str) -> bytes:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}i", *ids)

    # The separators are the only spaces, or the only line feeds, in what is encoded; each begins a token.
    begins = {" ": np.zeros(tokenizer.get_vocab_size(), bool), "\n": np.zeros(tokenizer.get_vocab_size(), bool)}
    for token, i in tokenizer.get_vocab().items():
        begins[" "][i], begins["\n"][i] = token.startswith("Ġ"), token == "Ċ"

    def many(words: list[str], before: str) -> list[bytes]:
        # Offsets, which this call leaves out, take a third of the time.
        found = tokenizer.encode_batch_fast([before + before.join(words)], add_special_tokens=False)[0]
        ids = np.array(found.ids, "<i4")
        at = np.flatnonzero(begins[before][ids])
        skip = 1 if before == "\n" else 0  # a line feed is a token of its own
        cuts, ids = (4 * np.append(at, len(ids))).tolist(), ids.tobytes()
        return [ids[a + 4 * skip : b] for a, b in zip(cuts[:-1], cuts[1:])]

    return Encoder(whole, many, added, MEMORY)


def token_ids(documents: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """``doc_id`` and ``ids`` of every text, with ``end_id`` behind them, and the ids ``before``
    them in the same partition.

    ``tokenizer`` names a file of the tokenizers library with byte-level pre-tokens, which
    must be there on every machine. A NULL text is empty, and has the end id only.
    """
    end = struct.pack("<i", end_id)

    def encode(batches):
        encoder, before = _encoder(tokenizer), 0
        for batch in batches:
            ids = [encoder.encode(text.as_py() or "") + end for text in batch.column(1)]
            sizes = np.cumsum([0, *(len(x) // 4 for x in ids)], dtype=np.int32)
            values = pa.array(np.frombuffer(b"".join(ids), "<i4"))
            starts = pa.array(sizes[:-1].astype(np.int64) + before)
            before += int(sizes[-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(sizes), values), starts], ROWS.names
            )

    return in_arrow(documents.select(F.col("doc_id").cast("bigint"), "text"), encode, ROWS)


def write_token_ids(documents: DataFrame, tokenizer: str, path: str, end_id: int = END_ID) -> None:
    """Writes the ids below ``path``; each file holds a range of documents in order.

    Texts are dealt out by range before they are encoded, since finding the ranges looks at
    the input twice. A NULL doc_id comes first; documents with the same id lie next to each other.
    """
    texts = documents.select("doc_id", "text").repartitionByRange("doc_id")
    (
        token_ids(texts.sortWithinPartitions("doc_id", "text"), tokenizer, end_id)
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", str(FALSE_POSITIVES))
        .option("orc.row.index.stride", str(ROWS_IN_INDEX))
        .option("orc.stripe.size", str(STRIPE_BYTES))
        .orc(path)
    )


def read_token_ids(spark: SparkSession, path: str, doc_ids=None) -> DataFrame:
    """``doc_id`` and ``ids``; of ``doc_ids`` only, if given, which reach the file index."""
    rows = spark.read.schema(ROWS).orc(path).select("doc_id", "ids")
    return rows if doc_ids is None else rows.where(F.col("doc_id").isin(list(doc_ids)))


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: ``start``, ``n_tokens`` and ``ids_crc32``.

    ``start`` counts the ids of all documents before it. Totals are formed by file, and
    only those, one row a file, are put in order in one place.
    """
    rows = spark.read.schema(ROWS).orc(path).select("*", F.col("_metadata.file_path").alias("file"))
    schema = "doc_id bigint, file string, before bigint, n_tokens bigint, ids_crc32 bigint"

    def measure(batches):
        for batch in batches:
            ids = batch.column(1)
            at = ids.offsets.to_numpy()
            values = memoryview(np.ascontiguousarray(ids.values.to_numpy(), "<i4")).cast("B")
            sums = [zlib.crc32(values[4 * a : 4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(3), batch.column(2), pa.array(np.diff(at), pa.int64()),
                 pa.array(sums, pa.int64())],
                ["doc_id", "file", "before", "n_tokens", "ids_crc32"],
            )

    measured = materialise(in_arrow(rows, measure, schema))
    files = measured.groupBy("file").agg(F.sum("n_tokens").alias("total"), F.min("doc_id").alias("least"))
    # A file with only NULL ids has no least one, and NULL comes first in any case.
    earlier = Window.orderBy("least", "total", "file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("files_before"))
    return measured.join(files, "file").select(
        "doc_id", (F.col("files_before") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )
