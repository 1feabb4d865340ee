"""From raw documents to token ids: five stages, each over all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a table; all but the last one return the columns
of ``documents``. A stage is written as Parquet, and read again for the next one.

1. quality: documents that fail the base rules, or whose statistics are outliers, go.
2. lines: of lines on ten sites or more the first stays. A document of which no word is left goes.
3. near_duplicates: of documents linked by a similarity of 0.8 (shingles of five words), the one
   with the smallest doc_id stays.
4. decontamination: words of benchmark windows are cut out; a document of which more than
   half is hit goes.
5. tokens: the texts as ids of a byte-level BPE vocabulary, with a digest of what they decode to.

A NULL text is empty and fails the base rules. Rows that share a doc_id are one document
to stage 3, and texts of their own to the others. Empty tables give empty tables.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from votestream.llm.bpe import decode_ids, encode_texts
from votestream.llm.decontamination import decontaminated
from votestream.llm.line_dedup import without_boilerplate
from votestream.llm.near_dedup import near_duplicates
from votestream.llm.quality import of_quality
from votestream.session import scratch_path

#: SQL cannot express the stages 1 and 5; tests compare the result with plain Python.
ORACLE_SQL = None


def _columns(rows: DataFrame, docs: DataFrame, changed=None) -> DataFrame:
    """``rows`` with the columns of ``docs``, and the number of characters of changed texts."""
    if "n_chars" in docs.columns and changed is not None:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        rows = rows.withColumn("n_chars", F.when(changed, size).otherwise(F.col("n_chars")))
    return rows.select(*[f"`{c}`" for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return of_quality(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = F.col("n_removed") > 0
    rest = without_boilerplate(docs).where(~cut | F.col("text").rlike(r"[^ \t\n\x0B\f\r]"))
    return _columns(rest, docs, cut)


def near_duplicate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    extra = near_duplicates(docs, size=5, threshold=0.8).where(~F.col("kept"))
    return docs.join(extra.select("doc_id").distinct(), "doc_id", "left_anti").select(
        *[f"`{c}`" for c in docs.columns]
    )


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    before = "_text_before"
    kept = decontaminated(docs.withColumn(before, F.col("text")), benchmark)
    return _columns(kept, docs, ~F.col("text").eqNullSafe(F.col(before)))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    vocabulary, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = encode_texts(docs.select("doc_id", "lang", "source", "text"), vocabulary, pattern)
    return decode_ids(encoded.drop("text"), vocabulary, pattern).select(
        "doc_id", "lang", "source",
        F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicate_documents),
    ("decontamination", decontamination),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = scratch_path(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{path}/{name}")
        docs = spark.read.parquet(f"{path}/{name}")
    return docs
