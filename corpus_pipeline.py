"""From raw documents to token ids: quality, line dedup, near dedup, decontamination, encoding and decoding.

Every stage takes all documents that the stage before kept, and all but the last return the columns of ``documents``. Between
stages the documents are a Parquet table in the shared folder, so a lost executor costs part of one stage at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.llm import bpe, decontamination, line_dedup, quality, simhash
from trailmark.session import materialize

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
SHINGLE_WORDS, MAX_BITS = 4, 4


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, quality.train(docs, labels))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs deleted; documents of which nothing is left go. ``n_chars`` follows the text.

    Columns of the documents that are named like the counts of the operator are kept as they are.
    """
    counts = ("n_lines", "n_removed", "n_runs")
    apart = "_" * (1 + max(map(len, docs.columns)))  # a prefix that no column has
    own = {c: apart + c for c in docs.columns if c in counts}
    cut = line_dedup.dedup_lines(docs.withColumnsRenamed(own)).where("n_removed = 0 OR trim(text) <> ''")
    size = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")) if "n_chars" in docs.columns else None
    return cut.select(*[size.alias(c) if c == "n_chars" else F.col(own.get(c, c)).alias(c) for c in docs.columns])


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash near-duplicate group."""
    return simhash.one_of_each(docs, SHINGLE_WORDS, MAX_BITS)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.without_matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, token_ids`` of every document, whose ids were decoded again and gave its text."""
    return bpe.encode_to_arrays(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", good_documents),
    ("line dedup", without_repeated_lines),
    ("simhash near-dedup", without_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("byte-level bpe", token_ids),
]

#: a conditional random field and BPE are not SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the ``documents`` of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = materialize(stage(spark, docs, sf_dir), f"stage_{number}")
    return docs
