"""Named queries: every operator on its whole table, as digests that compare across engines."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage_path
from . import (
    alignment,
    ann,
    bpe,
    collocations,
    decontamination,
    html_extraction,
    licenses,
    line_dedup,
    oracles,
    pii,
    quality,
    simhash,
    substring_dedup,
    token_files,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = dict(oracles.SQL)


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op8_bpe(spark, sf_dir):
    """Digests of the ids of every document and of the text decoded from them."""
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@query
def op7_pii(spark, sf_dir):
    """Personal data in every document."""
    return pii.scan(table(spark, sf_dir, "documents"))


@query
def op6_simhash(spark, sf_dir):
    """Near-duplicate groups of all documents: 4-word shingles, 4 bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words_per_shingle=4, max_bits=4)
    return found.select("doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


@query
def op1_licenses(spark, sf_dir):
    """Licence scan of every document."""
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op9_line_dedup(spark, sf_dir):
    """Later copies of repeated line runs deleted from all documents."""
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed", "n_runs", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256")
    )


@query
def op2_decontamination(spark, sf_dir):
    """Benchmark items found in documents, with the most similar window."""
    found = decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "start_word", "n_words", "distance", "similarity")


@query
def op3_quality(spark, sf_dir):
    """Quality of every document, by a model fitted to labels outside the held-out fifth."""
    docs = table(spark, sf_dir, "documents")
    scored = quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        F.coalesce(quality.held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op5_ann(spark, sf_dir):
    """The 20 nearest of every twentieth embedding."""
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


@query
def op10_substring_dedup(spark, sf_dir):
    """Strings of 50 bytes that an earlier document has, removed from all documents."""
    found = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op4_html(spark, sf_dir):
    """Main text of every page."""
    return html_extraction.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


@query
def op12_alignment(spark, sf_dir):
    """Groups and links of the tokens of two tokenizers over every document."""
    files = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.align(table(spark, sf_dir, "documents"), *files)


@query
def op11_token_files(spark, sf_dir):
    """Ids of all documents written to binary files and read back from them."""
    path = stage_path(spark, "token_files")
    token_files.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_files.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op13_collocations(spark, sf_dir):
    """The first 2,000 collocations of each language."""
    return collocations.mine(table(spark, sf_dir, "documents"), least=100, longest=5, top=2000)
