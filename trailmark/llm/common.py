"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())


def whole_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` only (null text: empty), whatever other columns there are."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str | StructType, rows: int = 256) -> DataFrame:
    """``function`` over Arrow batches of at most ``rows`` rows; few of them keep very long texts within memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                yield function(batch.slice(start, rows))

    return df.mapInArrow(run, schema)
