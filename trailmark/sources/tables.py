"""Parquet, CSV, JSON and text sinks and the Parquet source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def register(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Read a Parquet table and name it for SQL."""
    df = read_table(spark, path)
    df.createOrReplaceTempView(name)
    return df


def write_events(
    df: DataFrame, path: str, ts: str = "timestamp_utc", mode: str = "overwrite", rebalance: bool = True
) -> None:
    """Parquet partitioned by day, so that date filters prune folders.

    The rebalance hint groups rows by day and lets AQE split a day that is much larger than the others; rows that come from
    a table by day need none.
    """
    dated = df.withColumn("dt", F.to_date(ts))
    (dated.hint("rebalance", "dt") if rebalance else dated).write.mode(mode).partitionBy("dt").parquet(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A mart as CSV with a header; AQE already leaves small results in one file."""
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def write_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One text column as lines, in the order of the frame; for reports of a few rows."""
    df.coalesce(1).write.mode(mode).text(path)
