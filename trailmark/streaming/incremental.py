"""Incremental runs with Structured Streaming.

Cleaning, duplicate removal and sessions run as streams; marts, attribution and monitoring, which need windows over
ordered rows, run per batch on stored tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import CANONICAL, PURCHASE
from ..operators import attribution, cleaning
from ..operators.sessions import SESSION_GAP_SECONDS
from ..session import materialize
from ..sources import tables

RAW_SCHEMA = ", ".join(
    ["source_file string", "row_seq bigint", *[f"{name} string" for name in CANONICAL.values()]]
    + ["source_file_referrer_missing boolean"]
)


def arriving_events(spark: SparkSession, path: str, schema: str = RAW_SCHEMA, files_per_batch: int | None = None) -> DataFrame:
    """Raw events from Parquet files as they arrive in a folder."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def _derived(raw: DataFrame) -> DataFrame:
    return cleaning.derive(cleaning.flag_missing(cleaning.repair_names(cleaning.normalize(raw))))


def undated_stream(raw: DataFrame) -> DataFrame:
    """The side output of ``clean_stream``: cleaned events without a readable time, copies included.

    They fit ``update_days``, which drops copies against all undated rows stored so far.
    """
    return _derived(raw).where("timestamp_utc IS NULL")


def clean_stream(raw: DataFrame, delay: str = "1 day") -> DataFrame:
    """Cleaned events without copies; state is kept for ``delay`` past the newest event time.

    Copies are told by a digest of the copy key, so the state holds 32 bytes per event and not its texts. Undated rows have
    no event time; ``undated_stream`` has them.
    """
    # NULL and the empty text differ in the digest input
    shown = [F.coalesce(F.concat(F.lit("="), F.col(name)), F.lit("0")) for name in cleaning.COPY_KEY]
    sized = [F.concat(F.length(text).cast("string"), F.lit(":"), text) for text in shown]
    return (
        _derived(raw)
        .where("timestamp_utc IS NOT NULL")
        .withColumn("copy_digest", F.unhex(F.sha2(F.concat(*sized), 256)))
        .withWatermark("timestamp_utc", delay)
        .dropDuplicatesWithinWatermark(["copy_digest"])
        .drop("copy_digest")
    )


def session_stream(events: DataFrame, gap: int = SESSION_GAP_SECONDS, delay: str = "1 hour") -> DataFrame:
    """Closed sessions with their event count; equal to the batch sessions, which also cut at second boundaries."""
    utm = F.col("utm_source")
    touch = F.when(utm.isNotNull(), F.struct("timestamp_utc", "row_seq", utm))
    return (
        events.where("client_id IS NOT NULL")
        .withColumn("second", F.date_trunc("second", "timestamp_utc"))
        .withWatermark("second", delay)
        .groupBy("client_id", F.session_window("second", f"{gap} seconds").alias("run"))
        .agg(
            F.min("timestamp_utc").alias("session_start"),
            F.max("timestamp_utc").alias("session_end"),
            F.count("*").alias("n_events"),
            F.count_if(F.col("event_name") == PURCHASE).alias("purchases"),
            F.max(touch)["utm_source"].alias("session_last_utm"),
        )
        .drop("run")
    )


def write_stream(
    stream: DataFrame, path: str, checkpoint: str, mode: str = "append", partition_by: tuple[str, ...] = ()
) -> StreamingQuery:
    """Everything that has arrived, as Parquet files, then stop."""
    writer = stream.writeStream.outputMode(mode).format("parquet").option("path", path)
    writer = writer.option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.trigger(availableNow=True).start()


def per_batch(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Run a batch function (marts, monitors) on what has arrived, then stop."""
    writer = stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def update_days(events: DataFrame, path: str) -> None:
    """Merge cleaned events into a table partitioned by day; undated ones are a day of their own.

    The days that the batch touches are read, joined by the batch, freed of copies (stored rows come first) and written anew;
    all other days stay as they are. The merged days are staged before the first one is replaced.
    """
    spark = events.sparkSession
    dated = events.withColumn("dt", F.to_date("timestamp_utc"))
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        days = dated.select(F.col("dt").alias("day")).distinct()
        stored = tables.read_table(spark, path).alias("stored")
        touched = stored.join(days, F.col("stored.dt").eqNullSafe(F.col("day")), "left_semi")
        both = touched.withColumn("_batch", F.lit(0)).unionByName(dated.withColumn("_batch", F.lit(1)), allowMissingColumns=True)
        order = F.struct("_batch", "row_seq")
        dated = cleaning.keep_first(both.withColumn("_order", order), order="_order").drop("_batch", "_order")
    merged = materialize(dated, "days")
    writer = merged.hint("rebalance", "dt").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("dt").parquet(path)


def attribute_days(spark: SparkSession, path: str, first: str, last: str, days: int = attribution.LOOKBACK_DAYS) -> DataFrame:
    """Attributed purchases of some days of a table partitioned by day, and the undated ones; only their look-back is read.

    One day more than the look-back is read, since it starts in the middle of a day.
    """
    since, until = F.date_sub(F.lit(first).cast("date"), days + 1), F.lit(last).cast("date")
    dt = F.col("dt")
    events = tables.read_table(spark, path).where(dt.isNull() | dt.between(since, until))
    return attribution.purchase_attribution(events, days=days).where(dt.isNull() | dt.between(F.lit(first).cast("date"), until))
