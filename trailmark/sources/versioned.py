"""Tables in parts (days, sources) that are replaced together, or not at all.

The parts of a batch are written beside the stored ones, below a folder of their own. They become the current ones by one small
file added to the table's log, which says which folder holds which part; a reader sees all parts of a batch or none, and a batch
that dies in between leaves nothing behind but files that nobody reads. One writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LOG = "seq long, part string, version string"
UNDATED = "none"


def day_of(ts: str = "timestamp_utc") -> Column:
    """The part of a table by day: the day of a timestamp as text, or ``none``."""
    return F.coalesce(F.to_date(ts).cast("string"), F.lit(UNDATED))


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """All entries of a log of small JSON files; None before the first one."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def append_log(rows: DataFrame, path: str) -> None:
    """Add entries as one file, which a reader sees as a whole or not at all."""
    rows.coalesce(1).write.mode("append").json(path)


class VersionedTable:
    """A table whose rows belong to parts, by an expression of letters, digits, ``-`` and ``_``."""

    def __init__(self, spark: SparkSession, root: str, part: Column):
        self.spark, self.root, self.part = spark, root.rstrip("/"), part

    @property
    def _log(self) -> str:
        return f"{self.root}/_log"

    def versions(self) -> dict[str, str]:
        """The current version of each part that has rows; one entry for each."""
        log = read_log(self.spark, self._log, _LOG)
        if log is None:
            return {}
        latest = log.groupBy("part").agg(F.max_by("version", "seq").alias("version"))
        return {row["part"]: row["version"] for row in latest.where("version IS NOT NULL").collect()}

    def parts(self) -> list[str]:
        return sorted(self.versions())

    def read(self, parts: Iterable[str] | None = None) -> DataFrame | None:
        """Rows of all parts, or of those named that exist; None if there are none. No other part is listed or opened."""
        versions = self.versions()
        chosen = sorted(versions) if parts is None else sorted(set(parts) & set(versions))
        if not chosen:
            return None
        paths = [f"{self.root}/data/version={versions[part]}/part={part}" for part in chosen]
        return self.spark.read.option("basePath", f"{self.root}/data").parquet(*paths).drop("version", "part")

    def replace(self, rows: DataFrame, parts: Iterable[str]) -> None:
        """Make ``rows`` the content of ``parts``, all at once; parts without rows become empty. Rows of other parts are an error."""
        version, named = uuid.uuid4().hex, sorted(set(parts))
        path = f"{self.root}/data/version={version}"
        placed = rows.withColumn("part", self.part)
        placed.hint("rebalance", "part").write.partitionBy("part").parquet(path)
        found = self.spark.read.schema(placed.schema).parquet(path).select(F.col("part").cast("string")).distinct()
        filled = {row["part"] for row in found.collect()}
        if not filled <= set(named):
            raise ValueError(f"rows of parts that were not named: {sorted(filled - set(named))[:5]}")
        log = read_log(self.spark, self._log, _LOG)
        seq = 1 + ((log.agg(F.max("seq")).first()[0] or 0) if log is not None else 0)
        entries = [(seq, part, version if part in filled else None) for part in named]
        if entries:
            append_log(self.spark.createDataFrame(entries, _LOG), self._log)
