"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import gc
import os
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the results depend on; sizing stays with the cluster.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # a repeated JSON key keeps its last value
    "spark.sql.variant.allowDuplicateKeys": "true",
}
# The JVM does not compile longer methods; such stages run faster as separate, compiled projections.
CODEGEN_CONF = {"spark.sql.codegen.hugeMethodLimit": "8000"}

_staged: dict[tuple[str, str], str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings that results and generated code depend on to an existing session."""
    for key, value in {**SEMANTIC_CONF, **CODEGEN_CONF}.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", app: str = "trailmark", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; a scratch one only for local sessions without it."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    scratch = tempfile.mkdtemp(prefix="trailmark-")
    context.setCheckpointDir(scratch)
    return scratch


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(shared_dir(spark), "trailmark", spark.sparkContext.applicationId, uuid.uuid4().hex, name)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back, which cuts its lineage."""
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.parquet(path)
    found = spark.read.schema(df.schema).parquet(path)
    found.staged_path = path
    return found


def discard(*frames: DataFrame) -> None:
    """Remove what ``materialize`` wrote for frames that nothing reads any more."""
    for frame in frames:
        spark = frame.sparkSession
        place = spark._jvm.org.apache.hadoop.fs.Path(frame.staged_path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def let_go() -> None:
    """Have Spark delete the files of finished shuffles now.

    It does so once the driver has collected the objects that stand for them, which between the steps of a job that lives off
    its disk should not wait for the next full collection.
    """
    spark = SparkSession.getActiveSession()
    for _ in range(2):  # what Python lets go reaches the JVM with a delay
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.5)


def staged(spark: SparkSession, name: str, build) -> str:
    """Path of a table written at most once per application; ``build(path)`` writes it on first use."""
    key = (spark.sparkContext.applicationId, name)
    if key not in _staged:
        path = stage_path(spark, "table")
        build(path)
        _staged[key] = path
    return _staged[key]
