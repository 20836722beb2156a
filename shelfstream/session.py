"""Session settings and the shared folder every intermediate table is written to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings a cluster job wants. AQE merges small shuffle partitions and splits skewed ones of
# joins, but never raises their number, so a cluster starts with many.
CLUSTER_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # split valid / rejected rows without sorting each task by the partition column
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}

# 100 TB in 20,000 partitions are 5 GB each before AQE merges or splits
MANY_PARTITIONS = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000"}

# rows of an Arrow batch, which the JVM and a Python worker hold whole at the same time
BATCH_ROWS = 200
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"

_fallback_dirs: dict[str, str] = {}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    many = {} if master and master.startswith("local") else MANY_PARTITIONS
    if master:
        builder = builder.master(master)
    for key, value in {**CLUSTER_CONF, **many, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a local one only for a local master."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    app = context.applicationId
    if app not in _fallback_dirs:
        _fallback_dirs[app] = tempfile.mkdtemp(prefix="shelfstream-")
    return _fallback_dirs[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/shelfstream/{label}-{uuid.uuid4().hex}"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of at most ``BATCH_ROWS`` rows while it is open; a smaller setting stays."""
    before = spark.conf.get(BATCH_SETTING)
    if not 0 < int(before) <= BATCH_ROWS:
        spark.conf.set(BATCH_SETTING, BATCH_ROWS)
    try:
        yield
    finally:
        spark.conf.set(BATCH_SETTING, before)


def materialise(df: DataFrame, label: str, **options: str | int) -> DataFrame:
    """Write ``df`` once to the shared folder, with options of the Parquet writer, and read it back: lineage is
    cut, and the rows outlive the executors that made them."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
