"""Session settings and durable intermediate results."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile
from pathlib import Path
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job relies on.  Broadcast stays with Spark's own size check
# (autoBroadcastJoinThreshold from statistics, or measured stage sizes under AQE).
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even when that costs one more shuffle downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Tasks after a shuffle read 16 MB at most, however large the input: many partitions, of which small ones are joined.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1600",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # A table of thousands of days is listed by some tasks with many folders each, not by a task per folder.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    # Rows that are written several times, as staged and stored ones are, take about a third less than with snappy.
    "spark.sql.parquet.compression.codec": "zstd",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build(app: str = "layerhouse", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, which need not have it installed; once per context."""
    context = spark.sparkContext
    if getattr(context, "_layerhouse_shipped", False):
        return
    package = Path(__file__).resolve().parent
    archive = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="layerhouse-code-")), "layerhouse.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(archive)
    context._layerhouse_shipped = True


def prepare(spark: SparkSession) -> SparkSession:
    """For entry points: send the code along, and on one machine name a folder where none is named.

    On a cluster every process must see the folder, so there it has to be configured.
    """
    ship(spark)
    context = spark.sparkContext
    if not spark.conf.get("spark.checkpoint.dir", None) and not context._jsc.sc().getCheckpointDir().isDefined():
        if not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="layerhouse-"))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder for durable intermediates: the cluster's ``spark.checkpoint.dir``; never a guess."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = context._jsc.sc().getCheckpointDir()
    if not current.isDefined():
        if not configured:
            raise ValueError("no folder for intermediate results: set spark.checkpoint.dir")
        context.setCheckpointDir(configured)
        current = context._jsc.sc().getCheckpointDir()
    return configured or current.get()


def durable(df: DataFrame) -> DataFrame:
    """Materialise once on reliable storage, so later passes see identical rows."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch(spark: SparkSession, kind: str) -> str:
    """A new path below the shared folder, removed when the application ends or by ``release``."""
    path = f"{shared_dir(spark)}/{kind}-{uuid4().hex}"
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def release(spark: SparkSession, path: str) -> None:
    """Remove what ``scratch`` named, once nothing reads it any more."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def written(df: DataFrame) -> DataFrame:
    """As ``durable``, but as columnar files: later passes read only the columns they use."""
    path = scratch(df.sparkSession, "written")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
