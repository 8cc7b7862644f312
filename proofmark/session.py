"""Session settings the operators count on, and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Hot keys are split at run time even where the next step groups by the join key again.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, wherever it was imported from."""
    application = spark.sparkContext.applicationId
    if application not in _SHIPPED:
        package = Path(__file__).resolve().parent
        folder = tempfile.mkdtemp(prefix="proofmark-code-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        archive = os.path.join(folder, package.name)
        # Zipped on the driver only; Spark hands the file to every executor.
        spark.sparkContext.addPyFile(shutil.make_archive(archive, "zip", package.parent, package.name))
        _SHIPPED.add(application)


def tune(spark: SparkSession) -> SparkSession:
    """Make a live session ready: adaptive execution with skew splitting, UTC, and this package on the workers."""
    ship(spark)
    for key, value in ADAPTIVE.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: str = "8", app: str = "proofmark", settings: dict[str, str] | None = None) -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cores)
        # Plans are long chains of Columns; noting a call site for each costs more than running small queries.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in {**ADAPTIVE, **(settings or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and written intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Only where that is unset, and the master is a
    local one, is a fresh temporary folder made.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="proofmark-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    return os.path.join(shared_dir(spark), name)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate to the shared folder and read it back: it outlives lost executors and cuts the lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
