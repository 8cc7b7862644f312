"""Scans and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from proofmark import schemas


def scan(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Read a table of parquet files; only the named columns reach the scan."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def spread(df: DataFrame) -> DataFrame:
    """Give row-local, heavy work enough tasks when the scan itself has fewer than the session has cores.

    A table of many splits is left as it is: nothing is shuffled at scale.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def scan_named(spark: SparkSession, name: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.table(name)
    return df.select(*[F.col(f"`{c}`") for c in columns]) if columns else df


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A short configuration list as a local relation, which joins by broadcast and runs no Python task."""
    empty = spark.createDataFrame([], schema)
    if not rows:
        return empty
    fields = empty.schema.fields
    listed = F.array(*[F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields)]) for row in rows])
    return spark.range(0, 1, 1, 1).select(F.inline(listed))


def write_table(df: DataFrame, name: str, partition_by: list[str] | None = None) -> None:
    """Overwrite a catalog table."""
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def write_files(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_json(df: DataFrame, path: str, run_id: str) -> str:
    """Small result tables (verdicts, thresholds, name maps) of a run as JSON lines, in the run's own folder.

    A retried run replaces its folder, so nothing is doubled; ``path`` reads all runs, with ``run_id`` as a column.
    """
    target = f"{path}/run_id={run_id}"
    df.write.mode("overwrite").json(target)
    return target


def read_inference_log(spark: SparkSession, path: str, streaming: bool = False, glob: str | None = None) -> DataFrame:
    """The request log as a batch or streaming DataFrame, with its declared schema."""
    if streaming:
        reader = spark.readStream.schema(schemas.INFERENCE_LOG)
        return (reader.option("pathGlobFilter", glob) if glob else reader).parquet(path)
    return spark.read.schema(schemas.INFERENCE_LOG).parquet(path)


def chunk_documents(df: DataFrame, key: str, text: str, size: int = 500, overlap: int = 0) -> DataFrame:
    """Split each whole text into windows of ``size`` words, ``overlap`` words shared by neighbours."""
    if size <= overlap:
        raise ValueError("size must be larger than overlap")
    step = size - overlap
    split_up = df.select(key, F.filter(F.split(text, r"\s+"), lambda w: w != "").alias("_w"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("_w") - 1, F.lit(0)), F.lit(step))
    windows = F.transform(starts, lambda start: F.array_join(F.slice("_w", start + 1, size), " "))
    # A text without words yields one empty window. Dropping it afterwards, not before, keeps the
    # split from being computed once more for the test.
    return split_up.select(key, F.posexplode(windows).alias("chunk_no", "content")).where(F.col("content") != "")
