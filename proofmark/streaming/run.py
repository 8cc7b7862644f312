"""Starting streams, and sinks that a restart cannot spoil."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from proofmark.operators.ranking import keep_last

# State lives on the executors' disks with changes uploaded per batch; sessions are merged before the shuffle.
STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def tune_streams(spark: SparkSession) -> None:
    for key, value in STREAM_SETTINGS.items():
        spark.conf.set(key, value)


def read_stream(spark: SparkSession, path: str, schema, files_per_batch: int | None = None) -> DataFrame:
    """Stream the files of a folder; a single file is streamed from the folder that holds it."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(at).isFile():
        return reader.option("pathGlobFilter", at.getName()).parquet(at.getParent().toString())
    return reader.parquet(path)


def to_files(stream: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Append to files. The sink's own log makes each batch count once, replays included."""
    tune_streams(stream.sparkSession)
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start(path)


def to_batches(stream: DataFrame, path: str, checkpoint: str, mode: str = "update", available_now: bool = False) -> StreamingQuery:
    """Write each batch of an aggregate to a directory named by the batch, replacing it on a replay."""
    tune_streams(stream.sparkSession)

    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    writer = stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def latest_rows(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Current state of an updated aggregate: the newest batch's row per key."""
    return keep_last(spark.read.parquet(path), keys, ["batch"]).drop("batch")


def last_batch(spark: SparkSession, path: str) -> DataFrame:
    """The newest batch of a complete-mode aggregate, which holds the whole result."""
    batches = spark.read.parquet(path)
    newest = batches.agg(F.max("batch").alias("b")).scalar()
    return batches.where(F.col("batch") == newest).drop("batch")
