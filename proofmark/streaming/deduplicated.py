"""A log under replay as three tables: what is kept, what repeats it, and what came too late."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from proofmark.operators.ranking import keep_first
from proofmark.streaming.run import tune_streams

KINDS = ("kept", "repeated", "late")
_DAY = 86_400_000
_NO_DAY = -999_999_999  # an empty folder that is always there


def split_log(
    log: DataFrame, path: str, checkpoint: str, key: str = "request_id", time_col: str = "ts", lateness_minutes: int = 5, available_now: bool = False,
) -> StreamingQuery:
    """Write every row of a live log to exactly one of ``path``/kept, /repeated and /late.

    A row is late if its time lies behind the watermark, the greatest time of earlier batches less the lateness; ``late_ms`` says
    by how much. Of the others, the first of a key is kept and later ones are repeats; keys are remembered for as long as the
    watermark has not passed their row by the lateness. A row without a time is late with a null ``late_ms``; a null key is a key.

    Kept rows lie in a folder for each day, so a batch lists and reads the days back to the horizon only, however long the log is. A
    batch that is run again replaces its own folders.
    """
    spark = log.sparkSession
    tune_streams(spark)
    lateness = lateness_minutes * 60_000
    log_schema = spark.createDataFrame([], log.schema)

    def put(rows: DataFrame, kind: str, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/{kind}/batch={batch}")

    def split(rows: DataFrame, batch: int) -> None:
        session = rows.sparkSession
        seen = session.read.schema("greatest BIGINT, batch BIGINT").parquet(f"{path}/marks") if batch else None
        newest = seen.where(F.col("batch") < batch).agg(F.max("greatest").alias("t")).first().t if batch else None
        mark = None if newest is None else newest - lateness
        timed = rows.withColumn("_ms", F.unix_millis(F.col(time_col).cast("timestamp")))
        in_time = F.col("_ms").isNotNull() if mark is None else F.coalesce(F.col("_ms") >= mark, F.lit(False))
        late_by = F.lit(None).cast("bigint") if mark is None else (F.lit(mark) - F.col("_ms")).cast("bigint")
        put(timed.where(~in_time).withColumn("late_ms", late_by).drop("_ms"), "late", batch)

        numbered = timed.where(in_time).withColumn("_row", F.monotonically_increasing_id())
        if batch and mark is not None:
            horizon = mark - lateness
            earlier = kept_since(session, path, log, horizon, newest).where(F.col("batch") < batch)
            known = earlier.where(F.unix_millis(F.col(time_col).cast("timestamp")) >= horizon).select(F.col(key).alias("_key")).distinct().withColumn("_known", F.lit(True))
            numbered = numbered.join(known, numbered[key].eqNullSafe(known["_key"]), "left").drop("_key")
        else:
            numbered = numbered.withColumn("_known", F.lit(None).cast("boolean"))
        numbered.persist()
        try:
            new = numbered.where(F.col("_known").isNull())
            first = keep_first(new, [key], ["_ms", "_row"])
            repeats = new.join(first.select("_row"), "_row", "left_anti").unionByName(numbered.where("_known"))
            days = first.withColumns({"day": F.floor(F.col("_ms") / _DAY), "batch": F.lit(batch).cast("bigint")}).drop("_ms", "_row", "_known")
            if not batch:
                log_schema.write.mode("overwrite").parquet(f"{path}/kept/day={_NO_DAY}/batch=-1")
            days.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch").parquet(f"{path}/kept")
            put(repeats.select(*log.columns), "repeated", batch)
            put(numbered.agg(F.max("_ms").alias("greatest")), "marks", batch)
        finally:
            numbered.unpersist()

    writer = log.writeStream.foreachBatch(split).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def _schema(kind: str, like: DataFrame) -> str:
    more = {"kept": ["day BIGINT"], "late": ["late_ms BIGINT"], "repeated": []}[kind]
    return ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in like.schema.fields], *more, "batch BIGINT"])


def read_kind(spark: SparkSession, path: str, kind: str, like: DataFrame) -> DataFrame:
    """One of the tables with its batch, and kept rows with their day (since 1970)."""
    return spark.read.schema(_schema(kind, like)).parquet(f"{path}/{kind}")


def kept_since(spark: SparkSession, path: str, like: DataFrame, first_ms: int, last_ms: int) -> DataFrame:
    """Kept rows of the days from one time to another; no other day's folder is listed."""
    days = ",".join(map(str, [_NO_DAY, *range(first_ms // _DAY, last_ms // _DAY + 1)]))
    return spark.read.schema(_schema("kept", like)).option("basePath", f"{path}/kept").parquet(f"{path}/kept/day={{{days}}}")


def reckoning(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """Rows by batch and kind; together they are all rows that arrived."""
    parts = [read_kind(spark, path, kind, like).select("batch", F.lit(kind).alias("kind")) for kind in KINDS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("batch", "kind").agg(F.count("*").alias("n"))
