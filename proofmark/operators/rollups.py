"""Traffic figures from hourly rows that can be added up: counts, and sketches of latencies and users.

The log is read once, when its hours are written. Days and weeks come from the hourly rows: counts are exact, a percentile lies
within ``RANK_ERROR`` of the asked rank, a number of users within a few times ``USERS_ERROR``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Size of the latency sketch: up to so many requests it is exact, beyond that a rank is off by this share of them, nearly always.
KLL_SIZE = 4096
RANK_ERROR = 0.002
#: Size of the user sketch, as a power of two, and the standard error of its estimate.
HLL_BITS = 14
USERS_ERROR = 0.0082

HOUR_MS = 3_600_000
HOURS = "hour_ms BIGINT, total_requests BIGINT, blocked BIGINT, timed BIGINT, latencies BINARY, users BINARY, day DATE"


def hourly(log: DataFrame) -> DataFrame:
    """One row an hour (HOURS): counts, a sketch of the latencies that are known, and one of the users. Rows without a time are left out."""
    hour = (F.floor(F.col("timestamp_ms") / HOUR_MS) * HOUR_MS).cast("bigint")
    latency = F.col("execution_duration_ms").cast("double")
    known = F.when(~F.isnan(latency), latency)
    return log.where(F.col("timestamp_ms").isNotNull()).groupBy(hour.alias("hour_ms")).agg(
        F.count("*").alias("total_requests"), F.count_if(~F.col("status_code").eqNullSafe(F.lit(200))).alias("blocked"), F.count(known).alias("timed"),
        F.call_function("kll_sketch_agg_double", known, F.lit(KLL_SIZE)).alias("latencies"),
        F.hll_sketch_agg(F.col("user_id").cast("string"), HLL_BITS).alias("users"),
    ).withColumn("day", F.to_date(F.timestamp_millis("hour_ms")))


def write_hours(log: DataFrame, path: str) -> DataFrame:
    """Write the hours of a log of whole days, a folder each day; days written before are replaced. Returns all hours."""
    hourly(log).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)
    return read_hours(log.sparkSession, path)


def read_hours(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(HOURS).parquet(path)


def _quantile(sketch: str, share: float) -> Column:
    return F.when(F.col("timed") > 0, F.call_function("kll_sketch_get_quantile_double", F.col(sketch), F.lit(share)))


def rolled_up(hours: DataFrame, unit: str = "day") -> DataFrame:
    """Figures by day, week or month (the date it begins) from hourly rows; the log is not read."""
    begin = F.to_date(F.date_trunc(unit, F.timestamp_millis("hour_ms")))
    merged = hours.groupBy(begin.alias("begin")).agg(
        F.sum("total_requests").alias("total_requests"), F.sum("blocked").alias("blocked"), F.sum("timed").alias("timed"),
        F.call_function("kll_merge_agg_double", F.when(F.col("timed") > 0, F.col("latencies")), F.lit(KLL_SIZE)).alias("_latencies"),
        F.hll_union_agg("users").alias("_users"),
    )
    return merged.select(
        "begin", "total_requests", "blocked", F.round(F.col("blocked") / F.col("total_requests"), 6).alias("blocked_share"),
        _quantile("_latencies", 0.5).alias("latency_p50_ms"), _quantile("_latencies", 0.95).alias("latency_p95_ms"),
        F.hll_sketch_estimate("_users").alias("n_users"),
    )
