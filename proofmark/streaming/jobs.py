"""Streaming operators. Stateless ones are the batch operators, applied to a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from proofmark import schemas
from proofmark.operators.guardrails import apply_guardrails
from proofmark.operators.metrics import traffic_health
from proofmark.operators.monitoring import Registry, as_assessments, monitor_batch
from proofmark.operators.ranking import keep_first
from proofmark.operators.scorers import Score
from proofmark.streaming.run import tune_streams

LATENESS = "5 minutes"


def _event_time(df: DataFrame, column: str) -> DataFrame:
    """Watermarks need an instant: a zone-less time is read as UTC."""
    return df.withColumn(column, F.col(column).cast("timestamp"))


def health_stream(log: DataFrame, size: str, slide: str | None = None, time_col: str = "ts", lateness: str = LATENESS) -> DataFrame:
    """Traffic health per tumbling or sliding window of a live log."""
    live = _event_time(log, time_col).withWatermark(time_col, lateness)
    window = F.window(time_col, size, slide) if slide else F.window(time_col, size)
    return traffic_health(live, window.alias("w")).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        "total_requests", "passed", "blocked_or_errored", "latency_p50_ms", "latency_p95_ms",
    )


def window_counts(log: DataFrame, size: str, time_col: str = "ts", lateness: str | None = LATENESS) -> DataFrame:
    """Requests per window; the same plan for a stream and, without lateness, for a batch."""
    rows = _event_time(log, time_col)
    if lateness:
        rows = rows.withWatermark(time_col, lateness)
    return rows.groupBy(F.window(time_col, size).alias("w")).agg(F.count("*").alias("n")).select(
        F.col("w.start").alias("window_start"), "n"
    )


def session_stream(events: DataFrame, user: str, gap: str, time_col: str = "ts", lateness: str = LATENESS) -> DataFrame:
    """Sessions by silence, for traffic that carries no session id."""
    live = _event_time(events, time_col).withWatermark(time_col, lateness)
    return live.groupBy(user, F.session_window(time_col, gap).alias("w")).agg(F.count("*").alias("n")).select(
        user, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n"
    )


def dedupe_stream(log: DataFrame, key: str = "request_id", time_col: str = "ts", lateness: str = LATENESS) -> DataFrame:
    """One row per request under replay; the state forgets ids older than the lateness."""
    return _event_time(log, time_col).withWatermark(time_col, lateness).dropDuplicatesWithinWatermark([key])


def feedback_stream(feedback: DataFrame, traces: DataFrame, within: str = "1 hour", lateness: str = LATENESS) -> DataFrame:
    """Clicks meet their trace; the time bound lets both sides' state expire."""
    clicks = _event_time(feedback, "clicked_at").withWatermark("clicked_at", lateness).alias("f")
    asked = _event_time(traces, "request_time").withWatermark("request_time", lateness).alias("t")
    bound = F.expr(
        f"f.client_request_id = t.client_request_id AND f.clicked_at >= t.request_time AND f.clicked_at <= t.request_time + INTERVAL {within}"
    )
    return clicks.join(asked, bound, "inner").select("t.trace_id", "f.client_request_id", "f.helpful", "f.clicked_at")


def guard_stream(requests: DataFrame, keywords: list[str], topics: list[str], lexicon: list[str]) -> DataFrame:
    """Guardrails on live requests: the batch operator as it is."""
    return apply_guardrails(requests, keywords, topics, lexicon)


def monitor_stream(
    traces: DataFrame, registry: Registry, scorers: dict[str, Callable[[], Score]], time_col: str = "request_time", lateness: str = LATENESS
) -> DataFrame:
    """Registered scorers on live traces: repeats are dropped, then the batch monitor's projection runs.

    What arrives behind the watermark is dropped as well; ``monitor_to_feedback`` scores it.
    """
    return monitor_batch(dedupe_stream(traces, "trace_id", time_col, lateness), registry, scorers)


def monitor_to_feedback(
    traces: DataFrame, registry: Registry, scorers: dict[str, Callable[[], Score]], path: str, checkpoint: str,
    time_col: str = "request_time", available_now: bool = False,
) -> StreamingQuery:
    """Registered scorers on live traces, written to a feedback table that loses nothing and doubles nothing.

    Each batch is scored whole, late traces included. A (trace, scorer) that the table already holds gets no second row,
    whatever time stamp the replay carries. A batch that is run again replaces its own directory.
    """
    tune_streams(traces.sparkSession)

    def write(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        once = keep_first(rows, ["trace_id"], [time_col])
        scored = monitor_batch(once, registry, scorers, carry=[time_col])
        feedback = as_assessments(scored, F.unix_millis(F.col(time_col).cast("timestamp")))
        if batch:
            given = spark.read.schema(f"{schemas.ASSESSMENTS}, batch BIGINT").parquet(path).where(F.col("batch") < batch)
            feedback = feedback.join(given.select("trace_id", "name"), ["trace_id", "name"], "left_anti").select(*feedback.columns)
        feedback.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    writer = traces.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def reconcile(streamed: DataFrame, batch: DataFrame, key: str = "window_start") -> DataFrame:
    """Rows per window that a stream counted against a later batch count; the gap was lost to lateness."""
    left = streamed.select(key, F.col("n").alias("n_streamed"))
    right = batch.select(key, F.col("n").alias("n_batch"))
    counted, true = F.coalesce("n_streamed", F.lit(0)), F.coalesce("n_batch", F.lit(0))
    return left.join(right, key, "full_outer").select(key, counted.alias("n_streamed"), true.alias("n_batch"), (true - counted).alias("n_lost"))
