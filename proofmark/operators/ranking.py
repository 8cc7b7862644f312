"""Order-dependent operators: latest rows, first spans, progressions, rate limits, top-n.

"Keep the first / last per key" is a ``min_by`` / ``max_by`` aggregate, which combines before the
shuffle; windows are used only where the group is bounded by construction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from proofmark.functions import text
from proofmark.functions.ordered import with_previous
from proofmark.operators.filters import first_user_message, recent_requests, successful_requests


def keep_first(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """One row per key: the first in ``order``."""
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(first.alias("_r")).select(*keys, "_r.*").select(*df.columns)


def keep_last(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """One row per key: the last in ``order``."""
    rest = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(last.alias("_r")).select(*keys, "_r.*").select(*df.columns)


def latest_distinct_questions(log: DataFrame, pull: int = 50, n: int = 10) -> DataFrame:
    """Newest distinct questions: pull the newest successful requests, then drop repeats, then cut.

    The cut to ``pull`` rows comes first, so what follows works on at most that many rows.
    """
    pulled = recent_requests(successful_requests(log).select("request_id", "timestamp_ms", "status_code", "request"), pull)
    asked = pulled.withColumn("question", first_user_message("request")).where(F.col("question").isNotNull())
    newest = keep_last(asked.select("question", "timestamp_ms", "request_id"), ["question"], ["timestamp_ms", "request_id"])
    return newest.orderBy(F.desc("timestamp_ms"), F.desc("request_id")).limit(n)


def latest_assessment(assessments: DataFrame) -> DataFrame:
    """The last value of each scorer on each trace."""
    return keep_last(assessments, ["trace_id", "name"], ["created_ms", "assessment_id"])


def first_span(spans: DataFrame, span_type: str) -> DataFrame:
    """The earliest span of a type per trace."""
    return keep_first(spans.where(F.col("span_type") == span_type), ["trace_id"], ["start_time_ns", "span_id"])


def version_progression(run_metrics: DataFrame) -> DataFrame:
    """Change of each metric from run to run, oldest first. Runs are spread by month within a metric."""
    bucket = F.floor(F.col("start_day") / 30)
    return with_previous(run_metrics, ["metric"], ["start_day", "run_id"], bucket, ["value"]).withColumn(
        "change", F.round(F.col("value") - F.col("prev_value"), 6)
    )


SLICES = 50  # parts of the rate-limit span; divides every whole number of seconds


SLICES_PER_BLOCK = 20 * SLICES


def rate_limit(log: DataFrame, n: int, seconds: int, slices_per_span: int = SLICES) -> DataFrame:
    """Requests beyond ``n`` within the trailing ``seconds`` of the same user, both ends included.

    A window over a user would put one busy user into one task. Time is cut into slices instead, and
    a trailing count is the sum of three parts: the request's own slice so far, the whole slices
    before it (from per-slice counts), and the late end of the slice one span earlier. The last part
    comes from showing each request to the slice one span later as well, so a window group holds two
    slices of one user; a caller with busier users takes more slices. Per-slice counts are summed within
    blocks of slices, the end of each block being shown to the next, so they are spread by time too.
    """
    span = seconds * 1000
    count, width = slices_per_span, span // slices_per_span
    length = count * (SLICES_PER_BLOCK // SLICES)
    slices = log.select("request_id", "user_id", "timestamp_ms", F.floor(F.col("timestamp_ms") / width).alias("_slice"))

    per_slice = slices.groupBy("user_id", "_slice").agg(F.count("*").alias("_n"))
    block = F.floor(F.col("_slice") / length)
    late = F.col("_slice") >= (block + 1) * length - count
    blocks = per_slice.withColumn("_block", F.explode(F.when(late, F.array(block, block + 1)).otherwise(F.array(block))))
    before = Window.partitionBy("user_id", "_block").orderBy("_slice").rangeBetween(-(count - 1), -1)
    summed = blocks.withColumn("_whole", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    whole = summed.where(F.col("_block") == block).select("user_id", "_slice", "_whole")

    shown = slices.withColumn("_old", F.explode(F.array(F.lit(0), F.lit(1)))).withColumns(
        {"_slice": F.col("_slice") + F.col("_old") * count, "_at": F.col("timestamp_ms") + F.col("_old") * span}
    )
    group = Window.partitionBy("user_id", "_slice").orderBy("_at")
    so_far = F.sum(1 - F.col("_old")).over(group.rangeBetween(Window.unboundedPreceding, 0))
    # "From here to the end" as all less those before: Spark grows a frame from the start in one pass,
    # but makes one that shrinks towards the end anew for every row.
    all_old = F.sum("_old").over(group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    gone = F.coalesce(F.sum("_old").over(group.rangeBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counted = shown.withColumn("_ends", so_far + all_old - gone).where(F.col("_old") == 0)
    return (
        counted.join(whole, ["user_id", "_slice"], "inner")
        .withColumn("n_recent", F.col("_ends") + F.col("_whole"))
        .where(F.col("n_recent") > n)
        .select("request_id", "user_id", "timestamp_ms", "n_recent")
    )


def redundant_tool_calls(spans: DataFrame) -> DataFrame:
    """Tools called again with the same arguments on the same trace."""
    return (
        spans.where(F.col("span_type") == "TOOL")
        .groupBy("trace_id", "tool", "args")
        .agg(F.count("*").alias("calls"), F.min("start_time_ns").alias("first_ns"))
        .where(F.col("calls") > 1)
        .withColumn("redundant", F.col("calls") - 1)
    )


def worst_rows(results: DataFrame, scorers: list[str], n: int) -> DataFrame:
    """Rows with most failed scorers, and which ones failed."""
    failed = F.filter(
        F.array(*[F.when(text.not_yes(F.col(f"`{s}/value`")), F.lit(s)) for s in scorers]), lambda s: s.isNotNull()
    )
    return (
        results.select("record_id", failed.alias("_f"))
        .select("record_id", F.size("_f").alias("n_failed"), F.array_join("_f", ",").alias("failed"))
        .orderBy(F.desc("n_failed"), "record_id")
        .limit(n)
    )


def search_runs(runs: DataFrame, where: str | Column, n: int = 10) -> DataFrame:
    return runs.where(where).orderBy(F.desc("start_day"), "run_id").limit(n)
