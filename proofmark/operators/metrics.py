"""Aggregations. All are mergeable (map-side combine), so a hot group costs one row per task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from proofmark.functions import text


def share(condition: Column, digits: int = 6) -> Column:
    """Share of all rows that satisfy the condition; null counts as not satisfied."""
    return F.round(F.avg(F.when(condition, 1.0).otherwise(0.0)), digits)


def mean(value: Column, digits: int = 6) -> Column:
    return F.round(F.avg(value), digits)


def pass_rate(results: DataFrame, scorers: list[str], pass_values: tuple[str, ...] = ("yes",)) -> DataFrame:
    """Pass share per scorer of a wide result, with row and scored counts, in one pass.

    A missing verdict is a fail in the share; ``n_scored`` tells how many were there.
    """
    aggs = []
    for i, s in enumerate(scorers):
        value = F.col(f"`{s}/value`")
        aggs += [share(value.isin(*pass_values)).alias(f"r{i}"), F.count(value).alias(f"c{i}")]
    wide = results.agg(F.count("*").alias("n_rows"), *aggs)
    rows = ", ".join(f"'{s}', r{i}, c{i}" for i, s in enumerate(scorers))
    return wide.select(F.expr(f"stack({len(scorers)}, {rows}) AS (scorer, pass_rate, n_scored)"), "n_rows")


def mean_score(results: DataFrame, scorer: str) -> DataFrame:
    """Mean of the numeric readings; nulls and non-numbers are ignored."""
    number = text.as_number(F.col(f"`{scorer}/value`").cast("string"))
    return results.agg(F.lit(scorer).alias("scorer"), mean(number).alias("mean_score"), F.count(number).alias("n_scored"))


def _ratio_pass(pass_values: tuple[str, ...]) -> Column:
    return share(F.col("value").isin(*pass_values))


def scorer_metrics(assessments: DataFrame, keys: tuple[str, ...] = (), pass_values: tuple[str, ...] = ("yes",)) -> DataFrame:
    """Long metrics ``<name>/mean`` and ``<name>/ratio_pass``.

    Numeric scorers have a mean; for worded verdicts yes and no read as 1 and 0. Ratio is given only
    where a worded verdict exists.
    """
    worded = F.col("value").isin("yes", "no", *pass_values)
    number = F.coalesce(text.as_number("value"), F.when(worded, F.col("value").isin(*pass_values).cast("double")))
    per_name = assessments.groupBy(*keys, "name").agg(
        mean(number).alias("mean"),
        F.when(F.count_if(worded) > 0, _ratio_pass(pass_values)).alias("ratio_pass"),
    )
    return per_name.select(
        *keys, F.expr("stack(2, concat(name, '/mean'), mean, concat(name, '/ratio_pass'), ratio_pass) AS (metric, value)")
    ).where(F.col("value").isNotNull())


def assessment_summary(assessments: DataFrame) -> DataFrame:
    """Per scorer: size including nulls, numeric mean, yes share."""
    return assessments.groupBy("name").agg(
        F.count("*").alias("n"),
        mean(text.as_number("value")).alias("mean"),
        share(F.col("value") == "yes").alias("pass_ratio"),
    )


def score_distribution(results: DataFrame) -> DataFrame:
    return results.groupBy("run_id", "score").agg(F.count("*").alias("n"))


def _health() -> list[Column]:
    passed = F.col("status_code") == 200
    return [
        F.count("*").alias("total_requests"),
        F.count_if(passed).alias("passed"),
        F.count_if(~passed).alias("blocked_or_errored"),
        F.percentile_approx("execution_duration_ms", 0.5).alias("latency_p50_ms"),
        F.percentile_approx("execution_duration_ms", 0.95).alias("latency_p95_ms"),
    ]


def traffic_health(log: DataFrame, *keys: str | Column) -> DataFrame:
    """Request counts and latency percentiles, in total or per key."""
    return log.groupBy(*keys).agg(*_health()) if keys else log.agg(*_health())


def status_mix(log: DataFrame) -> DataFrame:
    return log.groupBy("status_code").agg(F.count("*").alias("n"))


def daily_quality(assessments: DataFrame, scorer: str, day: Column) -> DataFrame:
    return (
        assessments.where(F.col("name") == scorer)
        .groupBy(day.alias("day"))
        .agg(share(F.col("value") == "yes").alias("pass_rate"), F.count("*").alias("n_scored"))
    )


def daily_rollup(log: DataFrame, assessments: DataFrame, scorer: str) -> DataFrame:
    """Per day: blocked share, p95 latency and mean quality. Both sides are aggregated before they meet."""
    traffic = log.groupBy(F.date_format("event_date", "yyyy-MM-dd").alias("day")).agg(
        F.count("*").alias("total_requests"),
        share(F.col("status_code") != 200).alias("blocked_share"),
        F.percentile_approx("execution_duration_ms", 0.95).alias("latency_p95_ms"),
    )
    return traffic.join(daily_quality(assessments, scorer, day_of_ms("created_ms")), "day", "left")


def quality_ops_join(log: DataFrame, assessments: DataFrame) -> DataFrame:
    """Operational counts beside every scorer's pass share, per day."""
    traffic = log.groupBy(F.date_format("event_date", "yyyy-MM-dd").alias("day")).agg(
        F.count("*").alias("total_requests"), F.count_if(F.col("status_code") != 200).alias("blocked")
    )
    quality = assessments.groupBy(day_of_ms("created_ms").alias("day"), "name").agg(
        F.count("*").alias("n_scored"), share(F.col("value") == "yes").alias("pass_rate")
    )
    return traffic.join(quality, "day", "left")


def day_of_ms(c) -> Column:
    return F.date_format(F.timestamp_millis(text.col(c)), "yyyy-MM-dd")


def count_by_source(records: DataFrame) -> DataFrame:
    return records.groupBy(F.col("tags")["source"].alias("source")).agg(F.count("*").alias("n")).orderBy("source")


def cohort_scores(results: DataFrame, by: list[str], value: Column) -> DataFrame:
    """Mean score by each prefix of the cohort columns, one pass."""
    return results.rollup(*by).agg(
        F.grouping_id().cast("int").alias("level"), F.count("*").alias("n"), mean(value).alias("mean_score")
    )


def coverage_by_doc(records: DataFrame) -> DataFrame:
    """Questions per cited document, most cited first."""
    return (
        records.select(F.explode("uris").alias("doc_uri"))
        .groupBy("doc_uri")
        .agg(F.count("*").alias("n_questions"))
        .orderBy(F.desc("n_questions"), "doc_uri")
    )


def run_summary(results: DataFrame, label: str, scorers: list[str], pass_values: tuple[str, ...] = ("yes",)) -> DataFrame:
    """One labelled row per run: pass share of each scorer and the row count."""
    rates = [share(F.col(f"`{s}/value`").isin(*pass_values)).alias(f"{s}_rate") for s in scorers]
    return results.agg(F.count("*").alias("n_rows"), *rates).select(F.lit(label).alias("run"), "*")


def session_summary(traces: DataFrame) -> DataFrame:
    return traces.groupBy("session_id").agg(
        F.count("*").alias("n_traces"),
        F.count_if(F.col("state") != "OK").alias("n_errors"),
        F.min("request_ms").alias("first_ms"),
        F.max("request_ms").alias("last_ms"),
        mean(F.col("execution_duration_ms")).alias("mean_latency_ms"),
    )


def rule_breakdown(rule_results: DataFrame) -> DataFrame:
    return rule_results.groupBy("scorer", "rule_id").agg(
        F.count("*").alias("n"), F.count("passed").alias("n_applied"), share(F.col("passed") == "yes").alias("pass_share")
    )


def sampled_vs_total(total: DataFrame, assessments: DataFrame) -> DataFrame:
    """Traces graded by each scorer against the number of all traces (a scalar subquery)."""
    n_total = total.agg(F.count("*").alias("n_total")).scalar()
    return (
        assessments.groupBy("name")
        .agg(F.countDistinct("trace_id").alias("n_sampled"))
        .withColumn("n_total", n_total)
        .withColumn("sampled_share", F.round(F.col("n_sampled") / F.col("n_total"), 6))
    )


def human_feedback_summary(assessments: DataFrame) -> DataFrame:
    """Thumbs-up share and mean satisfaction over human feedback."""
    human = assessments.where(F.col("source_type") == "HUMAN")
    helpful, stars = F.col("name") == "user_helpful", F.col("name") == "satisfaction"
    return human.agg(
        F.count_if(helpful).alias("n_helpful"),
        F.round(F.avg(F.when(helpful, (F.col("value") == "true").cast("double"))), 6).alias("helpful_rate"),
        F.count_if(stars).alias("n_satisfaction"),
        F.round(F.avg(F.when(stars, text.as_number("value"))), 6).alias("mean_satisfaction"),
    )


def feedback_by_source_type(assessments: DataFrame, source_types: list[str]) -> DataFrame:
    """Feedback counts per scorer, one column per source type (types are named, so no extra job)."""
    return assessments.groupBy("name").pivot("source_type", source_types).agg(F.count(F.lit(1))).na.fill(0)


def token_usage(log: DataFrame, price_per_1k: float) -> DataFrame:
    """Word-count proxy of token usage and its cost, per user and day."""
    n = text.word_count("request") + text.word_count("response")
    return log.groupBy("user_id", F.date_format("event_date", "yyyy-MM-dd").alias("day")).agg(
        F.count("*").alias("n_requests"),
        F.sum(n).alias("n_tokens"),
        F.round(F.sum(n) * price_per_1k / 1000, 6).alias("cost"),
    )


def pass_rate_trend(assessments: DataFrame, days: int = 7) -> DataFrame:
    """Pass share per scorer over a rolling span of days.

    Assessments are first cut down to one row per scorer and day, which the calendar bounds.
    """
    day_no = F.floor(F.col("created_ms") / 86_400_000)
    daily = assessments.groupBy("name", day_no.alias("day_no")).agg(
        F.count("*").alias("n"), F.count_if(F.col("value") == "yes").alias("n_yes")
    )
    span = Window.partitionBy("name").orderBy("day_no").rangeBetween(-(days - 1), 0)
    return daily.select(
        "name", "day_no", "n", F.round(F.sum("n_yes").over(span) / F.sum("n").over(span), 6).alias("rolling_pass_rate")
    )


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
