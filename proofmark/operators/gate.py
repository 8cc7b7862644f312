"""Quality gate: metrics against floors, verdict, audit and run comparison."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from proofmark import schemas
from proofmark.sources.files import small_table

# Largest value a metric of the scale can reach.
SCALE_TOP = {"ratio": 1.0, "yes_no": 1.0, "1-5": 5.0}


class QualityGateFailed(Exception):
    """Raised when a gate that must hold does not."""


def thresholds(spark: SparkSession, floors: dict[str, tuple[float, str]]) -> DataFrame:
    """Floors with their scale; a floor that its scale can never reach is refused."""
    for metric, (floor, scale) in floors.items():
        if floor > SCALE_TOP[scale]:
            raise ValueError(f"{metric}: floor {floor} lies above the {scale} scale")
    rows = [(metric, float(floor), scale) for metric, (floor, scale) in floors.items()]
    return small_table(spark, rows, schemas.THRESHOLDS)


def stored_metrics(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """(metric, value) that a run has stored (``files.write_json``): what a later gate reads instead of scoring again."""
    return spark.read.schema("metric STRING, value DOUBLE, run_id STRING").json(path).where(F.col("run_id") == run_id).select("metric", "value")


def threshold_join(metrics: DataFrame, floors: DataFrame) -> DataFrame:
    """Each floor with its observed value and state. A NaN counts as missing."""
    joined = floors.join(metrics.select("metric", F.col("value").alias("observed")), "metric", "left")
    known = F.col("observed").isNotNull() & ~F.isnan("observed")
    state = F.when(~known, "missing").when(F.col("observed") < F.col("floor"), "below").otherwise("ok")
    return joined.select("metric", "floor", "observed", state.alias("state"))


def evaluate_gate(metrics: DataFrame, floors: DataFrame, digits: int = 3) -> DataFrame:
    """Failure messages; no rows means that the gate passes."""
    checked = threshold_join(metrics, floors)
    message = F.when(F.col("state") == "missing", F.format_string("%s: MISSING", "metric")).otherwise(
        F.format_string(f"%s: %.{digits}f < threshold %s", "metric", "observed", F.col("floor").cast("string"))
    )
    return checked.where(F.col("state") != "ok").select("metric", message.alias("message"))


def gate_verdict(failures: DataFrame) -> DataFrame:
    """One row: passed or not, and the sorted messages. There are at most as many as floors."""
    messages = F.array_join(F.array_sort(F.collect_list("message")), "; ")
    return failures.agg(
        F.when(F.count("*") == 0, "true").otherwise("false").alias("passed"),
        F.count("*").alias("n_failures"),
        messages.alias("failures"),
    )


def enforce(verdict: DataFrame) -> None:
    """Stop the job on a failed verdict (one row, collected)."""
    row = verdict.first()
    if row.passed != "true":
        raise QualityGateFailed(row.failures)


def gate_by_run(run_metrics: DataFrame, floors: dict[str, float]) -> DataFrame:
    """Verdict of every run against the same short list of floors, from one aggregate."""
    def failed(metric: str, floor: float) -> Column:
        observed = F.max(F.when(F.col("metric") == metric, F.col("value")))
        return (observed.isNull() | F.isnan(observed) | (observed < floor)).cast("int")

    n_failures = reduce(lambda a, b: a + b, [failed(m, f) for m, f in floors.items()])
    return run_metrics.groupBy("run_id").agg(n_failures.alias("n_failures")).withColumn(
        "passed", F.when(F.col("n_failures") == 0, "true").otherwise("false")
    )


def gate_audit(runs: DataFrame, verdicts: DataFrame, n: int = 10) -> DataFrame:
    """Gate runs with their verdict, newest first."""
    gates = runs.where(F.col("tags")["gate"] == "pre_deploy")
    return (
        gates.join(verdicts, "run_id", "left")
        .select("run_id", "start_day", F.col("tags")["environment"].alias("environment"), "passed", "n_failures")
        .orderBy(F.desc("start_day"), "run_id")
        .limit(n)
    )


def loop_audit(runs: DataFrame) -> DataFrame:
    """All runs of the improvement loop, by layer and time."""
    return runs.select(F.col("tags")["layer"].alias("layer"), "run_id", "start_day").orderBy("layer", "start_day", "run_id")


def run_compare(run_metrics: DataFrame, base: str, candidate: str) -> DataFrame:
    """Metric values of two runs and their difference, from one aggregate."""
    def of(run: str):
        return F.max(F.when(F.col("run_id") == run, F.col("value")))

    return (
        run_metrics.where(F.col("run_id").isin(base, candidate))
        .groupBy("metric")
        .agg(of(base).alias("base"), of(candidate).alias("candidate"))
        .withColumn("delta", F.round(F.col("candidate") - F.col("base"), 6))
    )


def regressions(run_metrics: DataFrame, base: str, candidate: str, tolerance: float = 0.0) -> DataFrame:
    """Metrics that the candidate lost, or dropped by more than the tolerance."""
    return run_compare(run_metrics, base, candidate).where(
        F.col("base").isNotNull() & (F.col("candidate").isNull() | (F.col("delta") < -tolerance))
    )


def drift_alerts(rollup: DataFrame, blocked_ceiling: float, latency_ceiling_ms: float, quality_floor: float) -> DataFrame:
    """Days of a roll-up that call for a look, and why."""
    reasons = F.filter(
        F.array(
            F.when(F.col("blocked_share") > blocked_ceiling, F.lit("blocked")),
            F.when(F.col("latency_p95_ms") > latency_ceiling_ms, F.lit("latency")),
            F.when(F.col("pass_rate") < quality_floor, F.lit("quality")),
        ),
        lambda r: r.isNotNull(),
    )
    return (
        rollup.withColumn("_r", reasons)
        .where(F.size("_r") > 0)
        .select("day", "total_requests", F.array_join("_r", ",").alias("reasons"))
    )
