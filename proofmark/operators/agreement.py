"""Judge-versus-human agreement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proofmark.operators.metrics import share


def _last_value(name: str):
    """Latest value of one assessment name within a trace, by creation time then id."""
    at = F.when(F.col("name") == name, F.struct("created_ms", "assessment_id"))
    return F.max_by("value", at)


def judge_human_pairs(assessments: DataFrame, judges: list[str], human: str) -> DataFrame:
    """Judge and human verdict side by side per trace.

    The first judge name with a non-empty value wins; traces lacking either verdict drop out. One
    partial aggregate, no sort and no window.
    """
    wanted = assessments.where(F.col("name").isin(*judges, human))
    per_trace = wanted.groupBy("trace_id").agg(
        *[_last_value(j).alias(f"_j{i}") for i, j in enumerate(judges)], _last_value(human).alias("human")
    )
    judge = F.coalesce(*[F.nullif(F.col(f"_j{i}"), F.lit("")) for i in range(len(judges))])
    return per_trace.select("trace_id", judge.alias("judge"), "human").where(
        F.col("judge").isNotNull() & F.col("human").isNotNull()
    )


def confusion_matrix(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("judge", "human").agg(F.count("*").alias("n"))


def agreement_rate(pairs: DataFrame) -> DataFrame:
    return pairs.agg(F.count("*").alias("n_pairs"), F.round(F.avg((F.col("judge") == F.col("human")).cast("double")), 6).alias("agreement"))


def graded_agreement(pairs: DataFrame) -> DataFrame:
    """Exact and within-one shares for graded scores."""
    gap = F.abs(F.col("judge") - F.col("human"))
    return pairs.agg(F.count("*").alias("n_pairs"), share(gap == 0).alias("exact_match"), share(gap <= 1).alias("within_1"))


def cohens_kappa(pairs: DataFrame) -> DataFrame:
    """Chance-adjusted agreement; null when chance agreement is certain.

    Works on the confusion counts, whose size is the square of the label alphabet.
    """
    cells = confusion_matrix(pairs)
    sides = cells.select(
        F.explode(
            F.array(
                F.struct(F.col("judge").alias("label"), F.col("n").alias("nj"), F.lit(0).cast("bigint").alias("nh"), F.when(F.col("judge") == F.col("human"), F.col("n")).otherwise(0).alias("same")),
                F.struct(F.col("human").alias("label"), F.lit(0).cast("bigint").alias("nj"), F.col("n").alias("nh"), F.lit(0).cast("bigint").alias("same")),
            )
        ).alias("s")
    ).select("s.*")
    marginals = sides.groupBy("label").agg(F.sum("nj").alias("nj"), F.sum("nh").alias("nh"), F.sum("same").alias("same"))
    total = marginals.agg(
        F.sum("nj").alias("n_pairs"), F.sum("same").alias("same"), F.sum(F.col("nj").cast("double") * F.col("nh")).alias("chance")
    )
    observed = F.try_divide(F.col("same"), F.col("n_pairs"))
    expected = F.try_divide(F.col("chance"), F.col("n_pairs").cast("double") * F.col("n_pairs"))
    return total.select(
        "n_pairs",
        F.round(observed, 6).alias("observed"),
        F.round(expected, 6).alias("expected"),
        F.round(F.when(expected < 1, (observed - expected) / (1 - expected)), 6).alias("kappa"),
    )


def canary_compare(assessments: DataFrame, v1: str, v2: str) -> DataFrame:
    """Two judge versions on the same traces: pairs, agreement, and how far the pass shares differ."""
    per_trace = (
        assessments.where(F.col("name").isin(v1, v2))
        .groupBy("trace_id")
        .agg(_last_value(v1).alias("a"), _last_value(v2).alias("b"))
        .where(F.col("a").isNotNull() & F.col("b").isNotNull())
    )
    pass_a, pass_b = share(F.col("a") == "yes"), share(F.col("b") == "yes")
    return per_trace.agg(
        F.count("*").alias("n_pairs"),
        share(F.col("a") == F.col("b")).alias("agreement"),
        pass_a.alias("pass_v1"),
        pass_b.alias("pass_v2"),
        F.round(pass_b - pass_a, 6).alias("delta"),
    )
