"""Set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proofmark.operators.ranking import keep_first


def stack_runs(*runs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), runs)


def hybrid_union(synthetic: DataFrame, production: DataFrame, edge: DataFrame) -> DataFrame:
    """Three sources of one record schema."""
    return stack_runs(synthetic, production, edge)


def dedupe_questions(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Keep the first row per question, in a stated order."""
    return keep_first(df, [key], order)


def ordered_array_dedupe(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.array_distinct(column))


def array_overlap(df: DataFrame, a: str, b: str, into: str = "overlap") -> DataFrame:
    return df.withColumn(into, F.array_intersect(a, b))
