"""Guardrails over request tables: ordered checks, a status code and the name of the rule that fired."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proofmark.functions import text


def detect_pii(df: DataFrame, column: str) -> DataFrame:
    """Which kinds of personal data the text holds."""
    kinds = {f"has_{kind}": text.yes_no(text.has_pii(column, kind)) for kind in text.PII_PATTERNS}
    return df.withColumns({**kinds, "first_kind": text.first_pii_kind(column)})


def unsafe(column: str, lexicon: list[str]) -> Column:
    """Does the text use a word or a phrase of the lexicon?"""
    return text.uses_term(column, lexicon)


def has_keyword(column: str, keywords: list[str]) -> Column:
    return text.contains_any(column, keywords)


def off_topic(column: str, topics: list[str]) -> Column:
    """No allowed topic is mentioned. Without a list of topics, nothing is off topic."""
    return ~text.contains_any(column, topics) if topics else F.lit(False)


def apply_guardrails(
    requests: DataFrame,
    keywords: list[str],
    topics: list[str],
    lexicon: list[str],
    input_safety: bool = False,
) -> DataFrame:
    """Run the checks in order, input before output; the first that fires names the block. An empty list is a check not asked for.

    Every check is a Column on the row, so this runs in one stateless pass, batch or stream.
    """
    checks: list[tuple[str, Column]] = [("pii", text.first_pii_kind("request").isNotNull())]
    if input_safety:
        checks.append(("input_safety", unsafe("request", lexicon)))
    checks += [
        ("keyword", has_keyword("request", keywords)),
        ("topic", off_topic("request", topics)),
        ("output_safety", unsafe("response", lexicon)),
    ]
    fired = F.coalesce(*[F.when(hit, F.lit(name)) for name, hit in checks])
    guarded = requests.withColumn("guardrail", fired)
    blocked = F.col("guardrail").isNotNull()
    return guarded.withColumns(
        {
            "status_code": F.when(blocked, 400).otherwise(200),
            "response": F.when(~blocked, F.col("response")),
            "request_metadata": F.create_map(F.lit("guardrail"), F.col("guardrail")),
        }
    )


def guardrail_hits(log: DataFrame) -> DataFrame:
    """Which guardrail fired, how often."""
    return log.groupBy(F.col("request_metadata")["guardrail"].alias("guardrail"), "status_code").agg(F.count("*").alias("n"))
