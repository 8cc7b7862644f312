"""Code scorers: deterministic rules over outputs, traces and spans.

Column scorers return ``(value, rationale)`` Columns and share one projection. Scorers that need
other rows are jobs: DataFrame in, one verdict row per key out.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proofmark.functions import text
from proofmark.functions.ordered import with_position
from proofmark.operators.ranking import first_span

# Latency budgets in milliseconds, tool-call limit, retrieval depth.
SPAN_BUDGET_MS = 5000
TRACE_BUDGET_MS = 8000
MAX_TOOL_CALLS = 3
RETRIEVAL_DEPTH = 3


class Score(NamedTuple):
    """What a Column scorer returns."""

    value: Column
    rationale: Column


def _said(value: Column, rationale: Column | str | None = None) -> Score:
    if rationale is None:
        rationale = F.lit(None).cast("string")
    return Score(value.cast("string"), F.lit(rationale) if isinstance(rationale, str) else rationale)


def word_count(output="outputs") -> Score:
    return _said(text.word_count(output))


def has_code_block(output="outputs") -> Score:
    return _said(text.yes_no(F.contains(text.col(output), F.lit("```"))))


def has_citation(output="outputs") -> Score:
    """Bracketed citations; the rationale lists them in order."""
    found = F.regexp_extract_all(text.col(output), F.lit(text.CITATION), F.lit(0))
    return _said(text.yes_no(F.size(found) > 0), F.array_join(found, ","))


def mentions(terms: list[str], output="outputs") -> Score:
    """Whole-word, case-blind product terms; the rationale lists the distinct ones, sorted."""
    if not terms:
        return _said(F.when(text.col(output).isNotNull(), "no"), "")
    edge = r"[\p{L}\p{N}_]"
    longest_first = sorted(set(terms), key=lambda t: (-len(t), t))
    pattern = rf"(?iu)(?<!{edge})(" + "|".join(map(text.quoted, longest_first)) + rf")(?!{edge})"
    found = F.array_sort(
        F.array_distinct(
            F.transform(F.regexp_extract_all(text.col(output), F.lit(pattern), F.lit(1)), lambda t: F.lower(t))
        )
    )
    return _said(text.yes_no(F.size(found) > 0), F.array_join(found, ","))


def valid_json(output="outputs", strict: bool = False) -> Score:
    """Parses as JSON. A strict reading takes exactly one document; the other accepts two in a row. Both refuse NaN."""
    given = text.col(output)
    ok = F.try_parse_json(given).isNotNull()
    if strict:
        # Inside brackets, two documents in a row, or one with a stray comma, are no list of one.
        alone = F.try_parse_json(F.concat(F.lit("["), given, F.lit("]")))
        ok = ok & alone.isNotNull() & F.try_variant_get(alone, "$[1]", "variant").isNull() & ~F.trim(given).rlike(r",\s*$")
    return _said(F.when(ok, "yes").otherwise("no"))


_BAD = "_unparsed"


def conforms(ddl: str, required: list[str], output="outputs") -> Score:
    """Parses into the declared fields: each of its declared type or absent, the required ones being present."""
    parsed = F.from_json(text.col(output), f"{ddl}, {_BAD} STRING", {"columnNameOfCorruptRecord": _BAD})
    ok = F.try_parse_json(text.col(output)).isNotNull() & parsed.isNotNull() & parsed[_BAD].isNull()
    for name in required:
        ok = ok & parsed[name].isNotNull()
    return _said(F.when(ok, "yes").otherwise("no"))


def exact_match(expected="expected_response", output="outputs", short: int = 0) -> Score:
    """Trimmed equality; an expected text of at most ``short`` characters need only occur."""
    want, got = F.trim(text.col(expected)), F.trim(text.col(output))
    return _said(text.yes_no((want == got) | ((F.length(want) <= short) & F.contains(got, want))))


def length_between(low: int, high: int, output="outputs", unit: str = "words") -> Score:
    n = text.word_count(output) if unit == "words" else F.length(text.col(output))
    return _said(text.yes_no(n.between(low, high)), n.cast("string"))


def trace_latency(budget_ms: int = TRACE_BUDGET_MS, on_missing: str = "null") -> Score:
    """Trace time within budget; a missing time gives no verdict, or a fail on request."""
    took = F.col("execution_duration_ms")
    verdict = text.yes_no(took <= budget_ms)
    if on_missing == "fail":
        verdict = F.coalesce(verdict, F.lit("no"))
    return _said(verdict, F.when(took.isNull(), "latency missing").otherwise("measured"))


def span_latency(traces: DataFrame, spans: DataFrame, budget_ms: int = SPAN_BUDGET_MS, on_missing: str = "fail") -> DataFrame:
    """First chat-model span within budget; a trace without one fails, or has no verdict."""
    first = first_span(spans, "CHAT_MODEL").select(
        "trace_id", ((F.col("end_time_ns") - F.col("start_time_ns")) / 1e6).alias("span_ms")
    )
    verdict = text.yes_no(F.col("span_ms") <= budget_ms)
    if on_missing == "fail":
        verdict = F.coalesce(verdict, F.lit("no"))
    return traces.select("trace_id").join(first, "trace_id", "left").select(
        "trace_id", F.round("span_ms", 3).alias("span_ms"), verdict.alias("value")
    )


def retrieval_recall(expected: DataFrame, retrieved: DataFrame) -> DataFrame:
    """Share of expected documents that were retrieved, half-even to two digits.

    Both sides are rows ``(record_id, doc_id)``. They meet by one union and two aggregates, so
    neither a record nor a document needs to fit anywhere as a set. A record that expects nothing
    has no verdict.
    """
    marks = expected.select("record_id", "doc_id", F.lit(1).alias("e"), F.lit(0).alias("r")).unionByName(
        retrieved.select("record_id", "doc_id", F.lit(0).alias("e"), F.lit(1).alias("r"))
    )
    per_doc = marks.groupBy("record_id", "doc_id").agg(F.max("e").alias("e"), F.max("r").alias("r"))
    known = F.col("doc_id").isNotNull()
    n_expected = F.sum(F.when(known, F.col("e")).otherwise(0))
    n_hit = F.sum(F.when(known, F.col("e") * F.col("r")).otherwise(0))
    return per_doc.groupBy("record_id").agg(
        n_expected.alias("n_expected"),
        n_hit.alias("n_hit"),
        F.when(n_expected > 0, F.bround(n_hit / n_expected, 2)).alias("recall"),
    )


def _tool_counts(traces: DataFrame, spans: DataFrame) -> DataFrame:
    counts = spans.where(F.col("span_type") == "TOOL").groupBy("trace_id").agg(F.count("*").alias("n"))
    return traces.join(counts, "trace_id", "left").withColumn("n_calls", F.coalesce("n", F.lit(0))).drop("n")


def tool_count(traces: DataFrame, spans: DataFrame, limit: int = MAX_TOOL_CALLS) -> DataFrame:
    """ok or too_many by the number of tool calls; none is ok."""
    return _tool_counts(traces, spans).select(
        "trace_id", "n_calls", F.when(F.col("n_calls") <= limit, "ok").otherwise("too_many").alias("value")
    )


def expected_tools(traces: DataFrame, spans: DataFrame) -> DataFrame:
    """Tool calls against the expected number carried by the record."""
    return _tool_counts(traces, spans).select(
        "trace_id", "n_calls", "expected_tool_calls",
        text.yes_no(F.col("n_calls") == F.col("expected_tool_calls")).alias("value"),
    )


def tool_efficiency(traces: DataFrame, spans: DataFrame) -> DataFrame:
    """Calls are minimal: no call repeats its arguments, and not more calls than expected when known."""
    per_call = spans.where(F.col("span_type") == "TOOL").groupBy("trace_id", "tool", "args").agg(F.count("*").alias("n"))
    per_trace = per_call.groupBy("trace_id").agg(F.sum("n").alias("n_calls"), F.sum(F.col("n") - 1).alias("n_redundant"))
    calls, extra = F.coalesce("n_calls", F.lit(0)), F.coalesce("n_redundant", F.lit(0))
    ok = (extra == 0) & F.coalesce(calls <= F.col("expected_tool_calls"), F.lit(True))
    return traces.join(per_trace, "trace_id", "left").select(
        "trace_id", calls.alias("n_calls"), extra.alias("n_redundant"), text.yes_no(ok).alias("value")
    )


MINUTE_NS = 60_000_000_000


def trajectory(spans: DataFrame) -> DataFrame:
    """Ordered tool path of each trace as rows (trace_id, position, tool), positions from 0; no trace is gathered into one row."""
    calls = spans.where(F.col("span_type") == "TOOL").select("trace_id", "start_time_ns", "span_id", "tool")
    placed = with_position(calls, ["trace_id"], ["start_time_ns", "span_id"], F.floor(F.col("start_time_ns") / MINUTE_NS))
    return placed.select("trace_id", "position", "tool")


def score_trajectory(spans: DataFrame, expected: list[str]) -> DataFrame:
    """One verdict per trace: its path is the expected one, step by step. Rows trace_id, n_steps, n_matching, value."""
    same = F.col("tool") == F.get(text.listed(expected), F.col("position").cast("int"))
    steps = trajectory(spans).groupBy("trace_id").agg(F.count("*").alias("n_steps"), F.count_if(same).alias("n_matching"))
    return steps.withColumn("value", text.yes_no((F.col("n_steps") == len(expected)) & (F.col("n_matching") == len(expected))))


ALIGNED = "trace_id STRING, n_steps BIGINT, n_matched BIGINT, n_inserted BIGINT, n_skipped BIGINT"


def align_trajectory(spans: DataFrame, expected: list[str]) -> DataFrame:
    """The path of each trace against the expected one, by their longest common subsequence, so an extra step costs that step only.

    Rows trace_id, n_steps, n_matched, n_inserted (steps taken that were not expected there), n_skipped (steps expected and not
    taken), similarity (matched steps, twice, over the steps of both), value (yes if nothing is inserted or skipped). A trace
    without tool calls has no row. A path goes through a task step by step, in order, as bits of one number for the expected
    path: a trace takes no more memory the longer it is.
    """
    bits: dict[str, int] = {}
    for place, tool in enumerate(expected):
        bits[tool] = bits.get(tool, 0) | 1 << place
    full = (1 << len(expected)) - 1

    def row(trace: str | None, steps: int, state: int) -> tuple:
        matched = len(expected) - (state & full).bit_count()
        return trace, steps, matched, steps - matched, len(expected) - matched

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, steps, state = False, 0, full
        current = None
        for batch in batches:
            done = []
            for trace, tool in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not open_ or trace != current:
                    if open_:
                        done.append(row(current, steps, state))
                    open_, current, steps, state = True, trace, 0, full
                steps += 1
                kept = state & bits.get(tool, 0)
                state = ((state + kept) | (state - kept)) & full
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["trace_id", "n_steps", "n_matched", "n_inserted", "n_skipped"])
        if open_:
            last = row(current, steps, state)
            yield pa.RecordBatch.from_arrays([pa.array([last[0]], pa.string()), *[pa.array([x], pa.int64()) for x in last[1:]]], ["trace_id", "n_steps", "n_matched", "n_inserted", "n_skipped"])

    calls = spans.where((F.col("span_type") == "TOOL") & F.col("trace_id").isNotNull()).select("trace_id", "tool", "start_time_ns", "span_id")
    ordered = calls.repartition("trace_id").sortWithinPartitions("trace_id", "start_time_ns", "span_id").select("trace_id", "tool")
    both = F.col("n_steps") + F.lit(len(expected))
    return ordered.mapInArrow(walk, ALIGNED).withColumns({
        "similarity": F.round(2 * F.col("n_matched") / both, 6), "value": text.yes_no((F.col("n_inserted") == 0) & (F.col("n_skipped") == 0)),
    })


def label_policy(output="outputs", question="question", off_topic: tuple[str, ...] = (), concepts: tuple[str, ...] = (), short: int = 80) -> Column:
    """Rule that stands in for a human label: short, off-topic, then concept; first match decides."""
    out, asked = text.col(output), text.col(question)
    return (
        F.when(out.isNull() | (F.length(out) < short), "no")
        .when(text.contains_any(F.coalesce(asked, F.lit("")), list(off_topic)), "no")
        .when(text.contains_any(out, list(concepts)), "yes")
        .otherwise("no")
    )


def long_scores(df: DataFrame, key: str, scorers: dict[str, Score]) -> DataFrame:
    """All Column scorers in one pass, as rows ``key, name, value, rationale``."""
    rows = F.array(
        *[F.struct(F.lit(n).alias("name"), s.value.alias("value"), s.rationale.alias("rationale")) for n, s in scorers.items()]
    )
    return df.select(key, F.inline(rows))
