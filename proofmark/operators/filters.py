"""Projections, filters and predicates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proofmark import schemas
from proofmark.functions import text

DAY_MS = 86_400_000


def search_traces(traces: DataFrame, where: str | Column, order_by: list[Column], n: int) -> DataFrame:
    """The ``n`` first traces that satisfy a predicate; planned as a distributed top-n."""
    return traces.where(where).orderBy(*order_by).limit(n)


def filter_by_tag(traces: DataFrame, key: str, values: list[str]) -> DataFrame:
    return traces.where(F.col("tags")[key].isin(values))


def filter_by_session(traces: DataFrame, session_id: str) -> DataFrame:
    return traces.where(F.col("trace_metadata")["session"] == session_id)


def payload_preview(log: DataFrame, n: int = 200, columns: tuple[str, ...] = ("request", "response")) -> DataFrame:
    shown = [F.substring(c, 1, n).alias(f"{c}_preview") for c in columns]
    return log.select("request_id", "status_code", *shown)


def recent_window(log: DataFrame, as_of_ms: int, hours: int = 24, time_col: str = "timestamp_ms") -> DataFrame:
    """Rows strictly newer than ``as_of_ms - hours``.

    The raw column is compared with a literal of its own type, so the bound reaches the file scan.
    """
    bound = as_of_ms - hours * 3_600_000
    if time_col == "timestamp_ms":
        return log.where(F.col(time_col) > bound)
    kind = log.schema[time_col].dataType.typeName()
    literal = F.timestamp_millis(F.lit(bound))
    return log.where(F.col(time_col) > literal.cast(kind))


def successful_requests(log: DataFrame) -> DataFrame:
    return log.where(F.col("status_code") == 200)


def blocked_requests(log: DataFrame, n: int = 5) -> DataFrame:
    """The newest blocked requests with their raw payloads."""
    return (
        log.where(F.col("status_code") != 200)
        .orderBy(F.desc("timestamp_ms"), F.desc("request_id"))
        .limit(n)
        .select("request_id", "timestamp_ms", "status_code", "request", "response")
    )


def recent_requests(log: DataFrame, n: int) -> DataFrame:
    return log.orderBy(F.desc("timestamp_ms"), F.desc("request_id")).limit(n)


def user_message(content: Column) -> Column:
    """A one-turn message list."""
    return F.array(F.struct(F.lit("user").alias("role"), content.cast("string").alias("content")))


def reshape_to_chat(records: DataFrame, question="question", messages="messages", other="other") -> DataFrame:
    """Chat inputs: a message list stays, a question is wrapped, anything else is wrapped as text."""
    chat = F.coalesce(
        F.col(messages),
        F.when(F.col(question).isNotNull(), user_message(F.col(question))),
        user_message(F.col(other)),
    )
    return records.withColumn("chat", chat)


def first_user_message(payload) -> Column:
    """Content of the first user turn of a JSON chat body; null when there is none or on bad JSON."""
    body = F.from_json(text.col(payload), schemas.CHAT_BODY)
    return F.get(F.filter(body["messages"], lambda m: m["role"] == "user"), F.lit(0))["content"]


def normalise_records(df: DataFrame, source: str | Column) -> DataFrame:
    """Coerce loose rows into ``inputs / expectations / tags``.

    ``inputs`` keeps a message list, else wraps whatever text there is as the question. A lone
    expected response becomes the single expected fact when no facts are given.
    """
    question = F.when(F.col("messages").isNull(), F.coalesce("question", "other"))
    facts = F.coalesce(
        "expected_facts", F.when(F.col("expected_response").isNotNull(), F.array("expected_response"))
    )
    source = F.lit(source) if isinstance(source, str) else source
    return df.select(
        "key",
        F.struct(question.alias("question"), F.col("messages")).alias("inputs"),
        F.struct(facts.alias("expected_facts")).alias("expectations"),
        F.create_map(F.lit("source"), source, F.lit("category"), F.col("category")).alias("tags"),
    )


def record_id(inputs: Column) -> Column:
    """Identity of an evaluation record: its inputs."""
    return F.sha2(F.to_json(inputs), 256)


def failing_rows(results: DataFrame, scorers: list[str]) -> DataFrame:
    """Rows on which any chosen scorer is not yes; a missing verdict counts as not yes."""
    return results.where(reduce(lambda a, b: a | b, [text.not_yes(F.col(f"`{s}/value`")) for s in scorers]))


def _pillars(results: DataFrame) -> DataFrame:
    return results.select(
        "*",
        F.col("`correctness/value`").alias("correctness"),
        F.col("`retrieval_groundedness/value`").alias("groundedness"),
        F.col("`retrieved_document_recall/value`").alias("recall"),
    )


def retrieval_misses(results: DataFrame, low: float = 0.5) -> DataFrame:
    """Wrong but grounded answers with low recall; rows lacking a verdict drop out."""
    return _pillars(results).where(
        (F.col("correctness") != "yes") & (F.col("groundedness") == "yes") & (F.col("recall") < low)
    )


def hallucinations(results: DataFrame, low: float = 0.5) -> DataFrame:
    """Answers not grounded although the right documents were retrieved."""
    return _pillars(results).where((F.col("groundedness") != "yes") & (F.col("recall") >= low))


def diagnose_rag(results: DataFrame, low: float = 0.5) -> DataFrame:
    """Name the failure mode of each row from correctness, groundedness and recall."""
    rows = _pillars(results)
    right = F.coalesce(F.col("correctness") == "yes", F.lit(False))
    grounded = F.coalesce(F.col("groundedness") == "yes", F.lit(False))
    scarce = F.col("recall") < low
    diagnosis = (
        F.when(F.col("recall").isNull(), F.when(right, "ok").otherwise("other"))
        .when(right & scarce, "lucky")
        .when(right, "ok")
        .when(grounded & scarce, "retrieval_miss")
        .when(grounded, "incomplete_answer")
        .when(~scarce, "hallucination")
        .otherwise("other")
    )
    return rows.withColumn("diagnosis", diagnosis)


def trace_to_record(traces: DataFrame, source: str = "production") -> DataFrame:
    """Evaluation records from traces: request becomes inputs, response becomes outputs."""
    inputs = F.struct(F.col("request").alias("question"), F.lit(None).cast(schemas.MESSAGES).alias("messages"))
    return traces.select(
        record_id(inputs).alias("record_id"),
        inputs.alias("inputs"),
        F.col("response").alias("outputs"),
        F.lit(None).cast(schemas.EXPECTATIONS).alias("expectations"),
        F.create_map(F.lit("source"), F.lit(source), F.lit("trace_id"), F.col("trace_id")).alias("tags"),
        F.col("request_ms"),
    )


def get_trace(traces: DataFrame, trace_id: str) -> DataFrame:
    return traces.where(F.col("trace_id") == trace_id)


def head_sample(df: DataFrame, n: int, *key: str) -> DataFrame:
    """A fixed first ``n`` rows for a smoke run."""
    return df.orderBy(*key).limit(n)


def validate_schema(records: DataFrame) -> DataFrame:
    """Rows breaking each rule of the record convention, counted in one pass."""
    question, messages = F.col("inputs.question"), F.col("inputs.messages")
    rules = {
        "null_inputs": F.col("inputs").isNull(),
        "neither_question_nor_messages": F.col("inputs").isNotNull() & question.isNull() & messages.isNull(),
        "no_expected_facts": F.coalesce(F.size("expectations.expected_facts"), F.lit(0)) <= 0,
        "missing_source_tag": F.col("tags")["source"].isNull(),
    }
    counts = records.agg(F.count("*").alias("n_rows"), *[F.count_if(c).alias(r) for r, c in rules.items()])
    pairs = ", ".join(f"'{r}', {r}" for r in rules)
    return counts.select(F.expr(f"stack({len(rules)}, {pairs}) AS (rule, violations)"), "n_rows")


def explode_spans(traces: DataFrame, span_type: str | None = None) -> DataFrame:
    spans = traces.select("trace_id", F.inline("spans"))
    return spans.where(F.col("span_type") == span_type) if span_type else spans


def explode_assessments(traces: DataFrame) -> DataFrame:
    """One row per feedback item; a trace without feedback keeps one row of nulls."""
    return traces.select("trace_id", F.inline_outer("assessments"))
