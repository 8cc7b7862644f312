"""Logical tables derived from the star-schema test tables.

Each function turns a source table into one of the logical tables the operators work on. The SQL
twins, which the result checks start from, are in ``proofmark.plans.base``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from proofmark import schemas
from proofmark.functions import text
from proofmark.functions.ordered import with_previous
from proofmark.sources.files import scan, spread

EPOCH_MS = 1704067200000  # 2024-01-01 00:00 UTC


def load(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return scan(spark, f"{sf_dir}/{name}.parquet", list(columns) or None)


def load_texts(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Documents for work on whole texts, spread over the cores."""
    return spread(load(spark, sf_dir, "documents", *columns))


def turn_pairs(conversations: DataFrame) -> DataFrame:
    """Each assistant turn whose previous turn, whatever its number, is the user's.

    Turns are spread by conversation and block of turn numbers, so an endless conversation is many tasks.
    """
    rows = conversations.select("conv_id", "turn", "role", "text")
    met = with_previous(rows, ["conv_id"], ["turn", "role"], F.floor(F.col("turn") / 1000), ["role", "text"])
    return met.where((F.col("role") == "assistant") & (F.col("prev_role") == "user")).select(
        "conv_id", "turn", F.col("prev_text").alias("question"), F.col("text").alias("answer")
    )


def traces_from_pairs(pairs: DataFrame) -> DataFrame:
    question, answer = F.col("question"), F.col("answer")
    conv, turn = F.col("conv_id"), F.col("turn")
    client = (conv * 2 + F.floor(turn / 4)).cast("string")
    return pairs.select(
        F.concat_ws("-", conv.cast("string"), turn.cast("string")).alias("trace_id"),
        conv.cast("string").alias("session_id"),
        client.alias("client_request_id"),
        F.concat(F.lit("u"), (conv % 40).cast("string")).alias("user_id"),
        (F.lit(EPOCH_MS) + conv * 600000 + turn * 1000).alias("request_ms"),
        F.when(F.length(answer) % 7 == 0, "ERROR").otherwise("OK").alias("state"),
        F.when(F.length(question) > 150, "rag_agent").otherwise("chat_agent").alias("name"),
        F.when(F.length(question) % 10 != 0, F.length(answer) * F.lit(10.0)).alias("execution_duration_ms"),
        question.alias("request"),
        answer.alias("response"),
        F.create_map(
            F.lit("environment"), F.when(F.length(question) > 100, "prod").otherwise("dev"),
            F.lit("client_request_id"), client,
        ).alias("tags"),
        F.create_map(F.lit("session"), conv.cast("string"), F.lit("user"), (conv % 40).cast("string")).alias("trace_metadata"),
    )


def traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traces_from_pairs(turn_pairs(load(spark, sf_dir, "conversations")))


SPAN_OUTPUTS = "array<struct<page_content:string,metadata:struct<doc_id:string,score:double>>>"


def with_span_array(traces_df: DataFrame, retrieved: Column | None = None) -> DataFrame:
    """Traces carrying their spans as an array: one retriever span, and chat spans when timed.

    ``retrieved`` gives the ids of the documents that the retriever span returned, in order; other spans have no outputs.
    """
    none = F.lit(None).cast(SPAN_OUTPUTS)
    if retrieved is not None:
        none_text, no_score = F.lit(None).cast("string"), F.lit(None).cast("double")
        found = F.transform(retrieved, lambda d: F.struct(none_text.alias("page_content"), F.struct(d.alias("doc_id"), no_score.alias("score")).alias("metadata"))).cast(SPAN_OUTPUTS)
    else:
        found = none
    start = F.col("request_ms") * 1000000
    millis = F.col("execution_duration_ms")
    ns = lambda share: start + (millis * share * 1000000).cast("bigint")
    span = lambda no, kind, begin, end, outputs=none: F.struct(
        F.concat(F.col("trace_id"), F.lit(f"/{no}")).alias("span_id"),
        F.lit(kind).alias("span_type"),
        begin.cast("bigint").alias("start_time_ns"),
        end.cast("bigint").alias("end_time_ns"),
        outputs.alias("outputs"),
    )
    spans = F.filter(
        F.array(
            span(1, "RETRIEVER", start, start + 2000000, found),
            F.when(millis.isNotNull(), span(2, "CHAT_MODEL", start + 2000000, ns(0.7))),
            F.when(millis > 5000, span(3, "CHAT_MODEL", ns(0.7), ns(1.0))),
        ),
        lambda s: s.isNotNull(),
    )
    return traces_df.withColumn("spans", spans)


def inference_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_from_events(load(spark, sf_dir, "events"))


def log_from_events(events: DataFrame) -> DataFrame:
    """Request log: errors are gateway blocks; ``ts`` stays so that time filters reach the files."""
    kind = F.col("event_type")
    k = F.regexp_extract("props", r"(\d+)", 1)
    blocked = kind == "error"

    def body(*turns: tuple[str, str | None]) -> Column:
        parts = []
        for role, content in turns:
            shown = F.lit("null") if content is None else F.concat(F.lit(f'"{content} '), k, F.lit('"'))
            parts.append(F.concat(F.lit(f'{{"role":"{role}","content":'), shown, F.lit("}")))
        return F.concat(F.lit('{"messages":['), F.concat_ws(",", *parts), F.lit("]}"))

    request = (
        F.when(blocked, body(("user", "write to user@example.com about item")))
        .when(kind == "purchase", body(("user", "buy item")))
        .when(kind == "click", body(("system", "be brief"), ("user", "open item")))
        .when(kind == "view", body(("user", None), ("user", "show item")))
        .otherwise(F.lit("not json"))
    )
    return events.select(
        F.col("event_id").cast("string").alias("request_id"),
        F.col("ts"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp_ms"),
        F.to_date("ts").alias("event_date"),
        F.col("user_id").cast("string").alias("user_id"),
        F.when(blocked, 400).otherwise(200).alias("status_code"),
        F.col("value").alias("execution_duration_ms"),
        request.alias("request"),
        F.when(blocked, "").otherwise(F.concat(F.lit("done "), kind, F.lit(" "), k)).alias("response"),
        F.create_map(F.lit("guardrail"), F.when(blocked, "pii")).alias("request_metadata"),
    )


def tool_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tool calls: one trace per user and day, the event type is the tool."""
    events = load(spark, sf_dir, "events")
    return events.select(
        F.concat_ws("/", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd")).alias("trace_id"),
        F.col("event_id").cast("string").alias("span_id"),
        F.lit("TOOL").alias("span_type"),
        F.col("event_type").alias("tool"),
        (F.regexp_extract("props", r"(\d+)", 1).cast("int") % 5).cast("string").alias("args"),
        (F.unix_micros(F.col("ts").cast("timestamp")) * 1000).alias("start_time_ns"),
    )


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return answers_from_documents(load_texts(spark, sf_dir, "doc_id", "text", "lang", "source"))


def answers_from_documents(docs: DataFrame) -> DataFrame:
    """One answered question per document; English answers carry a citation."""
    return docs.select(
        F.col("doc_id").cast("string").alias("record_id"),
        text.first_sentence("text").alias("question"),
        F.when(F.col("lang") == "en", F.concat(F.lit("[doc-"), F.col("doc_id").cast("string"), F.lit("] "), "text"))
        .otherwise(F.col("text"))
        .alias("outputs"),
        "lang",
        "source",
        "doc_id",
    )


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without their text, with the human labels where there are any."""
    docs = load(spark, sf_dir, "documents", "doc_id", "lang", "source", "n_chars")
    return docs.join(load(spark, sf_dir, "labels"), "doc_id", "left")


def assessment_slots() -> Column:
    """All feedback a document can have, as an array with nulls where there is none."""
    n, lang, quality, toxic = F.col("n_chars"), F.col("lang"), F.col("quality"), F.col("toxic")
    labelled = quality.isNotNull()

    def one(no: int, name: str, value: Column, source_type: str, when: Column | None = None) -> Column:
        row = F.struct(
            F.concat(F.col("doc_id").cast("string"), F.lit(f"#{no}")).alias("assessment_id"),
            F.lit(name).alias("name"),
            value.cast("string").alias("value"),
            F.lit(source_type).alias("source_type"),
            F.lit(f"{name}_v1").alias("source_id"),
            (F.lit(EPOCH_MS) + F.col("doc_id") * 60000 + no).alias("created_ms"),
        )
        return row if when is None else F.when(when, row)

    over = lambda limit: F.when(n >= limit, "yes").otherwise("no")
    return F.array(
        one(1, "correctness", over(300), "LLM_JUDGE"),
        one(2, "correctness", over(800), "LLM_JUDGE", lang == "en"),
        one(3, "suite_correctness", F.when(lang == "de", "").otherwise(over(500)), "LLM_JUDGE", lang.isin("fr", "de")),
        one(4, "human_correctness", F.when(quality == 1, "yes").otherwise("no"), "HUMAN", labelled),
        one(5, "user_helpful", F.when(toxic == 0, "true").otherwise("false"), "HUMAN", labelled),
        one(6, "satisfaction", 2 + 3 * quality - toxic, "HUMAN", labelled & (lang == "en")),
        one(7, "rubric", F.when(lang != "es", F.least(F.lit(5), 1 + F.floor(n / 1000))), "CODE"),
        one(8, "safety", F.when(toxic == 1, "no").otherwise("yes"), "CODE"),
    )


def assessed_traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trace per document with its feedback nested, as a trace store returns it."""
    return labelled_documents(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("trace_id"), "source", "lang",
        F.filter(assessment_slots(), lambda a: a.isNotNull()).alias("assessments"),
    )


def assessments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same feedback in long form, one row per assessment."""
    rows = labelled_documents(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("trace_id"), "source", "lang", F.inline(assessment_slots())
    )
    return rows.where(F.col("name").isNotNull()).withColumn("value_num", text.as_number("value"))


def graded_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two judge versions over the same answers: 1-5 grades in long form."""
    docs = load(spark, sf_dir, "documents", "doc_id", "n_chars", "lang")
    n = F.col("n_chars")
    v1 = F.least(F.lit(5), 1 + F.floor(n / 500)).cast("int")
    v2 = F.when(n < 80, F.lit(2)).otherwise(F.least(F.lit(5), 1 + F.floor(n / 1000))).cast("int")
    return docs.select(
        F.col("doc_id").cast("string").alias("record_id"),
        F.lit("rubric").alias("scorer"),
        F.explode(F.create_map(F.lit("v1"), v1, F.lit("v2"), v2)).alias("run_id", "score"),
    )


def rag_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide retrieval-run results: three verdict columns per record."""
    n = F.col("n_chars")
    return labelled_documents(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("record_id"),
        F.when(F.col("quality") == 1, "yes").when(F.col("quality") == 0, "no").alias("correctness/value"),
        F.when(F.col("lang") == "en", "yes").when(F.col("lang") != "de", "no").alias("retrieval_groundedness/value"),
        F.when(F.col("lang") != "es", F.bround((n % 101) / 100.0, 2)).alias("retrieved_document_recall/value"),
        "lang",
        "source",
    )


def feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feedback clicks, keyed by the id that the user interface knows."""
    labels = load(spark, sf_dir, "labels")
    return labels.select(
        F.col("doc_id").cast("string").alias("client_request_id"),
        F.concat(F.lit("user"), F.col("doc_id").cast("string")).alias("user_id"),
        (F.col("toxic") == 0).alias("helpful"),
        F.when(F.col("quality") == 1, F.lit(5)).alias("satisfaction"),
        F.when(F.col("quality") == 1, "good").otherwise("poor").alias("rationale"),
        (F.lit(EPOCH_MS) + F.col("doc_id") * 1000).alias("clicked_ms"),
    )


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loose evaluation rows in three shapes, before normalisation: a question, a message list, or text."""
    docs = load(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    lang = F.col("lang")
    first = text.first_sentence("text")
    message = F.array(F.struct(F.lit("user").alias("role"), first.alias("content")))
    return docs.select(
        F.col("doc_id").cast("string").alias("key"),
        F.when(lang == "en", first).alias("question"),
        F.when(lang == "fr", message).alias("messages"),
        F.when(~lang.isin("en", "fr"), F.col("source")).alias("other"),
        F.when(lang.isin("en", "es"), F.array(first)).alias("expected_facts"),
        F.when(lang != "es", first).alias("expected_response"),
        F.col("source").alias("category"),
    )


def records_of(df: DataFrame, question: Column, facts: Column, source: str, category: Column, outputs: Column | None = None) -> DataFrame:
    """Canonical evaluation records from a question and a fact array."""
    return df.select(
        F.struct(question.alias("question"), F.lit(None).cast(schemas.MESSAGES).alias("messages")).alias("inputs"),
        (outputs if outputs is not None else F.lit(None)).cast("string").alias("outputs"),
        F.struct(
            facts.cast("array<string>").alias("expected_facts"),
            F.lit(None).cast("string").alias("expected_response"),
            F.lit(None).cast("int").alias("expected_tool_calls"),
            F.lit(None).cast("array<string>").alias("guidelines"),
            F.lit(None).cast("array<struct<doc_uri:string>>").alias("expected_retrieved_context"),
        ).alias("expectations"),
        F.create_map(F.lit("source"), F.lit(source), F.lit("category"), category).alias("tags"),
    )


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long metrics of one evaluation run per document source; run numbers give the start day."""
    per_run = labelled_documents(spark, sf_dir).groupBy(F.col("source").alias("run_id")).agg(
        F.round(F.avg(F.when(F.col("n_chars") >= 300, 1.0).otherwise(0.0)), 6).alias("a"),
        F.round(F.avg("n_chars"), 6).alias("b"),
        F.round(F.avg("quality"), 6).alias("c"),
    )
    return per_run.select(
        "run_id",
        (F.regexp_extract("run_id", r"(\d+)", 1).cast("int") * 7).alias("start_day"),
        F.expr("stack(3, 'correctness/ratio_pass', a, 'length/mean', b, 'human_correctness/ratio_pass', c) AS (metric, value)"),
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tagged run per document source."""
    no = F.regexp_extract("run_id", r"(\d+)", 1).cast("int")
    layer = F.element_at(F.array(*[F.lit(x) for x in ("app", "dataset", "scorers", "gate", "feedback")]), F.pmod(no, F.lit(5)) + 1)
    return load(spark, sf_dir, "documents", "source").select(F.col("source").alias("run_id")).distinct().select(
        "run_id",
        (no * 7).alias("start_day"),
        F.create_map(
            F.lit("layer"), layer,
            F.lit("gate"), F.when(layer.isin("gate", "feedback"), "pre_deploy"),
            F.lit("environment"), F.when(no < 10, "staging").otherwise("prod"),
        ).alias("tags"),
    )
