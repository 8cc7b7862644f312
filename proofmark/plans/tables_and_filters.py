"""Queries: sources, projections and filters."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from proofmark.operators import filters, joins
from proofmark.plans import base
from proofmark.plans.base import ctes, query
from proofmark.session import scratch_path
from proofmark.sources import files, tables

AS_OF_MS = 1706659200000  # 2024-01-31 00:00 UTC, just after the last event


@query("scan_table", "SELECT doc_id, lang, source, n_chars FROM documents")
def scan_table(spark, sf):
    return files.scan(spark, f"{sf}/documents.parquet", ["doc_id", "lang", "source", "n_chars"])


@query(
    "validate_schema",
    """SELECT unnest(['null_inputs', 'neither_question_nor_messages', 'no_expected_facts', 'missing_source_tag']) AS rule,
  unnest([count(*) FILTER (doc_id % 7 = 0), count(*) FILTER (doc_id % 7 = 1), count(*) FILTER (doc_id % 5 = 0), count(*) FILTER (doc_id % 3 = 0)]) AS violations,
  count(*) AS n_rows FROM documents""",
)
def validate_schema(spark, sf):
    """Records of which some break each of the rules."""
    key = F.col("key").cast("bigint")
    raw = tables.raw_records(spark, sf).withColumns(
        {
            "question": F.when(key % 7 != 1, F.coalesce("question", F.lit(""))),
            "messages": F.when(key % 7 != 1, F.col("messages")),
            "other": F.when(key % 7 != 1, F.col("other")),
            "expected_facts": F.when(key % 5 != 0, F.array("key")),
            "expected_response": F.lit(None).cast("string"),
        }
    )
    records = filters.normalise_records(raw, F.when(key % 3 != 0, "documents"))
    return filters.validate_schema(records.withColumn("inputs", F.when(key % 7 != 0, F.col("inputs"))))


@query(
    "change_feed",
    """SELECT coalesce(o.doc_id, n.doc_id) AS doc_id, CASE WHEN o.doc_id IS NULL THEN 'insert' WHEN n.doc_id IS NULL THEN 'delete' ELSE 'update' END AS change
FROM (SELECT doc_id, text FROM documents WHERE lang <> 'es') o
FULL JOIN (SELECT doc_id, CASE WHEN source = 'src1' THEN upper(text) ELSE text END AS text FROM documents WHERE lang <> 'de') n ON o.doc_id = n.doc_id
WHERE o.doc_id IS NULL OR n.doc_id IS NULL OR o.text <> n.text""",
)
def change_feed(spark, sf):
    docs = tables.load_texts(spark, sf, "doc_id", "text", "lang", "source")
    old = docs.where(F.col("lang") != "es").select("doc_id", "text")
    new = docs.where(F.col("lang") != "de").select(
        "doc_id", F.when(F.col("source") == "src1", F.upper("text")).otherwise(F.col("text")).alias("text")
    )
    return joins.changes(old, new, "doc_id")


@query(
    "chunk_documents",
    f"""SELECT doc_id, CAST(i AS INT) AS chunk_no, array_to_string(w[i * 450 + 1 : i * 450 + 500], ' ') AS content
FROM (SELECT doc_id, w, unnest(range((len(w) - 1) // 450 + 1)) AS i FROM (SELECT doc_id, {base.words('text')} AS w FROM documents) WHERE len(w) > 0)""",
)
def chunk_documents(spark, sf):
    return files.chunk_documents(tables.load_texts(spark, sf, "doc_id", "text"), "doc_id", "text", size=500, overlap=50)


def landed_log(spark, sf) -> str:
    folder = scratch_path(spark, f"landed-{uuid.uuid4().hex}")
    files.write_files(tables.inference_log(spark, sf).drop("ts"), folder, ["event_date"])
    return folder


@query("inference_source", ctes(base.LOG) + "SELECT request_id, timestamp_ms, status_code, execution_duration_ms, request, response FROM log")
def inference_source(spark, sf):
    """The log is landed by day, as a gateway does, and read through its declared source."""
    return files.read_inference_log(spark, landed_log(spark, sf)).select(
        "request_id", "timestamp_ms", "status_code", "execution_duration_ms", "request", "response"
    )


@query("explode_spans", ctes(base.SPANS) + "SELECT trace_id, span_id, span_type, start_time_ns, end_time_ns FROM spans WHERE span_type = 'CHAT_MODEL'")
def explode_spans(spark, sf):
    return filters.explode_spans(tables.with_span_array(tables.traces(spark, sf)), "CHAT_MODEL").drop("outputs")


@query(
    "explode_assessments",
    ctes(base.ASSESSMENTS) + "SELECT trace_id, assessment_id, name, value, source_type, source_id, created_ms FROM assessments",
)
def explode_assessments(spark, sf):
    return filters.explode_assessments(tables.assessed_traces(spark, sf))


@query(
    "search_traces",
    ctes(base.TRACES) + """SELECT trace_id, request_ms, request FROM traces
WHERE request_ms >= 1704067200000 AND state = 'OK' AND name = 'chat_agent' ORDER BY request_ms DESC, trace_id LIMIT 20""",
)
def search_traces(spark, sf):
    where = f"request_ms >= {tables.EPOCH_MS} AND state = 'OK' AND name = 'chat_agent'"
    found = filters.search_traces(tables.traces(spark, sf), where, [F.desc("request_ms"), F.col("trace_id")], 20)
    return found.select("trace_id", "request_ms", "request")


@query("filter_by_tag", ctes(base.TRACES) + "SELECT trace_id, environment FROM traces WHERE environment IN ('prod', 'canary')")
def filter_by_tag(spark, sf):
    kept = filters.filter_by_tag(tables.traces(spark, sf), "environment", ["prod", "canary"])
    return kept.select("trace_id", F.col("tags")["environment"].alias("environment"))


@query("filter_by_session", ctes(base.TRACES) + "SELECT trace_id, request, response FROM traces WHERE session_id = '3'")
def filter_by_session(spark, sf):
    return filters.filter_by_session(tables.traces(spark, sf), "3").select("trace_id", "request", "response")


@query("project_columns", ctes(base.RAG) + 'SELECT record_id, correctness AS "correctness/value" FROM rag')
def project_columns(spark, sf):
    return tables.rag_results(spark, sf).select("record_id", "`correctness/value`")


@query(
    "payload_preview",
    ctes(base.LOG) + "SELECT request_id, status_code, substring(request, 1, 200) AS request_preview, substring(response, 1, 200) AS response_preview FROM log",
)
def payload_preview(spark, sf):
    return filters.payload_preview(tables.inference_log(spark, sf))


@query("recent_window", ctes(base.LOG) + f"SELECT request_id, timestamp_ms, status_code FROM log WHERE timestamp_ms > {AS_OF_MS} - 24 * 3600000")
def recent_window(spark, sf):
    log = filters.recent_window(tables.inference_log(spark, sf), AS_OF_MS, 24, "ts")
    return log.select("request_id", "timestamp_ms", "status_code")


@query("successful_requests", ctes(base.LOG) + "SELECT request_id, execution_duration_ms FROM log WHERE status_code = 200")
def successful_requests(spark, sf):
    return filters.successful_requests(tables.inference_log(spark, sf)).select("request_id", "execution_duration_ms")


@query(
    "blocked_requests",
    ctes(base.LOG) + """SELECT request_id, timestamp_ms, status_code, request, response FROM log WHERE status_code <> 200
ORDER BY timestamp_ms DESC, request_id DESC LIMIT 5""",
)
def blocked_requests(spark, sf):
    return filters.blocked_requests(tables.inference_log(spark, sf))


@query(
    "recent_requests",
    ctes(base.LOG) + "SELECT request_id, timestamp_ms, status_code FROM log ORDER BY timestamp_ms DESC, request_id DESC LIMIT 10",
)
def recent_requests(spark, sf):
    log = tables.inference_log(spark, sf).select("request_id", "timestamp_ms", "status_code")
    return filters.recent_requests(log, 10)


@query(
    "reshape_to_chat",
    ctes(base.RAW) + "SELECT key, 'user' AS role, CASE WHEN lang IN ('en', 'fr') THEN first ELSE source END AS content FROM raw",
)
def reshape_to_chat(spark, sf):
    return filters.reshape_to_chat(tables.raw_records(spark, sf)).select("key", F.inline("chat"))


@query(
    "first_user_message",
    ctes(base.LOG) + """SELECT request_id, CASE WHEN json_valid(request) THEN
  (list_filter(CAST(json_extract(request, '$.messages') AS JSON[]), lambda m: json_extract_string(m, '$.role') = 'user'))[1] ->> '$.content' END AS question FROM log""",
)
def first_user_message(spark, sf):
    return tables.inference_log(spark, sf).select("request_id", filters.first_user_message("request").alias("question"))


@query(
    "normalise_records",
    ctes(base.RAW) + """SELECT key, CASE WHEN lang = 'en' THEN first WHEN lang <> 'fr' THEN source END AS question,
  CASE WHEN lang = 'fr' THEN first END AS first_message, first AS facts, 'synthetic' AS origin, source AS category FROM raw""",
)
def normalise_records(spark, sf):
    return filters.normalise_records(tables.raw_records(spark, sf), "synthetic").select(
        "key",
        F.col("inputs.question").alias("question"),
        F.get("inputs.messages", F.lit(0))["content"].alias("first_message"),
        F.array_join("expectations.expected_facts", "|").alias("facts"),
        F.col("tags")["source"].alias("origin"),
        F.col("tags")["category"].alias("category"),
    )


@query(
    "failing_rows",
    ctes(base.RAG) + """SELECT record_id, correctness, groundedness FROM rag
WHERE correctness IS DISTINCT FROM 'yes' OR groundedness IS DISTINCT FROM 'yes'""",
)
def failing_rows(spark, sf):
    rows = filters.failing_rows(tables.rag_results(spark, sf), ["correctness", "retrieval_groundedness"])
    return rows.select(
        "record_id", F.col("`correctness/value`").alias("correctness"), F.col("`retrieval_groundedness/value`").alias("groundedness")
    )


@query(
    "retrieval_misses",
    ctes(base.RAG) + "SELECT record_id, correctness, groundedness, recall FROM rag WHERE correctness <> 'yes' AND groundedness = 'yes' AND recall < 0.5",
)
def retrieval_misses(spark, sf):
    return filters.retrieval_misses(tables.rag_results(spark, sf)).select("record_id", "correctness", "groundedness", "recall")


@query("hallucinations", ctes(base.RAG) + "SELECT record_id, correctness, groundedness, recall FROM rag WHERE groundedness <> 'yes' AND recall >= 0.5")
def hallucinations(spark, sf):
    return filters.hallucinations(tables.rag_results(spark, sf)).select("record_id", "correctness", "groundedness", "recall")


@query(
    "diagnose_rag",
    ctes(base.RAG) + """SELECT record_id, CASE
  WHEN recall IS NULL AND correctness = 'yes' THEN 'ok' WHEN recall IS NULL THEN 'other'
  WHEN correctness = 'yes' AND recall < 0.5 THEN 'lucky' WHEN correctness = 'yes' THEN 'ok'
  WHEN groundedness = 'yes' AND recall < 0.5 THEN 'retrieval_miss' WHEN groundedness = 'yes' THEN 'incomplete_answer'
  WHEN recall >= 0.5 THEN 'hallucination' ELSE 'other' END AS diagnosis FROM rag""",
)
def diagnose_rag(spark, sf):
    return filters.diagnose_rag(tables.rag_results(spark, sf)).select("record_id", "diagnosis")


@query("trace_to_record", ctes(base.TRACES) + "SELECT trace_id, request AS question, response AS outputs, 'production' AS source FROM traces")
def trace_to_record(spark, sf):
    return filters.trace_to_record(tables.traces(spark, sf)).select(
        F.col("tags")["trace_id"].alias("trace_id"), F.col("inputs.question").alias("question"), "outputs", F.col("tags")["source"].alias("source")
    )


@query("trace_lookup", ctes(base.TRACES) + "SELECT trace_id, request, response, state FROM traces WHERE trace_id = '3-1'")
def trace_lookup(spark, sf):
    return filters.get_trace(tables.traces(spark, sf), "3-1").select("trace_id", "request", "response", "state")


@query("head_sample", "SELECT doc_id, lang, n_chars FROM documents ORDER BY doc_id LIMIT 10")
def head_sample(spark, sf):
    return filters.head_sample(tables.load(spark, sf, "documents", "doc_id", "lang", "n_chars"), 10, "doc_id")
