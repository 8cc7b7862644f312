"""Declared schemas of the logical tables. Nothing is inferred from data."""

from __future__ import annotations

MESSAGES = "ARRAY<STRUCT<role: STRING, content: STRING>>"
CHAT_BODY = f"messages {MESSAGES}"

INPUTS = f"STRUCT<question: STRING, messages: {MESSAGES}>"
EXPECTATION_TYPES = {
    "expected_facts": "ARRAY<STRING>",
    "expected_response": "STRING",
    "expected_tool_calls": "INT",
    "guidelines": "ARRAY<STRING>",
    "expected_retrieved_context": "ARRAY<STRUCT<doc_uri: STRING>>",
}
EXPECTATION_FIELDS = list(EXPECTATION_TYPES)
EXPECTATIONS = "STRUCT<" + ", ".join(f"{name}: {kind}" for name, kind in EXPECTATION_TYPES.items()) + ">"
TAGS = "MAP<STRING, STRING>"

RECORDS = f"record_id STRING, inputs {INPUTS}, outputs STRING, expectations {EXPECTATIONS}, tags {TAGS}"
CHANGE_LOG = f"{RECORDS}, version INT, op STRING"

INFERENCE_LOG = (
    "request_id STRING, timestamp_ms BIGINT, event_date DATE, user_id STRING, status_code INT, "
    "execution_duration_ms DOUBLE, request STRING, response STRING, request_metadata MAP<STRING, STRING>"
)
ASSESSMENTS = (
    "trace_id STRING, assessment_id STRING, name STRING, value STRING, value_num DOUBLE, rationale STRING, "
    "source_type STRING, source_id STRING, created_ms BIGINT"
)
TRACES = (
    "trace_id STRING, session_id STRING, client_request_id STRING, user_id STRING, request_ms BIGINT, state STRING, "
    "name STRING, execution_duration_ms DOUBLE, request STRING, response STRING, tags MAP<STRING, STRING>, "
    "trace_metadata MAP<STRING, STRING>"
)
REGISTRY = "name STRING, scorer STRING, version INT, sample_rate DOUBLE, filter STRING, status STRING"
THRESHOLDS = "metric STRING, floor DOUBLE, scale STRING"
