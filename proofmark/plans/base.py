"""Registry of runnable queries, and the SQL twins of the derived tables.

The SQL is written on its own, from the definitions and not from the Spark plans: windows where the
operators aggregate, list functions where they shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from proofmark.functions.text import ALL_STOP_WORDS, PII_PATTERNS, STOP_WORDS
from proofmark.session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its operator name, with its SQL twin where there is one."""
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tune(spark), sf_dir)

        run.__name__ = name
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def quoted(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


def ctes(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


# --- text ---------------------------------------------------------------------------------------

def words(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '\\s+'), lambda w: w <> '')"


def tokens(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '[\\p{{L}}\\p{{N}}]+')"


def sentences(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '[.!?]+'), lambda s: regexp_matches(s, '[\\p{{L}}\\p{{N}}]'))"


def first_sentence(x: str) -> str:
    return f"trim(coalesce(({sentences(x)})[1], ''))"


def terms(x: str) -> str:
    return f"list_distinct(list_filter({tokens(x)}, lambda t: length(t) >= 3 AND t NOT IN ({quoted(ALL_STOP_WORDS)})))"


def coverage(wanted: str, present: str) -> str:
    return f"CASE WHEN len({wanted}) > 0 THEN len(list_intersect({wanted}, {present})) / len({wanted})::DOUBLE END"


def language(x: str) -> str:
    hits = {lang: f"len(list_filter({tokens(x)}, lambda t: t IN ({quoted(ws)})))" for lang, ws in STOP_WORDS.items()}
    best = f"greatest({', '.join(hits.values())})"
    return f"CASE WHEN {best} = 0 THEN 'none' " + " ".join(f"WHEN {h} = {best} THEN '{lang}'" for lang, h in hits.items()) + " END"


def yes_no(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 'yes' WHEN NOT ({condition}) THEN 'no' END"


def pii(x: str, kind: str) -> str:
    return f"regexp_matches({x}, '{PII_PATTERNS[kind]}')"


def first_pii(x: str) -> str:
    return "CASE " + " ".join(f"WHEN {pii(x, k)} THEN '{k}'" for k in PII_PATTERNS) + " END"


def ratio(condition: str) -> str:
    return f"round(avg(CASE WHEN {condition} THEN 1.0 ELSE 0.0 END)::DOUBLE, 6)"


# --- derived tables -----------------------------------------------------------------------------

PAIRS = """pairs AS (
  SELECT conv_id, turn, question, answer FROM (
    SELECT conv_id, turn, role, text AS answer, lag(text) OVER w AS question, lag(role) OVER w AS prev_role
    FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
  WHERE role = 'assistant' AND prev_role = 'user')"""

TRACES = PAIRS + """,
traces AS (
  SELECT conv_id || '-' || turn AS trace_id, CAST(conv_id AS VARCHAR) AS session_id,
    CAST(conv_id * 2 + turn // 4 AS VARCHAR) AS client_request_id, 'u' || (conv_id % 40) AS user_id,
    1704067200000 + conv_id * 600000 + turn * 1000 AS request_ms,
    CASE WHEN length(answer) % 7 = 0 THEN 'ERROR' ELSE 'OK' END AS state,
    CASE WHEN length(question) > 150 THEN 'rag_agent' ELSE 'chat_agent' END AS name,
    CASE WHEN length(question) % 10 <> 0 THEN length(answer)::DOUBLE * 10 END AS execution_duration_ms,
    question AS request, answer AS response,
    CASE WHEN length(question) > 100 THEN 'prod' ELSE 'dev' END AS environment
  FROM pairs)"""

SPANS = TRACES + """,
spans AS (
  SELECT trace_id, trace_id || '/1' AS span_id, 'RETRIEVER' AS span_type, request_ms * 1000000 AS start_time_ns,
    request_ms * 1000000 + 2000000 AS end_time_ns FROM traces
  UNION ALL
  SELECT trace_id, trace_id || '/2', 'CHAT_MODEL', request_ms * 1000000 + 2000000,
    request_ms * 1000000 + CAST(trunc(execution_duration_ms * 0.7::DOUBLE * 1000000) AS BIGINT)
  FROM traces WHERE execution_duration_ms IS NOT NULL
  UNION ALL
  SELECT trace_id, trace_id || '/3', 'CHAT_MODEL', request_ms * 1000000 + CAST(trunc(execution_duration_ms * 0.7::DOUBLE * 1000000) AS BIGINT),
    request_ms * 1000000 + CAST(trunc(execution_duration_ms * 1000000) AS BIGINT)
  FROM traces WHERE execution_duration_ms > 5000)"""

LOG = """log AS (
  SELECT CAST(event_id AS VARCHAR) AS request_id, ts, epoch_us(ts) // 1000 AS timestamp_ms, CAST(ts AS DATE) AS event_date,
    CAST(user_id AS VARCHAR) AS user_id, CASE WHEN event_type = 'error' THEN 400 ELSE 200 END AS status_code,
    value AS execution_duration_ms,
    CASE event_type
      WHEN 'error' THEN '{"messages":[{"role":"user","content":"write to user@example.com about item ' || k || '"}]}'
      WHEN 'purchase' THEN '{"messages":[{"role":"user","content":"buy item ' || k || '"}]}'
      WHEN 'click' THEN '{"messages":[{"role":"system","content":"be brief ' || k || '"},{"role":"user","content":"open item ' || k || '"}]}'
      WHEN 'view' THEN '{"messages":[{"role":"user","content":null},{"role":"user","content":"show item ' || k || '"}]}'
      ELSE 'not json' END AS request,
    CASE WHEN event_type = 'error' THEN '' ELSE 'done ' || event_type || ' ' || k END AS response,
    CASE WHEN event_type = 'error' THEN 'pii' END AS guardrail
  FROM (SELECT *, regexp_extract(props, '(\\d+)', 1) AS k FROM events))"""

TOOLS = """tools AS (
  SELECT user_id || '/' || strftime(ts, '%Y-%m-%d') AS trace_id, CAST(event_id AS VARCHAR) AS span_id, event_type AS tool,
    CAST(CAST(regexp_extract(props, '(\\d+)', 1) AS INT) % 5 AS VARCHAR) AS args, epoch_us(ts) * 1000 AS start_time_ns
  FROM events)"""

ANSWERS = f"""answers AS (
  SELECT CAST(doc_id AS VARCHAR) AS record_id, {first_sentence('text')} AS question,
    CASE WHEN lang = 'en' THEN '[doc-' || doc_id || '] ' || text ELSE text END AS outputs, lang, source, doc_id
  FROM documents)"""

LABELLED = """labelled AS (
  SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def _assessment(no: int, name: str, value: str, source_type: str, when: str = "true") -> str:
    return (
        f"SELECT CAST(doc_id AS VARCHAR) AS trace_id, source, lang, doc_id || '#{no}' AS assessment_id, '{name}' AS name, "
        f"CAST({value} AS VARCHAR) AS value, '{source_type}' AS source_type, '{name}_v1' AS source_id, "
        f"1704067200000 + doc_id * 60000 + {no} AS created_ms FROM labelled WHERE {when}"
    )


def _over(limit: int) -> str:
    return f"CASE WHEN n_chars >= {limit} THEN 'yes' ELSE 'no' END"


ASSESSMENTS = LABELLED + ",\nassessments AS (\n" + "\nUNION ALL\n".join(
    [
        _assessment(1, "correctness", _over(300), "LLM_JUDGE"),
        _assessment(2, "correctness", _over(800), "LLM_JUDGE", "lang = 'en'"),
        _assessment(3, "suite_correctness", f"CASE WHEN lang = 'de' THEN '' ELSE {_over(500)} END", "LLM_JUDGE", "lang IN ('fr', 'de')"),
        _assessment(4, "human_correctness", "CASE WHEN quality = 1 THEN 'yes' ELSE 'no' END", "HUMAN", "quality IS NOT NULL"),
        _assessment(5, "user_helpful", "CASE WHEN toxic = 0 THEN 'true' ELSE 'false' END", "HUMAN", "quality IS NOT NULL"),
        _assessment(6, "satisfaction", "2 + 3 * quality - toxic", "HUMAN", "quality IS NOT NULL AND lang = 'en'"),
        _assessment(7, "rubric", "CASE WHEN lang <> 'es' THEN least(5, 1 + n_chars // 1000) END", "CODE"),
        _assessment(8, "safety", "CASE WHEN toxic = 1 THEN 'no' ELSE 'yes' END", "CODE"),
    ]
) + ")"

LATEST = ASSESSMENTS + """,
latest AS (
  SELECT * FROM assessments QUALIFY row_number() OVER (PARTITION BY trace_id, name ORDER BY created_ms DESC, assessment_id DESC) = 1)"""

GRADED = """graded AS (
  SELECT CAST(doc_id AS VARCHAR) AS record_id, 'rubric' AS scorer, 'v1' AS run_id, CAST(least(5, 1 + n_chars // 500) AS INT) AS score FROM documents
  UNION ALL
  SELECT CAST(doc_id AS VARCHAR), 'rubric', 'v2', CAST(CASE WHEN n_chars < 80 THEN 2 ELSE least(5, 1 + n_chars // 1000) END AS INT) FROM documents)"""

RAG = LABELLED + """,
rag AS (
  SELECT CAST(doc_id AS VARCHAR) AS record_id, CASE quality WHEN 1 THEN 'yes' WHEN 0 THEN 'no' END AS correctness,
    CASE WHEN lang = 'en' THEN 'yes' WHEN lang <> 'de' THEN 'no' END AS groundedness,
    CASE WHEN lang <> 'es' THEN (n_chars % 101) / 100.0::DOUBLE END AS recall, lang, source
  FROM labelled)"""

FEEDBACK = """feedback AS (
  SELECT CAST(doc_id AS VARCHAR) AS client_request_id, 'user' || doc_id AS user_id, toxic = 0 AS helpful,
    CASE WHEN quality = 1 THEN 5 END AS satisfaction, CASE WHEN quality = 1 THEN 'good' ELSE 'poor' END AS rationale, 1704067200000 + doc_id * 1000 AS clicked_ms FROM labels)"""

RAW = f"""raw AS (
  SELECT CAST(doc_id AS VARCHAR) AS key, lang, source, {first_sentence('text')} AS first FROM documents)"""

RUN_METRICS = LABELLED + """,
run_metrics AS (
  SELECT source AS run_id, CAST(regexp_extract(source, '(\\d+)', 1) AS INT) * 7 AS start_day, unnest(['correctness/ratio_pass', 'length/mean', 'human_correctness/ratio_pass']) AS metric,
    unnest([round(avg(CASE WHEN n_chars >= 300 THEN 1.0 ELSE 0.0 END)::DOUBLE, 6), round(avg(n_chars)::DOUBLE, 6), round(avg(quality)::DOUBLE, 6)]) AS value
  FROM labelled GROUP BY source)"""

RUNS = """runs AS (
  SELECT run_id, no * 7 AS start_day, layer, CASE WHEN layer IN ('gate', 'feedback') THEN 'pre_deploy' END AS gate,
    CASE WHEN no < 10 THEN 'staging' ELSE 'prod' END AS environment
  FROM (SELECT run_id, no, (['app', 'dataset', 'scorers', 'gate', 'feedback'])[no % 5 + 1] AS layer
        FROM (SELECT DISTINCT source AS run_id, CAST(regexp_extract(source, '(\\d+)', 1) AS INT) AS no FROM documents)))"""
