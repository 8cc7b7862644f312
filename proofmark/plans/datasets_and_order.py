"""Queries: order-dependent operators and the evaluation-dataset lifecycle."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from proofmark import schemas
from proofmark.functions import text
from proofmark.operators import datasets, filters, ranking, setops
from proofmark.plans import base
from proofmark.plans.base import ctes, query
from proofmark.plans.tables_and_filters import AS_OF_MS
from proofmark.session import scratch_path, written
from proofmark.sources import files, tables

# --- order --------------------------------------------------------------------------------------

_QUESTION = """CASE WHEN json_valid(request) THEN
  (list_filter(CAST(json_extract(request, '$.messages') AS JSON[]), lambda m: json_extract_string(m, '$.role') = 'user'))[1] ->> '$.content' END"""

RECENT_QUESTIONS = base.LOG + f""",
pulled AS (SELECT * FROM log WHERE status_code = 200 ORDER BY timestamp_ms DESC, request_id DESC LIMIT 50),
asked AS (SELECT {_QUESTION} AS question, timestamp_ms, request_id FROM pulled),
recent AS (SELECT * FROM (SELECT * FROM asked WHERE question IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY question ORDER BY timestamp_ms DESC, request_id DESC) = 1) ORDER BY timestamp_ms DESC, request_id DESC LIMIT 10)"""


@query("latest_distinct_questions", ctes(RECENT_QUESTIONS) + "SELECT question, timestamp_ms, request_id FROM recent")
def latest_distinct_questions(spark, sf):
    return ranking.latest_distinct_questions(tables.inference_log(spark, sf))


@query("latest_assessment", ctes(base.LATEST) + "SELECT trace_id, name, value, created_ms FROM latest")
def latest_assessment(spark, sf):
    rows = tables.assessments(spark, sf).select("trace_id", "name", "value", "created_ms", "assessment_id")
    return ranking.latest_assessment(rows).select("trace_id", "name", "value", "created_ms")


@query("first_chat_span", ctes(base.SPANS) + """SELECT trace_id, span_id, start_time_ns, end_time_ns FROM spans WHERE span_type = 'CHAT_MODEL'
QUALIFY row_number() OVER (PARTITION BY trace_id ORDER BY start_time_ns, span_id) = 1""")
def first_chat_span(spark, sf):
    spans = filters.explode_spans(tables.with_span_array(tables.traces(spark, sf)))
    return ranking.first_span(spans, "CHAT_MODEL").select("trace_id", "span_id", "start_time_ns", "end_time_ns")


@query("turn_pairs", ctes(base.PAIRS) + "SELECT conv_id, turn, question, answer FROM pairs")
def turn_pairs(spark, sf):
    return tables.turn_pairs(tables.load(spark, sf, "conversations"))


@query("version_progression", ctes(base.RUN_METRICS) + """SELECT run_id, start_day, metric, value, lag(value) OVER w AS prev_value, round(value - lag(value) OVER w, 6) AS change
FROM run_metrics WINDOW w AS (PARTITION BY metric ORDER BY start_day, run_id)""")
def version_progression(spark, sf):
    return ranking.version_progression(tables.run_metrics(spark, sf))


@query("rate_limit", ctes(base.LOG) + """SELECT request_id, user_id, timestamp_ms, n_recent FROM (
  SELECT *, count(*) OVER (PARTITION BY user_id ORDER BY timestamp_ms RANGE BETWEEN 86400000 PRECEDING AND CURRENT ROW) AS n_recent FROM log) WHERE n_recent > 4""")
def rate_limit(spark, sf):
    return ranking.rate_limit(tables.inference_log(spark, sf), 4, 86_400)


@query("redundant_tool_calls", ctes(base.TOOLS) + """SELECT trace_id, tool, args, count(*) AS calls, min(start_time_ns) AS first_ns, count(*) - 1 AS redundant FROM tools
GROUP BY trace_id, tool, args HAVING count(*) > 1""")
def redundant_tool_calls(spark, sf):
    return ranking.redundant_tool_calls(tables.tool_spans(spark, sf))


@query("worst_rows", ctes(base.RAG) + """SELECT record_id, CAST((correctness IS DISTINCT FROM 'yes')::INT + (groundedness IS DISTINCT FROM 'yes')::INT AS INT) AS n_failed,
  concat_ws(',', CASE WHEN correctness IS DISTINCT FROM 'yes' THEN 'correctness' END, CASE WHEN groundedness IS DISTINCT FROM 'yes' THEN 'retrieval_groundedness' END) AS failed
FROM rag ORDER BY n_failed DESC, record_id LIMIT 20""")
def worst_rows(spark, sf):
    return ranking.worst_rows(tables.rag_results(spark, sf), ["correctness", "retrieval_groundedness"], 20)


@query("search_runs", ctes(base.RUNS) + "SELECT run_id, start_day, layer FROM runs WHERE environment = 'prod' ORDER BY start_day DESC, run_id LIMIT 10")
def search_runs(spark, sf):
    found = ranking.search_runs(tables.runs(spark, sf), "tags['environment'] = 'prod'")
    return found.select("run_id", "start_day", F.col("tags")["layer"].alias("layer"))


# --- datasets -----------------------------------------------------------------------------------

def _records(docs, facts, source):
    return tables.records_of(docs.withColumn("_facts", facts), F.col("question"), F.col("_facts"), source, F.col("lang"), F.col("record_id"))


def first_records(spark, sf):
    """All but the Spanish answers; English ones carry a fact."""
    docs = tables.answers(spark, sf).where(F.col("lang") != "es")
    return _records(docs, F.when(F.col("lang") == "en", F.array("source")), "synthetic")


def second_records(spark, sf):
    """French and Spanish answers; French ones carry other facts."""
    docs = tables.answers(spark, sf).where(F.col("lang").isin("fr", "es"))
    return _records(docs, F.when(F.col("lang") == "fr", F.array("lang", "source")), "edge")


def change_log(spark, sf):
    """The rows that two merges append; the first version is written before the second is merged into it."""
    v1 = written(datasets.merge_records(datasets.empty_log(spark), datasets.with_record_id(first_records(spark, sf)), 1, order="outputs"), "v1")
    v2 = datasets.merge_records(v1, datasets.with_record_id(second_records(spark, sf)), 2, order="outputs")
    return v1.unionByName(v2)


def _incoming(version: int, where: str, facts: str, source: str) -> str:
    return f"""in{version} AS (SELECT question, record_id AS outputs, {facts} AS facts, '{source}' AS source, lang AS category FROM answers WHERE {where}
  QUALIFY row_number() OVER (PARTITION BY question ORDER BY record_id DESC) = 1)"""


CHANGE_LOG = base.ANSWERS + ",\n" + ",\n".join(
    [
        _incoming(1, "lang <> 'es'", "CASE WHEN lang = 'en' THEN source END", "synthetic"),
        _incoming(2, "lang IN ('fr', 'es')", "CASE WHEN lang = 'fr' THEN lang || '|' || source END", "edge"),
    ]
) + """,
change_log AS (
  SELECT question, outputs, facts, source, category, 1 AS version, 'insert' AS op FROM in1
  UNION ALL
  SELECT n.question, n.outputs, coalesce(n.facts, o.facts), n.source, n.category, 2, CASE WHEN o.question IS NULL THEN 'insert' ELSE 'update' END
  FROM in2 n LEFT JOIN in1 o ON n.question = o.question),
state AS (SELECT * FROM change_log QUALIFY row_number() OVER (PARTITION BY question ORDER BY version DESC) = 1)"""


def flat(df, *more):
    return df.select(
        F.col("inputs.question").alias("question"), "outputs", F.array_join("expectations.expected_facts", "|").alias("facts"),
        F.col("tags")["source"].alias("source"), F.col("tags")["category"].alias("category"), *more,
    )


@query("merge_records", ctes(CHANGE_LOG) + "SELECT question, outputs, facts, source, category, version, op FROM change_log")
def merge_records(spark, sf):
    return flat(change_log(spark, sf), "version", "op")


@query("dataset_as_of", ctes(CHANGE_LOG) + "SELECT question, outputs, facts, source, category, version FROM change_log WHERE version <= 1")
def dataset_as_of(spark, sf):
    return flat(datasets.dataset_as_of(written(change_log(spark, sf), "log"), 1), "version")


@query("dataset_history", ctes(CHANGE_LOG) + """SELECT version, count(*) AS n_rows, count(*) FILTER (op = 'insert') AS n_inserted, count(*) FILTER (op = 'update') AS n_updated
FROM change_log GROUP BY version""")
def dataset_history(spark, sf):
    return datasets.dataset_history(change_log(spark, sf))


@query("dataset_history_top", ctes(CHANGE_LOG) + """SELECT version, count(*) AS n_rows, count(*) FILTER (op = 'insert') AS n_inserted, count(*) FILTER (op = 'update') AS n_updated
FROM change_log GROUP BY version ORDER BY version DESC LIMIT 5""")
def dataset_history_top(spark, sf):
    return datasets.history_top(change_log(spark, sf), 5)


@query("dataset_diff", ctes(CHANGE_LOG) + """SELECT change, count(*) AS n FROM (
  SELECT CASE WHEN a.question IS NULL THEN 'added' ELSE 'changed' END AS change FROM state s LEFT JOIN in1 a ON s.question = a.question WHERE s.version = 2) GROUP BY change""")
def dataset_diff(spark, sf):
    return datasets.dataset_diff(change_log(spark, sf), 1, 2).groupBy("change").agg(F.count("*").alias("n"))


@query("merge_traces", ctes(base.TRACES) + """SELECT request AS question, response AS outputs, trace_id, 1 AS version, 'insert' AS op FROM traces
QUALIFY row_number() OVER (PARTITION BY request ORDER BY request_ms DESC) = 1""")
def merge_traces(spark, sf):
    merged = datasets.merge_traces(datasets.empty_log(spark), tables.traces(spark, sf), 1)
    return merged.select(F.col("inputs.question").alias("question"), "outputs", F.col("tags")["trace_id"].alias("trace_id"), "version", "op")


@query("annotate_records", ctes(CHANGE_LOG, f"""truth AS (SELECT question, min(source) AS truth FROM answers WHERE lang IN ('fr', 'de') GROUP BY question)""") + """
SELECT s.question, s.outputs, CASE WHEN t.truth IS NOT NULL THEN t.truth ELSE s.facts END AS facts, t.truth AS response
FROM state s LEFT JOIN truth t ON s.question = t.question""")
def annotate_records(spark, sf):
    docs = tables.answers(spark, sf).where(F.col("lang").isin("fr", "de"))
    truth = docs.groupBy("question").agg(F.min("source").alias("truth"))
    inputs = F.struct("question", F.lit(None).cast(schemas.MESSAGES).alias("messages"))
    labels = truth.select(
        filters.record_id(inputs).alias("record_id"),
        F.to_json(F.struct(F.array("truth").alias("expected_facts"), F.col("truth").alias("expected_response"))).alias("expectations"),
    )
    done = datasets.annotate_records(datasets.dataset_as_of(written(change_log(spark, sf), "log")), labels)
    return done.select(
        F.col("inputs.question").alias("question"), "outputs",
        F.array_join("expectations.expected_facts", "|").alias("facts"), F.col("expectations.expected_response").alias("response"),
    )


def hybrid_rows(spark, sf):
    """Synthetic rows from documents, production rows from the log, edge rows from the benchmark items."""
    docs = tables.load_texts(spark, sf, "doc_id", "text").select(F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("doc_uri"), F.col("text").alias("content"))
    synthetic = datasets.synthesize(docs, per_doc=1)
    production = ranking.latest_distinct_questions(tables.inference_log(spark, sf))
    edge = tables.load(spark, sf, "benchmark").withColumn("question", text.first_sentence("text"))
    none = F.lit(None).cast("array<string>")
    return setops.hybrid_union(
        tables.records_of(synthetic, F.col("question"), F.array("fact"), "synthetic", F.lit("grounded")),
        tables.records_of(production, F.col("question"), none, "production", F.lit("recent")),
        tables.records_of(edge, F.col("question"), F.array("text"), "edge", F.lit("curated")),
    )


SYNTH = f"""picks AS (SELECT doc_uri, i - 1 AS pos, s, row_number() OVER (PARTITION BY doc_uri ORDER BY md5('7/' || doc_uri || '/' || (i - 1))) - 1 AS pick
  FROM (SELECT 'doc-' || doc_id AS doc_uri, unnest({base.sentences('text')}) AS s, generate_subscripts({base.sentences('text')}, 1) AS i FROM documents)),
synth AS (SELECT doc_uri, CAST(pick AS INT) AS pick, trim(s) AS fact, 'What does ' || doc_uri || ' state about ' || coalesce(({base.tokens('s')})[1], 'it') || '?' AS question FROM picks)"""

HYBRID = SYNTH + ",\n" + RECENT_QUESTIONS + f""",
hybrid AS (
  SELECT question, fact AS facts, 'synthetic' AS source FROM synth WHERE pick < 1
  UNION ALL SELECT question, NULL, 'production' FROM recent
  UNION ALL SELECT {base.first_sentence('text')}, text, 'edge' FROM benchmark)"""


@query("synth_evals", ctes(SYNTH) + "SELECT doc_uri, pick, question, fact FROM synth WHERE pick < 2")
def synth_evals(spark, sf):
    docs = tables.load_texts(spark, sf, "doc_id", "text").select(F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("doc_uri"), F.col("text").alias("content"))
    return datasets.synthesize(docs, per_doc=2)


@query("hybrid_union", ctes(HYBRID) + "SELECT question, facts, source FROM hybrid")
def hybrid_union(spark, sf):
    return flat(hybrid_rows(spark, sf)).select("question", "facts", "source")


@query("hybrid_dataset", ctes(HYBRID) + """SELECT question, facts, source, 1 AS version, 'insert' AS op FROM hybrid
QUALIFY row_number() OVER (PARTITION BY question ORDER BY CASE source WHEN 'synthetic' THEN 1 WHEN 'production' THEN 2 ELSE 3 END DESC, facts DESC) = 1""")
def hybrid_dataset(spark, sf):
    rank = F.when(F.col("tags")["source"] == "synthetic", 1).when(F.col("tags")["source"] == "production", 2).otherwise(3)
    rows = datasets.with_record_id(hybrid_rows(spark, sf)).withColumn(
        "_rank", F.struct(rank.alias("r"), F.array_join("expectations.expected_facts", "|").alias("f"))
    )
    merged = datasets.merge_records(datasets.empty_log(spark), rows, 1, order="_rank")
    return flat(merged, "version", "op").select("question", "facts", "source", "version", "op")


@query("question_one_term_twins", ctes(base.ANSWERS, f"asked AS (SELECT record_id, list_sort({base.terms('question')}) AS t FROM answers)",
  "sets AS (SELECT t, count(*) AS n_same FROM asked GROUP BY t)",
  """twins AS (SELECT DISTINCT a.t FROM sets a JOIN sets b ON a.t <> b.t AND len(a.t) >= 2 AND len(b.t) >= 2 AND abs(len(a.t) - len(b.t)) <= 1
  AND greatest(len(a.t), len(b.t)) >= 3 WHERE len(list_intersect(a.t, b.t)) = greatest(len(a.t), len(b.t)) - 1)""")
  + "SELECT record_id, n_same, CASE WHEN w.t IS NULL THEN 'no' ELSE 'yes' END AS reworded FROM asked JOIN sets USING (t) LEFT JOIN twins w USING (t)")
def question_one_term_twins(spark, sf):
    return datasets.one_term_twins(tables.answers(spark, sf))


@query("question_diversity", ctes(base.ANSWERS, f"asked AS (SELECT record_id, list_sort({base.terms('question')}) AS t FROM answers)",
  "sets AS (SELECT t, min(record_id) AS class_id, count(*) AS n_same FROM asked GROUP BY t)",
  """twins AS (SELECT a.t, min(b.class_id) AS first FROM sets a JOIN sets b ON a.t <> b.t AND 5 * len(a.t) >= 4 * len(b.t) AND 5 * len(b.t) >= 4 * len(a.t)
  WHERE 9 * len(list_intersect(a.t, b.t)) >= 4 * (len(a.t) + len(b.t)) GROUP BY a.t)""")
  + """SELECT record_id, class_id, n_same, CASE WHEN w.t IS NULL THEN 'no' ELSE 'yes' END AS reworded, coalesce(least(w.first, class_id), class_id) AS first_like
FROM asked JOIN sets USING (t) LEFT JOIN twins w USING (t)""")
def question_diversity(spark, sf):
    return datasets.question_diversity(tables.answers(spark, sf))


def _mask(x: str) -> str:
    for kind, pattern in text.PII_PATTERNS.items():
        x = f"regexp_replace({x}, '{pattern}', '[{kind.upper()}]', 'g')"
    return x


@query("redact_before_publish", f"SELECT doc_id, {_mask('text')} AS text FROM documents")
def redact_before_publish(spark, sf):
    return datasets.redact_records(tables.load_texts(spark, sf, "doc_id", "text"), "text")


@query("retention_counts", ctes(base.LOG) + """SELECT count(*) FILTER (event_date >= DATE '2024-01-17') AS kept, count(*) FILTER (event_date < DATE '2024-01-17') AS expired FROM log""")
def retention_counts(spark, sf):
    return datasets.retention_counts(tables.inference_log(spark, sf), AS_OF_MS, 14)


@query("retention", ctes(base.LOG) + "SELECT strftime(event_date, '%Y-%m-%d') AS event_date, count(*) AS n FROM log WHERE event_date >= DATE '2024-01-17' GROUP BY 1")
def retention(spark, sf):
    """The log is written by day, expired days go, and what is left is read back and counted."""
    folder = scratch_path(spark, f"log-{uuid.uuid4().hex}")
    files.write_files(tables.inference_log(spark, sf), folder, ["event_date"])
    left = datasets.retain(spark, folder, AS_OF_MS, 14)
    return left.groupBy(F.date_format("event_date", "yyyy-MM-dd").alias("event_date")).agg(F.count("*").alias("n"))
