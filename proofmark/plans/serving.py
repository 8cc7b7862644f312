"""Queries: harness, guardrails, monitoring and the quality gate."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import functions as F

from proofmark.operators import agreement, filters, gate, guardrails, harness, joins, judges, metrics, monitoring, ranking, retrieval, scorers
from proofmark.plans import base
from proofmark.plans.base import ctes, query, yes_no
from proofmark.plans.joined_and_aggregated import DAILY, METRICS, _keep_order, _keyword_list, monitors
from proofmark.plans.scoring import LEXICON, PROMPT, contents
from proofmark.session import scratch_path
from proofmark.sources import files, tables

# --- harness ------------------------------------------------------------------------------------


def chat_scorers() -> dict[str, scorers.Score]:
    """Code scorers of the flagship run over traces."""
    return {
        "has_citation": scorers.has_citation("response"),
        "length": scorers.length_between(40, 250, "response"),
        "latency_under_budget": scorers.trace_latency(),
        "word_count": scorers.word_count("response"),
    }


EVALUATED = base.TRACES + f""",
evaluated AS (
  SELECT trace_id, 'has_citation' AS name, CASE WHEN regexp_matches(response, '\\[[^\\]]+\\]') THEN 'yes' ELSE 'no' END AS value FROM traces
  UNION ALL SELECT trace_id, 'length', {yes_no(f"len({base.words('response')}) BETWEEN 40 AND 250")} FROM traces
  UNION ALL SELECT trace_id, 'latency_under_budget', {yes_no('execution_duration_ms <= 8000')} FROM traces
  UNION ALL SELECT trace_id, 'word_count', CAST(len({base.words('response')}) AS VARCHAR) FROM traces),
eval_per_name AS (SELECT name, round(avg(CASE value WHEN 'yes' THEN 1.0 WHEN 'no' THEN 0.0 ELSE TRY_CAST(value AS DOUBLE) END), 6) AS mean,
  CASE WHEN count(*) FILTER (value IN ('yes', 'no')) > 0 THEN {base.ratio("value = 'yes'")} END AS ratio_pass FROM evaluated GROUP BY name),
eval_metrics AS (SELECT name || '/mean' AS metric, mean AS value FROM eval_per_name WHERE mean IS NOT NULL
  UNION ALL SELECT name || '/ratio_pass', ratio_pass FROM eval_per_name WHERE ratio_pass IS NOT NULL)"""

FLOORS = {
    "has_citation/ratio_pass": (0.0, "ratio"),
    "length/ratio_pass": (0.9, "ratio"),
    "latency_under_budget/ratio_pass": (0.95, "ratio"),
    "relevance/ratio_pass": (0.9, "ratio"),
}
STRICT_FLOORS = {**FLOORS, "has_citation/ratio_pass": (0.999, "ratio"), "length/ratio_pass": (0.999, "ratio")}


def _floors_sql(floors: dict[str, tuple[float, str]], name: str = "floors") -> str:
    rows = ", ".join(f"('{m}', {f}::DOUBLE)" for m, (f, _) in floors.items())
    return f"{name}(metric, floor) AS (VALUES {rows})"


def _failures_sql(metrics_table: str, digits: int = 3) -> str:
    return f"""SELECT f.metric, CASE WHEN value IS NULL THEN f.metric || ': MISSING' ELSE f.metric || ': ' || printf('%.{digits}f', value) || ' < threshold ' || CAST(floor AS VARCHAR) END AS message
FROM floors f LEFT JOIN {metrics_table} m ON f.metric = m.metric WHERE value IS NULL OR value < floor"""


def evaluated(spark, sf):
    return harness.evaluate(tables.traces(spark, sf), None, chat_scorers(), key="trace_id")


@query("evaluate", ctes(EVALUATED) + """SELECT trace_id, name, value FROM evaluated
UNION ALL SELECT trace_id, 'echo', CASE WHEN upper(request) = request THEN 'yes' ELSE 'no' END FROM traces""")
def evaluate(spark, sf):
    """The flagship scorers and a job, over the answers of a predict function that is called once a row."""
    def shout(request: str) -> str:
        return request.upper()

    def echo(answers):
        return answers.select("trace_id", F.when(F.col("outputs") == F.col("request"), "yes").otherwise("no").alias("value"))

    rows = tables.traces(spark, sf).select("trace_id", "request", "response", "execution_duration_ms")
    results, _ = harness.evaluate(rows, lambda df: harness.predict_local(df, shout), chat_scorers(), {"echo": echo}, key="trace_id")
    return results.select("trace_id", "name", "value")


class _Died(Exception):
    pass


@query("evaluate_resumed", ctes(EVALUATED) + """SELECT trace_id, 'echo' AS name, CASE WHEN upper(request) = request THEN 'yes' ELSE 'no' END AS value FROM traces""")
def evaluate_resumed(spark, sf):
    """A run dies after some parts of its answers; the next one asks for the others, and every trace has its answer."""
    def shout(request: str) -> str:
        return request.upper()

    def echo(answers):
        return answers.select("trace_id", F.when(F.col("outputs") == F.col("request"), "yes").otherwise("no").alias("value"))

    left = [3]

    def dying(df):
        if not left[0]:
            raise _Died
        left[0] -= 1
        return harness.predict_local(df, shout)

    rows = tables.traces(spark, sf).select("trace_id", "request")
    folder = scratch_path(spark, f"answers-{uuid.uuid4().hex}")
    try:
        harness.evaluate(rows, dying, {}, {"echo": echo}, key="trace_id", resume=folder)
    except _Died:
        pass
    results, _ = harness.evaluate(rows, lambda df: harness.predict_local(df, shout), {}, {"echo": echo}, key="trace_id", resume=folder)
    return results.select("trace_id", "name", "value")


@query("pivot_results", ctes(EVALUATED) + """SELECT trace_id, max(value) FILTER (name = 'has_citation') AS "has_citation/value", max(value) FILTER (name = 'length') AS "length/value",
  max(value) FILTER (name = 'latency_under_budget') AS "latency_under_budget/value", max(value) FILTER (name = 'word_count') AS "word_count/value" FROM evaluated GROUP BY trace_id""")
def pivot_results(spark, sf):
    return harness.pivot_results(evaluated(spark, sf)[0], "trace_id", list(chat_scorers()))


@query("predict_local", ctes(base.ANSWERS) + "SELECT record_id, upper(lang) || ': ' || question AS prediction FROM answers")
def predict_local(spark, sf):
    def answer(question: str, lang: str) -> str:
        return f"{lang.upper()}: {question}"

    rows = tables.answers(spark, sf).select("record_id", "question", "lang")
    return harness.predict_local(rows, answer, "prediction").select("record_id", "prediction")


@query("predict_model", "SELECT doc_id, CAST(length(text) AS VARCHAR) || ' characters' AS prediction FROM documents")
def predict_model(spark, sf):
    def load_model():
        return lambda texts: texts.str.len().astype(str) + " characters"

    docs = tables.load_texts(spark, sf, "doc_id", "text")
    return harness.predict_model(docs, load_model, "text", "prediction").select("doc_id", "prediction")


@query("predict_concurrent", ctes(base.TRACES) + "SELECT trace_id, reverse(request) AS prediction FROM traces")
def predict_concurrent(spark, sf):
    async def answer(request: str) -> str:
        return request[::-1]

    rows = tables.traces(spark, sf).select("trace_id", "request")
    return harness.predict_concurrent(rows, answer, 8, "prediction").select("trace_id", "prediction")


@query("model_judge", ctes(base.ANSWERS) + """SELECT record_id, 'accuracy' AS name, CAST(1 + length('Question:' || chr(10) || question || chr(10) || chr(10) || 'Answer:' || chr(10) || outputs
  || chr(10) || chr(10) || 'Give a whole number from 1 to 5 on the last line.') % 5 AS VARCHAR) AS value FROM answers""")
def model_judge(spark, sf):
    def reply(prompts: pd.Series) -> pd.Series:
        return "Reasons first.\n" + (1 + prompts.str.len() % 5).astype(str)

    return harness.model_judge(tables.answers(spark, sf), PROMPT, reply, "accuracy", inputs="question", outputs="outputs").select("record_id", "name", "value")


@query("user_scorer", "SELECT doc_id, 'shouting' AS name, CASE WHEN contains(text, '!') THEN 'yes' ELSE 'no' END AS value FROM documents UNION ALL SELECT doc_id, 'letters', CAST(length(text) AS VARCHAR) FROM documents")
def user_scorer(spark, sf):
    registry = harness.ScorerRegistry()

    @registry.scorer()
    def shouting():
        return F.when(F.contains("text", F.lit("!")), "yes").otherwise("no")

    @registry.batch_scorer("letters", "text")
    def letters(texts: pd.Series) -> pd.Series:
        return texts.str.len()

    return scorers.long_scores(tables.load_texts(spark, sf, "doc_id", "text"), "doc_id", registry.build()).select("doc_id", "name", "value")


SOURCES = {"the": ["0", "3"], "que": ["1", "4"], "und": ["2"], "ree": ["5", "0"], "item": ["6", "none such"]}


@query("rag_context", ctes(base.TRACES, f"""asked AS (SELECT trace_id AS record_id, {_keep_order(_keyword_list('request', SOURCES))} AS ids FROM traces),
retrieved AS (SELECT record_id, unnest(ids) AS doc_id, generate_subscripts(ids, 1) AS rank FROM asked)""")
  + """SELECT record_id, string_agg('[' || r.doc_id || '] ' || text, chr(10) ORDER BY rank) AS context FROM retrieved r JOIN documents d ON CAST(d.doc_id AS VARCHAR) = r.doc_id
WHERE rank <= 3 GROUP BY record_id""")
def rag_context(spark, sf):
    """Keywords of a request retrieve documents, the retriever's span holds what it returned, and the context is read from the spans."""
    traces = tables.traces(spark, sf)
    spans = filters.explode_spans(tables.with_span_array(traces, joins.keyword_documents("request", SOURCES)))
    found = retrieval.retrieved_documents(spans).select(F.col("trace_id").alias("record_id"), "rank", "doc_id")
    return retrieval.assemble_context(found.join(contents(spark, sf), "doc_id"))


@query("chat_history", "SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS position, role, text AS content FROM conversations")
def chat_history(spark, sf):
    return harness.chat_history(tables.load(spark, sf, "conversations"))


# --- guardrails ---------------------------------------------------------------------------------

KEYWORDS = ["ree", "item 13"]
TOPICS = ["item", "the", "que", "und"]


@query("detect_pii", f"SELECT doc_id, {yes_no(base.pii('text', 'ssn'))} AS has_ssn, {yes_no(base.pii('text', 'email'))} AS has_email, {yes_no(base.pii('text', 'card'))} AS has_card, {base.first_pii('text')} AS first_kind FROM documents")
def detect_pii(spark, sf):
    return guardrails.detect_pii(tables.load_texts(spark, sf, "doc_id", "text"), "text").drop("text")


def _contains(x: str, needles: list[str]) -> str:
    return "(" + " OR ".join(f"contains(lower({x}), '{n}')" for n in needles) + ")"


def _unsafe(x: str) -> str:
    return f"list_has_any({base.tokens(x)}, [{base.quoted(LEXICON)}])"


@query("block_unsafe_output", ctes(base.TRACES) + f"SELECT trace_id FROM traces WHERE {_unsafe('response')}")
def block_unsafe_output(spark, sf):
    return tables.traces(spark, sf).where(guardrails.unsafe("response", LEXICON)).select("trace_id")


@query("block_keywords", ctes(base.TRACES) + f"SELECT trace_id FROM traces WHERE {_contains('request', KEYWORDS)}")
def block_keywords(spark, sf):
    return tables.traces(spark, sf).where(guardrails.has_keyword("request", KEYWORDS)).select("trace_id")


@query("restrict_topics", ctes(base.TRACES) + f"SELECT trace_id FROM traces WHERE NOT {_contains('request', TOPICS)}")
def restrict_topics(spark, sf):
    return tables.traces(spark, sf).where(guardrails.off_topic("request", TOPICS)).select("trace_id")


GUARDED = base.LOG.replace("CASE WHEN event_type = 'error' THEN 'pii' END AS guardrail", "1 AS one") + f""",
fired AS (SELECT request_id, response, CASE WHEN {base.first_pii('request')} IS NOT NULL THEN 'pii' WHEN {_contains('request', KEYWORDS)} THEN 'keyword'
  WHEN NOT {_contains('request', TOPICS)} THEN 'topic' WHEN {_unsafe('response')} THEN 'output_safety' END AS guardrail FROM log),
guarded AS (SELECT request_id, guardrail, CAST(CASE WHEN guardrail IS NULL THEN 200 ELSE 400 END AS INT) AS status_code, CASE WHEN guardrail IS NULL THEN response END AS response FROM fired)"""


def guarded(spark, sf):
    return guardrails.apply_guardrails(tables.inference_log(spark, sf), KEYWORDS, TOPICS, LEXICON)


@query("apply_guardrails", ctes(GUARDED) + "SELECT request_id, status_code, guardrail, response FROM guarded")
def apply_guardrails(spark, sf):
    return guarded(spark, sf).select("request_id", "status_code", "guardrail", "response")


@query("guardrail_hits", ctes(GUARDED) + "SELECT guardrail, status_code, count(*) AS n FROM guarded GROUP BY ALL")
def guardrail_hits(spark, sf):
    return guardrails.guardrail_hits(guarded(spark, sf))


# --- monitoring ---------------------------------------------------------------------------------

def _sampled(scorer: str, rate: float) -> str:
    return f"('0x' || substr(md5('{scorer}' || trace_id), 1, 8))::BIGINT / 4294967296.0::DOUBLE < {rate}"


def live_registry() -> monitoring.Registry:
    entries = [monitoring.Registration(n, n) for n in ("safety", "length", "latency", "idle")]
    registry = monitoring.Registry(entries)
    registry.start("safety", 1.0)
    registry.start("length", 0.5, "tags['environment'] = 'prod'")
    registry.start("latency", 0.3, "tags['environment'] = 'prod' AND state = 'OK'")
    return registry


LIVE_SCORERS = {
    "safety": lambda: judges.safety("response", LEXICON),
    "length": lambda: scorers.length_between(40, 250, "response"),
    "latency": lambda: scorers.trace_latency(),
}


@query("list_scorers", ctes("registry AS (SELECT unnest(['correctness', 'safety', 'rubric', 'compliance']) AS name, unnest([0.2, 1.0, 0.5, 0.5])::DOUBLE AS sample_rate)", base.ASSESSMENTS)
  + "SELECT r.name, sample_rate, count(a.name) AS n_assessments FROM registry r LEFT JOIN assessments a ON r.name = a.name GROUP BY ALL")
def list_scorers(spark, sf):
    """Active scorers, each with the number of assessments it has given."""
    active = monitoring.list_scorers(monitors().to_df(spark)).select("name", "sample_rate")
    given = tables.assessments(spark, sf).groupBy("name").agg(F.count("*").alias("n"))
    return active.join(given, "name", "left").select("name", "sample_rate", F.coalesce("n", F.lit(0)).alias("n_assessments"))


@query("sample_traces", ctes(base.TRACES) + f"SELECT trace_id FROM traces WHERE {_sampled('correctness', 0.3)}")
def sample_traces(spark, sf):
    return monitoring.sample_traces(tables.traces(spark, sf), "correctness", 0.3).select("trace_id")


@query("monitor_batch", ctes(base.TRACES) + f"""SELECT trace_id, 'safety' AS name, CASE WHEN {base.first_pii('response')} IS NULL AND NOT {_unsafe('response')} THEN 'yes' ELSE 'no' END AS value FROM traces WHERE {_sampled('safety', 1.0)}
UNION ALL SELECT trace_id, 'length', {yes_no(f"len({base.words('response')}) BETWEEN 40 AND 250")} FROM traces WHERE environment = 'prod' AND {_sampled('length', 0.5)}
UNION ALL SELECT trace_id, 'latency', {yes_no('execution_duration_ms <= 8000')} FROM traces WHERE environment = 'prod' AND state = 'OK' AND {_sampled('latency', 0.3)}""")
def monitor_batch(spark, sf):
    return monitoring.monitor_batch(tables.traces(spark, sf), live_registry(), LIVE_SCORERS).select("trace_id", "name", "value")


@query("monitor_append", ctes(base.TRACES) + f"""SELECT trace_id, name, value, md5(concat_ws(chr(31), trace_id, name, name || '_v1')) AS assessment_id, request_ms AS created_ms,
  CASE WHEN session_id::BIGINT % 2 = 0 THEN 'first' ELSE 'second' END AS run FROM (
  SELECT trace_id, request_ms, session_id, 'safety' AS name, CASE WHEN {base.first_pii('response')} IS NULL AND NOT {_unsafe('response')} THEN 'yes' ELSE 'no' END AS value FROM traces WHERE {_sampled('safety', 1.0)}
  UNION ALL SELECT trace_id, request_ms, session_id, 'length', {yes_no(f"len({base.words('response')}) BETWEEN 40 AND 250")} FROM traces WHERE environment = 'prod' AND {_sampled('length', 0.5)}
  UNION ALL SELECT trace_id, request_ms, session_id, 'latency', {yes_no('execution_duration_ms <= 8000')} FROM traces WHERE environment = 'prod' AND state = 'OK' AND {_sampled('latency', 0.3)})""")
def monitor_append(spark, sf):
    """Two runs of the batch monitor add to one table; the second one sees the first one's traces again, and is run twice."""
    path = scratch_path(spark, f"feedback-{uuid.uuid4().hex}")
    traces = tables.traces(spark, sf)
    monitoring.append_feedback(traces.where(F.col("session_id").cast("bigint") % 2 == 0), live_registry(), LIVE_SCORERS, path, "first")
    monitoring.append_feedback(traces, live_registry(), LIVE_SCORERS, path, "second")
    rows = monitoring.append_feedback(traces, live_registry(), LIVE_SCORERS, path, "second")
    return rows.select("trace_id", "name", "value", "assessment_id", "created_ms", "run")


@query("canary_compare", ctes(base.LATEST) + f"""SELECT count(*) AS n_pairs, {base.ratio('a = b')} AS agreement, {base.ratio("a = 'yes'")} AS pass_v1, {base.ratio("b = 'yes'")} AS pass_v2,
  round({base.ratio("b = 'yes'")} - {base.ratio("a = 'yes'")}, 6) AS delta
FROM (SELECT trace_id, max(value) FILTER (name = 'suite_correctness') AS a, max(value) FILTER (name = 'correctness') AS b FROM latest GROUP BY trace_id) WHERE a IS NOT NULL AND b IS NOT NULL""")
def canary_compare(spark, sf):
    return agreement.canary_compare(tables.assessments(spark, sf), "suite_correctness", "correctness")


@query("drift_alerts", ctes(base.LOG, base.ASSESSMENTS, DAILY) + """SELECT day, total_requests, concat_ws(',', CASE WHEN blocked_share > 0.2 THEN 'blocked' END, CASE WHEN latency_p95_ms > 150 THEN 'latency' END, CASE WHEN pass_rate < 0.9 THEN 'quality' END) AS reasons
FROM rollup_days WHERE blocked_share > 0.2 OR latency_p95_ms > 150 OR pass_rate < 0.9""")
def drift_alerts(spark, sf):
    rollup = metrics.daily_rollup(tables.inference_log(spark, sf), tables.assessments(spark, sf), "correctness")
    return gate.drift_alerts(rollup, 0.2, 150.0, 0.9)


# --- gate ---------------------------------------------------------------------------------------

def chat_metrics(spark, sf):
    return evaluated(spark, sf)[1]


@query("threshold_join", ctes(EVALUATED, _floors_sql(FLOORS)) + """SELECT f.metric, floor, value AS observed, CASE WHEN value IS NULL THEN 'missing' WHEN value < floor THEN 'below' ELSE 'ok' END AS state
FROM floors f LEFT JOIN eval_metrics m ON f.metric = m.metric""")
def threshold_join(spark, sf):
    return gate.threshold_join(chat_metrics(spark, sf), gate.thresholds(spark, FLOORS))


@query("evaluate_gate", ctes(EVALUATED, _floors_sql(FLOORS)) + _failures_sql("eval_metrics"))
def evaluate_gate(spark, sf):
    return gate.evaluate_gate(chat_metrics(spark, sf), gate.thresholds(spark, FLOORS))


@query("gate_verdict", ctes(EVALUATED, _floors_sql(FLOORS), f"failures AS ({_failures_sql('eval_metrics')})") + """SELECT CASE WHEN count(*) = 0 THEN 'true' ELSE 'false' END AS passed, count(*) AS n_failures,
  coalesce(string_agg(message, '; ' ORDER BY message), '') AS failures FROM failures""")
def gate_verdict(spark, sf):
    return gate.gate_verdict(gate.evaluate_gate(chat_metrics(spark, sf), gate.thresholds(spark, FLOORS)))


@query("strict_gate", ctes(EVALUATED, _floors_sql(STRICT_FLOORS)) + _failures_sql("eval_metrics", 2))
def strict_gate(spark, sf):
    """A run stores its metrics; the stricter floors are then held against what is stored, and nothing is scored for them."""
    path = scratch_path(spark, f"metrics-{uuid.uuid4().hex}")
    files.write_json(chat_metrics(spark, sf), path, "run-1")
    return gate.evaluate_gate(gate.stored_metrics(spark, path, "run-1"), gate.thresholds(spark, STRICT_FLOORS), digits=2)


def renamed(old: str, new: str):
    return F.when(F.col("metric").startswith(old + "/"), F.replace("metric", F.lit(old), F.lit(new))).otherwise(F.col("metric"))


@query("regate", ctes(METRICS, "next_metrics AS (SELECT replace(metric, 'rubric/', 'rubric_v2/') AS metric, value FROM metrics)",
  _floors_sql({"rubric_v2/mean": (3.0, "1-5"), "rubric/mean": (2.0, "1-5"), "safety/ratio_pass": (1.0, "ratio"), "correctness/ratio_pass": (0.5, "ratio")})) + _failures_sql("next_metrics"))
def regate(spark, sf):
    floors = {"rubric_v2/mean": (3.0, "1-5"), "rubric/mean": (2.0, "1-5"), "safety/ratio_pass": (1.0, "ratio"), "correctness/ratio_pass": (0.5, "ratio")}
    observed = metrics.scorer_metrics(ranking.latest_assessment(tables.assessments(spark, sf)))
    return gate.evaluate_gate(observed.withColumn("metric", renamed("rubric", "rubric_v2")), gate.thresholds(spark, floors))


RUN_FLOORS = {"correctness/ratio_pass": 0.6, "human_correctness/ratio_pass": 0.8}
VERDICTS = base.RUN_METRICS + """,
verdicts AS (SELECT run_id, CAST(n AS INT) AS n_failures, CASE WHEN n = 0 THEN 'true' ELSE 'false' END AS passed FROM (
  SELECT run_id, count(*) FILTER (value IS NULL OR value < CASE metric WHEN 'correctness/ratio_pass' THEN 0.6 ELSE 0.8 END) AS n
  FROM run_metrics WHERE metric <> 'length/mean' GROUP BY run_id))"""


@query("gate_audit", ctes(base.RUNS, VERDICTS) + """SELECT r.run_id, start_day, environment, passed, n_failures FROM runs r LEFT JOIN verdicts v ON r.run_id = v.run_id
WHERE gate = 'pre_deploy' ORDER BY start_day DESC, r.run_id LIMIT 10""")
def gate_audit(spark, sf):
    return gate.gate_audit(tables.runs(spark, sf), gate.gate_by_run(tables.run_metrics(spark, sf), RUN_FLOORS))


@query("loop_audit", ctes(base.RUNS) + "SELECT layer, run_id, start_day FROM runs ORDER BY layer, start_day, run_id")
def loop_audit(spark, sf):
    return gate.loop_audit(tables.runs(spark, sf))


_TWO_RUNS = base.RUN_METRICS + """,
two AS (SELECT metric, max(value) FILTER (run_id = 'src3') AS base, max(value) FILTER (run_id = 'src7') AS candidate FROM run_metrics WHERE run_id IN ('src3', 'src7') GROUP BY metric)"""


@query("run_compare", ctes(_TWO_RUNS) + "SELECT metric, base, candidate, round(candidate - base, 6) AS delta FROM two")
def run_compare(spark, sf):
    return gate.run_compare(tables.run_metrics(spark, sf), "src3", "src7")


@query("degraded_regression", ctes(_TWO_RUNS) + "SELECT metric, base, candidate, round(candidate - base, 6) AS delta FROM two WHERE round(candidate - base, 6) < -0.01")
def degraded_regression(spark, sf):
    return gate.regressions(tables.run_metrics(spark, sf), "src3", "src7", 0.01)
