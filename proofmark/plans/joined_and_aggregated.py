"""Queries: joins, aggregates, agreement and set operations."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from proofmark.functions import text
from proofmark.operators import agreement, joins, keywords, metrics, ranking, retrieval, rollups, setops
from proofmark.operators.monitoring import Registration, Registry
from proofmark.plans import base
from proofmark.plans.base import ctes, query, ratio
from proofmark.plans.tables_and_filters import AS_OF_MS
from proofmark.session import scratch_path
from proofmark.sources import tables

# A short keyword map, as a retrieval test set carries it: word found in a question -> expected documents.
KEYWORD_DOCS = {
    "the": ["english_guide"], "with": ["english_guide", "style_guide"], "que": ["french_guide", "spanish_guide"],
    "une": ["french_guide"], "und": ["german_guide"], "los": ["spanish_guide"], "tion": ["style_guide"],
}
KEYWORD_DOC = {word: docs[0] for word, docs in KEYWORD_DOCS.items()}
JUDGES = ["suite_correctness", "correctness"]
RAG_SCORERS = ["correctness", "retrieval_groundedness"]
YES, CORRECT, GROUNDED = ratio("value = 'yes'"), ratio("correctness = 'yes'"), ratio("groundedness = 'yes'")


def monitors() -> Registry:
    registry = Registry([Registration(n, n) for n in ("correctness", "safety", "rubric", "compliance", "relevance")])
    for name, rate in (("correctness", 0.2), ("safety", 1.0), ("rubric", 0.5), ("compliance", 0.5)):
        registry.start(name, rate)
    return registry


REGISTRY_SQL = "registry AS (SELECT unnest(['correctness', 'safety', 'rubric', 'compliance', 'relevance']) AS name)"


@query("bridge_request_trace", ctes(base.TRACES) + """SELECT trace_id, client_request_id FROM traces
WHERE client_request_id IN (SELECT CAST(event_id AS VARCHAR) FROM events WHERE event_type <> 'error')""")
def bridge_request_trace(spark, sf):
    log = tables.inference_log(spark, sf).where(F.col("status_code") == 200)
    return joins.bridge_request_trace(log, tables.traces(spark, sf)).select("trace_id", "client_request_id")


@query("request_with_trace", ctes(base.TRACES, base.LOG) + """SELECT trace_id, t.client_request_id, l.timestamp_ms, l.status_code, l.execution_duration_ms AS logged_ms, t.execution_duration_ms AS traced_ms,
  l.request AS logged_request, t.request AS traced_request FROM traces t JOIN log l ON l.request_id = t.client_request_id""")
def request_with_trace(spark, sf):
    """What the gateway logged beside what the application traced, in one row."""
    rows = joins.request_with_trace(tables.inference_log(spark, sf), tables.traces(spark, sf))
    return rows.select(
        "trace_id", "client_request_id", "log.timestamp_ms", "log.status_code", F.col("log.execution_duration_ms").alias("logged_ms"),
        F.col("execution_duration_ms").alias("traced_ms"), F.col("log.request").alias("logged_request"), F.col("request").alias("traced_request"),
    )


_RESOLVED = """,
newest AS (SELECT * FROM traces QUALIFY row_number() OVER (PARTITION BY client_request_id ORDER BY request_ms DESC, trace_id DESC) = 1)"""


@query("resolve_client_request", ctes(base.TRACES + _RESOLVED, base.FEEDBACK) + """SELECT f.client_request_id, n.trace_id, f.user_id
FROM feedback f JOIN newest n ON f.client_request_id = n.client_request_id""")
def resolve_client_request(spark, sf):
    return joins.resolve_client_request(tables.feedback(spark, sf), tables.traces(spark, sf)).select("client_request_id", "trace_id", "user_id")


@query("unresolved_feedback", ctes(base.TRACES, base.FEEDBACK) + """SELECT client_request_id, user_id FROM feedback f
WHERE NOT EXISTS (SELECT 1 FROM traces t WHERE t.client_request_id = f.client_request_id)""")
def unresolved_feedback(spark, sf):
    return joins.unresolved_feedback(tables.feedback(spark, sf), tables.traces(spark, sf)).select("client_request_id", "user_id")


ATTACHED = """attached AS (
  SELECT *, md5(concat_ws(chr(31), trace_id, name, source_id)) AS assessment_id, TRY_CAST(value AS DOUBLE) AS value_num, 'HUMAN' AS source_type FROM (
    SELECT trace_id, 'user_helpful' AS name, CASE WHEN helpful THEN 'true' ELSE 'false' END AS value, rationale, f.user_id AS source_id, clicked_ms AS created_ms
    FROM feedback f JOIN newest n ON f.client_request_id = n.client_request_id
    UNION ALL SELECT trace_id, 'satisfaction', CAST(satisfaction AS VARCHAR), NULL, 'aggregate', clicked_ms
    FROM feedback f JOIN newest n ON f.client_request_id = n.client_request_id WHERE satisfaction IS NOT NULL))"""


@query("attach_feedback", ctes(base.TRACES + _RESOLVED, base.FEEDBACK, ATTACHED) + """SELECT trace_id, assessment_id, name, value, value_num, rationale, source_id, source_type, created_ms FROM attached""")
def attach_feedback(spark, sf):
    rows = joins.attach_feedback(tables.feedback(spark, sf), tables.traces(spark, sf))
    return rows.select("trace_id", "assessment_id", "name", "value", "value_num", "rationale", "source_id", "source_type", "created_ms")


@query("feedback_to_latest", ctes(base.TRACES + _RESOLVED, base.FEEDBACK, ATTACHED) + """SELECT trace_id, name, value, created_ms FROM attached
QUALIFY row_number() OVER (PARTITION BY trace_id, name ORDER BY created_ms DESC, assessment_id DESC) = 1""")
def feedback_to_latest(spark, sf):
    """Clicks become assessments, and the last word of each kind on a trace counts."""
    rows = joins.attach_feedback(tables.feedback(spark, sf), tables.traces(spark, sf))
    return ranking.latest_assessment(rows).select("trace_id", "name", "value", "created_ms")


PAIRED = base.LATEST + """,
paired AS (
  SELECT trace_id, coalesce(nullif(max(value) FILTER (name = 'suite_correctness'), ''), nullif(max(value) FILTER (name = 'correctness'), '')) AS judge,
    max(value) FILTER (name = 'human_correctness') AS human FROM latest GROUP BY trace_id),
pairs AS (SELECT * FROM paired WHERE judge IS NOT NULL AND human IS NOT NULL)"""


def _pairs(spark, sf):
    return agreement.judge_human_pairs(tables.assessments(spark, sf), JUDGES, "human_correctness")


@query("judge_human_pairs", ctes(PAIRED) + "SELECT trace_id, judge, human FROM pairs")
def judge_human_pairs(spark, sf):
    return _pairs(spark, sf)


@query("confusion_matrix", ctes(PAIRED) + "SELECT judge, human, count(*) AS n FROM pairs GROUP BY ALL")
def confusion_matrix(spark, sf):
    return agreement.confusion_matrix(_pairs(spark, sf))


@query("agreement_rate", ctes(PAIRED) + f"SELECT count(*) AS n_pairs, {ratio('judge = human')} AS agreement FROM pairs")
def agreement_rate(spark, sf):
    return agreement.agreement_rate(_pairs(spark, sf))


@query("cohens_kappa", ctes(PAIRED) + """SELECT n AS n_pairs, round(po, 6) AS observed, round(pe, 6) AS expected, round(CASE WHEN pe < 1 THEN (po - pe) / (1 - pe) END, 6) AS kappa
FROM (SELECT count(*) AS n, avg((judge = human)::INT)::DOUBLE AS po FROM pairs),
  (SELECT sum(a.share * b.share) AS pe FROM (SELECT judge AS label, count(*) / (SELECT count(*) FROM pairs)::DOUBLE AS share FROM pairs GROUP BY 1) a
   JOIN (SELECT human AS label, count(*) / (SELECT count(*) FROM pairs)::DOUBLE AS share FROM pairs GROUP BY 1) b ON a.label = b.label)""")
def cohens_kappa(spark, sf):
    return agreement.cohens_kappa(_pairs(spark, sf))


@query("human_label_join", ctes(base.GRADED) + """SELECT g.record_id, g.score, l.quality AS human_score FROM graded g JOIN labels l ON g.record_id = CAST(l.doc_id AS VARCHAR)
WHERE run_id = 'v2'""")
def human_label_join(spark, sf):
    labels = tables.load(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("record_id"), F.col("quality").alias("human_score"))
    scores = tables.graded_runs(spark, sf).where("run_id = 'v2'").select("record_id", "score")
    return joins.human_label_join(scores, labels, "record_id")


@query("graded_agreement", ctes(base.GRADED) + f"""SELECT count(*) AS n_pairs, {ratio('judge = human')} AS exact_match, {ratio('abs(judge - human) <= 1')} AS within_1
FROM (SELECT g.score AS judge, 1 + 4 * l.quality - l.toxic AS human FROM graded g JOIN labels l ON g.record_id = CAST(l.doc_id AS VARCHAR) WHERE run_id = 'v2')""")
def graded_agreement(spark, sf):
    human = tables.load(spark, sf, "labels").select(
        F.col("doc_id").cast("string").alias("record_id"), (1 + 4 * F.col("quality") - F.col("toxic")).alias("human")
    )
    judge = tables.graded_runs(spark, sf).where("run_id = 'v2'").select("record_id", F.col("score").alias("judge"))
    return agreement.graded_agreement(joins.human_label_join(judge, human, "record_id"))


_DAY_MS = "strftime(make_timestamp(created_ms * 1000), '%Y-%m-%d')"
_QUALITY = f"""quality AS (SELECT {_DAY_MS} AS day, name, count(*) AS n_scored, {ratio("value = 'yes'")} AS pass_rate FROM assessments GROUP BY ALL)"""


def _rolled_sql(unit: str) -> str:
    return f"""SELECT strftime(date_trunc('{unit}', ts), '%Y-%m-%d') AS begin, count(*) AS total_requests, count(*) FILTER (status_code <> 200) AS blocked,
  round(count(*) FILTER (status_code <> 200) / count(*)::DOUBLE, 6) AS blocked_share, quantile_disc(execution_duration_ms, 0.5) AS latency_p50_ms,
  quantile_disc(execution_duration_ms, 0.95) AS latency_p95_ms, count(DISTINCT user_id) AS n_users FROM log GROUP BY 1"""


def _rolled(spark, sf, unit):
    """Hours are written in two pieces, one of them twice; days and weeks are made of the hours."""
    path = scratch_path(spark, f"hours-{uuid.uuid4().hex}")
    log = tables.inference_log(spark, sf)
    early = F.col("event_date") < F.lit("2024-01-11").cast("date")
    rollups.write_hours(log.where(early), path)
    rollups.write_hours(log.where(~early), path)
    hours = rollups.write_hours(log.where(~early), path)
    return rollups.rolled_up(hours, unit).withColumn("begin", F.date_format("begin", "yyyy-MM-dd"))


@query("daily_from_hours", ctes(base.LOG) + _rolled_sql("day"))
def daily_from_hours(spark, sf):
    return _rolled(spark, sf, "day")


@query("weekly_from_hours", ctes(base.LOG) + _rolled_sql("week"))
def weekly_from_hours(spark, sf):
    return _rolled(spark, sf, "week")


@query("quality_ops_join", ctes(base.LOG, base.ASSESSMENTS, _QUALITY) + """SELECT l.day, total_requests, blocked, name, n_scored, pass_rate
FROM (SELECT strftime(event_date, '%Y-%m-%d') AS day, count(*) AS total_requests, count(*) FILTER (status_code <> 200) AS blocked FROM log GROUP BY ALL) l
LEFT JOIN quality q ON l.day = q.day""")
def quality_ops_join(spark, sf):
    return metrics.quality_ops_join(tables.inference_log(spark, sf), tables.assessments(spark, sf))


DAILY = _QUALITY + """,
rollup_days AS (SELECT l.day, total_requests, blocked_share, latency_p95_ms, pass_rate, n_scored
FROM (SELECT strftime(event_date, '%Y-%m-%d') AS day, count(*) AS total_requests, round(avg(CASE WHEN status_code <> 200 THEN 1.0 ELSE 0.0 END)::DOUBLE, 6) AS blocked_share,
  quantile_disc(execution_duration_ms, 0.95) AS latency_p95_ms FROM log GROUP BY ALL) l
LEFT JOIN (SELECT * FROM quality WHERE name = 'correctness') q ON l.day = q.day)"""


@query("daily_rollup", ctes(base.LOG, base.ASSESSMENTS, DAILY) + "SELECT * FROM rollup_days")
def daily_rollup(spark, sf):
    return metrics.daily_rollup(tables.inference_log(spark, sf), tables.assessments(spark, sf), "correctness")


def _keyword_list(question: str, mapping: dict[str, list[str]]) -> str:
    parts = ", ".join(
        f"CASE WHEN contains(lower({question}), '{w}') THEN [{base.quoted(d)}] ELSE CAST([] AS VARCHAR[]) END" for w, d in mapping.items()
    )
    return f"flatten([{parts}])"


def _keep_order(x: str) -> str:
    """First occurrence of each element, in order."""
    return f"list_filter({x}, lambda d, i: list_position({x}, d) = i)"


@query("keyword_expected_docs", ctes(base.TRACES) + f"""SELECT trace_id, array_to_string({_keep_order('docs')}, ',') AS expected_docs
FROM (SELECT trace_id, {_keyword_list('request', KEYWORD_DOCS)} AS docs FROM traces)""")
def keyword_expected_docs(spark, sf):
    found = joins.keyword_expected_docs(tables.traces(spark, sf).select("trace_id", "request"), KEYWORD_DOCS, "request")
    return found.select("trace_id", F.array_join("expected_docs", ",").alias("expected_docs"))


@query("keyword_retrieve", ctes(base.TRACES) + f"""SELECT trace_id, unnest(CASE WHEN len(docs) > 0 THEN list_distinct(docs) ELSE ['none'] END) AS doc_id
FROM (SELECT trace_id, {_keyword_list('request', {w: [d] for w, d in KEYWORD_DOC.items()})} AS docs FROM traces)""")
def keyword_retrieve(spark, sf):
    return joins.keyword_retrieve(tables.traces(spark, sf).select("trace_id", "request"), KEYWORD_DOC, "request").select("trace_id", "doc_id")


@query("keyword_table_documents", f"""WITH kw AS (SELECT DISTINCT lower(left({base.first_sentence('text')}, 12)) AS keyword, CAST(item_id AS VARCHAR) AS doc_id FROM benchmark
  UNION SELECT DISTINCT name[1:3], 'nation-' || name FROM (SELECT lower(n_name) AS name FROM nation)),
hits AS (SELECT d.doc_id AS key, kw.doc_id, count(*) AS n FROM documents d JOIN (SELECT * FROM kw WHERE length(keyword) > 0) kw ON contains(lower(d.text), kw.keyword) GROUP BY ALL)
SELECT d.doc_id AS key, coalesce(h.doc_id, 'none') AS doc_id, b.text AS content, coalesce(n, 0) AS n_keywords
FROM documents d LEFT JOIN hits h ON h.key = d.doc_id LEFT JOIN benchmark b ON CAST(b.item_id AS VARCHAR) = h.doc_id""")
def keyword_table_documents(spark, sf):
    """Whole documents ask a table of keywords: the beginnings of benchmark passages, and of the names of nations."""
    items = tables.load(spark, sf, "benchmark").select(F.col("item_id").cast("string").alias("doc_id"), F.col("text").alias("content"))
    begin = items.select(F.lower(F.substring(text.first_sentence("content"), 1, 12)).alias("keyword"), "doc_id")
    name = F.lower("n_name")
    nations = tables.load(spark, sf, "nation", "n_name").select(F.substring(name, 1, 3).alias("keyword"), F.concat(F.lit("nation-"), name).alias("doc_id"))
    asked = tables.load_texts(spark, sf, "doc_id", "text").select(F.col("doc_id").alias("key"), "text")
    return keywords.keyword_documents(asked, "key", "text", begin.unionByName(nations), items)


@query("vector_topk", """SELECT query_id, vec_id, CAST(rank AS INT) AS rank, score FROM (
  SELECT q.vec_id AS query_id, v.vec_id, round(round(list_cosine_similarity(q.embedding::DOUBLE[], v.embedding::DOUBLE[]), 9), 6) AS score,
    row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_cosine_similarity(q.embedding::DOUBLE[], v.embedding::DOUBLE[]), 9) DESC, v.vec_id) AS rank
  FROM embeddings q, embeddings v) WHERE rank <= 3""")
def vector_topk(spark, sf):
    index = tables.load(spark, sf, "embeddings", "vec_id", "embedding")
    queries = index.withColumnRenamed("vec_id", "query_id")
    return retrieval.vector_topk(queries, index, 3).select("query_id", "vec_id", "rank", F.round("score", 6).alias("score"))


def _probed_sql() -> str:
    """Written from the definition: centroids by rounds of k-means, probes from held-out vectors, neighbours from the probed cells."""
    def closest(rows: str, centroids: str) -> str:
        return f"""SELECT r.vec_id, r.u, c.cell FROM {rows} r, {centroids} c
  QUALIFY row_number() OVER (PARTITION BY r.vec_id ORDER BY round(list_inner_product(r.u, c.m), 9) DESC, c.cell) = 1"""

    def moved(n: int) -> str:
        return f"""a{n} AS MATERIALIZED ({closest('sample', f'c{n}')}),
s{n} AS (SELECT cell, list(x ORDER BY d) AS total FROM (SELECT cell, d, sum(x) AS x FROM (SELECT cell, unnest(u) AS x, generate_subscripts(u, 1) AS d FROM a{n}) GROUP BY cell, d) GROUP BY cell),
c{n + 1} AS MATERIALIZED (SELECT cell, CASE WHEN total IS NULL THEN m ELSE list_transform(total, lambda x: round(x / sqrt(list_inner_product(total, total)), 6)) END AS m
  FROM c{n} LEFT JOIN s{n} USING (cell))"""

    rounds = retrieval.FIT_ROUNDS
    return f"""WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE embedding IS NOT NULL),
u AS MATERIALIZED (SELECT vec_id, list_transform(e, lambda x: x / CASE WHEN list_inner_product(e, e) = 0 THEN 1 ELSE sqrt(list_inner_product(e, e)) END) AS u FROM v),
size AS (SELECT count(*) AS n, greatest(1, least({retrieval.MOST_CELLS}, ceil(sqrt(count(*))))) AS cells FROM u),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY md5(vec_id::VARCHAR)) - 1 AS cell, list_transform(u, lambda x: round(x, 6)) AS m FROM u
  QUALIFY cell < (SELECT cells FROM size)),
sample AS (SELECT * FROM u WHERE ('0x' || substr(md5('s' || vec_id), 1, 8))::BIGINT / 4294967296.0::DOUBLE < (SELECT {retrieval.SAMPLE_PER_CELL} * cells / n FROM size)),
{", ".join(moved(n) for n in range(rounds))},
filed AS MATERIALIZED ({closest('u', f'c{rounds}')}),
seen AS MATERIALIZED (SELECT vec_id, u, cell, row_number() OVER (PARTITION BY vec_id ORDER BY round(list_inner_product(u, m), 9) DESC, cell) AS place FROM u, c{rounds}),
held AS (SELECT * FROM u ORDER BY md5('h' || vec_id) LIMIT {retrieval.HELD_OUT}),
true_ones AS (SELECT h.vec_id AS query_id, f.cell FROM held h JOIN filed f ON f.vec_id <> h.vec_id
  QUALIFY row_number() OVER (PARTITION BY h.vec_id ORDER BY round(list_inner_product(h.u, f.u), 9) DESC, f.vec_id) <= 3),
probes AS (SELECT list_sort(list(place))[ceil({retrieval.RECALL} * count(*))::INT] AS p FROM true_ones t JOIN seen s ON s.vec_id = t.query_id AND s.cell = t.cell),
met AS (SELECT s.vec_id AS query_id, f.vec_id, round(list_inner_product(s.u, f.u), 9) AS s FROM seen s JOIN filed f USING (cell) WHERE s.place <= (SELECT p FROM probes))
SELECT query_id, vec_id, CAST(rank AS INT) AS rank, round(s, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id) AS rank FROM met) WHERE rank <= 3"""


@query("vector_topk_lsh", _probed_sql())
def vector_topk_lsh(spark, sf):
    index = tables.load(spark, sf, "embeddings", "vec_id", "embedding")
    queries = index.withColumnRenamed("vec_id", "query_id")
    found = retrieval.vector_topk_approx(queries, retrieval.inverted_file(index), 3)
    return found.select("query_id", "vec_id", "rank", F.round("score", 6).alias("score"))


@query("compare_runs_rows", ctes(base.GRADED) + """SELECT record_id, scorer, a.score AS score_a, b.score AS score_b, b.score - a.score AS delta
FROM (SELECT * FROM graded WHERE run_id = 'v1') a JOIN (SELECT * FROM graded WHERE run_id = 'v2') b USING (record_id, scorer)""")
def compare_runs_rows(spark, sf):
    rows = tables.graded_runs(spark, sf)
    return joins.compare_runs_rows(rows.where("run_id = 'v1'"), rows.where("run_id = 'v2'"))


@query("monitor_coverage", ctes(base.ASSESSMENTS, REGISTRY_SQL) + """SELECT r.name, count(a.name) AS n_seen, CASE WHEN count(a.name) = 0 THEN 'missing' ELSE 'seen' END AS coverage
FROM registry r LEFT JOIN assessments a ON r.name = a.name GROUP BY r.name""")
def monitor_coverage(spark, sf):
    return joins.monitor_coverage(monitors().to_df(spark), tables.assessments(spark, sf))


@query("missing_monitors", ctes(base.ASSESSMENTS, REGISTRY_SQL) + "SELECT name FROM registry EXCEPT SELECT name FROM assessments")
def missing_monitors(spark, sf):
    return joins.missing_monitors(monitors().to_df(spark), tables.assessments(spark, sf))


@query("judges_seen", ctes(base.ASSESSMENTS) + "SELECT DISTINCT name FROM assessments")
def judges_seen(spark, sf):
    return joins.judges_seen(tables.assessments(spark, sf))


def cited_records(spark, sf):
    """Records citing documents: each answer cites its own document, German ones also the next."""
    docs = tables.load_texts(spark, sf, "doc_id", "text", "lang")
    own, following = F.col("doc_id").cast("string"), (F.col("doc_id") + 1).cast("string")
    return docs.where(F.col("lang") != "es").select(
        own.alias("record_id"),
        F.array(text.first_sentence("text")).alias("facts"),
        F.when(F.col("lang") == "de", F.array(own, following)).otherwise(F.array(own)).alias("uris"),
    )


CITED = f"""cited AS (
  SELECT CAST(doc_id AS VARCHAR) AS record_id, {base.first_sentence('text')} AS fact,
    unnest(CASE WHEN lang = 'de' THEN [CAST(doc_id AS VARCHAR), CAST(doc_id + 1 AS VARCHAR)] ELSE [CAST(doc_id AS VARCHAR)] END) AS doc_uri
  FROM documents WHERE lang <> 'es')"""


@query("uncovered_docs", ctes(CITED) + "SELECT CAST(doc_id AS VARCHAR) AS doc_uri FROM documents WHERE CAST(doc_id AS VARCHAR) NOT IN (SELECT doc_uri FROM cited)")
def uncovered_docs(spark, sf):
    docs = tables.load(spark, sf, "documents", "doc_id").select(F.col("doc_id").cast("string").alias("doc_uri"))
    return joins.uncovered_docs(docs, cited_records(spark, sf).select(F.explode("uris").alias("doc_uri")))


@query("coverage_by_doc", ctes(CITED) + "SELECT doc_uri, count(*) AS n_questions FROM cited GROUP BY doc_uri ORDER BY n_questions DESC, doc_uri")
def coverage_by_doc(spark, sf):
    return metrics.coverage_by_doc(cited_records(spark, sf))


@query("facts_in_source", ctes(CITED) + """SELECT record_id, doc_uri, fact, CASE WHEN contains(lower(text), lower(fact)) THEN 'yes' ELSE 'no' END AS in_source
FROM cited JOIN documents ON doc_uri = CAST(doc_id AS VARCHAR)""")
def facts_in_source(spark, sf):
    docs = tables.load_texts(spark, sf, "doc_id", "text").select(F.col("doc_id").cast("string").alias("doc_uri"), F.col("text").alias("content"))
    return joins.facts_in_source(cited_records(spark, sf), docs)


# --- aggregates ---------------------------------------------------------------------------------

@query("pass_rate", ctes(base.RAG) + f"""SELECT 'correctness' AS scorer, {ratio("correctness = 'yes'")} AS pass_rate, count(correctness) AS n_scored, count(*) AS n_rows FROM rag
UNION ALL SELECT 'retrieval_groundedness', {ratio("groundedness = 'yes'")}, count(groundedness), count(*) FROM rag""")
def pass_rate(spark, sf):
    return metrics.pass_rate(tables.rag_results(spark, sf), RAG_SCORERS)


@query("mean_score", ctes(base.RAG) + "SELECT 'retrieved_document_recall' AS scorer, round(avg(recall), 6) AS mean_score, count(recall) AS n_scored FROM rag")
def mean_score(spark, sf):
    return metrics.mean_score(tables.rag_results(spark, sf), "retrieved_document_recall")


METRICS = base.LATEST + f""",
per_name AS (SELECT name, round(avg(CASE value WHEN 'yes' THEN 1.0 WHEN 'no' THEN 0.0 ELSE TRY_CAST(value AS DOUBLE) END), 6) AS mean,
  CASE WHEN count(*) FILTER (value IN ('yes', 'no')) > 0 THEN {ratio("value = 'yes'")} END AS ratio_pass FROM latest GROUP BY name),
metrics AS (SELECT name || '/mean' AS metric, mean AS value FROM per_name WHERE mean IS NOT NULL
  UNION ALL SELECT name || '/ratio_pass', ratio_pass FROM per_name WHERE ratio_pass IS NOT NULL)"""


@query("scorer_metrics", ctes(METRICS) + "SELECT metric, value FROM metrics")
def scorer_metrics(spark, sf):
    from proofmark.operators.ranking import latest_assessment

    return metrics.scorer_metrics(latest_assessment(tables.assessments(spark, sf)))


@query("assessment_summary", ctes(base.ASSESSMENTS) + f"SELECT name, count(*) AS n, round(avg(TRY_CAST(value AS DOUBLE)), 6) AS mean, {YES} AS pass_ratio FROM assessments GROUP BY name")
def assessment_summary(spark, sf):
    return metrics.assessment_summary(tables.assessments(spark, sf))


@query("score_distribution", ctes(base.GRADED) + "SELECT run_id, score, count(*) AS n FROM graded GROUP BY ALL")
def score_distribution(spark, sf):
    return metrics.score_distribution(tables.graded_runs(spark, sf))


HEALTH = """count(*) AS total_requests, count(*) FILTER (status_code = 200) AS passed, count(*) FILTER (status_code <> 200) AS blocked_or_errored,
  quantile_disc(execution_duration_ms, 0.5) AS latency_p50_ms, quantile_disc(execution_duration_ms, 0.95) AS latency_p95_ms"""


@query("traffic_health", ctes(base.LOG) + f"SELECT {HEALTH} FROM log WHERE timestamp_ms > {AS_OF_MS} - 24 * 3600000")
def traffic_health(spark, sf):
    from proofmark.operators.filters import recent_window

    return metrics.traffic_health(recent_window(tables.inference_log(spark, sf), AS_OF_MS, 24, "ts"))


@query("status_mix", ctes(base.LOG) + "SELECT status_code, count(*) AS n FROM log GROUP BY status_code")
def status_mix(spark, sf):
    return metrics.status_mix(tables.inference_log(spark, sf))


@query("count_by_source", """SELECT 'documents' AS source, count(*) AS n FROM documents UNION ALL SELECT 'edge', count(*) FROM benchmark ORDER BY source""")
def count_by_source(spark, sf):
    from proofmark.operators.filters import normalise_records

    docs = normalise_records(tables.raw_records(spark, sf), "documents").select("tags")
    edge = tables.load(spark, sf, "benchmark", "item_id").select(F.create_map(F.lit("source"), F.lit("edge"), F.lit("category"), F.lit("benchmark")).alias("tags"))
    return metrics.count_by_source(docs.unionByName(edge))


@query("cohort_scores", ctes(base.RAG) + """SELECT source, lang, CAST(grouping(source, lang) AS INT) AS level, count(*) AS n, round(avg(recall), 6) AS mean_score FROM rag GROUP BY ROLLUP (source, lang)""")
def cohort_scores(spark, sf):
    return metrics.cohort_scores(tables.rag_results(spark, sf), ["source", "lang"], F.col("`retrieved_document_recall/value`"))


@query("human_feedback_summary", ctes(base.ASSESSMENTS) + """SELECT count(*) FILTER (name = 'user_helpful') AS n_helpful, round(avg((value = 'true')::INT) FILTER (name = 'user_helpful'), 6) AS helpful_rate,
  count(*) FILTER (name = 'satisfaction') AS n_satisfaction, round(avg(TRY_CAST(value AS DOUBLE)) FILTER (name = 'satisfaction'), 6) AS mean_satisfaction
FROM assessments WHERE source_type = 'HUMAN'""")
def human_feedback_summary(spark, sf):
    return metrics.human_feedback_summary(tables.assessments(spark, sf))


@query("feedback_by_source_type", ctes(base.ASSESSMENTS) + """SELECT name, count(*) FILTER (source_type = 'HUMAN') AS "HUMAN", count(*) FILTER (source_type = 'LLM_JUDGE') AS "LLM_JUDGE",
  count(*) FILTER (source_type = 'CODE') AS "CODE" FROM assessments GROUP BY name""")
def feedback_by_source_type(spark, sf):
    return metrics.feedback_by_source_type(tables.assessments(spark, sf), ["HUMAN", "LLM_JUDGE", "CODE"])


@query("run_summary", ctes(base.RAG) + f"SELECT 'v1' AS run, count(*) AS n_rows, {CORRECT} AS correctness_rate, {GROUNDED} AS retrieval_groundedness_rate FROM rag")
def run_summary(spark, sf):
    return metrics.run_summary(tables.rag_results(spark, sf), "v1", RAG_SCORERS)


@query("session_summary", ctes(base.TRACES) + """SELECT session_id, count(*) AS n_traces, count(*) FILTER (state <> 'OK') AS n_errors, min(request_ms) AS first_ms, max(request_ms) AS last_ms,
  round(avg(execution_duration_ms), 6) AS mean_latency_ms FROM traces GROUP BY session_id""")
def session_summary(spark, sf):
    return metrics.session_summary(tables.traces(spark, sf))


@query("sampled_vs_total", ctes(base.ASSESSMENTS) + """SELECT name, count(DISTINCT trace_id) AS n_sampled, (SELECT count(*) FROM documents) AS n_total,
  round(count(DISTINCT trace_id) / (SELECT count(*) FROM documents)::DOUBLE, 6) AS sampled_share FROM assessments GROUP BY name""")
def sampled_vs_total(spark, sf):
    return metrics.sampled_vs_total(tables.load(spark, sf, "documents", "doc_id"), tables.assessments(spark, sf))


_N_WORDS = f"len({base.words('request')}) + len({base.words('response')})"


@query("token_usage", ctes(base.LOG) + f"""SELECT user_id, strftime(event_date, '%Y-%m-%d') AS day, count(*) AS n_requests, CAST(sum({_N_WORDS}) AS BIGINT) AS n_tokens,
  round(CAST(sum({_N_WORDS}) AS DOUBLE) * 0.5 / 1000, 6) AS cost FROM log GROUP BY ALL""")
def token_usage(spark, sf):
    return metrics.token_usage(tables.inference_log(spark, sf), 0.5)


@query("pass_rate_trend", ctes(base.ASSESSMENTS) + """SELECT name, day_no, n, round(sum(n_yes) OVER w / sum(n) OVER w, 6) AS rolling_pass_rate
FROM (SELECT name, created_ms // 86400000 AS day_no, count(*) AS n, count(*) FILTER (value = 'yes') AS n_yes FROM assessments GROUP BY ALL)
WINDOW w AS (PARTITION BY name ORDER BY day_no RANGE BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def pass_rate_trend(spark, sf):
    return metrics.pass_rate_trend(tables.assessments(spark, sf), 7)


# --- set operations -----------------------------------------------------------------------------

@query("union_runs", ctes(base.GRADED) + "SELECT run_id, record_id, score FROM graded")
def union_runs(spark, sf):
    rows = tables.graded_runs(spark, sf).select("run_id", "record_id", "score")
    return setops.stack_runs(rows.where("run_id = 'v1'"), rows.where("run_id = 'v2'"))


@query("ordered_array_dedupe", ctes(base.TRACES) + f"""SELECT trace_id, array_to_string({_keep_order('toks')}, ' ') AS distinct_tokens
FROM (SELECT trace_id, {base.tokens('request')} AS toks FROM traces)""")
def ordered_array_dedupe(spark, sf):
    rows = tables.traces(spark, sf).select("trace_id", text.tokens("request").alias("t"))
    return setops.ordered_array_dedupe(rows, "t").select("trace_id", F.array_join("t", " ").alias("distinct_tokens"))


@query("array_overlap", ctes(base.TRACES) + f"""SELECT trace_id, array_to_string(list_sort(list_intersect({base.terms('request')}, {base.terms('response')})), ' ') AS shared FROM traces""")
def array_overlap(spark, sf):
    rows = tables.traces(spark, sf).select("trace_id", text.content_terms("request").alias("q"), text.content_terms("response").alias("a"))
    return setops.array_overlap(rows, "q", "a").select("trace_id", F.array_join(F.array_sort("overlap"), " ").alias("shared"))


@query("dedupe_questions", ctes(base.ANSWERS) + "SELECT question, record_id, source FROM answers QUALIFY row_number() OVER (PARTITION BY question ORDER BY doc_id) = 1")
def dedupe_questions(spark, sf):
    rows = tables.answers(spark, sf).select("question", "record_id", "source", "doc_id")
    return setops.dedupe_questions(rows, "question", ["doc_id"]).select("question", "record_id", "source")
