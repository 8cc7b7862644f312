"""Queries: code scorers and lexical judges."""

from __future__ import annotations

from pyspark.sql import functions as F

from proofmark.functions import text
from proofmark.operators import filters, harness, judges, retrieval, scorers
from proofmark.operators.judges import Override, Rule
from proofmark.plans import base
from proofmark.plans.base import ctes, query, yes_no
from proofmark.plans.joined_and_aggregated import KEYWORD_DOCS, _keyword_list
from proofmark.sources import tables

# Product terms, banned words, off-topic words and concept words of the invented test prose.
TERMS = ["the", "que", "und", "los"]
LEXICON = ["hash", "hate", "ou", "haha"]
OFF_TOPIC = ["wetter", "ree", "shh"]
CONCEPTS = ["tion", "ment", "ung", "ado"]
RULES = [
    Rule("language", "en"),
    Rule("max_sentences", "8"),
    Rule("must_not_match", "[0-9]{6,}"),
    Rule("must_match", "tion|ing", question_guard="the"),
]


def _score(df, key, score):
    return df.select(key, score.value.alias("value"))


def _score_said(df, key, score):
    return df.select(key, score.value.alias("value"), score.rationale.alias("rationale"))


@query("score_word_count", ctes(base.ANSWERS) + f"SELECT record_id, CAST(len({base.words('outputs')}) AS VARCHAR) AS value FROM answers")
def score_word_count(spark, sf):
    return _score(tables.answers(spark, sf), "record_id", scorers.word_count())


def coded(spark, sf):
    """Answers of which the Spanish ones carry a code block."""
    fenced = F.concat(F.lit("```sql\n"), "outputs", F.lit("\n```"))
    return tables.answers(spark, sf).withColumn("outputs", F.when(F.col("lang") == "es", fenced).otherwise(F.col("outputs")))


@query("score_code_block", ctes(base.ANSWERS) + "SELECT record_id, CASE WHEN lang = 'es' OR contains(outputs, '```') THEN 'yes' ELSE 'no' END AS value FROM answers")
def score_code_block(spark, sf):
    return _score(coded(spark, sf), "record_id", scorers.has_code_block())


@query("score_span_latency", ctes(base.SPANS) + """SELECT t.trace_id, round((end_time_ns - start_time_ns) / 1e6, 3) AS span_ms,
  CASE WHEN (end_time_ns - start_time_ns) / 1e6 <= 5000 THEN 'yes' ELSE 'no' END AS value
FROM traces t LEFT JOIN (SELECT * FROM spans WHERE span_type = 'CHAT_MODEL' QUALIFY row_number() OVER (PARTITION BY trace_id ORDER BY start_time_ns, span_id) = 1) s ON t.trace_id = s.trace_id""")
def score_span_latency(spark, sf):
    traces = tables.traces(spark, sf)
    return scorers.span_latency(traces, filters.explode_spans(tables.with_span_array(traces)))


@query("score_trace_latency", ctes(base.TRACES) + f"""SELECT trace_id, {yes_no('execution_duration_ms <= 8000')} AS value,
  CASE WHEN execution_duration_ms IS NULL THEN 'latency missing' ELSE 'measured' END AS rationale FROM traces""")
def score_trace_latency(spark, sf):
    return _score_said(tables.traces(spark, sf), "trace_id", scorers.trace_latency())


@query("score_valid_json", ctes(base.LOG) + "SELECT request_id, CASE WHEN json_valid(request) THEN 'yes' ELSE 'no' END AS value FROM log")
def score_valid_json(spark, sf):
    return _score(tables.inference_log(spark, sf), "request_id", scorers.valid_json("request"))


@query("score_strict_json", ctes(base.LOG) + """SELECT request_id, CASE WHEN json_valid(body) THEN 'yes' ELSE 'no' END AS value
FROM (SELECT request_id, CASE CAST(request_id AS BIGINT) % 3 WHEN 0 THEN request ELSE CASE CAST(request_id AS BIGINT) % 3 WHEN 1 THEN request || request ELSE request || ',' END END AS body FROM log)""")
def score_strict_json(spark, sf):
    """Every third body as it is, every third twice over, every third with a stray comma."""
    turn = F.col("request_id").cast("bigint") % 3
    body = F.when(turn == 0, F.col("request")).when(turn == 1, F.concat("request", "request")).otherwise(F.concat("request", F.lit(",")))
    return _score(tables.inference_log(spark, sf).withColumn("request", body), "request_id", scorers.valid_json("request", strict=True))


@query("score_json_schema", "SELECT event_id, CASE WHEN json_valid(props) AND json_extract(props, '$.k') IS NOT NULL THEN 'yes' ELSE 'no' END AS value FROM events")
def score_json_schema(spark, sf):
    events = tables.load(spark, sf, "events", "event_id", "props")
    return _score(events, "event_id", scorers.conforms("k INT", ["k"], "props"))


@query("score_citation", ctes(base.ANSWERS) + """SELECT record_id, CASE WHEN len(c) > 0 THEN 'yes' ELSE 'no' END AS value, array_to_string(c, ',') AS rationale
FROM (SELECT record_id, regexp_extract_all(outputs, '\\[[^\\]]+\\]') AS c FROM answers)""")
def score_citation(spark, sf):
    return _score_said(tables.answers(spark, sf), "record_id", scorers.has_citation())


@query("score_term_mention", ctes(base.ANSWERS) + f"""SELECT record_id, CASE WHEN len(m) > 0 THEN 'yes' ELSE 'no' END AS value, array_to_string(list_sort(m), ',') AS rationale
FROM (SELECT record_id, list_distinct(list_filter(regexp_extract_all(lower(outputs), '[\\p{{L}}\\p{{N}}_]+'), lambda t: t IN ({base.quoted(TERMS)}))) AS m FROM answers)""")
def score_term_mention(spark, sf):
    return _score_said(tables.answers(spark, sf), "record_id", scorers.mentions(TERMS))


@query("score_exact_match", ctes(base.ANSWERS) + f"""SELECT record_id, {yes_no("trim(question) = trim(outputs) OR (length(trim(question)) <= 20 AND contains(trim(outputs), trim(question)))")} AS value FROM answers""")
def score_exact_match(spark, sf):
    return _score(tables.answers(spark, sf), "record_id", scorers.exact_match("question", "outputs", short=20))


@query("score_length", ctes(base.ANSWERS) + f"""SELECT record_id, {yes_no(f"len({base.words('outputs')}) BETWEEN 20 AND 200")} AS value, CAST(len({base.words('outputs')}) AS VARCHAR) AS rationale FROM answers""")
def score_length(spark, sf):
    return _score_said(tables.answers(spark, sf), "record_id", scorers.length_between(20, 200))


KEYWORD_RETRIEVED = {"the": ["english_guide"], "eau": ["french_guide"], "ed": ["style_guide"], "en": ["german_guide"], "que": ["spanish_guide"]}


@query("score_retrieval_recall", ctes(base.TRACES, f"""docs AS (SELECT trace_id AS record_id, list_distinct({_keyword_list('request', KEYWORD_DOCS)}) AS e, list_distinct({_keyword_list('response', KEYWORD_RETRIEVED)}) AS r FROM traces)""")
  + """SELECT record_id, len(e) AS n_expected, len(list_intersect(e, r)) AS n_hit, CASE WHEN len(e) > 0 THEN round_even(len(list_intersect(e, r)) / len(e)::DOUBLE, 2)::DOUBLE END AS recall FROM docs""")
def score_retrieval_recall(spark, sf):
    from proofmark.operators.joins import keyword_documents

    traces = tables.traces(spark, sf)
    expected = traces.select(F.col("trace_id").alias("record_id"), F.explode_outer(keyword_documents("request", KEYWORD_DOCS)).alias("doc_id"))
    spans = filters.explode_spans(tables.with_span_array(traces, keyword_documents("response", KEYWORD_RETRIEVED)))
    return scorers.retrieval_recall(expected, retrieval.retrieved_documents(spans).withColumnRenamed("trace_id", "record_id"))


# All users times days of the log are traces, also those without a call; odd-numbered days expect three calls.
TOOL_TRACES = base.TOOLS + """,
tool_traces AS (SELECT user_id || '/' || strftime(day, '%Y-%m-%d') AS trace_id, CASE WHEN user_id % 2 = 1 THEN 3 END AS expected_tool_calls
  FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) + INTERVAL 1 DAY AS day FROM events))"""


def tool_traces(spark, sf):
    """Traces that tools may have run on: the day after each active day of a user."""
    events = tables.load(spark, sf, "events", "user_id", "ts")
    days = events.select("user_id", F.date_add(F.to_date("ts"), 1).alias("day")).distinct()
    return days.select(
        F.concat_ws("/", F.col("user_id").cast("string"), F.date_format("day", "yyyy-MM-dd")).alias("trace_id"),
        F.when(F.col("user_id") % 2 == 1, F.lit(3)).alias("expected_tool_calls"),
    )


_CALLS = TOOL_TRACES + """,
calls AS (SELECT t.trace_id, t.expected_tool_calls, count(c.span_id) AS n_calls, count(c.span_id) - count(DISTINCT c.tool || '/' || c.args) AS n_redundant
  FROM tool_traces t LEFT JOIN tools c ON t.trace_id = c.trace_id GROUP BY ALL)"""


@query("score_tool_count", ctes(_CALLS) + "SELECT trace_id, n_calls, CASE WHEN n_calls <= 3 THEN 'ok' ELSE 'too_many' END AS value FROM calls")
def score_tool_count(spark, sf):
    return scorers.tool_count(tool_traces(spark, sf), tables.tool_spans(spark, sf))


@query("score_expected_tools", ctes(_CALLS) + f"SELECT trace_id, n_calls, expected_tool_calls, {yes_no('n_calls = expected_tool_calls')} AS value FROM calls")
def score_expected_tools(spark, sf):
    return scorers.expected_tools(tool_traces(spark, sf), tables.tool_spans(spark, sf))


@query("score_tool_efficiency", ctes(_CALLS) + f"""SELECT trace_id, n_calls, n_redundant, {yes_no('n_redundant = 0 AND coalesce(n_calls <= expected_tool_calls, true)')} AS value FROM calls""")
def score_tool_efficiency(spark, sf):
    return scorers.tool_efficiency(tool_traces(spark, sf), tables.tool_spans(spark, sf))


@query("score_trajectory", ctes(base.TOOLS) + """SELECT trace_id, count(*) AS n_steps, coalesce(max(CASE WHEN tool = 'view' AND n = 1 THEN 1 END), 0) + coalesce(max(CASE WHEN tool = 'click' AND n = 2 THEN 1 END), 0) AS n_matching,
  CASE WHEN string_agg(tool, '>' ORDER BY n) = 'view>click' THEN 'yes' ELSE 'no' END AS value
FROM (SELECT *, row_number() OVER (PARTITION BY trace_id ORDER BY start_time_ns, span_id) AS n FROM tools) GROUP BY trace_id""")
def score_trajectory(spark, sf):
    return scorers.score_trajectory(tables.tool_spans(spark, sf), ["view", "click"])


ROUTE = ["view", "click", "view", "purchase"]


@query("score_trajectory_alignment", ctes(base.TOOLS).replace("WITH ", "WITH RECURSIVE ", 1) + """,
steps AS (SELECT trace_id, tool, row_number() OVER (PARTITION BY trace_id ORDER BY start_time_ns, span_id) AS n FROM tools),
walked AS (
  SELECT trace_id, 0 AS n, 0 AS a, 0 AS b, 0 AS c, 0 AS d FROM steps WHERE n = 1
  UNION ALL
  SELECT trace_id, n, a1, b1, c1, greatest(d, c1, CASE WHEN tool = 'purchase' THEN c + 1 ELSE 0 END)
  FROM (SELECT *, greatest(c, b1, CASE WHEN tool = 'view' THEN b + 1 ELSE 0 END) AS c1
    FROM (SELECT *, greatest(b, a1, CASE WHEN tool = 'click' THEN a + 1 ELSE 0 END) AS b1
      FROM (SELECT w.trace_id, s.n, s.tool, w.a, w.b, w.c, w.d, greatest(w.a, CASE WHEN s.tool = 'view' THEN 1 ELSE 0 END) AS a1
        FROM walked w JOIN steps s ON s.trace_id = w.trace_id AND s.n = w.n + 1)))),
ends AS (SELECT trace_id, n AS n_steps, d::BIGINT AS m FROM walked WHERE n > 0 QUALIFY row_number() OVER (PARTITION BY trace_id ORDER BY n DESC) = 1)
SELECT trace_id, n_steps, m AS n_matched, n_steps - m AS n_inserted, 4 - m AS n_skipped, round(2 * m / (n_steps + 4)::DOUBLE, 6) AS similarity,
  CASE WHEN n_steps = m AND m = 4 THEN 'yes' ELSE 'no' END AS value FROM ends""")
def score_trajectory_alignment(spark, sf):
    return scorers.align_trajectory(tables.tool_spans(spark, sf), ROUTE)


@query("score_knowledge_retention", ctes(f"""turns AS (SELECT conv_id, turn, role, {base.terms('text')} AS t FROM conversations WHERE role IN ('user', 'assistant')),
ends AS (SELECT conv_id, max(turn) FILTER (role = 'assistant') AS la FROM turns GROUP BY conv_id),
lasts AS (SELECT e.conv_id, la, max(turn) AS lq FROM ends e JOIN turns u ON u.conv_id = e.conv_id AND u.role = 'user' AND u.turn < e.la GROUP BY ALL),
per AS (SELECT l.conv_id, (SELECT list_distinct(flatten(list(t))) FROM turns u WHERE u.conv_id = l.conv_id AND u.role = 'user' AND u.turn < l.lq) AS want,
  (SELECT any_value(t) FROM turns a WHERE a.conv_id = l.conv_id AND a.turn = l.la) AS have FROM lasts l)""")
  + """SELECT conv_id, coalesce(len(want), 0) AS n_terms, CASE WHEN len(want) > 0 THEN round(len(list_intersect(want, have)) / len(want)::DOUBLE, 6) END AS retention FROM per""")
def score_knowledge_retention(spark, sf):
    return judges.knowledge_retention(tables.load(spark, sf, "conversations"))


def fact_records(spark, sf):
    """Answers with expected facts: the document's own source word and, where ids meet, a benchmark passage."""
    bench = tables.load(spark, sf, "benchmark").select(F.col("item_id").alias("doc_id"), F.col("text").alias("passage"))
    docs = tables.answers(spark, sf).join(bench, "doc_id", "left")
    facts = F.when(F.col("lang") != "es", F.filter(F.array("question", "passage"), lambda f: f.isNotNull()))
    return docs.withColumn("facts", facts)


@query("score_correctness", ctes(base.ANSWERS, """facts AS (SELECT a.record_id, outputs, unnest([question, b.text]) AS fact FROM answers a LEFT JOIN benchmark b ON a.doc_id = b.item_id WHERE lang <> 'es')""")
  + """SELECT a.record_id, CASE WHEN count(f.fact) > 0 THEN CASE WHEN bool_and(contains(lower(a.outputs), lower(f.fact))) THEN 'yes' ELSE 'no' END END AS value,
  CASE WHEN count(f.fact) > 0 THEN coalesce(string_agg(f.fact, ' | ' ORDER BY f.fact) FILTER (NOT contains(lower(a.outputs), lower(f.fact))), '') END AS rationale
FROM answers a LEFT JOIN (SELECT * FROM facts WHERE fact IS NOT NULL) f ON a.record_id = f.record_id GROUP BY a.record_id""")
def score_correctness(spark, sf):
    return judges.correctness(fact_records(spark, sf)).select("record_id", "value", "rationale")


@query("score_relevance", ctes(base.TRACES, f"cov AS (SELECT trace_id, {base.terms('request')} AS q, {base.tokens('response')} AS a FROM traces)")
  + f"SELECT trace_id, round({base.coverage('q', 'a')}, 6) AS coverage, {yes_no('round(' + base.coverage('q', 'a') + ', 6) >= 0.3')} AS value FROM cov")
def score_relevance(spark, sf):
    return judges.relevance(tables.traces(spark, sf), "request", "response").select("trace_id", "coverage", "value")


def retrieved_neighbours(spark, sf):
    """Retrieval results, ids only: each answer is served the next two documents, where they exist."""
    return tables.load(spark, sf, "documents", "doc_id").select(
        F.inline(F.array(*[F.struct((F.col("doc_id") - r).cast("string").alias("record_id"), F.lit(r).alias("rank")) for r in (1, 2)])),
        F.col("doc_id").cast("string").alias("doc_id"),
    ).where(F.col("record_id").cast("bigint") >= 0)


def contents(spark, sf):
    """The documents that retrieval draws on."""
    return tables.load_texts(spark, sf, "doc_id", "text").select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").alias("content"))


NEIGHBOURS = """neighbours AS (SELECT CAST(d.doc_id - r.rank AS VARCHAR) AS record_id, r.rank, CAST(d.doc_id AS VARCHAR) AS doc_id, d.text AS content
  FROM documents d, (SELECT unnest([1, 2]) AS rank) r WHERE d.doc_id - r.rank >= 0)"""


@query("score_groundedness", ctes(base.ANSWERS, NEIGHBOURS, f"""context AS (SELECT record_id, list_distinct(flatten(list({base.terms('content')}))) AS context FROM neighbours GROUP BY record_id),
pieces AS (SELECT record_id, {base.terms('s')} AS t FROM (SELECT record_id, unnest({base.sentences('outputs')}) AS s FROM answers)),
bad AS (SELECT p.record_id, count(*) AS n FROM pieces p JOIN context c ON p.record_id = c.record_id WHERE len(t) > 0 AND len(list_intersect(t, context)) / len(t)::DOUBLE < 0.5 GROUP BY 1)""")
  + """SELECT a.record_id, CASE WHEN context IS NOT NULL THEN CAST(coalesce(n, 0) AS INT) END AS n_unsupported,
  CASE WHEN context IS NOT NULL THEN CASE WHEN coalesce(n, 0) = 0 THEN 'yes' ELSE 'no' END END AS value
FROM answers a LEFT JOIN context c ON a.record_id = c.record_id LEFT JOIN bad b ON a.record_id = b.record_id""")
def score_groundedness(spark, sf):
    return judges.groundedness(tables.answers(spark, sf), retrieved_neighbours(spark, sf), contents(spark, sf))


@query("score_retrieval_relevance", ctes(base.ANSWERS, NEIGHBOURS, f"""met AS (SELECT n.record_id, {base.terms('a.question')} AS q, {base.tokens('n.content')} AS d FROM neighbours n JOIN answers a ON n.record_id = a.record_id)""")
  + f"SELECT record_id, count(*) AS n_docs, round(avg(CASE WHEN {base.coverage('q', 'd')} >= 0.3 THEN 1.0 ELSE 0.0 END)::DOUBLE, 6) AS relevance FROM met GROUP BY record_id")
def score_retrieval_relevance(spark, sf):
    return judges.retrieval_relevance(tables.answers(spark, sf), retrieved_neighbours(spark, sf), contents(spark, sf))


_REASON = f"coalesce({base.first_pii('text')}, CASE WHEN list_has_any({base.tokens('text')}, [{base.quoted(LEXICON)}]) THEN 'lexicon' END)"


@query("score_safety", f"SELECT doc_id, CASE WHEN {_REASON} IS NULL THEN 'yes' ELSE 'no' END AS value, {_REASON} AS rationale FROM documents")
def score_safety(spark, sf):
    return _score_said(tables.load_texts(spark, sf, "doc_id", "text"), "doc_id", judges.safety("text", LEXICON))


_RULE_SQL = ctes(base.ANSWERS, f"""checked AS (SELECT record_id, {base.language('outputs')} = 'en' AS r1, len({base.sentences('outputs')}) <= 8 AS r2,
  NOT regexp_matches(outputs, '[0-9]{{6,}}') AS r3, CASE WHEN regexp_matches(question, 'the') THEN regexp_matches(outputs, 'tion|ing') END AS r4 FROM answers)""")


PHRASES = ["the", "of the", "in and the", "Ou", "que la", "der, die"]


@query("phrase_hits", f"""WITH p AS (SELECT phrase, ' ' || array_to_string({base.tokens('phrase')}, ' ') || ' ' AS g FROM (SELECT unnest([{base.quoted(PHRASES)}]) AS phrase)),
d AS (SELECT doc_id, ' ' || array_to_string({base.tokens('text')}, ' ') || ' ' AS t FROM documents)
SELECT doc_id, phrase FROM d, p WHERE contains(t, g)""")
def phrase_hits(spark, sf):
    """Phrases of a table that each document uses as whole tokens."""
    from proofmark.operators.joins import phrase_hits as hits
    from proofmark.sources.files import small_table

    phrases = small_table(spark, [(p,) for p in PHRASES], "phrase STRING")
    return hits(tables.load_texts(spark, sf, "doc_id", "text"), "doc_id", "text", phrases)


@query("score_guidelines", _RULE_SQL + """SELECT record_id, 'compliance' AS scorer, CASE WHEN r1 AND r2 AND r3 AND coalesce(r4, true) THEN 'yes' ELSE 'no' END AS value,
  concat_ws(',', CASE WHEN NOT r1 THEN '1' END, CASE WHEN NOT r2 THEN '2' END, CASE WHEN NOT r3 THEN '3' END, CASE WHEN NOT r4 THEN '4' END) AS failed_rules FROM checked""")
def score_guidelines(spark, sf):
    return judges.guidelines(tables.answers(spark, sf), "record_id", "compliance", RULES)


@query("rule_breakdown", _RULE_SQL + """SELECT 'compliance' AS scorer, rule_id, count(*) AS n, count(p) AS n_applied, round(avg(CASE WHEN p THEN 1.0 ELSE 0.0 END)::DOUBLE, 6) AS pass_share
FROM (SELECT unnest([1, 2, 3, 4]) AS rule_id, unnest([r1, r2, r3, r4]) AS p FROM checked) GROUP BY rule_id""")
def rule_breakdown(spark, sf):
    from proofmark.operators.metrics import rule_breakdown as breakdown

    return breakdown(judges.rule_results(tables.answers(spark, sf), "record_id", "compliance", RULES))


def row_rules(spark, sf):
    """Answers with rules of their own, by language; Spanish ones have none, some German ones have rules of no known kind."""
    by_lang = {
        "en": ["language:en", "max_sentences:20", "must_match:^[A-Z\\[]"],
        "fr": ["must_contain:tion", "max_sentences:20"],
        "de": ["must_not_contain:und", "language:de"],
    }
    rules = F.when(F.col("lang") == "none", F.array().cast("array<string>"))
    for lang, listed in by_lang.items():
        rules = rules.when(F.col("lang") == lang, F.array(*[F.lit(r) for r in listed]))
    listed = rules.otherwise(F.array().cast("array<string>"))
    odd = F.array(F.lit("be polite"), F.lit("max_sentences:few"))
    is_odd = (F.col("lang") == "de") & (F.col("source") == "src3")
    return tables.answers(spark, sf).withColumn("guidelines", F.when(is_odd, F.concat(listed, odd)).otherwise(listed))


@query("score_row_guidelines", ctes(base.ANSWERS, f"""c AS (SELECT record_id, lang, {base.language('outputs')} AS l, len({base.sentences('outputs')}) AS n, lower(outputs) AS o, outputs AS raw, source FROM answers),
f AS (SELECT record_id, lang, CASE WHEN lang = 'de' AND source = 'src3' THEN 'be polite,max_sentences:few' ELSE '' END AS unknown_rules, CASE lang
  WHEN 'en' THEN concat_ws(',', CASE WHEN l <> 'en' THEN 'language:en' END, CASE WHEN n > 20 THEN 'max_sentences:20' END, CASE WHEN NOT regexp_matches(raw, '^[A-Z\\[]') THEN 'must_match:^[A-Z\\[]' END)
  WHEN 'fr' THEN concat_ws(',', CASE WHEN NOT contains(o, 'tion') THEN 'must_contain:tion' END, CASE WHEN n > 20 THEN 'max_sentences:20' END)
  WHEN 'de' THEN concat_ws(',', CASE WHEN contains(o, 'und') THEN 'must_not_contain:und' END, CASE WHEN l <> 'de' THEN 'language:de' END) ELSE '' END AS failed_rules FROM c)""")
  + "SELECT record_id, CASE WHEN lang <> 'es' AND unknown_rules = '' THEN CASE WHEN failed_rules = '' THEN 'yes' ELSE 'no' END END AS value, failed_rules, unknown_rules FROM f")
def score_row_guidelines(spark, sf):
    return judges.row_guidelines(row_rules(spark, sf), "record_id")


def _any_sql(x: str, needles: list[str]) -> str:
    return "(" + " OR ".join(f"contains(lower({x}), '{n}')" for n in needles) + ")"


@query("score_rubric", ctes(base.TRACES, f"""cov AS (SELECT trace_id, request, response, {base.coverage('q', 'a')} AS c, len(tk) AS n_tokens
  FROM (SELECT *, {base.terms('request')} AS q, {base.tokens('response')} AS a, {base.tokens('request')} AS tk FROM traces)),
b AS (SELECT *, least(5, 1 + floor(c * 4)) AS s0 FROM cov),
s AS (SELECT *, CASE WHEN {_any_sql('request', OFF_TOPIC)} THEN least(s0, 1) ELSE s0 END AS s1 FROM b WHERE s0 IS NOT NULL UNION ALL SELECT *, NULL FROM b WHERE s0 IS NULL),
s2 AS (SELECT *, CASE WHEN length(response) < 150 AND n_tokens >= 4 THEN least(s1, 2) ELSE s1 END AS sb FROM s)""")
  + f"SELECT trace_id, CAST(CASE WHEN s0 IS NULL THEN NULL WHEN NOT {_any_sql('response', CONCEPTS)} THEN least(sb, 3) ELSE sb END AS INT) AS score FROM s2")
def score_rubric(spark, sf):
    covered = judges.relevance(tables.traces(spark, sf).withColumn("_n", F.size(text.tokens("request"))), "request", "response")
    grade = judges.rubric(
        F.col("coverage"),
        [
            Override(text.contains_any("request", OFF_TOPIC), 1),
            Override((F.length("response") < 150) & (F.col("_n") >= 4), 2),
            Override(~text.contains_any("response", CONCEPTS), 3),
        ],
    )
    return covered.select("trace_id", grade.alias("score"))


PROMPT = "Question:\n{{ inputs }}\n\nAnswer:\n{{ outputs }}\n\nGive a whole number from 1 to 5 on the last line."


@query("render_prompt", ctes(base.ANSWERS) + """SELECT record_id, 'Question:' || chr(10) || question || chr(10) || chr(10) || 'Answer:' || chr(10) || outputs || chr(10) || chr(10) || 'Give a whole number from 1 to 5 on the last line.' AS prompt FROM answers""")
def render_prompt(spark, sf):
    return tables.answers(spark, sf).select("record_id", harness.render_prompt(PROMPT, inputs="question", outputs="outputs").alias("prompt"))


@query("parse_final_score", """SELECT doc_id, CASE WHEN k BETWEEN 1 AND 5 THEN k END AS score
FROM (SELECT doc_id, TRY_CAST(nullif(regexp_extract(text || chr(10) || (n_chars % 8) || chr(10), '(\\d+)\\s*$', 1), '') AS INT) AS k FROM documents)""")
def parse_final_score(spark, sf):
    docs = tables.load_texts(spark, sf, "doc_id", "text", "n_chars")
    reply = F.concat("text", F.lit("\n"), (F.col("n_chars") % 8).cast("string"), F.lit("\n"))
    return docs.select("doc_id", harness.final_score(reply).alias("score"))


@query("label_policy", ctes(base.ANSWERS) + f"""SELECT record_id, CASE WHEN length(outputs) < 80 THEN 'no' WHEN {_any_sql('question', OFF_TOPIC)} THEN 'no' WHEN {_any_sql('outputs', CONCEPTS)} THEN 'yes' ELSE 'no' END AS value FROM answers""")
def label_policy(spark, sf):
    return tables.answers(spark, sf).select("record_id", scorers.label_policy("outputs", "question", tuple(OFF_TOPIC), tuple(CONCEPTS)).alias("value"))
