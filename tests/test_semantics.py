"""Null, tie and format rules on small literal rows."""

from __future__ import annotations

import json
import math

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from proofmark.functions import text
from proofmark.operators import agreement, datasets, filters, gate, guardrails, harness, joins, judges, metrics, monitoring, ranking, scorers


def values(df, *columns):
    return [tuple(r) if len(columns) != 1 else r[0] for r in df.select(*columns).collect()]


def one(spark, column, **row):
    return spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} {kind(v)}" for k, v in row.items())).select(column).first()[0]


def kind(v):
    return {str: "string", int: "bigint", float: "double", type(None): "string"}[type(v)]


@pytest.mark.parametrize("body, want", [
    (json.dumps({"messages": [{"role": "user", "content": "hi"}]}), "hi"),
    (json.dumps({"messages": [{"role": "system", "content": "s"}, {"role": "user", "content": "a"}, {"role": "user", "content": "b"}]}), "a"),
    (json.dumps({"messages": [{"role": "user", "content": None}, {"role": "user", "content": "b"}]}), None),
    (json.dumps({"messages": [{"role": "user", "content": ""}]}), ""),
    (json.dumps({"messages": [{"role": "assistant", "content": "x"}]}), None),
    ("{broken", None), ("", None), (None, None), (json.dumps({"other": 1}), None),
])
def test_first_user_message(spark, body, want):
    assert one(spark, filters.first_user_message("p"), p=body) == want


def test_word_count_is_zero_for_blank_text(spark):
    assert [one(spark, text.word_count("t"), t=t) for t in ("", "  ", "a  b\nc", "é ü")] == [0, 0, 3, 2]


def test_sampled_recall_rounds_half_to_even(spark):
    expected = spark.createDataFrame([("r", f"d{i}") for i in range(8)], "record_id string, doc_id string")
    found = spark.createDataFrame([("r", "d0"), ("r", "other")], "record_id string, doc_id string")
    assert scorers.retrieval_recall(expected, found).first().recall == 0.12


def test_recall_has_no_verdict_without_expectations(spark):
    expected = spark.createDataFrame([("r", None), ("s", "d")], "record_id string, doc_id string")
    found = spark.createDataFrame([("r", "d")], "record_id string, doc_id string")
    got = {r.record_id: r.recall for r in scorers.retrieval_recall(expected, found).collect()}
    assert got == {"r": None, "s": 0.0}


def test_pass_rate_counts_missing_as_fail(spark):
    rows = spark.createDataFrame([("yes",), ("no",), (None,), ("ok",)], "`s/value` string")
    got = metrics.pass_rate(rows, ["s"]).first()
    assert (got.pass_rate, got.n_scored, got.n_rows) == (0.25, 3, 4)
    assert metrics.pass_rate(rows, ["s"], ("yes", "ok")).first().pass_rate == 0.5


def test_mean_score_ignores_what_is_not_a_number(spark):
    rows = spark.createDataFrame([("3",), ("3.5",), ("abc",), (None,)], "`s/value` string")
    got = metrics.mean_score(rows, "s").first()
    assert (got.mean_score, got.n_scored) == (3.25, 2)


def test_failing_rows_keep_missing_but_cohorts_drop_them(spark):
    rows = spark.createDataFrame([("a", None, "yes", 0.1), ("b", "no", "yes", 0.1), ("c", "yes", "yes", 0.1), ("d", "no", "yes", None)],
        "record_id string, `correctness/value` string, `retrieval_groundedness/value` string, `retrieved_document_recall/value` double")
    assert sorted(values(filters.failing_rows(rows, ["correctness"]), "record_id")) == ["a", "b", "d"]
    assert values(filters.retrieval_misses(rows), "record_id") == ["b"]


def spans(spark, rows):
    return spark.createDataFrame(rows, "trace_id string, span_id string, span_type string, start_time_ns bigint, end_time_ns bigint")


def test_span_latency_budget_and_missing_policy(spark):
    traces = spark.createDataFrame([("a",), ("b",), ("c",)], "trace_id string")
    rows = spans(spark, [("a", "1", "CHAT_MODEL", 0, 5_000_000_000), ("a", "2", "CHAT_MODEL", 1, 9_000_000_000), ("b", "1", "CHAT_MODEL", 0, 5_000_000_001), ("b", "0", "TOOL", 0, 1)])
    got = dict(values(scorers.span_latency(traces, rows), "trace_id", "value"))
    assert got == {"a": "yes", "b": "no", "c": "no"}
    assert dict(values(scorers.span_latency(traces, rows, on_missing="null"), "trace_id", "value"))["c"] is None


def test_trace_latency_missing_policy(spark):
    df = spark.createDataFrame([(8000.0,), (8000.1,), (None,)], "execution_duration_ms double")
    assert values(df.select(scorers.trace_latency().value.alias("v")), "v") == ["yes", "no", None]
    assert values(df.select(scorers.trace_latency(on_missing="fail").value.alias("v")), "v") == ["yes", "no", "no"]


@pytest.mark.parametrize("body, want", [('{"a": 1}', "yes"), ("[1, 2]", "yes"), ("3", "yes"), ('"x"', "yes"), ("null", "yes"), ("{a: 1}", "no"), ("text", "no"), ("", "no")])
def test_valid_json(spark, body, want):
    assert one(spark, scorers.valid_json("p").value, p=body) == want


def test_mentions_are_whole_words_case_blind_and_sorted(spark):
    score = scorers.mentions(["spark", "delta"], "t")
    df = spark.createDataFrame([("Delta and SPARK, spark",), ("sparkle",), ("éspark",)], "t string")
    assert values(df.select(score.value.alias("v"), score.rationale.alias("r")), "v", "r") == [("yes", "delta,spark"), ("no", ""), ("no", "")]


def test_citations_are_listed(spark):
    score = scorers.has_citation("t")
    df = spark.createDataFrame([("see [a] and [b c]",), ("none []",)], "t string")
    assert values(df.select(score.value.alias("v"), score.rationale.alias("r")), "v", "r") == [("yes", "[a],[b c]"), ("no", "")]


def test_exact_match_and_json_schema(spark):
    df = spark.createDataFrame([("12", " 12 "), ("12", "it is 12 degrees"), ("a long expected answer", "not it")], "expected_response string, outputs string")
    assert values(df.select(scorers.exact_match(short=5).value.alias("v")), "v") == ["yes", "yes", "no"]
    assert one(spark, scorers.conforms("a INT, b STRING", ["a"], "p").value, p='{"a": 1}') == "yes"
    assert one(spark, scorers.conforms("a INT, b STRING", ["a"], "p").value, p='{"b": "x"}') == "no"


def test_final_score(spark):
    got = [one(spark, harness.final_score("p"), p=p) for p in ("fine\n4", "4 of 5\n", "9", "none", "10", "x 3 \n ")]
    assert got == [4, 5, None, None, None, 3]


def test_prompt_values_are_not_rendered_again(spark):
    df = spark.createDataFrame([("{{ outputs }}", "answer")], "q string, a string")
    assert values(df.select(harness.render_prompt("Q {{ inputs }} A {{ outputs }}", inputs="q", outputs="a").alias("p")), "p") == ["Q {{ outputs }} A answer"]


def test_pii_kinds_and_redaction(spark):
    df = spark.createDataFrame([("ssn 123-45-6789",), ("mail a.b@c.org",), ("123-45-6789 and a@b.co",), ("card 1234567812345678",), ("clean",), (None,)], "t string")
    got = values(guardrails.detect_pii(df, "t"), "has_ssn", "has_email", "has_card", "first_kind")
    assert got == [("yes", "no", "no", "ssn"), ("no", "yes", "no", "email"), ("yes", "yes", "no", "ssn"), ("no", "no", "yes", "card"), ("no", "no", "no", None), (None, None, None, None)]
    assert values(df.select(text.redact("t").alias("r")), "r")[2] == "[SSN] and [EMAIL]"


def test_guardrails_fire_in_order(spark):
    rows = [("1", "mail a@b.co about BOMB item", "x"), ("2", "BOMB item", "x"), ("3", "weather", "x"), ("4", "item", "hateful hate"), ("5", "item", "fine"), ("6", "item hate", "fine")]
    df = spark.createDataFrame(rows, "request_id string, request string, response string")
    out = guardrails.apply_guardrails(df, ["bomb"], ["item"], ["hate"])
    assert values(out, "guardrail") == ["pii", "keyword", "topic", "output_safety", None, None]
    assert values(out, "status_code") == [400, 400, 400, 400, 200, 200]
    strict = guardrails.apply_guardrails(df, ["bomb"], ["item"], ["hate"], input_safety=True)
    assert values(strict, "guardrail")[5] == "input_safety"


def long(spark, rows):
    return spark.createDataFrame(rows, "trace_id string, assessment_id string, name string, value string, created_ms bigint")


def test_pairs_take_the_last_value_and_fall_back(spark):
    rows = long(spark, [
        ("a", "1", "judge", "no", 1), ("a", "2", "judge", "yes", 2), ("a", "3", "human", "yes", 1),
        ("b", "1", "suite", "", 1), ("b", "2", "judge", "no", 1), ("b", "3", "human", "yes", 1),
        ("c", "1", "judge", "yes", 1), ("d", "1", "human", "yes", 1), ("e", "2", "judge", None, 5), ("e", "1", "judge", "yes", 1), ("e", "3", "human", "no", 1),
    ])
    got = sorted(values(agreement.judge_human_pairs(rows, ["suite", "judge"], "human"), "trace_id", "judge", "human"))
    assert got == [("a", "yes", "yes"), ("b", "no", "yes")]


def test_ties_in_time_go_to_the_higher_id(spark):
    rows = long(spark, [("a", "1", "s", "x", 1), ("a", "2", "s", "y", 1)])
    assert values(ranking.latest_assessment(rows), "value") == ["y"]


def test_kappa_edges(spark):
    pairs = lambda rows: spark.createDataFrame(rows, "judge string, human string")
    assert agreement.cohens_kappa(pairs([("yes", "yes")] * 3)).first().kappa is None
    assert agreement.cohens_kappa(pairs([("yes", "yes"), ("no", "no")])).first().kappa == 1.0
    assert agreement.cohens_kappa(pairs([("yes", "no"), ("no", "yes")])).first().kappa == -1.0
    assert agreement.cohens_kappa(pairs([])).first().kappa is None


def test_gate_states(spark):
    observed = spark.createDataFrame([("a", 0.9), ("b", 0.8999), ("c", math.nan)], "metric string, value double")
    floors = gate.thresholds(spark, {m: (0.9, "ratio") for m in "abcd"})
    got = dict(values(gate.threshold_join(observed, floors), "metric", "state"))
    assert got == {"a": "ok", "b": "below", "c": "missing", "d": "missing"}
    failures = gate.evaluate_gate(observed, floors)
    assert dict(values(failures, "metric", "message"))["b"] == "b: 0.900 < threshold 0.9"
    assert dict(values(gate.evaluate_gate(observed, floors, digits=2), "metric", "message"))["b"] == "b: 0.90 < threshold 0.9"
    verdict = gate.gate_verdict(failures)
    with pytest.raises(gate.QualityGateFailed, match="c: MISSING"):
        gate.enforce(verdict)
    gate.enforce(gate.gate_verdict(gate.evaluate_gate(observed, gate.thresholds(spark, {}))))


def test_unreachable_floor_is_refused(spark):
    with pytest.raises(ValueError, match="above the yes_no scale"):
        gate.thresholds(spark, {"correctness/mean": (3.5, "yes_no")})


def test_rubric_caps(spark):
    rows = [(1.0, "no"), (1.0, "yes"), (0.0, "no"), (None, "no")]
    df = spark.createDataFrame(rows, "c double, off string")
    grade = judges.rubric(F.col("c"), [judges.Override(F.col("off") == "yes", 1)])
    assert values(df.select(grade.alias("g")), "g") == [5, 1, 1, None]


def test_label_policy_order(spark):
    answer = "a" * 80
    rows = [(None, "q"), ("a" * 79, "q"), (answer + " grant", "a recipe"), (answer + " grant", None), (answer, "q")]
    df = spark.createDataFrame(rows, "outputs string, question string")
    assert values(df.select(scorers.label_policy(off_topic=("recipe",), concepts=("grant",)).alias("v")), "v") == ["no", "no", "no", "yes", "no"]


def test_keyword_documents_keep_order_without_repeats(spark):
    mapping = {"time travel": ["tt", "lake"], "lake": ["lake"], "zorder": ["z"]}
    df = spark.createDataFrame([("LAKE with Time Travel",), ("nothing",), (None,)], "question string")
    assert values(joins.keyword_expected_docs(df, mapping), "expected_docs")[:2] == [["tt", "lake"], []]
    assert values(joins.keyword_retrieve(df, {"lake": "d"}), "doc_id") == ["d", "none", "none"]


def test_latest_questions_drop_repeats_after_the_pull(spark):
    body = lambda q: json.dumps({"messages": [{"role": "user", "content": q}]})
    rows = [(str(i), i, 200, body("same")) for i in range(100, 150)] + [("1", 1, 200, body("old"))]
    log = spark.createDataFrame(rows, "request_id string, timestamp_ms bigint, status_code int, request string")
    assert values(ranking.latest_distinct_questions(log), "question", "timestamp_ms") == [("same", 149)]
    assert values(ranking.latest_distinct_questions(log, pull=51), "question") == ["same", "old"]


def test_unresolved_and_resolved_feedback_split_the_clicks(spark):
    clicks = spark.createDataFrame([("a",), ("b",)], "client_request_id string")
    traces = spark.createDataFrame([("t1", "a", 1), ("t2", "a", 2)], "trace_id string, client_request_id string, request_ms bigint")
    assert values(joins.resolve_client_request(clicks, traces), "client_request_id", "trace_id") == [("a", "t2")]
    assert values(joins.unresolved_feedback(clicks, traces), "client_request_id") == ["b"]


def test_tools_without_calls_are_ok(spark):
    traces = spark.createDataFrame([("a", 2), ("b", None)], "trace_id string, expected_tool_calls int")
    calls = spark.createDataFrame([("a", "TOOL", "w", "x")] * 4, "trace_id string, span_type string, tool string, args string")
    assert sorted(values(scorers.tool_count(traces, calls), "trace_id", "value")) == [("a", "too_many"), ("b", "ok")]
    assert sorted(values(scorers.tool_efficiency(traces, calls), "trace_id", "n_redundant", "value")) == [("a", 3, "no"), ("b", 0, "yes")]


def test_retention_has_no_verdict_on_a_first_exchange(spark):
    rows = [(1, 0, "user", "alpha beta"), (1, 1, "assistant", "alpha"), (2, 0, "user", "gamma delta"), (2, 1, "assistant", "x"), (2, 2, "user", "more"), (2, 3, "assistant", "gamma again"), (3, 0, "user", "alone")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    assert sorted(values(judges.knowledge_retention(df), "conv_id", "n_terms", "retention")) == [(1, 0, None), (2, 2, 0.5)]


def test_groundedness_without_context_has_no_verdict(spark):
    answers = spark.createDataFrame([("a", "alpha beta. gamma delta!"), ("b", "alpha"), ("c", "alpha beta. unknown words here")], "record_id string, outputs string")
    found = spark.createDataFrame([("a", 1, "1"), ("c", 1, "2"), ("c", 9, "3")], "record_id string, rank int, doc_id string")
    docs = spark.createDataFrame([("1", "alpha beta gamma"), ("2", "alpha beta"), ("2", "alpha beta"), ("3", "unknown words here")], "doc_id string, content string")
    got = sorted(values(judges.groundedness(answers, found, docs), "record_id", "n_unsupported", "value"))
    assert got == [("a", 0, "yes"), ("b", None, None), ("c", 1, "no")]


def test_registry_rules(spark):
    registry = monitoring.Registry([monitoring.Registration(f"s{i}", "x") for i in range(20)])
    with pytest.raises(ValueError, match="at most 20"):
        registry.register(monitoring.Registration("s20", "x"))
    with pytest.raises(ValueError, match="already"):
        registry.register(monitoring.Registration("s1", "x"))
    with pytest.raises(ValueError, match="between 0 and 1"):
        registry.start("s1", 1.5)
    registry.start("s1", 0.5).start("s2").stop("s2").update("s1", sample_rate=0.25)
    assert [(e.name, e.sample_rate) for e in registry.running()] == [("s1", 0.25)]
    assert values(monitoring.list_scorers(registry.to_df(spark)), "name") == ["s1"]


def test_sample_rates_zero_and_one(spark):
    traces = spark.range(500).select(F.col("id").cast("string").alias("trace_id"))
    assert monitoring.sample_traces(traces, "s", 0.0).count() == 0
    assert monitoring.sample_traces(traces, "s", 1.0).count() == 500
    assert 100 < monitoring.sample_traces(traces, "s", 0.3).count() < 200


def test_predict_checks_names_while_planning(spark):
    with pytest.raises(ValueError, match="topic"):
        harness.predict_local(spark.range(1), lambda topic: topic)


def test_user_scorers(spark):
    registry = harness.ScorerRegistry()

    @registry.scorer()
    def short():
        return text.yes_no(F.length("outputs") < 3)

    @registry.batch_scorer("size", "outputs")
    def size(batch: pd.Series) -> pd.Series:
        return batch.str.len()

    with pytest.raises(ValueError, match="already"):
        registry.scorer("short")(short)
    df = spark.createDataFrame([("r", "ab")], "record_id string, outputs string")
    results, summary = harness.evaluate(df, None, registry.build())
    assert dict(values(results, "name", "value")) == {"short": "yes", "size": "2"}
    assert dict(values(summary, "metric", "value")) == {"short/mean": 1.0, "short/ratio_pass": 1.0, "size/mean": 2.0}


def test_evaluate_with_prediction_and_job(spark):
    df = spark.createDataFrame([("r", "q"), ("s", "hello")], "record_id string, question string")
    results, _ = harness.evaluate(
        df,
        lambda rows: harness.predict_local(rows, lambda question: question * 2),
        {"words": scorers.word_count()},
        {"relevance": judges.relevance},
    )
    assert sorted(values(results, "record_id", "name", "value")) == [("r", "relevance", None), ("r", "words", "1"), ("s", "relevance", "no"), ("s", "words", "1")]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from(["yes", "no", "ok"]), min_size=2, max_size=12))
def test_equal_labels_agree_fully(spark, labels):
    pairs = spark.createDataFrame([(v, v) for v in labels], "judge string, human string")
    got = agreement.cohens_kappa(pairs).first()
    assert got.observed == 1.0
    assert got.kappa == (1.0 if len(set(labels)) > 1 else None)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.sampled_from("abcd"), st.floats(0, 1), max_size=4))
def test_verdict_passes_exactly_without_failures(spark, observed):
    rows = spark.createDataFrame(list(observed.items()), "metric string, value double")
    failures = gate.evaluate_gate(rows, gate.thresholds(spark, {"a": (0.5, "ratio"), "b": (0.5, "ratio")}))
    want = all(observed.get(m, -1) >= 0.5 for m in "ab")
    assert (gate.gate_verdict(failures).first().passed == "true") == want


def test_expectations_as_text_or_struct(spark):
    records = datasets.with_record_id(spark.createDataFrame([(("q", None),)], "inputs struct<question:string, messages:array<struct<role:string, content:string>>>"))
    current = records.select("record_id", "inputs", F.lit("o").alias("outputs"), F.lit(None).cast("struct<expected_facts:array<string>,expected_response:string,expected_tool_calls:int,guidelines:array<string>,expected_retrieved_context:array<struct<doc_uri:string>>>").alias("expectations"))
    as_text = current.select("record_id", F.lit('{"expected_facts": ["f"]}').alias("expectations"))
    as_struct = current.select("record_id", F.struct(F.array(F.lit("f")).alias("expected_facts")).alias("expectations"))
    for labels in (as_text, as_struct):
        assert datasets.annotate_records(current, labels).first().expectations.expected_facts == ["f"]


def test_correctness_of_a_missing_answer(spark):
    df = spark.createDataFrame([("a", None, ["f"]), ("b", "has F in it", ["f"]), ("c", "x", ["f", "e"]), ("d", "x", None), ("e", "x", [])], "record_id string, outputs string, facts array<string>")
    got = sorted(values(judges.correctness(df), "record_id", "value", "rationale"))
    assert got == [("a", "no", "f"), ("b", "yes", ""), ("c", "no", "e | f"), ("d", None, None), ("e", None, "")]
