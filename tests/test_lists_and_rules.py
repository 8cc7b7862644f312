"""Lists of any length, phrases, empty lists, one rule engine, nulls, repeated labels, and models called once."""

from __future__ import annotations

from pyspark.sql import functions as F

from proofmark.functions import text
from proofmark.operators import datasets, guardrails, harness, joins, judges, scorers
from proofmark.operators.judges import Rule


def texts(spark, *rows):
    return spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "id int, t string")


def values(df, column):
    return [r.v for r in df.select("id", column.alias("v")).orderBy("id").collect()]


def test_long_lists(spark):
    many = [f"word{i}" for i in range(5000)]
    df = texts(spark, "here is WORD4999 now", "nothing", None)
    assert values(df, guardrails.has_keyword("t", many)) == [True, False, None]
    assert values(df, guardrails.unsafe("t", many)) == [True, False, None]
    assert values(df, scorers.mentions(many, "t").value) == ["yes", "no", None]
    held = [f"doc-{w}" for w in many if w in "here is word4999 now"]
    assert values(df, joins.keyword_documents("t", {w: [f"doc-{w}"] for w in many})) == [held, [], []]


def test_many_rules(spark):
    df = texts(spark, "alpha", "beta", None).withColumn("question", F.lit("q"))
    rules = [Rule("must_match", "a")] * 120 + [Rule("must_contain", "ALPHA")]
    rows = {r.id: (r.value, r.failed_rules) for r in judges.guidelines(df, "id", "s", rules, "t").collect()}
    assert rows == {0: ("yes", ""), 1: ("no", "121"), 2: (None, "")}
    assert judges.rule_results(df, "id", "s", rules, "t").count() == 3 * 121


def test_phrases_and_punctuation(spark):
    df = texts(spark, "Never, EVER do that", "never do; ever", "whenever do")
    assert values(df, guardrails.unsafe("t", ["never ever"])) == [True, False, False]
    assert values(df, guardrails.unsafe("t", ["never-ever", "Whenever"])) == [True, False, True]
    df = texts(spark, "axb", "a.b here", "C++ and Cxx", "c only")
    assert values(df, scorers.mentions(["a.b"], "t").value) == ["no", "yes", "no", "no"]
    assert values(df, scorers.mentions(["C++", "C"], "t").rationale) == ["", "", "c++", "c"]


def test_phrase_table_equals_the_list(spark):
    df = texts(spark, "the cat of the house", "House of cats", "", None, "of the of the")
    phrases = spark.createDataFrame([("of the",), ("House",), ("of-the",), ("...",), ("cat of the house",), ("cat cat",)], "phrase string")
    found = {(r.id, r.phrase) for r in joins.phrase_hits(df, "id", "t", phrases).collect()}
    assert found == {(0, "of the"), (0, "of-the"), (0, "House"), (0, "cat of the house"), (1, "House"), (4, "of the"), (4, "of-the")}
    assert joins.phrase_hits(df, "id", "t", phrases.where("false")).count() == 0


def test_empty_lists_ask_for_nothing(spark):
    df = texts(spark, "some text", None)
    assert values(df, guardrails.has_keyword("t", [])) == [False, None] and values(df, guardrails.off_topic("t", [])) == [False, False]
    assert values(df, guardrails.unsafe("t", [])) == [False, None] and values(df, scorers.mentions([], "t").value) == ["no", None]
    assert values(df, joins.keyword_documents("t", {})) == [[], []]
    log = df.withColumns({"request": F.col("t"), "response": F.col("t")})
    assert [r.status_code for r in guardrails.apply_guardrails(log, [], [], []).orderBy("id").collect()] == [200, 200]
    rows = spark.createDataFrame([(0, "x" * 90, "q")], "id int, outputs string, question string")
    assert values(rows, scorers.label_policy()) == ["no"]


def test_no_text_no_verdict(spark):
    df = texts(spark, None, "fine").withColumn("question", F.lit("q"))
    assert values(df, judges.safety("t", ["bad"]).value) == [None, "yes"]
    rows = {r.id: r.value for r in judges.guidelines(df, "id", "s", [Rule("must_not_match", "z")], "t").collect()}
    assert rows == {0: None, 1: "yes"}


def test_rules_on_the_row_share_the_kinds(spark):
    rows = [
        (0, "Some text.", ["must_match:^S", "must_not_match:zzz", "max_sentences:1", "must_contain:TEXT"]),
        (1, "Some text.", ["must_match:zzz"]), (2, "Some text.", ["be polite"]), (3, "Some text.", ["max_sentences:abc", "must_contain:no"]),
        (4, "Some text.", []), (5, None, ["must_match:^S"]),
    ]
    df = spark.createDataFrame(rows, "id int, outputs string, guidelines array<string>")
    got = {r.id: (r.value, r.failed_rules, r.unknown_rules) for r in judges.row_guidelines(df, "id").collect()}
    assert got == {
        0: ("yes", "", ""), 1: ("no", "must_match:zzz", ""), 2: (None, "", "be polite"), 3: (None, "must_contain:no", "max_sentences:abc"),
        4: (None, "", ""), 5: (None, "", ""),
    }


def test_typed_fields_and_strict_json(spark):
    df = texts(spark, '{"k":1,"m":2}', '{"k":1,"m":"x"}', '{"k":1}', '{"m":1}', "no", None)
    assert values(df, scorers.conforms("k INT, m INT", ["k"], "t").value) == ["yes", "no", "yes", "no", "no", "no"]
    df = texts(spark, "{}", "{} {}", "{},", "1, 2", " [1] ", "{", "NaN")
    assert values(df, scorers.valid_json("t", strict=True).value) == ["yes", "no", "no", "no", "yes", "no", "no"]


def test_repeated_labels_do_not_multiply(spark):
    labels = spark.createDataFrame([("a", 1), ("a", 0), ("b", 1)] + [("hot", i) for i in range(300)], "record_id string, label int")
    scores = spark.createDataFrame([("a", "s"), ("hot", "s")], "record_id string, scorer string")
    assert sorted((r.record_id, r.label) for r in joins.human_label_join(scores, labels, "record_id").collect()) == [("a", 1), ("hot", 299)]
    runs = spark.createDataFrame([("hot", "s", i) for i in range(300)], "record_id string, scorer string, score int")
    assert [(r.score_a, r.score_b, r.delta) for r in joins.compare_runs_rows(runs, runs).collect()] == [(299, 299, 0)]
    docs = spark.createDataFrame([("u", "the fact")] * 5, "doc_uri string, content string")
    records = spark.createDataFrame([("r", ["fact"], ["u", "u"])], "record_id string, facts array<string>, uris array<string>")
    assert joins.facts_in_source(records, docs).count() == 1


def test_repeated_annotations_keep_the_last(spark):
    from proofmark import schemas
    from tests.test_datasets import records

    current = datasets.with_record_id(records(spark, [("a", ["1"]), ("b", ["2"])]))
    ids = [r.record_id for r in current.orderBy("inputs.question").collect()]
    labels = spark.createDataFrame([(ids[0], '{"expected_response":"old"}', 1), (ids[0], '{"expected_response":"new"}', 2)], "record_id string, expectations string, created_ms long")
    got = datasets.annotate_records(current, labels)
    assert got.count() == 2 and {r.expectations.expected_response for r in got.collect()} == {"new", None}
    assert schemas.EXPECTATIONS


def test_the_model_is_called_once_a_row(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def answer(question: str) -> str:
        calls.add(1)
        return question.upper()

    def job(answers):
        return answers.select("record_id", F.length("outputs").alias("value"))

    rows = spark.createDataFrame([(str(i), f"q{i}") for i in range(20)], "record_id string, question string")
    results, metrics = harness.evaluate(rows, lambda df: harness.predict_local(df, answer), {"words": scorers.word_count()}, {"a": job, "b": job}, out=str(tmp_path / "run"))
    assert results.count() == 60 and metrics.count() > 0 and results.count() == 60
    assert calls.value == 20
    assert spark.read.parquet(str(tmp_path / "run" / "answers")).count() == 20


def test_quoting_matches_literally(spark):
    odd = ["a.b", "(x", "y)*", "q?", "\\d", "[z]", "$^", "p|q", "é-ü"]
    df = texts(spark, *odd)
    for i, term in enumerate(odd):
        assert values(df, F.rlike("t", F.lit("^" + text.quoted(term) + "$"))) == [j == i for j in range(len(odd))]
