"""Dataset lifecycle, sinks and snapshots."""

from __future__ import annotations

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from proofmark import schemas
from proofmark.operators import datasets, gate
from proofmark.sources import files, tables


def records(spark, rows):
    """Canonical records from (question, facts or None)."""
    df = spark.createDataFrame(rows, "question string, facts array<string>")
    return tables.records_of(df, F.col("question"), F.col("facts"), "x", F.lit("c"))


def facts(df):
    return {r.q: r.f for r in df.select(F.col("inputs.question").alias("q"), F.col("expectations.expected_facts").alias("f")).collect()}


def test_lifecycle(spark, tmp_path):
    dataset = datasets.Dataset.create_or_get(spark, str(tmp_path), "evals")
    assert dataset.versions() == [] and dataset.as_of().count() == 0
    assert dataset.merge(records(spark, [("a", ["1"]), ("b", None), ("", ["e"])])) == 1
    assert dataset.merge(records(spark, [("b", ["2"]), ("c", ["3"]), ("a", None)])) == 2
    again = datasets.Dataset.create_or_get(spark, str(tmp_path), "evals")
    assert again.versions() == [1, 2]
    assert facts(again.as_of(1)) == {"a": ["1"], "b": None, "": ["e"]}
    assert facts(again.as_of()) == {"a": ["1"], "b": ["2"], "c": ["3"], "": ["e"]}
    history = {r.version: (r.n_inserted, r.n_updated) for r in again.history().collect()}
    assert history == {1: (3, 0), 2: (1, 1)}
    assert {r.change: r.n for r in datasets.dataset_diff(again.change_log(), 1, 2).groupBy("change").agg(F.count("*").alias("n")).collect()} == {"added": 1, "changed": 1}
    assert [r.version for r in datasets.history_top(again.change_log(), 1).collect()] == [2]


def test_merging_the_same_rows_again_appends_nothing(spark, tmp_path):
    dataset = datasets.Dataset.create_or_get(spark, str(tmp_path), "evals")
    rows = records(spark, [("a", ["1"]), ("b", None)])
    dataset.merge(rows)
    dataset.merge(rows)
    assert dataset.change_log().where("version = 2").count() == 0
    assert dataset.as_of().count() == 2


def test_an_unfinished_version_does_not_count(spark, tmp_path):
    dataset = datasets.Dataset.create_or_get(spark, str(tmp_path), "evals")
    dataset.merge(records(spark, [("a", ["1"])]))
    (tmp_path / "evals" / "v=2").mkdir()
    assert dataset.versions() == [1] and dataset.next_version() == 2
    assert dataset.merge(records(spark, [("b", ["1"])])) == 2
    assert dataset.versions() == [1, 2]


def test_snapshot_is_written_once(spark, tmp_path):
    dataset = datasets.Dataset.create_or_get(spark, str(tmp_path), "evals")
    dataset.merge(records(spark, [("a", ["1"])]))
    dataset.merge(records(spark, [("b", ["1"])]))
    assert spark.read.parquet(dataset.snapshot("w1", 1)).count() == 1
    assert spark.read.parquet(dataset.snapshot("w2")).count() == 2
    with pytest.raises(ValueError, match="exists"):
        dataset.snapshot("w1")
    half = tmp_path / "evals" / "snapshots" / "tag=w3"
    half.mkdir()
    (half / "part-0.parquet").write_text("died half-way")
    assert spark.read.parquet(dataset.snapshot("w3")).count() == 2
    assert dataset.versions() == [1, 2]


def test_merge_traces_keeps_the_newest_answer(spark, tmp_path):
    dataset = datasets.Dataset.create_or_get(spark, str(tmp_path), "evals")
    traces = spark.createDataFrame([("t1", "q", "old", 1), ("t2", "q", "new", 2)], "trace_id string, request string, response string, request_ms bigint")
    dataset.merge_traces(traces)
    row = dataset.as_of().first()
    assert (row.outputs, row.tags["trace_id"]) == ("new", "t2")


def test_tags_are_joined_key_by_key(spark):
    empty = spark.createDataFrame([], schemas.CHANGE_LOG)
    base = datasets.with_record_id(records(spark, [("a", None)]))
    first = base.withColumn("tags", F.create_map(F.lit("k"), F.lit("1"), F.lit("m"), F.lit("1")))
    second = base.withColumn("tags", F.create_map(F.lit("k"), F.lit("2"), F.lit("n"), F.lit("3")))
    v1 = datasets.merge_records(empty, first, 1)
    v2 = datasets.merge_records(v1, second, 2).first()
    assert v2.tags == {"k": "2", "m": "1", "n": "3"} and v2.op == "update"


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abc"), st.one_of(st.none(), st.lists(st.sampled_from("xy"), max_size=2))), min_size=1, max_size=5))
def test_merge_is_idempotent_and_keeps_every_question(spark, rows):
    empty = spark.createDataFrame([], schemas.CHANGE_LOG)
    incoming = datasets.with_record_id(records(spark, [(q, f) for q, f in rows]))
    once = datasets.merge_records(empty, incoming, 1)
    assert datasets.merge_records(once, incoming, 2).count() == 0
    assert set(facts(datasets.dataset_as_of(once))) == {q for q, _ in rows}


def test_synthesis_spreads_a_limit_over_documents(spark):
    docs = spark.createDataFrame([(f"d{i}", "One fact here. Another fact there. A third.") for i in range(6)], "doc_uri string, content string")
    picked = datasets.synthesize(docs, per_doc=3, n=8).collect()
    per_doc = {}
    for r in picked:
        per_doc[r.doc_uri] = per_doc.get(r.doc_uri, 0) + 1
    assert len(picked) == 8 and len(per_doc) == 6 and max(per_doc.values()) == 2
    assert datasets.synthesize(docs, per_doc=3, n=8).collect() == picked


def test_diversity_finds_reworded_questions(spark):
    rows = [("1", "How does alpha beta gamma work"), ("2", "how does GAMMA beta alpha work?"), ("3", "How does alpha beta delta work"),
            ("4", "How does alpha beta work"), ("5", "entirely other words here"), ("6", None), ("7", "")]
    got = {r.record_id: (r.n_same, r.reworded) for r in datasets.one_term_twins(spark.createDataFrame(rows, "record_id string, question string")).collect()}
    assert {k: got[k] for k in "12345"} == {"1": (2, "yes"), "2": (2, "yes"), "3": (1, "yes"), "4": (1, "yes"), "5": (1, "no")}
    assert len(got) == 7


def test_table_and_json_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, kind string")
    files.write_table(df, "sink_check", ["kind"])
    files.write_table(df.where("id = 2"), "sink_check", ["kind"])
    assert files.scan_named(spark, "sink_check", ["id"]).collect() == [(2,)]
    out = str(tmp_path / "verdicts")
    for run, floors in (("r1", {}), ("r2", {"m": (0.5, "ratio")}), ("r2", {"m": (0.5, "ratio")})):
        none = spark.createDataFrame([], "metric string, value double")
        files.write_json(gate.gate_verdict(gate.evaluate_gate(none, gate.thresholds(spark, floors))), out, run)
    lines = [json.loads(r.value) for r in spark.read.text(out).collect()]
    assert sorted((x["passed"], x["failures"]) for x in lines) == [("false", "m: MISSING"), ("true", "")]


def test_expiry_prunes_partitions(spark, tmp_path):
    log = spark.createDataFrame([("2024-01-01", 1), ("2024-01-09", 2), ("2024-01-10", 3)], "day string, id bigint").select(F.to_date("day").alias("event_date"), "id")
    files.write_files(log, str(tmp_path / "log"), ["event_date"])
    kept = datasets.expire(spark.read.parquet(str(tmp_path / "log")), 1704844800000, 2)  # as of 2024-01-10
    assert sorted(r.id for r in kept.collect()) == [2, 3]
    for _ in range(2):
        left = datasets.retain(spark, str(tmp_path / "log"), 1704844800000, 2)
        assert sorted(r.id for r in left.collect()) == [2, 3]
    assert sorted(p.name for p in (tmp_path / "log").iterdir() if p.is_dir()) == ["event_date=2024-01-09", "event_date=2024-01-10"]
    assert "PartitionFilters: [isnotnull(event_date" in kept._jdf.queryExecution().toString()


def test_chunks_cover_every_word(spark):
    words = [f"w{i}" for i in range(23)]
    df = spark.createDataFrame([(1, " ".join(words)), (2, ""), (3, " one ")], "doc_id bigint, text string")
    got = {}
    for r in files.chunk_documents(df, "doc_id", "text", 5, 2).orderBy("doc_id", "chunk_no").collect():
        got.setdefault(r.doc_id, []).append(r.content.split(" "))
    assert set(got) == {1, 3} and got[3] == [["one"]]
    assert [c[0] for c in got[1]] == ["w0", "w3", "w6", "w9", "w12", "w15", "w18", "w21"]
    assert sorted({w for c in got[1] for w in c}) == sorted(words)
    with pytest.raises(ValueError):
        files.chunk_documents(df, "doc_id", "text", 2, 2)


def _state(df):
    return sorted((r.record_id, r.inputs.question, r.outputs, r.version, tuple(sorted((r.tags or {}).items()))) for r in df.collect())


def _questions(spark, rows):
    df = spark.createDataFrame(rows, "q string, a string, k string")
    return df.select(
        F.struct(F.col("q").alias("question"), F.lit(None).cast(schemas.MESSAGES).alias("messages")).alias("inputs"), F.col("a").alias("outputs"),
        F.lit(None).cast(schemas.EXPECTATIONS).alias("expectations"), F.create_map(F.lit("kind"), "k").alias("tags"),
    )


def test_states_are_equal_before_and_after_compaction(spark, tmp_path):
    plain = datasets.Dataset.create_or_get(spark, str(tmp_path), "plain")
    summed = datasets.Dataset.create_or_get(spark, str(tmp_path), "summed")
    with pytest.raises(ValueError):
        summed.compact()
    for n in range(4):
        rows = _questions(spark, [(f"question {i}", f"answer {i % (n + 3)}", f"k{n}" if i % 2 else None) for i in range(n * 5, n * 5 + 30)])
        plain.merge(rows)
        summed.merge(rows)
        if n != 1:
            assert summed.compact() == n + 1 and summed.compact() == n + 1
    assert summed.bases() == [1, 3, 4] and summed.versions() == [1, 2, 3, 4]
    again = datasets.Dataset.create_or_get(spark, str(tmp_path), "summed")
    for version in (None, 1, 2, 3, 4):
        assert _state(again.as_of(version)) == _state(plain.as_of(version))
    assert sorted(map(tuple, again.history().collect())) == sorted(map(tuple, plain.history().collect()))
    before = again.change_log().count()
    again.merge(_questions(spark, [("question 20", None, None)]))
    assert again.change_log().count() == before and _state(again.as_of()) == _state(plain.as_of())


def test_a_merge_reads_its_parts_and_leaves_the_base_where_it_is(spark, tmp_path):
    dataset = datasets.Dataset.create_or_get(spark, str(tmp_path), "large")
    dataset.merge(_questions(spark, [(f"question {i}", "a", "k") for i in range(400)]))
    dataset.compact()
    incoming = datasets._one_per_record(datasets.with_record_id(_questions(spark, [("question 7", "b", "k")])), None)
    parts = [r.p for r in incoming.select(datasets._part().alias("p")).collect()]
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = dataset.with_state(incoming, 1, [], parts)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    base = plan.split("\n")
    scan = next(i for i, line in enumerate(base) if "FileScan" in line and "base_" in line)
    depth, above = base[scan].index("FileScan"), []
    for line in reversed(base[:scan]):  # from the base's scan up to the join
        at = len(line) - len(line.lstrip(" :+-*()0123456789"))
        if at < depth:
            depth, above = at, [*above, line]
    above = above[: next(i for i, line in enumerate(above) if "SortMergeJoin" in line)]
    assert above and not any("Exchange" in line for line in above) and "Bucketed: true" in base[scan]
    assert "part" in base[scan].split("PartitionFilters:")[1].split("]")[0]
    assert len(dataset._base(1).where(F.col("part").isin(parts)).inputFiles()) < len(dataset._base(1).inputFiles())
    dataset.merge(_questions(spark, [("question 7", "b", "k")]))
    assert [r.op for r in dataset.change_log().where("version = 2").collect()] == ["update"]
