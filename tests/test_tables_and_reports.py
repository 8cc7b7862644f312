"""Keyword tables, aligned paths, hourly sketches, resumed runs, and feedback that flows from click to report."""

from __future__ import annotations

import io
import random
from contextlib import redirect_stdout
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from proofmark import schemas
from proofmark.operators import gate, harness, joins, keywords, monitoring, ranking, rollups, scorers
from proofmark.sources import files


def shared_steps(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row[:]
        for j, y in enumerate(b):
            row[j + 1] = last[j] + 1 if x == y else max(last[j + 1], row[j])
    return row[-1]


def calls(spark, paths):
    rows = [(t, f"{i:06d}", "TOOL", tool, i * 1000) for t, path in paths.items() for i, tool in enumerate(path)]
    rows += [(t, "x", "LLM", "view", 5) for t in paths] + [(None, "0", "TOOL", "a", 1)]
    random.Random(4).shuffle(rows)
    return spark.createDataFrame(rows, "trace_id string, span_id string, span_type string, tool string, start_time_ns bigint").repartition(5)


def test_paths_are_aligned_as_by_the_full_table(spark):
    rng = random.Random(2)
    for size in (0, 1, 7, 90):
        expected = [rng.choice("abcd") for _ in range(size)]
        paths = {f"t{k}": [rng.choice("abcde") for _ in range(rng.randint(1, 120))] for k in range(40)}
        paths["as expected"] = expected or ["a"]
        got = {r.trace_id: r for r in scorers.align_trajectory(calls(spark, paths), expected).collect()}
        assert set(got) == set(paths)
        for t, path in paths.items():
            m = shared_steps(path, expected)
            r = got[t]
            assert (r.n_steps, r.n_matched, r.n_inserted, r.n_skipped) == (len(path), m, len(path) - m, size - m)
            assert r.value == ("yes" if path == expected else "no") and r.similarity == round(2 * m / (len(path) + size), 6)


def test_one_extra_step_costs_one_step_on_a_long_path(spark):
    path = [f"tool{i % 7}" for i in range(2500)]
    paths = {"late": path[:3] + ["extra"] + path[3:], "short": path[:1200] + path[1201:], "none": ["other"] * 2500}
    got = {r.trace_id: (r.n_matched, r.n_inserted, r.n_skipped) for r in scorers.align_trajectory(calls(spark, paths), path).collect()}
    assert got == {"late": (2500, 1, 0), "short": (2499, 0, 1), "none": (0, 2500, 2500)}


def test_a_table_of_keywords_is_found_as_substrings(spark):
    rng = random.Random(8)
    letters = "abcdeäß中 "
    texts = {i: "".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 2, 3, 40, 400]))) for i in range(200)}
    texts[200] = None
    texts[201] = "THE END"
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(1, 6))) for _ in range(5000)} | {"The", "he e", "zzz", "É"}
    table = spark.createDataFrame([(w,) for w in words] + [(None,), ("",), ("The",)], "keyword string")
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = keywords.keyword_hits(df, "doc_id", "text", table)
    shown = io.StringIO()
    with redirect_stdout(shown):
        found.explain("formatted")
    assert "NestedLoop" not in shown.getvalue() and "Cartesian" not in shown.getvalue()
    got = sorted(map(tuple, found.collect()))
    assert got == sorted((i, w) for i, t in texts.items() if t is not None for w in words if w.lower() in t.lower())


def test_runs_of_texts_are_made_without_a_row_of_characters(spark, monkeypatch):
    """Texts are not spelled out by the plan, and the runs of a text in many pieces are those of the text, whatever its planes."""
    monkeypatch.setattr(keywords, "PIECE", 7)
    rng = random.Random(3)
    letters = "ab\x00é中\U0001f600\U0010ffff"
    texts = ["".join(rng.choice(letters) for _ in range(n)) for n in (0, 1, 2, 3, 6, 7, 8, 9, 14, 60, 300)]
    for t in texts:
        for n in (1, 2, 3):
            assert set(keywords._distinct(t, [n]).tolist()) == set(keywords._codes(t, n).tolist()) and len(set(keywords._codes(t, n).tolist())) == len({t[i : i + n] for i in range(len(t) - n + 1)})
    codes = keywords._distinct(texts[-1], [1, 2, 3])
    assert len(codes) == len(set(codes.tolist())) == sum(len({texts[-1][i : i + n] for i in range(len(texts[-1]) - n + 1)}) for n in (1, 2, 3))
    words = {t[i : i + n] for t in texts for n in (1, 2, 3, 5) for i in range(0, len(t) - n + 1, 2)}
    df = spark.createDataFrame([(i, i % 2, t) for i, t in enumerate(texts)], "id long, other int, text string")
    found = keywords.keyword_hits(df, "id", "text", spark.createDataFrame([(w,) for w in words], "keyword string"))
    shown = io.StringIO()
    with redirect_stdout(shown):
        found.explain("extended")
    assert "transform(" not in shown.getvalue()
    assert sorted(map(tuple, found.collect())) == sorted((i, w) for i, t in enumerate(texts) for w in words if w in t)


def test_documents_of_keywords_come_with_content_or_the_sentinel(spark):
    asked = spark.createDataFrame([("q1", "about Alpha and beta"), ("q2", "nothing"), ("q3", None), ("q1", "about Alpha and beta")], "key string, question string")
    table = spark.createDataFrame([("alpha", "d1"), ("beta", "d1"), ("beta", "d2"), ("beta", "gone")], "keyword string, doc_id string")
    docs = spark.createDataFrame([("d1", "one"), ("d2", "two"), ("d3", "three")], "doc_id string, content string")
    got = sorted(map(tuple, keywords.keyword_documents(asked.distinct(), "key", "question", table, docs).collect()), key=str)
    assert got == sorted([("q1", "d1", "one", 2), ("q1", "d2", "two", 1), ("q1", "gone", None, 1), ("q2", "none", None, 0), ("q3", "none", None, 0)], key=str)


LOG_ROWS = "timestamp_ms long, status_code int, execution_duration_ms double, user_id string"


def test_weeks_are_made_of_hours_within_the_rank_error(spark, tmp_path):
    n = 60_000
    log = spark.range(n).select(
        (F.lit(1704067200000) + F.col("id") * 20_000).alias("timestamp_ms"), F.when(F.col("id") % 9 == 0, 400).otherwise(200).alias("status_code"),
        (F.abs(F.randn(3)) * 100 + F.col("id") % 7).alias("execution_duration_ms"), (F.col("id") % 3000).cast("string").alias("user_id"),
    )
    log = log.unionByName(spark.createDataFrame([(1704067200000, None, float("nan"), None), (None, 200, 1.0, "x"), (1704067200000, 200, None, "y")], LOG_ROWS))
    files.write_files(log, str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    assert rollups.write_hours(log, str(tmp_path / "hours")).count() == 334
    again = rollups.write_hours(log, str(tmp_path / "hours"))
    assert again.count() == 334
    weeks = {r.begin.isoformat(): r for r in rollups.rolled_up(again, "week").collect()}
    plain = log.where("timestamp_ms IS NOT NULL").select("execution_duration_ms", "user_id", "status_code", F.date_trunc("week", F.timestamp_millis("timestamp_ms")).cast("date").cast("string").alias("begin")).toPandas()
    assert set(weeks) == set(plain["begin"])
    for begin, rows in plain.groupby("begin"):
        week = weeks[begin]
        assert week.total_requests == len(rows) and week.blocked == int((rows["status_code"] != 200).sum())
        times = np.sort(rows["execution_duration_ms"].dropna().to_numpy())
        for share, value in ((0.5, week.latency_p50_ms), (0.95, week.latency_p95_ms)):
            low, high = np.searchsorted(times, value, "left") / len(times), np.searchsorted(times, value, "right") / len(times)
            assert low - rollups.RANK_ERROR <= share <= high + rollups.RANK_ERROR
        users = rows["user_id"].nunique()
        assert abs(week.n_users - users) <= max(2, 4 * rollups.USERS_ERROR * users)
    assert rollups.rolled_up(again.limit(0)).count() == 0


def test_a_run_that_died_asks_for_the_rest_only(spark, tmp_path):
    folder, asked = tmp_path / "asked", str(tmp_path / "answers")
    folder.mkdir()
    rows = spark.createDataFrame([(str(i), f"question {i % 90}") for i in range(100)] + [("7", "question 7"), (None, None)], "record_id string, question string")

    def predict(df, stop=None):
        at = str(folder)

        def answer(question):
            with open(f"{at}/{random.random()}", "w") as out:
                out.write(str(question))
            return f"answer to {question}"

        if stop is not None:
            stop[0] -= 1
            if stop[0] < 0:
                raise RuntimeError("died")
        return harness.predict_local(df, answer)

    left = [5]
    with pytest.raises(RuntimeError):
        harness.resumable_answers(rows, lambda df: predict(df, left), asked, parts=12)
    half = len(list(folder.iterdir()))
    assert 0 < half < 101
    # A part that was being written when the job died does not count.
    (Path(asked) / "half").mkdir()
    (Path(asked) / "half" / "part-0.parquet").write_bytes(b"broken")
    done = harness.resumable_answers(rows, predict, asked, parts=12)
    assert len(list(folder.iterdir())) == 101  # distinct records
    assert done.count() == 102 and done.where("outputs = concat('answer to ', coalesce(question, 'None'))").count() == 102
    more = rows.unionByName(spark.createDataFrame([("new", "question new")], rows.schema))
    assert harness.resumable_answers(more, predict, asked, parts=12).where("outputs IS NULL").count() == 0
    assert len(list(folder.iterdir())) == 102


def test_clicks_become_assessments_and_reports(spark, tmp_path):
    traces = spark.createDataFrame([("t1", "c1", 5), ("t2", "c1", 9), ("t3", "c2", 1)], "trace_id string, client_request_id string, request_ms long")
    feedback = spark.createDataFrame(
        [("c1", "u", True, 4, "good", 100), ("c1", "u", False, None, "worse", 200), ("zz", "u", True, 1, None, 1), ("c2", "v", None, 2, None, 3)],
        "client_request_id string, user_id string, helpful boolean, satisfaction int, rationale string, clicked_ms long",
    )
    rows = joins.attach_feedback(feedback, traces)
    assert rows.columns == spark.createDataFrame([], schemas.ASSESSMENTS).columns and rows.count() == 4
    latest = {(r.trace_id, r.name): (r.value, r.created_ms) for r in ranking.latest_assessment(rows).collect()}
    assert latest == {("t2", "user_helpful"): ("false", 200), ("t2", "satisfaction"): ("4", 100), ("t3", "satisfaction"): ("2", 3)}
    log = spark.createDataFrame([("c1", 7, 200), ("c1", 8, 400), ("other", 1, 200), (None, 1, 200)], "request_id string, timestamp_ms long, status_code int")
    both = sorted((r.trace_id, r.log.status_code) for r in joins.request_with_trace(log, traces).collect())
    assert both == [("t1", 400), ("t2", 400)]


def test_the_monitor_appends_each_verdict_once(spark, tmp_path):
    registry = monitoring.Registry([monitoring.Registration("words", "words")]).start("words")
    scorer = {"words": lambda: scorers.word_count("response")}
    traces = spark.createDataFrame([("a", "x y", 1), ("b", "x", 2)], "trace_id string, response string, request_ms long")
    path = str(tmp_path / "feedback")
    monitoring.append_feedback(traces.limit(1), registry, scorer, path, "r1")
    for _ in range(2):
        table = monitoring.append_feedback(traces, registry, scorer, path, "r2")
    assert sorted((r.trace_id, r.value_num, r.created_ms, r.run) for r in table.collect()) == [("a", 2.0, 1, "r1"), ("b", 1.0, 2, "r2")]


def test_a_gate_reads_stored_metrics(spark, tmp_path):
    path = str(tmp_path / "metrics")
    for run, value in (("r1", 0.95), ("r2", 0.5)):
        files.write_json(spark.createDataFrame([("m/ratio_pass", value)], "metric string, value double"), path, run)
    floors = gate.thresholds(spark, {"m/ratio_pass": (0.9, "ratio")})
    failed = {run: gate.evaluate_gate(gate.stored_metrics(spark, path, run), floors).count() for run in ("r1", "r2")}
    assert failed == {"r1": 0, "r2": 1}
