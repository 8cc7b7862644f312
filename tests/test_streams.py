"""Streams against batch results, under restarts, repeats and lateness."""

from __future__ import annotations

from pyspark.sql import functions as F

from proofmark.operators import monitoring, scorers
from proofmark.sources import files
from proofmark.streaming import deduplicated, jobs, run, sessions

LOG = "request_id string, ts timestamp, status_code int, execution_duration_ms double"


def land(spark, folder, rows, schema=LOG, time_cols=("ts",)):
    """One more file in the folder that a stream reads."""
    plain = schema.replace("timestamp", "string")
    df = spark.createDataFrame(rows, plain).withColumns({c: F.to_timestamp(c) for c in time_cols})
    df.coalesce(1).write.mode("append").parquet(str(folder))


def minute(m):
    return f"2024-01-{1 + m // 1440:02d} {m % 1440 // 60:02d}:{m % 60:02d}:00"


def test_late_rows_are_reported(spark, tmp_path):
    source, out, cp = tmp_path / "log", str(tmp_path / "out"), str(tmp_path / "cp")
    land(spark, source, [("a", minute(5), 200, 1.0), ("b", minute(65), 200, 2.0)])
    go = lambda: run.to_batches(jobs.window_counts(run.read_stream(spark, str(source), LOG), "1 hour"), out, cp, available_now=True).awaitTermination()
    go()
    land(spark, source, [("c", minute(66), 200, 1.0), ("d", minute(300), 200, 1.0)])
    go()
    land(spark, source, [("late", minute(10), 200, 1.0), ("e", minute(301), 200, 1.0)])
    go()
    live = run.latest_rows(spark, out, ["window_start"])
    batch = jobs.window_counts(spark.read.schema(LOG).parquet(str(source)), "1 hour", lateness=None)
    got = {r.window_start.hour: (r.n_streamed, r.n_batch, r.n_lost) for r in jobs.reconcile(live, batch).collect()}
    assert got == {0: (1, 2, 1), 1: (2, 2, 0), 5: (2, 2, 0)}


def test_replays_are_dropped_and_a_restart_adds_nothing(spark, tmp_path):
    source, out, cp = tmp_path / "log", str(tmp_path / "out"), str(tmp_path / "cp")
    go = lambda: run.to_files(jobs.dedupe_stream(run.read_stream(spark, str(source), LOG)), out, cp, available_now=True).awaitTermination()
    land(spark, source, [("a", minute(1), 200, 1.0), ("a", minute(1), 200, 1.0), ("b", minute(2), 400, 1.0)])
    go()
    land(spark, source, [("b", minute(2), 400, 1.0), ("c", minute(3), 200, 1.0)])
    go()
    go()
    assert sorted(r.request_id for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_health_stream_equals_batch_on_closed_windows(spark, tmp_path):
    source, out, cp = tmp_path / "log", str(tmp_path / "out"), str(tmp_path / "cp")
    rows = [(str(i), minute(i), 400 if i % 4 == 0 else 200, float(i)) for i in range(120)]
    land(spark, source, rows)
    land(spark, source, [("end", minute(600), 200, 0.0)])
    live = jobs.health_stream(run.read_stream(spark, str(source), LOG), "1 hour")
    run.to_files(live, out, cp, available_now=True).awaitTermination()
    got = {r.window_start.hour: (r.total_requests, r.passed, r.blocked_or_errored, r.latency_p50_ms, r.latency_p95_ms) for r in spark.read.parquet(out).collect()}
    assert got == {0: (60, 45, 15, 29.0, 56.0), 1: (60, 45, 15, 89.0, 116.0)}


def test_sessions_close_in_append_mode(spark, tmp_path):
    source, out, cp = tmp_path / "log", str(tmp_path / "out"), str(tmp_path / "cp")
    schema = "user string, ts timestamp"
    land(spark, source, [("u", minute(0)), ("u", minute(20)), ("u", minute(90)), ("v", minute(5))], schema)
    land(spark, source, [("end", minute(900))], schema)
    live = jobs.session_stream(run.read_stream(spark, str(source), schema), "user", "30 minutes")
    run.to_files(live, out, cp, available_now=True).awaitTermination()
    assert sorted((r.user, r.n) for r in spark.read.parquet(out).collect()) == [("u", 1), ("u", 2), ("v", 1)]


SESSION = "session_id string, state string, request_time timestamp"


def test_silent_sessions_leave_the_state(spark, tmp_path):
    source, out, cp = tmp_path / "t", str(tmp_path / "out"), str(tmp_path / "cp")
    held = []

    def go():
        stream = sessions.closing_sessions(run.read_stream(spark, str(source), SESSION), gap_minutes=30)
        query = run.to_files(stream, out, cp, available_now=True)
        query.awaitTermination()
        counts = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
        held.append(counts[-1] if counts else held[-1])

    def rows():
        found = spark.read.schema(sessions.SESSION_ROWS).parquet(out).collect()
        return sorted((r.session_id, r.n_traces, r.n_errors, (r.last_ms - r.first_ms) // 60_000, r.correction) for r in found)

    land(spark, source, [("s", "OK", minute(0)), ("t", "OK", minute(1)), ("s", None, minute(9)), (None, "OK", minute(2)), ("u", "OK", None)], SESSION, ("request_time",))
    go()
    assert rows() == [] and held[0] > 0
    land(spark, source, [("s", "ERROR", minute(29)), ("t", "OK", minute(61))], SESSION, ("request_time",))
    go()
    go()  # a restart without news
    assert rows() == [("t", 1, 0, 0, False)] or rows() == []
    land(spark, source, [("end", "OK", minute(600))], SESSION, ("request_time",))
    go()
    closed = [r for r in rows() if r[0] != "end"]
    assert closed[0] == ("s", 3, 2, 29, False) and sum(r[1] for r in closed if r[0] == "t") == 2
    land(spark, source, [("s", "OK", minute(40)), ("end", "OK", minute(601))], SESSION, ("request_time",))
    go()
    assert [r for r in rows() if r[0] == "s"] == [("s", 1, 0, 0, True), ("s", 3, 2, 29, False)]
    land(spark, source, [("last", "OK", minute(5000))], SESSION, ("request_time",))
    go()
    land(spark, source, [("last", "OK", minute(5001))], SESSION, ("request_time",))
    go()
    assert held[-1] <= held[0] and {r[0] for r in rows()} == {"s", "t", "end"}  # the state holds the open session only
    totals = {r.session_id: (r.n_traces, r.n_errors, r.n_corrections) for r in sessions.session_totals(spark.read.schema(sessions.SESSION_ROWS).parquet(out)).collect()}
    assert totals["s"] == (4, 2, 1)


def test_every_row_is_kept_repeated_or_late(spark, tmp_path):
    source, out, cp = tmp_path / "log", str(tmp_path / "out"), str(tmp_path / "cp")

    def go():
        deduplicated.split_log(run.read_stream(spark, str(source), LOG), out, cp, lateness_minutes=60, available_now=True).awaitTermination()

    land(spark, source, [("a", minute(1), 200, 1.0), ("a", minute(2), 200, 2.0), ("b", minute(200), 200, 1.0), (None, minute(190), 200, 1.0), ("n", None, 200, 1.0)])
    go()
    land(spark, source, [("b", minute(200), 200, 1.0), ("c", minute(150), 200, 1.0), ("d", minute(139), 200, 1.0), (None, minute(191), 200, 1.0), ("a", minute(201), 200, 1.0)])
    go()
    go()  # a restart without news
    land(spark, source, [("c", minute(400), 200, 1.0), ("b", minute(10), 200, 1.0)])
    go()
    land(spark, source, [("c", minute(401), 200, 1.0)])
    go()
    live = spark.read.schema(LOG).parquet(str(source))
    kind = lambda k: sorted(((r.request_id, r.batch) for r in deduplicated.read_kind(spark, out, k, live).collect()), key=str)
    # Minute 139 is a minute behind the mark of batch 1. An hour after the mark has passed a kept row, its key counts as new.
    assert kind("kept") == sorted([("a", 0), ("b", 0), (None, 0), ("c", 1), ("a", 1), ("c", 3)], key=str)
    assert kind("repeated") == sorted([("a", 0), ("b", 1), (None, 1), ("c", 2)], key=str)
    late = {(r.request_id, r.batch): r.late_ms for r in deduplicated.read_kind(spark, out, "late", live).collect()}
    assert late == {("n", 0): None, ("d", 1): 60_000, ("b", 2): 131 * 60_000}
    assert deduplicated.reckoning(spark, out, live).agg(F.sum("n").alias("n")).first().n == live.count() == 13


def test_a_batch_reads_back_to_the_horizon_only(spark, tmp_path):
    source, out, cp = tmp_path / "log", str(tmp_path / "out"), str(tmp_path / "cp")
    land(spark, source, [(str(i), f"2024-01-{1 + i // 28:02d} {i % 24:02d}:00:00", 200, 1.0) for i in range(288)])
    deduplicated.split_log(run.read_stream(spark, str(source), LOG), out, cp, lateness_minutes=60, available_now=True).awaitTermination()
    live = spark.read.schema(LOG).parquet(str(source))
    recent = deduplicated.kept_since(spark, out, live, 1704067200000 + 8 * 86_400_000, 1704067200000 + 9 * 86_400_000)
    assert sorted({r.day for r in recent.collect()}) == [19731, 19732]
    every = deduplicated.read_kind(spark, out, "kept", live)
    assert every.count() == 288 and 5 * len(recent.inputFiles()) <= 2 * len(every.inputFiles())


def test_clicks_outside_the_bound_do_not_match(spark, tmp_path):
    traces, clicks, out = tmp_path / "t", tmp_path / "c", str(tmp_path / "out")
    t_schema, c_schema = "trace_id string, client_request_id string, request_time timestamp", "client_request_id string, helpful boolean, clicked_at timestamp"
    land(spark, traces, [("t1", "a", minute(0)), ("t2", "b", minute(0))], t_schema, ("request_time",))
    land(spark, clicks, [("a", True, minute(30)), ("b", True, minute(61)), ("c", False, minute(1))], c_schema, ("clicked_at",))
    joined = jobs.feedback_stream(run.read_stream(spark, str(clicks), c_schema), run.read_stream(spark, str(traces), t_schema), "1 hour")
    run.to_files(joined, out, str(tmp_path / "cp"), available_now=True).awaitTermination()
    assert [(r.trace_id, r.client_request_id) for r in spark.read.parquet(out).collect()] == [("t1", "a")]


def test_monitor_restart_gives_no_second_feedback(spark, tmp_path):
    source, out, cp = tmp_path / "t", str(tmp_path / "out"), str(tmp_path / "cp")
    schema = "trace_id string, response string, request_time timestamp"
    registry = monitoring.Registry([monitoring.Registration("words", "words"), monitoring.Registration("off", "words")]).start("words")
    live = lambda: jobs.monitor_stream(run.read_stream(spark, str(source), schema), registry, {"words": lambda: scorers.word_count("response")})
    go = lambda: run.to_files(live(), out, cp, available_now=True).awaitTermination()
    land(spark, source, [("a", "x y", minute(0)), ("b", "x", minute(1))], schema, ("request_time",))
    go()
    land(spark, source, [("a", "x y", minute(0)), ("c", "", minute(2))], schema, ("request_time",))
    go()
    got = sorted((r.trace_id, r.name, r.value) for r in spark.read.parquet(out).collect())
    assert got == [("a", "words", "2"), ("b", "words", "1"), ("c", "words", "0")]
    batch = monitoring.monitor_batch(spark.read.schema(schema).parquet(str(source)).dropDuplicates(["trace_id"]), registry, {"words": lambda: scorers.word_count("response")})
    assert sorted((r.trace_id, r.name, r.value) for r in batch.collect()) == got


def test_late_traces_get_feedback_and_replays_get_none(spark, tmp_path):
    source, out, cp = tmp_path / "t", str(tmp_path / "out"), str(tmp_path / "cp")
    schema = "trace_id string, response string, request_time timestamp"
    registry = monitoring.Registry([monitoring.Registration("words", "words")]).start("words")
    scorer = {"words": lambda: scorers.word_count("response")}
    go = lambda: jobs.monitor_to_feedback(run.read_stream(spark, str(source), schema), registry, scorer, out, cp, available_now=True).awaitTermination()
    land(spark, source, [("a", "x y", minute(55)), ("b", "x", minute(56)), ("b", "x", minute(57))], schema, ("request_time",))
    go()
    land(spark, source, [("late", "x y z", minute(10)), ("a", "x y", minute(500))], schema, ("request_time",))
    go()
    go()
    rows = spark.read.parquet(out).collect()
    assert sorted((r.trace_id, r.value_num, r.created_ms) for r in rows) == [
        ("a", 2.0, 1704070500000), ("b", 1.0, 1704070560000), ("late", 3.0, 1704067800000)
    ]
    assert len({r.assessment_id for r in rows}) == 3 and {(r.name, r.source_id) for r in rows} == {("words", "words_v1")}


def test_registry_table_and_scorers_of_several_columns(spark, tmp_path):
    import pandas as pd

    from proofmark.operators import harness

    registry = monitoring.Registry([monitoring.Registration("a", "s"), monitoring.Registration("b", "s", 2)]).start("b", 0.25, "x > 1")
    registry.save(spark, str(tmp_path / "r"))
    registry.save(spark, str(tmp_path / "r"))
    assert monitoring.Registry.load(spark, str(tmp_path / "r")).entries() == registry.entries()
    mine = harness.ScorerRegistry()

    @mine.batch_scorer("budget", "took", "spans")
    def budget(took: pd.Series, spans: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"value": ["yes" if t < 5 else "no" for t in took], "rationale": [f"{len(s)} spans" for s in spans]})

    df = spark.createDataFrame([("t", 3.0, ["a", "b"]), ("u", 9.0, [])], "trace_id string, took double, spans array<string>")
    got = scorers.long_scores(df, "trace_id", mine.build()).collect()
    assert sorted((r.trace_id, r.value, r.rationale) for r in got) == [("t", "yes", "2 spans"), ("u", "no", "0 spans")]


def test_inference_log_reads_as_batch_and_stream(spark, tmp_path):
    rows = spark.range(3).select(F.col("id").cast("string").alias("request_id"), F.col("id").alias("timestamp_ms"), F.lit(200).alias("status_code"))
    files.write_files(rows, str(tmp_path / "log"))
    batch = files.read_inference_log(spark, str(tmp_path / "log"))
    live = files.read_inference_log(spark, str(tmp_path / "log"), streaming=True)
    assert live.isStreaming and live.schema == batch.schema and batch.count() == 3
