"""Queries: streams, run over all that is available and read back from their sink."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from proofmark import schemas
from proofmark.operators import monitoring
from proofmark.plans import base
from proofmark.plans.base import ctes, query
from proofmark.plans.serving import GUARDED, KEYWORDS, LIVE_SCORERS, TOPICS
from proofmark.plans.scoring import LEXICON
from proofmark.session import scratch_path
from proofmark.plans.tables_and_filters import landed_log
from proofmark.sources import files, tables
from proofmark.streaming import deduplicated, jobs, run, sessions


def _live(spark, sf, name):
    path = f"{sf}/{name}.parquet"
    return run.read_stream(spark, path, spark.read.parquet(path).schema)


def _finished(spark, start) -> str:
    """Run a stream over what is there now; returns the sink's folder."""
    folder = scratch_path(spark, f"stream-{uuid.uuid4().hex}")
    start(f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return f"{folder}/out"


def _appended(spark, stream):
    return spark.read.parquet(_finished(spark, lambda out, cp: run.to_files(stream, out, cp, available_now=True)))


def _updated(spark, stream, keys):
    return run.latest_rows(spark, _finished(spark, lambda out, cp: run.to_batches(stream, out, cp, available_now=True)), keys)


def _arriving(spark, slices, start):
    """Land slices one after the other in a folder, running the stream over what is there after each; returns the sink's folder."""
    folder = scratch_path(spark, f"stream-{uuid.uuid4().hex}")
    for rows in slices:
        rows.write.mode("append").parquet(f"{folder}/in")
        start(run.read_stream(spark, f"{folder}/in", rows.schema), f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return f"{folder}/out"


def _shown(*columns):
    return {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in columns}


HEALTH = """count(*) AS total_requests, count(*) FILTER (status_code = 200) AS passed, count(*) FILTER (status_code <> 200) AS blocked_or_errored,
  quantile_disc(execution_duration_ms, 0.5) AS latency_p50_ms, quantile_disc(execution_duration_ms, 0.95) AS latency_p95_ms"""


@query("stream_health_tumbling", ctes(base.LOG) + f"""SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_start, strftime(date_trunc('day', ts) + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS window_end, {HEALTH}
FROM log GROUP BY ALL""")
def stream_health_tumbling(spark, sf):
    live = jobs.health_stream(tables.log_from_events(_live(spark, sf, "events")), "1 day")
    return _updated(spark, live, ["window_start", "window_end"]).withColumns(_shown("window_start", "window_end"))


@query("stream_health_sliding", ctes(base.LOG) + f"""SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(s + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS window_end, {HEALTH}
FROM (SELECT *, date_trunc('hour', ts) - unnest(range(24)) * INTERVAL 1 HOUR AS s FROM log) GROUP BY ALL""")
def stream_health_sliding(spark, sf):
    live = jobs.health_stream(tables.log_from_events(_live(spark, sf, "events")), "24 hours", "1 hour")
    return _updated(spark, live, ["window_start", "window_end"]).withColumns(_shown("window_start", "window_end"))


@query("stream_sessions", """SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS session_start, strftime(max(ts) + INTERVAL 12 HOUR, '%Y-%m-%d %H:%M:%S') AS session_end, count(*) AS n
FROM (SELECT *, sum(CASE WHEN ts - prev < INTERVAL 12 HOUR THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts) AS s
  FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM events)) GROUP BY user_id, s""")
def stream_sessions(spark, sf):
    """Sessions leave the state, and are appended, once the watermark has passed them; a last row from a month later closes all."""
    events = tables.load(spark, sf, "events", "user_id", "ts")
    closing = events.agg((F.max("ts") + F.expr("INTERVAL 30 DAY")).alias("ts")).select(F.lit(-1).cast("bigint").alias("user_id"), "ts")
    out = _arriving(spark, [events, closing], lambda live, path, cp: run.to_files(jobs.session_stream(live, "user_id", "12 hours"), path, cp, available_now=True))
    return spark.read.parquet(out).where("user_id >= 0").withColumns(_shown("session_start", "session_end"))


@query("stream_sessions_by_id", ctes(base.TRACES) + """SELECT session_id, late AS correction, min(request_ms) AS first_ms, max(request_ms) AS last_ms, count(*) AS n_traces,
  count(*) FILTER (state <> 'OK') AS n_errors FROM (SELECT *, session_id::BIGINT % 7 = 0 AND (request_ms - 1704067200000) % 600000 >= 4000 AS late FROM traces) GROUP BY ALL""")
def stream_sessions_by_id(spark, sf):
    """Sessions close by silence, a marker from a month later closes the last; traces that come after that are correction rows."""
    traces = tables.traces(spark, sf).select("session_id", "state", F.timestamp_millis("request_ms").alias("request_time"), "request_ms")
    late = (F.col("session_id").cast("bigint") % 7 == 0) & ((F.col("request_ms") - tables.EPOCH_MS) % 600_000 >= 4000)
    kept = traces.drop("request_ms")
    marker = traces.agg((F.max("request_time") + F.expr("INTERVAL 30 DAY")).alias("request_time")).select(F.lit("end").alias("session_id"), F.lit("OK").alias("state"), "request_time")
    slices = [traces.where(~late).select(kept.columns), marker, traces.where(late).select(kept.columns)]
    out = _arriving(spark, slices, lambda live, path, cp: run.to_files(sessions.closing_sessions(live), path, cp, available_now=True))
    rows = spark.read.schema(sessions.SESSION_ROWS).parquet(out).where("session_id <> 'end'")
    return rows.select("session_id", "correction", "first_ms", "last_ms", "n_traces", "n_errors")


@query("stream_late_rows", ctes(base.LOG) + """,
marked AS (SELECT request_id, timestamp_ms AS ms, request_id::BIGINT % 50 = 0 AND timestamp_ms < t - 3 * 86400000 AS held, t FROM log, (SELECT max(timestamp_ms) AS t FROM log)),
arrived AS (
  SELECT request_id, 'kept' AS kind, NULL AS late_ms FROM marked WHERE NOT held
  UNION ALL SELECT request_id, 'repeated', NULL FROM marked WHERE NOT held AND request_id::BIGINT % 10 = 1
  UNION ALL SELECT request_id, 'repeated', NULL FROM marked WHERE ms >= t - 86400000
  UNION ALL SELECT request_id, 'late', t - 2 * 86400000 - ms FROM marked WHERE held
  UNION ALL SELECT request_id, 'late', t - 2 * 86400000 - ms FROM marked WHERE ms < t - 3 * 86400000 AND request_id::BIGINT % 70 = 1)
SELECT request_id, kind, late_ms, count(*) AS n FROM arrived GROUP BY ALL""")
def stream_late_rows(spark, sf):
    """Copies inside a batch and across batches, and rows two days behind the watermark: every row is kept, a repeat, or late."""
    log = tables.inference_log(spark, sf).select("request_id", "ts", "status_code", "timestamp_ms")
    end = log.agg(F.max("timestamp_ms").alias("t")).first().t
    ms, no, day = F.col("timestamp_ms"), F.col("request_id").cast("bigint"), 86_400_000
    old = ms < end - 3 * day if end is not None else F.lit(False)
    held = (no % 50 == 0) & old
    slices = [
        log.where(~held).unionByName(log.where(~held & (no % 10 == 1))),
        log.where(ms >= end - day) if end is not None else log,
        log.where(held).unionByName(log.where(old & (no % 70 == 1))),
    ]
    out = _arriving(spark, slices, lambda live, path, cp: deduplicated.split_log(live, path, cp, lateness_minutes=2 * 1440, available_now=True))
    kinds = [
        deduplicated.read_kind(spark, out, kind, log).select("request_id", F.lit(kind).alias("kind"), F.col("late_ms") if kind == "late" else F.lit(None).cast("bigint").alias("late_ms"))
        for kind in deduplicated.KINDS
    ]
    return kinds[0].unionByName(kinds[1]).unionByName(kinds[2]).groupBy("request_id", "kind", "late_ms").agg(F.count("*").alias("n"))


@query("stream_dedupe", ctes(base.LOG) + "SELECT request_id, status_code FROM log")
def stream_dedupe(spark, sf):
    log = tables.log_from_events(_live(spark, sf, "events"))
    replayed = log.withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
    return _appended(spark, jobs.dedupe_stream(replayed).select("request_id", "status_code"))


@query("stream_inference_source", ctes(base.LOG) + "SELECT request_id, timestamp_ms, strftime(event_date, '%Y-%m-%d') AS event_date, status_code FROM log WHERE status_code = 200")
def stream_inference_source(spark, sf):
    """The landed log, streamed through its declared source."""
    live = files.read_inference_log(spark, landed_log(spark, sf), streaming=True)
    kept = _appended(spark, live.where("status_code = 200").select("request_id", "timestamp_ms", "event_date", "status_code"))
    return kept.withColumn("event_date", F.date_format("event_date", "yyyy-MM-dd"))


@query("stream_feedback_join", """SELECT 'trace-' || d.doc_id AS trace_id, CAST(d.doc_id AS VARCHAR) AS client_request_id, CASE WHEN toxic = 0 THEN 'true' ELSE 'false' END AS helpful
FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE quality = 1""")
def stream_feedback_join(spark, sf):
    at = F.timestamp_millis(F.lit(tables.EPOCH_MS) + F.col("doc_id") * 1000)
    key = F.col("doc_id").cast("string").alias("client_request_id")
    traces = _live(spark, sf, "documents").select(key, F.concat(F.lit("trace-"), F.col("doc_id").cast("string")).alias("trace_id"), at.alias("request_time"))
    wait = F.make_dt_interval(mins=F.when(F.col("quality") == 1, 30).otherwise(90))  # 90 minutes is past the bound
    clicks = _live(spark, sf, "labels").select(key, (F.col("toxic") == 0).alias("helpful"), (at + wait).alias("clicked_at"))
    joined = jobs.feedback_stream(clicks, traces, "1 hour")
    return _appended(spark, joined.select("trace_id", "client_request_id", F.col("helpful").cast("string").alias("helpful")))


@query("stream_guardrails", ctes(GUARDED) + "SELECT request_id, status_code, guardrail, response FROM guarded")
def stream_guardrails(spark, sf):
    log = tables.log_from_events(_live(spark, sf, "events"))
    return _appended(spark, jobs.guard_stream(log, KEYWORDS, TOPICS, LEXICON).select("request_id", "status_code", "guardrail", "response"))


def _unsafe(x: str) -> str:
    return f"list_has_any({base.tokens(x)}, [{base.quoted(LEXICON)}])"


@query("monitor_stream", ctes(base.ANSWERS) + f"""SELECT record_id AS trace_id, 'safety' AS name, CASE WHEN {base.first_pii('outputs')} IS NULL AND NOT {_unsafe('outputs')} THEN 'yes' ELSE 'no' END AS value FROM answers
UNION ALL SELECT record_id, 'length', {base.yes_no(f"len({base.words('outputs')}) BETWEEN 40 AND 250")} FROM answers
WHERE lang = 'en' AND ('0x' || substr(md5('length' || record_id), 1, 8))::BIGINT / 4294967296.0::DOUBLE < 0.5""")
def monitor_stream(spark, sf):
    registry = monitoring.Registry([monitoring.Registration(n, n) for n in ("safety", "length")])
    registry.start("safety", 1.0).start("length", 0.5, "lang = 'en'")
    at = F.timestamp_millis(F.lit(tables.EPOCH_MS) + F.col("doc_id") * 1000)
    traces = tables.answers_from_documents(_live(spark, sf, "documents")).select(
        F.col("record_id").alias("trace_id"), F.col("outputs").alias("response"), "lang", at.alias("request_time")
    )
    out = _finished(spark, lambda path, cp: jobs.monitor_to_feedback(traces, registry, LIVE_SCORERS, path, cp, available_now=True))
    return spark.read.schema(schemas.ASSESSMENTS).parquet(out).select("trace_id", "name", "value")


@query("late_data", """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) FILTER (NOT late) AS n_streamed, count(*) AS n_batch, count(*) FILTER (late) AS n_lost
FROM (SELECT ts, event_id % 50 = 0 AND ts < (SELECT max(ts) FROM events) - INTERVAL 1 DAY AS late FROM events) GROUP BY 1""")
def late_data(spark, sf):
    """One event in fifty arrives when the watermark has long passed its hour; the batch count shows what the stream lost."""
    events = tables.load(spark, sf, "events", "event_id", "ts")
    end = events.agg(F.max("ts").alias("t")).first().t
    late = (F.col("event_id") % 50 == 0) & (F.col("ts") < F.lit(end) - F.expr("INTERVAL 1 DAY"))
    out = _arriving(
        spark, [events.where(~late), events.where(late)],
        lambda live, path, cp: run.to_batches(jobs.window_counts(live, "1 hour"), path, cp, available_now=True),
    )
    batch = jobs.window_counts(events, "1 hour", lateness=None)
    return jobs.reconcile(run.latest_rows(spark, out, ["window_start"]), batch).withColumns(_shown("window_start"))
