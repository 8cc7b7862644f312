"""Sessions with known ids, whose state goes when they have been silent."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

SESSION_ROWS = "session_id STRING, first_ms BIGINT, last_ms BIGINT, n_traces BIGINT, n_errors BIGINT, correction BOOLEAN"
_TOTALS = "first_ms BIGINT, last_ms BIGINT, n_traces BIGINT, n_errors BIGINT, correction BOOLEAN"


class _Silence(StatefulProcessor):
    """Totals of one session, and one timer that goes off when it has been silent for the gap."""

    def __init__(self, gap_ms: int):
        self.gap_ms = gap_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.totals = handle.getValueState("totals", _TOTALS)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = self.totals.get() if self.totals.exists() else None
        first, last, traces, errors, correction = known or (None, None, 0, 0, None)
        for batch in rows:
            low, high = int(batch["at"].min()), int(batch["at"].max())
            first, last = min(low, low if first is None else first), max(high, high if last is None else last)
            traces, errors = traces + len(batch), errors + int(batch["failed"].sum())
        if correction is None:
            # A session opened by a trace this old had been closed, had it been there.
            correction = last + self.gap_ms <= timerValues.getCurrentWatermarkInMs()
        if known:
            self.handle.deleteTimer(known[1] + self.gap_ms)
        self.totals.update((first, last, traces, errors, correction))
        self.handle.registerTimer(last + self.gap_ms)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        first, last, traces, errors, correction = self.totals.get()
        self.totals.clear()
        yield pd.DataFrame({
            "session_id": [key[0]], "first_ms": [first], "last_ms": [last], "n_traces": [traces], "n_errors": [errors], "correction": [correction],
        })


def closing_sessions(traces: DataFrame, gap_minutes: int = 30, time_col: str = "request_time", lateness: str = "5 minutes") -> DataFrame:
    """A stream of rows (SESSION_ROWS), one when a session has been silent for the gap by the watermark; its state is gone then.

    No trace is lost: what arrives behind the watermark opens the session anew and closes at once, as a ``correction`` row. Rows of
    a session cover different traces, so its totals are their sums (``session_totals``). Traces without a session or a time have no
    session. A state other than OK, a null one included, is an error.
    """
    live = traces.withColumn(time_col, F.col(time_col).cast("timestamp")).withWatermark(time_col, lateness)
    # The time goes on as a plain number: a column with a watermark would have its late rows dropped.
    rows = live.where(F.col("session_id").isNotNull() & F.col(time_col).isNotNull()).select(
        F.col("session_id").cast("string").alias("session_id"), F.unix_millis(time_col).alias("at"), (~F.col("state").eqNullSafe(F.lit("OK"))).cast("int").alias("failed"),
    )
    return rows.groupBy("session_id").transformWithStateInPandas(_Silence(gap_minutes * 60_000), SESSION_ROWS, "append", "eventTime")


def session_totals(rows: DataFrame) -> DataFrame:
    """One row a session from its closing row and its corrections."""
    return rows.groupBy("session_id").agg(
        F.min("first_ms").alias("first_ms"), F.max("last_ms").alias("last_ms"), F.sum("n_traces").alias("n_traces"), F.sum("n_errors").alias("n_errors"),
        F.count_if("correction").alias("n_corrections"),
    )
