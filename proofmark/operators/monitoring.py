"""Registered scorers over live traffic: registry, sampling and the batch monitor."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from proofmark import schemas
from proofmark.operators.scorers import Score
from proofmark.sources.files import small_table

# Fixed value: most scorers one experiment may register.
MAX_SCORERS = 20


@dataclass(frozen=True)
class Registration:
    """One registered scorer. ``filter`` is a SQL predicate over traces, empty for all."""

    name: str
    scorer: str
    version: int = 1
    sample_rate: float = 1.0
    filter: str = ""
    status: str = "registered"


class Registry:
    """Named scorers: unique, at most twenty. Stopping one keeps the feedback it has given."""

    def __init__(self, entries: list[Registration] | None = None):
        self._entries: dict[str, Registration] = {}
        for entry in entries or []:
            self.register(entry)

    def register(self, entry: Registration) -> Registry:
        if entry.name in self._entries:
            raise ValueError(f"{entry.name} is already registered")
        if len(self._entries) >= MAX_SCORERS:
            raise ValueError(f"at most {MAX_SCORERS} scorers")
        self._entries[entry.name] = entry
        return self

    def _change(self, name: str, **fields) -> Registry:
        rate = fields.get("sample_rate")
        if rate is not None and not 0.0 <= rate <= 1.0:
            raise ValueError("sample_rate lies between 0 and 1")
        self._entries[name] = replace(self._entries[name], **fields)
        return self

    def start(self, name: str, sample_rate: float = 1.0, filter: str = "") -> Registry:
        return self._change(name, status="running", sample_rate=sample_rate, filter=filter)

    def update(self, name: str, **fields) -> Registry:
        return self._change(name, **fields)

    def stop(self, name: str) -> Registry:
        return self._change(name, status="stopped")

    def entries(self) -> list[Registration]:
        return list(self._entries.values())

    def running(self) -> list[Registration]:
        return [e for e in self._entries.values() if e.status == "running"]

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the registry as a table, replacing what was there."""
        self.to_df(spark).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Registry:
        """Read a registry back; it has at most MAX_SCORERS rows."""
        rows = spark.read.schema(schemas.REGISTRY).parquet(path).orderBy("name").limit(MAX_SCORERS + 1).collect()
        return cls([Registration(**r.asDict()) for r in rows])

    def to_df(self, spark: SparkSession) -> DataFrame:
        rows = [(e.name, e.scorer, e.version, e.sample_rate, e.filter, e.status) for e in self._entries.values()]
        return small_table(spark, rows, schemas.REGISTRY)


def list_scorers(registry: DataFrame) -> DataFrame:
    """Active scorers with their rate and filter."""
    return registry.where(F.col("status") == "running").select("name", "scorer", "version", "sample_rate", "filter")


def in_sample(scorer: str, rate: float, key: str = "trace_id") -> Column:
    """Repeatable sampling: the same trace is in or out for a scorer, wherever and whenever it is asked."""
    digest = F.md5(F.concat(F.lit(scorer), F.col(key)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(2**32)) < F.lit(rate)


def sample_traces(traces: DataFrame, scorer: str, rate: float) -> DataFrame:
    return traces.where(in_sample(scorer, rate))


def as_assessments(feedback: DataFrame, created_ms: str | Column) -> DataFrame:
    """Feedback rows in the shape of the assessments table.

    The id is a function of trace, scorer and version, so the same verdict given twice has one id.
    """
    identity = F.md5(F.concat_ws("\u001f", "trace_id", "name", "source_id"))
    at = F.col(created_ms) if isinstance(created_ms, str) else created_ms
    return feedback.select(
        "trace_id", identity.alias("assessment_id"), "name", "value", F.col("value").try_cast("double").alias("value_num"),
        "rationale", "source_type", "source_id", at.cast("bigint").alias("created_ms"),
    )


def append_feedback(
    traces: DataFrame, registry: Registry, scorers: dict[str, Callable[[], Score]], path: str, run: str, created_ms: str = "request_ms",
) -> DataFrame:
    """Run the batch monitor and add its feedback to a table of assessments, in the run's own folder; returns the whole table.

    A run that is repeated replaces its folder. A verdict that an earlier run gave, known by its id, gets no second row.
    """
    spark = traces.sparkSession
    rows = as_assessments(monitor_batch(traces, registry, scorers, carry=[created_ms]), created_ms)
    folder, schema = f"{path}/run={run}", f"{schemas.ASSESSMENTS}, run STRING"
    spark.createDataFrame([], schemas.ASSESSMENTS).write.mode("ignore").parquet(f"{path}/run=none")
    given = spark.read.schema(schema).parquet(path).where(F.coalesce("run", F.lit("")) != run).select("assessment_id").distinct()
    rows.join(given, "assessment_id", "left_anti").select(*rows.columns).write.mode("overwrite").parquet(folder)
    return spark.read.schema(schema).parquet(path)


def monitor_batch(traces: DataFrame, registry: Registry, scorers: dict[str, Callable[[], Score]], carry: list[str] | None = None) -> DataFrame:
    """Feedback rows of every running scorer: filter, sample and score in one pass over the traces.

    ``carry`` names columns of the trace that go along, such as its time.
    """
    running = registry.running()
    if not running:
        raise ValueError("no scorer is running")
    rows = []
    for entry in running:
        score = scorers[entry.scorer]()
        wanted = in_sample(entry.name, entry.sample_rate)
        if entry.filter:
            wanted = wanted & F.expr(entry.filter)
        row = F.struct(
            F.lit(entry.name).alias("name"), score.value.alias("value"), score.rationale.alias("rationale"),
            F.lit("CODE").alias("source_type"), F.concat(F.lit(entry.scorer), F.lit(f"_v{entry.version}")).alias("source_id"),
        )
        rows.append(F.when(wanted, row))
    # Unwanted rows come out as nulls and are dropped after the generator: a filter on the array itself
    # would make the optimizer compute every score twice.
    return traces.select("trace_id", *(carry or []), F.inline(F.array(*rows))).where(F.col("name").isNotNull())
