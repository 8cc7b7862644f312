"""Evaluation harness: predict, score, aggregate; and the surface for user functions.

User functions are Python by nature, so they run in Arrow batches; everything around them stays in
the JVM.
"""

from __future__ import annotations

import asyncio
import inspect
import uuid
from collections.abc import Awaitable, Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from proofmark.functions import text
from proofmark.functions.ordered import with_position
from proofmark.operators.metrics import scorer_metrics
from proofmark.operators.scorers import Score, long_scores
from proofmark.session import scratch_path, written


def _with_column(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*df.schema.fields, T.StructField(name, kind)])


def _check_names(df: DataFrame, fn: Callable) -> list[str]:
    """The function's parameters must be columns; checked while the plan is made."""
    names = list(inspect.signature(fn).parameters)
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"no such input columns: {missing}")
    return names


def predict_local(df: DataFrame, fn: Callable[..., str], output: str = "outputs") -> DataFrame:
    """Call a function per row, the row's columns being its keyword arguments."""
    names = _check_names(df, fn)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = zip(*[batch[n] for n in names])
            yield batch.assign(**{output: [fn(**dict(zip(names, row))) for row in rows]})

    return df.mapInPandas(run, _with_column(df, output, T.StringType()))


def predict_model(df: DataFrame, loader: Callable[[], Callable[[pd.Series], pd.Series]], column: str, output: str = "outputs") -> DataFrame:
    """Score a column with a model that is loaded once per worker task."""
    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = loader()
        for batch in batches:
            yield model(batch)

    return df.withColumn(output, run(F.col(column)))


def predict_concurrent(df: DataFrame, fn: Callable[..., Awaitable[str]], concurrency: int = 8, output: str = "outputs") -> DataFrame:
    """Await a coroutine per row, at most ``concurrency`` at a time in each task, order kept."""
    names = _check_names(df, fn)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        async def all_rows(batch: pd.DataFrame) -> list[str]:
            gate = asyncio.Semaphore(concurrency)

            async def one(row: tuple) -> str:
                async with gate:
                    return await fn(**dict(zip(names, row)))

            return await asyncio.gather(*[one(row) for row in zip(*[batch[n] for n in names])])

        for batch in batches:
            yield batch.assign(**{output: asyncio.run(all_rows(batch))})

    return df.mapInPandas(run, _with_column(df, output, T.StringType()))


def render_prompt(template: str, **values: str | Column) -> Column:
    """Fill ``{{ name }}`` marks of a fixed template from columns, in one pass over the template.

    The template is cut at its marks first, so a value that itself holds a mark is left alone.
    """
    pieces: list[Column] = []
    rest = template
    while rest:
        cuts = {rest.find(f"{{{{ {n} }}}}"): n for n in values if f"{{{{ {n} }}}}" in rest}
        if not cuts:
            pieces.append(F.lit(rest))
            break
        at = min(cuts)
        name = cuts[at]
        pieces += [F.lit(rest[:at]), F.coalesce(text.col(values[name]), F.lit(""))]
        rest = rest[at + len(f"{{{{ {name} }}}}") :]
    return F.concat(*pieces)


def final_score(reply: str | Column, low: int = 1, high: int = 5) -> Column:
    """Integer at the very end of a judge's reply; null when absent or out of range."""
    number = F.regexp_extract(text.col(reply), r"(\d+)\s*$", 1).try_cast("int")
    return F.when(number.between(low, high), number)


def model_judge(df: DataFrame, template: str, fn: Callable[[pd.Series], pd.Series], name: str, **values: str | Column) -> DataFrame:
    """Judge by a user-supplied model: render, reply in Arrow batches, read the final score."""
    @F.pandas_udf("string")
    def reply(prompts: pd.Series) -> pd.Series:
        return fn(prompts)

    return df.withColumn("_reply", reply(render_prompt(template, **values))).select(
        "record_id", F.lit(name).alias("name"), final_score("_reply").cast("string").alias("value"), F.col("_reply").alias("rationale")
    )


class ScorerRegistry:
    """User scorers by name: a Column builder, or a batch function over one column."""

    def __init__(self) -> None:
        self._known: dict[str, Callable[[], Score]] = {}

    def scorer(self, name: str | None = None) -> Callable:
        """Decorator for functions returning a Score, or a plain Column as the value."""
        def register(fn: Callable[[], Score | Column]) -> Callable:
            label = name or fn.__name__
            if label in self._known:
                raise ValueError(f"scorer {label} is already defined")

            def build() -> Score:
                made = fn()
                return made if isinstance(made, Score) else Score(made.cast("string"), F.lit(None).cast("string"))

            self._known[label] = build
            return fn

        return register

    def batch_scorer(self, name: str, *columns: str) -> Callable:
        """Decorator for pandas functions: a series for each column in; out, a series of values, or a frame of value and rationale.

        A column may hold anything Spark can hand to pandas, so a scorer may read a whole trace: its text, times and spans.
        """
        def register(fn: Callable[..., pd.Series | pd.DataFrame]) -> Callable:
            @F.pandas_udf("value string, rationale string")
            def run(*series: pd.Series) -> pd.DataFrame:
                found = fn(*series)
                if not isinstance(found, pd.DataFrame):
                    found = pd.DataFrame({"value": found, "rationale": None})
                return found[["value", "rationale"]].astype("string")

            def build() -> Score:
                both = run(*[F.col(c) for c in columns])
                return Score(both["value"], both["rationale"])

            self.scorer(name)(build)
            return fn

        return register

    def build(self, names: list[str] | None = None) -> dict[str, Score]:
        return {n: self._known[n]() for n in (names or self._known)}


def pivot_results(long: DataFrame, key: str, names: list[str]) -> DataFrame:
    """Wide results, one ``<name>/value`` column per scorer; names are given, so no job is run for them."""
    return long.groupBy(key).agg(
        *[F.max(F.when(F.col("name") == n, F.col("value"))).alias(f"{n}/value") for n in names]
    )


def evaluate(
    records: DataFrame,
    predict: Callable[[DataFrame], DataFrame] | None,
    scorers: dict[str, Score],
    jobs: dict[str, Callable[[DataFrame], DataFrame]] | None = None,
    key: str = "record_id",
    out: str | None = None,
    resume: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Predict, score and aggregate. Returns long results and long metrics.

    Answers and results are written once, under ``out`` or a new folder in the shared checkpoint folder, so the model is
    called once a row whatever reads them later. Column scorers share one pass over the answers; each job (answers in,
    ``key, value`` out) adds its rows by union. With ``resume``, a folder, answers are committed there part by part, and a run
    that follows one that died asks for the missing ones only (``resumable_answers``).
    """
    out = out or scratch_path(records.sparkSession, f"evaluation-{uuid.uuid4().hex}")
    answered = records
    if predict:
        answered = _stored(resumable_answers(records, predict, resume) if resume else predict(records), f"{out}/answers")
    found = [long_scores(answered, key, scorers)] if scorers else []
    for name, job in (jobs or {}).items():
        rows = job(answered).select(key, F.lit(name).alias("name"), F.col("value").cast("string").alias("value"), F.lit(None).cast("string").alias("rationale"))
        found.append(rows)
    results = _stored(reduce(DataFrame.unionByName, found), f"{out}/results")
    return results, scorer_metrics(results)


def resumable_answers(records: DataFrame, predict: Callable[[DataFrame], DataFrame], path: str, parts: int = 16, output: str = "outputs") -> DataFrame:
    """The records with their answers, for runs that may die: only what no earlier run has committed is asked.

    Distinct records, by the hash of all their columns, are dealt into ``parts``, and each part's answers are committed by a job of
    their own to a new folder under ``path``. Another run over the same or other records asks for the hashes that no committed
    folder holds; a record that has changed is a new one. Equal records are asked once. ``predict`` adds the column ``output``.
    """
    spark = records.sparkSession
    key = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in records.columns]), {"ignoreNullFields": "false"}), 256)
    hashed = records.withColumn("_hash", key)
    schema = f"_hash STRING, `{output}` STRING"

    def committed() -> DataFrame:
        root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        found = [s.getPath().toString() for s in fs.listStatus(root)] if fs.exists(root) else []
        done = [f for f in found if fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f + "/_SUCCESS"))]
        return spark.read.schema(schema).parquet(*done) if done else spark.createDataFrame([], schema)

    distinct = hashed.dropDuplicates(["_hash"])
    missing = written(distinct.join(committed().select("_hash"), "_hash", "left_anti").select(*hashed.columns), "unanswered")
    waiting = {r.part for r in missing.select(F.pmod(F.xxhash64("_hash"), F.lit(parts)).cast("int").alias("part")).distinct().collect()}
    for part in sorted(waiting):
        rows = missing.where(F.pmod(F.xxhash64("_hash"), F.lit(parts)) == part)
        answers = predict(rows).select("_hash", F.col(output).cast("string").alias(output))
        answers.write.parquet(f"{path}/{uuid.uuid4().hex}")
    answers = committed().groupBy("_hash").agg(F.max(output).alias(output))
    return hashed.drop(output).join(answers, "_hash", "left").drop("_hash")


def _stored(df: DataFrame, path: str) -> DataFrame:
    """Written once, read as often as need be; a second run for the same path replaces it."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


TURNS_PER_BUCKET = 1000


def chat_history(conversations: DataFrame) -> DataFrame:
    """Ordered messages as rows (conv_id, position, role, content), positions from 0, however long the conversation and
    whatever its turn numbers leave out."""
    placed = with_position(conversations.select("conv_id", "turn", "role", "text"), ["conv_id"], ["turn", "role"], F.floor(F.col("turn") / TURNS_PER_BUCKET))
    return placed.select("conv_id", "position", "role", F.col("text").alias("content"))
