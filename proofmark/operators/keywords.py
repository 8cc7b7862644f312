"""Keyword tables: which texts hold which keywords, as substrings, for lists too long for a plan.

A keyword is looked for under one key only, the rarest of its runs of three characters (the keyword itself, if shorter). Texts give
their distinct runs that are keys of some keyword; keyword and text meet by an equi-join on the key, and the text decides.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from proofmark.functions import text
from proofmark.session import written

GRAM = 3
#: Runs of keywords are marked in so many slots (a prime), which bounds what the tasks over the texts hold of them.
SLOTS = 4_194_301
#: Characters of a text whose runs are made at a time, and pairs of text and run that leave a task at a time.
PIECE = 1 << 20


def _codes(chars: str, n: int) -> np.ndarray:
    """The runs of n characters, each as one number: 21 bits a character, none of them zero, so runs of two lengths differ."""
    points = np.frombuffer(chars.encode("utf-32-le"), dtype=np.uint32).astype(np.int64) + 1
    codes = points[: max(len(points) - n + 1, 0)]
    for k in range(1, n):
        codes = codes << 21 | points[k : len(points) - n + 1 + k]
    return codes


def _distinct(chars: str, sizes: list[int]) -> np.ndarray:
    """Distinct runs of some lengths of a text."""
    found = [np.unique(_codes(chars[start : start + PIECE + n - 1], n)) for n in sizes for start in range(0, len(chars), PIECE)]
    if not found:
        return np.empty(0, dtype=np.int64)
    return np.concatenate(found) if len(chars) <= PIECE else np.unique(np.concatenate(found))


def _runs(df: DataFrame, sizes: list[int] | None = None, slots: np.ndarray | None = None) -> DataFrame:
    """The distinct runs of a text, the bytes `_body`, as `_gram` beside the other columns: of these lengths, or one of its own up to GRAM.

    `slots`: only runs that fall into these, which holds for every run that is looked for and for few others.
    """
    wanted = None
    if slots is not None:
        marks = np.zeros(SLOTS, dtype=bool)
        marks[slots] = True
        wanted = df.sparkSession.sparkContext.broadcast(marks)
    kept = [c for c in df.columns if c != "_body"]

    def run(batches):
        for batch in batches:
            rows, grams, held = [], [], 0
            for row, body in enumerate(batch.column("_body").to_pylist()):
                chars = body.decode("utf-8", "replace")
                codes = _distinct(chars, sizes or [max(1, min(len(chars), GRAM))])
                if wanted is not None:
                    codes = codes[wanted.value[codes % SLOTS]]
                rows.append(np.full(len(codes), row))
                grams.append(codes)
                held += len(codes)
                if held > PIECE:
                    yield paired(batch, rows, grams)
                    rows, grams, held = [], [], 0
            if held:
                yield paired(batch, rows, grams)

    def paired(batch, rows, grams):
        at = pa.array(np.concatenate(rows))
        return pa.RecordBatch.from_arrays([*(batch.column(c).take(at) for c in kept), pa.array(np.concatenate(grams))], [*kept, "_gram"])

    return df.mapInArrow(run, T.StructType([*(df.schema[c] for c in kept), T.StructField("_gram", T.LongType())]))


def keyword_hits(df: DataFrame, key: str, column: str, keywords: DataFrame, keyword: str = "keyword") -> DataFrame:
    """(key, keyword): keywords of a table that a text holds anywhere, without regard to case, each once.

    ``key`` is unique per text. A null text holds nothing; a null or empty keyword is in no text.
    """
    wanted = keywords.select(F.col(keyword).alias("keyword")).where(F.length("keyword") > 0).distinct()
    lowered = wanted.withColumn("_low", F.lower("keyword"))
    parts = written(_runs(lowered.withColumn("_body", F.col("_low").cast("binary"))), "keyword-runs")
    known = parts.select("_gram").distinct()
    sizes = [r.n for r in lowered.select(F.least(F.length("_low"), F.lit(GRAM)).alias("n")).distinct().orderBy("n").collect()]
    slots = known.select(F.pmod("_gram", F.lit(SLOTS)).alias("slot")).distinct().toArrow().column("slot").to_numpy()  # SLOTS at most

    # Only runs that some keyword has are written.
    spelled = df.where(F.col(column).isNotNull()).select(F.col(key).alias("_id"), F.lower(text.col(column)).cast("binary").alias("_body"))
    runs = _runs(spelled, sizes, slots)
    met = written(runs.join(known, "_gram", "left_semi").select("_id", "_gram"), "text-runs")
    seen = met.groupBy("_gram").agg(F.count("*").alias("n"))
    # A keyword with a run that no text has is in no text; the others go by their rarest.
    rated = parts.join(seen, "_gram", "left").groupBy("keyword", "_low").agg(
        F.min_by("_gram", F.struct("n", "_gram")).alias("_gram"), F.count_if(F.col("n").isNull()).alias("missing")
    )
    keys = rated.where(F.col("missing") == 0).select("keyword", "_low", "_gram")
    texts = df.select(F.col(key).alias("_id"), F.lower(text.col(column)).alias("_text"))
    pairs = met.join(keys, "_gram").select("_id", "keyword", "_low").join(texts, "_id")
    return pairs.where(F.contains("_text", F.col("_low"))).select(F.col("_id").alias(key), "keyword")


def keyword_documents(
    records: DataFrame, key: str, question: str, keywords: DataFrame, docs: DataFrame, none: str = "none",
) -> DataFrame:
    """(key, doc_id, content, n_keywords): the documents whose keywords a question holds, with their content, or one sentinel row.

    ``keywords`` holds (keyword, doc_id), ``docs`` (doc_id, content); a document that is not in ``docs`` comes without content.
    """
    hits = keyword_hits(records, key, question, keywords).join(keywords.select("keyword", "doc_id").distinct(), "keyword")
    counted = hits.groupBy(key, "doc_id").agg(F.count("*").alias("n_keywords"))
    content = docs.groupBy("doc_id").agg(F.max("content").alias("content"))
    found = counted.join(content, "doc_id", "left")
    everyone = records.select(key).distinct()
    return everyone.join(found, key, "left").select(
        key, F.coalesce("doc_id", F.lit(none)).alias("doc_id"), "content", F.coalesce("n_keywords", F.lit(0)).alias("n_keywords")
    )
