"""Joins between logs, traces, feedback, registries and documents.

Fact sides may hold one very hot key. Each join below meets a side that is unique per key (a key
table, or an aggregate made by map-side combine), so a hot key only ever needs its fact side split,
which adaptive skew-join handling does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proofmark.functions import text
from proofmark.operators.monitoring import as_assessments
from proofmark.operators.ranking import keep_last


def bridge_request_trace(log: DataFrame, traces: DataFrame, key: str = "client_request_id") -> DataFrame:
    """Traces whose request id is in the log."""
    ids = log.select(F.col("request_id").alias(key)).distinct()
    return traces.join(ids, key, "left_semi")


def request_with_trace(log: DataFrame, traces: DataFrame, key: str = "client_request_id") -> DataFrame:
    """Traces with the log row of their request as the struct ``log``; of a request logged twice, the newest row.

    Traces of a request that was not logged have no row.
    """
    newest = keep_last(log.where(F.col("request_id").isNotNull()), ["request_id"], ["timestamp_ms"])
    return traces.join(newest.select(F.col("request_id").alias(key), F.struct(*newest.columns).alias("log")), key)


def latest_trace_per_request(traces: DataFrame, *carry: str) -> DataFrame:
    """The newest trace of each client request id."""
    newest = F.max_by(F.struct("trace_id", *carry), F.struct("request_ms", "trace_id"))
    return traces.groupBy("client_request_id").agg(newest.alias("t")).select("client_request_id", "t.*")


def resolve_client_request(feedback: DataFrame, traces: DataFrame) -> DataFrame:
    return feedback.join(latest_trace_per_request(traces), "client_request_id", "inner")


def unresolved_feedback(feedback: DataFrame, traces: DataFrame) -> DataFrame:
    return feedback.join(traces.select("client_request_id").distinct(), "client_request_id", "left_anti")


def attach_feedback(feedback: DataFrame, traces: DataFrame) -> DataFrame:
    """Assessments (``schemas.ASSESSMENTS``) from clicks: helpful for each, satisfaction where it was given, at the time of the click."""
    rows = F.array(
        F.struct(
            F.lit("user_helpful").alias("name"),
            F.col("helpful").cast("string").alias("value"),
            F.col("rationale").alias("rationale"),
            F.col("user_id").alias("source_id"),
        ),
        F.struct(
            F.lit("satisfaction").alias("name"),
            F.col("satisfaction").cast("string").alias("value"),
            F.lit(None).cast("string").alias("rationale"),
            F.lit("aggregate").alias("source_id"),
        ),
    )
    attached = resolve_client_request(feedback, traces).select("trace_id", "clicked_ms", F.inline(rows))
    return as_assessments(attached.where(F.col("value").isNotNull()).withColumn("source_type", F.lit("HUMAN")), "clicked_ms")


def human_label_join(scores: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Scores with the label of their record; of repeated labels, the greatest counts."""
    rest = [c for c in labels.columns if c != key]
    return scores.join(keep_last(labels, [key], rest), key, "inner")


def keyword_documents(question, keyword_map: dict[str, list[str]]) -> Column:
    """Documents of every keyword found in the question, in map order, without repeats."""
    if not keyword_map:
        return F.array().cast("array<string>")
    entries = F.array(*[F.struct(F.lit(word).alias("word"), text.listed(docs).alias("docs")) for word, docs in keyword_map.items()])
    held = F.filter(entries, lambda e: F.contains(F.lower(text.col(question)), e["word"]))
    return F.coalesce(F.array_distinct(F.flatten(F.transform(held, lambda e: e["docs"]))), F.array().cast("array<string>"))


def phrase_hits(df: DataFrame, key: str, column: str, phrases: DataFrame, phrase: str = "phrase") -> DataFrame:
    """(key, phrase): phrases of a table that a text uses as whole tokens, each once.

    For lists too long for a plan. Phrases meet texts by an equi-join on token n-grams: texts give their distinct runs of
    tokens of the lengths that the table has, so nothing is compared with everything. Lengths are few: one small aggregate.
    """
    terms = phrases.select(F.col(phrase).alias("phrase"), text.tokens(F.col(phrase)).alias("_t")).where(F.size("_t") > 0)
    terms = terms.select("phrase", F.array_join("_t", " ").alias("_gram"), F.size("_t").alias("_n")).distinct()
    sizes = sorted(r[0] for r in terms.select("_n").distinct().collect())
    if not sizes:
        return df.select(key, F.lit(None).cast("string").alias("phrase")).where(F.lit(False))
    with_tokens = df.select(key, text.tokens(column).alias("_w"))
    runs = F.array_distinct(F.flatten(F.array(*[_token_runs(n) for n in sizes])))
    return with_tokens.select(key, F.explode(runs).alias("_gram")).join(terms, "_gram").select(key, "phrase").distinct()


def _token_runs(n: int) -> Column:
    if n == 1:
        return F.col("_w")
    starts = F.filter(F.sequence(F.lit(1), F.greatest(F.size("_w"), F.lit(1))), lambda i: i + (n - 1) <= F.size("_w"))
    return F.transform(starts, lambda i: F.array_join(F.slice("_w", i, n), " "))


def keyword_expected_docs(records: DataFrame, keyword_map: dict[str, list[str]], question: str = "question") -> DataFrame:
    return records.withColumn("expected_docs", keyword_documents(question, keyword_map))


def keyword_retrieve(records: DataFrame, docs: dict[str, str], question: str = "question", none: str = "none") -> DataFrame:
    """Documents whose key occurs in the question, or one sentinel row."""
    hits = keyword_documents(question, {word: [doc] for word, doc in docs.items()})
    return records.withColumn("_hits", hits).select(
        *records.columns, F.explode(F.when(F.size("_hits") > 0, F.col("_hits")).otherwise(F.array(F.lit(none)))).alias("doc_id")
    )


def compare_runs_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Row-by-row comparison of two runs on the same record and scorer; of repeated scores, the greatest counts."""
    on = ["record_id", "scorer"]
    left = a.groupBy(*on).agg(F.max("score").alias("score_a"))
    right = b.groupBy(*on).agg(F.max("score").alias("score_b"))
    return left.join(right, on, "inner").withColumn("delta", F.col("score_b") - F.col("score_a"))


def judges_seen(assessments: DataFrame) -> DataFrame:
    return assessments.select("name").distinct()


def monitor_coverage(registry: DataFrame, assessments: DataFrame) -> DataFrame:
    """Each registered scorer with the number of results seen; zero means not seen yet."""
    seen = assessments.groupBy("name").agg(F.count("*").alias("n_seen"))
    return registry.join(seen, "name", "left").select(
        "name",
        F.coalesce("n_seen", F.lit(0)).alias("n_seen"),
        F.when(F.col("n_seen").isNull(), "missing").otherwise("seen").alias("coverage"),
    )


def missing_monitors(registry: DataFrame, assessments: DataFrame) -> DataFrame:
    """Registered names with no result."""
    return registry.select("name").join(judges_seen(assessments), "name", "left_anti")


def uncovered_docs(docs: DataFrame, citations: DataFrame) -> DataFrame:
    """Documents that no question cites."""
    return docs.join(citations.select("doc_uri").distinct(), "doc_uri", "left_anti")


def facts_in_source(records: DataFrame, docs: DataFrame) -> DataFrame:
    """For each fact and cited document: does the fact occur in the document?

    The text is only read where it is cited; the shuffle carries facts to documents by document key.
    """
    facts = records.select("record_id", F.explode("facts").alias("fact"), "uris").select(
        "record_id", "fact", F.explode("uris").alias("doc_uri")
    )
    found = F.contains(F.lower("content"), F.lower("fact"))
    sources = keep_last(docs.select("doc_uri", "content"), ["doc_uri"], ["content"])
    return facts.join(sources, "doc_uri", "inner").select("record_id", "doc_uri", "fact", text.yes_no(found).alias("in_source")).distinct()


def changes(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Change feed between two snapshots: insert, update or delete per key.

    Only the key and a payload digest are shuffled, whatever the width of the rows.
    """
    def digest(df: DataFrame, name: str) -> DataFrame:
        payload = F.to_json(F.struct(*[c for c in sorted(df.columns) if c != key]), {"ignoreNullFields": "false"})
        return df.select(key, F.sha2(payload, 256).alias(name))

    joined = digest(old, "_old").join(digest(new, "_new"), key, "full_outer")
    change = (
        F.when(F.col("_old").isNull(), "insert")
        .when(F.col("_new").isNull(), "delete")
        .when(F.col("_old") != F.col("_new"), "update")
    )
    return joined.select(key, change.alias("change")).where(F.col("change").isNotNull())
