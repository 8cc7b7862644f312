"""Lexical stand-ins for language-model judges.

A hosted judge answers a question in prose; no model can run inside this library. Each function
here answers the same question by a stated word-level rule, so results are repeatable, but it is a
proxy and is not calibrated against a model. ``harness.model_judge`` takes a real one.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proofmark.functions import text
from proofmark.operators.ranking import keep_last
from proofmark.operators.scorers import Score

# Default thresholds; parameters of every judge, not calibrated.
RELEVANT = 0.3
GROUNDED = 0.5


def correctness(df: DataFrame, facts: str = "facts", output: str = "outputs") -> DataFrame:
    """Every expected fact occurs in the answer, case aside; no verdict without facts.

    Adds ``value`` and the missing facts, sorted. Facts live on the row, so nothing is shuffled.
    """
    low = df.withColumn("_low", F.lower(output))
    absent = F.filter(facts, lambda f: ~F.contains(F.col("_low"), F.lower(f)))
    missing = F.when(F.col("_low").isNull(), F.col(facts)).otherwise(absent)
    return (
        low.withColumn("_missing", missing)
        .withColumn("value", F.when(F.size(facts) > 0, text.yes_no(F.size("_missing") == 0)))
        .withColumn("rationale", F.array_join(F.array_sort("_missing"), " | "))
        .drop("_low", "_missing")
    )


def relevance(df: DataFrame, question: str = "question", output: str = "outputs", threshold: float = RELEVANT) -> DataFrame:
    """Enough of the question's content terms come back in the answer."""
    prepared = df.withColumns({"_q": text.content_terms(question), "_a": text.tokens(output)})
    share = prepared.withColumn("coverage", F.round(text.coverage("_q", "_a"), 6))
    return share.withColumn("value", text.yes_no(F.col("coverage") >= threshold)).drop("_q", "_a")


def context_terms(retrieved: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """Distinct terms of the at most ``k`` documents retrieved per record.

    Terms are made once per document; a document's text never leaves its row.
    """
    known = keep_last(docs.select("doc_id", text.content_terms("content").alias("_t")), ["doc_id"], ["_t"])
    return (
        retrieved.where(F.col("rank") <= k)
        .select("record_id", "doc_id")
        .join(known, "doc_id")
        .groupBy("record_id")
        .agg(F.array_distinct(F.flatten(F.collect_list("_t"))).alias("context"))
    )


SENTENCES_PER_BLOCK = 16


def groundedness(answers: DataFrame, retrieved: DataFrame, docs: DataFrame, k: int = 3, threshold: float = GROUNDED) -> DataFrame:
    """Each sentence of the answer is covered by the retrieved text; no verdict when nothing was retrieved.

    A record's context is ``k`` documents at most, so the check stays on the row. Terms absent from the
    context are found once per answer, narrowed per block of sentences, and only then met with each
    sentence: a set operation hashes its second side anew each time, so that side is kept short.
    """
    joined = answers.select("record_id", "outputs").join(context_terms(retrieved, docs, k), "record_id", "left")
    starts = F.filter(F.sequence(F.lit(0), F.size("_s"), F.lit(SENTENCES_PER_BLOCK)), lambda i: i < F.size("_s"))
    blocks = F.transform(starts, lambda i: F.slice("_s", i + 1, SENTENCES_PER_BLOCK))
    marked = F.transform(
        "_b", lambda b: F.struct(b.alias("s"), F.array_intersect(F.flatten(b), F.col("_lack")).alias("lack"))
    )

    def unsupported(block: Column) -> Column:
        return F.filter(
            block["s"],
            lambda t: (F.size(t) > 0) & (F.size(F.array_intersect(t, block["lack"])) > F.size(t) * F.lit(1 - threshold)),
        )

    counted = (
        joined.withColumn("_s", F.transform(text.sentences("outputs"), lambda s: text.content_terms(s)))
        .withColumns({"_lack": F.array_except(F.flatten("_s"), F.col("context")), "_b": blocks})
        .withColumn("_m", marked)
        # The test on ``_lack`` also keeps it a column: used once, it would be moved into the function
        # above and made anew for each block.
        .withColumn("n_unsupported", F.when(F.size("_lack") == 0, 0).otherwise(F.size(F.flatten(F.transform("_m", unsupported)))))
    )
    known = F.col("context").isNotNull()
    return counted.select(
        "record_id",
        F.when(known, F.col("n_unsupported")).alias("n_unsupported"),
        F.when(known, text.yes_no(F.col("n_unsupported") == 0)).alias("value"),
    )


def retrieval_relevance(questions: DataFrame, retrieved: DataFrame, docs: DataFrame, threshold: float = RELEVANT) -> DataFrame:
    """Share of retrieved documents that cover enough of the question."""
    asked = questions.select("record_id", text.content_terms("question").alias("_q"))
    known = keep_last(docs.select("doc_id", F.array_distinct(text.tokens("content")).alias("_d")), ["doc_id"], ["_d"])
    found = retrieved.select("record_id", "doc_id").join(known, "doc_id").select("record_id", "_d")
    hit = F.when(F.coalesce(text.coverage("_q", "_d"), F.lit(0.0)) >= threshold, 1.0).otherwise(0.0)
    return found.join(asked, "record_id", "inner").select("record_id", hit.alias("hit")).groupBy("record_id").agg(
        F.count("*").alias("n_docs"), F.round(F.avg("hit"), 6).alias("relevance")
    )


def safety(output: str, lexicon: list[str]) -> Score:
    """No word or phrase of the lexicon and no personal data; the rationale names what was found first. No text, no verdict."""
    reason = F.coalesce(text.first_pii_kind(output), F.when(text.uses_term(output, lexicon), F.lit("lexicon")))
    return Score(F.when(text.col(output).isNotNull(), text.yes_no(reason.isNull())), reason)


class Rule(NamedTuple):
    """One guideline as data: a kind, its argument, and an optional guard on the question."""

    kind: str
    arg: str
    question_guard: str | None = None


def _with_language(df: DataFrame, output: str, wanted: bool = True) -> DataFrame:
    """Add the language, once per row, where a rule asks for it."""
    return text.with_language(df.withColumn("_tok", text.tokens(output)), "_tok", "_lang") if wanted else df


def _holds(kind: Column, arg: Column, out: Column, lang: Column, n_sentences: Column) -> Column:
    """Does a rule hold? The one engine behind listed rules and rules on the row. An unknown kind, or an argument that it
    cannot read, gives null; so does a missing text."""
    return (
        F.when(kind == "language", lang == arg)
        .when(kind == "max_sentences", n_sentences <= arg.try_cast("int"))
        .when(kind == "must_match", F.rlike(out, arg))
        .when(kind == "must_not_match", ~F.rlike(out, arg))
        .when(kind == "must_contain", F.contains(F.lower(out), F.lower(arg)))
        .when(kind == "must_not_contain", ~F.contains(F.lower(out), F.lower(arg)))
    )


def rule_holds(rule: Rule, output: str = "outputs", question: str = "question") -> Column:
    """yes / no; a guarded rule whose guard is not met has no verdict. Language rules read ``_lang``."""
    out = text.col(output)
    verdict = text.yes_no(_holds(F.lit(rule.kind), F.lit(rule.arg), out, F.col("_lang") if rule.kind == "language" else F.lit(None).cast("string"), F.size(text.sentences(out))))
    return F.when(text.col(question).rlike(rule.question_guard), verdict) if rule.question_guard else verdict


def guidelines(df: DataFrame, key: str, name: str, rules: list[Rule], output: str = "outputs", question: str = "question") -> DataFrame:
    """Verdict per row against a rule list: fails when any rule fails; failing rules are listed. No text, no verdict."""
    results = rule_results(df.withColumn("_given", text.col(output).isNotNull()), key, name, rules, output, question, carry=["_given"], as_array=True)
    failed = F.transform(F.filter("_rules", lambda r: F.coalesce(r["passed"] == "no", F.lit(False))), lambda r: r["rule_id"].cast("string"))
    return results.withColumn("_failed", failed).select(
        key, F.lit(name).alias("scorer"), F.when(F.col("_given"), text.yes_no(F.size("_failed") == 0)).alias("value"), F.array_join("_failed", ",").alias("failed_rules")
    )


def rule_results(df: DataFrame, key: str, name: str, rules: list[Rule], output: str = "outputs", question: str = "question",
                 carry: list[str] | None = None, as_array: bool = False) -> DataFrame:
    """One row per record and rule, or one array per record."""
    rows = F.array(
        *[F.struct(F.lit(i).alias("rule_id"), rule_holds(r, output, question).alias("passed")) for i, r in enumerate(rules, 1)]
    ).cast("array<struct<rule_id:int,passed:string>>")
    prepared = _with_language(df, output, any(r.kind == "language" for r in rules))
    return prepared.select(key, *(carry or []), F.lit(name).alias("scorer"), rows.alias("_rules") if as_array else F.inline(rows))


def row_guidelines(df: DataFrame, key: str, rules: str = "guidelines", output: str = "outputs") -> DataFrame:
    """Rules that live on the row, written ``kind:argument``; fails when any fails.

    A rule of an unknown kind, or with an argument its kind cannot read, is listed in ``unknown_rules``; a row with one has
    no verdict. Neither has a row without rules or without text.
    """
    prepared = _with_language(df, output).select(
        key, rules, "_lang", F.col(output).alias("_out"), F.size(text.sentences(output)).alias("_n")
    )
    marked = F.transform(
        rules,
        lambda r: F.struct(
            r.alias("rule"),
            _holds(F.substring_index(r, ":", 1), F.regexp_replace(r, r"^[^:]*:", ""), F.col("_out"), F.col("_lang"), F.col("_n")).alias("held"),
        ),
    )
    given = F.col("_out").isNotNull()
    listed = prepared.withColumn("_m", marked).withColumns(
        {
            "_f": F.transform(F.filter("_m", lambda m: ~F.coalesce(m["held"], F.lit(True))), lambda m: m["rule"]),
            "_u": F.transform(F.filter("_m", lambda m: m["held"].isNull() & given), lambda m: m["rule"]),
        }
    )
    return listed.select(
        key,
        F.when(given & (F.size(rules) > 0) & (F.size("_u") == 0), text.yes_no(F.size("_f") == 0)).alias("value"),
        F.array_join("_f", ",").alias("failed_rules"),
        F.array_join("_u", ",").alias("unknown_rules"),
    )


class Override(NamedTuple):
    """A hard rule of a rubric: where it applies, the score is at most ``cap``."""

    applies: Column
    cap: int


def rubric(base_coverage: Column, overrides: list[Override]) -> Column:
    """1-5 grade: coverage bands, then the caps; null coverage gives no grade."""
    base = F.least(F.lit(5), 1 + F.floor(base_coverage * 4)).cast("int")
    capped = reduce(lambda score, o: F.when(o.applies, F.least(score, F.lit(o.cap))).otherwise(score), overrides, base)
    return F.when(base_coverage.isNotNull(), capped)


def knowledge_retention(conversations: DataFrame) -> DataFrame:
    """Share of content terms from earlier user turns that the last answer still uses.

    A term is reduced to one row per conversation before conversations meet anything: its first user
    turn and the last answer that holds it. A first exchange has no verdict.
    """
    roles = conversations.where(F.col("role").isin("user", "assistant"))
    # Last answer, then the last user turn before it, both by mergeable aggregates.
    last_answer = roles.groupBy("conv_id").agg(F.max(F.when(F.col("role") == "assistant", F.col("turn"))).alias("last_answer"))
    asked = (
        roles.where(F.col("role") == "user")
        .select("conv_id", "turn")
        .join(last_answer, "conv_id")
        .where(F.col("turn") < F.col("last_answer"))
        .groupBy("conv_id")
        .agg(F.max("turn").alias("last_question"), F.max("last_answer").alias("last_answer"))
    )
    terms = (
        roles.select("conv_id", "turn", "role", F.explode(text.content_terms("text")).alias("term"))
        .groupBy("conv_id", "term")
        .agg(
            F.min(F.when(F.col("role") == "user", F.col("turn"))).alias("first_user"),
            F.max(F.when(F.col("role") == "assistant", F.col("turn"))).alias("last_assistant"),
        )
        .where(F.col("first_user").isNotNull())
    )
    placed = terms.join(asked, "conv_id", "inner")
    earlier = F.col("first_user") < F.col("last_question")
    kept = earlier & (F.col("last_assistant") == F.col("last_answer"))
    counts = placed.groupBy("conv_id").agg(F.count_if(earlier).alias("n_terms"), F.count_if(kept).alias("n_kept"))
    return asked.select("conv_id").join(counts, "conv_id", "left").select(
        "conv_id",
        F.coalesce("n_terms", F.lit(0)).alias("n_terms"),
        F.round(F.try_divide("n_kept", "n_terms"), 6).alias("retention"),
    )
