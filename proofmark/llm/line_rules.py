"""Quality rules for documents, with the frequency of lines across the documents of a host. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proofmark.llm.common import col, written

GAP = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "[#*$%&|<>]"
#: A line is boilerplate if more different documents of its host hold it than this number, however many the host has.
LINE_DOCUMENTS = 20
#: A document is depleted if removed lines hold more than this share of its words.
DEPLETED = 0.5


def bound(value: Column, fn: Callable[[Column], Column]) -> Column:
    """fn(value) with the value computed once a row, however often fn uses it."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, GAP), "")


def repeated_words(ws: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the text, every occurrence included.

    Windows are hashed; hash and position are packed into one number, so one sort of plain numbers puts equal windows
    side by side. Positions of repeated windows, in order, each cover up to three words.
    """
    def windows(hashes: Column) -> Column:
        return F.transform(F.slice(hashes, 1, F.size(hashes) - 2), lambda x, i: F.xxhash64(x, F.get(hashes, i + 1), F.get(hashes, i + 2)))

    def covered(grams: Column) -> Column:
        bits = F.length(F.bin(F.size(grams)))

        def marked(n: Column) -> Column:
            low = F.call_function("shiftleft", F.lit(1).cast("long"), n) - 1
            packed = F.sort_array(F.transform(grams, lambda g, i: F.call_function("shiftleft", F.call_function("shiftright", g, n), n).bitwiseOR(i.cast("long"))))

            def places(sorted_: Column) -> Column:
                top = lambda e: F.call_function("shiftright", e, n)
                same = F.filter(
                    sorted_,
                    lambda e, i: (F.coalesce(top(F.get(sorted_, i + 1)) == top(e), F.lit(False)))
                    | ((i > 0) & F.coalesce(top(F.get(sorted_, F.greatest(i - 1, F.lit(0)))) == top(e), F.lit(False))),
                )
                return F.sort_array(F.transform(same, lambda e: e.bitwiseAND(low)))

            return bound(bound(packed, places), _cover)

        return bound(bits, marked)

    return bound(
        F.transform(ws, lambda w: F.xxhash64(w)),
        lambda hashes: F.when(F.size(hashes) < 4, F.lit(0).cast("long")).otherwise(bound(windows(hashes), covered)),
    )


def _cover(places: Column) -> Column:
    gaps = F.transform(places, lambda p, i: F.least(F.lit(3).cast("long"), F.coalesce(F.get(places, i + 1) - p, F.lit(3).cast("long"))))
    return F.aggregate(gaps, F.lit(0).cast("long"), lambda total, g: total + g)


def line_key(line: Column) -> Column:
    """Hash of a line without regard to case and white space."""
    return F.xxhash64(F.lower(F.trim(F.regexp_replace(line, GAP, " "))))


def measure(df: DataFrame, id_col: str, text_col: str, host_col: str, whole_rows: bool = False) -> DataFrame:
    """Per row, one pass: row number, id, host, hash of the text, the base counts, and key and words of each line.

    ``whole_rows`` keeps the input row as well, as the struct ``doc``.
    """
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    kept = [F.struct(*[col(c) for c in df.columns]).alias("doc")] if whole_rows else []
    rows = df.select(
        F.monotonically_increasing_id().alias("row"), col(id_col).alias("id"), F.coalesce(col(host_col).cast("string"), F.lit("")).alias("host"),
        text.alias("text"), words(text).alias("ws"), F.filter(F.split(text, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]")).alias("lines"), *kept,
    )
    return rows.select(
        "row", "id", "host", F.xxhash64("text").alias("copy"),
        F.size("ws").cast("long").alias("n_words"),
        F.length(F.array_join("ws", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("ws")).alias("n_repeat_words"),
        F.transform("lines", lambda line: F.struct(line_key(line).alias("key"), F.size(words(line)).alias("words"))).alias("lines"),
        *(["doc"] if whole_rows else []),
    )


def common_lines(measured: DataFrame, least: int = LINE_DOCUMENTS) -> DataFrame:
    """(host, key) of lines above the limit. Exact copies of a document count once, so copies alone make no line common."""
    seen = measured.select("host", "copy", F.explode(F.array_distinct(F.transform("lines", lambda line: line.key))).alias("key"))
    return seen.distinct().groupBy("host", "key").agg(F.count("*").alias("n")).where(F.col("n") > least).select("host", "key")


def judged(measured: DataFrame, least: int = LINE_DOCUMENTS, depleted: float = DEPLETED) -> DataFrame:
    """The measured rows with removed (keys of their common lines), removed_words, base_failed and kept."""
    common = written(common_lines(measured, least), "common-lines")
    hits = (
        measured.select("row", "host", F.inline("lines"))
        .join(common, ["host", "key"])
        .groupBy("row")
        .agg(F.collect_set("key").alias("removed"), F.sum("words").alias("removed_words"))
    )
    joined = measured.join(hits, "row", "left").withColumn("removed_words", F.coalesce("removed_words", F.lit(0)).cast("long"))
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    return joined.withColumn("base_failed", failed).withColumn(
        "kept", ~failed & (F.col("removed_words") <= F.col("n_words") * depleted)
    )


def quality(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", **limits) -> DataFrame:
    """One row per input row: id, base counts, base_failed, kept, removed_words.

    A null text has no words and fails the base rule; a null host is a host of its own. Repeated rows stay and count as
    copies of one document. Other columns are not read. An empty table gives none.
    """
    rows = judged(written(measure(df, id_col, text_col, host_col), "measured"), **limits)
    return rows.select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "removed_words"
    )


def cleaned(df: DataFrame, text_col: str = "text", host_col: str = "source", length_col: str | None = "n_chars", **limits) -> DataFrame:
    """The kept rows of a table, all columns, without their common lines; the length column is brought up to date.

    Texts without a common line come back as they are.
    """
    rows = judged(written(measure(df, df.columns[0], text_col, host_col, whole_rows=True), "measured"), **limits).where("kept")
    old = F.col("doc").getField(text_col)
    new = F.when(
        F.col("removed").isNull(), old
    ).otherwise(F.array_join(F.filter(F.split(old, "\n"), lambda line: ~F.array_contains("removed", line_key(line))), "\n"))
    rows = rows.withColumn("cleaned", new)

    def value(name: str) -> Column:
        given = F.col("doc").getField(name)
        if name == text_col:
            return F.col("cleaned")
        if name == length_col:
            return F.when(F.col("removed").isNull(), given).otherwise(F.length("cleaned").cast(df.schema[name].dataType))
        return given

    return rows.select(*[value(c).alias(c) for c in df.columns])
