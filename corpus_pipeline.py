"""Documents to training tokens: quality rules, quality classifier, near-duplicates, benchmark passages, token ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from proofmark.llm import bpe, contamination, importance, line_rules, queries, simhash
from proofmark.llm.common import prepare, table, written
from proofmark.session import tune


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Common lines of a source go; documents that fail the base rules, or are depleted without those lines, go."""
    prepare(tune(spark))
    return line_rules.cleaned(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents outside the importance sample go."""
    prepare(tune(spark))
    return importance.filtered(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints at most two bits apart (three-word shingles) stays, the one of the smallest id."""
    prepare(tune(spark))
    return simhash.one_of_each(docs, most_bits=simhash.MOST_BITS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out of contaminated documents; what is mostly such passages goes."""
    prepare(tune(spark))
    return contamination.remove_passages(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts, and hashes of the ids and of the decoded bytes, of what is left."""
    prepare(tune(spark))
    return bpe.round_trip(docs, queries.RANKS, queries.public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("near-duplicates", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("byte-level BPE", token_ids),
]

#: The fitted classifier and the hashed fingerprints have no SQL form; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what a stage returns is written and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage-{k}")
    return docs
