"""Small tables with every awkward case: nulls, empty and long texts, repeated rows, columns whose names the operators use inside."""

from __future__ import annotations

import random

CLASHES = "id string, row string, fp string, body string, key string, host string, doc string, n_words string, log_weight string, sample_key string, log_weight_ string"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + CLASHES


def docs_of(spark, texts, lang="en", source="s0", ids=None):
    rows = [(i if ids is None else ids[i], t, lang, source, None if t is None else len(t)) + ("x",) * 11 for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def words(n, seed=0, pool=None):
    rng = random.Random(seed)
    pool = pool or [a + b for a in ("ba", "co", "du", "fe", "gi", "lo") for b in ("ran", "set", "mil", "tor", "pen", "dax", "vik", "sol")]
    return " ".join(rng.choice(pool) + (str(rng.randint(0, 99)) if rng.random() < 0.3 else "") for _ in range(n))


AWKWARD = [
    None, "", " \t\n ", "one", "two words", "Ünïcödé 中文 ßtraße", "line a\nline a\n\nline b", "tab\tand\x0bmore\x0c\r\nend ", "x" * 3000,
    "Same text here for the copies", "Same text here for the copies", "same TEXT here  for the\ncopies", words(40_000, 5), "<|endoftext|> it's  123 !!", "nb sp　wide\x1csep",
]


def awkward(spark):
    """The awkward texts; the last two rows repeat a row, and one has no id."""
    ids = [*range(len(AWKWARD)), 9, None]
    return docs_of(spark, [*AWKWARD, AWKWARD[9], "text of no id"], ids=ids)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
