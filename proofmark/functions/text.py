"""Text Columns: words, tokens, sentences, content terms, language, personal data.

All are built from JVM-side functions over the whole text. Where a token array is read more than
once, give it a column of its own first (``df.withColumn``): Catalyst then keeps the projection
apart and the regular expression runs once per row.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Stop words per language, in tie-break order of the languages.
STOP_WORDS = {
    "en": ["the", "and", "of", "to", "in", "that", "is"],
    "fr": ["le", "la", "les", "et", "un", "une", "qui", "que", "dans"],
    "de": ["der", "die", "das", "und", "ein", "eine", "in"],
    "es": ["el", "los", "las", "y", "un", "que", "en", "de"],
}
ALL_STOP_WORDS = sorted({word for words in STOP_WORDS.values() for word in words})

# Personal-data patterns, in the order in which they are reported.
PII_PATTERNS = {
    "ssn": r"\b\d{3}-\d{2}-\d{4}\b",
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "card": r"\b\d{16}\b",
}
# A cheap test that must hold before the pattern above is tried.
PII_GUARDS = {"email": "@"}

# Fixed value: a bracketed citation.
CITATION = r"\[[^\]]+\]"

MIN_TERM_LENGTH = 3


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def words(c) -> Column:
    """Whitespace-separated words; an empty text has none."""
    return F.filter(F.split(col(c), r"\s+"), lambda w: w != "")


def word_count(c) -> Column:
    return F.size(words(c))


def tokens(c) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.regexp_extract_all(F.lower(col(c)), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def sentences(c) -> Column:
    """Pieces between sentence ends that hold at least one letter or digit."""
    return F.filter(F.split(col(c), r"[.!?]+"), lambda s: s.rlike(r"[\p{L}\p{N}]"))


def first_sentence(c) -> Column:
    return F.trim(F.coalesce(F.get(sentences(c), F.lit(0)), F.lit("")))


def content_terms(c) -> Column:
    """Distinct tokens of three or more characters that are not stop words."""
    return terms_of(tokens(c))


def terms_of(token_array) -> Column:
    return F.array_distinct(
        F.filter(
            col(token_array),
            lambda t: (F.length(t) >= MIN_TERM_LENGTH) & ~t.isin(ALL_STOP_WORDS),
        )
    )


def coverage(wanted, present) -> Column:
    """Share of ``wanted`` terms that are in ``present``; null when nothing is wanted."""
    wanted, present = col(wanted), col(present)
    return F.when(
        F.size(wanted) > 0,
        F.size(F.array_intersect(wanted, present)).cast("double") / F.size(wanted),
    )


def with_language(df: DataFrame, token_col: str, into: str = "language") -> DataFrame:
    """Add the language with most stop-word hits; earlier language on ties, ``none`` without a hit.

    Steps are columns of their own, so that the tokens are passed over once and every count is made once.
    """
    counts = F.array(*[_hits("_stops", stop_words) for stop_words in STOP_WORDS.values()])
    best = F.array_max("_hits")
    names = F.array(*[F.lit(lang) for lang in STOP_WORDS])
    return (
        df.withColumn("_stops", F.filter(token_col, lambda t: t.isin(ALL_STOP_WORDS)))
        .withColumn("_hits", counts)
        .withColumn(into, F.when(best == 0, "none").otherwise(F.element_at(names, F.array_position("_hits", best).cast("int"))))
        .drop("_stops", "_hits")
    )


def _hits(token_col: str, stop_words: list[str]) -> Column:
    return F.size(F.filter(token_col, lambda t: t.isin(stop_words)))


def has_pii(c, kind: str) -> Column:
    text = col(c)
    found = text.rlike(PII_PATTERNS[kind])
    guard = PII_GUARDS.get(kind)
    return F.contains(text, F.lit(guard)) & found if guard else found


def first_pii_kind(c) -> Column:
    """Name of the first personal-data kind found, null when there is none."""
    return F.coalesce(*[F.when(has_pii(c, kind), F.lit(kind)) for kind in PII_PATTERNS])


def redact(c) -> Column:
    """Replace every personal-data match by ``[KIND]``."""
    def mask(text: Column, kind: str) -> Column:
        return F.regexp_replace(text, PII_PATTERNS[kind], f"[{kind.upper()}]")

    return reduce(mask, PII_PATTERNS, col(c))


def contains_any(c, needles) -> Column:
    """Case-insensitive: does the text hold any of the needles? An empty list is never held; null in, null out.

    The list is one constant of the plan, whatever its length.
    """
    if not needles:
        return F.when(col(c).isNotNull(), F.lit(False))
    return F.exists(listed([n.lower() for n in needles]), lambda n: F.contains(F.lower(col(c)), n)) if len(needles) > FEW else reduce(
        lambda a, b: a | b, [F.contains(F.lower(col(c)), F.lit(n.lower())) for n in needles]
    )


# Up to here a list is tested entry by entry in generated code; longer ones are walked as one constant array.
FEW = 32


def listed(values) -> Column:
    """A list of strings as one constant array."""
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def uses_term(c, lexicon) -> Column:
    """Does the text use a word or a phrase of the lexicon, as whole tokens? An empty lexicon is never used; null in, null out."""
    entries = [tokens_of(w) for w in lexicon]
    words_, phrases = [e[0] for e in entries if len(e) == 1], [" ".join(e) for e in entries if len(e) > 1]
    known = col(c).isNotNull()
    hit = F.lit(False)
    if words_:
        hit = F.arrays_overlap(tokens(c), listed(words_))
    if phrases:
        line = F.concat(F.lit(" "), F.array_join(tokens(c), " "), F.lit(" "))
        hit = hit | F.exists(listed([f" {p} " for p in phrases]), lambda p: F.contains(line, p))
    return F.when(known, hit)


def tokens_of(entry: str) -> list[str]:
    """Tokens of a lexicon entry, by the same rule as `tokens`."""
    return re.findall(r"[^\W_]+", entry.lower())


def quoted(term: str) -> str:
    """A term as a literal part of a regular expression."""
    return re.sub(r"([^\w\s])", r"\\\1", term)


def as_number(c) -> Column:
    """Numeric reading of a scorer value; null when it is not a number."""
    return col(c).try_cast("double")


def yes_no(condition: Column) -> Column:
    """yes / no, null where the condition is null."""
    return F.when(condition, F.lit("yes")).when(~condition, F.lit("no"))


def not_yes(c) -> Column:
    """True unless the value is yes; a missing value counts as not yes."""
    return ~col(c).eqNullSafe(F.lit("yes"))
