"""Exact set-similarity join: which sets of terms have a twin at a Jaccard similarity of a threshold or more.

Terms of a set are sorted by one order, rare ones first. Two sets that share enough terms share one among their first few (the
prefix filter), so each set is filed under those, and only sets that meet under a term, and whose sizes and places in the
order still allow enough shared terms, are compared.

A term that very many sets are filed under is not compared pair by pair. There a set is filed under its next terms as
well, apart for each pair of sizes: by the first, second, ... term that two such sets would share. A file grows narrower
with every step. It ends when it is small, when it holds sets of one of the two sizes only, or when the terms shared are
already enough: then all its pairs are twins, and the least member on either side stands for them.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proofmark.session import written

#: Sets in a file up to which they are compared pair by pair.
MOST = 64
#: Terms that are ordered by how many sets hold them; the others come first, in the order of their hashes. Bounds a broadcast.
FREQUENT = 10_000


def _ratio(threshold: float) -> Fraction:
    if not 0 < threshold <= 1:
        raise ValueError("the threshold lies above 0 and is at most 1")
    return Fraction(str(threshold))


def _up(value: Column, by: int) -> Column:
    """value / by, rounded up, in whole numbers."""
    return F.call_function("div", value + (by - 1), F.lit(by)).cast("int")


def needed(size: Column, other: Column, ratio: Fraction) -> Column:
    """Shared terms from which sets of these sizes reach the threshold."""
    p, q = ratio.numerator, ratio.denominator
    return _up((size + other) * p, p + q)


def rare_first(sets: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """The sets (id, terms) with their terms, each once, in the common order: rare ones first."""
    each = sets.select("id", F.explode(F.array_distinct("terms")).alias("term"))
    common = each.groupBy("term").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "term").limit(frequent)
    placed = each.join(F.broadcast(common), "term", "left").select("id", F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.xxhash64("term").alias("h"), "term").alias("t"))
    return placed.groupBy("id").agg(F.transform(F.sort_array(F.collect_list("t")), lambda t: t["term"]).alias("terms"))


def twins(sets: DataFrame, threshold: float, most: int = MOST) -> DataFrame:
    """(id, first) of the sets that have a twin: another set at the threshold or above; first is its least twin or itself, if less.

    ``sets`` holds (id, terms): different ids for different sets, terms without nulls. Sets without terms have no twin.
    """
    ratio = _ratio(threshold)
    p, q = ratio.numerator, ratio.denominator
    ordered = written(rare_first(sets), "term-sets")

    size = F.size("terms")
    first = F.slice("terms", 1, size - _up(size * p, q) + 1)
    filed = ordered.select("id", size.alias("size"), F.posexplode(first).alias("place", "term"))
    counts = filed.groupBy("term").agg(F.count("*").alias("n"))
    small = filed.join(counts.where((F.col("n") > 1) & (F.col("n") <= most)).select("term"), "term")
    pairs = _met(small, ["term"], ratio, 0)

    crowded = written(filed.join(counts.where(F.col("n") > most).select("term"), "term"), "crowded-terms")
    found, closed = [pairs], []
    if not crowded.isEmpty():
        more, closed = _crowded(crowded, ordered, ratio, most)
        found += more
    candidates = found[0]
    for other in found[1:]:
        candidates = candidates.unionByName(other)
    return _least(candidates, ordered, ratio, closed)


def _met(filed: DataFrame, key: list[str], ratio: Fraction, before: int) -> DataFrame:
    """Pairs (a, b) of ids that meet under a key; `before` terms are known to be shared besides the one at their places."""
    p, q = ratio.numerator, ratio.denominator
    a = filed.select(*key, F.col("id").alias("a"), F.col("size").alias("n"), F.col("place").alias("i"))
    b = filed.select(*key, F.col("id").alias("b"), F.col("size").alias("m"), F.col("place").alias("j"))
    left = F.least(F.col("n") - F.col("i"), F.col("m") - F.col("j")) + before
    long_enough = (F.col("n") * q >= F.col("m") * p) & (F.col("m") * q >= F.col("n") * p)
    return a.join(b, key).where((F.col("a") < F.col("b")) & long_enough & (left >= needed(F.col("n"), F.col("m"), ratio))).select("a", "b")


def _crowded(crowded: DataFrame, ordered: DataFrame, ratio: Fraction, most: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Candidates, and (id, other) twins that need no check, from the files that are too full to compare pairs."""
    p, q = ratio.numerator, ratio.denominator
    sizes = F.sequence(_up(F.col("size") * p, q), F.call_function("div", F.col("size") * q, F.lit(p)).cast("int"))
    rows = crowded.join(ordered, "id").withColumn("other", F.explode(sizes)).select(
        F.least("size", "other").alias("lo"), F.greatest("size", "other").alias("hi"), F.array("term").alias("shared"), "id", "size", "place", "terms",
    )
    key, shared = ["lo", "hi", "shared"], 1
    enough = needed(F.col("lo"), F.col("hi"), ratio)
    rows = rows.where(F.col("place") <= F.col("size") - enough)
    found, closed = [], []
    while True:
        rows = written(rows, f"crowded-{shared}")
        small_side, large_side = F.col("size") == F.col("lo"), F.col("size") == F.col("hi")
        files = rows.groupBy(*key).agg(
            F.count("*").alias("n"), F.min(F.when(small_side, F.col("id"))).alias("least"), F.min(F.when(large_side, F.col("id"))).alias("least_large"),
        ).where((F.col("n") > 1) & F.col("least").isNotNull() & F.col("least_large").isNotNull())
        done = files.where(enough <= shared)
        # All pairs across the two sizes are twins: each side meets the least of the other. Of one size, all meet the least.
        met = rows.join(done.select(*key, "least", "least_large"), key)
        other = F.when(small_side & large_side, F.col("least")).when(small_side, F.col("least_large")).otherwise(F.col("least"))
        closed.append(met.select("id", other.alias("other")))
        going = files.where(enough > shared)
        found.append(_met(rows.join(going.where(F.col("n") <= most).select(*key), key).select(*key, "id", "size", "place"), key, ratio, shared - 1))
        full = going.where(F.col("n") > most).select(*key)
        if full.isEmpty():
            return found, closed
        start, last = F.col("place") + 2, F.col("size") - enough + shared  # 1-based place of the next term, and 0-based last place it can have
        ahead = F.slice("terms", start, F.greatest(last - start + 2, F.lit(0)))
        rows = rows.join(full, key).select(*key, "id", "size", "terms", F.col("place").alias("before"), F.posexplode(ahead).alias("step", "next")).select(
            "lo", "hi", F.concat("shared", F.array("next")).alias("shared"), "id", "size", (F.col("before") + 1 + F.col("step")).alias("place"), "terms",
        )
        shared += 1


def _least(candidates: DataFrame, ordered: DataFrame, ratio: Fraction, closed: list[DataFrame]) -> DataFrame:
    """Check the candidates, and give every set that has a twin the least of itself and its twins."""
    sides = candidates.distinct().join(ordered.select(F.col("id").alias("a"), F.col("terms").alias("x")), "a")
    sides = sides.join(ordered.select(F.col("id").alias("b"), F.col("terms").alias("y")), "b")
    true = sides.where(F.size(F.array_intersect("x", "y")) >= needed(F.size("x"), F.size("y"), ratio))
    # The greater of two twins has the lesser; the lesser only has to know that it has one.
    links = true.select(F.inline(F.array(F.struct(F.col("b").alias("id"), F.col("a").alias("first")), F.struct(F.col("a").alias("id"), F.col("a").alias("first")))))
    for pairs in closed:
        # A least member of one size is its own `other`; the rest of its file, two sets or more, are its twins.
        links = links.unionByName(pairs.select("id", F.least("id", "other").alias("first")))
    return links.groupBy("id").agg(F.min("first").alias("first"))
