"""The set-similarity join against all pairs."""

from __future__ import annotations

import random
from fractions import Fraction

import pytest

from proofmark.operators import datasets, similarity


def brute(sets, threshold):
    ratio, found = Fraction(str(threshold)), {}
    for a, x in sets.items():
        alike = [b for b, y in sets.items() if a != b and x & y and Fraction(len(x & y), len(x | y)) >= ratio]
        if alike:
            found[a] = min([a, *alike])
    return found


def random_sets(rng, n, vocabulary, largest):
    """Different sets, many of them close to one another."""
    made = set()
    pool = [f"t{i}" for i in range(vocabulary)]
    while len(made) < n:
        base = rng.sample(pool, rng.randint(1, largest))
        for _ in range(rng.randint(1, 6)):
            made.add(frozenset(base))
            base = [t for t in base if rng.random() < 0.93] + ([rng.choice(pool)] if rng.random() < 0.5 else [])
            base = base or [rng.choice(pool)]
    return {f"{i:05d}": s for i, s in enumerate(sorted(made, key=sorted))}


def answer(spark, sets, threshold, most):
    rows = [(k, sorted(v)) for k, v in sets.items()]
    random.Random(1).shuffle(rows)
    return {r.id: r["first"] for r in similarity.twins(spark.createDataFrame(rows, "id string, terms array<string>"), threshold, most).collect()}


@pytest.mark.parametrize("threshold, most, vocabulary, largest", [(0.8, 64, 200, 14), (0.8, 2, 14, 11), (0.5, 3, 12, 7), (0.65, 4, 30, 20), (1.0, 2, 10, 6)])
def test_twins_equal_all_pairs(spark, threshold, most, vocabulary, largest):
    sets = random_sets(random.Random(vocabulary), 150, vocabulary, largest)
    want = brute(sets, threshold)
    assert answer(spark, sets, threshold, most) == want and (want or threshold == 1.0)


def test_many_variants_of_one_template(spark):
    """Nine shared words and one that varies: all are twins of one another, and no pair of them is made."""
    words = [f"word{i}" for i in range(9)]
    sets = {f"{i:04d}": frozenset([*words, f"only{i}"]) for i in range(1500)}
    assert answer(spark, sets, 0.8, 64) == {k: "0000" for k in sets}


def test_sets_of_one_size_that_only_a_smaller_one_joins(spark):
    """Four words and a fifth that varies: twins of the four words alone, not of one another."""
    words = ["a", "b", "c", "d"]
    sets = {f"{i:04d}": frozenset([*words, f"only{i}"]) for i in range(300)}
    assert answer(spark, sets, 0.8, 16) == {}
    sets["9999"] = frozenset(words)
    assert answer(spark, sets, 0.8, 16) == {**{k: k for k in sets}, "9999": "0000"}


def test_pairs_grow_with_the_rows(spark, monkeypatch):
    met = {}
    plain = similarity._met

    def counted(*given):
        pairs = plain(*given)
        met[n] = met.get(n, 0) + pairs.count()
        return pairs

    monkeypatch.setattr(similarity, "_met", counted)
    for n in (300, 3000):
        rng = random.Random(n)
        common = [f"c{i}" for i in range(20)]
        sets = {f"{i:05d}": frozenset(rng.sample(common, 4) + [f"r{rng.randrange(n // 2)}" for _ in range(4)]) for i in range(n)}
        answer(spark, sets, 0.8, 64)
    assert met[3000] < 15 * max(met[300], 20)


@pytest.mark.parametrize("threshold", [0, 1.5, -1])
def test_refuses(spark, threshold):
    with pytest.raises(ValueError):
        similarity.twins(spark.createDataFrame([], "id string, terms array<string>"), threshold)


def test_questions(spark):
    rows = [("1", "How does alpha beta gamma delta work"), ("2", "how does GAMMA beta delta alpha work?"), ("3", "Why does alpha beta gamma delta work"),
            ("4", "How does alpha beta epsilon zeta work"), ("5", "entirely other words here"), ("6", None), ("7", ""), ("6", None), (None, "nobody asks this question")]
    df = spark.createDataFrame(rows, "record_id string, question string")
    got = [(r.record_id, r.class_id, r.n_same, r.reworded, r.first_like) for r in datasets.question_diversity(df, 0.7).collect()]
    assert sorted(got, key=str) == sorted([
        ("1", "1", 2, "yes", "1"), ("2", "1", 2, "yes", "1"), ("3", "3", 1, "yes", "1"), ("4", "4", 1, "no", "4"), ("5", "5", 1, "no", "5"),
        ("6", "6", 3, "no", "6"), ("6", "6", 3, "no", "6"), ("7", "6", 3, "no", "6"), (None, None, 1, "no", None),
    ], key=str)
    assert datasets.question_diversity(df.limit(0)).count() == 0
