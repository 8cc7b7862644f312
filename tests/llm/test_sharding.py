"""Placement on shards against a plain version."""

from __future__ import annotations

from collections import Counter

import pytest
import xxhash

from proofmark.llm import queries, sharding
from tests import compare
from tests.llm import data

NAMES = [f"n{i}" for i in range(7)]


def test_every_slot_is_filled_and_shares_are_even():
    table = sharding.lookup_table(NAMES, 211)
    assert len(table) == 211 and set(Counter(table).values()) <= {30, 31}
    assert sharding.lookup_table(["one"], 2) == [0, 0]


def plain_table(names, slots):
    """Turn by turn over whole lists of preferences, as the rule is told."""
    wishes = []
    for name in names:
        offset, skip = xxhash.xxh64(name, seed=1).intdigest() % slots, 1 + xxhash.xxh64(name, seed=2).intdigest() % (slots - 1)
        wishes.append([(offset + j * skip) % slots for j in range(slots)])
    owner = {}
    while len(owner) < slots:
        for k, wish in enumerate(wishes):
            free = [x for x in wish if x not in owner]
            if free:
                owner[free[0]] = k
    return [owner[x] for x in range(slots)]


@pytest.mark.parametrize("names, slots", [(NAMES, 211), (["one"], 2), (NAMES[:3], 101), ([f"shard-{i:03d}" for i in range(40)], 83)])
def test_table_equals_a_plain_fill(names, slots):
    assert sharding.lookup_table(names, slots) == plain_table(names, slots)


def test_a_shard_that_goes_moves_few_other_keys():
    before, after = sharding.lookup_table(NAMES, 1009), sharding.lookup_table(NAMES[:-1], 1009)
    moved = sum(a != b for a, b in zip(before, after) if a != 6)
    assert moved / 1009 < 0.2


@pytest.mark.parametrize("names, slots", [([], 7), (["a", "a"], 7), (["a", "b", "c"], 2), (["a"], 9)])
def test_refuses(names, slots):
    with pytest.raises(ValueError):
        sharding.lookup_table(names, slots)


def test_awkward_rows(spark):
    rows = sharding.place(data.awkward(spark), NAMES, slots=211).collect()
    assert len(rows) == len(data.AWKWARD) + 2 and all(r.shard in NAMES for r in rows)
    assert len({r.shard for r in rows if r.doc_id == 9}) == 1
    assert sharding.place(data.empty(spark), NAMES).count() == 0


def test_query_equals_sql(spark, sf_dir):
    got = compare.spark_rows(queries.QUERIES["op2_sharding"](spark, sf_dir))
    assert compare.difference(got, compare.sql_rows(compare.connect(sf_dir), queries.ORACLES["op2_sharding"])) is None
