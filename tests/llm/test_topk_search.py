"""Bit-sliced top-k search against plain sums."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from proofmark.llm import queries, topk_search
from proofmark.llm.common import prepare
from tests import compare

SCHEMA = "vec_id long, embedding array<float>, label int, id string, q string, rows string, body string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "x", "x", "x") for i, v in rows], SCHEMA)


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def brute(queries_, rows, k):
    held = [(i, [math.floor(1024 * x) for x in np.array(v, dtype=np.float32).astype(float)]) for i, v in rows if usable(v)]
    found = []
    for i, v in queries_:
        if usable(v):
            v = [math.floor(1024 * x) for x in np.array(v, dtype=np.float32).astype(float)]
            scored = sorted(((-sum(a * b for a, b in zip(v, w)), j is None, j or 0) for j, w in held if i is None or j != i))
            found += [(i, n + 1, None if gone else j, -s) for n, (s, gone, j) in enumerate(scored[:k])]
    return sorted(found, key=repr)


def answer(spark, queries_, rows, k, **sizes):
    got = topk_search.top_k(frame(spark, queries_), topk_search.index(frame(spark, rows), **sizes), k)
    return sorted(map(tuple, got.collect()), key=repr)


@pytest.mark.parametrize("seed", range(20))
def test_block_selects_as_plain_sums_do(seed):
    rng = np.random.default_rng(seed)
    rows, dims, k = int(rng.integers(1, 400)), int(rng.integers(0, 9)), int(rng.integers(1, 30))
    reach = int(rng.choice([1, 3, 700, 2**20]))
    vectors = rng.integers(-reach, reach + 1, (rows, dims))
    ids, known = rng.permutation(rows), rng.random(rows) < 0.95
    block = topk_search.Block(ids, known, vectors)
    for own in (None, int(ids[0])):
        query = rng.integers(-reach, reach + 1, dims)
        found, scores = topk_search.search(block, block.both(), block.all_rows(), own, query, k)
        want = vectors @ query
        order = sorted((r for r in range(rows) if own is None or not (known[r] and ids[r] == own)), key=lambda r: (-want[r], not known[r], ids[r]))
        assert sorted(found.tolist()) == sorted(order[:k]) and scores.tolist() == want[found].tolist()


def test_awkward_rows(spark):
    prepare(spark)
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(50)]
    rows += [(50, None), (51, [None, 1.0]), (52, [float("nan")] * 6), (53, [float("inf")] * 6), (54, []), (55, [0.5, -0.25]), (None, [0.1] * 6), (3, rows[4][1]), rows[7], rows[7]]
    rows += [(i, rows[0][1]) for i in range(100, 130)]  # copies tie
    asked = [*rows[:8], *rows[50:60], rows[70]]
    for k in (1, 10, 1000):
        assert answer(spark, asked, rows, k, block_rows=16) == brute(asked, rows, k)
    assert answer(spark, asked, [], 5) == [] and answer(spark, [], rows, 5) == []
    assert answer(spark, asked, rows[50:52], 5) == []


def test_queries_in_many_rounds(spark, monkeypatch):
    prepare(spark)
    monkeypatch.setattr(topk_search, "PART_BYTES", 500)
    monkeypatch.setattr(topk_search, "PARTS", 2)
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(60)]
    assert answer(spark, rows, rows, 3, block_rows=25) == brute(rows, rows, 3)


def test_sums_beyond_64_bits_are_refused(spark):
    prepare(spark)
    rows = [(0, [3e12] * 4), (1, [3e12] * 4)]
    with pytest.raises(Exception, match="do not fit"):
        answer(spark, rows, rows, 1)


def test_query_equals_sql(spark, sf_dir):
    got = compare.spark_rows(queries.QUERIES["op13_topk_search"](spark, sf_dir))
    assert compare.difference(got, compare.sql_rows(compare.connect(sf_dir), queries.ORACLES["op13_topk_search"])) is None
