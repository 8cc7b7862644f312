"""One key holding most rows: results stay whole, and no group is collected without a bound."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from proofmark.functions.ordered import with_position, with_previous
from proofmark.operators import harness, ranking, retrieval, scorers
from proofmark.sources import tables


@pytest.fixture(scope="module")
def busy_log(spark):
    """Two thirds of the requests come from one user; some share a millisecond."""
    rng = random.Random(3)
    rows = [(str(i), "hot" if i % 3 else f"u{i % 7}", rng.randrange(0, 60_000)) for i in range(1500)]
    return rows, spark.createDataFrame(rows, "request_id string, user_id string, timestamp_ms bigint")


@pytest.mark.parametrize("limit, seconds", [(0, 1), (20, 1), (100, 7), (900, 60)])
def test_rate_limit_equals_brute_force(busy_log, limit, seconds):
    rows, log = busy_log
    want = {}
    for rid, user, at in rows:
        n = sum(1 for _, u, t in rows if u == user and at - seconds * 1000 <= t <= at)
        if n > limit:
            want[rid] = n
    assert {r.request_id: r.n_recent for r in ranking.rate_limit(log, limit, seconds).collect()} == want


def test_positions_and_previous_rows_across_buckets(spark):
    rng = random.Random(5)
    rows = [(k, o) for k in ("hot", "b", "c") for o in sorted(rng.sample(range(5000), 900 if k == "hot" else 3))]
    df = spark.createDataFrame(rows, "k string, o bigint").repartition(5)
    bucket = F.floor(F.col("o") / 64)
    place = {(r.k, r.o): r.position for r in with_position(df, ["k"], ["o"], bucket).collect()}
    before = {(r.k, r.o): r.prev_o for r in with_previous(df, ["k"], ["o"], bucket, ["o"]).collect()}
    for key in ("hot", "b", "c"):
        mine = [o for k, o in rows if k == key]
        assert [place[key, o] for o in mine] == list(range(len(mine)))
        assert [before[key, o] for o in mine] == [None, *mine[:-1]]


def test_long_conversation_pairs_and_history(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"m{t}") for t in range(2500)] + [(2, 0, "system", "s"), (2, 1, "assistant", "x")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    pairs = {r.turn: (r.question, r.answer) for r in tables.turn_pairs(df).collect()}
    assert pairs == {t: (f"m{t - 1}", f"m{t}") for t in range(1, 2500, 2)}
    history = harness.chat_history(df).orderBy("conv_id", "position").collect()
    assert [(r.conv_id, r.position, r.content) for r in history] == [(1, t, f"m{t}") for t in range(2500)] + [(2, 0, "s"), (2, 1, "x")]
    # Turn numbers may leave gaps: what counts is the order.
    gaps = spark.createDataFrame([(1, 0, "user", "q"), (1, 2, "assistant", "a"), (1, 999, "user", "r"), (1, 5000, "assistant", "b")], df.schema)
    assert sorted((r.turn, r.question, r.answer) for r in tables.turn_pairs(gaps).collect()) == [(2, "q", "a"), (5000, "r", "b")]


def test_a_long_trajectory_has_one_verdict(spark):
    rows = [("t", f"{i:05d}", "TOOL", f"tool{i % 3}", i * 1000) for i in range(2300)] + [("u", "1", "TOOL", "a", 5), ("u", "0", "TOOL", "b", 5), ("u", "2", "LLM", "z", 1)]
    df = spark.createDataFrame(rows, "trace_id string, span_id string, span_type string, tool string, start_time_ns bigint")
    path = [f"tool{i % 3}" for i in range(2300)]
    got = scorers.trajectory(df).orderBy("trace_id", "position").collect()
    assert [(r.trace_id, r.position, r.tool) for r in got] == [("t", i, p) for i, p in enumerate(path)] + [("u", 0, "b"), ("u", 1, "a")]
    verdict = lambda expected: {r.trace_id: r.value for r in scorers.score_trajectory(df, expected).collect()}
    assert verdict(path) == {"t": "yes", "u": "no"} and verdict(path[:1000]) == {"t": "no", "u": "no"} and verdict(["b", "a"]) == {"t": "no", "u": "yes"}


def vectors(spark, matrix, key):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(matrix)]
    return spark.createDataFrame(rows, f"{key} bigint, embedding array<float>")


def brute_force(queries, index, k, skip_self=False):
    q = np.asarray(queries, np.float32).astype(float)
    v = np.asarray(index, np.float32).astype(float)
    scores = np.round((q / np.linalg.norm(q, axis=1, keepdims=True)) @ (v / np.linalg.norm(v, axis=1, keepdims=True)).T, 9)
    out = set()
    for i, row in enumerate(scores):
        ids = [j for j in np.lexsort((np.arange(len(row)), -row)) if not (skip_self and i == j)][:k]
        out |= {(i, int(j), rank) for rank, j in enumerate(ids, 1)}
    return out


@pytest.fixture(scope="module")
def copies():
    """A third of the index are copies of one vector."""
    rng = np.random.default_rng(1)
    matrix = rng.standard_normal((300, 16))
    matrix[::3] = matrix[0]
    return matrix


def found(df):
    return {(r.query_id, r.vec_id, r.rank) for r in df.collect()}


@pytest.mark.parametrize("skip_self", [False, True])
def test_exact_neighbours_whatever_the_blocks(spark, copies, skip_self):
    queries, index = vectors(spark, copies, "query_id"), vectors(spark, copies, "vec_id").repartition(4)
    want = brute_force(copies, copies, 3, skip_self)
    assert found(retrieval.vector_topk(queries, index, 3, 16, skip_self)) == want
    assert found(retrieval.vector_topk(queries, index, 3, 16, skip_self, block_rows=37)) == want


def test_room_of_a_block_does_not_follow_its_rows():
    rng = np.random.default_rng(2)
    matrix = rng.standard_normal((retrieval.BLOCK_ROWS, 16))
    matrix[::3] = matrix[0]
    unit, ids = retrieval._unit(matrix), np.arange(len(matrix))
    tracemalloc.start()
    q, v, s = retrieval._best(ids[:300], unit[:300], ids, unit, 3, False)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert set(zip(q.tolist(), v.tolist())) == {w[:2] for w in brute_force(unit[:300], unit, 3)} and len(q) == 900
    assert peak < 40 << 20


def frame_of(spark, matrix, key):
    """A larger matrix as a table, without a Python row each."""
    flat = matrix.astype(np.float32)
    lists = pa.ListArray.from_arrays(np.arange(0, flat.size + 1, flat.shape[1], dtype=np.int32), flat.ravel())
    return spark.createDataFrame(pa.table({key: np.arange(len(matrix)), "embedding": lists})).repartition(8)


def drawn(kind, n, dim=64):
    rng = np.random.default_rng(n)
    matrix = rng.standard_normal((n, dim))
    if kind == "clustered":
        matrix = rng.standard_normal((n // 100, dim))[rng.integers(0, n // 100, n)] + 0.3 * matrix
    return matrix


@pytest.mark.parametrize("kind", ["random", "clustered"])
@pytest.mark.parametrize("n", [2_000, 16_384, 65_536])
def test_probed_cells_hold_nine_of_ten_neighbours(spark, kind, n):
    matrix = drawn(kind, n)
    file = retrieval.inverted_file(frame_of(spark, matrix, "vec_id"))
    assert file.filed.count() == n
    asked = np.random.default_rng(1).choice(n, 300, replace=False)
    queries = frame_of(spark, matrix, "query_id").where(F.col("query_id").isin([int(i) for i in asked]))
    got = {(r.query_id, r.vec_id) for r in retrieval.vector_topk_approx(queries, file, 3, skip_self=True).collect()}
    unit = matrix.astype(np.float32).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    want = set()
    for i in asked:
        scores = unit @ unit[i]
        scores[i] = -9
        want |= {(int(i), int(j)) for j in np.argsort(-scores)[:3]}
    assert len(got) == 900 and len(got & want) >= 0.9 * 900
    if kind == "clustered":  # a small share of the cells, and so of the vectors, is enough
        assert file.probes <= max(4, 0.1 * len(file.centroids))


def test_probed_neighbours_of_copies_and_odd_rows(spark, copies):
    queries, index = vectors(spark, copies, "query_id"), vectors(spark, copies, "vec_id")
    odd = spark.createDataFrame([(1000, None), (1001, [0.0] * 16)], "vec_id bigint, embedding array<float>")
    file = retrieval.inverted_file(index.unionByName(odd))
    assert file.filed.count() == 301
    got = found(retrieval.vector_topk_approx(queries.unionByName(odd.withColumnRenamed("vec_id", "query_id").where("query_id = 1000")), file, 3))
    want = brute_force(copies, copies, 3)
    assert len({w[:2] for w in got} & {w[:2] for w in want}) >= 0.9 * len(want)
    every = retrieval.InvertedFile(file.filed, file.centroids, len(file.centroids))
    assert found(retrieval.vector_topk_approx(queries, every, 3)) == want
    none = retrieval.inverted_file(index.limit(0))
    assert retrieval.vector_topk_approx(queries, none, 3).count() == 0 and retrieval.vector_topk_approx(queries.limit(0), file, 3).count() == 0


def test_queries_in_rounds(spark, copies, monkeypatch):
    queries, index = vectors(spark, copies, "query_id"), vectors(spark, copies, "vec_id")
    file = retrieval.inverted_file(index)
    whole = found(retrieval.vector_topk_approx(queries, file, 3))
    monkeypatch.setattr(retrieval, "ROUND_QUERIES", 70)
    assert found(retrieval.vector_topk_approx(queries, file, 3)) == whole


def test_no_neighbours_without_queries(spark, copies):
    index = vectors(spark, copies, "vec_id")
    none = vectors(spark, copies, "query_id").where("query_id < 0")
    assert retrieval.vector_topk(none, index, 3, 16).count() == 0
