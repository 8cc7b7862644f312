"""Periodic runs against a version that tries every period."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from proofmark.llm import periodic_runs, queries
from proofmark.llm.common import prepare
from tests.llm import data


def brute_runs(words):
    """Every period, smallest first; a stretch whose period is a multiple of a smaller one's has that one."""
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    w = np.array([number[x] for x in words], dtype=np.int64)
    found = []
    for q in range(1, len(w) // 4 + 1):
        edges = np.flatnonzero(np.diff(np.concatenate(([0], (w[:-q] == w[q:]).astype(np.int8), [0]))))
        for start, stop in zip(edges[::2].tolist(), (edges[1::2] + q).tolist()):
            if stop - start >= max(6, 4 * q):
                part = w[start:stop]
                if not any(np.array_equal(part[:-r], part[r:]) for r in range(1, q)):
                    found.append((start, stop - start, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_collapsed(words, runs):
    return [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs)]


def brute_repeats(words, doc_id):
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def found_in(texts, **given):
    return [[tuple(map(int, r)) for r in runs] for runs in periodic_runs.runs_of([np.array(t, dtype=np.int64) for t in texts], **given)]


@pytest.mark.parametrize("seed", range(60))
def test_runs_of_random_texts(seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(4):
        kinds, text, size = rng.choice([1, 2, 2, 3, 5, 50]), [], rng.randint(0, 500)
        while len(text) < size:
            part = [rng.randrange(kinds) for _ in range(rng.randint(1, 30))]
            text += part if rng.random() < 0.5 else (part * rng.randint(2, 9))[: rng.randint(1, 200)]
            if rng.random() < 0.2:
                text = (text * rng.randint(1, 5))[:900]
        texts.append(text)
    assert found_in(texts, together=rng.choice([100, 1 << 20])) == [brute_runs(t) for t in texts]


@pytest.mark.parametrize("period", [1, 2, 3, 4, 5, 7, 8, 15, 16, 17, 31, 63, 64, 100])
def test_every_period_at_the_least_length(period):
    rng = random.Random(period)
    part = list(range(100, 100 + period))
    for size in (4 * period - 1, 4 * period, 4 * period + 1, 6):
        text = [rng.randrange(50) for _ in range(37)] + (part * 8)[:size] + [rng.randrange(50) for _ in range(41)]
        assert found_in([text, text[::-1]]) == [brute_runs(text), brute_runs(text[::-1])]


def test_small_periods_inside_large_ones():
    """A period of 40 words, nearly all of them the same word: the sets leave out what repeats at once."""
    part = [1] * 38 + [2, 3]
    text = [9, 8, *(part * 6)[:217], 7]
    assert found_in([text]) == [brute_runs(text)]
    word = [0]
    for _ in range(11):  # a word without cubes has no run
        word = [x for w in word for x in ((0, 1) if w == 0 else (1, 0))]
    assert found_in([word]) == [[]]


def test_texts_do_not_run_into_each_other():
    assert found_in([[1, 1, 1], [1, 1, 1], [2, 1] * 4, [2, 1] * 2]) == [[], [], [(0, 8, 2)], []]


def test_awkward_rows(spark):
    prepare(spark)
    rows = periodic_runs.find_runs(data.awkward(spark)).collect()
    assert len(rows) == len(data.AWKWARD) + 2
    found = {r.doc_id: r for r in rows}
    for i, text in enumerate(data.AWKWARD):
        words = (text or "").encode().split()
        runs = brute_runs(words)
        assert [tuple(r) for r in found[i].runs] == runs and found[i].n_words == len(words)
        assert found[i].collapsed == b" ".join(brute_collapsed(words, runs)).decode()
    assert found[None].collapsed == "text of no id"
    assert periodic_runs.find_runs(data.empty(spark)).count() == 0
    repeated = {r.doc_id: r.text for r in periodic_runs.with_repeats(data.awkward(spark)).collect()}
    for i, text in enumerate(data.AWKWARD):
        words = (text or "").encode().split()
        assert (repeated[i] or "").encode().split() == brute_repeats(words, i)
    assert periodic_runs.with_repeats(data.empty(spark)).count() == 0


def test_a_very_long_repetition_is_whole(spark):
    prepare(spark)
    text = " ".join(["lead"] + [f"w{i % 30_000}" for i in range(200_000)] + ["tail"])
    row = periodic_runs.find_runs(data.docs_of(spark, [text])).collect()[0]
    assert [tuple(r) for r in row.runs] == [(1, 200_000, 30_000)] and len(row.collapsed.split()) == 30_002


def test_query_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    rows = {r.doc_id: r for r in queries.QUERIES["op11_periodic_runs"](spark, sf_dir).collect()}
    assert len(rows) == len(docs) and sum(r.n_runs > 0 for r in rows.values()) > 5
    for doc in docs:
        words = brute_repeats((doc.text or "").encode().split(), doc.doc_id)
        runs = brute_runs(words)
        row = rows[doc.doc_id]
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        assert row.n_runs == len(runs)
        assert (row.start, row.length, row.period) == (best or (None,) * 3)
        assert row.exponent_milli == (best and 1000 * best[1] // best[2])
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert row.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(b" ".join(brute_collapsed(words, runs))).hexdigest()
