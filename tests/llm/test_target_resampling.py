"""Resampling towards a target against SQL and a plain version."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from proofmark.llm import queries, target_resampling
from proofmark.llm.common import prepare
from tests import compare
from tests.llm import data

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def brute_grams(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return words, [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def brute(docs, target, share=(5, 100), least=20):
    """docs: (id, text) rows. Rows (id, n_features, weight, score, rank)."""
    counts = []
    for texts in ([t for _, t in docs], target):
        table = [0] * 10_000
        for text in texts:
            for gram in brute_grams(text)[1]:
                table[zlib.crc32(gram.encode()) % 10_000] += 1
        counts.append(table)
    (s, t), (all_s, all_t) = counts, map(sum, counts)
    gain = [math.floor(1000 * math.log((b + 1) * (all_s + 10_000) / ((a + 1) * (all_t + 10_000)))) for a, b in zip(s, t)]
    rows, able = [], []
    for key, text in docs:
        words, grams = brute_grams(text)
        weight = sum(gain[zlib.crc32(g.encode()) % 10_000] for g in grams)
        h = int(hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([key, len(grams), weight, score, None])
        if len(words) >= least:
            able.append(rows[-1])
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for rank, row in enumerate(able[: share[0] * len(able) // share[1]]):
        row[4] = rank + 1
    return sorted(map(tuple, rows), key=repr)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_crcs_from_prefixes():
    rng = random.Random(3)
    shift = target_resampling.Shift()
    for size in (0, 1, 2, 3, 50):
        words = [bytes(rng.choices(b"abcdefgh\xc3\xa9", k=rng.choice([1, 3, 9, 200, 300, 5000, 70_000]))) for _ in range(size)]
        for k, found in enumerate(target_resampling.gram_crcs(words, shift)):
            assert found.tolist() == [zlib.crc32(b" ".join(words[i : i + k + 1])) for i in range(size - k)]


def test_awkward_rows(spark):
    prepare(spark)
    texts = [*data.AWKWARD, data.AWKWARD[9], "text of no id"]
    ids = [*range(len(data.AWKWARD)), 9, None]
    target = data.docs_of(spark, [None, "", "same text HERE for the copies", "W" * 1000, "é 中 ßtraße"])
    for share in ((5, 100), (1, 1), (0, 1)):
        got = target_resampling.resample(data.awkward(spark), target, least_words=1, share=share)
        assert rows_of(got) == brute(list(zip(ids, texts)), [r.text for r in target.collect()], share, 1)
    assert target_resampling.resample(data.empty(spark), target).count() == 0
    none = target_resampling.resample(data.awkward(spark), data.empty(spark), least_words=1, share=(1, 2))
    assert rows_of(none) == brute(list(zip(ids, texts)), [], (1, 2), 1)


def test_copies_and_ties_are_ranked_once_each(spark):
    prepare(spark)
    rows = [(i % 40, "all of these have the very same text " * 5) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = target_resampling.resample(docs, docs.limit(1), share=(1, 2))
    drawn = [r for r in got.orderBy("rank").collect() if r["rank"] is not None]
    assert [r["rank"] for r in drawn] == list(range(1, 2001))
    assert [(r.score, -r.doc_id) for r in drawn] == sorted(((r.score, -r.doc_id) for r in drawn), reverse=True)
    assert rows_of(got) == brute(rows, [rows[0][1]], (1, 2))


def test_ranks_over_many_bins(spark):
    rng = np.random.default_rng(4)
    scores = rng.integers(-5000, 5000, 3000)
    rows = spark.createDataFrame([(i, 1, 0, int(s), bool(i % 3)) for i, s in enumerate(scores)], "id long, n_features long, weight long, score long, able boolean").repartition(5)
    got = target_resampling._drawn(rows, F.col("able"), 500).where("rank IS NOT NULL").orderBy("rank").collect()
    want = sorted(((-int(s), i) for i, s in enumerate(scores) if i % 3))[:500]
    assert [(-r.score, r.id) for r in got] == want and [r["rank"] for r in got] == list(range(1, 501))


def test_query_equals_brute_force_and_sql(spark, sf_dir):
    found = queries.QUERIES["op12_target_resampling"](spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    target = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("text").collect()]
    assert rows_of(found) == brute([tuple(r) for r in docs], target)
    got = compare.spark_rows(found)
    assert compare.difference(got, compare.sql_rows(compare.connect(sf_dir), queries.ORACLES["op12_target_resampling"])) is None
