"""Importance resampling: the ratio, the limit, the k-th largest key, and what is kept."""

from __future__ import annotations

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from proofmark.llm import importance, queries
from proofmark.llm.common import prepare
from tests.llm import data


def corpus(spark, n=240):
    texts, labels = [], []
    for i in range(n):
        text = data.words(80, i)
        kind = i % 6
        if kind == 4:
            text = text.replace(" ", "%%% ").replace("s", "s###")
        if kind == 5:
            text = text[:200] + " you nastyfool " + text[200:] + " nastyfool"
        texts.append(text)
        if i % 2 == 0 or kind == 5:
            labels.append((i, int(kind != 4), int(kind == 5), "x"))
    return data.docs_of(spark, texts), spark.createDataFrame(labels, "doc_id long, quality int, toxic int, key string")


def test_rejects_what_the_target_never_holds(spark):
    prepare(spark)
    docs, labels = corpus(spark)
    rows = importance.classify(docs, labels).collect()
    assert len(rows) == 240 and all(r.kept == (r.doc_id % 6 < 4) for r in rows)
    out = importance.filtered(docs, labels)
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == [i for i in range(240) if i % 6 < 4]


def test_ratio_equals_counts_by_hand(spark):
    docs, labels = corpus(spark, 24)
    classifier = importance.fit(docs, labels)
    target, raw = Counter(), Counter()
    good = {r.doc_id: r.quality == 1 and r.toxic == 0 for r in labels.collect()}
    for r in docs.collect():
        for word in importance._TOKEN.findall(r.text.lower()):
            padded = "  " + word + "  "
            grams = [padded[i : i + 5] for i in range(len(word))]
            raw.update(grams)
            if good.get(r.doc_id):
                target.update(grams)
    slots = 1 << importance.BUCKET_BITS
    own = importance.Weigher(classifier.ratio)
    for word in ("nastyfool", "baran", "###"):
        padded = "  " + word + "  "
        want = sum(
            math.log((target[g] + 1) / (sum(target.values()) + slots)) - math.log((raw[g] + 1) / (sum(raw.values()) + slots))
            for g in (padded[i : i + 5] for i in range(len(word)))
        )
        assert own.weight(word.encode()) == pytest.approx(min(0.0, want), abs=1e-3)


def test_words_of_unlabelled_documents_only_are_held_against(spark):
    docs, labels = corpus(spark)
    texts = [data.words(60, 3000 + i) + " vileshout vileshout" for i in range(30)]
    unseen = data.docs_of(spark, texts).withColumn("doc_id", F.col("doc_id") + 5000)
    rows = {r.doc_id: r for r in importance.classify(docs.unionByName(unseen), labels).collect()}
    assert not any(rows[5000 + i].kept for i in range(30))
    assert all(rows[i].kept == (i % 6 < 4) for i in range(240))


def brute(docs, labels):
    """Log weights by plain counting: raw over distinct texts, target over distinct labelled good ones."""
    good = {}
    for i, quality, toxic in labels:
        good[i] = good.get(i, True) and quality == 1 and toxic == 0
    grams = lambda text: Counter(g for w in importance._TOKEN.findall(text.lower()) for g in parts(w))
    parts = lambda w: importance.buckets_of([w])[0].tolist()  # noqa: E731  (grams of one bucket count together)
    target, raw = Counter(), Counter()
    for text in {t for _, t in docs}:
        raw.update(grams(text))
    for text in {t for i, t in docs if good.get(i)}:
        target.update(grams(text))
    slots, all_target, all_raw = 1 << importance.BUCKET_BITS, sum(target.values()), sum(raw.values())
    ratio = lambda g: math.log((target[g] + 1) / (all_target + slots)) - math.log((raw[g] + 1) / (all_raw + slots))
    return {i: min([0.0] + [sum(map(ratio, parts(w))) for w in importance._TOKEN.findall(t.lower())]) for i, t in docs}


def test_whole_query_equals_brute_force(spark):
    """Weights by counting, keys by the stated noise, and the largest keys kept, as many as have a weight above the limit."""
    docs, labels = corpus(spark)
    more = docs.where("doc_id < 12").withColumn("doc_id", F.col("doc_id") + 7000)
    docs = docs.unionByName(more)
    classifier = importance.fit(docs, labels)
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [r[:3] for r in labels.collect()])
    noise = spark.createDataFrame([(i,) for i in want], "doc_id long").select("doc_id", F.xxhash64(F.col("doc_id").cast("string"), F.lit(importance.SEED)).alias("h"))
    uniform = {r.doc_id: (r.h % ((1 << 52) - 1) + 1) / (1 << 52) for r in noise.collect()}
    keys = {i: (w - classifier.limit) * importance.SHARPNESS - math.log(-math.log(uniform[i])) for i, w in want.items()}
    size = sum(w >= classifier.limit for w in want.values())
    kept = set(sorted(keys, key=keys.get, reverse=True)[:size])
    rows = importance.classify(docs, labels).collect()
    assert len(rows) == len(want) and 0 < size < len(want)
    for r in rows:
        assert r.log_weight == pytest.approx(want[r.doc_id], abs=1e-3)
    assert {r.doc_id for r in rows if r.kept} == kept


def test_awkward_rows_and_missing_labels(spark):
    docs, labels = (t.withColumn("doc_id", F.col("doc_id") + 10_000) for t in corpus(spark))
    rows = importance.classify(data.awkward(spark).unionByName(docs), labels.unionByName(labels)).collect()
    assert len(rows) == len(data.AWKWARD) + 2 + 240
    # Texts without words hold nothing against them.
    blank = [r for r in rows if r.doc_id in (0, 1, 2)]
    assert len(blank) == 3 and all(r.kept and r.log_weight == 0 for r in blank)
    none = spark.createDataFrame([], labels.schema)
    nulls = labels.withColumn("quality", F.lit(None).cast("int"))
    for given in (none, nulls, labels.where("quality = 1 AND toxic = 0")):
        assert importance.classify(data.awkward(spark), given).where("kept").count() == len(data.AWKWARD) + 2
    assert importance.classify(data.empty(spark), labels).count() == 0


def test_copies_count_as_one_document(spark):
    docs, labels = corpus(spark, 24)
    more = docs.where("doc_id = 4").select(F.explode(F.sequence(F.lit(1000), F.lit(1200))).alias("new"), *docs.columns).drop("doc_id").withColumnRenamed("new", "doc_id")
    tags = labels.where("doc_id = 4").select(F.explode(F.sequence(F.lit(1000), F.lit(1200))).alias("new"), *labels.columns).drop("doc_id").withColumnRenamed("new", "doc_id")
    plain, copied = importance.fit(docs, labels), importance.fit(docs.unionByName(more.select(docs.columns)), labels.unionByName(tags.select(labels.columns)))
    assert abs(plain.ratio.values - copied.ratio.values).max() < 0.02


@pytest.mark.parametrize("values", [[1.0], [2.0] * 50, [float(i) for i in range(100)], [0.0] * 30 + [5.0] * 30, [1e300, -1e300, 0.0]])
def test_kth_largest(spark, values, monkeypatch):
    monkeypatch.setattr(importance, "_BINS", 8)
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for k in {1, 2, len(values) // 2, len(values)} - {0}:
        if k <= len(values):
            assert importance.kth_largest(df, "v", k) == sorted(values, reverse=True)[k - 1]


def test_sample_size_and_query(spark, sf_dir):
    rows = queries.QUERIES["op9_importance_resampling"](spark, sf_dir).collect()
    keys = sorted((r.sample_key for r in rows if r.kept), reverse=True)
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count() and keys
    assert all(r.sample_key < keys[-1] for r in rows if not r.kept)
