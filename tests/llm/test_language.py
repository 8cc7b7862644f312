"""Character models: probabilities, held-out accuracy, and awkward rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from proofmark.llm import language, queries
from proofmark.llm.common import prepare
from tests.llm import data


def labelled(spark, n=60):
    texts = [" ".join(["the house and that tree", "der baum und das haus nicht"][i % 2].split()[(i // 2 + k) % 5] for k in range(30)) for i in range(n)]
    rows = [(i, t, ["en", "de"][i % 2]) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_grams_stay_inside_words():
    grams, sizes = language.grams_of(["ab", "c"])
    text = ["".join(chr(int(g) >> s & 0xFFFF) for s in (48, 32, 16, 0)) for g in grams]
    assert text == ["   a", "  ab", " ab ", "   c", "  c "] and sizes.tolist() == [3, 2]


def test_probabilities_of_a_context_sum_to_one(spark):
    prepare(spark)
    models = language.fit(labelled(spark), F.lit(True), "text", "lang")
    alphabet = sorted({c for r in labelled(spark).collect() for c in r.text} | {" "})
    for before in ("   ", "  t", "hau", "nic", "xyz"):
        grams = np.array([sum(ord(c) << s for c, s in zip(before + c, (48, 32, 16, 0))) for c in alphabet], dtype=np.uint64)
        p = np.exp2(-models.costs(grams).astype(float)).sum(axis=0)
        # The rest is what characters never seen anywhere share.
        assert (p <= 1 + 1e-3).all() and (p > 0.6).all()


def test_kneser_ney_by_hand(spark):
    """Unigram level: a character's share is by how many characters stand before it, not by how often it occurs."""
    docs = spark.createDataFrame([("aaaa aaaa", "x"), ("ba ca", "x"), ("b", "y")], "text string, lang string")
    grams = language.gram_counts(docs.select(F.col("text").cast("binary").alias("body"), "lang"))
    assert {r.n for r in grams.where("lang = 'y'").collect()} == {1}
    models = language.Models(language._tables(grams).toArrow())
    _, total, types = models.parts["x", "before", 1]
    assert total.tolist() == [sum(models.parts["x", "gram", 1][1])] and types.tolist() == [4]  # a b c and the space


def test_awkward_rows(spark):
    models = language.fit(labelled(spark), F.lit(True), "text", "lang")
    rows = language.identify(data.awkward(spark), models).collect()
    assert len(rows) == len(data.AWKWARD) + 2
    for r in rows:
        text = "text of no id" if r.doc_id is None else data.AWKWARD[r.doc_id]
        if text and any(map(str.isalpha, text)):
            assert r.lang_pred in ("en", "de") and 0.5 <= r.score <= 1
        else:
            assert (r.lang_pred, r.score, r.accepted) == ("und", 0.0, False)
    for text, lang in (("1 ² ½ !?", "und"), ("das haus", "de"), ("THE TREE", "en")):
        assert language.identify(data.docs_of(spark, [text]), models).first().lang_pred == lang
    assert language.identify(data.empty(spark), models).count() == 0


def test_nothing_learned(spark):
    for docs, train in ((labelled(spark), F.lit(False)), (labelled(spark).withColumn("lang", F.lit(None).cast("string")), F.lit(True)), (data.empty(spark), F.lit(True))):
        models = language.fit(docs, train, "text", "lang")
        assert [r.lang_pred for r in language.identify(data.docs_of(spark, ["the tree"]), models).collect()] == ["und"]
    one = language.fit(labelled(spark).where("lang = 'de'"), F.lit(True), "text", "lang")
    assert language.identify(data.docs_of(spark, ["the tree"]), one).first()[1:3] == ("de", 1.0)


def by_brute_force(rates, right, langs):
    """Temperature and rejection limit from all rows, sorted in one place."""
    def p(t):
        e = np.exp(-rates * t - (-rates * t).max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    places = np.arange(len(right))
    t = min(np.geomspace(0.25, 64, 17), key=lambda t: -np.log(np.maximum(p(t)[places, right], 1e-12)).sum())
    best, ok = p(t).max(axis=1), p(t).argmax(axis=1) == right
    fine = [s for s in set(best) if ok[best >= s].mean() >= language.PRECISION]
    return t, 1.0 if not fine else 1 / langs if min(fine) == best.min() else min(fine)


def test_every_training_document_calibrates(spark):
    rng = np.random.default_rng(4)
    right = rng.integers(0, 2, 9000)
    rates = rng.normal(6, 1, (9000, 2))
    rates[np.arange(9000), right] -= rng.gamma(2, 1, 9000)
    rates[:500] = rates[500:1000]  # ties
    rows = [(["de", "en"][k], [10 * x for x in r.tolist()], 10.0) for k, r in zip(right, rates)]
    known = spark.createDataFrame(rows, "lang string, costs array<double>, length double").repartition(5)
    models = language.Models(language._tables(language.gram_counts(labelled(spark).select(F.col("text").cast("binary").alias("body"), "lang"))).toArrow())
    language._calibrate(models, known)
    t, least = by_brute_force(rates, right, 2)
    assert models.temperature == t and 0.5 < least < 1 and abs(models.least - least) < 1e-9


def test_the_limit_of_a_fit_is_that_of_all_its_documents(spark):
    prepare(spark)
    rng = np.random.default_rng(5)
    words = ["the house and that tree was here".split(), "der baum und das haus war hier".split()]
    rows = [(i, " ".join(words[int(rng.random() < (0.3, 0.7)[i % 2])][rng.integers(7)] for _ in range(5)), ["en", "de"][i % 2]) for i in range(9000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    models = language.fit(docs, F.lit(True), "text", "lang")
    scored = language.score_rows(docs.select(F.col("doc_id").alias("id"), F.col("text").cast("binary").alias("body")), models).collect()
    rates = np.array([r.costs for r in scored]) / np.array([[r.length] for r in scored])
    t, least = by_brute_force(rates, np.array([1 - r.id % 2 for r in scored]), 2)
    assert models.temperature == t and abs(models.least - least) < 1e-9
    # Scores that a fit made of all rows are those that the model makes.
    again, kept = language.fit_scored(docs, F.lit(True), "doc_id", "text", "lang")
    assert sorted(map(tuple, language.identify(docs, again, scored=kept).collect())) == sorted(map(tuple, language.identify(docs, models).collect()))


def test_held_out_accuracy(spark, sf_dir):
    langs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = queries.QUERIES["op3_language_id"](spark, sf_dir).join(langs, "doc_id").collect()
    held = [r for r in rows if r.held_out and r.lang_pred != "und"]
    assert len(rows) == langs.count() and len(held) > 20
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.97
