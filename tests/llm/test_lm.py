"""The attention model and the scores of texts."""

from __future__ import annotations

import copy
import itertools
import math
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from proofmark.llm import attention_lm as lm
from proofmark.llm import bpe, lm_scoring, queries
from proofmark.llm.common import prepare
from tests.llm import data


@pytest.fixture(scope="module")
def small():
    rng = np.random.default_rng(0)
    size = 600
    texts = [np.concatenate(([size - 1], rng.zipf(1.5, rng.integers(5, 200)) % (size - 1), [size - 1])).astype(np.int32) for _ in range(60)]
    counts = np.bincount(np.concatenate(texts), minlength=size).astype(float)
    v = lm.Vocabulary(counts, np.arange(size) % 7)
    tables = lm.Counts(v)
    flat = np.concatenate(texts)
    starts = np.zeros(len(flat), dtype=bool)
    starts[np.cumsum([0] + [len(t) for t in texts[:-1]])] = True
    tables.add(flat, starts)
    after, within = tables.tables()
    weights = lm.starting_weights()
    weights["out"] = weights["out"] * 30
    return v, after, within, weights, texts


def test_windows_use_every_place_once():
    for n in (0, 1, 31, 32, 33, 100):
        at = lm.windows(n)[:, lm.CONTEXT :]
        assert sorted(at[at >= 0].tolist()) == list(range(n))


def test_next_id_probabilities_sum_to_one(small):
    v, after, within, weights, texts = small
    model = lm.Model(v, after, within, weights)
    start = texts[0][:40]
    ends = [np.append(start, i).astype(np.int32) for i in range(v.size)]
    base = model.log_probabilities([start])[0]
    assert sum(math.exp(x - base) for x in model.log_probabilities(ends)) == pytest.approx(1, abs=1e-3)


def test_no_place_sees_what_follows_and_batches_change_nothing(small):
    v, after, within, weights, texts = small
    model = lm.Model(v, after, within, weights)
    text = max(texts, key=len)
    steps = np.diff(model.log_probabilities([text[:n] for n in range(1, 80)]))
    changed = text.copy()
    changed[60:] = 5
    assert np.allclose(steps[:58], np.diff(model.log_probabilities([changed[:n] for n in range(1, 80)]))[:58], atol=1e-3)
    alone = [model.log_probabilities([t])[0] for t in texts]
    assert np.allclose(model.log_probabilities(texts, chunk=5), alone, atol=1e-3)
    assert model.log_probabilities([text[:1], text[:0]]) == [0, 0] and model.log_probabilities([]) == []


def test_training_equals_finite_differences(small):
    v, after, _, weights, texts = small
    inputs, targets, _, valid = lm.window_arrays(v, texts[3])
    weights = {k: w.astype(np.float64) for k, w in weights.items()}

    def loss(w):
        t = lm.Trainer(w, v, after.astype(np.float64), rate=0.0)
        return t.step(inputs, targets, valid)

    trainer = lm.Trainer(weights, v, after.astype(np.float64), rate=0.0)
    trainer.step(inputs, targets, valid)
    for name, at in (("out", (3, 5)), ("q", (1, 2)), ("k", (4, 4)), ("v", (0, 7)), ("embed", (int(inputs[0, -1]), 3)), ("bias", (2,))):
        moved = [{k: w.copy() for k, w in weights.items()} for _ in range(2)]
        moved[0][name][at] += 1e-4
        moved[1][name][at] -= 1e-4
        slope = (loss(moved[0]) - loss(moved[1])) / 2e-4
        assert trainer.m[name][at] / 0.1 == pytest.approx(slope, rel=2e-2, abs=1e-5)


def test_training_lowers_the_loss(small):
    v, after, within, weights, texts = small
    first = lm.starting_weights()
    trainer = lm.Trainer(first, v, after)
    assert trainer.run(texts, least=3000) == sum(-(-(len(t) - 1) // lm.STRIDE) for t in texts)
    assert sum(lm.Model(v, after, within, trainer.w).log_probabilities(texts)) > sum(lm.Model(v, after, within, first).log_probabilities(texts))
    assert trainer.run([texts[0][:1]]) == 0


def brute_base(texts, train):
    tokens = {i: [*(t or "").encode().lower().split(), None] for i, t in texts.items()}
    counts = Counter(w for i in train for w in tokens[i])
    n, v = sum(counts.values()), len(counts)
    return {i: (len(ws), sum(counts[w] > 0 for w in ws), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws)) for i, ws in tokens.items()}


def test_rows_of_awkward_tables(spark, monkeypatch):
    prepare(spark)
    monkeypatch.setattr(lm_scoring, "WARM_WINDOWS", 2000)
    monkeypatch.setattr(lm_scoring, "COMMON", 20)
    docs = data.awkward(spark).where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    texts = dict(enumerate(data.AWKWARD))
    for train in (F.col("doc_id") % 2 == 0, F.lit(False)):
        want = brute_base(texts, [i for i in texts if i % 2 == 0] if "%" in str(train) else [])
        model, base, words = lm_scoring.fit(docs, train, queries.RANKS, public_tokenizers.PATTERN)
        rows = lm_scoring.score(data.awkward(spark), model, base, words, queries.RANKS, public_tokenizers.PATTERN).collect()
        assert len(rows) == len(texts) + 2
        for r in rows:
            assert r.score < 0 and math.isfinite(r.score)
            if r.doc_id is not None:
                assert (r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:3] and r.base_score == pytest.approx(want[r.doc_id][3])
    assert lm_scoring.score(data.empty(spark), model, base, words, queries.RANKS, public_tokenizers.PATTERN).count() == 0


def test_words_of_other_spaces_in_any_order():
    """Spaces that do not part words; side by side they may share an id with the space between them."""
    words = [w.encode() for w in ("\xa0", "\xa0\xa0", "\xa0\u2003", "\u2009", "plain")]
    ranks = bpe.read_ranks(queries.RANKS)
    alone = {}
    subwords = lm_scoring.Subwords(ranks, public_tokenizers.PATTERN)
    for w in words:
        alone[w] = subwords.ids(subwords.index([w])).tolist()
        subwords.reset()
    for order in itertools.permutations(words):
        ids, sizes = subwords._encoded(list(order))
        assert ids.tolist() == [i for w in order for i in alone[w]] and sizes.tolist() == [len(alone[w]) for w in order]


def test_query_equals_brute_force(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    held = {i for i in texts if zlib.crc32(str(i).encode()) % 7 == 2}
    want = brute_base(texts, set(texts) - held)
    rows = queries.QUERIES["op1_lm_scoring"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:3] and r.held_out == (r.doc_id in held)
        assert r.base_score == pytest.approx(want[r.doc_id][3]) and r.score < 0


def test_all_texts_rank_ids_and_train(spark, monkeypatch):
    """However many training texts there are against a trainer's share and the warm-up."""
    prepare(spark)
    monkeypatch.setattr(lm_scoring, "WARM", 5)
    monkeypatch.setattr(lm_scoring, "TRAINER_TEXTS", 2)
    seen = []
    monkeypatch.setattr(lm_scoring, "trained", lambda texts, trainers, tok, v, after, weights, *rest: seen.append((texts.count(), trainers)) or weights)
    docs = data.docs_of(spark, [data.words(40, i) for i in range(60)])
    model, _, _ = lm_scoring.fit(docs, F.lit(True), queries.RANKS, public_tokenizers.PATTERN)
    assert seen[-1] == (60, 30)
    tokenizer = lm_scoring.Tokenizer(queries.RANKS, public_tokenizers.PATTERN)
    counts = lm_scoring.rank_counts(lm_scoring._bodies(docs, "text"), tokenizer, model.vocabulary.size)
    top = np.argsort(-counts, kind="stable")[: lm.SINGLES]
    assert sorted(model.vocabulary.class_of[top]) == list(range(lm.SINGLES))


def test_texts_are_encoded_once_and_train_by_their_ids(spark, monkeypatch):
    """Ranks, class counts and training read ids that were written once, not texts."""
    prepare(spark)
    seen, begun = [], lm_scoring.trained
    monkeypatch.setattr(lm_scoring, "trained", lambda texts, *rest: seen.append(texts) or begun(texts, *rest))
    monkeypatch.setattr(lm_scoring, "WARM_WINDOWS", 100)
    bodies = [*data.AWKWARD, "one", data.words(300, 4)]
    docs = data.docs_of(spark, bodies)
    lm_scoring.fit(docs, F.lit(True), queries.RANKS, public_tokenizers.PATTERN)
    subwords = lm_scoring.Subwords(bpe.read_ranks(queries.RANKS), public_tokenizers.PATTERN)
    want = sorted(lm_scoring.whole_text(subwords, (t or "").encode()).tolist() for t in bodies)
    for texts in seen:
        assert "ids" in texts.columns and "body" not in texts.columns
        rows = texts.select("ids").toArrow()
        assert sorted(ids.tolist() for batch in rows.to_batches() for ids in lm_scoring._held_ids(batch, subwords.end + 1)) == want


def test_a_step_holds_class_probabilities_of_few_rows(small):
    v, after, _, weights, texts = small
    inputs, targets, _, valid = (np.concatenate(x) for x in zip(*(lm.window_arrays(v, t) for t in texts * 4)))
    trainer = lm.Trainer(weights, v, after)
    trainer.step(inputs, targets, valid)
    tracemalloc.start()
    trainer.step(inputs, targets, valid)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # Attention's arrays, of WIDTH numbers a query, are held; class probabilities, several arrays of CLASSES numbers a query, are not.
    everything = targets.size * lm.CLASSES * 4
    assert everything > 20e6 and peak < 3 * everything


def test_steps_of_many_rows_equal_the_plain_loss(small):
    """Blocks of rows, and windows with few ids or none, against probabilities made window by window."""
    v, after, within, weights, texts = small
    inputs, targets, wanted, valid = (np.concatenate(x) for x in zip(*(lm.window_arrays(v, t) for t in [*texts, texts[0][:2]])))
    real = valid[:, lm.CONTEXT :]
    assert real.sum() > 2 * lm.ROWS and real.sum() % lm.ROWS
    model = lm.Model(v, after, np.zeros_like(within), weights)
    model.vocabulary = copy.copy(v)
    model.vocabulary.in_class = np.zeros_like(v.in_class)
    loss = lm.Trainer(weights, v, after, rate=0.0).step(inputs, targets, valid)
    assert loss == pytest.approx(-sum(model.log_probabilities([*texts, texts[0][:2]])) / real.sum(), rel=1e-4)


def test_a_step_uses_the_arrays_of_the_one_before(small):
    v, after, _, weights, texts = small
    inputs, targets, _, valid = (np.concatenate(x)[:32] for x in zip(*(lm.window_arrays(v, t) for t in texts)))
    trainer = lm.Trainer(weights, v, after)
    trainer.step(inputs, targets, valid)
    tracemalloc.start()
    trainer.step(inputs, targets, valid)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(inputs) == 32 and peak < 1e6


def test_large_products_change_no_step(small, monkeypatch):
    """With and without the largest of a row taken off, and where exponentials would overflow without."""
    v, after, _, weights, texts = small
    inputs, targets, _, valid = (np.concatenate(x) for x in zip(*(lm.window_arrays(v, t) for t in [*texts[:9], texts[0][:2]])))
    found = []
    for safe in (0, 1e9):
        monkeypatch.setattr(lm, "SAFE", safe)
        trainer = lm.Trainer({k: w.astype(np.float64) for k, w in weights.items()}, v, after.astype(np.float64))
        found.append((trainer.step(inputs, targets, valid), trainer.m))
    assert found[0][0] == pytest.approx(found[1][0]) and all(np.allclose(found[0][1][k], found[1][1][k]) for k in weights)
    monkeypatch.undo()
    trainer = lm.Trainer({k: w * 30 for k, w in weights.items()}, v, after)
    assert math.isfinite(trainer.step(inputs, targets, valid)) and all(np.isfinite(w).all() for w in trainer.w.values())


def test_known_words_are_looked_up_once():
    class Known(dict):
        looked = 0

        def get(self, *key):
            Known.looked += 1
            return super().get(*key)

        def __contains__(self, key):
            Known.looked += 1
            return super().__contains__(key)

        def __getitem__(self, key):
            Known.looked += 1
            return super().__getitem__(key)

    subwords = lm_scoring.Subwords(bpe.read_ranks(queries.RANKS), public_tokenizers.PATTERN)
    words = [b"one", b"two", b"one", b"three"] * 5
    subwords.index(words)
    subwords.known = Known(subwords.known)
    again = subwords.index(words)
    assert Known.looked == len(words) and [list(subwords.known)[i] for i in again] == words
    mixed = subwords.index([b"four", b"one", b"four", b"five"])
    assert mixed[0] == mixed[2] and [list(subwords.known)[i] for i in mixed] == [b"four", b"one", b"four", b"five"]
