"""Scores of texts by a language model trained on the corpus: a word-count base, and causal attention on subword ids."""

from __future__ import annotations

from itertools import repeat
from math import log, log10

import numpy as np
import pyarrow as pa
import tiktoken
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proofmark.llm import attention_lm as lm
from proofmark.llm.bpe import read_ranks
from proofmark.llm.common import add_fields, col, per_batch, split_bytes, written

#: Texts that warm the model up before all texts train it: a fixed number, at most about this many.
WARM = 1500
#: Windows of the warm-up; where the texts have fewer, they are gone over again.
WARM_WINDOWS = 100_000
#: Texts a trainer takes, about.
TRAINER_TEXTS = 1500
#: A word whose share of all tokens is at least one in so many is looked up in a broadcast of that many entries at most.
COMMON = 200_000
REMEMBERED = 300_000


class Subwords:
    """Words of a worker's texts, with their subword ids and hashes; every distinct word is encoded once."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.encoding = tiktoken.Encoding("subwords", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.end = max(ranks.values()) + 1
        self.spaced = np.zeros(self.end, dtype=bool)
        self.spaced[[rank for token, rank in ranks.items() if token.startswith(b" ")]] = True
        self.turn = 0
        self.reset()

    def reset(self) -> None:
        self.turn += 1
        self.known: dict[bytes, int] = {}
        self.hashes = np.empty(1 << 14, dtype=np.int64)
        self.begins = np.empty(1 << 14, dtype=np.int64)
        self.sizes = np.empty(1 << 14, dtype=np.int64)
        self.flat = np.empty(1 << 16, dtype=np.int32)
        self.used = 0

    def index(self, words: list[bytes]) -> np.ndarray:
        """Numbers of words, unseen ones being added."""
        found = np.fromiter(map(self.known.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        new = np.flatnonzero(found < 0)
        if len(new):
            unseen = list({words[i] for i in new.tolist()})
            if len(self.known) + len(unseen) > REMEMBERED:
                self.reset()
                unseen, new = list(set(words)), np.arange(len(words))
            known, digest = self.known, xxhash.xxh3_64_intdigest
            ids, sizes = self._encoded(unseen)
            first, n = len(known), len(unseen)
            total = len(ids)
            self._grow(first + n, self.used + total)
            self.hashes[first : first + n] = np.fromiter(map(digest, unseen), dtype=np.uint64, count=n).view(np.int64)
            self.sizes[first : first + n] = sizes
            self.begins[first : first + n] = self.used + np.cumsum(sizes) - sizes
            self.flat[self.used : self.used + total] = ids
            self.used += total
            known.update(zip(unseen, range(first, first + n)))
            found[new] = [known[words[i]] for i in new.tolist()]
        return found

    def _encoded(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, each after a space, and how many each has.

        Words are encoded as one text: the split pattern begins anew at a space after a word, and only the first id of a
        word begins with a space.
        """
        ids = np.array(self.encoding.encode_ordinary(" " + b" ".join(words).decode("utf-8", "replace")), dtype=np.int32)
        begins = np.flatnonzero(self.spaced[ids])
        if len(begins) == len(words):
            return ids, np.diff(np.append(begins, len(ids)))
        # Words of other kinds of space, side by side, may share an id with the space between them: each is encoded alone then.
        alone = [self.encoding.encode_ordinary(" " + w.decode("utf-8", "replace")) for w in words]
        return np.array([i for ids in alone for i in ids], dtype=np.int32), np.array([len(ids) for ids in alone], dtype=np.int64)

    def _grow(self, words: int, ids: int) -> None:
        while words > len(self.hashes):
            self.hashes, self.begins, self.sizes = (np.concatenate((a, np.empty_like(a))) for a in (self.hashes, self.begins, self.sizes))
        while ids > len(self.flat):
            self.flat = np.concatenate((self.flat, np.empty_like(self.flat)))

    def ids(self, index: np.ndarray) -> np.ndarray:
        """The subword ids of words by their numbers, in order."""
        sizes = self.sizes[index]
        ends = np.cumsum(sizes)
        if not len(ends):
            return np.empty(0, dtype=np.int32)
        return self.flat[np.repeat(self.begins[index] - ends + sizes, sizes) + np.arange(ends[-1])]


def pieces(body: bytes):
    """Words of a text, lower-cased in ASCII, in lists of bounded length."""
    for piece in split_bytes(body.lower()):
        words = piece.split()
        if words:
            yield words


def whole_text(subwords: Subwords, body: bytes) -> np.ndarray:
    """Ids of a text between two end marks."""
    parts = [np.array([subwords.end], dtype=np.int32)]
    for words in pieces(body):
        parts.append(subwords.ids(subwords.index(words)).copy())
    return np.concatenate([*parts, parts[0]])


def kinds_of(ranks: dict[bytes, int]) -> np.ndarray:
    """A group number by the look of an id's bytes: begins with a space or not, ASCII letters, beyond ASCII, other."""
    kinds = np.full(max(ranks.values()) + 2, 6, dtype=np.int64)
    for token, rank in ranks.items():
        inside = token.removeprefix(b" ")
        look = 1 if any(b > 127 for b in inside) else 0 if inside.isalpha() else 2
        kinds[rank] = look * 2 + (len(inside) < len(token))
    return kinds


_SUBWORDS: dict[tuple[str, str], Subwords] = {}


class Tokenizer:
    """What builds the subwords in a worker: the rank file is read there, once a process; words met stay known to later tasks."""

    def __init__(self, ranks_path: str, pattern: str):
        self.ranks_path, self.pattern = ranks_path, pattern

    def subwords(self) -> Subwords:
        key = self.ranks_path, self.pattern
        if key not in _SUBWORDS:
            _SUBWORDS[key] = Subwords(read_ranks(self.ranks_path), self.pattern)
        return _SUBWORDS[key]


def _bodies(df: DataFrame, text_col: str) -> DataFrame:
    return df.select(F.coalesce(col(text_col), F.lit("")).cast("string").cast("binary").alias("body"))


TEXT, WORD, AFTER, WITHIN = range(4)


def encoded(texts: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """(kind, key, n, ids): a row a text, its key a hash of its bytes, with its ids; and counts of words by hash, to be added up.

    Words are told apart by 64 bits of hash. A task holds counts of a bounded number of words at a time.
    """
    def run(batches):
        subwords = tokenizer.subwords()
        kind = np.min_scalar_type(subwords.end)
        tally, pending = np.zeros(0, dtype=np.int64), []

        def tallied():
            if not pending:
                return tally
            seen = np.bincount(np.concatenate(pending), minlength=len(tally))
            pending.clear()
            seen[: len(tally)] += tally
            return seen

        for batch in batches:
            held = []
            for body in batch.column("body").to_pylist():
                parts = [np.array([subwords.end], dtype=np.int32)]
                for part in pieces(body):
                    if len(subwords.known) + len(part) > REMEMBERED:
                        # Numbers of words are about to be given out anew.
                        yield _word_rows(subwords, tallied())
                        tally = tally[:0]
                        subwords.reset()
                    index = subwords.index(part)
                    pending.append(index)
                    parts.append(subwords.ids(index))
                held.append(np.concatenate([*parts, parts[0]]).astype(kind))
            if pending:
                tally = tallied()
            yield _rows(TEXT, batch.column("key"), np.array([len(ids) for ids in held], dtype=np.int64), [ids.tobytes() for ids in held])
        yield _word_rows(subwords, tally)

    keyed = texts.select("body", F.xxhash64("body", F.lit(7)).alias("key"))
    return keyed.mapInArrow(run, "kind int, key long, n long, ids binary")


def _word_rows(subwords: Subwords, tally: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(tally)
    return _rows(WORD, subwords.hashes[at], tally[at], [None] * len(at))


def _rows(kind: int, keys: np.ndarray | pa.Array, n: np.ndarray, ids: list | None = None) -> pa.RecordBatch:
    columns = {"kind": pa.array(np.full(len(keys), kind, dtype=np.int32)), "key": pa.array(keys), "n": pa.array(n)}
    if ids is not None:
        columns["ids"] = pa.array(ids, pa.binary())
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _held_ids(batch: pa.RecordBatch, size: int) -> list[np.ndarray]:
    """The ids of a batch of encoded texts, from a vocabulary of so many."""
    kind = np.min_scalar_type(size - 1)
    return [np.frombuffer(ids, dtype=kind) for ids in batch.column("ids").to_pylist()]


def rank_counts(texts: DataFrame, tokenizer: Tokenizer, size: int) -> np.ndarray:
    """Counts of ids in the texts, encoded or not yet; a task emits at most a row an id."""
    if "ids" not in texts.columns:
        texts = encoded(texts, tokenizer).where(F.col("kind") == TEXT)

    def run(batches):
        counts = np.zeros(size, dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                counts += np.bincount(np.concatenate([ids[1:] for ids in _held_ids(batch, size)]), minlength=size)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["id", "n"])

    found = texts.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(size)
    counts[found.column("id").to_numpy()] = found.column("n").to_numpy()
    return counts


def class_counts(texts: DataFrame, vocabulary: lm.Vocabulary) -> lm.Counts:
    """Classes after slots and ids after classes, counted over all encoded texts; a task emits at most a fixed number of rows."""
    shared = texts.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        v = shared.value
        counts = lm.Counts(v)
        for batch in batches:
            if not batch.num_rows:
                continue
            held = _held_ids(batch, v.size)
            lengths = np.array([len(ids) for ids in held])
            starts = np.zeros(lengths.sum(), dtype=bool)
            starts[np.cumsum(lengths) - lengths] = True
            counts.add(np.concatenate(held), starts)
        for kind, table in ((AFTER, counts.next_class.ravel()), (WITHIN, counts.next_id.ravel())):
            at = np.flatnonzero(table)
            yield _rows(kind, at, table[at].astype(np.int64))

    found = texts.select("ids").mapInArrow(run, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n")).toArrow()
    kind, key, n = (found.column(c).to_numpy() for c in ("kind", "key", "n"))
    tables = lm.Counts(vocabulary)
    for k, table in ((AFTER, tables.next_class.ravel()), (WITHIN, tables.next_id.ravel())):
        table[key[kind == k]] = n[kind == k]
    return tables


def trained(texts: DataFrame, trainers: int, rate: float, vocabulary: lm.Vocabulary, after: np.ndarray, weights: dict, least: int = 0) -> dict:
    """Weights after every trainer has gone over its share of the encoded texts from the given ones: the mean of their results.

    A trainer sends its weights as one row a number, and the mean is an aggregate. One trainer reads the texts where they
    lie, and goes over them until `least` windows are done.
    """
    shared = texts.sparkSession.sparkContext.broadcast((vocabulary, after, weights))

    def run(batches):
        v, table, first = shared.value
        trainer = lm.Trainer(first, v, table, rate)
        done = trainer.run([ids for rows in batches for ids in _held_ids(rows, v.size)], least)
        if done:
            flat = np.concatenate([trainer.w[name].ravel() for name in sorted(trainer.w)]).astype(np.float64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat * done), pa.array(np.full(len(flat), done, dtype=np.int64))], ["at", "value", "done"])

    dealt = texts.select("ids")
    dealt = dealt.coalesce(1) if trainers == 1 else dealt.repartition(trainers)
    mean = dealt.mapInArrow(run, "at long, value double, done long").groupBy("at").agg((F.sum("value") / F.sum("done")).alias("value")).orderBy("at").toArrow()
    if not mean.num_rows:
        return weights
    flat, out, used = mean.column("value").to_numpy().astype(np.float32), {}, 0
    for name in sorted(weights):
        out[name] = flat[used : used + weights[name].size].reshape(weights[name].shape)
        used += weights[name].size
    return out


class Base:
    """Corpus totals, and log10(count + 1) of the common words by hash."""

    def __init__(self, tokens: int, distinct: int, texts: int, common: dict[int, int]):
        self.tokens, self.distinct, self.texts, self.common = tokens, distinct, texts, common


def fit(df: DataFrame, train: Column, ranks_path: str, pattern: str, text_col: str = "text") -> tuple[lm.Model, Base, DataFrame]:
    """Model, base totals and word counts from the rows for which `train` holds.

    Texts are encoded once, and everything is learned from their ids. Counts cover all of them, those that rank the ids for
    the vocabulary too. Attention weights are trained on a fixed number
    of texts first, then on all of them by as many trainers as that takes, at every size.
    """
    tokenizer, ranks = Tokenizer(ranks_path, pattern), read_ranks(ranks_path)
    kinds = kinds_of(ranks)
    found = written(encoded(_bodies(df.where(train), text_col), tokenizer), "ids")
    texts = found.where(F.col("kind") == TEXT).select("key", "ids")
    total = texts.count()
    warm = written(texts.where(F.pmod("key", F.lit(max(1, total // WARM))) == 0), "warm")
    vocabulary = lm.Vocabulary(rank_counts(texts, tokenizer, len(kinds)), kinds)
    after, within = class_counts(texts, vocabulary).tables()
    weights = trained(warm, 1, 6e-3, vocabulary, after, lm.starting_weights(), WARM_WINDOWS)
    weights = trained(texts, max(1, round(total / TRAINER_TEXTS)), 3e-3, vocabulary, after, weights)
    words = written(found.where(F.col("kind") == WORD).groupBy(F.col("key").alias("hash")).agg(F.sum("n").alias("n")), "words")
    tokens, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    # The end mark is a token too, one a text.
    tokens, distinct = tokens + total, distinct + (total > 0)
    common = words.where(F.col("n") * COMMON >= tokens).toArrow()
    base = Base(tokens, distinct, total, dict(zip(common.column("hash").to_pylist(), common.column("n").to_pylist())))
    return lm.Model(vocabulary, after, within, weights), base, words


_NONE = np.empty(0, dtype=np.int64)


class Marks:
    """log10(count + 1) of words by their numbers in a worker's memory of words; -1 where a word is not a common one."""

    def __init__(self, common: dict[int, int]):
        self.common, self.values, self.filled, self.turn = common, np.empty(0), 0, -1

    def of(self, subwords: Subwords, numbers: np.ndarray) -> np.ndarray:
        if self.turn != subwords.turn:
            self.filled, self.turn = 0, subwords.turn
        known = len(subwords.known)
        if self.filled < known:
            if len(self.values) < len(subwords.hashes):
                self.values = np.concatenate((self.values[: self.filled], np.empty(len(subwords.hashes) - self.filled)))
            counts = (self.common.get(h) for h in subwords.hashes[self.filled : known].tolist())
            self.values[self.filled : known] = [-1.0 if c is None else log10(c + 1) for c in counts]
            self.filled = known
        return self.values[numbers]


def score(df: DataFrame, model: lm.Model, base: Base, words: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row: id, n_tokens, n_known, train_tokens, base_score, score (both log10).

    A null or empty text is one token, its end. Repeated rows stay; an empty table gives none; an empty training corpus
    knows nothing and gives every token the same base probability. Counts of common words are broadcast; the others of a
    text meet the word counts in a join, whose keys are all rare.
    """
    spark = df.sparkSession
    tokenizer, shared = Tokenizer(ranks_path, pattern), spark.sparkContext.broadcast((model, base))
    source = df.select(
        F.monotonically_increasing_id().alias("row"), col(id_col).alias("id"), F.coalesce(col(text_col), F.lit("")).cast("string").cast("binary").alias("body")
    )

    def start():
        own, totals = shared.value
        subwords, marks = tokenizer.subwords(), Marks(totals.common)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts, n_tokens, known, logs, rare, often = [], [], [], [], [], []
            for body in batch.column("body").to_pylist():
                parts, size = [np.array([subwords.end], dtype=np.int32)], 1
                sure, logged = int(totals.texts > 0), log10(totals.texts + 1)
                keys, times = [], []
                for part in pieces(body):
                    index = subwords.index(part)
                    parts.append(subwords.ids(index))
                    size += len(part)
                    numbers, n = np.unique(index, return_counts=True)
                    found = marks.of(subwords, numbers)
                    common = found >= 0
                    sure += int(n[common].sum())
                    logged += float((n * found)[common].sum())
                    keys.append(subwords.hashes[numbers[~common]])
                    times.append(n[~common])
                texts.append(np.concatenate([*parts, parts[0]]))
                n_tokens.append(size)
                known.append(sure)
                logs.append(logged)
                rare.append(np.concatenate(keys) if keys else _NONE)
                often.append(np.concatenate(times) if times else _NONE)
            scores = [x / log(10) for x in own.log_probabilities(texts)]
            arrays = [batch.column("row"), batch.column("id"), pa.array(n_tokens, pa.int64()), pa.array(known, pa.int64()), pa.array(logs, pa.float64()),
                      pa.array(scores, pa.float64()), pa.array(rare, pa.list_(pa.int64())), pa.array(often, pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays(arrays, ["row", "id", "n_tokens", "known", "logs", "score", "rare", "times"])

        return step

    out = add_fields(source, ["row", "id"], "n_tokens long, known long, logs double, score double, rare array<long>, times array<long>")
    found = written(source.mapInArrow(per_batch(start), out), "scores")
    rest = (
        found.select("row", F.inline(F.arrays_zip(F.col("rare").alias("hash"), F.col("times").alias("times"))))
        .join(words, "hash")
        .groupBy("row")
        .agg(F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more_logs"))
    )
    total = log10(base.tokens + base.distinct + 1)
    return found.drop("rare", "times").join(rest, "row", "left").select(
        F.col("id").alias(id_col), "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(base.tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) - F.col("n_tokens") * total).alias("base_score"), "score",
    )
