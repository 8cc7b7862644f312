"""Language identification with interpolated Kneser-Ney character models, one per language."""

from __future__ import annotations

import re
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from proofmark.llm.common import add_fields, col, keyed_texts, per_batch, safe_pieces, written

ORDER = 4
#: Slots of the hash space of each order and language: the bound of the model, whatever the corpus.
SLOT_BITS = 20
#: Temperatures that are tried.
TEMPERATURES = tuple(np.geomspace(0.25, 64, 17).tolist())
#: Share of accepted training documents that must be right.
PRECISION = 0.99
REMEMBERED = 400_000
UNDETERMINED = "und"

_LETTERS = re.compile(r"[^\W\d_]+")


def grams_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Packed 4-grams of words, each with three spaces before and one behind it, and the number of grams of each word."""
    padded = "".join(["   " + w + " " for w in words])
    codes = np.frombuffer(padded.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64) & np.uint64(0xFFFF)
    packed = codes[:-3] << np.uint64(48) | codes[1:-2] << np.uint64(32) | codes[2:-1] << np.uint64(16) | codes[3:]
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
    ends = np.cumsum(sizes + 3)
    inside = np.ones(len(packed), dtype=bool)
    for skip in range(3):  # grams that begin in the last three places of one word reach into the next
        cut = ends[:-1] - 1 - skip
        inside[cut] = False
    return packed[inside], sizes


def slots(grams: np.ndarray, order: int) -> np.ndarray:
    """Hash slots of the last `order` characters of packed grams."""
    held = grams & np.uint64((1 << (16 * order)) - 1)
    mixed = (held ^ (held >> np.uint64(29)) ^ np.uint64(order)) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (mixed >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _words(text: str) -> list[str]:
    return _LETTERS.findall(text.lower())


def gram_counts(labelled: DataFrame) -> DataFrame:
    """(lang, gram, n) over all rows of (body, lang): counts of packed 4-grams, from distinct words and their counts."""
    def start_and_run(batches):
        counts: dict[str, Counter] = {}
        held = 0
        for batch in batches:
            for body, lang in zip(batch.column("body").to_pylist(), batch.column("lang").to_pylist()):
                own = counts.setdefault(lang, Counter())
                held -= len(own)
                for piece in safe_pieces(body.decode("utf-8", "replace")):
                    own.update(_words(piece))
                held += len(own)
            if held > REMEMBERED:
                yield from _flushed(counts)
                counts, held = {}, 0
        yield from _flushed(counts)

    raw = labelled.mapInArrow(start_and_run, "lang string, gram long, n long")
    return raw.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _flushed(counts: dict[str, Counter]):
    for lang, words in counts.items():
        names = list(words)
        for start in range(0, len(names), 50_000):
            part = names[start : start + 50_000]
            grams, sizes = grams_of(part)
            weights = np.repeat(np.fromiter(map(words.__getitem__, part), dtype=np.int64, count=len(part)), sizes)
            distinct, where = np.unique(grams, return_inverse=True)
            n = np.bincount(where, weights=weights).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(distinct)), pa.array(distinct.view(np.int64)), pa.array(n)], ["lang", "gram", "n"])


def _tables(grams: DataFrame) -> DataFrame:
    """(lang, sort, size, slot, total, types): for each order the gram counts ('gram') and their context sums ('before').

    The highest order counts occurrences; each lower one counts the distinct characters that stand before the gram.
    """
    spark_tables, level = [], grams.select("lang", "gram", "n")
    for order in range(ORDER, 0, -1):
        spark_tables.append(level.select("lang", F.lit(order).alias("size"), "gram", "n"))
        if order > 1:
            keep = (1 << (16 * (order - 1))) - 1
            level = level.groupBy("lang", F.col("gram").bitwiseAND(F.lit(keep)).alias("gram")).agg(F.count("*").alias("n"))
    counts = spark_tables[0]
    for other in spark_tables[1:]:
        counts = counts.unionByName(other)

    def start():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            gram = batch.column("gram").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            size = batch.column("size").to_numpy(zero_copy_only=False)
            own, before = np.zeros(len(gram), dtype=np.int64), np.zeros(len(gram), dtype=np.int64)
            for order in range(1, ORDER + 1):
                at = size == order
                own[at] = slots(gram[at], order)
                before[at] = slots(gram[at] >> np.uint64(16), order - 1) if order > 1 else 0
            lang, n = batch.column("lang"), batch.column("n")
            return pa.RecordBatch.from_arrays([lang, batch.column("size"), pa.array(own), pa.array(before), n], ["lang", "size", "own", "before", "n"])

        return step

    hashed = counts.mapInArrow(per_batch(start), "lang string, size int, own long, before long, n long")
    own = hashed.groupBy("lang", "size", F.col("own").alias("slot")).agg(F.sum("n").alias("total"), F.lit(0).cast("long").alias("types"))
    before = hashed.groupBy("lang", "size", F.col("before").alias("slot")).agg(F.sum("n").alias("total"), F.count("*").alias("types"))
    return own.withColumn("sort", F.lit("gram")).unionByName(before.withColumn("sort", F.lit("before")))


class Models:
    """Sorted slot arrays of all languages, and the calibration."""

    def __init__(self, rows: list[pa.RecordBatch] | pa.Table):
        table = rows if isinstance(rows, pa.Table) else pa.Table.from_batches(rows)
        frame = table.to_pandas()
        self.langs = sorted(frame["lang"].unique().tolist())
        self.parts, self.discount = {}, {}
        for (lang, sort, size), rows_ in frame.groupby(["lang", "sort", "size"], sort=False):
            rows_ = rows_.sort_values("slot")
            self.parts[lang, sort, int(size)] = tuple(rows_[c].to_numpy() for c in ("slot", "total", "types"))
            if sort == "gram":
                once, twice = int((rows_["total"] == 1).sum()), int((rows_["total"] == 2).sum())
                self.discount[lang, int(size)] = once / (once + 2 * twice) if once and twice else 0.5
        letters = [p[0] for (_, sort, size), p in self.parts.items() if sort == "gram" and size == 1]
        self.characters = float(len(np.unique(np.concatenate(letters)))) if letters else 1.0
        self.temperature, self.least = 1.0, 0.0
        self.name = uuid.uuid4().hex

    @staticmethod
    def _find(part, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if part is None:
            return np.zeros(len(wanted)), np.zeros(len(wanted))
        keys, total, types = part
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        found = keys[at] == wanted
        return np.where(found, total[at], 0).astype(float), np.where(found, types[at], 0).astype(float)

    def costs(self, grams: np.ndarray) -> np.ndarray:
        """-log2 p(last character | those before it) of packed grams, one column a language."""
        out = np.empty((len(grams), len(self.langs)), dtype=np.float32)
        for k, lang in enumerate(self.langs):
            p = np.full(len(grams), 1.0 / (self.characters + 1))
            for order in range(1, ORDER + 1):
                n, _ = self._find(self.parts.get((lang, "gram", order)), slots(grams, order))
                before = slots(grams >> np.uint64(16), order - 1) if order > 1 else np.zeros(len(grams), dtype=np.int64)
                total, types = self._find(self.parts.get((lang, "before", order)), before)
                d = self.discount.get((lang, order), 0.5)
                seen = total > 0
                safe = np.where(seen, total, 1.0)
                p = np.where(seen, np.maximum(n - d, 0) / safe + d * types / safe * p, p)
            out[:, k] = -np.log2(np.maximum(p, 1e-30))
        return out


class Scorer:
    """Cross-entropies of texts; words and grams met before are looked up."""

    def __init__(self, models: Models):
        self.models = models
        self.keys = np.empty(0, dtype=np.uint64)
        self.values = np.empty((0, len(models.langs)), dtype=np.float32)
        self._reset()

    def _reset(self) -> None:
        self.known: dict[str, int] = {}
        self.rows = np.zeros((1 << 12, len(self.models.langs) + 1), dtype=np.float32)

    def _gram_costs(self, grams: np.ndarray) -> np.ndarray:
        distinct, where = np.unique(grams, return_inverse=True)
        if len(self.keys) > 1 << 20:
            self.keys, self.values = self.keys[:0], self.values[:0]
        at = np.searchsorted(self.keys, distinct)
        new = np.ones(len(distinct), dtype=bool)
        inside = at < len(self.keys)
        new[inside] = self.keys[at[inside]] != distinct[inside]
        if new.any():
            # Both lists are sorted: new keys go to their places, nothing is sorted again.
            costs = self.models.costs(distinct[new])
            self.values = np.insert(self.values, at[new], costs, axis=0)
            self.keys = np.insert(self.keys, at[new], distinct[new])
        return self.values[np.searchsorted(self.keys, distinct)][where]

    def _learn(self, words: list[str]) -> None:
        if len(self.known) + len(words) > REMEMBERED:
            self._reset()
        for start in range(0, len(words), 20_000):
            part = words[start : start + 20_000]
            grams, sizes = grams_of(part)
            costs = self._gram_costs(grams)
            begins = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            summed = np.add.reduceat(costs, begins, axis=0)
            first = len(self.known)
            while first + len(part) > len(self.rows):
                self.rows = np.concatenate((self.rows, np.zeros_like(self.rows)))
            self.rows[first : first + len(part), :-1] = summed
            self.rows[first : first + len(part), -1] = [n if any(map(str.isalpha, w)) else 0 for w, n in zip(part, sizes)]
            self.rows[first : first + len(part)][self.rows[first : first + len(part), -1] == 0] = 0
            self.known.update(zip(part, range(first, first + len(part))))

    def costs(self, text: str) -> tuple[np.ndarray, float]:
        """Sum of costs for each language, and the number of characters they are over (0: the text has no letter)."""
        total = np.zeros(len(self.models.langs) + 1)
        for piece in safe_pieces(text):
            words = _words(piece)
            if not words:
                continue
            distinct = set(words)
            unseen = [w for w in distinct if w not in self.known]
            if unseen:
                if len(self.known) + len(unseen) > REMEMBERED:
                    self._reset()
                    unseen = list(distinct)
                self._learn(unseen)
            at = np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words))
            total += self.rows[at].sum(axis=0, dtype=np.float64)
        return total[:-1], float(total[-1])


def fit(df: DataFrame, train: Column, text_col: str, lang_col: str) -> Models:
    """Models from all rows for which `train` holds and the language is known; calibrated on all of them."""
    return fit_scored(df.where(train & col(lang_col).isNotNull()), F.lit(True), lang_col, text_col, lang_col)[0]


def fit_scored(df: DataFrame, train: Column, id_col: str, text_col: str, lang_col: str) -> tuple[Models, DataFrame]:
    """The same, and the scores of every row of the table for `identify`: each text is scored once, for calibration and answer."""
    lang = F.when(train, col(lang_col)).cast("string")
    keyed = df.select(col(id_col).alias("id"), F.coalesce(col(text_col), F.lit("")).cast("string").cast("binary").alias("body"), lang.alias("lang"))
    grams = written(gram_counts(keyed.where("lang IS NOT NULL").select("body", "lang")), "grams")
    models = Models(_tables(grams).toArrow())
    scored = written(score_rows(keyed, models), "scores")
    _calibrate(models, scored.where("lang IS NOT NULL AND length > 0"))
    return models, scored.select("id", "costs", "length")


def _calibrate(models: Models, known: DataFrame) -> None:
    """Temperature by least log loss over a grid; the rejection limit by the precision of what is accepted."""
    if len(models.langs) < 2:
        return
    loss = dict(known.mapInArrow(_losses(models.langs), "at int, loss double").groupBy("at").agg(F.sum("loss")).collect())  # a row a temperature
    if loss:
        models.temperature = TEMPERATURES[min(loss, key=lambda at: (loss[at], at))]
        models.least = _least(_verdicts(known, models).select("score", (F.col("lang_pred") == F.col("lang")).alias("right")), len(models.langs))


def _losses(langs: list[str]):
    """A mapInArrow function: the log loss of a task's rows at each temperature."""
    def run(batches):
        total, rows = np.zeros(len(TEMPERATURES)), 0
        for batch in batches:
            n = batch.num_rows
            if n:
                costs = batch.column("costs").flatten().to_numpy().reshape(n, len(langs))
                rates = costs / batch.column("length").to_numpy()[:, None]
                right = np.array([langs.index(x) for x in batch.column("lang").to_pylist()])
                total += [-np.log(np.maximum(_softmax(-rates * t)[np.arange(n), right], 1e-12)).sum() for t in TEMPERATURES]
                rows += n
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], ["at", "loss"])

    return run


def _least(judged: DataFrame, langs: int) -> float:
    """The lowest score at or above which the share PRECISION of all (score, right) rows is right.

    Rows of one score count together; running sums are made in ranges of scores, and range totals are all that reaches the driver.
    """
    by_score = judged.groupBy("score").agg(F.count("*").alias("n"), F.count_if("right").alias("ok"))
    ranged = written(by_score.repartitionByRange(F.desc("score")).withColumn("part", F.spark_partition_id()), "by-score")
    starts, n, ok = [], 0, 0
    for r in ranged.groupBy("part").agg(F.sum("n").alias("n"), F.sum("ok").alias("ok")).orderBy("part").collect():
        starts.append((r.part, n, ok))
        n, ok = n + r.n, ok + r.ok
    before = F.broadcast(judged.sparkSession.createDataFrame(starts, "part int, n_before long, ok_before long"))
    higher = Window.partitionBy("part").orderBy(F.desc("score"))
    summed = ranged.select("part", "score", F.sum("n").over(higher).alias("n"), F.sum("ok").over(higher).alias("ok")).join(before, "part")
    precise = (F.col("ok") + F.col("ok_before")) / (F.col("n") + F.col("n_before")) >= PRECISION
    found = summed.agg(F.min(F.when(precise, F.col("score"))).alias("least"), F.min("score").alias("lowest")).first()
    # Where even the least sure answers are right, nothing above chance is rejected.
    return 1.0 if found.least is None else 1 / langs if found.least == found.lowest else float(found.least)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


_SCORERS: dict[str, Scorer] = {}


def score_rows(keyed: DataFrame, models: Models) -> DataFrame:
    """(id, costs, length) of rows of (id, body); other columns stay beside the id."""
    shared = keyed.sparkSession.sparkContext.broadcast(models)
    kept = [c for c in keyed.columns if c != "body"]

    def start():
        # The words that a worker has met stay known to its later tasks.
        name = shared.value.name
        if name not in _SCORERS:
            _SCORERS.clear()
            _SCORERS[name] = Scorer(shared.value)
        scorer = _SCORERS[name]

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            costs, lengths = zip(*(scorer.costs(b.decode("utf-8", "replace")) for b in batch.column("body").to_pylist()))
            return pa.RecordBatch.from_arrays(
                [*map(batch.column, kept), pa.array([c.tolist() for c in costs], pa.list_(pa.float64())), pa.array(lengths, pa.float64())], [*kept, "costs", "length"]
            )

        return step

    return keyed.mapInArrow(per_batch(start), add_fields(keyed, kept, "costs array<double>, length double"))


def identify(df: DataFrame, models: Models, id_col: str = "doc_id", text_col: str = "text", scored: DataFrame | None = None) -> DataFrame:
    """Per input row: id, lang_pred, score (probability of the chosen language), accepted (score at or above the rejection limit).

    The language of the lowest cross-entropy per character wins; on a tie, the first in alphabetical order. A text that
    is null or has no letter, and any text where no language was learned, is `und` with score 0 and not accepted. `scored`:
    the rows of the table as `fit_scored` returns them, which are then not scored again.
    """
    found = score_rows(keyed_texts(df, id_col, text_col), models) if scored is None else scored
    if not models.langs:
        return found.select(F.col("id").alias(id_col), F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("accepted"))
    return _verdicts(found, models).select(
        F.col("id").alias(id_col), "lang_pred", "score", ((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= models.least)).alias("accepted")
    )


def _verdicts(found: DataFrame, models: Models) -> DataFrame:
    """lang_pred and score beside scored rows."""
    rates = F.transform("costs", lambda c: c / F.col("length"))
    some = F.col("length") > 0
    at = F.array_position("rates", F.array_min("rates")).cast("int")
    share = F.aggregate("rates", F.lit(0.0), lambda s, r: s + F.exp((F.array_min("rates") - r) * models.temperature))
    langs = F.array(*[F.lit(x) for x in models.langs])
    return (
        found.withColumn("rates", F.when(some, rates))
        .withColumn("lang_pred", F.when(some, F.element_at(langs, at)).otherwise(UNDETERMINED))
        .withColumn("score", F.when(some, 1 / share).otherwise(0.0))
    )
