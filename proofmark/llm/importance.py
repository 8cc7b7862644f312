"""Quality classifier by importance resampling: hashed n-gram models of target and raw text, sampled by Gumbel top-k."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from proofmark.llm.common import col, fresh, per_batch, safe_pieces, written

#: Characters of an n-gram, and hash buckets of the two models.
SIZE = 5
BUCKET_BITS = 18
#: Labelled rows, about, that the target model and the limit are fitted on, and so the bound of what is broadcast. The raw model counts all documents.
LABELLED = 200_000
#: Weight of a rejected target row against a kept other row when the limit is set.
CARE = 20.0
#: Log weights are multiplied by this before Gumbel noise is added: chance decides near the limit only.
SHARPNESS = 8.0
REMEMBERED = 400_000
SEED = 9
#: Kind of a row that the raw model is counted from; 0 and 1 are the halves of the target.
RAW = 2

_TOKEN = re.compile(r"\w+|[^\w\s]+")
_BINS = 4096


def tokens(body: bytes):
    for piece in safe_pieces(body.decode("utf-8", "replace")):
        yield _TOKEN.findall(piece.lower())


def buckets_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the character 5-grams of words with two spaces at either side, and the number of grams of each word."""
    padded = "".join(["  " + w + "  " for w in words])
    codes = np.frombuffer(padded.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    n = len(codes) - SIZE + 1
    mixed = np.zeros(n, dtype=np.uint64)
    for k in range(SIZE):
        mixed = (mixed ^ codes[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(sizes + SIZE - 1)
    inside = np.ones(n, dtype=bool)
    for skip in range(SIZE - 1):
        inside[ends[:-1] - 1 - skip] = False
    return (mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)[inside], sizes


class Ratio:
    """log p_target - log p_raw of every bucket, from add-one counts of both."""

    def __init__(self, target: np.ndarray, raw: np.ndarray):
        slots = 1 << BUCKET_BITS
        self.values = (np.log((target + 1) / (target.sum() + slots)) - np.log((raw + 1) / (raw.sum() + slots))).astype(np.float32)


class Weigher:
    """Log weights of texts; a word's sum of log ratios is worked out once and remembered."""

    def __init__(self, ratio: Ratio):
        self.values, self.known = ratio.values, {}

    def weight(self, body: bytes) -> float:
        """The log weight of the text's least likely word: what the target never holds outweighs any length of common text. 0 without words."""
        least = 0.0
        for words in tokens(body):
            distinct = set(words)
            unseen = [w for w in distinct if w not in self.known]
            if unseen:
                if len(self.known) + len(unseen) > REMEMBERED:
                    self.known.clear()
                    unseen = list(distinct)
                for start in range(0, len(unseen), 20_000):
                    part = unseen[start : start + 20_000]
                    buckets, sizes = buckets_of(part)
                    begins = np.concatenate(([0], np.cumsum(sizes)[:-1]))
                    self.known.update(zip(part, np.add.reduceat(self.values[buckets], begins).tolist()))
            if distinct:
                least = min(least, min(map(self.known.__getitem__, distinct)))
        return least


def labelled_rows(documents: DataFrame, labels: DataFrame, id_col: str, text_col: str, most: int = LABELLED) -> DataFrame:
    """(body, half, target, share) of about `most` labelled documents, chosen by a hash of the id.

    Target is quality 1 and toxic 0, by every label a document has. `share` is one over the number of labelled copies of the
    text, so that copies count as one document.
    """
    chosen = labels.groupBy(col(id_col).alias("key")).agg((F.min((F.col("quality") == 1) & (F.col("toxic") == 0))).alias("target")).where("key IS NOT NULL AND target IS NOT NULL")
    parts = max(1, -(-chosen.count() // most))
    chosen = chosen.where(F.pmod(F.xxhash64("key", F.lit(SEED)), F.lit(parts)) == 0)
    rows = documents.select(col(id_col).alias("key"), F.coalesce(col(text_col), F.lit("")).cast("string").cast("binary").alias("body")).join(F.broadcast(chosen), "key")
    rows = rows.select("body", "target", F.xxhash64("body").alias("copy"))
    copies = rows.groupBy("copy").agg((1 / F.count("*")).alias("share"))
    # At most as many rows as there are chosen labels, so they go to the texts, not the texts to them.
    return rows.join(F.broadcast(copies), "copy").select("body", F.pmod("copy", F.lit(2)).cast("int").alias("half"), "target", "share")


def raw_rows(documents: DataFrame, text_col: str) -> DataFrame:
    """(body, share) of all documents, labelled or not; `share` is one over the number of copies of the text.

    Only the hashes of texts that occur again are counted out; they meet the texts by a broadcast while their written
    size is small, by a join that splits a hot hash beyond that.
    """
    body = F.coalesce(col(text_col), F.lit("")).cast("string").cast("binary")
    copies = documents.groupBy(F.xxhash64(body).alias("copy")).agg(F.count("*").alias("n")).where("n > 1").select("copy", (1 / F.col("n")).alias("share"))
    rows = documents.select(body.alias("body")).withColumn("copy", F.xxhash64("body"))
    return rows.join(written(copies, "copies"), "copy", "left").select("body", F.coalesce("share", F.lit(1.0)).alias("share"))


def bucket_counts(rows: DataFrame) -> dict[int, np.ndarray]:
    """Counts of every bucket by kind of row: 0 and 1 the halves of the target, RAW the raw text; rows are (body, kind, share).

    At most a row a bucket and kind leaves a task or reaches the driver.
    """
    def run(batches):
        counts: dict = defaultdict(lambda: np.zeros(1 << BUCKET_BITS))
        words: dict = defaultdict(Counter)

        def flush():
            for kind, own in words.items():
                names = list(own)
                for start in range(0, len(names), 50_000):
                    part = names[start : start + 50_000]
                    buckets, sizes = buckets_of(part)
                    weights = np.repeat(np.fromiter(map(own.__getitem__, part), dtype=np.float64, count=len(part)), sizes)
                    counts[kind] += np.bincount(buckets, weights=weights, minlength=1 << BUCKET_BITS)
            words.clear()

        for batch in batches:
            for body, kind, share in zip(*(batch.column(c).to_pylist() for c in ("body", "kind", "share"))):
                own = words[kind]
                for found in tokens(body):
                    if share == 1:
                        own.update(found)
                    else:
                        for word, n in Counter(found).items():
                            own[word] += n * share
            if sum(map(len, words.values())) > REMEMBERED:
                flush()
        flush()
        for kind, own in counts.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([kind] * len(at), pa.int32()), pa.array(at), pa.array(own[at])], ["kind", "bucket", "n"])

    found = rows.mapInArrow(run, "kind int, bucket long, n double").groupBy("kind", "bucket").agg(F.sum("n").alias("n")).toArrow()
    kind, bucket, n = (found.column(c).to_numpy() for c in ("kind", "bucket", "n"))
    out = {}
    for k in (0, 1, RAW):
        out[k] = np.zeros(1 << BUCKET_BITS)
        out[k][bucket[kind == k]] = n[kind == k]
    return out


def weighed(df: DataFrame, ratios: list[Ratio], text_col: str, half_col: str | None = None, name: str = "log_weight") -> DataFrame:
    """The table with the log weight of its text as a further column; with `half_col`, by the model of the row's other half."""
    shared = [df.sparkSession.sparkContext.broadcast(r) for r in ratios]

    def start():
        weighers = [Weigher(s.value) for s in shared]

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column(batch.schema.names.index(text_col)).to_pylist()
            halves = batch.column(half_col).to_pylist() if half_col else [0] * len(texts)
            found = [weighers[h].weight(t.encode("utf-8", "replace") if isinstance(t, str) else t or b"") for t, h in zip(texts, halves)]
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], [*batch.schema.names, name])

        return step

    return df.mapInArrow(per_batch(start), T.StructType([*df.schema.fields, T.StructField(name, T.DoubleType())]))


class Classifier:
    """The fitted ratio of target to raw text and the limit on log weights."""

    def __init__(self, ratio: Ratio, limit: float):
        self.ratio, self.limit = ratio, limit


def fit(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = LABELLED) -> Classifier:
    """The target model from labelled rows, the raw model from all documents; the limit from rows weighed by the target half they are not in.

    The limit is the middle of the best gap: the one that loses fewest target rows, CARE times as dear as other rows kept.
    Without labels of both kinds, nothing is rejected.
    """
    rows = written(labelled_rows(documents, labels, id_col, text_col, most), "labelled")
    target = rows.where("target").select("body", F.col("half").alias("kind"), "share")
    counts = bucket_counts(raw_rows(documents, text_col).select("body", F.lit(RAW).alias("kind"), "share").unionByName(target))
    ratio = lambda halves: Ratio(sum(counts[h] for h in halves), counts[RAW])
    weights = weighed(rows, [ratio([1]), ratio([0])], "body", "half")
    bins = weights.groupBy("target", F.greatest(F.lit(-1024), F.floor(F.col("log_weight") * 8)).cast("int").alias("bin")).agg(F.count("*").alias("n")).collect()
    good, bad = np.zeros(1026), np.zeros(1026)
    for row in bins:
        (good if row.target else bad)[min(row.bin, 0) + 1024] += row.n
    limit = -np.inf
    if good.sum() and bad.sum():
        # Bins below `at` are rejected.
        costs = CARE * np.concatenate(([0], np.cumsum(good))) / good.sum() + 1 - np.concatenate(([0], np.cumsum(bad))) / bad.sum()
        best = np.flatnonzero(costs <= costs.min() + 1e-12)
        limit = (best[0] + best[-1]) / 2 / 8 - 128
    return Classifier(ratio([0, 1]), float(limit))


def kth_largest(df: DataFrame, name: str, k: int) -> float:
    """The k-th largest value of a column without a null: counts over narrowing ranges, a bounded number of bins a round."""
    low, high = df.agg(F.min(name), F.max(name)).first()
    while low < high:
        width = (high - low) / _BINS
        place = F.least(F.floor((F.col(name) - low) / width), F.lit(_BINS - 1))
        found = df.where(F.col(name).between(low, high)).groupBy(place.alias("bin")).agg(F.count("*"), F.min(name), F.max(name)).collect()
        for _, n, least, most in sorted(found, reverse=True):
            if k <= n:
                if (least, most) == (low, high):
                    return high if k <= df.where(F.col(name) == high).count() else low
                low, high = least, most
                break
            k -= n
    return low


def sample_key(classifier: Classifier, id_col: str, weight_col: str) -> Column:
    """Gumbel key of a row, a function of its id and log weight; 0 where nothing is rejected."""
    if classifier.limit == -np.inf:
        return F.lit(0.0)
    uniform = (F.pmod(F.xxhash64(col(id_col).cast("string"), F.lit(SEED)), F.lit((1 << 52) - 1)) + 1) / F.lit(float(1 << 52))
    return (col(weight_col) - classifier.limit) * SHARPNESS - F.log(-F.log(uniform))


def resampled(df: DataFrame, classifier: Classifier, id_col: str, weight_col: str, key_col: str) -> tuple[DataFrame, float]:
    """The weighed table with its Gumbel keys, and the least key of the sample.

    The sample has as many rows as have a log weight above the limit, drawn without replacement with chances in
    proportion to their sharpened weights: Gumbel noise, a function of the id, is added and the largest keys win.
    Equal keys at the limit are all in.
    """
    keyed = df.withColumn(key_col, sample_key(classifier, id_col, weight_col))
    if classifier.limit == -np.inf:
        return keyed, -np.inf
    size = keyed.where(col(weight_col) >= classifier.limit).count()
    if not size:
        return keyed, np.inf
    return keyed, kth_largest(keyed.select(col(key_col).alias("key")), "key", size)


def classify(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per input row: id, log_weight, sample_key, kept.

    A null or empty text has log weight 0 and is kept as far as this rule goes. Repeated rows stay and share their key; an
    empty table gives none. Without labels, all rows are kept.
    """
    classifier = fit(documents, labels, id_col, text_col, **options)
    narrow = documents.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"))
    weights = written(weighed(narrow, [classifier.ratio], "text").drop("text"), "weights")
    keyed, least = resampled(weights, classifier, "id", "log_weight", "sample_key")
    return keyed.select(F.col("id").alias(id_col), "log_weight", "sample_key", (F.col("sample_key") >= F.lit(least)).alias("kept"))


def filtered(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The kept rows of the table, all columns.

    Texts are weighed once for the limit of the sample and once more as they are filtered: that is cheaper than to store them.
    """
    classifier = fit(documents, labels, id_col, text_col, **options)
    narrow = documents.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"))
    weights = written(weighed(narrow, [classifier.ratio], "text").drop("text"), "weights")
    _, least = resampled(weights, classifier, "id", "log_weight", "sample_key")
    name = fresh(documents, "log_weight")
    again = weighed(documents, [classifier.ratio], text_col, name=name)
    return again.where(sample_key(classifier, id_col, name) >= F.lit(least)).select(*[col(c) for c in documents.columns])
