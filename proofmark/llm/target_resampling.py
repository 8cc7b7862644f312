"""Importance resampling towards a target: hashed word n-grams of two corpora, CRCs from prefixes, Gumbel top-k.

A text becomes its words joined by one space and is read once: the CRC-32 of every prefix that ends with a word is kept.
The CRC of any n-gram then follows from two prefixes: moving the earlier one over the n-gram's bytes, a linear map over
GF(2) that depends on their number only, and adding it to the later one cancels everything before the n-gram.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from proofmark.llm.common import keyed_texts, per_batch, written

LONGEST = 3
BUCKETS = 10_000
#: Documents of fewer words are not drawn.
LEAST_WORDS = 20
#: Share of the others that is drawn, as a fraction of whole numbers.
SHARE = (5, 100)
SEED = 42
#: Gains, scores and noise are thousandths of a natural logarithm, rounded down.
UNIT = 1000

#: Bytes of words ([^\x00-\x2F\x3A-\x60\x7B-\x7F], A-Z in lower case) stay, all others become spaces.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)
_POLYNOMIAL = 0xEDB88320
_SHORT = 256  # moves over fewer bytes are looked up at once


def _kind(buckets: int) -> str:
    return "<u4" if buckets > 1 << 16 else "<u2"


def words_of(body: bytes) -> list[bytes]:
    return body.translate(_WORD_BYTES).split()


def _step_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ np.where(table & np.uint32(1), np.uint32(_POLYNOMIAL), np.uint32(0))
    return table


class Shift:
    """CRCs moved over any number of bytes: multiplication by a power of x in GF(2)[x], byte by byte from tables."""

    def __init__(self):
        self.step = _step_table()
        move = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
        moves = [move]
        for _ in range(_SHORT):
            move = (move >> np.uint32(8)) ^ self.step[move & np.uint32(255)]
            moves.append(move)
        self.short = np.stack(moves[:_SHORT])
        self.powers = [moves[_SHORT]]  # over 256, 512, 1024, ... bytes

    def over_space(self, crcs: np.ndarray) -> np.ndarray:
        """CRCs of texts with one space more."""
        return ~(((~crcs) >> np.uint32(8)) ^ self.step[(~crcs ^ np.uint32(0x20)) & np.uint32(255)])

    def over(self, crcs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """CRCs moved over so many bytes each."""
        low, high = lengths & (_SHORT - 1), lengths >> 8
        moved = np.zeros_like(crcs)
        for k in range(4):
            moved ^= self.short[low, k, (crcs >> np.uint32(8 * k)) & np.uint32(255)]
        bit = 0
        while (high >> bit).any():
            if bit == len(self.powers):
                last = self.powers[-1]
                self.powers.append(self._apply(last, last))
            far = np.flatnonzero((high >> bit) & 1)
            moved[far] = self._apply(self.powers[bit], moved[far])
            bit += 1
        return moved

    @staticmethod
    def _apply(tables: np.ndarray, crcs: np.ndarray) -> np.ndarray:
        out = np.zeros_like(crcs)
        for k in range(4):
            out ^= tables[k][(crcs >> np.uint32(8 * k)) & np.uint32(255)]
        return out


def gram_crcs(words: list[bytes], shift: Shift, longest: int = LONGEST) -> list[np.ndarray]:
    """CRC-32 of every run of 1 to `longest` words joined by a space, by length of run, in order."""
    n = len(words)
    if not n:
        return [np.zeros(0, dtype=np.uint32)] * longest
    # One pass over the text: CRC of every prefix that ends with a word.
    texts = [words[0], *[b" " + w for w in words[1:]]]
    ends = np.fromiter(accumulate(texts, lambda crc, text: crc32(text, crc), initial=0), dtype=np.uint32, count=n + 1)[1:]
    last = np.cumsum(np.fromiter(map(len, texts), dtype=np.int64, count=n))  # end of each word in the text
    first = np.concatenate(([0], last[:-1] + 1))
    before = np.concatenate((np.zeros(1, np.uint32), shift.over_space(ends[:-1])))  # CRC of what precedes each word
    return [ends[k:] ^ shift.over(before[: n - k], last[k:] - first[: n - k]) if n > k else np.zeros(0, np.uint32) for k in range(longest)]


def features(df: DataFrame, id_col: str, text_col: str, longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """(id, n_words, buckets) of every row, written: the buckets of all n-grams as little-endian 32-bit numbers.

    Texts are read here only; counts and weights both come from what is written. A null text has no words.
    """
    def start():
        shift = Shift()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts, found = [], []
            for body in batch.column(1):
                words = words_of(body.as_py())
                counts.append(len(words))
                crcs = np.concatenate(gram_crcs(words, shift, longest))
                found.append((crcs % np.uint32(buckets)).astype(_kind(buckets)).tobytes())
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(found, pa.binary())], ["id", "n_words", "buckets"])

        return step

    rows = keyed_texts(df, id_col, text_col)
    schema = T.StructType([rows.schema["id"], *T._parse_datatype_string("n_words long, buckets binary").fields])
    return written(rows.mapInArrow(per_batch(start), schema), "ngrams")


def counts(found: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features of all rows by bucket. A task adds up its rows before anything is shuffled."""
    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for body in batch.column(0):
                total += np.bincount(np.frombuffer(body.as_buffer() or b"", dtype=_kind(buckets)), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    return found.select("buckets").mapInArrow(tally, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Gain of each bucket; the counts of the two corpora by bucket are all that reaches the driver."""
    both = np.zeros((2, buckets))
    for row, table in enumerate((raw, target)):
        for r in table.toLocalIterator():
            both[row, r.bucket] = r.n
    (s, t), (all_s, all_t) = both, both.sum(axis=1)
    return np.floor(UNIT * np.log((t + 1) * (all_s + buckets) / ((s + 1) * (all_t + buckets)))).astype(np.int64)


def weights(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """(id, n_words, n_features, weight) of every row; the weight is the sum of its features' gains."""
    kind = np.dtype(_kind(len(gain)))

    def start():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            sizes, total = [], []
            for body in batch.column(2):
                buckets = np.frombuffer(body.as_buffer() or b"", dtype=kind)
                sizes.append(len(buckets))
                total.append(int(gain[buckets].sum()))
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(total, pa.int64())], ["id", "n_words", "n_features", "weight"])

        return step

    schema = T.StructType([found.schema["id"], *T._parse_datatype_string("n_words long, n_features long, weight long").fields])
    return found.mapInArrow(per_batch(start), schema)


def noise(key: Column, seed: int = SEED) -> Column:
    """Gumbel noise of a row from the hash of its id, in thousandths, rounded down."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-float(UNIT)) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def _drawn(rows: DataFrame, able: Column, take: int) -> DataFrame:
    """The rows with rank 1, 2, 3 ... for the `take` able ones of the highest score, null for the others.

    Scores fall into bins, of which only as many as hold enough rows are sorted, by ranges over all tasks; a row's rank is
    its place in its range and the rows of the ranges before. Bin and range counts are all that reaches the driver.
    """
    none = rows.withColumn("rank", F.lit(None).cast("long"))
    if not take:
        return none
    width = 256
    bins = rows.where(able).groupBy(F.floor(F.col("score") / width).alias("bin")).count().toLocalIterator()
    left, least = take, None
    for r in sorted(bins, key=lambda r: -r["bin"]):
        least, left = r["bin"], left - r["count"]
        if left <= 0:
            break
    high = able & (F.floor(F.col("score") / width) >= least)
    order = [F.desc("score"), F.asc_nulls_last("id"), F.asc("n_features"), F.asc("weight")]
    # Salted, so that rows equal in all of these still part; written, so that a range stays what it was.
    dealt = rows.where(high).withColumn("salt", F.xxhash64(F.monotonically_increasing_id())).repartitionByRange(*order, F.asc("salt"))
    placed = dealt.sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()).withColumn("part", F.spark_partition_id())
    placed = written(placed, "by-score")
    parts = placed.groupBy("part").agg(F.min("place").alias("first"), F.count("*").alias("rows"))
    starts = parts.select("part", "first", (F.sum("rows").over(Window.orderBy("part")) - F.col("rows")).alias("before"))
    ranked = placed.join(F.broadcast(starts), "part").withColumn("rank", F.col("place") - F.col("first") + F.col("before") + 1)
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= take, F.col("rank"))).select(*rows.columns, "rank")
    return none.where(~high).unionByName(ranked)


def resample(
    df: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text",
    longest: int = LONGEST, buckets: int = BUCKETS, least_words: int = LEAST_WORDS, share: tuple[int, int] = SHARE, seed: int = SEED,
) -> DataFrame:
    """(id, n_features, weight, score, rank) of every row: which documents resemble the target corpus more than the others do.

    A bucket's gain is the log ratio of its smoothed share in the target to that in all documents; a document's weight is
    the sum over its n-grams, its score the weight with Gumbel noise from its id, and the highest scores are drawn.
    A null or empty text has no features and weight 0. A null id counts as empty for the noise and comes last in ties.
    Repeated rows are each counted and ranked. With no target texts gains follow the smoothing alone; with no documents
    there is no row. Other columns are not read.
    """
    found = features(df, id_col, text_col, longest, buckets)
    aimed = features(target, target.columns[0], target_text, longest, buckets)
    gain = gains(counts(found, buckets), counts(aimed, buckets), buckets)
    scored = weights(found, gain).withColumn("score", F.col("weight") + noise(F.col("id"), seed))
    rows = written(scored, "weighed")
    able = F.col("n_words") >= least_words
    take = share[0] * rows.where(able).count() // share[1]
    return _drawn(rows, able, take).select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank")
