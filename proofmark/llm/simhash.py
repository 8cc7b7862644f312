"""SimHash near-duplicates: fingerprints, an inverted index over positional bytes, links at few differing bits."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from proofmark.llm.common import col, fresh, per_batch, split_bytes, written
from proofmark.llm.components import connected_components

SHINGLE = 3
#: Fingerprints link at so many differing bits or fewer.
MOST_BITS = 2
BYTES = 8
SEED = 42


def fingerprint(body: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the words of a UTF-8 text, lower-cased in ASCII; without words, zero.

    A bit is set if more than half of the shingles' hashes have it. Long texts go through in pieces.
    """
    ones = np.zeros(64, dtype=np.int64)
    count, tail = 0, []
    for piece in split_bytes(body.lower()):
        words = tail + piece.split()
        if len(words) >= shingle:
            hashes = _hashes(words, shingle)
            for start in range(0, len(hashes), 8192):
                part = hashes[start : start + 8192]
                ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
            count += len(hashes)
        tail = words[len(words) - shingle + 1 :] if len(words) >= shingle else words
    if not count:
        if not tail:
            return 0
        return xxhash.xxh64_intdigest(b" ".join(tail), SEED)
    bits = (ones * 2 > count).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def _hashes(words: list[bytes], shingle: int) -> np.ndarray:
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    digest = xxhash.xxh64_intdigest
    n = len(words) - shingle + 1
    pairs = zip(starts[:n].tolist(), (ends[shingle - 1 :] - 1).tolist())
    return np.fromiter((digest(joined[a:b], SEED) for a, b in pairs), dtype=np.uint64, count=n)


def fingerprints(df: DataFrame, text_col: str, name: str) -> DataFrame:
    """The table with the fingerprint of its text as a further column, a signed 64-bit number. A null text has no words."""
    def start():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column(batch.schema.names.index(text_col)).to_pylist()
            found = np.array([fingerprint(t.encode("utf-8", "replace") if isinstance(t, str) else t or b"") for t in texts], dtype=np.uint64)
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(found.view(np.int64))], [*batch.schema.names, name])

        return step

    return df.mapInArrow(per_batch(start), T.StructType([*df.schema.fields, T.StructField(name, T.LongType())]))


def links(distinct: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints that differ in at most `most_bits` bits.

    Such a pair shares at least 8 - most_bits of its 8 bytes at their places. The index files a fingerprint under every
    choice of that many places, so a posting holds only fingerprints that already reach the guaranteed number of
    shared bytes, and at most 65,536 of them for two bits; the tally of shared bytes and the bits then decide.
    Both sides are shuffled at every size: to the planner the index is as large as its fingerprints before they are
    filed under all choices, so it would broadcast an index many times its limit.
    """
    sure = BYTES - most_bits
    masks = [sum(0xFF << (8 * place) for place in places) for places in combinations(range(BYTES), sure)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    filed = distinct.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in signed])).alias("places", "value"))
    a = filed.select("places", "value", F.col("fp").alias("a"))
    b = filed.select("places", "value", F.col("fp").alias("b"))
    differing = F.col("a").bitwiseXOR(F.col("b"))
    shared = sum((differing.bitwiseAND(F.lit(m)) == 0).cast("int") for m in [0xFF << (8 * i) for i in range(7)] + [-(1 << 56)])
    return (
        a.join(b.hint("merge"), ["places", "value"])
        .where((F.col("a") < F.col("b")) & (shared >= sure) & (F.bit_count(differing) <= most_bits))
        .select("a", "b")
        .distinct()
    )


def names(prints: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """(fp, named): the first row of the component of a fingerprint, for fingerprints of more than one row or with a link.

    Takes (id, row, fp), row being a number of its own for every row. Rows are ordered by id, nulls last, then by row.
    Equal fingerprints are one node of the graph, so copies are never paired.
    """
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row"))
    groups = written(prints.groupBy("fp").agg(first.alias("least"), F.count("*").alias("rows")), "groups")
    roots = connected_components(links(groups.select("fp"), most_bits))
    # Files hold a fingerprint in far fewer bytes than a broadcast does, the more so where many have one root or name.
    rooted = written(roots.join(groups.hint("merge"), roots.node == groups.fp).select("fp", "root", "least"), "rooted")
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("named")), "root").select("fp", "named")
    found = groups.join(named, "fp", "left").where("named IS NOT NULL OR rows > 1")
    return written(found.select("fp", F.coalesce("named", "least").alias("named")), "names")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_bits: int = MOST_BITS) -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits), component_id (the smallest id that links reach, its own included).

    Texts without words, nulls among them, share the fingerprint zero. Repeated rows stay; an empty table gives none; a
    null id takes part, but names a component only if all its ids are null. Other columns are not read.
    """
    narrow = df.select(F.monotonically_increasing_id().alias("row"), col(id_col).alias("id"), col(text_col).cast("string").alias("text"))
    prints = written(fingerprints(narrow, "text", "fp").drop("text"), "fingerprints")
    return prints.join(names(prints, most_bits).hint("merge"), "fp", "left").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.coalesce(F.col("named.id"), "id").alias("component_id")
    )


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_bits: int = MOST_BITS) -> DataFrame:
    """The table with one row of every near-duplicate group: the one of the smallest id, and one only where that id repeats."""
    row, fp = fresh(df, "row"), fresh(df, "fp")
    prints = written(fingerprints(df.withColumn(row, F.monotonically_increasing_id()), text_col, fp), "fingerprints")
    found = names(prints.select(col(id_col).alias("id"), col(row).alias("row"), col(fp).alias("fp")), most_bits)
    later = found.select(F.col("fp").alias(fp + "_named"), F.col("named.row").alias(row + "_named"))
    joined = prints.join(later, prints[fp] == F.col(fp + "_named"), "left")
    return joined.where(F.col(row + "_named").isNull() | (F.col(row + "_named") == col(row))).select(*[col(c) for c in df.columns])
