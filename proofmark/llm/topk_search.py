"""Exact top-k by integer inner product over a bit-sliced index.

The index holds vectors in blocks. In a block each component is a set of bitmaps, one for each binary digit of the
component less its least value in the block, with one bit a vector. A query multiplies by adding: every digit of a
query's component adds that component's bitmaps at the digit's place (their complements for a negative component, which
moves all scores of the block by one constant). Full adders over whole columns of bitmaps leave one bitmap for each
digit of the score. The best rows are read off from the most significant bitmap down; where the k-th place falls among
equal scores, the rows on that boundary are settled by id, and scores are worked out exactly for the rows that remain.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from proofmark.llm.common import col, written
from proofmark.session import scratch_path

#: Components are multiplied by this and rounded down.
SCALE = 1024
#: Vectors of a block: its bitmaps are words of 64 vectors.
BLOCK_ROWS = 8192
#: Bytes of query vectors in a stored part, and stored parts that are broadcast at a time.
PART_BYTES = 2 << 20
PARTS = 4
#: Blocks meet the queries of a round in about so many tasks where there are fewer blocks than that, a task having this many queries.
TASKS = 64
TASK_QUERIES = 64

_WORD = 64


class Block:
    """Up to BLOCK_ROWS vectors as bitmaps."""

    def __init__(self, ids: np.ndarray, known: np.ndarray, vectors: np.ndarray):
        if np.abs(vectors).max(initial=0) >= 1 << 53:
            raise ValueError("components of these vectors do not fit into 53 bits")
        self.ids, self.known, self.rows, self.dims = ids, known, len(ids), vectors.shape[1]
        self.least = vectors.min(axis=0)
        above = vectors - self.least
        widths = [int(m).bit_length() for m in above.max(axis=0)]
        self.place = np.repeat(np.arange(self.dims), widths)
        self.digit = np.concatenate([np.arange(w) for w in widths] or [np.zeros(0)]).astype(np.int64)
        self.words = -(-self.rows // _WORD)
        bits = np.zeros((len(self.place), self.words * _WORD), dtype=np.uint8)
        for r, (d, j) in enumerate(zip(self.place, self.digit)):
            bits[r, : self.rows] = (above[:, d] >> j) & 1
        self.maps = np.packbits(bits, axis=1, bitorder="little").view(np.uint64).reshape(len(self.place), self.words)

    def both(self) -> np.ndarray:
        """The bitmaps and then their complements."""
        return np.concatenate([self.maps, ~self.maps])

    def rows_of(self, bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little")[: self.rows])

    def all_rows(self) -> np.ndarray:
        bits = np.zeros(self.words * _WORD, dtype=np.uint8)
        bits[: self.rows] = 1
        return np.packbits(bits, bitorder="little").view(np.uint64)

    def scores(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Inner products of some rows, from their own bits."""
        bits = (self.maps[:, rows // _WORD] >> (rows % _WORD).astype(np.uint64)) & np.uint64(1)
        weight = query[self.place] << self.digit
        return weight @ bits.astype(np.int64) + int(query @ self.least)


def column_sums(columns: list[np.ndarray]) -> list[np.ndarray]:
    """One bitmap for each binary digit of the sums, least significant first; columns[c] holds the bitmaps that count 2**c."""
    digits, c = [], 0
    columns = list(columns)
    while c < len(columns):
        maps = columns[c]
        carried = []
        while len(maps) > 2:
            third = len(maps) // 3
            x, y, z = maps[:third], maps[third : 2 * third], maps[2 * third : 3 * third]
            half = x ^ y
            carried.append((x & y) | (half & z))
            maps = np.concatenate([half ^ z, maps[3 * third :]])
        if len(maps) == 2:
            carried.append((maps[0] & maps[1])[None, :])
            maps = (maps[0] ^ maps[1])[None, :]
        digits.append(maps[0] if len(maps) else None)
        if carried:
            if c + 1 == len(columns):
                columns.append(carried[0][:0])
            columns[c + 1] = np.concatenate([columns[c + 1], *carried])
        c += 1
    return digits


def highest(digits: list[np.ndarray], among: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Rows surely among the k highest, rows that tie at the k-th place, and how many of these belong to them."""
    sure, open_ = np.zeros_like(among), among.copy()
    if int(np.bitwise_count(open_).sum()) <= k:
        return open_, sure, 0
    for digit in reversed(digits):
        if digit is None:
            continue
        tried = sure | (open_ & digit)
        n = int(np.bitwise_count(tried).sum())
        if n > k:
            open_ &= digit
        elif n < k:
            sure, open_ = tried, open_ & ~digit
        else:
            return tried, np.zeros_like(among), 0
    return sure, open_, k - int(np.bitwise_count(sure).sum())


def search(block: Block, both: np.ndarray, everyone: np.ndarray, own: int | None, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and scores of the k best of a block for one query, ties to the smaller id, no id last."""
    dims = max(block.dims, len(query))
    if dims > block.dims:  # components the block lacks are zero there
        query = query[: block.dims]
    elif dims > len(query):
        query = np.concatenate([query, np.zeros(dims - len(query), dtype=np.int64)])
    size, rows = np.abs(query)[block.place], len(block.place)
    negative = (query < 0)[block.place]
    source = np.arange(rows) + rows * negative
    top = (int(size.max()).bit_length() if rows else 0) + (int(block.digit.max()) if rows else 0)
    columns = []
    for c in range(top):
        shift = c - block.digit
        here = (shift >= 0) & ((size >> np.maximum(shift, 0)) & 1 == 1)
        columns.append(both[source[here]])
    among = everyone
    if own is not None:
        mine = np.flatnonzero((block.ids == own) & block.known)
        if len(mine):
            among = everyone.copy()
            np.bitwise_and.at(among, mine // _WORD, ~(np.uint64(1) << (mine % _WORD).astype(np.uint64)))
    sure, tied, missing = highest(column_sums(columns), among, k)
    found = block.rows_of(sure)
    if missing:
        rest = block.rows_of(tied)
        found = np.concatenate([found, rest[np.lexsort((block.ids[rest], ~block.known[rest]))][:missing]])
    return found, block.scores(found, query)


def quantised(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """Ids and whole-number vectors of the rows whose vector is whole: no nulls, no NaN, no infinity."""
    def bad(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    values = F.transform(col(vector_col), lambda x: x.cast("double"))
    given = df.select(col(id_col).cast("long").alias("id"), values.alias("x")).where(F.col("x").isNotNull() & ~F.exists("x", bad))
    return given.select("id", F.transform("x", lambda x: F.floor(x * F.lit(float(scale))).cast("long")).alias("q"))


def _matrix(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids (0 for null), which ids are known, and vectors, shorter ones filled up with zeros."""
    ids, lists = batch.column(0), batch.column(1)
    known = ids.is_valid().to_numpy(zero_copy_only=False)
    numbers = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.asarray(pa.compute.list_value_length(lists).fill_null(0)).astype(np.int64)
    matrix = np.zeros((len(sizes), int(sizes.max(initial=0))), dtype=np.int64)
    if sizes.sum():
        matrix[np.arange(matrix.shape[1])[None, :] < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return numbers, known, matrix


def _joined(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    dims = max(m.shape[1] for _, _, m in parts)
    wide = [np.pad(m, ((0, 0), (0, dims - m.shape[1]))) for _, _, m in parts]
    return np.concatenate([i for i, _, _ in parts]), np.concatenate([k for _, k, _ in parts]), np.concatenate(wide)


def _gathered(full: Callable[[int, int], bool], make: Callable[..., object]) -> Callable:
    """A mapInArrow function that gathers rows (id, q) until full(rows, bytes) and gives one pickled object for them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, size = [], 0, 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([rows], pa.int64()), pa.array([pickle.dumps(make(*_joined(held)))], pa.binary())], ["rows", "body"])

        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = _matrix(batch.slice(start, 1024))
                held.append(part)
                rows, size = rows + len(part[0]), size + part[2].nbytes
                if full(rows, size):
                    yield out()
                    held, rows, size = [], 0, 0
        if held:
            yield out()

    return run


def index(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The bit-sliced index of a table, written: one row (rows, body) a block, of about block_rows vectors.

    Vectors that are null or hold null, NaN or infinity have no place in it. Every other row has one, repeated rows each
    their own. An empty table gives no block.
    """
    narrow = written(quantised(df, id_col, vector_col, scale), "quantised")
    blocks = -(-max(narrow.count(), 1) // block_rows)
    # Dealt in turn, not by a key: neither a repeated id nor a repeated vector makes a block larger.
    dealt = narrow.repartition(blocks)
    return written(dealt.mapInArrow(_gathered(lambda rows, _: rows >= block_rows, Block), "rows long, body binary"), "bit-slices")


def _searcher(shared, spread: int, k: int, skip_self: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, known, vectors = shared.value
        limit = int(np.abs(vectors).max(initial=0))
        for batch in batches:
            for body, part in zip(batch.column(0), batch.column(1)):
                block = pickle.loads(body.as_py())
                reach = max((abs(int(x)) + (1 << int(w)) for x, w in zip(block.least, np.bincount(block.place, minlength=block.dims))), default=0)
                if limit * reach * max(block.dims, 1) >= 1 << 62:
                    raise ValueError("inner products of these vectors do not fit into 64 bits")
                both, everyone = block.both(), block.all_rows()
                q, v, known_v, s = [], [], [], []
                for n in range(part.as_py(), len(ids), spread):
                    own = int(ids[n]) if skip_self and known[n] else None
                    rows, scores = search(block, both, everyone, own, vectors[n], k)
                    q.append(np.full(len(rows), n))
                    v.append(block.ids[rows])
                    known_v.append(block.known[rows])
                    s.append(scores)
                if q:
                    at = np.concatenate(q)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(at), pa.array(ids[at], mask=~known[at]), pa.array(np.concatenate(v), mask=~np.concatenate(known_v)), pa.array(np.concatenate(s)),
                    ], ["q", "query_id", "vec_id", "score"])

    return run


def top_k(
    queries: DataFrame, blocks: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE, skip_self: bool = True,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row the k rows of the index with the highest integer inner product.

    Ties go to the smaller vec_id, a null id last. With skip_self, rows of the query's own id are no candidates; a query
    without an id meets every row. Fewer candidates than k: all of them. A repeated query row is a query of its own.
    Vectors that are null or hold null, NaN or infinity ask nothing; a shorter vector counts as filled up with zeros.
    Other columns are not read. Without queries or without an index there is no row.

    Queries are broadcast in rounds of PARTS * PART_BYTES bytes, whatever their number. Each block returns its best k
    of each query, and the best of those are ranked.
    """
    spark = blocks.sparkSession
    asked = quantised(queries, id_col, vector_col, scale)
    stored = written(asked.mapInArrow(_gathered(lambda _, size: size >= PART_BYTES, lambda *given: given), "rows long, body binary"), "queries")
    path = scratch_path(spark, f"topk-{uuid.uuid4().hex}")
    schema = "q long, query_id long, vec_id long, score long"
    spark.createDataFrame([], schema).write.parquet(f"{path}/round=-1")
    n_blocks = blocks.count()
    rounds, held = 0, []

    def ask() -> None:
        shared = spark.sparkContext.broadcast(_joined(held))
        spread = max(1, min(-(-TASKS // max(n_blocks, 1)), -(-len(shared.value[0]) // TASK_QUERIES)))
        met = blocks.select("body", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("part"))
        if spread > 1:  # few blocks, so copying them is bounded
            met = met.repartition(n_blocks * spread)
        met.mapInArrow(_searcher(shared, spread, k, skip_self), schema).write.parquet(f"{path}/round={rounds}")
        shared.unpersist()

    for row in stored.select("body").toLocalIterator():
        held.append(pickle.loads(row.body))
        if len(held) == PARTS:
            ask()
            rounds, held = rounds + 1, []
    if held:
        ask()
    found = spark.read.schema(schema + ", round int").parquet(path)
    best = Window.partitionBy("round", "q").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
