"""Nearest-neighbour retrieval without a cross join.

Both variants score blocks of vectors as one matrix product inside a task and let only the best ``k`` of each query leave it:

* ``vector_topk``: queries and index are cut into bounded blocks that meet in a grid, by the same plan at every size; every query
  block meets every index block, queries x index by nature.
* ``inverted_file`` and ``vector_topk_approx``: each vector is filed once under its closest centroid. A query looks into as many of its
  closest cells as held-out vectors needed to find the stated share of their true neighbours.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from proofmark.session import scratch_path, written

BLOCK_ROWS = 20_000
#: Vectors of a block that are scored at a time.
TILE = 2048
TOPK_SCHEMA = "query_id BIGINT, vec_id BIGINT, score DOUBLE"


def _unit(vectors) -> np.ndarray:
    matrix = np.stack(list(vectors)).astype(np.float64)
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(norms == 0, 1.0, norms)


Triples = tuple[np.ndarray, np.ndarray, np.ndarray]  # query ids, vector ids, scores


def _cut(found: Triples, k: int) -> Triples:
    """The best ``k`` per query, by score, then by lower id."""
    q, v, s = found
    order = np.lexsort((v, -s, q))
    q, v, s = q[order], v[order], s[order]
    first = np.concatenate(([True], q[1:] != q[:-1])) if len(q) else np.zeros(0, bool)
    starts = np.flatnonzero(first)
    place = np.arange(len(q)) - np.repeat(starts, np.diff(np.append(starts, len(q))))
    keep = place < k
    return q[keep], v[keep], s[keep]


def _best(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, index: np.ndarray, k: int, skip_self: bool) -> Triples:
    """The best ``k`` of one block of the index for every query, by matrix products."""
    parts = []
    for start in range(0, len(query_ids), 256):
        part = query_ids[start : start + 256]
        found = part[:0], ids[:0], np.zeros(0)
        # Scores are held for TILE vectors at a time, and the best so far: room does not follow the block, nor the copies in it.
        for first in range(0, len(ids), TILE):
            own = ids[first : first + TILE]
            scores = np.round(queries[start : start + 256] @ index[first : first + TILE].T, 9)
            if skip_self:
                scores[part[:, None] == own[None, :]] = -np.inf
            nth = max(scores.shape[1] - k, 0)
            floor = np.partition(scores, nth, axis=1)[:, nth]
            rows, cols = np.nonzero((scores >= floor[:, None]) & (scores > -np.inf))  # ties at the floor included
            new = part[rows], own[cols], scores[rows, cols]
            found = _cut(tuple(np.concatenate(column) for column in zip(found, new)), k)
        parts.append(found)
    return tuple(np.concatenate(column) for column in zip(*parts))


def _frame(found: Triples) -> pd.DataFrame:
    return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), found)))


def _rank(candidates: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return candidates.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def vector_topk(
    queries: DataFrame, index: DataFrame, k: int = 3, dim: int = 64, skip_self: bool = False, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Exact ``k`` nearest by cosine. Frames hold ``query_id, embedding`` and ``vec_id, embedding``."""
    one_cell = F.array(F.lit(0))
    return _rank(_grid(queries.withColumn("cells", one_cell), index.withColumn("cells", one_cell), k, skip_self, block_rows), k)


#: Cells of an inverted file are about the root of its vectors, and at most so many, which bounds what is broadcast.
MOST_CELLS = 16_384
#: Centroids are fitted on about so many vectors a cell, picked by the hash of their ids, in so many rounds.
SAMPLE_PER_CELL = 64
FIT_ROUNDS = 3
#: Cells are probed until this share of the true neighbours of held-out vectors lies in them.
RECALL = 0.95
HELD_OUT = 200
#: Queries that are broadcast at a time.
ROUND_QUERIES = 16_384


def _hash_share(name: str, salt: str) -> Column:
    """An even number from 0 to 1 for a row, from the hash of its id."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(salt), F.col(name).cast("string"))), 1, 8), 16, 10).cast("double") / 4294967296


def _closeness(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.round(vectors @ centroids.T, 9)


def _nearest(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The closest centroid of each vector, the first of equals."""
    return np.concatenate([_closeness(vectors[i : i + 1024], centroids).argmax(axis=1) for i in range(0, max(len(vectors), 1), 1024)])


@dataclass
class InvertedFile:
    """Vectors filed under their closest centroid, each once, and the number of closest cells that a query looks into."""

    filed: DataFrame  # cell, vec_id, embedding; written in the order of cells
    centroids: np.ndarray
    probes: int

    def cells_of(self, vectors: np.ndarray) -> np.ndarray:
        """The cells to look into, closest first, for each unit vector."""
        if not self.probes:  # nothing is filed
            return np.zeros((len(vectors), 0), dtype=np.int64)
        return np.argsort(-_closeness(vectors, self.centroids), axis=1, kind="stable")[:, : self.probes]


def _moved(sample: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids in the middle of the vectors closest to them; one that no vector is closest to stays."""
    shared = sample.sparkSession.sparkContext.broadcast(centroids)

    def totals(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = shared.value
        total = np.zeros_like(held)
        for batch in batches:
            if len(batch):
                vectors = _unit(batch["embedding"])
                np.add.at(total, _nearest(vectors, held), vectors)
        some = np.flatnonzero(np.abs(total).sum(axis=1))
        if len(some):
            yield pd.DataFrame({"cell": some, "total": list(total[some])})

    def added(parts: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"cell": parts["cell"].iloc[:1], "total": [np.stack(list(parts["total"])).sum(axis=0)]})

    schema = "cell BIGINT, total ARRAY<DOUBLE>"
    out = centroids.copy()
    for row in sample.mapInPandas(totals, schema).groupBy("cell").applyInPandas(added, schema).collect():  # one row a cell
        out[row.cell] = _unit([row.total])[0].round(6)
    shared.unpersist()
    return out


def inverted_file(index: DataFrame, k: int = 3, recall: float = RECALL, cells: int | None = None) -> InvertedFile:
    """Fit an inverted file on ``vec_id, embedding`` and file every vector.

    Centroids come from a few rounds of spherical k-means on a sample that is chosen by hash, SAMPLE_PER_CELL vectors a cell.
    The number of probes is the least that holds the share ``recall`` of the true ``k`` neighbours of HELD_OUT vectors, which are
    looked up exactly. Vectors that are null are not filed; a zero vector is filed like any other.
    """
    index = index.where("embedding IS NOT NULL").select("vec_id", "embedding")
    spark = index.sparkSession
    rows = index.count()
    cells = cells or max(1, min(MOST_CELLS, math.ceil(math.sqrt(rows))))
    first = index.orderBy(F.md5(F.col("vec_id").cast("string"))).limit(cells).collect()
    if not first:
        return InvertedFile(index.select(F.lit(0).alias("cell"), "vec_id", "embedding"), np.zeros((0, 0)), 0)
    centroids = _unit([r.embedding for r in first]).round(6)
    sample = index.where(_hash_share("vec_id", "s") < min(1.0, SAMPLE_PER_CELL * cells / rows))
    for _ in range(FIT_ROUNDS):
        centroids = _moved(sample, centroids)

    shared = spark.sparkContext.broadcast(centroids)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch.assign(cell=_nearest(_unit(batch["embedding"]), shared.value))

    placed = index.mapInPandas(place, "vec_id BIGINT, embedding ARRAY<FLOAT>, cell BIGINT").select("cell", "vec_id", "embedding")
    # By cell, then by hash: a cell full of copies is many partitions.
    filed = written(placed.repartitionByRange("cell", F.xxhash64("vec_id")).sortWithinPartitions("cell"), "inverted-file")

    asked = index.orderBy(F.md5(F.concat(F.lit("h"), F.col("vec_id").cast("string")))).limit(HELD_OUT).collect()
    held = spark.createDataFrame([(r.vec_id, list(r.embedding)) for r in asked], "query_id BIGINT, embedding ARRAY<FLOAT>")
    true = vector_topk(held, index, k, skip_self=True).select("query_id", "vec_id")
    met = true.join(filed.select("vec_id", "cell"), "vec_id").select("query_id", "cell").collect()  # k a held-out vector
    order = np.argsort(-_closeness(_unit([r.embedding for r in asked]), centroids), axis=1, kind="stable")
    place_of = {r.vec_id: {int(c): n + 1 for n, c in enumerate(line)} for r, line in zip(asked, order)}
    ranks = sorted(place_of[r.query_id][r.cell] for r in met)
    probes = ranks[math.ceil(recall * len(ranks)) - 1] if ranks else 1
    return InvertedFile(filed, centroids, probes)


def vector_topk_approx(queries: DataFrame, file: InvertedFile, k: int = 3, skip_self: bool = False) -> DataFrame:
    """The ``k`` nearest by cosine among the vectors in the cells a query looks into; scores are exact.

    Queries are broadcast in rounds of ROUND_QUERIES, each with the cells it looks into, so vectors stay where they are filed and
    only a task's best ``k`` of a query are shuffled. Query ids are unique; null vectors ask nothing.
    """
    spark = file.filed.sparkSession
    path = scratch_path(spark, f"probed-{uuid.uuid4().hex}")
    spark.createDataFrame([], TOPK_SCHEMA).write.parquet(f"{path}/round=-1")

    def ask(number: int, held: list) -> None:
        ids, vectors = np.array([r.query_id for r in held], dtype=np.int64), _unit([r.embedding for r in held])
        probed = file.cells_of(vectors)
        cells, who = probed.ravel(), np.repeat(np.arange(len(ids)), probed.shape[1])
        order = np.argsort(cells, kind="stable")
        starts = np.searchsorted(cells[order], np.arange(len(file.centroids) + 1))
        shared = spark.sparkContext.broadcast((ids, vectors, who[order], starts))

        def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            query_ids, asked, waiting, begin = shared.value
            found, rows = [], 0
            for batch in batches:
                for cell, part in batch.groupby("cell"):
                    at = waiting[begin[cell] : begin[cell + 1]]
                    if len(at):
                        best = _best(query_ids[at], asked[at], part["vec_id"].to_numpy(dtype=np.int64), _unit(part["embedding"]), k, skip_self)
                        found, rows = [*found, best], rows + len(best[0])
                if rows > 4 * k * len(query_ids):
                    found = [_cut(tuple(np.concatenate(column) for column in zip(*found)), k)]
                    rows = len(found[0][0])
            if found:
                yield _frame(_cut(tuple(np.concatenate(column) for column in zip(*found)), k))

        file.filed.mapInPandas(score, TOPK_SCHEMA).write.parquet(f"{path}/round={number}")
        shared.unpersist()

    number, held = 0, []
    for row in queries.where("embedding IS NOT NULL").select("query_id", "embedding").toLocalIterator():
        held.append(row)
        if len(held) == ROUND_QUERIES:
            ask(number, held)
            number, held = number + 1, []
    if held:
        ask(number, held)
    return _rank(spark.read.schema(TOPK_SCHEMA).parquet(path), k)


def _grid(queries: DataFrame, index: DataFrame, k: int, skip_self: bool, block_rows: int) -> DataFrame:
    """Score queries against index within each cell, in blocks of about ``block_rows`` rows.

    The number of cells is a parameter of the hash tables, so their sizes may be counted on the
    driver. A cell of n rows is cut into n / block_rows blocks; every query block of a cell meets
    every index block of that cell, and no group exceeds two blocks.
    """
    # Names of their own: both sides may come from one table.
    q = queries.select("query_id", F.col("embedding").alias("asked"), F.explode("cells").alias("cell"))
    v = index.select("vec_id", F.col("embedding").alias("held"), F.explode("cells").alias("cell"))

    sizes = (
        q.select("cell", F.lit(1).alias("q"), F.lit(0).alias("v"))
        .unionByName(v.select("cell", F.lit(0).alias("q"), F.lit(1).alias("v")))
        .groupBy("cell")
        .agg(F.sum("q").alias("q"), F.sum("v").alias("v"))
    )
    cut = [(r.cell, -(-r.q // block_rows), -(-r.v // block_rows)) for r in sizes.where("q > 0 AND v > 0").collect()]
    spark = queries.sparkSession
    plan = F.broadcast(spark.createDataFrame(cut, "cell INT, nq INT, nv INT"))  # one row per cell

    last = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    q_cut = q.join(plan, "cell").select(
        "cell", "query_id", "asked", F.pmod(F.xxhash64("query_id"), F.col("nq")).cast("int").alias("qb"), F.explode(last("nv")).alias("vb")
    )
    v_cut = v.join(plan, "cell").select(
        "cell", "vec_id", "held", F.pmod(F.xxhash64("vec_id"), F.col("nv")).cast("int").alias("vb"), F.explode(last("nq")).alias("qb")
    )

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if len(left) == 0 or len(right) == 0:
            return _frame((np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)))
        return _frame(
            _best(
                left["query_id"].to_numpy(dtype=np.int64), _unit(left["asked"]),
                right["vec_id"].to_numpy(dtype=np.int64), _unit(right["held"]), k, skip_self,
            )
        )

    on = ["cell", "qb", "vb"]
    return q_cut.groupBy(*on).cogroup(v_cut.groupBy(*on)).applyInPandas(score, TOPK_SCHEMA)


def retrieved_documents(spans: DataFrame) -> DataFrame:
    """What retriever spans returned, as rows (trace_id, rank, doc_id, content); ranks from 1 over the trace's spans in order."""
    placed = spans.where(F.col("span_type") == "RETRIEVER").select("trace_id", "start_time_ns", "span_id", F.posexplode("outputs").alias("_at", "_doc"))
    order = Window.partitionBy("trace_id").orderBy("start_time_ns", "span_id", "_at")
    return placed.select(
        "trace_id", F.row_number().over(order).alias("rank"), F.col("_doc.metadata.doc_id").alias("doc_id"), F.col("_doc.page_content").alias("content")
    )


def assemble_context(retrieved: DataFrame, k: int = 3) -> DataFrame:
    """``[doc] text`` lines in rank order, at most ``k`` per record."""
    lines = F.array_sort(F.collect_list(F.struct("rank", F.concat(F.lit("["), "doc_id", F.lit("] "), "content").alias("line"))))
    return (
        retrieved.where(F.col("rank") <= k)
        .groupBy("record_id")
        .agg(lines.alias("_l"))
        .select("record_id", F.array_join(F.transform("_l", lambda x: x["line"]), "\n").alias("context"))
    )
