"""Vectors in blocks, for search.

The query set is read a bounded batch at a time (``batches``: ``QUERY_BYTES`` of
vectors) and broadcast. Candidates are scanned where they stand, and a task keeps
the best ``k`` of each query, so no row is made for a (query, candidate) pair and no vector is
copied for a query; a window with a group limit merges the tasks' bests. Where queries meet
only some candidates (``block_pairs``), blocks of about ``BLOCK`` rows of each side are one group
of a cogrouped step, so a hot bucket is many groups, and a task holds two blocks at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage_counted, workers_import

BLOCK = 4096
BLOCK_VALUES = 1 << 21  # components in a block, where vectors are long
QUERY_BYTES = 64 << 20


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """``(row, id, v)`` of the rows that take part - with an id, and a vector of finite
    components without nulls - written to the staging folder, and their number.
    ``row`` tells repeated ids apart."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & ~bad)
    return stage_counted(rows.withColumn("row", F.monotonically_increasing_id()), "vec-rows")


def block_rows(dim: int) -> int:
    return max(1, min(BLOCK, BLOCK_VALUES // max(1, dim)))


def blocks_of(rows, dim: int = 1):
    """Number of blocks for a number of rows (a Column or an int) of ``dim`` components."""
    return F.greatest(F.lit(1), F.ceil(rows / F.lit(block_rows(dim)))).cast("int")


def batches(queries: DataFrame) -> Iterator[tuple[DataFrame, pa.Table]]:
    """The staged ``queries(row, id, v)`` in parts whose vectors take about ``QUERY_BYTES``: as frames and read."""
    size = queries.agg(F.sum(8 * F.size("v") + 32)).first()[0]
    n = -(-int(size or 0) // QUERY_BYTES)
    for i in range(n):
        some = queries.where(F.pmod(F.xxhash64("row"), F.lit(n)) == i)
        yield some, some.toArrow()


def block_pairs(queries: DataFrame, candidates: DataFrame, keys: list[str], step, schema: str) -> DataFrame:
    """Cogroups ``queries(row)`` and ``candidates(row, id, v)``, both with ``keys``, ``q_blocks`` and ``c_blocks``,
    by key and pair of blocks and applies ``step(queries, candidates)`` to each."""
    workers_import(queries.sparkSession)
    own, every = F.pmod(F.xxhash64("row"), F.col("q_blocks")).cast("int").alias("qb"), F.sequence(F.lit(0), F.col("c_blocks") - 1)
    left = queries.select(*keys, "row", own, F.explode(every).alias("cb"))
    own, every = F.pmod(F.xxhash64("row"), F.col("c_blocks")).cast("int").alias("cb"), F.sequence(F.lit(0), F.col("q_blocks") - 1)
    right = candidates.select(*keys, "row", "id", "v", F.explode(every).alias("qb"), own)
    by = [*keys, "qb", "cb"]
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(step, schema)


def table_vectors(table: pa.Table) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Row numbers, ids and vectors of a block."""
    v = table.column("v").combine_chunks()
    values = v.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    ends = np.cumsum(np.diff(v.offsets.to_numpy()))
    return table.column("row").to_numpy(), table.column("id").to_numpy(), np.split(values, ends)[:-1]


def best_of(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each query ``row``, ties to the smaller id, numbered from 1."""
    best = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id", "vec_row")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def falling(scores: np.ndarray) -> np.ndarray:
    """Values in the opposite order, the least integer included."""
    return ~scores if scores.dtype == np.int64 else -scores


def top_rows(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` largest scores, ties to the smaller id: a partition, then a sort of what reaches its bound."""
    if len(score) > k:
        bound = np.partition(score, len(score) - k)[len(score) - k]
        near = np.flatnonzero(score >= bound)
    else:
        near = np.arange(len(score))
    return near[np.lexsort((ids[near], falling(score[near])))][:k]


class Bests:
    """The ``k`` best candidates so far of each query of a batch, ties to the smaller id, then the smaller row."""

    def __init__(self, queries: int, k: int, score):
        self.k = k
        self.row, self.id = np.full((queries, k), -1, np.int64), np.full((queries, k), -1, np.int64)
        self.score, self.n = np.zeros((queries, k), score), np.zeros(queries, np.int64)

    def add(self, q: int, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        m = self.n[q]
        rows, ids, scores = (np.concatenate([x[q, :m], y]) for x, y in ((self.row, rows), (self.id, ids), (self.score, scores)))
        best = np.lexsort((rows, ids, falling(scores)))[: self.k]
        m = self.n[q] = len(best)
        self.row[q, :m], self.id[q, :m], self.score[q, :m] = rows[best], ids[best], scores[best]

    def least(self, q: int):
        """The score that a further candidate must reach, if ``k`` are there."""
        return self.score[q, self.k - 1] if self.n[q] == self.k else None

    def table(self, q_row: np.ndarray, q_id: np.ndarray) -> pa.RecordBatch:
        on = np.arange(self.k) < self.n[:, None]
        q = np.repeat(np.arange(len(q_row)), self.n)
        columns = [q_row[q], q_id[q], self.row[on], self.id[on], self.score[on]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["row", "query_id", "vec_row", "vec_id", "score"])
