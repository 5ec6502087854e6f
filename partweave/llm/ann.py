"""Approximate nearest neighbours by multiprobe p-stable hashing.

Vectors are scaled to length 1. A table has ``hashes`` functions
``floor((a . u + b) / width)`` with a Gaussian (2-stable) ``a``; their values are the
bucket. For a neighbour at cosine c of a query, ``a . u`` of the neighbour is
normal around ``c * (a . q)`` with variance ``1 - c * c``: that gives each slot of
each function a probability, and a bucket the product. A query visits buckets
in the order of that estimate - taken one by one from a heap, so only visited ones
are ever made - until their sum reaches ``reach`` in each table; tables' candidates
are merged and reranked by the exact cosine. A probe is a row of ids: queries' vectors are
broadcast, a bounded batch at a time. A query that met fewer than ``k`` candidates though
the table has more is compared with all rows, scanned in place.

``c`` is what the sample shows: the cosine of the k-th neighbour inside a bounded
sample, which is no larger than among all rows, so the estimate errs towards
visiting more. Every row is indexed; nothing caps a bucket: a large one is cut
into blocks of rows that are searched apart (see ``vectors``).
"""

from __future__ import annotations

import copy
import heapq
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partweave.operators.broadcast import checked_broadcast

from .common import U64, as_long, in_arrow, mix64, stage
from .vectors import Bests, batches, best_of, block_pairs, block_rows, blocks_of, table_vectors, usable

TABLES = 2
REACH = 0.85  # estimated share of neighbours that each table's visits find
WIDTH = 2.0
SAMPLE = 4096  # rows that the neighbours' cosine is estimated on
ASKED = 256  # of them, as queries
MOST_HASHES = 16
SCHEMA = "row long, query_id long, vec_row long, vec_id long, score double"


def hashes_for(rows: int) -> int:
    """So many that a bucket has a few thousand rows, up to ``MOST_HASHES``."""
    return max(1, min(MOST_HASHES, round(math.log(max(1.0, rows / 2048)) / math.log(2.5))))


def _scaled(vectors: list[np.ndarray], dim: int) -> np.ndarray:
    """Vectors as rows of ``dim`` components, missing ones 0, the largest brought near 1 where squares might overflow."""
    out = np.zeros((len(vectors), dim))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    top = np.abs(out).max(axis=1, initial=0.0)
    odd = (top > 1e100) | ((top < 1e-100) & (top > 0))
    out[odd] /= top[odd, None]
    return out


def _units(vectors: list[np.ndarray], dim: int) -> np.ndarray:
    x = _scaled(vectors, dim)
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def neighbour_cosine(sample: np.ndarray, k: int) -> float:
    """A low decile of the k-th neighbour's cosine inside a sample of unit vectors."""
    if len(sample) < 2:
        return 0.0
    near = sample[:ASKED] @ sample.T
    near[np.arange(len(near)), np.arange(len(near))] = -2.0
    k = min(k, len(sample) - 1)
    kth = np.partition(near, len(sample) - k, axis=1)[:, len(sample) - k]
    return float(np.clip(np.quantile(kth, 0.1), 0.0, 0.999))


class Tables:
    def __init__(self, dim: int, hashes: int, cosine: float, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.dim, self.cosine = dim, cosine
        self.a = rng.standard_normal((TABLES, dim, hashes))
        self.b = rng.uniform(0, WIDTH, (TABLES, hashes))

    def buckets(self, units: np.ndarray) -> list[np.ndarray]:
        """For each table, the bucket (a hash of its slots) of each vector."""
        return [_code(np.floor((units @ a + b) / WIDTH).astype(np.int64)) for a, b in zip(self.a, self.b, strict=True)]

    def probes(self, unit: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """For each table, the buckets to visit, best first."""
        spread = math.sqrt(1 - self.cosine**2)
        for table, (a, b) in enumerate(zip(self.a, self.b, strict=True)):
            middle = self.cosine * (unit @ a) + b
            low = np.floor((middle - 4 * spread) / WIDTH).astype(int).tolist()
            high = np.floor((middle + 4 * spread) / WIDTH).astype(int).tolist()
            slots = []
            for x, y, m in zip(low, high, middle.tolist(), strict=True):
                edges = [_normal((edge * WIDTH - m) / spread) for edge in range(x, y + 2)]
                slots.append(sorted(((q - p, s) for s, p, q in zip(range(x, y + 1), edges[:-1], edges[1:], strict=True)), reverse=True))
            yield table, _code(np.array(list(_best_first(slots)), np.int64))


def _best_first(slots: list[list[tuple[float, int]]]) -> Iterator[list[int]]:
    """Combinations of one slot a function, the most likely first, until they reach ``REACH``. ``slots``: (share,
    slot) of each function, falling. A combination's successors step one function on, none before
    the last one stepped, so each is made once."""
    start = math.prod(s[0][0] for s in slots)
    heap = [(-start, (0,) * len(slots), 0)]
    seen = 0.0
    while heap and seen < REACH:
        share, at, last = heapq.heappop(heap)
        seen -= share
        yield [s[i][1] for s, i in zip(slots, at, strict=True)]
        for j in range(last, len(slots)):
            i = at[j] + 1
            if i < len(slots[j]) and slots[j][i][0] > 0:
                step = share / slots[j][i - 1][0] * slots[j][i][0]
                heapq.heappush(heap, (step, (*at[:j], i, *at[j + 1 :]), j))


def _normal(x: float) -> float:
    return 0.5 * math.erfc(-x / math.sqrt(2))


def _code(slots: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row of slots: buckets that share one are searched together."""
    code = np.zeros(len(slots), U64)
    for j in range(slots.shape[1]):
        code = mix64(code * U64(0x9E3779B97F4A7C15) + slots[:, j].astype(np.int64).view(U64))
    return code.view(np.int64)


def _units_of(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Pieces of batches with their unit vectors, few rows at a time where vectors are long."""
    for batch in batches:
        for a in range(0, batch.num_rows, block_rows(dim)):
            piece = batch.slice(a, block_rows(dim))
            yield piece, _units(table_vectors(pa.Table.from_batches([piece]))[2], dim)


def _index(batches: Iterator[pa.RecordBatch], tables) -> Iterator[pa.RecordBatch]:
    """Each row under its bucket in each table."""
    tables = tables.value
    for piece, units in _units_of(batches, tables.dim):
        for t, codes in enumerate(tables.buckets(units)):
            yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(np.full(len(codes), t, np.int32)), as_long(codes)], ["row", "id", "v", "table", "bucket"])


def _probe(batches: Iterator[pa.RecordBatch], tables) -> Iterator[pa.RecordBatch]:
    """The buckets that each query visits: ids only."""
    tables = tables.value
    for piece, units in _units_of(batches, tables.dim):
        for row, unit in zip(piece.column(0).to_pylist(), units, strict=True):
            for t, codes in tables.probes(unit):
                n = len(codes)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, row)), pa.array(np.full(n, t, np.int32)), as_long(codes)], ["row", "table", "bucket"])


class Asked:
    """A batch of queries: rows and ids in the order of rows, scaled vectors and their lengths."""

    def __init__(self, table: pa.Table, dim: int):
        row, id_, v = table_vectors(table)
        order = np.argsort(row)
        self.row, self.id, self.v = row[order], id_[order], _scaled([v[i] for i in order], dim)
        self.length = np.sqrt((self.v * self.v).sum(axis=1))


def _meet(bests: Bests, asked: Asked, some: np.ndarray, c_row: np.ndarray, c_id: np.ndarray, c: np.ndarray) -> None:
    """Adds candidates to the bests of the queries ``some``."""
    c_len = np.sqrt((c * c).sum(axis=1))
    for a in range(0, len(some) if len(c) else 0, 256):
        part = some[a : a + 256]
        near = (asked.v[part] @ c.T) / (asked.length[part, None] * c_len)
        for i, score in zip(part.tolist(), near, strict=True):
            least = bests.least(i)
            other = np.flatnonzero((c_row != asked.row[i]) & (True if least is None else score >= least - 1e-9))
            if len(other) > bests.k:
                bound = np.partition(score[other], len(other) - bests.k)[len(other) - bests.k]
                other = other[score[other] >= bound - 1e-9]
            if len(other):
                # The measure itself, row by row: equal vectors get equal scores wherever they stand.
                exact = (c[other] * asked.v[i]).sum(axis=1) / (asked.length[i] * c_len[other])
                bests.add(i, c_row[other], c_id[other], exact)


def _rerank(queries: pa.Table, candidates: pa.Table, asked, k: int, dim: int) -> pa.Table:
    """The bests of a block of probes among a block of a bucket."""
    asked = asked.value
    some = np.searchsorted(asked.row, queries.column("row").to_numpy())
    c_row, c_id, c = table_vectors(candidates)
    own = Bests(len(some), k, np.float64)
    picked = copy.copy(asked)
    picked.row, picked.id, picked.v, picked.length = (x[some] for x in (asked.row, asked.id, asked.v, asked.length))
    _meet(own, picked, np.arange(len(some)), c_row, c_id, _scaled(c, dim))
    return pa.Table.from_batches([own.table(picked.row, picked.id)])


def _reranked(asked, k: int, dim: int):
    def step(q: pa.Table, c: pa.Table) -> pa.Table:
        return _rerank(q, c, asked, k, dim)

    return step


def _scan(batches: Iterator[pa.RecordBatch], asked, k: int, dim: int) -> Iterator[pa.RecordBatch]:
    """The bests of all queries of a batch among a task's rows."""
    asked = asked.value
    bests, every = Bests(len(asked.row), k, np.float64), np.arange(len(asked.row))
    for batch in batches:
        for a in range(0, batch.num_rows, block_rows(dim)):
            c_row, c_id, c = table_vectors(pa.Table.from_batches([batch.slice(a, block_rows(dim))]))
            _meet(bests, asked, every, c_row, c_id, _scaled(c, dim))
    yield bests.table(asked.row, asked.id)


def nearest(
    vectors: DataFrame, is_query, k: int = 5, seed: int = 0, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row where ``is_query`` (a Column over
    ``id``) holds, the ``k`` other rows found with the largest cosine, nearest first;
    all of them where the table has fewer.

    Ties go to the smaller id. Rows with a null id or vector, a null or non-finite
    component, or only zeros take no part; a shorter vector counts as filled up
    with zeros. Rows that repeat an id are queries and candidates of their own: each
    meets the others, and the id has as many lists, ranks from 1 in each. Very long
    vectors are read in smaller blocks. Other columns and their names play no part; an
    empty table gives no rows."""
    spark = vectors.sparkSession
    rows, n = usable(vectors, id_col, vector_col)
    rows = rows.where(F.exists("v", lambda x: x != 0))
    dim, present = rows.agg(F.max(F.size("v")), F.count(F.lit(1))).first()
    dim = dim or 1
    sample = rows.orderBy(F.xxhash64("row")).limit(min(SAMPLE, block_rows(dim))).select("v").toPandas()["v"]
    sample = _units([np.asarray(v, np.float64) for v in sample], dim)
    tables = spark.sparkContext.broadcast(Tables(dim, hashes_for(n), neighbour_cosine(sample, k), seed))

    rows = rows.select("row", "id", "v")
    indexed = stage(in_arrow(rows, _index, "row long, id long, v array<double>, table int, bucket long", tables=tables), "ann-index")
    queries = stage(rows.where(is_query), "ann-asked")
    keys = ["table", "bucket"]
    there = indexed.groupBy(*keys).agg(blocks_of(F.count(F.lit(1)), dim).alias("c_blocks"))
    done = []
    for some, table in batches(queries):
        asked = spark.sparkContext.broadcast(Asked(table, dim))
        probes = stage(in_arrow(some, _probe, "row long, table int, bucket long", tables=tables), "ann-probes")
        here = probes.groupBy(*keys).agg(blocks_of(F.count(F.lit(1)), dim).alias("q_blocks"))
        sizes = checked_broadcast(stage(there.join(here, keys), "ann-sizes"))

        pairs = block_pairs(probes.join(sizes, keys), indexed.join(sizes, keys), keys, _reranked(asked, k, dim), SCHEMA)
        found = stage(pairs.distinct(), "ann-found")
        met = found.groupBy("row").agg(F.count(F.lit(1)).alias("met"))
        short = some.select("row").join(met, "row", "left").where(F.coalesce("met", F.lit(0)) < min(k, present - 1))
        short = stage(some.join(short.select("row"), "row", "left_semi"), "ann-short")
        if not short.isEmpty():
            rest = spark.sparkContext.broadcast(Asked(short.toArrow(), dim))  # some of the batch's queries
            whole = stage(in_arrow(rows, _scan, SCHEMA, asked=rest, k=k, dim=dim), "ann-whole")
            found = found.join(short.select("row"), "row", "left_anti").unionByName(whole)
        done.append(found)
    if not done:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return best_of(reduce(DataFrame.unionAll, done), k)
