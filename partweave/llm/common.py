"""Shared pieces of the training-data operators: text hashing inside tasks,
Arrow columns from numpy arrays, connected components and row packing."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from functools import partial
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partweave.operators.broadcast import DEFAULT_MAX_BYTES, is_at_most, row_bytes
from partweave.session import stage, stage_counted  # noqa: F401  (re-exported for the operators)

U64 = np.uint64
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


BATCH_ROWS = 1000
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


# Large arrays go back to the system when freed, so a worker that served one
# operator does not hold their memory through the next.
_WORKER_MEMORY = {
    "MALLOC_ARENA_MAX": "1",
    "MALLOC_MMAP_THRESHOLD_": str(4 << 20),
    "MALLOC_TRIM_THRESHOLD_": str(8 << 20),
    "ARROW_DEFAULT_MEMORY_POOL": "system",
}
#: Module name -> what empties the caches that it keeps in a Python worker.
WORKER_CACHES: dict[str, Callable[[], None]] = {}


def workers_import(spark) -> None:
    """Puts this package's folder on the Python workers' path, for local mode and
    installations at one path. A cluster without one gets it by ``--py-files``.
    Functions imported (not pickled) keep their caches for a worker's life.

    Also holds Arrow batches to ``BATCH_ROWS`` rows in this session, as rows here are
    whole texts and vectors: the default of 10,000 would hold many MB a batch, more than once."""
    if int(spark.conf.get(_BATCH_CONF)) > BATCH_ROWS:
        spark.conf.set(_BATCH_CONF, BATCH_ROWS)
    env = spark.sparkContext.environment
    for name, value in _WORKER_MEMORY.items():
        env.setdefault(name, value)
    if _ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [_ROOT, env.get("PYTHONPATH")]))


def in_arrow(df: DataFrame, step: Callable, schema: str, **options) -> DataFrame:
    """``df.mapInArrow`` of a module-level ``step(batches, **options)``."""
    workers_import(df.sparkSession)
    return df.mapInArrow(partial(_alone, step=step, options=options), schema)


def _alone(batches: Iterator[pa.RecordBatch], step: Callable, options: dict) -> Iterator[pa.RecordBatch]:
    """Runs ``step`` after emptying the caches that other operators left in this worker."""
    for module, clear in WORKER_CACHES.items():
        if module != step.__module__:
            clear()
    return step(batches, **options)




_SLICE_BYTES = 1 << 18
_R = 0x9E3779B97F4A7C15  # 5 modulo 8, so its powers have the longest period
_PIECED_BYTES = 256
_FIRST_BYTES = np.array([(1 << 8 * i) - 1 for i in range(9)], U64)  # masks
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _byte_terms() -> np.ndarray:
    x = np.arange(1, 257, dtype=U64) * U64(0xD1342543DE82EF95)
    for _ in range(2):
        x = mix64(x)
    x[ord("A") : ord("Z") + 1] = x[ord("a") : ord("z") + 1]
    return x


class _Powers:
    """Powers of ``_R`` and of its inverse, as many as were ever needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, U64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            with np.errstate(over="ignore"):
                up, down = np.full(n, _R, U64), np.full(n, pow(_R, -1, 1 << 64), U64)
                up[0] = down[0] = 1
                self.up, self.down = np.cumprod(up), np.cumprod(down)
        return self.up, self.down


_POWERS = _Powers()


def _slices(text: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Start and bytes of the slices of a text (uint8 array), cut at white space: arrays
    made from one stay small beside a very long text."""
    done = 0
    while done < len(text):
        stop = min(len(text), done + _SLICE_BYTES)
        while stop < len(text):
            blank = np.flatnonzero(_SPACE[text[stop : stop + _SLICE_BYTES]])
            if len(blank):
                stop += int(blank[0])
                break
            stop = min(len(text), stop + _SLICE_BYTES)
        yield done, text[done:stop]
        done = stop


def hashed_words(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and 64-bit hashes of the words of a text (uint8 array): what stands between
    ASCII white space, A-Z hashed like a-z."""
    starts, hashes = [], []
    for done, part in _slices(text):
        blank = np.concatenate([[True], _SPACE[part], [True]])
        first = np.flatnonzero(blank[:-2] & ~blank[1:-1])
        last = np.flatnonzero(~blank[1:-1] & blank[2:]) + 1
        up, down = _POWERS.upto(len(part) + 1)
        sums = np.concatenate([np.zeros(1, U64), np.cumsum(_BYTE_TERMS[part] * up[: len(part)])])
        hashes.append(mix64((sums[last] - sums[first]) * down[first] + (last - first).astype(U64)))
        starts.append(first + done)
    return (np.concatenate(starts), np.concatenate(hashes)) if starts else (np.empty(0, np.int64), np.empty(0, U64))


def piece_hashed_words(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``hashed_words``, with other hashes, in half the time: a word's 8-byte pieces are
    mixed one after the other, and the few words beyond ``_PIECED_BYTES`` are hashed whole."""
    starts, hashes = [], []
    for done, part in _slices(text):
        low = np.zeros(len(part) + 8, np.uint8)
        low[: len(part)] = part | ((part - np.uint8(65) < 26).view(np.uint8) << 5)
        blank = np.ones(len(part) + 2, bool)
        np.logical_or(part == 32, part - np.uint8(9) < 5, out=blank[1:-1])
        edge = np.flatnonzero(blank[1:] != blank[:-1])
        first, size = edge[::2], edge[1::2] - edge[::2]
        eight = np.ndarray(len(part) + 1, "<u8", low, strides=(1,))  # the 8 bytes from each place on
        h = mix64((eight[first] & _FIRST_BYTES[np.minimum(size, 8)]) ^ (size.astype(U64) * U64(_R)))
        at, rest = 8, np.flatnonzero(size > 8)
        while len(rest) and at < _PIECED_BYTES:
            h[rest] = mix64(h[rest] ^ (eight[first[rest] + at] & _FIRST_BYTES[np.minimum(size[rest] - at, 8)]))
            at += 8
            rest = rest[size[rest] > at]
        for i in rest:
            whole = blake2b(low[first[i] : first[i] + size[i]].tobytes(), digest_size=8)
            h[i] = int.from_bytes(whole.digest(), "little")
        hashes.append(h)
        starts.append(first + done)
    return (np.concatenate(starts), np.concatenate(hashes)) if starts else (np.empty(0, np.int64), np.empty(0, U64))


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (wrapping arithmetic)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_BYTE_TERMS = _byte_terms()


def as_long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == U64 else x.astype(np.int64, copy=False))


def binary_rows(rows: np.ndarray) -> pa.Array:
    """A 2-D array as one binary value per row, without a Python loop."""
    rows = np.ascontiguousarray(rows)
    width, n = rows.dtype.itemsize * rows.shape[1], rows.shape[0]
    offsets = np.arange(n + 1, dtype=np.int32) * np.int32(width)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(rows)])


def binary_runs(words: np.ndarray, size: np.ndarray) -> pa.Array:
    """Consecutive runs of an array, ``size`` items each, as binary values."""
    offsets = (np.concatenate([[0], np.cumsum(size)]) * words.dtype.itemsize).astype(np.int32)
    words = np.ascontiguousarray(words)
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(words)])


def rows_of(column: pa.Array, dtype, width: int) -> np.ndarray:
    """The inverse of ``binary_rows``: (n, width) array of a fixed-width binary column."""
    if not len(column):
        return np.empty((0, width), dtype)
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), width)


RARITY_SIZE = 1 << 20
COUNT_SCHEMA = "slice int, counts binary"
_SLICE = 1 << 14


def tally(counts: np.ndarray, at: np.ndarray) -> None:
    """Adds one to ``counts`` for each index in ``at``; much faster than ``np.add.at`` on many."""
    counts += np.bincount(at, minlength=len(counts)).astype(counts.dtype)


def count_slices(counts: np.ndarray) -> pa.RecordBatch:
    """A task's ``RARITY_SIZE`` counters as rows that can be dealt out and added up."""
    rows = counts.astype("<u8").reshape(-1, _SLICE)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.arange(len(rows), dtype=np.int32)), binary_rows(rows)], ["slice", "counts"]
    )


def _add_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            total[i] = total.get(i, 0) + np.frombuffer(x, "<u8")
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())],
        ["slice", "counts"],
    )


def rarity_of(counts: DataFrame) -> bytes:
    """One byte, below 64, for each of ``RARITY_SIZE`` counters: twice the binary
    logarithm of its sum over all tasks' ``count_slices``. Its size is the same at any input size."""
    total = np.zeros(RARITY_SIZE, np.uint64)
    for r in in_arrow(counts.repartition("slice"), _add_slices, COUNT_SCHEMA).collect():
        total[r["slice"] * _SLICE : (r["slice"] + 1) * _SLICE] += np.frombuffer(r["counts"], "<u8")
    return np.minimum(63, 2 * np.log2(total + 1.0)).astype(np.uint8).tobytes()


def broadcast_lists(df: DataFrame, lists: str) -> DataFrame:
    """A broadcast of ``df``, whose column ``lists`` holds arrays of ints beside fixed-width columns, if its
    rows and lists are measured to fit the budget, else ``df``. Give it a staged table."""
    rows, items = df.agg(F.count(F.lit(1)), F.sum(F.size(lists))).first()
    size = rows * (row_bytes(df.schema) + 64) + 4 * (items or 0)
    return F.broadcast(df) if size <= DEFAULT_MAX_BYTES else df


def broadcast_within(df: DataFrame, rows: int) -> DataFrame:
    """A broadcast of ``df`` if it is found to have at most ``rows`` rows (the caller
    knows their width), else ``df`` itself for a shuffle join."""
    return F.broadcast(df) if is_at_most(df, rows) else df


def fresh_name(taken: list[str], wanted: str) -> str:
    """``wanted``, with underscores in front until no column has that name (any case)."""
    low = {c.lower() for c in taken}
    while wanted.lower() in low:
        wanted = "_" + wanted
    return wanted


def _signature(edges: DataFrame) -> tuple:
    r = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s"),
    ).first()
    return r["n"], r["s"]


def connected_components(edges: DataFrame, tag: str = "cc") -> DataFrame:
    """``edges(u, v)`` (longs) -> ``(node, root)`` with root = smallest node reachable.

    Alternating large-star / small-star contraction. A hub's minimum is a
    partially aggregated ``min`` joined back (an equi-join that adaptive
    execution can split), so no task holds a hub's whole neighbourhood. Each
    round is written to the shared staging folder, which also cuts the lineage.
    Nodes without an edge do not appear."""
    e = stage(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), tag
    )
    seen = _signature(e)
    while seen[0]:
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        near = large.join(low, "u")
        e = stage(
            near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionAll(low.select("u", F.col("m").alias("v")))
            .distinct(),
            tag,
        )
        now = _signature(e)
        if now == seen:
            break
        seen = now
    roots = e.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots)
