"""Exact top-k search by term-at-a-time accumulation.

A vector is a sparse row: component t, as floor(scale * x), is the weight of term
t. For a block of candidates the postings of each term (positions and weights
other than 0) are laid out once; a query then goes through its own terms and
adds query weight times posting weight into one dense score array. The best are
taken by partition selection. Queries are broadcast a bounded batch at a time and
candidates scanned in place, so every query meets every candidate and the result is
exact; the tasks' bests are merged by a window.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import in_arrow, stage
from .vectors import Bests, batches, best_of, table_vectors, top_rows, usable

SCHEMA = "row long, query_id long, vec_row long, vec_id long, score long"
_LONG = 1 << 63


def _weights(vectors: list[np.ndarray], scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and weight of every component that isn't 0. Weights are int64, or
    Python integers where products and sums might leave int64."""
    size = np.array([len(v) for v in vectors], np.int64)
    weight = np.floor(scale * np.concatenate(vectors)) if size.sum() else np.empty(0)
    row = np.repeat(np.arange(len(vectors)), size)
    term = np.arange(len(weight)) - np.repeat(np.cumsum(size) - size, size)
    on = weight != 0
    weight = weight[on]
    if len(weight) and np.abs(weight).max() * np.sqrt(max(1, size.max())) >= 2.0**31:
        return row[on], term[on], np.array([int(w) for w in weight], object)
    return row[on], term[on], weight.astype(np.int64)


def _search(batches: Iterator[pa.RecordBatch], asked, k: int, scale: int) -> Iterator[pa.RecordBatch]:
    """The best of each broadcast query among a task's candidates."""
    q_row, q_id, (row, term_q, weight_q) = asked.value
    bounds = np.searchsorted(row, np.arange(len(q_row) + 1))
    bests = Bests(len(q_row), k, np.int64)
    for batch in batches:
        c_row, c_id, c_vectors = table_vectors(pa.Table.from_batches([batch]))
        if not len(c_id):
            continue
        at, term, weight = _weights(c_vectors, scale)
        exact = object if object in (weight.dtype, weight_q.dtype) else np.int64
        order = np.argsort(term, kind="stable")
        at, term, weight = at[order], term[order], weight[order].astype(exact)
        terms, first = np.unique(term, return_index=True)
        postings = {t: (a, w) for t, a, w in zip(terms.tolist(), np.split(at, first[1:]), np.split(weight, first[1:]), strict=False)}
        for q in range(len(q_row)):
            score = np.zeros(len(c_id), exact)
            for t, w in zip(term_q[bounds[q] : bounds[q + 1]].tolist(), weight_q[bounds[q] : bounds[q + 1]].tolist(), strict=True):
                if t in postings:
                    a, x = postings[t]
                    if len(a) == len(score):
                        score += w * x
                    else:
                        score[a] += w * x
            if exact is object:
                score = np.array([max(-_LONG, min(_LONG - 1, int(s))) for s in score], np.int64)
            least = bests.least(q)
            other = np.flatnonzero((c_row != q_row[q]) & (True if least is None else score >= least))
            best = other[top_rows(score[other], c_id[other], k)]
            if len(best):
                bests.add(q, c_row[best], c_id[best], score[best])
    yield bests.table(q_row, q_id)


def exact_top_k(
    vectors: DataFrame, is_query, k: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row where ``is_query`` (a Column over
    ``id``) holds, the ``k`` other rows with the largest integer inner product.

    Ties go to the smaller id. Rows with a null id, a null vector or a null or
    non-finite component take no part; a shorter vector lacks the terms beyond its
    end; an empty one scores 0. Rows that repeat an id are queries and candidates of
    their own: each meets the others, and the id has as many lists, ranks from 1 in each.
    A very long vector is a long sparse row; the blocks of Arrow batches bound a task's memory.
    Scores beyond a long are held at its ends. Other columns and their names play no part; an
    empty table gives no rows."""
    rows, _ = usable(vectors, id_col, vector_col)
    asked = stage(rows.where(is_query), "topk-asked")
    found = []
    for _, table in batches(asked):
        q_row, q_id, v = table_vectors(table)
        shared = vectors.sparkSession.sparkContext.broadcast((q_row, q_id, _weights(v, scale)))
        found.append(stage(in_arrow(rows.select("row", "id", "v"), _search, SCHEMA, asked=shared, k=k, scale=scale), "topk-found"))
    if not found:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return best_of(functools.reduce(DataFrame.unionAll, found), k)
