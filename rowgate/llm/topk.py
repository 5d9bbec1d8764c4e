"""Exact top-k search by the threshold algorithm.

In a cell of the grid each dimension has the list of the rows sorted by it. A query walks all lists
at once, from the end its sign prefers, a deeper part each round; rows met for the first time are
scored in full. No row not yet met can score more than the query against the values at the depth
reached; once that bound is below the k-th score, which leaves no tie open either, the cell is done.
Spark keeps the k best of the cells of each query.

Every row but the query's own is a candidate; rows that repeat a ``vec_id`` are rows of their own,
as candidates and as queries. Rows without a ``vec_id`` are candidates only, the last among ties.
Vectors that ``whole_vectors`` leaves out take no part; queries meet vectors of their length only.
With fewer than k candidates all are returned; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowgate.llm.vectors import arrow_ids, ids, matrix, on_grid, whole_vectors

FACTOR, FIRST = 1_024, 8
_BEST = ["query", "query_id", "vec_id", "score"]


def best(scores: np.ndarray, keys: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties by the smaller key, in that order."""
    places = np.arange(len(scores))
    if len(scores) > 4 * k:
        places = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
    return places[np.lexsort((keys[places], -scores[places]))[:k]]


class Lists:
    """The rows of a cell, and for each dimension their order by it."""

    def __init__(self, rows: np.ndarray, keys: np.ndarray):
        n, self.dim = rows.shape
        order = np.argsort(rows, axis=0, kind="stable")
        self.rows, self.keys, self.n = rows, keys, n
        self.order, self.values = np.ascontiguousarray(order.T), np.ascontiguousarray(np.take_along_axis(rows, order, 0).T)

    def search(self, query: np.ndarray, k: int, own: int = -1) -> tuple[np.ndarray, np.ndarray, int]:
        """Places and scores of the ``k`` best rows but ``own``, and the depth that was needed."""
        up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        met = np.zeros(self.n, bool)
        if own >= 0:
            met[own] = True
        found, scores = np.zeros(0, np.int64), np.zeros(0, self.rows.dtype)
        depth, step = 0, FIRST if len(up) + len(down) else self.n
        while depth < self.n:
            end = min(self.n, depth + step)
            fresh = np.zeros(self.n, bool)
            if len(up) + len(down):
                fresh[self.order[up, self.n - end : self.n - depth]] = True
                fresh[self.order[down, depth:end]] = True
            else:
                fresh[:] = True
            fresh &= ~met
            new = np.flatnonzero(fresh)
            met |= fresh
            if len(new):
                found, scores = np.append(found, new), np.append(scores, self.rows[new] @ query)
                chosen = best(scores, self.keys[found], k)
                found, scores = found[chosen], scores[chosen]
            depth, step = end, 2 * step
            bound = query[up] @ self.values[up, self.n - end] + query[down] @ self.values[down, end - 1]
            if len(found) == k and bound < scores[-1]:
                break
        return found, scores, depth


def exact_numbers(one: np.ndarray, other: np.ndarray) -> type:
    """Floating point where every sum of products is a whole number it can hold, as it is faster."""
    most = [int(np.abs(m).max(initial=0)) for m in (one, other)]
    return np.float64 if most[0] * most[1] * max(1, one.shape[1]) < 1 << 53 else np.int64


def top_rows(rows: DataFrame, is_query: Column, k: int, factor: int = FACTOR) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score``: the ``k`` best rows of each query."""

    def meet(block: pa.Table, group: pa.Table) -> pa.Table:
        dim = group.column("dim")[0].as_py()
        queries, held, keys = matrix(block, dim), matrix(group, dim), ids(group)
        kind = exact_numbers(queries, held)
        lists, place = Lists(held.astype(kind), keys), {r: i for i, r in enumerate(group.column("row").to_pylist())}
        numbers, out = block.column("row").to_pylist(), []
        for query, number in zip(queries.astype(kind), numbers):
            found, scores, _ = lists.search(query, k, place.get(number, -1))
            out.append((len(found), keys[found], scores.astype(np.int64)))
        times = [n for n, _, _ in out]
        return pa.table(
            {
                "query": pa.array(np.repeat(np.array(numbers, np.int64), times)),
                "query_id": pa.array(np.repeat(ids(block), times)),
                "vec_id": arrow_ids(np.concatenate([x for _, x, _ in out])),
                "score": pa.array(np.concatenate([x for _, _, x in out])),
            }
        )

    vectors = whole_vectors(rows, factor)
    found = on_grid(vectors.where(is_query), vectors, meet, _BEST)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
