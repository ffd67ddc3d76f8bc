"""Exact top-k by inner product: aggregation of sorted lists without random access.

Within a block, each dimension is a list sorted by value. A query reads a list from its
high end where its own component is positive, and from its low end where it is negative,
stretch by stretch. What it has read of a vector is added up. Between stretches the
vector's score has a lower bound (parts not read yet replaced by the list's far end) and
an upper bound (replaced by the last value read). A vector whose upper bound is under
the k-th lower bound, or under the floor that the query brings from other blocks, can't
qualify, and its entries are passed over from then on. The scores of the vectors that
are left are final once their entries in all lists have been read.

Results in odd cases: null vectors, empty ones and ones with null or non-finite
components take no part; repeated rows count once; vectors meet only vectors of their
own dimension; ties go to the smaller id; a table with k rows or fewer gives all others
to each query; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineflow.llm.vectors import best_first, search, usable

#: Stretches that a list is read in; bounds are compared after every CHECK-th.
STRETCHES, CHECK = 16, 4
#: Queries that read the lists together.
QUERIES = 256


def block_top(queries: np.ndarray, query_ids: np.ndarray, floors: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> list[tuple]:
    """(query_id, vec_id, score) arrays: the k best of the block for each query, but for scores under its floor."""
    rows, queries = rows.astype(np.int64), queries.astype(np.int64)
    order = np.argsort(rows, axis=0, kind="stable")
    lists = [(order[:, d], rows[order[:, d], d]) for d in range(rows.shape[1])]
    out = []
    for at in range(0, len(queries), QUERIES):
        part = slice(at, at + QUERIES)
        out += _read(queries[part], query_ids[part], floors[part], lists, rows.shape, ids, k)
    return out


def _read(queries: np.ndarray, query_ids: np.ndarray, floors: np.ndarray, lists: list[tuple[np.ndarray, np.ndarray]], shape: tuple[int, int], ids: np.ndarray, k: int) -> list[tuple]:
    n, width = shape
    largest = float(max(max(-v[0], v[-1], 0) for _, v in lists)) * float(np.abs(queries).max(initial=0)) * width
    # every partial sum is exact in the chosen type, or the bounds get some slack and exact sums are kept besides
    kind = np.float32 if largest < 1 << 24 else np.float64
    slack = 0.0 if largest < 1 << 53 else largest * 1e-12
    sums = np.zeros((n, len(queries)), kind)
    exact = np.zeros((n, len(queries)), np.int64) if slack else None
    whole_up, whole_down = np.maximum(queries, 0), np.minimum(queries, 0)  # what reads a list from its high and its low end
    up, down = (np.ascontiguousarray(x.T, kind) for x in (whole_up, whole_down))  # a row for each list
    unread_top, unread_bottom = np.ones((n, width), kind), np.ones((n, width), kind)
    lowest, highest = (np.array([v[i] for _, v in lists]).astype(kind) for i in (0, -1))
    own = ids[:, None] == query_ids[None, :]
    few = n - own.sum(axis=0) <= k
    alive = np.ones(n, bool)
    reach = ~own
    edges = np.linspace(0, n, min(STRETCHES, n) + 1).astype(int)
    for step, (a, b) in enumerate(zip(edges, edges[1:]), 1):
        for d, (order, values) in enumerate(lists):
            for unread, asking, whole, span in ((unread_top, up, whole_up, slice(n - b, n - a)), (unread_bottom, down, whole_down, slice(a, b))):
                left = alive[order[span]]
                which, value = order[span][left], values[span][left]
                unread[which, d] = 0
                sums[which] += value.astype(kind)[:, None] * asking[d]
                if slack:
                    exact[which] += value[:, None] * whole[:, d]
        if step % CHECK or b == n:
            continue
        left = np.flatnonzero(alive)
        frontier_top, frontier_bottom = (np.array([v[i] for _, v in lists]).astype(kind) for i in (n - b, b - 1))
        top, bottom, part = unread_top[left], unread_bottom[left], sums[left]
        upper = part + top @ (up * frontier_top[:, None]) + bottom @ (down * frontier_bottom[:, None])
        bound = floors.astype(float)
        if len(left) >= k and not np.isfinite(floors).all():
            lower = part + top @ (up * lowest[:, None]) + bottom @ (down * highest[:, None])
            lower[~reach[left]] = -np.inf
            bound = np.maximum(bound, np.partition(lower, len(left) - k, axis=0)[len(left) - k])
        reach[left] &= (upper >= bound - slack) | few
        alive[left] = reach[left].any(axis=1)
    out, final = [], sums if exact is None else exact
    for j in range(len(queries)):
        left = np.flatnonzero(reach[:, j])
        scores = final[left, j].astype(np.int64)
        top = best_first(ids[left], scores, k)
        out.append((np.full(len(top), query_ids[j]), ids[left][top], scores[top]))
    return out


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score long) over vectors of whole numbers; is_query is a condition on `id`."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).where(usable(F.col("v"), False))
    rows = rows.withColumn("v", F.transform("v", lambda x: x.cast("long")))
    return search(rows, is_query, k, lambda q, qi, floor, r, ri, _: block_top(q, qi, floor, r, ri, k), "long")


def quantized(vectors: DataFrame, factor: int = 256, vector_col: str = "embedding") -> DataFrame:
    """Components x become floor(factor * x), x as double; unusable vectors become null."""
    whole = F.transform(vector_col, lambda x: F.floor(F.lit(float(factor)) * x.cast("double")))
    return vectors.withColumn(vector_col, F.when(usable(F.col(vector_col), False), whole))
