"""Approximate nearest neighbours by inner product: collision counting over projections.

Within a block, every vector gets one more component so that all have one length and
the largest inner product is the smallest distance. Each projection is a sorted array.
A query opens a window around its own projection in every array, of a width that goes
with the search radius; a vector that lies in enough windows collides often enough to
be verified by its exact inner product, once. Windows that hold over half of the entries
are counted by the entries outside them. When the radius grows (virtual rehashing), the
windows are expanded at both ends and the new entries alone are counted.

The number of projections follows the block's own distances: so many that the collision
threshold lies MARGIN standard deviations under the mean count of a vector at the search
radius, and FAR over that of a vector at the usual distance. Where that takes over MOST,
no index of this kind is selective, and the whole block is verified.

In the first blocks the radius grows until the block's share of the k nearest, plus four
standard deviations as rows are dealt to blocks by hash, lies within it; a query whose
windows outgrow the block verifies the rest of it. In the other blocks the k-th best
score found so far gives the radius: nothing beyond it is wanted.

Results in odd cases: null, empty and zero vectors and ones with null or non-finite
components take no part; repeated rows count once; vectors meet only vectors of their
own dimension; ties go to the smaller id; a table with k rows or fewer gives all others
to each query; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineflow.llm.vectors import best_first, search, usable

#: Half a window's width, in search radii.
WINDOW = 2.0
#: The collision threshold lies so many standard deviations under the mean of a vector at the radius, and so many over that of one far away.
MARGIN, FAR = 1.5, 1.0
#: Projections, at least and at most.
LEAST, MOST = 16, 192
#: Growth of the radius, and how often it grows before the whole block is verified.
GROWTH, ROUNDS = 1.12, 10


def projections(dimension: int, m: int) -> np.ndarray:
    """(dimension, m) vectors of orthogonal bases, each of length sqrt(dimension)."""
    draw = np.random.default_rng(17)
    bases = [np.linalg.qr(draw.normal(size=(dimension, dimension)))[0] for _ in range(-(-m // dimension))]
    return np.hstack(bases)[:, :m] * math.sqrt(dimension)


def planned(near: float, far: float) -> tuple[int, int] | None:
    """(projections, collision threshold) that tell a vector at distance near from one at distance far; None: over MOST are needed."""
    p, q = math.erf(WINDOW / math.sqrt(2)), math.erf(WINDOW * near / max(far, 1e-12) / math.sqrt(2))
    spread, other = math.sqrt(p * (1 - p)), math.sqrt(q * (1 - q))
    if p <= q or (needed := ((MARGIN * spread + FAR * other) / (p - q)) ** 2) > MOST:
        return None
    m = max(LEAST, math.ceil(needed))
    return m, max(1, math.floor(m * p - MARGIN * math.sqrt(m) * spread))


def block_nearest(queries: np.ndarray, query_ids: np.ndarray, floors: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int, share: float) -> list[tuple]:
    """(query_id, vec_id, score) arrays: what each query found in the block, but for scores under its floor."""
    rows, queries = rows.astype(float), queries.astype(float)
    n, mean = len(rows), k * share
    need = min(k, math.ceil(mean + 4 * math.sqrt(mean * (1 - share)) + 1))
    whole = lambda: [_best(*_scores(q, np.arange(n), queries, query_ids, rows, ids), query_ids[q], ids, k) for q in range(len(queries))]
    if n <= 4 * k:
        return whole()
    length = np.sqrt((rows * rows).sum(axis=1))
    longest = length.max()
    points = np.hstack([rows / longest, np.sqrt(np.maximum(0, 1 - (length / longest) ** 2))[:, None]])
    size = np.sqrt((queries * queries).sum(axis=1))
    units = np.hstack([queries / size[:, None], np.zeros((len(queries), 1))])
    # a first radius that about `need` vectors lie within, from some rows of the block, which are in order of hash
    some = 2 - 2 * units @ points[:: max(1, n // 256)].T
    first = np.sqrt(np.maximum(np.quantile(some, max(need / n, 4 / some.size)), 1e-12))
    known = np.isfinite(floors)
    with np.errstate(invalid="ignore"):
        radius = np.where(known, np.sqrt(np.maximum(2 - 2 * floors / (size * longest), 1e-12)), first)
    plan = planned(float(np.median(radius)), math.sqrt(max(float(np.median(some)), 0)))
    if plan is None:
        return whole()
    m, threshold = plan
    turn = projections(points.shape[1], m)
    projected = points @ turn
    order = np.argsort(projected, axis=0).T.astype(np.int64)
    arrays = np.take_along_axis(projected.T, order, axis=1)
    centre = units @ turn
    held = lambda spans: np.bincount(np.concatenate(spans), minlength=n)

    def edges(asking: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the windows of the queries asking begin and end in every array."""
        low, high = centre[asking] - WINDOW * radius[asking, None], centre[asking] + WINDOW * radius[asking, None]
        return np.array([np.searchsorted(a, low[:, j]) for j, a in enumerate(arrays)]).T, np.array([np.searchsorted(a, high[:, j], "right") for j, a in enumerate(arrays)]).T

    found: list[list[tuple]] = [[] for _ in queries]
    asking, before = np.arange(len(queries)), {}  # before: what the last radius left of each query that goes on
    for expansion in range(ROUNDS + 1):
        lows, highs = edges(asking)
        going = {}
        for i, q in enumerate(asking.tolist()):
            low, high = lows[i].tolist(), highs[i].tolist()
            if q in before:
                old_low, old_high, counts, unseen, near = before.pop(q)
                counts += held([order[j, low[j] : old_low[j]] for j in range(m)] + [order[j, old_high[j] : high[j]] for j in range(m)]).astype(counts.dtype)
            else:
                unseen, near = ids != query_ids[q], np.zeros(0)
                if 2 * (sum(high) - sum(low)) > m * n:
                    counts = m - held([order[j, : low[j]] for j in range(m)] + [order[j, high[j] :] for j in range(m)])
                else:
                    counts = held([order[j, low[j] : high[j]] for j in range(m)])
            crossed = np.flatnonzero(unseen & (counts >= threshold) if expansion < ROUNDS else unseen)
            found[q].append(_scores(q, crossed, queries, query_ids, rows, ids))
            if known[q] or expansion == ROUNDS:
                continue
            near = np.concatenate([near, found[q][-1][1]])
            if (near >= (1 - radius[q] ** 2 / 2) * longest * size[q]).sum() < min(need, n - (ids == query_ids[q]).sum()):
                unseen[crossed] = False
                going[q] = (low, high, counts.astype(np.int16), unseen, near)
        asking, before = np.array(list(going), np.int64), going
        if not going:
            break
        radius[asking] *= GROWTH
    return [_best(*map(np.concatenate, zip(*found[q])), query_ids[q], ids, k) for q in range(len(queries))]


def _scores(q: int, left: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The vectors left that aren't the query's own, and their exact inner products."""
    left = left[ids[left] != query_ids[q]]
    return left, np.einsum("ij,j->i", rows.take(left, axis=0), queries[q])


def _best(left: np.ndarray, scores: np.ndarray, query_id: int, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    top = best_first(ids[left], scores, k)
    return np.full(len(top), query_id), ids[left][top], scores[top]


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score double); is_query is a condition on `id`."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).where(usable(F.col("v"), True))
    rows = rows.withColumn("v", F.transform("v", lambda x: x.cast("double")))
    return search(rows, is_query, k, lambda q, qi, floor, r, ri, share: block_nearest(q, qi, floor, r, ri, k, share), "double")
