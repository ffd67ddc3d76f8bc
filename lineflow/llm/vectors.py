"""Dealing vectors out for searches of a stated query set against all rows, in blocks."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lineflow.llm.common import cut

#: Candidates and queries of a cell, about.
BLOCK_ROWS, QUERY_ROWS = 4096, 2048
#: One block of so many is searched first; what a query finds there bounds its search of the others.
FIRST = 8


def usable(vector: Column, no_zero: bool) -> Column:
    """Neither null nor empty, and no component null or not finite; no_zero: not all zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(vector, lambda x: x != 0) if no_zero else F.lit(True)
    return F.coalesce((F.size(vector) > 0) & fine & some, F.lit(False))


def search(vectors: DataFrame, is_query: Column, k: int, local: Callable[..., list[tuple]], kind: str) -> DataFrame:
    """vectors (id long, v array) -> (query_id, rank, vec_id, score kind), the k best of every query.

    Rows are dealt to blocks by hash and each block meets each block of queries of the
    same dimension in one cell, where local(queries, their ids, their floors, rows, their
    ids, share) returns (query_id, vec_id, score) rows; share is the block's part of all
    rows. One block in FIRST is searched first: the k-th best score that a query finds
    there is its floor in the other blocks, which need no lower ones. Repeated rows count
    once; rows without an id take no part.
    """
    rows = vectors.where("id is not null").dropDuplicates(["id", "v"]).withColumn("d", F.size("v"))
    n, n_queries = vectors.select(F.count("*"), F.count_if(is_query)).first()
    blocks, query_blocks = max(1, -(-n // BLOCK_ROWS)), max(1, -(-n_queries // QUERY_ROWS))
    early = -(-blocks // FIRST)
    at = lambda count: F.pmod(F.xxhash64("id", "v"), F.lit(count)).cast("int")
    every = lambda low, high: F.explode(F.sequence(F.lit(low), F.lit(high - 1)))
    queries = rows.where(is_query).select("d", at(query_blocks).alias("q"), "id", "v", F.lit(None).cast("double").alias("floor"))
    rows = rows.select("d", every(0, query_blocks).alias("q"), at(blocks).alias("b"), "id", "v")

    def cell(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if left.num_rows and right.num_rows:
            matrix = lambda t: t.column("v").combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1)
            floor = np.nan_to_num(left.column("floor").to_numpy().astype(float), nan=-np.inf)
            found = local(matrix(left), left.column("id").to_numpy(), floor, matrix(right), right.column("id").to_numpy(), 1 / blocks)
        columns = zip(*found) if found else ([], [], [])
        kinds = [pa.int64(), pa.int64(), pa.int64() if kind == "long" else pa.float64()]
        return pa.table([pa.array(np.concatenate(c) if found else [], t) for c, t in zip(columns, kinds)], ["query_id", "vec_id", "score"])

    def searched(asked: DataFrame, low: int, high: int) -> DataFrame:
        asked = asked.withColumn("b", every(low, high))
        cells = asked.groupBy("d", "q", "b").cogroup(rows.where(F.col("b").between(low, high - 1)).groupBy("d", "q", "b"))
        return cells.applyInArrow(cell, f"query_id long, vec_id long, score {kind}")

    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    top = lambda found: found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    found = searched(queries, 0, early)
    if early < blocks:
        found = cut(top(found).select("query_id", "vec_id", "score"))
        # the same id may stand for several vectors; the lowest floor of the id holds for all of them
        floors = found.groupBy(F.col("query_id").alias("id")).agg(F.count("*").alias("n"), F.min("score").cast("double").alias("floor"))
        floors = floors.where(F.col("n") == k).select("id", "floor")
        single = queries.groupBy("id").agg(F.count("*").alias("vectors")).where("vectors = 1").select("id")
        asked = cut(queries.drop("floor").join(floors.join(single, "id"), "id", "left").select("d", "q", "id", "v", "floor"))
        found = found.union(searched(asked, early, blocks))
    return top(found).select("query_id", "rank", "vec_id", "score")


def best_first(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to smaller ids."""
    if len(scores) > 4 * k:
        high = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
        return high[np.lexsort([ids[high], -scores[high]])[:k]]
    return np.lexsort([ids, -scores])[:k]
