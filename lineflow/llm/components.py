"""Connected components of a link table, as rounds of DataFrame joins."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineflow.llm.common import cut

#: Rows of two ids that one task reads in a round; rounds over few rows take few tasks and files.
TASK_ROWS = 100_000


def components(links: DataFrame) -> DataFrame:
    """links (a long, b long) -> (v long, root long), root being the smallest id reachable.

    Before each round every task replaces the links that it holds, TASK_ROWS at a time, by
    stars around the smallest id of each part that they connect, so that a component of
    few links is a star at once; where one task holds all links, they are the result. A round hooks every vertex to its first neighbour, follows
    the hooks to their ends by doubling, and contracts the links. Neighbours are ordered by id in even rounds, so
    that stars and chains in order of id end at once, and by a hash of the id that
    differs by round in odd ones: there a vertex with a link has an even chance or better
    of not being the first of its neighbourhood, so two rounds halve the vertices on any
    graph, whatever its order of ids, and the number of rounds is logarithmic. Links
    whose ends are null or equal are ignored; an empty table gives an empty result.
    Vertices without links are not returned. State lives in reliable checkpoints only.
    """
    links, n = _stars(_clean(links.select(F.col("a").cast("long"), F.col("b").cast("long"))))
    if n <= TASK_ROWS:
        ends = links.select(F.col("b").alias("v"), F.col("a").alias("root"))
        return cut(ends.union(links.select("a", "a").distinct()).coalesce(1))
    both = links.select(F.col("a").alias("v")).union(links.select(F.col("b").alias("v")))
    held = both.distinct().select("v", F.col("v").alias("at"))
    turn = 0
    while n:
        hooks = _settled(_hooks(links, turn))
        held, _ = _dense(held.join(hooks.withColumnRenamed("v", "at"), "at", "left").select("v", F.coalesce("p", "at").alias("at")))
        ends = links.join(hooks.select(F.col("v").alias("a"), F.col("p").alias("pa")), "a")
        ends = ends.join(hooks.select(F.col("v").alias("b"), F.col("p").alias("pb")), "b")
        links, n = _stars(_clean(ends.select(F.col("pa").alias("a"), F.col("pb").alias("b"))))
        turn += 1
    least = held.groupBy("at").agg(F.min("v").alias("root"))
    return cut(held.join(least, "at").select("v", "root"))


def _dense(df: DataFrame) -> tuple[DataFrame, int]:
    """df cut, in as many partitions as its rows need, and their number."""
    df = cut(df)
    n = df.count()
    return df.coalesce(max(1, -(-n // TASK_ROWS))), n


def forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest position reachable from each of n positions."""
    root = np.arange(n)
    for p, q in pairs:
        while True:
            a, b = root[p], root[q]
            apart = a != b
            if not apart.any():
                break
            p, q, a, b = p[apart], q[apart], a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while (root[root] != root).any():
                root = root[root]
    return root


def _stars(links: DataFrame) -> tuple[DataFrame, int]:
    """Links that connect the same vertices, a star for each part that TASK_ROWS links of one task connect, and how many there were."""
    links, n = _dense(links)
    most = TASK_ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        rows = 0
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                held.append(np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()]))
                rows += batch.num_rows
            if rows and (batch is None or rows >= most):
                ids, at = np.unique(np.concatenate(held, axis=1), return_inverse=True)
                root = forest(len(ids), iter([tuple(at.reshape(2, -1))]))
                apart = root != np.arange(len(ids))
                held, rows = [], 0
                yield pa.RecordBatch.from_arrays([pa.array(ids[root[apart]]), pa.array(ids[apart])], ["a", "b"])

    return cut(links.mapInArrow(run, "a long, b long")) if n else links, n


def _clean(links: DataFrame) -> DataFrame:
    ends = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return ends.where("a <> b").distinct()


def _hooks(links: DataFrame, turn: int) -> DataFrame:
    """(v, p): the first of the vertex and its neighbours in this round's order."""
    rank = lambda c: F.xxhash64(c, F.lit(turn)) if turn % 2 else F.col(c)
    near = links.union(links.select("b", "a")).groupBy(F.col("a").alias("v")).agg(F.min_by("b", rank("b")).alias("b"))
    first: Column = F.when(rank("b") < rank("v"), F.col("b")).otherwise(F.col("v"))
    return near.select("v", first.alias("p"))


def _settled(hooks: DataFrame) -> DataFrame:
    """Hooks followed to their ends; each pass doubles the way."""
    while True:
        onward = hooks.select(F.col("v").alias("p"), F.col("p").alias("q"))
        hooks, _ = _dense(hooks.join(onward, "p").select("v", F.col("q").alias("p"), (F.col("p") != F.col("q")).alias("moved")))
        if hooks.where("moved").isEmpty():
            return hooks.select("v", "p")
        hooks = hooks.select("v", "p")
