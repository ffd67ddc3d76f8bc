"""Mixing sources to target weights, block by block.

The words of each source are packed into blocks of fixed length. The mix is a row of slots,
cut into shards; each shard draws the numbers of its slots by source from a multinomial.
A slot's number within its source is the number of those drawn before it, and a
pseudorandom permutation of the source's blocks, a new one for each pass over them, tells
which block it takes. Blocks and slots are joined by source and block number.

Independent draws miss a quota by the root of its size, so draws that are over a source's
quota, picked by another permutation, go to sources that are under theirs: each source
comes within a block of its target, and no block is taken more often than its cap allows.

A source's documents are dealt over bins by a hash, and blocks are packed within a bin, so
that no window holds a source. One row for each source (its size and blocks) is in the
driver, as the weights are.

Results in odd cases: a null or blank text has size 0 and is never taken; a null source is
one of its own, after all others; rows without an id and repeated rows are documents like
any others; targets are 0 if no text has a word; an empty table gives an empty one; other
columns are not looked at. Everything follows from the rows and SEED, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lineflow.llm.common import written

WORD = r"[^\x20\x09-\x0D]+"
#: Words of a block, slots of a shard, and words of a bin, about.
BLOCK, SHARD, BIN_WORDS = 64, 8192, 200_000
#: How often a source's words are taken at most.
PASSES = 3
SEED = 13
#: Sources whose rows are sent to every task; more are joined by a shuffle.
SENT_SOURCES = 20_000
#: Salts of those shuffles' hot sources.
SALTS = 64


def targets(sizes: np.ndarray, weights: np.ndarray, passes: float = PASSES) -> np.ndarray:
    """Shares of all sizes by weight, none above `passes` times its size: what is above is shared again by weight among the others."""
    caps, total, out = passes * sizes.astype(float), float(sizes.sum()), np.zeros(len(sizes))
    free = np.ones(len(sizes), bool)
    while free.any():
        share = (total - caps[~free].sum()) * weights / weights[free].sum()
        over = free & (share > caps)
        if not over.any():
            out[free] = share[free]
            break
        free &= ~over
    out[~free] = caps[~free]
    return out


def _mixed(x: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A hash of unsigned 64-bit integers."""
    x = (x + key) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(index: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Where a pseudorandom permutation of 0 to n - 1, one for each key, puts index.

    A Feistel network of four rounds over the next power of four; what falls outside n goes
    through it again.
    """
    index, n, key = (np.asarray(a).astype(np.uint64) for a in np.broadcast_arrays(index, n, key))
    out = index.copy()
    half = np.maximum(1, np.ceil(np.log2(np.maximum(n, 2).astype(float)) / 2 + 1e-9)).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    todo = np.arange(len(out))
    while len(todo):
        x, h, m = out[todo], half[todo], mask[todo]
        for r in range(4):
            left, right = x >> h, x & m
            x = (right << h) | (left ^ (_mixed(right, key[todo] + np.uint64(r << 56)) & m))
        out[todo] = x
        todo = todo[x >= n[todo]]
    return out.astype(np.int64)


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", texts: bool = False) -> DataFrame:
    """(row, id_col, source, size, h[, text]): documents with the number of their words, as a written table; row numbers it."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    kept = [text.alias("text")] if texts else []
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), F.xxhash64(id_col, text).alias("h"), *kept)
    return written(rows, "mixing")


def _binned(found: DataFrame, spread: DataFrame) -> DataFrame:
    return _with_source(found.where("size > 0"), spread).withColumn("bin", F.pmod("h", "bins"))


def _with_source(rows: DataFrame, spread: DataFrame) -> DataFrame:
    """rows with the columns of their source's row."""
    same = lambda r, s: r["source"].eqNullSafe(s["source"])
    r, s = rows.alias("r"), spread.alias("s")
    if spread.count() <= SENT_SOURCES:
        return r.join(F.broadcast(s), F.col("r.source").eqNullSafe(F.col("s.source"))).select("r.*", *(f"s.{c}" for c in spread.columns if c != "source"))
    s = spread.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).alias("s")
    r = rows.withColumn("salt", F.pmod("h", F.lit(SALTS))).alias("r")
    return r.join(s, (F.col("r.salt") == F.col("s.salt")) & F.col("r.source").eqNullSafe(F.col("s.source"))).select(*(f"r.{c}" for c in rows.columns), *(f"s.{c}" for c in spread.columns if c != "source"))


def pieces_of_blocks(found: DataFrame, spread: DataFrame, block: int = BLOCK, texts: bool = False) -> DataFrame:
    """(k, bin, local, row, start, n[, words]): n words from `start` of a document in the block `local` of its source's bin."""
    order = Window.partitionBy("k", "bin").orderBy("h", "size")
    rows = _binned(found, spread).withColumn("end", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))).withColumn("begin", F.col("end") - F.col("size"))
    whole = lambda c: F.floor(c / block).cast("long")
    words = F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1)) if texts else None
    rows = rows.withColumn("words", words) if texts else rows

    def piece(b: Column) -> Column:
        start = F.greatest(b * block, F.col("begin")) - F.col("begin")
        n = F.least((b + 1) * block, F.col("end")) - F.col("begin") - start
        some = [F.array_join(F.slice("words", (start + 1).cast("int"), n.cast("int")), " ").alias("words")] if texts else []
        return F.struct(b.alias("local"), start.alias("start"), n.alias("n"), *some)

    cut = F.transform(F.sequence(whole(F.col("begin")), whole(F.col("end") - 1)), piece)
    return rows.select("k", "bin", "row", F.explode(cut).alias("p")).select("k", "bin", "row", "p.*")


def slots(blocks: np.ndarray, quota: np.ndarray, shard: int, seed: int, spark) -> DataFrame:
    """(shard, slot, k, block): the block of source k in each slot of the mix; quota slots of each source."""
    total, share = int(quota.sum()), quota / max(quota.sum(), 1)
    shards = -(-total // shard)

    def draw(number: int) -> np.ndarray:
        return np.random.default_rng([seed, number]).multinomial(min(shard, total - number * shard), share)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for number in batch["id"]:
                n = draw(int(number))
                yield pd.DataFrame({"shard": number, "k": np.flatnonzero(n), "n": n[n > 0]})

    counts = spark.range(0, shards, 1, max(1, -(-shards // 64))).mapInPandas(count, "shard long, k int, n long")
    counts = written(counts, "mixing-draws")  # a row for each shard and source
    before = Window.partitionBy("k").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    ranked = counts.select("shard", "k", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    drawn = np.zeros(len(quota), np.int64)
    for k, n in counts.groupBy("k").agg(F.sum("n")).collect():  # a row for each source
        drawn[k] = n
    over, under = np.maximum(drawn - quota, 0), np.maximum(quota - drawn, 0)
    given, taken = np.cumsum(over) - over, np.cumsum(under)

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for number, k, n, first in batch[["shard", "k", "n", "first"]].itertuples(index=False):
                sources, rank = np.full(n, k), permuted(first + np.arange(n), np.int64(drawn[k]), np.int64(seed * 1_000_003 + k))
                spare = rank >= quota[k]
                extra = given[k] + rank[spare] - quota[k]  # among all draws over a quota
                sources[spare] = np.searchsorted(taken, extra, "right")
                rank[spare] = drawn[sources[spare]] + extra - (taken - under)[sources[spare]]
                size = blocks[sources]
                which = permuted(rank % size, size, (rank // size) * 7_919 + sources + seed * 1_000_033 + (1 << 40))
                yield pd.DataFrame({"shard": number, "k": sources, "block": which})

    filled = ranked.repartition(max(1, -(-shards // 16)), "shard").sortWithinPartitions("shard", "k").mapInPandas(fill, "shard long, k int, block long")
    return filled


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, block: int = BLOCK, shard: int = SHARD, seed: int = SEED, texts: bool = True, **columns: str) -> tuple[DataFrame, DataFrame]:
    """(documents, mixed).

    documents: row, doc_id, source, size, source_size, target. mixed: shard, source, block,
    row, start, n[, words]: n words from `start` of the document with that row number; the
    pieces of one block that stands in a shard twice are there twice. Without weights
    sources weigh 1, 2, 3, repeating, in order of code points, null last.
    """
    spark, found = docs.sparkSession, sized(docs, texts=texts, **columns)
    sums = found.groupBy("source").agg(F.sum("size").alias("size")).collect()
    sums = sorted(sums, key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    size = np.array([r["size"] for r in sums], np.int64)
    weight = np.array([1 + i % 3 if weights is None else weights.get(r["source"], 0) for i, r in enumerate(sums)], float)
    target = targets(size, weight)
    bins = np.maximum(1, size // BIN_WORDS)
    table = [(r["source"], i, *map(int, (size[i], bins[i])), float(target[i])) for i, r in enumerate(sums)]
    spread = spark.createDataFrame(table, "source string, k int, source_size long, bins long, target double")
    pieces = pieces_of_blocks(found, spread.select("source", "k", "bins"), block, texts)

    local = _binned(found, spread.select("source", "k", "bins")).groupBy("k", "bin").agg(F.ceil(F.sum("size") / block).cast("long").alias("blocks"))
    before = Window.partitionBy("k").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    local = written(local.select("k", "bin", "blocks", F.coalesce(F.sum("blocks").over(before), F.lit(0)).alias("base")), "mixing-bins")  # a row for each bin
    blocks = np.zeros(len(sums), np.int64)
    for k, n in local.groupBy("k").agg(F.sum("blocks")).collect():
        blocks[k] = n
    quota = np.rint(np.divide(target * blocks, size, out=np.zeros(len(sums)), where=size > 0)).astype(np.int64)
    chosen = slots(blocks, quota, shard, seed, spark)
    numbered = pieces.join(local.select("k", "bin", "base"), ["k", "bin"]).withColumn("block", F.col("base") + F.col("local"))
    # Spark takes the slots for as few as the draws that they come from, and would broadcast them
    mixed = numbered.hint("merge").join(chosen, ["k", "block"]).select("shard", "k", "block", "row", "start", "n", *(["words"] if texts else []))
    documents = _with_source(found.drop("text"), spread).select("row", "doc_id", "source", "size", "source_size", "target", "k")
    return documents, mixed


def taken(documents: DataFrame, mixed: DataFrame) -> DataFrame:
    """documents with the number of their words in the mix, repeats counted."""
    words = mixed.groupBy("row").agg(F.sum("n").alias("taken"))
    return documents.join(words, "row", "left").withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long"))
