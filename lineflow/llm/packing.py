"""Packing along a space-filling curve.

A document's hashed word vector is projected to a few dimensions; the Hilbert key of
that point orders the corpus, so that similar documents become neighbours. Spark sorts
by ranges of the key, whose bounds come from a sample of keys; sequences are cut from
the row of all ids along the curve. Only sums by range go to one task.

Every sequence holds `length` ids but for those made of the remainder: it is cut into
powers of two, which need no padding.

Results in odd cases: a null text is an empty one and has the end id only; repeated rows
are each packed; documents with one key keep the order of id and of a hash of their
text; an empty table gives no pieces; other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lineflow.llm.common import release, released, tokenizer_path, written
from lineflow.llm.tokens import word_tokenizer

LENGTH = 2048
#: Buckets of the hashed word vector, dimensions it is projected to, bits of each in the key.
BUCKETS, DIMENSIONS, BITS = 4096, 4, 12
#: Bytes of text of a range while there are MANY_RANGES at most, and beyond that.
RANGE_BYTES, MANY_RANGES, LARGE_RANGE_BYTES = 16 << 20, 10_000, 256 << 20
#: A range for each core, as long as it has so many bytes.
LEAST_BYTES = 2 << 20
#: Keys of the sample that a range's bounds are taken from, and of all ranges at most.
SAMPLE, SAMPLE_KEYS = 100, 2_000_000
#: Words that are hashed at a time.
SLICE = 1 << 18
#: Bytes of ids that are gathered before rows are handed on.
BATCH_BYTES = 4 << 20


def project(text: bytes | None, matrix: np.ndarray) -> np.ndarray:
    """The text's word vector, of unit length, times a fixed random matrix."""
    words = (text or b"").lower().split()
    counts = np.zeros(BUCKETS)
    for at in range(0, len(words), SLICE):
        part = words[at : at + SLICE]
        counts += np.bincount(np.fromiter(map(zlib.crc32, part), np.int64, len(part)) % BUCKETS, minlength=BUCKETS)
    return counts @ matrix / max(np.sqrt(counts @ counts), 1e-9)


def hilbert_key(points: np.ndarray, bits: int) -> np.ndarray:
    """Position of integer points (n, dimensions), each under 2**bits, along the Hilbert curve.

    Skilling's transform: undo the excess turns from the top bit down, Gray-encode, and
    interleave the bits.
    """
    x = points.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(n):
            set_ = (x[i] & q) != 0
            swap = np.where(set_, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] = np.where(set_, x[0] ^ (q - 1), x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn = np.where((x[n - 1] & q) != 0, turn ^ (q - 1), turn)
        q >>= 1
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | (((x[i] ^ turn) >> b) & 1)
    return key


def curve_keys(texts: list[bytes | None]) -> np.ndarray:
    matrix = np.random.default_rng(9).normal(size=(BUCKETS, DIMENSIONS))
    points = np.array([project(t, matrix) for t in texts]).reshape(-1, DIMENSIONS)
    grid = np.clip((points + 3) / 6 * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)
    return hilbert_key(grid, BITS)


def range_count(n_bytes: int, cores: int = 1) -> int:
    """Ranges for so many bytes of text; their size is what a task has to hold, and small inputs have one for each core."""
    return max(1, min(-(-n_bytes // RANGE_BYTES), MANY_RANGES), -(-n_bytes // LARGE_RANGE_BYTES), min(cores, n_bytes // LEAST_BYTES))


def range_bounds(rows: DataFrame) -> np.ndarray:
    """Keys that cut the curve into range_count() ranges of about equal numbers, from a sample of SAMPLE rows a range, about.

    A key that fills several ranges is a bound several times; its rows are dealt over them.
    """
    size = rows.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    n = range_count(size["bytes"], rows.sparkSession.sparkContext.defaultParallelism)
    share = min(1.0, min(n * SAMPLE, SAMPLE_KEYS) / max(size["rows"], 1))

    @F.pandas_udf("long")
    def key(text: pd.Series) -> pd.Series:
        return pd.Series(curve_keys(list(text)))

    some = rows.sample(share, seed=5) if share < 1 else rows
    keys = np.sort(some.select(key(F.col("text").cast("binary")).alias("key")).toPandas()["key"].to_numpy(np.int64))
    return keys[[len(keys) * i // n for i in range(1, n)]] if len(keys) else np.zeros(0, np.int64)


def along_curve(docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(part, before, doc_id, n_tokens, ids binary, width): the tokenized documents in curve order, written to the shared folder."""
    vocabulary = tokenizer or tokenizer_path()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    bounds = range_bounds(rows)
    n = len(bounds) + 1

    @F.pandas_udf("key long, range int")
    def place(text: pd.Series, salt: pd.Series) -> pd.DataFrame:
        keys = curve_keys(list(text))
        release()
        first = np.searchsorted(bounds, keys, "left")
        return pd.DataFrame({"key": keys, "range": first + salt.to_numpy() % (np.searchsorted(bounds, keys, "right") - first + 1)})

    rows = rows.withColumn("at", place(F.col("text").cast("binary"), F.abs(F.monotonically_increasing_id() % 1_000_003)))
    rows = rows.withColumn("h", F.xxhash64("text")).repartitionById(n, F.col("at.range")).sortWithinPartitions("at.key", "id", "h").select("id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, before, held, size = word_tokenizer(vocabulary), 0, [], 0

        def out() -> pa.RecordBatch:
            first, ids, n, data = zip(*held)
            return pa.RecordBatch.from_arrays([pa.array(first, pa.int64()), pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(data, pa.binary()), pa.array([encoder.width] * len(held), pa.int32())], ["before", "doc_id", "n_tokens", "ids", "width"])

        for batch in batches:
            texts = (t.as_py() for t in batch.column(1))
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.documents(texts)):
                held.append((before, doc_id, len(ids), ids.tobytes()))
                before += len(ids)
                size += ids.nbytes
                if size > BATCH_BYTES:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    tokenized = rows.mapInArrow(released(run), "before long, doc_id long, n_tokens long, ids binary, width int")
    return written(tokenized.select(F.spark_partition_id().alias("part"), "*"), "packing", compression="zstd")


def cuts(start: int, end: int, total: int, length: int) -> list[tuple[int, int, int, int]]:
    """(sequence, offset in it, from, to) of the ids start to end in the row of total ids."""
    whole = total // length
    edges = []  # where the sequences of the remainder end
    at = whole * length
    for bit in range(length.bit_length() - 1, -1, -1):
        if (total - whole * length) >> bit & 1:
            at += 1 << bit
            edges.append(at)
    out = []
    while start < end:
        if start < whole * length:
            sequence = start // length
            first, last = sequence * length, (sequence + 1) * length
        else:
            k = next(i for i, e in enumerate(edges) if start < e)
            sequence, first, last = whole + k, edges[k - 1] if k else whole * length, edges[k]
        stop = min(end, last)
        out.append((sequence, start - first, start, stop))
        start = stop
    return out


def pack(docs: DataFrame, length: int = LENGTH, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids (4 bytes each).

    length is a power of two.
    """
    if length & (length - 1):
        raise ValueError("the length of sequences is a power of two")
    rows = along_curve(docs, tokenizer, id_col, text_col)
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"), F.sum("n").over(every).alias("total"))  # a row for each shuffle partition
    rows = rows.join(F.broadcast(parts), "part").select("doc_id", (F.col("first") + F.col("before")).alias("at"), "n_tokens", "total", "ids", "width")
    kinds = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, at, n, total, data, width in zip(*(batch.column(i).to_pylist() for i in range(6))):
                ids = np.frombuffer(data, f"<u{width}").astype("<u4")
                for sequence, offset, first, last in cuts(at, at + n, total, length):
                    part = ids[first - at : last - at].tobytes()
                    out.append((doc_id, first - at, last - first, zlib.crc32(part), n, sequence, offset, part))
            columns = zip(*out) if out else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, kinds)], [k for k, _ in kinds])

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
    return rows.mapInArrow(released(run), schema)
