"""Token ids as files of length-delimited binary records, with a separate offset index.

A record is: payload length (8 bytes), masked checksum of those 8 bytes (4), payload,
masked checksum of the payload (4), newline. The payload is: flag byte (1 if the id is
null), document id (8), bytes of a token id (1), then the token ids. Numbers are
little-endian; a masked checksum is the CRC-32 turned right by 15 bits plus 0xa282ead8.

Spark's text writer writes the files, so that its committer handles lost executors; they
lie in ascending order of id, file by file. A file holds FILE_ROWS runs of records, each
of ROW_BYTES and one record at most, so that it can be read as one value however long the
texts are. The index names each record's file, offset and length, so that a reader can
fetch records in any order.

Results in odd cases: a null text is an empty one and has the end id only; rows with a
null id come first; repeated ids are ordered by a hash of their text; an empty table
gives an empty index; other columns are not looked at; a record that fails a checksum
stops the read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lineflow.llm.common import new_path, tokenizer_path
from lineflow.llm.tokens import word_tokenizer

#: Bytes of records that are written as a run, and runs of a file, at most.
ROW_BYTES, FILE_ROWS = 4 << 20, 8

_MASK = 0xA282EAD8


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + _MASK) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: np.ndarray) -> bytes:
    payload = struct.pack("<?qB", doc_id is None, doc_id or 0, ids.dtype.itemsize) + ids.tobytes()
    length = struct.pack("<Q", len(payload))
    return b"".join([length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload)), b"\n"])


def parse(data: memoryview, at: int) -> tuple[int | None, np.ndarray, int]:
    """(document id, ids, where the next record starts); ValueError if a checksum fails."""
    length, check = struct.unpack_from("<QI", data, at)
    payload = data[at + 12 : at + 12 + length]
    end = at + 12 + length
    if masked(bytes(data[at : at + 8])) != check or len(payload) != length or masked(payload) != struct.unpack_from("<I", data, end)[0]:
        raise ValueError(f"broken record at byte {at}")
    null, doc_id, width = struct.unpack_from("<?qB", payload)
    return None if null else doc_id, np.frombuffer(payload, f"<u{width}", offset=10), end + 5


def write(docs: DataFrame, path: str, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Tokenizes every whole text and writes the record files in ascending order of id."""
    vocabulary = tokenizer or tokenizer_path()
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    order = ["id", "h", "p"]
    rows = rows.withColumn("h", F.xxhash64("text")).withColumn("p", F.spark_partition_id())
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, held, size = word_tokenizer(vocabulary), [], 0
        out = lambda: pa.RecordBatch.from_arrays([pa.array([b"".join(held)[:-1]], pa.binary())], ["run"])  # the writer adds the last newline
        for batch in batches:
            texts = (t.as_py() for t in batch.column(1))
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.documents(texts)):
                held.append(frame(doc_id, ids))
                size += len(held[-1])
                if size >= ROW_BYTES:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    framed = rows.mapInArrow(run, "run binary").select(F.col("run").cast("string").alias("run"))
    framed.write.option("lineSep", "\n").option("maxRecordsPerFile", FILE_ROWS).text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    """(part int, piece int, content binary); the order of (part, piece) is the order of the records."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    name = lambda k: F.regexp_extract("path", r"part-(\d+)-.*-c(\d+)[^/]*$", k).cast("int")
    return files.select(name(1).alias("part"), name(2).alias("piece"), "content")


def index(spark: SparkSession, path: str) -> DataFrame:
    """Reads the files back: where each record lies, its document, tokens and checksum of ids.

    (part, piece, offset, length, doc_id, before, n_tokens, ids_crc32): before counts the
    tokens of the file's earlier records; the checksum is over ids of 4 bytes.
    """
    kinds = [("part", pa.int32()), ("piece", pa.int32()), ("offset", pa.int64()), ("length", pa.int64()), ("doc_id", pa.int64()), ("before", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, piece, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                data, at, before, rows = memoryview(content.as_buffer()), 0, 0, []
                while at < len(data):
                    doc_id, ids, end = parse(data, at)
                    rows.append((part, piece, at, end - at, doc_id, before, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    at, before = end, before + len(ids)
                columns = zip(*rows) if rows else [[]] * len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, kinds)], [k for k, _ in kinds])

    schema = "part int, piece int, offset long, length long, doc_id long, before long, n_tokens long, ids_crc32 long"
    return _files(spark, path).mapInArrow(run, schema)


def write_with_index(docs: DataFrame, tokenizer: str | None = None, path: str | None = None, **columns: str) -> tuple[str, DataFrame]:
    """Writes the record files and, beside them, the index table; returns the path and the index."""
    spark = docs.sparkSession
    path = path or new_path(spark, "records")
    write(docs, path + "/data", tokenizer, **columns)
    found = index(spark, path + "/data")
    found.write.parquet(path + "/index")
    return path, spark.read.schema(found.schema).parquet(path + "/index")


def numbered(found: DataFrame) -> DataFrame:
    """The index with start, the tokens of all records before: files are summed up by part, and the few parts in one window."""
    earlier = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = found.groupBy("part", "piece").agg(F.sum("n_tokens").alias("n"))
    parts = files.groupBy("part").agg(F.sum("n").alias("n")).select("part", earlier(Window.orderBy("part")).alias("of_parts"))
    files = files.select("part", "piece", earlier(Window.partitionBy("part").orderBy("piece")).alias("of_files"))
    files = files.join(parts, "part").select("part", "piece", (F.col("of_parts") + F.col("of_files")).alias("first"))
    return found.join(files, ["part", "piece"]).withColumn("start", F.col("first") + F.col("before"))


def read(spark: SparkSession, path: str, chosen: DataFrame, seed: int | None = None) -> DataFrame:
    """(doc_id, ids array<int>) of the records that rows of the index name.

    With a seed the result is in shuffled order; the shuffle moves the records, as each
    file is opened by one task.
    """

    def run(key, files: pa.Table, wanted: pa.Table) -> pa.Table:
        data = memoryview(files.column(0)[0].as_buffer()) if files.num_rows else b""
        rows = [parse(data, at)[:2] for at in wanted.column("offset").to_pylist()]
        return pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "ids": pa.array([r[1].astype(np.int32) for r in rows], pa.list_(pa.int32()))})

    files = _files(spark, path + "/data").groupBy("part", "piece")
    wanted = chosen.select("part", "piece", "offset").groupBy("part", "piece")
    found = files.cogroup(wanted).applyInArrow(lambda k, f, w: run(k, f.select(["content"]), w), "doc_id long, ids array<int>")
    return found if seed is None else found.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id")
