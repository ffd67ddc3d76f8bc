"""Discovery of new files from a listing, partition look-back, typed reads."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

from lineflow.functions.ports import directory_ts
from lineflow.sources.scratch import stored
from lineflow.sources.stores import locate

#: Files whose footers a task opens, about.
FILES_PER_TASK = 500


def listing(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, mtime, length) of the files under a path; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return files.select("path", F.col("modificationTime").alias("mtime"), "length")


def select_new_files(listed: DataFrame, processed: DataFrame, low: Column, high: Column) -> DataFrame:
    """Files of (path, mtime) that aren't processed yet, oldest first.

    A file is skipped if it isn't newer than the low mark, or if it isn't newer than the
    high mark and is in processed with the same or a newer time. A rewritten file with a
    newer time is taken again.
    """
    seen = processed.groupBy("path").agg(F.max("mtime").alias("seen"))
    fresh = listed.where(F.col("mtime") > low).join(seen, "path", "left")
    return fresh.where(~((F.col("mtime") <= high) & F.coalesce(F.col("mtime") <= F.col("seen"), F.lit(False)))).drop("seen").orderBy("mtime", "path")


def advance_marks(taken: DataFrame, processed: DataFrame, low: Column, high: Column, offset: Column) -> tuple[DataFrame, DataFrame]:
    """After a scan: one row (low, high), and the processed files that still matter.

    The high mark is the newest time seen; the low mark follows it by the offset and never
    goes back. Only files newer than the low mark are kept.
    """
    marks = taken.agg(F.max("mtime").alias("m")).select(F.greatest(F.coalesce("m", high), high).alias("high"))
    marks = marks.select(F.greatest(F.col("high") - offset, low).alias("low"), "high")
    every = processed.select("path", "mtime").unionByName(taken.select("path", "mtime")).groupBy("path").agg(F.max("mtime").alias("mtime"))
    kept = every.join(F.broadcast(marks.select("low")), F.col("mtime") > F.col("low")).select("path", "mtime")  # marks is one row
    return marks, kept


def select_new_files_deferred(listed: DataFrame, mark: Column, now: Column, buffer: Column) -> DataFrame:
    """Files newer than the mark and at least a buffer old; the next mark is now - buffer, and no list is kept."""
    return listed.where((F.col("mtime") > mark) & (F.col("mtime") <= now - buffer))


def scan_dir_chunk(listed: DataFrame, mark: Column, chunk_s: int = 900, rescan_s: int = 2700, time_of: Callable[[Column], Column] = directory_ts) -> DataFrame:
    """Files of the next chunk of directories, with dir_ts; time_of(path) tells a directory's time, from yyyyMMdd/HHmm by default.

    Directories from rescan_s before the mark on are looked at. Those up to the mark are
    scanned again; of the newer ones those of the first chunk that isn't empty are taken,
    so empty stretches are jumped over.
    """
    dirs = listed.withColumn("dir_ts", time_of(F.col("path"))).where(F.col("dir_ts") >= mark - F.expr(f"interval {rescan_s} seconds"))
    seconds = F.unix_timestamp("dir_ts") - F.unix_timestamp(mark)
    chunk = F.greatest(F.ceil(seconds / chunk_s), F.lit(0))  # 0: up to the mark
    numbered = dirs.withColumn("chunk", chunk)
    first = numbered.where("chunk > 0").agg(F.min("chunk").alias("first"))  # one row
    return numbered.join(F.broadcast(first), F.expr("chunk = 0 or chunk = first")).select(*listed.columns, "dir_ts")


def within_lookback(df: DataFrame, dt: str, today: Column, days: int, fmt: str = "yyyyMMdd") -> DataFrame:
    """Rows of partitions not older than the look-back; partitions whose name isn't a date stay."""
    day = F.try_to_timestamp(F.col(dt).cast("string"), F.lit(fmt)).cast("date")
    return df.where(F.coalesce(day >= F.date_sub(today, days), F.lit(True)))


def read_reported(spark: SparkSession, path: str, schema: StructType, glob: str = "*.parquet") -> tuple[DataFrame, DataFrame]:
    """(rows, report): what can be read of the named fields with their types, with each row's file_path, and the files that gave less than they hold.

    report: (path, rows_read, rows_held, error). A file whose footer can't be read has a
    null rows_held and the error; one that breaks off, or lacks a field or has it with
    another type, has fewer rows than its footer tells. Files are opened by tasks.
    """
    spark_files = listing(spark, path, glob).select("path")
    wanted = {f.name: f.dataType.simpleString() for f in schema.fields}

    def footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for name in batch.column(0).to_pylist():
                try:
                    client, where, _ = locate(name)
                    with client.open_input_file(where) as f:
                        found = pq.ParquetFile(f)
                        there = {x.name: x.dataType.simpleString() for x in from_arrow_schema(found.schema_arrow).fields}
                        wrong = [n for n, t in wanted.items() if there.get(n) != t]
                        out.append((name, found.metadata.num_rows, f"missing or of another type: {', '.join(wrong)}" if wrong else None))
                except (OSError, ValueError, pa.ArrowException) as e:
                    out.append((name, None, f"{type(e).__name__}: {e}"[:500]))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else ([], [], []), (pa.string(), pa.int64(), pa.string()))], ["path", "rows_held", "error"])

    held = stored(spark_files.repartition(max(1, -(-spark_files.count() // FILES_PER_TASK))).mapInArrow(footers, "path string, rows_held long, error string"), "footers")
    good = held.where("error is null").select("path")
    every = spark.read.schema(schema).option("ignoreCorruptFiles", True).option("recursiveFileLookup", True).option("pathGlobFilter", glob).parquet(path)
    rows = every.select("*", F.regexp_replace("_metadata.file_path", "^file:/+", "file:/").alias("file_path"))
    rows = rows.join(good.withColumnRenamed("path", "file_path"), "file_path", "left_semi")  # a row per file
    counted = rows.groupBy("file_path").agg(F.count("*").alias("n"), *(F.count(F.col(f"`{n}`")).alias(f"__{i}") for i, n in enumerate(wanted)))
    counted = counted.select("file_path", F.greatest("n", F.lit(0), *(f"__{i}" for i in range(len(wanted)))).alias("n"))  # that is n, but makes Spark read the columns
    report = held.join(counted, F.col("path") == F.col("file_path"), "left").select("path", F.coalesce("n", F.lit(0)).alias("rows_read"), "rows_held", "error")
    return rows, report.where("error is not null or rows_read < rows_held")


def read_typed(spark: SparkSession, path: str, schema: StructType, skip_corrupt: bool = True) -> DataFrame:
    """Only the named fields, with their types; a missing field or other type is an error, an unreadable file is skipped."""
    there = {f.name: f.dataType for f in spark.read.parquet(path).schema.fields}
    wrong = [f.name for f in schema.fields if there.get(f.name) != f.dataType]
    if wrong:
        raise ValueError(f"missing or of another type: {', '.join(wrong)}")
    return spark.read.schema(schema).option("ignoreCorruptFiles", skip_corrupt).parquet(path)
