"""Sinks: Parquet by date, keyed upserts and replacements."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lineflow.sources.stores import locate


#: Files that a task holds open while it writes by a column, and bytes of a row group: what it buffers at most is their product.
OPEN_FILES, ROW_GROUP = 8, 32 << 20
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def _write_by(column: str, df: DataFrame, path: str, mode: str = "errorifexists", form: str = "parquet") -> None:
    """Directories of a column's values.

    Of a task's rows only those beyond its first OPEN_FILES values are sorted; by default Spark sorts them all, and spills
    what its memory doesn't hold. Where the session sets the number of writers itself, that holds.
    """
    conf, writer = df.sparkSession.conf, df.write.mode(mode).partitionBy(column).format(form)
    if conf.get(_WRITERS, None) is not None:
        return writer.save(path)
    conf.set(_WRITERS, OPEN_FILES)
    try:
        writer.option("parquet.block.size", ROW_GROUP).save(path)
    finally:
        conf.unset(_WRITERS)


def write_by_date(df: DataFrame, path: str, ts: str, fmt: str = "yyyy-MM-dd", mode: str = "append") -> None:
    """Parquet in dt=<date of ts> directories, UTC."""
    _write_by("dt", df.withColumn("dt", F.date_format(ts, fmt)), path, mode)


def write_lines_by_date(lines: DataFrame, path: str, fmt: str = "yyyy-MM-dd", mode: str = "append") -> None:
    """Text lines (one string column) in dt=<date of writing> directories, UTC."""
    _write_by("dt", lines.withColumn("dt", F.date_format(F.current_timestamp(), fmt)), path, mode, "text")


# Logs of batches. A log holds folders batch_id=../run=..; the file _live.json names those that
# count and is replaced in one step. So a reader sees a batch that is written again, or a
# compaction, wholly or not at all. One job at a time writes a log.


def _pointer(path: str) -> tuple:
    client, where, _ = locate(path.rstrip("/"))
    return client, where, f"{where}/_live.json"


def live_folders(path: str) -> list[str]:
    """The folders of a log that count, in order of batches."""
    client, _, name = _pointer(path)
    try:
        with client.open_input_stream(name, compression=None) as f:
            return json.loads(f.read())["folders"]
    except FileNotFoundError:
        return []


def _publish(path: str, folders: list[str]) -> None:
    client, where, name = _pointer(path)
    temporary = f"{where}/_live-{uuid.uuid4().hex}"
    with client.open_output_stream(temporary, compression=None) as f:
        f.write(json.dumps({"folders": folders}).encode())
    client.move(temporary, name)


def _batch_of(folder: str) -> int:
    return int(folder.split("/", 1)[0].removeprefix("batch_id="))


def _append(path: str, batch_id: int, write: Callable[[str], None], replaced: Callable[[int], bool] | None = None) -> None:
    """Writes a new folder of a batch, and then makes it count instead of those that it replaces: the batch's own, as a rule."""
    folder = f"batch_id={batch_id}/run={uuid.uuid4().hex}"
    write(f"{path}/{folder}")
    kept = [f for f in live_folders(path) if not (replaced or batch_id.__eq__)(_batch_of(f))]
    _publish(path, sorted([*kept, folder], key=_batch_of))


def live(spark: SparkSession, path: str, schema: str | None = None, format: str = "parquet") -> DataFrame:
    """The rows of a log as of now, with batch_id; a frame keeps its version, whatever is written later. Without a batch, an empty frame needs a schema."""
    folders = live_folders(path)
    if not folders:
        return spark.createDataFrame([], schema or "batch_id int")
    reader = spark.read.option("basePath", path)
    return (reader.schema(schema) if schema else reader).format(format).load([f"{path}/{f}" for f in folders]).drop("run")


def vacuum(path: str) -> int:
    """Deletes the folders that don't count any more, and how many; not to be run while older versions are being read."""
    client, where, _ = _pointer(path)
    live_ones, gone = set(live_folders(path)), 0
    for batch in client.get_file_info(pafs.FileSelector(where, allow_not_found=True)):
        if batch.base_name.startswith("batch_id="):
            for run in client.get_file_info(pafs.FileSelector(batch.path)):
                if f"{batch.base_name}/{run.base_name}" not in live_ones:
                    client.delete_dir(run.path)
                    gone += 1
    return gone


def upsert_by_key(batch: DataFrame, path: str, batch_id: int, day: str) -> None:
    """Appends a batch to the change log; a replayed batch replaces all that it wrote before, so replays change nothing."""
    rows = batch.withColumn("day", F.date_format(day, "yyyyMMdd"))
    _append(path, batch_id, lambda folder: _write_by("day", rows, folder))


def compact(spark: SparkSession, path: str, keys: list[str], order: str, last: int) -> None:
    """Makes the batches of a change log up to `last` one: a row of each key and day. Its view stays as it is, and readers need do nothing."""
    merged = _upserted(live(spark, path).where(F.col("batch_id") <= last), keys, order)
    _append(path, last, lambda folder: _write_by("day", merged, folder), lambda b: b <= last)


def compact_by_date(spark: SparkSession, path: str, last: int, files_per_date: int = 1) -> None:
    """Makes the many small files of the batches up to `last` few: files_per_date of each dt. The rows stay as they are, under batch `last`."""
    rows = live(spark, path).where(F.col("batch_id") <= last).drop("batch_id")
    dealt = rows.repartition("dt", (F.rand(1) * files_per_date).cast("int"))
    _append(path, last, lambda folder: _write_by("dt", dealt, folder), lambda b: b <= last)


def write_batch(batch: DataFrame, path: str, batch_id: int) -> None:
    """Parquet by batch; a replayed batch replaces its own."""
    _append(path, batch_id, batch.write.parquet)


def write_batch_by_date(batch: DataFrame, path: str, batch_id: int, ts: str, fmt: str = "yyyy-MM-dd") -> None:
    """write_by_date() for a stream's batches: a replayed batch replaces its own."""
    _append(path, batch_id, lambda folder: write_by_date(batch, folder, ts, fmt))


def write_batch_lines(lines: DataFrame, path: str, batch_id: int, fmt: str = "yyyy-MM-dd") -> None:
    """write_lines_by_date() for a stream's batches, likewise."""
    _append(path, batch_id, lambda folder: write_lines_by_date(lines, folder, fmt))


def upserted(spark: SparkSession, path: str, keys: list[str], order: str) -> DataFrame:
    """The view of the change log: of each field the newest value that is present, by key and day."""
    return _upserted(live(spark, path), keys, order)


def _upserted(log: DataFrame, keys: list[str], order: str) -> DataFrame:
    values = [c for c in log.columns if c not in (*keys, "day", "batch_id", order)]
    newest = [F.max_by(c, F.when(F.col(c).isNotNull(), F.struct("batch_id", order))).alias(c) for c in values]
    return log.groupBy(*keys, "day").agg(F.max(order).alias(order), *newest)


def replaced(spark: SparkSession, path: str, keys: list[str], order: str) -> DataFrame:
    """The same log with whole rows: the newest row of each key counts."""
    log = live(spark, path)
    values = [c for c in log.columns if c not in (*keys, "batch_id")]
    newest = log.groupBy(*keys).agg(F.max_by(F.struct(*values), F.struct("batch_id", order)).alias("x"))
    return newest.select(*keys, "x.*")
