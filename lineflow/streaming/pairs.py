"""Pairing on streams: by a state processor over one stream of files, or by a stream-stream join of two."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from lineflow.functions.ports import INSTANT


PAIR = Row("name", "window_start", "left_path", "left_ts", "left_mtime", "right_path", "right_ts", "right_mtime")


class PairProcessor(StatefulProcessor):
    """Both files of a name and window, as soon as they are there; files that stay alone when the watermark passes the window's end.

    Rows: name, window_start, end_ms, path, ts, mtime, dslam_type. Of several files of one
    kind the first to arrive counts, in one batch the oldest; others are ignored once there
    is a pair, and are alone with the first if there is none.
    """

    output = "name string, window_start timestamp, left_path string, left_ts timestamp, left_mtime timestamp, right_path string, right_ts timestamp, right_mtime timestamp"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "path string, ts timestamp, mtime timestamp, left boolean")
        self.done = handle.getValueState("done", "done boolean")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        rows = sorted(rows, key=lambda r: (r.mtime, r.path))
        if not self.held.exists() and not self.done.exists():
            self.handle.registerTimer(rows[0].end_ms)
        if self.done.exists():
            return
        new = [(r.path, r.ts, r.mtime, r.dslam_type == INSTANT) for r in rows]
        held = [*map(tuple, self.held.get()), *new]
        first = {left: next((h for h in held if h[3] == left), None) for left in (True, False)}
        if first[True] and first[False]:
            self.held.clear()
            self.done.update((True,))
            yield self._row(key, first[True], first[False])
        else:
            self.held.appendList(new)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        if not self.done.exists():
            for h in map(tuple, self.held.get()):
                yield self._row(key, h if h[3] else None, None if h[3] else h)
        self.held.clear()
        self.done.clear()

    @staticmethod
    def _row(key: Any, left: tuple | None, right: tuple | None) -> Row:
        nothing = (None,) * 3
        return PAIR(*key, *(left or nothing)[:3], *(right or nothing)[:3])

    def close(self) -> None:
        pass


def pair_files(named: DataFrame, size: str, lateness: str) -> DataFrame:
    """name_only() rows of a stream -> pairs, and lone files with nulls on the other side, in the columns of pair_by_name().

    One source and one state do for both sides. Rows behind the watermark are dropped by Spark.
    """
    rows = named.where("error is null").select("name", F.window("ts", size).alias("w"), "path", "ts", "mtime", "dslam_type")
    rows = rows.select("name", F.col("w.start").alias("window_start"), F.unix_millis("w.end").alias("end_ms"), "path", "ts", "mtime", "dslam_type")
    grouped = rows.withWatermark("ts", lateness).groupBy("name", "window_start")
    return grouped.transformWithState(PairProcessor(), StructType.fromDDL(PairProcessor.output), "Append", "EventTime")


def pair_stream(left: DataFrame, right: DataFrame, key: str, ts: str, size: str, lateness: str, values: list[str]) -> DataFrame:
    """(key, window_start, left_<value>.., right_<value>..) as soon as both sides are there.

    The first row of a side counts. A side that stays alone comes out with nulls once the
    watermark, which trails by the allowed lateness, has passed the window's end. Rows
    later than that are dropped by Spark; late_reconcile() of the batch side finds them.
    """

    def side(df: DataFrame, name: str) -> DataFrame:
        rows = df.withWatermark(ts, lateness).select(key, F.window(ts, size).alias("w"), *values)
        rows = rows.dropDuplicatesWithinWatermark([key, "w"])
        return rows.select(F.col(key).alias(f"{name}_key"), F.col("w").alias(f"{name}_w"), *(F.col(v).alias(f"{name}_{v}") for v in values))

    both = side(left, "left").join(side(right, "right"), F.expr("left_key = right_key and left_w = right_w"), "full_outer")
    columns = [f"{s}_{v}" for s in ("left", "right") for v in values]
    return both.select(F.coalesce("left_key", "right_key").alias(key), F.coalesce("left_w.start", "right_w.start").alias("window_start"), *columns)


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Runs a stream over what is there into a Parquet table, and reads it."""
    query = stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def run_continuous(stream: DataFrame, path: str, checkpoint: str, interval: str = "10 seconds"):
    """Starts a stream that looks for new input at an interval; returns the running query."""
    return stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(processingTime=interval).start(path)


def fan_out(stream: DataFrame, sinks: dict[str, Callable[[DataFrame, int], None]], tag: str, checkpoint: str):
    """Tagged rows to several sinks in one pass: sinks[tag value](rows, batch id)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        for value, sink in sinks.items():
            sink(batch.where(F.col(tag) == value).drop(tag), batch_id)
        batch.unpersist()

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
