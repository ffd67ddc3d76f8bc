"""The watch loop beside the line job: commands switch lines on and off, history seeds them, and a line that is well again is reported and switched off.

Two streams work on the sinks of the line job. The first takes commands and the records
that arrive: a command for a service is looked up in the records written so far, which
tell its line and the newest rows of it; a command without history waits in a table of
retries, and is looked up again when records come. What is found goes to a log of
toggles. The second has gate, pattern and feedback in one state by line, over the log of
toggles and the records; its matches are a table.

Both read folders whose batches may be written again after a failure, so the second
counts a row once, however often it comes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lineflow.operators import enrich, health, tables
from lineflow.streaming.processors import MonitorLoopProcessor, process, tagged_events

#: Of the records' sink, what the loop needs.
RECORDS = "ts long, dslam string, port string, avc string, reInit int, uas int, ifOperStatus boolean, batch_id int, dt string"
TOGGLES = "avc string, dslam string, port string, flag boolean, ts timestamp, held array<struct<reInit:int,uas:int,up:boolean>>, batch_id int"
_LINE = ["dslam", "port"]


def _records(rows: DataFrame) -> DataFrame:
    return rows.select(F.timestamp_millis("ts").alias("ts"), *_LINE, "avc", "reInit", "uas", "ifOperStatus", "dt")


def _start(writer, checkpoint: str, interval: str | None) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def look_up(requests: DataFrame, history: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """(toggles, retries) of requests (avc, flag, ts): with the line of the service and, if switched on, its newest n rows before that time."""
    _, found, retries = enrich.history_lookup(requests, history, "avc", "ts", n, ["reInit", "uas", "ifOperStatus", *_LINE], _LINE)
    return health.seed_toggles(found, history, _LINE, "ts", n), retries


def command_stream(spark: SparkSession, commands: DataFrame, out: str, checkpoint: str, n: int, days: int | None = None, interval: str | None = None) -> StreamingQuery:
    """Starts the look-up of a stream of commands (avc, flag, ts) in the records under out; days bounds how far back history is read."""
    arrived = spark.readStream.schema(RECORDS).option("ignoreMissingFiles", True).parquet(f"{out}/records")
    tagged = commands.select("avc", "flag", "ts").unionByName(arrived.where("avc is not null").select("avc", F.lit(None).cast("boolean").alias("flag"), F.timestamp_millis("ts").alias("ts")))

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        asked = batch.where("flag is not null").distinct()
        if batch_id:
            waiting = tables.live(spark, f"{out}/retries", "avc string, flag boolean, ts timestamp, batch_id int")
            asked = asked.unionByName(waiting.where(F.col("batch_id") == batch_id - 1).drop("batch_id"))
        asked = asked.persist()
        history = _records(tables.live(spark, f"{out}/records", RECORDS)).where("avc is not null")
        if days is not None:
            history = history.where(F.col("dt") >= F.date_format(F.date_sub(F.current_date(), days), "yyyy-MM-dd"))
        toggles, retries = look_up(asked, history, n)
        kind = TOGGLES.split("held ")[1].rsplit(", batch_id", 1)[0]
        tables.write_batch(toggles.select("avc", *_LINE, "flag", "ts", F.col("held").cast(kind).alias("held")), f"{out}/toggles", batch_id)
        tables.write_batch(retries.select("avc", "flag", "ts"), f"{out}/retries", batch_id)
        asked.unpersist()

    return _start(tagged.writeStream.foreachBatch(write), checkpoint, interval)


def monitor_stream(spark: SparkSession, out: str, checkpoint: str, n: int = 288, m: int = 8, max_reinit: int = 5, max_uas: int = 10, lateness: str = "120 minutes", interval: str | None = None) -> StreamingQuery:
    """Starts gate, pattern and feedback over the records and toggles under out; matches (key, ts, id) go to out/matches."""
    line = F.concat_ws(":", *_LINE).alias("key")
    read = lambda name, schema: spark.readStream.schema(schema).option("ignoreMissingFiles", True).parquet(f"{out}/{name}")
    events = _records(read("records", RECORDS)).withColumn("event_id", F.xxhash64(*_LINE, "ts")).select(line, "ts", "event_id", "reInit", "uas", "ifOperStatus")
    toggles = read("toggles", TOGGLES).select(line, "ts", "flag", "held")
    tagged = tagged_events(events, toggles, "key")
    found = process(tagged, MonitorLoopProcessor(tagged.schema, n, m, max_reinit, max_uas), lateness)
    return _start(found.writeStream.format("parquet").option("path", f"{out}/matches"), checkpoint, interval)


def watch_list(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(key, flag) of every line that the monitor has a state of, as of its last batch; the stream may be running or stopped."""
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "state").load()
    return state.groupBy("key.key").agg(F.max("value.flag").alias("flag"))


def export_stream(spark: SparkSession, triggers: DataFrame, monitor_checkpoint: str, out: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Starts the export of the watch list: each batch with a line (value) in the stream of triggers writes the list as it is then."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch.where("trim(value) <> ''").limit(1).count():
            tables.write_batch(watch_list(batch.sparkSession, monitor_checkpoint), f"{out}/watch-list", batch_id)

    return _start(triggers.writeStream.foreachBatch(write), checkpoint, interval)
