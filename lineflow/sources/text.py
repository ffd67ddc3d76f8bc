"""Line formats: percentile tables, inventory, watch commands."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_COMMAND = r"^(AVC\d{12})(?:[, ](?:(on|true)|(off|false)))?$"


def parse_percentiles(lines: DataFrame, value: str = "value") -> DataFrame:
    """JSON lines -> (key `Tier,Attenuation`, pctls array<float>); lines that aren't objects or have no list go."""
    parsed = F.from_json(value, "Tier string, Attenuation double, Percentiles array<float>")
    rows = lines.select(parsed.alias("x")).where("x.Percentiles is not null")
    key = F.concat_ws(",", F.coalesce("x.Tier", F.lit("")), F.coalesce(F.col("x.Attenuation").cast("int"), F.lit(0)))
    return rows.select(key.alias("key"), F.col("x.Percentiles").alias("pctls"))


def parse_inventory_csv(lines: DataFrame, value: str = "value") -> DataFrame:
    """`x,dslam,port,avc,number` lines -> (ts, dslam, port, avc, cpi); the number is both ts and cpi, bad lines go."""
    part = F.split(value, ",", -1)
    rows = lines.select(F.get(part, F.lit(4)).try_cast("long").alias("ts"), F.get(part, F.lit(1)).alias("dslam"), F.get(part, F.lit(2)).alias("port"), F.get(part, F.lit(3)).alias("avc"), F.get(part, F.lit(4)).alias("cpi"))
    return rows.where("ts is not null")


def parse_watch_commands(lines: DataFrame, value: str = "value") -> DataFrame:
    """`AVC...[, ][on|off|true|false]` lines -> (avc, flag); a plain id switches on, other lines go.

    A line source may hold several lines a record; they are split first.
    """
    rows = lines.select(F.explode(F.split(value, r"\r?\n")).alias("line")).where(F.col("line").rlike(_COMMAND))
    return rows.select(F.regexp_extract("line", _COMMAND, 1).alias("avc"), (F.regexp_extract("line", _COMMAND, 3) == "").alias("flag"))


def watch_command_stream(spark: SparkSession, kind: str, **options: str) -> DataFrame:
    """Watch commands of a streaming source: text files, or kafka and others where their connector is installed."""
    source = spark.readStream.format(kind).options(**options).load()
    return parse_watch_commands(source.select(F.col("value").cast("string").alias("value")))
