"""Where intermediate tables go: the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under spark.checkpoint.dir of the session; a temporary folder only where that is unset and the master is local."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder and not (spark.sparkContext.master or "").startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{(folder or tempfile.mkdtemp(prefix='lineflow-')).rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Bytes of a generated method that Java compiles; it interprets larger ones, which are slower than operators of their own.
_METHOD, _LIMIT = 8000, "spark.sql.codegen.hugeMethodLimit"


def stored(df: DataFrame, name: str, long: bool = False) -> DataFrame:
    """Writes df as a Parquet table under scratch_path() and reads it back.

    Where expressions are long, steps whose generated method would be over _METHOD bytes aren't made one method,
    unless the session sets the limit itself.
    """
    path, conf = scratch_path(df.sparkSession, name), df.sparkSession.conf
    own = long and int(conf.get(_LIMIT)) == 65535
    if own:
        conf.set(_LIMIT, _METHOD)
    try:
        df.write.parquet(path)
    finally:
        if own:
            conf.unset(_LIMIT)
    return df.sparkSession.read.schema(df.schema).parquet(path)
