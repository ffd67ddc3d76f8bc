"""Helpers shared by the corpus operators."""

from __future__ import annotations

import contextlib
import ctypes
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session.

    Only where neither the setting nor a checkpoint folder is there and the master is
    local (as in tests on one machine) a temporary folder is set; on a cluster that is an
    error, as executors would not see it.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    if sc.getCheckpointDir() is None:
        if not (sc.master or "").startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="lineflow-checkpoint-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Cuts lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Writes df as a Parquet table in the shared folder and reads it back."""
    path = new_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within it the files of an action's shuffles go when the action ends, not when the driver's memory is next cleaned; for frames that are made within and run once."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id) -> F.Column:
    """True for the fifth of documents that no model may learn from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where a public vocabulary file lies; TOKENIZER_DIR of the environment wins."""
    folder = os.environ.get("TOKENIZER_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def release() -> None:
    """Gives memory that a worker has freed back to the machine, as workers outlive their tasks and the stages they belong to."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library keeps it
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def released(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """run, a function over the batches of a task, with release() at the task's end."""

    def whole(batches: Iterator) -> Iterator:
        yield from run(batches)
        release()

    return whole
