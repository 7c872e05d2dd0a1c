"""What the operators of this subpackage share: lineage cuts and tables."""

from __future__ import annotations

import atexit
import pickle
import shutil
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; a temporary one where it is unset and all runs on one machine."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir")
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="reachmill-checkpoint-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    context.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """Materialise df in the shared checkpoint folder and cut its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def store(df: DataFrame) -> DataFrame:
    """df as a compressed table in the shared checkpoint folder, read again; for wide rows.  The files go when the driver ends."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(there)
    return spark.read.parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Bound the rows of an Arrow batch, since one text may be long; a smaller bound of the session stays.

    Spark reads the bound when the batches are made, so it has to stay in the
    session for as long as the operator's result is used.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def stretches(texts, most: int = 8_000_000):
    """(first, last + 1) of stretches of texts of at most so many characters each, or of one text."""
    first = chars = 0
    for i, text in enumerate(texts):
        if chars and chars + len(text) > most:
            yield first, i
            first, chars = i, 0
        chars += len(text)
    if first < len(texts):
        yield first, len(texts)


def tidy(run):
    """The batches of run, whose memory goes back to the system at the end: Python workers outlive their tasks."""

    def tidied(batches):
        import ctypes

        import pyarrow as pa

        yield from run(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):  # another C library
            pass

    return tidied


def ship(spark: SparkSession, model):
    """A broadcast of model as bytes, its classes with it, so that a worker without this repository can read it."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(model))


def unpack(shared):
    """The model of a broadcast that ship made."""
    return pickle.loads(shared.value)
