"""Lineage cuts in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

from reachmill.functions.contracts import ContractError


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a temporary one where it is unset and all runs on one machine."""
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    named = context.getConf().get("spark.checkpoint.dir")
    if not named:
        if not context.master.startswith("local"):
            raise ContractError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="reachmill-shared-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    context.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """df, written once to the shared folder and read from there from now on."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
