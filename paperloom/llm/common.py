"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a maximal run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: ASCII white space besides the space itself.
OTHER_SPACE = "\t\n\x0b\x0c\r"

#: Rows in one Arrow batch: bounds a Python worker's memory when texts are long.
ARROW_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small: texts may be megabytes each.

    Spark reads the setting when a plan starts, after the operator has returned it, so it stays for the session; a smaller one is left alone.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= ARROW_ROWS:
        spark.conf.set(name, str(ARROW_ROWS))


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints: the one that the cluster names, or a new one where a single machine names none (in tests)."""
    context = spark.sparkContext
    if (set_already := context.getCheckpointDir()) is not None:
        return set_already
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="paperloom-checkpoint-")
    context.setCheckpointDir(named)
    return context.getCheckpointDir()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever it lies."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialise(df: DataFrame) -> DataFrame:
    """Cut lineage by a checkpoint in the shared folder.

    A checkpoint keeps the optimizer's guess of its plan's size, and a join multiplies its sides' guesses; in a loop the guess comes to have
    so many digits that planning takes minutes. The rows are therefore wrapped anew, without a guess, and joins are settled by the sizes
    that adaptive execution measures.
    """
    spark = df.sparkSession
    shared_folder(spark)
    stored = df.checkpoint(eager=True)._jdf
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(stored.queryExecution().toRdd(), stored.schema(), False), spark)


def release(spark: SparkSession) -> None:
    """Have the driver collect its garbage, so that shuffle files and checkpoints that nothing refers to any more leave the disks."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def words(text: Column) -> Column:
    """The words of a text as an array, in order; built-in functions only."""
    spaced = F.translate(text, OTHER_SPACE, " " * len(OTHER_SPACE))
    return F.array_remove(F.split(spaced, " "), "")


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body names it."""
    return F.transform(F.array(value), body)[0]
