"""Incremental refresh: new files of a snapshot folder go to a function batch by batch, each once.

The models need distinct counts, exact medians and first rows, which streams do not give; so a batch updates the stored
table it feeds and the marts are made again from the tables.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.relational import first_per_key


def refresh(spark: SparkSession, folder: str, schema, progress: str, apply: Callable[[DataFrame, int], None], form: str = "parquet", files_a_batch: int = 1000) -> int:
    """Process what arrived since the last call and stop; returns the number of batches. ``progress`` keeps what was read."""
    stream = spark.readStream.format(form).schema(schema).option("maxFilesPerTrigger", files_a_batch).option("recursiveFileLookup", "true").load(folder)
    q = stream.writeStream.foreachBatch(apply).option("checkpointLocation", progress).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return sum(1 for p in q.recentProgress if p["numInputRows"])


def upsert(old: DataFrame | None, new: DataFrame, keys: Sequence[str], newest: str) -> DataFrame:
    """Rows of both, each key's by the greatest ``newest``; equal ones go to the new rows."""
    tagged = new.withColumn("__new", F.lit(1))
    every = tagged if old is None else old.withColumn("__new", F.lit(0)).unionByName(tagged)
    return first_per_key(every, keys, [F.col(newest).desc_nulls_last(), F.col("__new").desc(), *[F.col(c) for c in every.columns if c not in (*keys, newest, "__new")]]).drop("__new")
