"""Search for parts of texts by an index of their three-letter sequences, checked against the texts.

``build`` writes two tables: postings (gram, id) in folders by a hash of the gram, and texts in folders by a hash of the id. ``search`` reads the folders of its query's grams alone,
takes the ids that have all of them, and checks these texts with ILIKE, so answers are ILIKE's own. ``%`` and ``_`` in a query are wild cards, as there; grams come from
what stands between them. A query without three letters in a row has no gram and reads all texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GRAM, BUCKETS = 3, 256
#: Texts whose grams a worker holds at once.
ROWS_AT_ONCE = 64


def gram_rows(docs: DataFrame) -> DataFrame:
    """(id, gram) of rows (id, text): each sequence of ``GRAM`` characters of a text in lower case once a row, cut in one pass over the text."""
    kind = docs.schema["id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                found = [{t[i : i + GRAM] for i in range(len(t) - GRAM + 1)} for t in part.column(1).to_pylist()]
                row = np.repeat(np.arange(len(found)), [len(x) for x in found])
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row)), pa.array([g for x in found for g in x], pa.string())], names=["id", "gram"])

    # lower case as Spark has it, as in ``search``
    return docs.select("id", F.lower("text").alias("text")).mapInArrow(cut, f"id {kind}, gram string")


def _bucket(c: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(buckets)).cast("int")


def build(docs: DataFrame, id_col: str, text_col: str, path: str, buckets: int = BUCKETS) -> None:
    """Write the index of (id, text) under ``path``; rows without an id or a text are left out."""
    known = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # a scan may be one task, however many texts it has; rows that share an id may share grams, which ``search`` counts once
    postings = gram_rows(known.hint("rebalance")).withColumn("bucket", _bucket(F.col("gram"), buckets))
    # frequent grams fill a folder with several files; the sort begins with the folder, as the writer asks, so rows are sorted once
    postings.repartition("bucket", F.pmod(F.xxhash64("id"), F.lit(8))).sortWithinPartitions("bucket", "gram", "id").write.partitionBy("bucket").parquet(f"{path}/postings")
    known.withColumn("bucket", _bucket(F.col("id"), buckets)).repartition("bucket").write.partitionBy("bucket").parquet(f"{path}/texts")


def search(spark: SparkSession, path: str, query: str, buckets: int = BUCKETS) -> DataFrame:
    """(id, text) of the texts that ILIKE '%query%' finds."""
    texts = spark.read.parquet(f"{path}/texts").drop("bucket")
    # in lower case as Spark has it, as the index was made
    low = spark.range(1).select(F.lower(F.lit(query))).first()[0]
    runs = [r for r in low.replace("_", "%").split("%") if "\\" not in r]
    needed = sorted({r[i : i + GRAM] for r in runs for i in range(len(r) - GRAM + 1)})
    hit = F.col("text").ilike(f"%{query}%")
    if not needed:
        return texts.where(hit)
    at = spark.range(1).select(F.array(*[_bucket(F.lit(g), buckets) for g in needed])).first()[0]
    postings = spark.read.parquet(f"{path}/postings").where(F.col("bucket").isin(*sorted(set(at))) & F.col("gram").isin(*needed))
    ids = postings.select("id", "gram").distinct().groupBy("id").agg(F.count("*").alias("n")).where(F.col("n") == len(needed)).select("id")
    return texts.join(ids, "id", "left_semi").where(hit)
