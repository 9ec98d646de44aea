"""From raw documents to packed training sequences: five stages, each one operator applied to all that the last kept.

Each stage takes (spark, docs, sf_dir); all but the last return the columns of ``documents``. ``run`` writes each
stage's rows as Parquet in the cluster's shared folder and reads them again, so a lost executor costs one
stage's tasks at most and no stage is computed twice; of these folders the last one stays, as the result is read from it.

Defined results, as the operators have them: a null text is empty, is not toxic, has no language and so goes in the second stage; a null
label or language teaches nothing; documents without an id are never copies and are mixed and packed as others are; of rows that share an
id one stays at most; a null source is a source of its own; an empty table passes through and packs to no rows. The columns named in
``documents`` are read by name, so extra columns of any name pass through; ties are settled as each operator states.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm import language, mixing, packing, simhash, toxicity
from paperloom.llm.common import remove, shared_folder, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    return toxicity.clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or of no language at even odds or better, go."""
    return language.accepted(docs, language.fit(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: texts that share five-word shingles at 0.8, found by fingerprints and an exact join."""
    return simhash.keep_one(docs, confirm=True)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks."""
    return mixing.mixed_rows(docs).withColumn("n_chars", F.length("text").cast("long"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in windows: (doc_id, start, length, doc_tokens, ids, sequence_id, offset)."""
    import public_tokenizers

    # workers live on through all stages, so they remember less here than where packing runs by itself
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), remembered=(60_000, 120_000))


STAGES = [
    ("toxicity", drop_toxic),
    ("language ID", keep_known_languages),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing sources", mix_sources),
    ("packing", pack_sequences),
]

#: Trained models and XXH64 are beyond SQL; tests/llm compares each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for at, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{at}")
        docs = spark.read.parquet(f"{folder}/{at}")
        if at:
            remove(spark, f"{folder}/{at - 1}")
    return docs
