"""Data tests. Each returns its violations; ``report`` counts them in one plan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def missing(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def repeated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of more than one row; a null in a single key is no key."""
    known = df.where(F.col(keys[0]).isNotNull()) if len(keys) == 1 else df
    return known.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def unaccepted(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(*values))


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str | None = None) -> DataFrame:
    ids = parent.select(F.col(parent_key or key).alias("__parent"))
    return child.where(F.col(key).isNotNull()).join(ids, F.col(key) == F.col("__parent"), "left_anti")


def outside(df: DataFrame, column: str, low: float | None = None, high: float | None = None) -> DataFrame:
    c = F.col(column)
    return df.where((F.lit(False) if low is None else c < low) | (F.lit(False) if high is None else c > high))


def mixed_sources(links: DataFrame, key: str = "patent_id", source: str = "link_source", published: str = "marx_fuegi") -> DataFrame:
    """Keys with links both of the published source and of another."""
    return links.groupBy(key).agg(F.countDistinct(F.col(source) == published).alias("n")).where("n > 1")


def orphaned_documents(bridge: DataFrame, papers: DataFrame, patents: DataFrame) -> DataFrame:
    a = orphans(bridge.where("doc_type = 'paper'"), "doc_id", papers, "work_id")
    return a.unionByName(orphans(bridge.where("doc_type = 'patent'"), "doc_id", patents, "patent_id"))


def silently_empty(exclusions: DataFrame, raw: DataFrame) -> DataFrame:
    """One row if there is input and nothing at all was excluded."""
    counts = exclusions.agg(F.count("*").alias("n_excluded")).crossJoin(raw.agg(F.count("*").alias("n_raw")))  # one row each
    return counts.where("n_excluded = 0 and n_raw > 0")


def floors_broken(families: DataFrame, votes: DataFrame, neutral: str = "mixed", purity: float = 0.80, coverage: float = 0.50) -> DataFrame:
    """Clusters named after a family whose share of the votes, counted anew, is below a floor."""
    sums = votes.join(families.where(F.col("family_id") != neutral).select("cluster_id", "family_id"), "cluster_id").groupBy("cluster_id").agg(
        F.count("*").alias("total"), F.count(F.when(F.col("vote") != neutral, 1)).alias("real"), F.count(F.when(F.col("vote") == F.col("family_id"), 1)).alias("own")
    )
    return sums.where((F.col("own") < purity * F.col("real")) | (F.col("real") < coverage * F.col("total")))


def report(checks: Mapping[str, DataFrame]) -> DataFrame:
    """(check, violations) of all checks."""
    counts = [v.agg(F.count("*").alias("violations")).select(F.lit(k).alias("check"), "violations") for k, v in checks.items()]
    return reduce(lambda a, b: a.unionByName(b), counts)
