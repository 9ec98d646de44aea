"""Counts that tell whether a corpus is worth the build: scope, references and known links by family."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import patent_family
from ..operators.relational import ratio, semi
from .marts import joined, zero


def scope_counts(staged_patents: DataFrame, staged_codes: DataFrame, references: DataFrame, published: DataFrame) -> DataFrame:
    """By family of the first code: patents in scope, those that cite other literature, those that quote a DOI, and published links."""
    primary = staged_codes.where("cpc_sequence = 0").select("patent_id", patent_family(F.col("cpc_group")).alias("family_id")).where("family_id is not null")
    own = semi(primary, staged_patents, "patent_id").distinct()
    counts = own.groupBy("family_id").agg(F.countDistinct("patent_id").alias("n_patents"))
    cited = own.join(references, "patent_id").groupBy("family_id").agg(F.countDistinct("patent_id").alias("n_citing"), F.countDistinct(F.when(F.col("doi_extracted").isNotNull(), F.col("patent_id"))).alias("n_with_doi"))
    linked = own.join(published.select("patent_id", "work_id").distinct(), "patent_id").groupBy("family_id").agg(F.count("*").alias("n_links"))
    out = joined(counts, [cited, linked], "family_id")
    return out.select("family_id", "n_patents", zero("n_citing"), zero("n_with_doi"), zero("n_links"), ratio(F.coalesce("n_citing", F.lit(0)), F.col("n_patents"), 4).alias("citing_share"))


def too_thin(counts: DataFrame, patents: int, links: int) -> DataFrame:
    """Families below either floor, with what they lack."""
    few = F.array_compact(F.array(F.when(F.col("n_patents") < patents, "patents"), F.when(F.col("n_links") < links, "links")))
    return counts.select("family_id", F.array_join(few, ",").alias("lacks")).where("lacks <> ''")


def corpus_counts(works: DataFrame, staged_works: DataFrame, scoped: DataFrame, staged_patents: DataFrame) -> DataFrame:
    """(side, raw, staged) of papers and patents."""
    one = lambda side, raw, staged, key: raw.agg(F.count("*").alias("raw")).crossJoin(staged.agg(F.countDistinct(key).alias("staged"))).select(F.lit(side).alias("side"), "raw", "staged")  # noqa: E731  one row each
    return one("paper", works, staged_works, "work_id").unionByName(one("patent", scoped, staged_patents, "patent_id"))
