"""Distinct counts over any choice of groups, from bitmaps made once.

Ids get dense numbers; for each group the numbers of its ids are bits of rows of 32768. Counts over some groups are the bits of their rows
joined by OR: exact, and the tables of facts are not read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

#: Parts in which ids are numbered.
PARTS = 256


def numbered(ids: DataFrame, id_col: str, parts: int = PARTS) -> DataFrame:
    """(id, number): distinct ids numbered from 1 without gaps; numbered part by part, and a part begins where those before it end."""
    each = materialise(ids.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id")).distinct().withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts))))
    sizes = each.groupBy("part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))  # one row a part
    starts = F.broadcast(sizes.select("part", F.coalesce(before, F.lit(0)).alias("start")))
    return each.withColumn("k", F.row_number().over(Window.partitionBy("part").orderBy("id"))).join(starts, "part").select("id", (F.col("start") + F.col("k")).alias("number"))


def bitmaps(facts: DataFrame, groups: Sequence[str], kinds: dict[str, str]) -> DataFrame:
    """(kind, *groups, bucket, bits): for each kind (name: id column) the bitmaps of every group; rows without an id are left out."""
    out = None
    for kind, id_col in kinds.items():
        known = facts.where(F.col(id_col).isNotNull()).select(*groups, F.col(id_col).alias("id")).distinct().join(numbered(facts, id_col), "id")
        own = known.groupBy(F.lit(kind).alias("kind"), *groups, F.bitmap_bucket_number("number").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))
        out = own if out is None else out.unionByName(own)
    return out


def counted(maps: DataFrame, chosen: Column, by: Sequence[str] = ()) -> DataFrame:
    """(*by, kind, n): distinct ids of the chosen groups. What no chosen group has is not a row."""
    both = maps.where(chosen).groupBy(*by, "kind", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return both.groupBy(*by, "kind").agg(F.sum(F.bitmap_count("bits")).alias("n"))


def document_bitmaps(filings: DataFrame, publications: DataFrame) -> DataFrame:
    """Bitmaps of patents, papers and their organisations by family (``unattributed`` where there is none), cluster and year."""
    family = F.coalesce("family_id", F.lit("unattributed")).alias("family_id")
    groups = ["family_id", "cluster_id", "year"]
    p = filings.select(family, "cluster_id", F.year("filing_date").alias("year"), "patent_id", "org_id")
    w = publications.select(family, "cluster_id", F.year("publication_date").alias("year"), "work_id", "org_id")
    return bitmaps(p, groups, {"n_patents": "patent_id", "n_assignees": "org_id"}).unionByName(bitmaps(w, groups, {"n_papers": "work_id", "n_research_orgs": "org_id"}))
