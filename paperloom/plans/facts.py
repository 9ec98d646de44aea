"""Dimensions and facts of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import paper_family, patent_family
from ..operators.relational import first_per_key, not_in, ratio, semi

#: How far a match method is trusted.
METHOD_RANK = {"seed_crosswalk": 1, "fuzzy_high": 2, "native_id": 3, "ror": 4}
DAYS_A_YEAR = 365.25


def organisations(crosswalk: DataFrame) -> DataFrame:
    """One row an org_id: its best match method's name; ties go by name and source id."""
    rank = F.coalesce(*[F.when(F.col("match_method") == m, F.lit(r)) for m, r in METHOD_RANK.items()], F.lit(5))
    best = first_per_key(crosswalk.withColumn("__rank", rank), "org_id", [F.col("__rank"), F.col("canonical_name").asc_nulls_last(), F.col("source_id").asc_nulls_last()])
    return best.select("org_id", "canonical_name", F.col("match_method").alias("primary_match_method"), F.col("confidence").alias("primary_confidence"))


def papers(works: DataFrame) -> DataFrame:
    return works.select("work_id", "work_url", "doi", "doi_bare", "title", "publication_date", "publication_year", "abstract", "primary_topic_id", "primary_topic_name")


def patents(staged: DataFrame) -> DataFrame:
    return staged.select("patent_id", "title", "filing_date", "grant_date", "patent_type")


def codes(staged: DataFrame) -> DataFrame:
    return staged.where("cpc_group is not null").select("cpc_group", "cpc_subclass", "cpc_class", "cpc_section").distinct()


def technology_clusters(labels: DataFrame) -> DataFrame:
    return labels.select("cluster_id", "tagline", "summary_friendly", "top_terms")


def document_clusters(clusters: DataFrame, works: DataFrame, staged_patents: DataFrame) -> DataFrame:
    """Clustered documents that are still staged."""
    kept = [semi(clusters.where(F.col("doc_type") == kind), ids.select(F.col(key).alias("doc_id")), "doc_id") for kind, ids, key in (("paper", works, "work_id"), ("patent", staged_patents, "patent_id"))]
    return kept[0].unionByName(kept[1]).select("doc_id", "doc_type", "cluster_id", "umap_x", "umap_y", "model_version")


def _side(crosswalk: DataFrame, source: str, key: str) -> DataFrame:
    return crosswalk.where(F.col("source") == source).select(F.col("source_id").alias(key), "org_id", F.col("match_method").alias("org_match_method"), F.col("confidence").alias("org_confidence"))


def _cluster_of(bridge: DataFrame, kind: str, key: str) -> DataFrame:
    return bridge.where(F.col("doc_type") == kind).select(F.col("doc_id").alias(key), "cluster_id")


def publications(works: DataFrame, crosswalk: DataFrame, bridge: DataFrame) -> DataFrame:
    """(paper, institution) occurrences; papers without an institution have none. Duplicates stay."""
    each = works.select("work_id", "publication_date", "publication_year", "primary_topic_id", "primary_topic_name", "title", "abstract", paper_family(F.col("primary_topic_id"), F.col("title"), F.col("abstract")).alias("family_id"), F.explode("institution_ids").alias("institution_id"))
    out = each.join(_side(crosswalk, "openalex", "institution_id"), "institution_id", "left").join(_cluster_of(bridge, "paper", "work_id"), "work_id", "left")
    return out.select("work_id", "publication_date", "publication_year", "primary_topic_id", "primary_topic_name", "title", "abstract", "institution_id", "org_id", "org_match_method", "org_confidence", "cluster_id", "family_id")


def filings(staged_patents: DataFrame, assignees: DataFrame, staged_codes: DataFrame, crosswalk: DataFrame, bridge: DataFrame) -> DataFrame:
    """(patent, assignee) rows; a patent without an assignee keeps one row."""
    primary = staged_codes.where("cpc_sequence = 0").select("patent_id", F.col("cpc_group").alias("primary_cpc"))
    own = assignees.select("patent_id", "assignee_id", F.col("org_name").alias("assignee_name"), "assignee_sequence")
    out = staged_patents.join(primary, "patent_id", "left").join(own, "patent_id", "left").join(_side(crosswalk, "patentsview", "assignee_id"), "assignee_id", "left").join(_cluster_of(bridge, "patent", "patent_id"), "patent_id", "left")
    return out.select("patent_id", "filing_date", "grant_date", "patent_type", "primary_cpc", patent_family(F.col("primary_cpc")).alias("family_id"), "assignee_id", "assignee_name", "assignee_sequence", "org_id", "org_match_method", "org_confidence", "cluster_id")


def links(published: DataFrame, matched: DataFrame, dim_paper: DataFrame, dim_patent: DataFrame) -> DataFrame:
    """Patent to paper links: the published ones, and the matcher's for patents that these lack; papers that precede the filing."""
    given = published.select("patent_id", "work_id", "match_method", "confidence", F.lit("marx_fuegi").alias("link_source"), F.lit(None).cast("string").alias("doi_extracted"), F.col("confscore").cast("int").alias("mf_confscore"), F.col("wherefound").alias("mf_wherefound"), F.col("self").alias("mf_self"))
    own = not_in(matched, published.select("patent_id").distinct(), "patent_id").select(
        "patent_id", "work_id", "match_method", "confidence", F.when(F.col("confidence") == "high", "doi").otherwise("fuzzy_title").alias("link_source"), "doi_extracted",
        F.lit(None).cast("int").alias("mf_confscore"), F.lit(None).cast("string").alias("mf_wherefound"), F.lit(None).cast("string").alias("mf_self"),
    )
    dated = given.unionByName(own).join(dim_paper.select("work_id", "publication_date"), "work_id").join(dim_patent.select("patent_id", "filing_date"), "patent_id").where("publication_date < filing_date")
    days = F.datediff("filing_date", "publication_date")
    return dated.select("patent_id", "work_id", "match_method", "confidence", "link_source", "doi_extracted", "mf_confscore", "mf_wherefound", "mf_self", "publication_date", "filing_date", days.alias("citation_lag_days"), ratio(days, F.lit(DAYS_A_YEAR), 2).alias("citation_lag_years"))


def patent_citations(staged_citations: DataFrame) -> DataFrame:
    return staged_citations.select("citing_patent_id", "cited_patent_id")
