"""Scope filter and staged tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import DATASET_DOI, bare_doi, doi_in, looks_like_file, staged_version_title, starts_with_any, work_id
from ..operators.relational import not_in, semi

# Fixed values.
SCOPE_PREFIXES = ("G03F7/20", "G03F7/70", "G02B6/12", "G02B6/122", "H01S5/0224", "H01S5/10", "G06N3/049", "G11C11/54", "G11C13/00", "H10N70/00")
LAST_SEQUENCE = 4
FILED_FROM, FILED_TO = "2014-01-01", "2025-12-31"
ORGANISATION_TYPES = ("2", "3", "6", "7")
NO_EXCLUSIONS = "doc_id string, doc_type string, reason string"


def in_scope(patents: DataFrame, applications: DataFrame, codes: DataFrame, prefixes=SCOPE_PREFIXES, last: int = LAST_SEQUENCE, start: str = FILED_FROM, end: str = FILED_TO) -> DataFrame:
    """Patents with one of the codes among their first, filed in the window: once each.

    Codes are the largest input: they are cut to ids by a filter that reaches the scan, and only ids meet the patents.
    """
    sequence = F.expr("try_cast(try_cast(cpc_sequence AS double) AS int)")
    hit = codes.where(starts_with_any(F.col("cpc_group"), prefixes) & (sequence <= last)).select("patent_id")
    filed = applications.where(F.to_date("filing_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))).select("patent_id", "filing_date")
    wanted = semi(patents, hit, "patent_id").select("patent_id", "patent_title", "patent_date", "patent_type")
    return wanted.join(filed, "patent_id")


def staged_works(works: DataFrame, excluded: DataFrame) -> DataFrame:
    """Works with an id, title and date, without data sets, file names, release notes and what the gate excluded."""
    w = works.where(
        F.col("openalex_id").isNotNull() & F.col("title").isNotNull() & F.col("publication_date").isNotNull()
        & F.coalesce(~F.col("doi").contains(DATASET_DOI), F.lit(True)) & ~looks_like_file(F.col("title")) & ~staged_version_title(F.col("title"))
    ).select(
        F.col("openalex_id").alias("work_url"), work_id(F.col("openalex_id")).alias("work_id"), "doi", bare_doi(F.col("doi")).alias("doi_bare"), "title", "type",
        F.to_date("publication_date").alias("publication_date"), F.col("publication_year").cast("int").alias("publication_year"), "language", "abstract",
        "primary_topic_id", "primary_topic_name", "institution_ids", "institution_rors", "institution_display_names",
    )
    return not_in(w, excluded.where("doc_type = 'paper'").withColumnRenamed("doc_id", "work_id"), "work_id")


def staged_patents(scoped: DataFrame, excluded: DataFrame) -> DataFrame:
    """Patents in scope with an id and a filing date, without what the gate excluded."""
    p = scoped.where("patent_id is not null and filing_date is not null").select("patent_id", F.col("patent_title").alias("title"), F.to_date("filing_date").alias("filing_date"), F.to_date("patent_date").alias("grant_date"), "patent_type")
    return not_in(p, excluded.where("doc_type = 'patent'").withColumnRenamed("doc_id", "patent_id"), "patent_id")


def staged_assignees(assignees: DataFrame, patents: DataFrame) -> DataFrame:
    """Assignees that are organisations with an id and a name, of staged patents."""
    own = assignees.where(F.col("assignee_type").isin(*ORGANISATION_TYPES) & F.col("assignee_id").isNotNull() & F.col("disambig_assignee_organization").isNotNull())
    return semi(own, patents, "patent_id").select("patent_id", "assignee_id", F.col("disambig_assignee_organization").alias("org_name"), "assignee_type", F.col("assignee_sequence").cast("int").alias("assignee_sequence"))


def staged_codes(codes: DataFrame, patents: DataFrame) -> DataFrame:
    own = semi(codes.where("cpc_group is not null"), patents, "patent_id")
    return own.select("patent_id", "cpc_group", "cpc_subclass", "cpc_class", "cpc_section", "cpc_type", F.col("cpc_sequence").cast("int").alias("cpc_sequence"))


def staged_references(references: DataFrame, patents: DataFrame) -> DataFrame:
    """References to other literature with the DOI they quote."""
    own = semi(references.where("other_reference_text is not null"), patents, "patent_id")
    return own.select("patent_id", F.col("other_reference_sequence").cast("int").alias("ref_sequence"), F.col("other_reference_text").alias("ref_text"), doi_in(F.col("other_reference_text")).alias("doi_extracted"))


def staged_citations(citations: DataFrame, patents: DataFrame) -> DataFrame:
    own = semi(citations.where("citation_patent_id is not null"), patents, "patent_id")
    return own.select(F.col("patent_id").alias("citing_patent_id"), F.col("citation_patent_id").alias("cited_patent_id"))
