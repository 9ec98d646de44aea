"""Quality gate for papers, exclusions and the corpus to embed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import LEAST_ABSTRACT, PLACEHOLDER_ABSTRACT, gated_version_title
from ..functions.udfs import detect_language

Detector = Callable[[Column], Column]


def gated_text(title: Column, abstract: Column, language: Detector = detect_language) -> Column:
    """struct(text, text_source, reason): the text to trust of a paper, or why there is none.

    The detector is asked last, and only about texts that the plain rules leave open.
    """
    t, a = F.trim(F.coalesce(title, F.lit(""))), F.trim(F.coalesce(abstract, F.lit("")))
    release = gated_version_title(t)
    unusable = a.rlike(PLACEHOLDER_ABSTRACT) | (F.length(a) < LEAST_ABSTRACT)
    is_english = lambda c: F.coalesce(language(c) == "en", F.lit(False))
    said = lambda text, source: F.struct(text.alias("text"), F.lit(source).alias("text_source"), F.lit(None).cast("string").alias("reason"))
    none = lambda reason: F.struct(F.lit(None).cast("string").alias("text"), F.lit(None).cast("string").alias("text_source"), F.lit(reason).alias("reason"))
    return (
        F.when(release, none("version_style_title"))
        .when(unusable, F.when(t != "", said(t, "title")).otherwise(none("no_usable_text")))
        .when(is_english(F.when(~release & ~unusable, a)), said(a, "abstract"))
        .when((t != "") & is_english(F.when(~release & ~unusable, t)), said(t, "title"))
        .otherwise(none("non_english_content"))
    )


def gated_title(title: Column) -> Column:
    """The same for patents, which have a title alone."""
    t = F.trim(F.coalesce(title, F.lit("")))
    reason = F.when(gated_version_title(t), F.lit("version_style_title")).when(t == "", F.lit("no_usable_text"))
    return F.struct(F.when(reason.isNull(), t).alias("text"), F.when(reason.isNull(), F.lit("title")).alias("text_source"), reason.alias("reason"))


def _gated(papers: DataFrame, patents: DataFrame, language: Detector) -> DataFrame:
    a = papers.select(F.col("work_id").alias("doc_id"), F.lit("paper").alias("doc_type"), gated_text(F.col("title"), F.col("abstract"), language).alias("g"))
    b = patents.select(F.col("patent_id").alias("doc_id"), F.lit("patent").alias("doc_type"), gated_title(F.col("title")).alias("g"))
    return a.unionByName(b)


def exclusions(papers: DataFrame, patents: DataFrame, language: Detector = detect_language) -> DataFrame:
    """(doc_id, doc_type, reason) of documents without a text to trust."""
    return _gated(papers, patents, language).where("g.reason is not null").select("doc_id", "doc_type", "g.reason")


def corpus(papers: DataFrame, patents: DataFrame, language: Detector = detect_language) -> DataFrame:
    """(doc_id, doc_type, text, text_source) of the others."""
    return _gated(papers, patents, language).where("g.reason is null").select("doc_id", "doc_type", "g.text", "g.text_source")
