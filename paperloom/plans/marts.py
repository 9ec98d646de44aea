"""Marts: yearly velocity, competition, gap, family scorecard and the clusters' families."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import paper_vote, patent_vote
from ..operators.relational import concentration, first_per_key, ranked, ratio, reported, year_spine
from .facts import DAYS_A_YEAR

NOISE = "c_noise"
LEAST_RESOLVED, LEAST_LINKS = 10, 20
PURITY, COVERAGE = 0.80, 0.50
#: Families of documents and of clusters, with their names in order.
FAMILIES = (("euv", "EUV Lithography"), ("lasers", "Lasers"), ("si_photonics", "Silicon Photonics"), ("neuromorphic", "Neuromorphic"), ("in_memory", "In-Memory Compute"))
CLUSTER_FAMILIES = (("euv", "EUV Lithography"), ("silicon_photonics", "Silicon Photonics"), ("neuromorphic_in_memory", "Neuromorphic & In-Memory Compute"), ("mixed", "Mixed"))


def family_rows(spark: SparkSession, families=FAMILIES) -> DataFrame:
    return spark.createDataFrame([(k, name, i) for i, (k, name) in enumerate(families, 1)], "family_id string, family_name string, family_sort_order int")


def joined(spine: DataFrame, parts: list[DataFrame], key: str) -> DataFrame:
    """Left joins of parts, one row a key each, onto a spine."""
    return reduce(lambda a, b: a.join(b, key, "left"), parts, spine)


def velocity(publications: DataFrame, filings: DataFrame, clusters: DataFrame) -> DataFrame:
    paper = publications.where("cluster_id is not null").groupBy("cluster_id", F.col("publication_year").alias("year")).agg(F.countDistinct("work_id").alias("paper_count"))
    patent = filings.where("cluster_id is not null").groupBy("cluster_id", F.year("filing_date").alias("year")).agg(F.countDistinct("patent_id").alias("patent_count"))
    out = year_spine([(paper, "paper_count"), (patent, "patent_count")], ["cluster_id", "year"])
    return out.join(clusters.select("cluster_id", "tagline"), "cluster_id").select("cluster_id", "tagline", (F.col("cluster_id") == NOISE).alias("is_noise"), "year", "paper_count", "patent_count")


def competitive(publications: DataFrame, filings: DataFrame, clusters: DataFrame, organisations: DataFrame) -> DataFrame:
    """Documents by (cluster, side, organisation, family) with shares of the cluster; an organisation's rank is over all its families."""
    sides = []
    for side, facts, doc in (("patent", filings, "patent_id"), ("paper", publications, "work_id")):
        sides.append(facts.where("cluster_id is not null").select("cluster_id", F.lit(side).alias("side"), F.coalesce("org_id", F.lit("unresolved")).alias("org_id_key"), "org_id", F.coalesce("family_id", F.lit("unattributed")).alias("family_id_key"), "family_id", F.col(doc).alias("doc")))
    docs = sides[0].unionByName(sides[1])
    slices = docs.groupBy("cluster_id", "side", "org_id_key", "org_id", "family_id_key", "family_id").agg(F.countDistinct("doc").alias("doc_count"))
    totals = docs.groupBy("cluster_id", "side").agg(F.countDistinct("doc").alias("cluster_total"))
    ranks = ranked(slices.groupBy("cluster_id", "side", "org_id_key").agg(F.sum("doc_count").alias("n")), ["cluster_id", "side"], [F.col("n").desc(), F.col("org_id_key")], "rank_in_cluster").drop("n")
    out = slices.join(totals, ["cluster_id", "side"]).join(ranks, ["cluster_id", "side", "org_id_key"]).join(clusters.select("cluster_id", "tagline"), "cluster_id").join(organisations, "org_id", "left")
    return out.select(
        "cluster_id", "tagline", "side", "org_id_key", "org_id", "family_id_key", "family_id", F.coalesce("canonical_name", F.lit("Unresolved")).alias("canonical_name"),
        F.coalesce("primary_match_method", F.lit("none")).alias("match_method"), F.coalesce("primary_confidence", F.lit("low")).alias("confidence"),
        "doc_count", ratio(F.col("doc_count"), F.col("cluster_total"), 4).alias("share"), "cluster_total", "rank_in_cluster",
    )


def primary_assignees(filings: DataFrame) -> DataFrame:
    """One row a patent: sequence 0 first, then other numbers, then none; org_id settles ties."""
    order = [F.when(F.col("assignee_sequence") == 0, 0).when(F.col("assignee_sequence").isNull(), 2).otherwise(1), F.col("assignee_sequence").asc_nulls_last(), F.col("org_id").asc_nulls_last()]
    return first_per_key(filings, "patent_id", order)


def cluster_concentration(filings: DataFrame) -> DataFrame:
    return concentration(primary_assignees(filings.where("cluster_id is not null")), "cluster_id", "org_id")


def link_lags(links: DataFrame, of: DataFrame, key: str) -> DataFrame:
    """Links and median lag by ``key`` of the patents in ``of`` (patent_id, key); repeated patents repeat their links."""
    return links.join(of, "patent_id").groupBy(key).agg(F.count("*").alias("npl_n_links"), F.round(F.median("citation_lag_years"), 2).alias("npl_median"))


def zero(name: str) -> Column:
    return F.coalesce(name, F.lit(0)).cast("long").alias(name)


def gap(publications: DataFrame, filings: DataFrame, links: DataFrame, bridge: DataFrame, clusters: DataFrame) -> DataFrame:
    """One row a cluster: concentration, breadth, link lag, cohort lag; figures from too few rows are withheld.

    A cluster whose patents are all unresolved reports no patents.
    """
    hhi = cluster_concentration(filings).where("resolved > 0").select("cluster_id", F.col("total").alias("n_patents"), F.col("n_entities").alias("n_assignees"), "unresolved", "resolved", F.col("hhi").alias("hhi_raw"))
    own = publications.where("cluster_id is not null")
    breadth = own.groupBy("cluster_id").agg(F.countDistinct("institution_id").alias("n_oa_institutions"), F.countDistinct("org_id").alias("n_research_orgs"), F.countDistinct("work_id").alias("n_papers"), F.median("publication_year").alias("pub"))
    filed = filings.where("cluster_id is not null").groupBy("cluster_id").agg(F.median(F.year("filing_date")).alias("filed"))
    lag = link_lags(links, bridge.where("doc_type = 'patent' and cluster_id is not null").select(F.col("doc_id").alias("patent_id"), "cluster_id"), "cluster_id")
    out = joined(clusters.select("cluster_id", "tagline"), [hhi, breadth, lag, filed], "cluster_id")
    both = F.col("pub").isNotNull() & F.col("filed").isNotNull()
    return out.select(
        "cluster_id", "tagline", (F.col("cluster_id") == NOISE).alias("is_noise"), zero("n_patents"), zero("n_assignees"),
        F.round(F.coalesce("unresolved", F.lit(0)) * F.lit(100.0) / F.nullif(F.coalesce("n_patents", F.lit(0)), F.lit(0)), 1).alias("pct_unresolved_patents"),
        reported(F.col("hhi_raw"), F.col("resolved"), LEAST_RESOLVED).alias("hhi"), (F.coalesce("resolved", F.lit(0)) >= LEAST_RESOLVED).alias("hhi_reportable"),
        zero("n_oa_institutions"), zero("n_research_orgs"), zero("n_papers"),
        reported(F.col("npl_median"), F.col("npl_n_links"), LEAST_LINKS).alias("npl_median_lag_years"), zero("npl_n_links"), (F.coalesce("npl_n_links", F.lit(0)) >= LEAST_LINKS).alias("npl_reportable"),
        F.when(both, F.round("pub", 1)).alias("cohort_med_pub_year"), F.when(both, F.round("filed", 1)).alias("cohort_med_filing_year"), F.round(F.col("filed") - F.col("pub"), 1).alias("cohort_lag_years"),
    )


def family(publications: DataFrame, filings: DataFrame, links: DataFrame, dim_patent: DataFrame) -> DataFrame:
    """The five families' scorecard; all five rows whatever the data."""
    of = filings.where("family_id is not null").select("patent_id", "family_id").distinct()
    patent = filings.where("family_id is not null").groupBy("family_id").agg(F.countDistinct("patent_id").alias("n_patents"), F.countDistinct("org_id").alias("n_assignees_sum"))
    paper = publications.where("family_id is not null").groupBy("family_id").agg(F.countDistinct("work_id").alias("n_papers"), F.countDistinct("org_id").alias("n_research_orgs_sum"))
    lag = link_lags(links, of, "family_id")
    granted = of.join(dim_patent.where("grant_date is not null").select("patent_id", "filing_date", "grant_date"), "patent_id").groupBy("family_id").agg(F.round(F.avg(ratio(F.datediff("grant_date", "filing_date"), F.lit(DAYS_A_YEAR))), 2).alias("avg_grant_lag_years"))
    total = patent.agg(F.sum("n_patents").alias("all_patents"))
    out = joined(family_rows(filings.sparkSession), [paper, patent, lag, granted], "family_id").crossJoin(F.broadcast(total))  # one row
    return out.select(
        "family_id", "family_name", "family_sort_order", zero("n_papers"), zero("n_patents"), ratio(F.coalesce("n_patents", F.lit(0)), F.col("all_patents"), 3).alias("patent_share"),
        zero("n_research_orgs_sum"), zero("n_assignees_sum"), reported(F.col("npl_median"), F.col("npl_n_links"), LEAST_LINKS).alias("median_lag_years_weighted"),
        F.coalesce("npl_n_links", F.lit(0)).cast("long").alias("total_npl_links"), "avg_grant_lag_years",
    )


def dominant_votes(votes: DataFrame, group: str, vote: str, neutral: str, purity: float = PURITY, coverage: float = COVERAGE) -> DataFrame:
    """(group, label): the most frequent vote where it clears both floors, else ``neutral``; ties go to the first by name."""
    counts = votes.groupBy(group, vote).agg(F.count("*").alias("n"))
    real = F.when(F.col(vote) != neutral, F.col("n"))
    sums = counts.groupBy(group).agg(F.sum("n").alias("n_total"), F.sum(real).alias("n_real"), F.min(F.when(F.col(vote) != neutral, F.struct((-F.col("n")).alias("n"), F.col(vote).alias("vote")))).alias("best"))
    clear = (ratio(-F.col("best.n"), F.col("n_real")) >= purity) & (ratio(F.col("n_real"), F.col("n_total")) >= coverage)
    return sums.select(group, F.when(clear, F.col("best.vote")).otherwise(F.lit(neutral)).alias("label"))


def cluster_families(filings: DataFrame, dim_paper: DataFrame, bridge: DataFrame, clusters: DataFrame) -> DataFrame:
    """Each cluster but noise with the family that its documents vote for."""
    patent = filings.where(f"cluster_id is not null and cluster_id <> '{NOISE}'").select("cluster_id", "patent_id", "primary_cpc").distinct().select("cluster_id", patent_vote(F.col("primary_cpc")).alias("vote"))
    inside = bridge.where(f"doc_type = 'paper' and cluster_id is not null and cluster_id <> '{NOISE}'").select(F.col("doc_id").alias("work_id"), "cluster_id")
    paper = dim_paper.join(inside, "work_id").select("cluster_id", paper_vote(F.col("primary_topic_id")).alias("vote"))
    label = dominant_votes(patent.unionByName(paper), "cluster_id", "vote", "mixed")
    named = clusters.where(F.col("cluster_id") != NOISE).select("cluster_id").join(label, "cluster_id", "left").select("cluster_id", F.coalesce("label", F.lit("mixed")).alias("family_id"))
    return named.join(family_rows(filings.sparkSession, CLUSTER_FAMILIES), "family_id").select("cluster_id", "family_id", "family_name", "family_sort_order")
