"""The dashboard's questions as lazy DataFrames over a star schema held in ``Star``.

Orders that the questions leave open are settled by id, so results are the same from run to run.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..functions.text import grant_cutoff_year, role_of, shortened
from ..operators.relational import contains_ignoring_case, first_per_key, ordered_list, ordered_string, ranked, ratio, reported, top_k, within, year_spine
from .marts import LEAST_LINKS, LEAST_RESOLVED, NOISE, cluster_concentration, joined, link_lags, zero

Ids = Sequence[str] | None
SHORT_QUERY = 2


@dataclass(frozen=True)
class Star:
    """The tables that the questions read."""

    fact_publication: DataFrame
    fact_patent_filing: DataFrame
    fact_npl_link: DataFrame
    dim_organization: DataFrame
    dim_paper: DataFrame
    dim_patent: DataFrame
    dim_technology_cluster: DataFrame
    mart_competitive: DataFrame
    mart_gap: DataFrame
    mart_family: DataFrame
    seed_cluster_family: DataFrame

    def cached(self) -> Star:
        """The same with every table cached: marts are small and each question reads several."""
        return Star(**{k: v.cache() for k, v in vars(self).items()})


class TooManyRows(ValueError):
    """An answer is larger than what is held for a question."""


class Answers:
    """Small results by question and arguments, held by the driver for ``seconds``: at most ``most`` of up to ``rows`` rows each.

    An answer is whole or an error: one of more rows raises ``TooManyRows``, and its DataFrame is to be read instead.
    """

    def __init__(self, seconds: float = 3600, most: int = 500, rows: int = 1000, clock=time.monotonic):
        self.seconds, self.most, self.rows, self.clock = seconds, most, rows, clock
        self.held: dict[tuple, tuple[float, list[Row]]] = {}

    def ask(self, question: Callable[..., DataFrame], star: Star, *args) -> list[Row]:
        key = (question.__name__, *(tuple(a) if isinstance(a, list) else a for a in args))
        now = self.clock()
        if key in self.held and now - self.held[key][0] < self.seconds:
            return self.held[key][1]
        found = question(star, *args).limit(self.rows + 1).collect()
        if len(found) > self.rows:
            raise TooManyRows(f"{question.__name__}{args} has more than {self.rows} rows")
        self.held.pop(key, None)
        while len(self.held) >= self.most:
            self.held.pop(next(iter(self.held)))  # the oldest
        self.held[key] = (now, found)
        return found


def _scope(families: Ids, clusters: Ids, family: str = "family_id_key") -> Column:
    return within({family: families, "cluster_id": clusters})


def _facts_scope(families: Ids, clusters: Ids) -> Column:
    own = F.coalesce(F.col("family_id"), F.lit("unattributed"))
    return (own.isin(*families) if families else F.lit(True)) & within({"cluster_id": clusters})


def family_scorecard(s: Star) -> DataFrame:
    return s.mart_family.select("family_id", "family_name", "family_sort_order", "n_papers", "n_patents", "patent_share", "n_research_orgs_sum", "n_assignees_sum", "median_lag_years_weighted", "total_npl_links").orderBy("family_sort_order")


def family_top_orgs(s: Star, most: int = 3) -> DataFrame:
    counts = s.mart_competitive.where(f"canonical_name <> 'Unresolved' and family_id is not null and cluster_id <> '{NOISE}'").groupBy("family_id", "side", "canonical_name").agg(F.sum("doc_count").alias("doc_count"))
    return ranked(counts, ["family_id", "side"], [F.col("doc_count").desc(), F.col("canonical_name")]).where(F.col("rnk") <= most).orderBy("family_id", "side", "rnk")


def _two_counts(s: Star, condition: str, name: str) -> DataFrame:
    a = s.fact_patent_filing.where(condition).agg(F.countDistinct("patent_id").alias(f"{name}_patents"))
    return a.crossJoin(s.fact_publication.where(condition).agg(F.countDistinct("work_id").alias(f"{name}_papers")))  # one row each


def unattributed_counts(s: Star) -> DataFrame:
    return _two_counts(s, "family_id is null", "unattributed")


def unclustered_counts(s: Star) -> DataFrame:
    return _two_counts(s, f"cluster_id = '{NOISE}'", "unclustered")


def cluster_bubble(s: Star) -> DataFrame:
    gap = s.mart_gap.where(f"cluster_id <> '{NOISE}'").select("cluster_id", "n_papers", "n_patents", "npl_median_lag_years", "npl_reportable", "npl_n_links", "cohort_lag_years")
    out = gap.join(s.dim_technology_cluster.select("cluster_id", "tagline"), "cluster_id").join(s.seed_cluster_family.select("cluster_id", "family_id", "family_name"), "cluster_id", "left")
    return out.select("cluster_id", "tagline", F.coalesce("family_id", F.lit("noise")).alias("family_id"), F.coalesce("family_name", F.lit("Frontier / Unclustered")).alias("family_name"), "n_papers", "n_patents", "npl_median_lag_years", "npl_reportable", "npl_n_links", "cohort_lag_years").orderBy(F.col("n_papers").desc(), "cluster_id")


def family_clusters(s: Star, family_id: str) -> DataFrame:
    """Clusters that hold a document of the family, measured over that family's documents alone, with the other families there.

    A patent's links count once for each of its assignee rows here, unlike in ``family_metrics``.
    """
    real = f"cluster_id is not null and cluster_id <> '{NOISE}'"
    patents, papers = s.fact_patent_filing.where(real), s.fact_publication.where(real)
    own_patents, own_papers = patents.where(F.col("family_id") == family_id), papers.where(F.col("family_id") == family_id)
    docs = patents.select("cluster_id", "family_id", F.col("patent_id").alias("doc")).unionByName(papers.select("cluster_id", "family_id", F.col("work_id").alias("doc"))).where("family_id is not null")
    counts = docs.groupBy("cluster_id", "family_id").agg(F.countDistinct("doc").alias("n"))
    spine = counts.where(F.col("family_id") == family_id).select("cluster_id")
    others = counts.where(F.col("family_id") != family_id).groupBy("cluster_id").agg(ordered_list([-F.col("n"), F.col("family_id")], F.col("family_id")).alias("spillover_family_ids"))
    hhi = cluster_concentration(own_patents).select("cluster_id", F.col("total").alias("n_patents"), "resolved", F.col("n_entities").alias("n_assignees"), F.col("hhi").alias("hhi_raw"))
    breadth = own_papers.groupBy("cluster_id").agg(F.countDistinct("work_id").alias("n_papers"), F.countDistinct("org_id").alias("n_research_orgs"))
    lag = link_lags(s.fact_npl_link, own_patents.select("patent_id", "cluster_id"), "cluster_id")
    out = joined(spine.join(s.dim_technology_cluster.select("cluster_id", "tagline", "top_terms"), "cluster_id"), [hhi, breadth, lag, others], "cluster_id")
    out = out.select(
        "cluster_id", "tagline", "top_terms", zero("n_papers"), zero("n_patents"), reported(F.col("hhi_raw"), F.col("resolved"), LEAST_RESOLVED).alias("hhi"), (F.coalesce("resolved", F.lit(0)) >= LEAST_RESOLVED).alias("hhi_reportable"),
        zero("n_research_orgs"), zero("n_assignees"), reported(F.col("npl_median"), F.col("npl_n_links"), LEAST_LINKS).alias("npl_median_lag_years"), zero("npl_n_links"), (F.coalesce("npl_n_links", F.lit(0)) >= LEAST_LINKS).alias("npl_reportable"), "spillover_family_ids",
    )
    return out.orderBy((F.col("n_papers") + F.col("n_patents")).desc(), "cluster_id")


def family_metrics(s: Star, family_id: str, clusters: Ids = None) -> DataFrame:
    """One row of figures for a family, or for its documents in some clusters."""
    scope = (F.col("family_id") == family_id) & within({"cluster_id": clusters})
    patents, papers = s.fact_patent_filing.where(scope), s.fact_publication.where(scope)
    a = patents.agg(F.countDistinct("patent_id").alias("n_patents"), F.countDistinct("org_id").alias("n_assignees_sum"))
    b = papers.agg(F.countDistinct("work_id").alias("n_papers"), F.countDistinct("org_id").alias("n_research_orgs_sum"))
    c = s.fact_npl_link.join(patents.select("patent_id"), "patent_id", "left_semi").agg(F.count("*").alias("total_npl_links"), F.round(F.median("citation_lag_years"), 2).alias("lag"))
    total = s.fact_patent_filing.where("family_id is not null").agg(F.countDistinct("patent_id").alias("all"))
    grant = s.mart_family.where(F.col("family_id") == family_id).select("avg_grant_lag_years")
    one = a.crossJoin(b).crossJoin(c).crossJoin(total).crossJoin(grant)  # one row each
    return one.select("n_papers", "n_patents", ratio(F.col("n_patents"), F.col("all"), 3).alias("patent_share"), "n_research_orgs_sum", "n_assignees_sum", reported(F.col("lag"), F.col("total_npl_links"), LEAST_LINKS).alias("median_lag_years_weighted"), "total_npl_links", "avg_grant_lag_years")


def cluster_card(s: Star, cluster_id: str) -> DataFrame:
    gap = s.mart_gap.where(f"cluster_id <> '{NOISE}'")
    totals = gap.agg(F.sum("n_patents").alias("total_patents"), F.sum("n_papers").alias("total_papers"))
    group = gap.select("cluster_id", "n_patents").join(s.seed_cluster_family.select("cluster_id", "family_id"), "cluster_id").groupBy("family_id").agg(F.sum("n_patents").alias("family_patents"))
    own = s.dim_technology_cluster.where(F.col("cluster_id") == cluster_id)
    figures = s.mart_gap.select("cluster_id", "n_papers", "n_patents", "npl_median_lag_years", "npl_reportable", "npl_n_links", "cohort_lag_years")
    out = joined(own, [figures, s.seed_cluster_family.select("cluster_id", "family_id", "family_name")], "cluster_id").crossJoin(totals).join(group, "family_id", "left")
    return out.select("cluster_id", "tagline", "summary_friendly", "top_terms", "n_papers", "n_patents", "npl_median_lag_years", "npl_reportable", "npl_n_links", "cohort_lag_years", "family_id", "family_name", "total_patents", "total_papers", "family_patents")


def family_velocity(s: Star, family_id: str, clusters: Ids = None) -> DataFrame:
    scope = (F.col("family_id") == family_id) & within({"cluster_id": clusters})
    paper = s.fact_publication.where(scope).groupBy(F.col("publication_year").cast("int").alias("year")).agg(F.countDistinct("work_id").alias("paper_count"))
    patent = s.fact_patent_filing.where(scope).groupBy(F.year("filing_date").alias("year")).agg(F.countDistinct("patent_id").alias("patent_count"))
    return year_spine([(paper, "paper_count"), (patent, "patent_count")], ["year"]).orderBy("year")


def velocity_series(velocity: DataFrame, max_year: Column, lag_years: Column, first_year: int = 2014) -> DataFrame:
    """Solid and provisional patent counts by year; the boundary year is in both."""
    cutoff = grant_cutoff_year(max_year, lag_years)
    shown = velocity.where(F.col("year") >= first_year)
    return shown.select("*", F.when(F.col("year") <= cutoff, F.col("patent_count")).alias("solid"), F.when(F.col("year") >= cutoff, F.col("patent_count")).alias("provisional"))


def _by_org(competitive: DataFrame, condition: Column) -> DataFrame:
    return competitive.where(condition & (F.col("canonical_name") != "Unresolved")).groupBy("org_id", "canonical_name").agg(F.sum("doc_count").alias("doc_count"))


def family_leaderboard(s: Star, family_id: str, side: str, top_n: int = 50, clusters: Ids = None) -> DataFrame:
    orgs = _by_org(s.mart_competitive, (F.col("family_id") == family_id) & (F.col("side") == side) & (F.col("cluster_id") != NOISE) & within({"cluster_id": clusters}))
    total = orgs.agg(F.count("*").alias("total_orgs"))
    return top_k(orgs.crossJoin(F.broadcast(total)), [F.col("doc_count").desc(), F.col("org_id")], top_n)  # one row


def top_orgs(s: Star, clusters: Sequence[str], side: str, top_n: int = 10) -> DataFrame:
    return top_k(_by_org(s.mart_competitive, F.col("cluster_id").isin(*clusters) & (F.col("side") == side)), [F.col("doc_count").desc(), F.col("org_id")], top_n)


def search_orgs(s: Star, query: str = "") -> DataFrame:
    """(canonical_name, org_id): active organisations beyond bare native ids, by name; short queries list the first hundred."""
    active = s.mart_competitive.where(f"cluster_id <> '{NOISE}'").select("org_id")
    found = s.dim_organization.where("primary_match_method <> 'native_id'").join(active, "org_id", "left_semi")
    short = len(query or "") < SHORT_QUERY
    found = found if short else found.where(contains_ignoring_case(F.col("canonical_name"), query))
    return top_k(found.select("canonical_name", "org_id"), [F.col("canonical_name"), F.col("org_id")], 100 if short else 50)


def search_papers(s: Star, query: str = "") -> DataFrame:
    """(label, work_id): cited papers by citing patents; short queries list the thirty most cited."""
    short = len(query or "") < SHORT_QUERY
    papers = s.dim_paper if short else s.dim_paper.where(contains_ignoring_case(F.col("title"), query))
    cited = s.fact_npl_link.groupBy("work_id").agg(F.countDistinct("patent_id").alias("n_citing"))
    best = top_k(papers.select("work_id", "title", F.year("publication_date").alias("year")).join(cited, "work_id"), [F.col("n_citing").desc(), F.col("work_id")], 30 if short else 50)
    label = F.concat(shortened(F.coalesce("title", F.lit(""))), F.lit(" ("), F.coalesce(F.col("year").cast("string"), F.lit("?")), F.lit(" · "), F.col("n_citing").cast("string"), F.lit(" patents)"))
    return best.select(label.alias("label"), "work_id")


def org_profile(s: Star, org_id: str) -> DataFrame:
    return s.dim_organization.where(F.col("org_id") == org_id).select("org_id", "canonical_name", "primary_match_method", "primary_confidence")


def org_output_by_family(s: Star, org_id: str, side: str, families: Ids = None, clusters: Ids = None) -> DataFrame:
    name = "n_patents" if side == "patent" else "n_papers"
    own = s.mart_competitive.where((F.col("org_id") == org_id) & (F.col("side") == side) & _scope(families, clusters))
    return own.groupBy(F.col("family_id_key").alias("family_id")).agg(F.sum("doc_count").alias(name)).orderBy(F.col(name).desc(), "family_id")


def dataset_totals(s: Star, families: Ids = None, clusters: Ids = None) -> DataFrame:
    scope = _facts_scope(families, clusters)
    return s.fact_publication.where(scope).agg(F.countDistinct("work_id").alias("total_papers")).crossJoin(s.fact_patent_filing.where(scope).agg(F.countDistinct("patent_id").alias("total_patents")))  # one row each


def org_active_scope(s: Star, org_id: str) -> DataFrame:
    return s.mart_competitive.where((F.col("org_id") == org_id) & (F.col("cluster_id") != NOISE)).select("cluster_id", "tagline", F.col("family_id_key").alias("family_id")).distinct()


def org_top_clusters(s: Star, org_id: str, side: str, families: Ids = None, clusters: Ids = None, most: int = 5) -> DataFrame:
    """An organisation's clusters by its documents there, over all families before ranking."""
    own = s.mart_competitive.where((F.col("org_id") == org_id) & (F.col("side") == side) & (F.col("cluster_id") != NOISE) & _scope(families, clusters))
    sums = own.groupBy("cluster_id", "tagline").agg(F.sum("doc_count").alias("doc_count"), ratio(F.sum("doc_count"), F.max("cluster_total")).alias("share"))
    best = top_k(sums, [F.col("doc_count").desc(), F.col("cluster_id")], most)
    return best.join(s.seed_cluster_family.select("cluster_id", "family_id"), "cluster_id", "left").orderBy(F.col("doc_count").desc(), "cluster_id")


def org_filing_years(s: Star, org_id: str, families: Ids = None, clusters: Ids = None) -> DataFrame:
    return s.fact_patent_filing.where((F.col("org_id") == org_id) & _facts_scope(families, clusters)).groupBy(F.year("filing_date").alias("year")).agg(F.countDistinct("patent_id").alias("n_patents")).orderBy("year")


def org_paper_years(s: Star, org_id: str, families: Ids = None, clusters: Ids = None) -> DataFrame:
    own = s.fact_publication.where((F.col("org_id") == org_id) & _facts_scope(families, clusters)).select("work_id").distinct()
    return s.dim_paper.where("publication_date is not null").join(own, "work_id", "left_semi").groupBy(F.year("publication_date").alias("year")).agg(F.countDistinct("work_id").alias("n_papers")).orderBy("year")


def _across(s: Star, near: DataFrame, near_key: str, far: DataFrame, far_key: str, count: str, org_name: tuple[str, str], most: int) -> DataFrame:
    """Organisations on the far side of the links from the near rows, by distinct ``count``; self-citation stays."""
    linked = s.fact_npl_link.join(near.select(near_key).distinct(), near_key, "left_semi").select("patent_id", "work_id").distinct()
    pairs = linked.join(far.where("org_id is not null").select(far_key, "org_id").distinct(), far_key)
    counts = pairs.groupBy("org_id").agg(F.countDistinct(count.split(":")[0]).alias(count.split(":")[1])).join(s.dim_organization.select("org_id", "canonical_name"), "org_id")
    n = count.split(":")[1]
    return top_k(counts.select(F.col("org_id").alias(org_name[0]), F.col("canonical_name").alias(org_name[1]), n), [F.col(n).desc(), F.col(org_name[0])], most)


def org_intake(s: Star, org_id: str, families: Ids = None, clusters: Ids = None, most: int = 10) -> DataFrame:
    """Whose papers this organisation's patents cite."""
    near = s.fact_patent_filing.where((F.col("org_id") == org_id) & _facts_scope(families, clusters))
    return _across(s, near, "patent_id", s.fact_publication, "work_id", "work_id:n_papers_cited", ("paper_org_id", "paper_org_name"), most)


def org_influence(s: Star, org_id: str, families: Ids = None, clusters: Ids = None, most: int = 10) -> DataFrame:
    """Whose patents cite this organisation's papers."""
    near = s.fact_publication.where((F.col("org_id") == org_id) & _facts_scope(families, clusters))
    return _across(s, near, "work_id", s.fact_patent_filing, "patent_id", "patent_id:n_patents", ("patenter_org_id", "patenter_name"), most)


def org_flagship_paper(s: Star, org_id: str, families: Ids = None, clusters: Ids = None) -> DataFrame:
    own = s.fact_publication.where((F.col("org_id") == org_id) & _facts_scope(families, clusters)).select("work_id").distinct()
    counts = s.fact_npl_link.join(own, "work_id", "left_semi").groupBy("work_id").agg(F.countDistinct("patent_id").alias("n_citing_patents"))
    best = top_k(counts.join(s.dim_paper.select("work_id", "title", "publication_date", "abstract"), "work_id"), [F.col("n_citing_patents").desc(), F.col("work_id")], 1)
    return best.select("work_id", "title", "publication_date", "abstract", "n_citing_patents")


def org_flagship_patent(s: Star, org_id: str, families: Ids = None, clusters: Ids = None) -> DataFrame:
    own = s.fact_patent_filing.where((F.col("org_id") == org_id) & _facts_scope(families, clusters)).select("patent_id", "filing_date").distinct()
    counts = s.fact_npl_link.groupBy("patent_id").agg(F.countDistinct("work_id").alias("n_papers_cited"))
    best = top_k(own.join(counts, "patent_id").join(s.dim_patent.select("patent_id", "title"), "patent_id"), [F.col("n_papers_cited").desc(), F.col("patent_id")], 1)
    return best.select("patent_id", "title", "filing_date", "n_papers_cited")


def trace_paper(s: Star, work_id: str) -> DataFrame:
    """A paper's card with all its organisations in one string, null where none is resolved."""
    rows = s.fact_publication.where(F.col("work_id") == work_id)
    orgs = rows.select("work_id", "org_id").distinct().join(s.dim_organization.select("org_id", "canonical_name"), "org_id").select("work_id", "canonical_name").distinct()
    names = orgs.groupBy("work_id").agg(ordered_string([F.col("canonical_name")], F.col("canonical_name")).alias("org_name"))
    out = joined(s.dim_paper.where(F.col("work_id") == work_id), [names, rows.select("work_id", "family_id").distinct()], "work_id")
    return out.select("title", "publication_date", "abstract", "primary_topic_name", "org_name", "family_id")


def trace_links(s: Star, work_id: str) -> DataFrame:
    """Citing patents of a paper: the best link of each, with all assignees in order."""
    trust = F.when(F.col("confidence") == "high", 0).when(F.col("confidence") == "medium", 1).otherwise(2)
    best = first_per_key(s.fact_npl_link.where(F.col("work_id") == work_id), "patent_id", [trust, F.col("citation_lag_years").asc_nulls_last(), F.col("link_source")]).select("patent_id", "confidence", "link_source", "citation_lag_years")
    held = s.fact_patent_filing.join(best.select("patent_id"), "patent_id", "left_semi").join(s.dim_organization.select("org_id", "canonical_name"), "org_id")
    order = [F.col("assignee_sequence").isNull(), F.col("assignee_sequence"), F.col("canonical_name")]
    names = held.groupBy("patent_id").agg(ordered_string(order, F.col("canonical_name")).alias("assignee"))
    out = best.join(s.dim_patent.select("patent_id", F.col("title").alias("patent_title"), "filing_date"), "patent_id").join(names, "patent_id", "left")
    return out.select("patent_id", "confidence", "link_source", "citation_lag_years", "patent_title", "filing_date", "assignee").orderBy(F.col("citation_lag_years").asc_nulls_last(), "patent_id")


def fastest_link(links: DataFrame) -> DataFrame:
    return links.where("citation_lag_years is not null").agg(F.min("citation_lag_years").alias("fastest"), F.count("*").alias("n_known"))


def trace_family_stat(s: Star, family_id: str) -> DataFrame:
    return s.mart_family.where(F.col("family_id") == family_id).select("family_name", "median_lag_years_weighted", "n_papers", "n_patents", "total_npl_links")


def shown_lag(gap: DataFrame) -> DataFrame:
    """The lag to display and its basis: linked where reportable, else by cohort, else none."""
    linked = F.col("npl_reportable") & F.col("npl_median_lag_years").isNotNull()
    return gap.select("*", F.coalesce(F.when(linked, F.col("npl_median_lag_years")), F.col("cohort_lag_years")).alias("lag_years"), F.when(linked, "linked").when(F.col("cohort_lag_years").isNotNull(), "cohort").otherwise("none").alias("lag_basis"))


def org_role(s: Star, org_id: str, families: Ids = None, clusters: Ids = None) -> DataFrame:
    """An organisation's papers and patents, their shares of all in scope, and its role."""
    sums = s.mart_competitive.where((F.col("org_id") == org_id) & _scope(families, clusters)).agg(*[F.coalesce(F.sum(F.when(F.col("side") == side, F.col("doc_count"))), F.lit(0)).alias(name) for side, name in (("paper", "papers"), ("patent", "patents"))])
    out = sums.crossJoin(dataset_totals(s, families, clusters))  # one row each
    return out.select("papers", "patents", ratio(F.col("papers"), F.col("total_papers"), 4).alias("paper_share"), ratio(F.col("patents"), F.col("total_patents"), 4).alias("patent_share"), role_of(F.col("papers"), F.col("patents")).alias("role"))
