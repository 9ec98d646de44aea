"""The whole build as a graph: named steps, what each reads, and how it is made.

A step's DataFrame is lazy; those in ``STORED`` are written (or cached) where later steps read them more than once, which
is also where the two phases meet: all up to the matchers and clusters, and all after them.
"""

from __future__ import annotations

import hashlib
import inspect
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import work_id
from ..functions.udfs import detect_language
from ..operators import gate, matching, quality
from ..sources import snapshots
from . import facts, marts, serving, staging

Make = Callable[..., DataFrame]


def _title_rows(scoped: DataFrame) -> DataFrame:
    return scoped.select("patent_id", F.col("patent_title").alias("title"))


def _paper_rows(works: DataFrame) -> DataFrame:
    return works.select(work_id(F.col("openalex_id")).alias("work_id"), "title", "abstract")


#: step: (what it reads, how it is made). Names that are no step are sources.
STEPS: dict[str, tuple[tuple[str, ...], Make]] = {
    "patents_scoped": (("patents", "applications", "cpc"), staging.in_scope),
    "excluded_documents": (("works", "patents_scoped"), lambda w, p: gate.exclusions(_paper_rows(w), _title_rows(p), detect_language)),
    "stg_openalex_works": (("works", "excluded_documents"), staging.staged_works),
    "stg_patents_scoped": (("patents_scoped", "excluded_documents"), staging.staged_patents),
    "stg_assignees": (("assignees", "stg_patents_scoped"), staging.staged_assignees),
    "stg_cpc": (("cpc", "stg_patents_scoped"), staging.staged_codes),
    "stg_npl": (("npl", "stg_patents_scoped"), staging.staged_references),
    "stg_patent_citations": (("citations", "stg_patents_scoped"), staging.staged_citations),
    "pv_orgs": (("assignees", "patents_scoped"), matching.patent_side_organisations),
    "oa_orgs": (("works",), matching.paper_side_organisations),
    "seed_matched": (("seed", "pv_orgs"), matching.seed_matches),
    "seed_oa_matched": (("seed", "oa_orgs"), matching.seed_institutions),
    "fuzzy_bridge": (("oa_orgs", "pv_orgs"), matching.blocked_bridge),
    "uncovered_orgs": (("seed_matched", "seed_oa_matched", "fuzzy_bridge"), matching.uncovered_organisations),
    "ror_bridge": (("uncovered_orgs", "institution_hits"), matching.name_bridge),
    "int_org_crosswalk": (("seed_matched", "seed_oa_matched", "ror_bridge", "fuzzy_bridge", "pv_orgs", "oa_orgs"), matching.crosswalk),
    "dim_organization": (("int_org_crosswalk",), facts.organisations),
    "dim_paper": (("stg_openalex_works",), facts.papers),
    "dim_patent": (("stg_patents_scoped",), facts.patents),
    "dim_cpc": (("stg_cpc",), facts.codes),
    "dim_technology_cluster": (("cluster_labels",), facts.technology_clusters),
    "mf_npl_links": (("published_links", "dim_patent", "dim_paper"), matching.published_links),
    "gold_links": (("mf_npl_links", "dim_patent", "dim_paper"), matching.gold_links),
    "npl_links": (("stg_npl", "dim_paper", "gold_links"), matching.matched_links),
    "fact_document_cluster": (("clusters", "stg_openalex_works", "stg_patents_scoped"), facts.document_clusters),
    "fact_publication": (("stg_openalex_works", "int_org_crosswalk", "fact_document_cluster"), facts.publications),
    "fact_patent_filing": (("stg_patents_scoped", "stg_assignees", "stg_cpc", "int_org_crosswalk", "fact_document_cluster"), facts.filings),
    "fact_npl_link": (("mf_npl_links", "npl_links", "dim_paper", "dim_patent"), facts.links),
    "fact_patent_citation": (("stg_patent_citations",), facts.patent_citations),
    "mart_velocity": (("fact_publication", "fact_patent_filing", "dim_technology_cluster"), marts.velocity),
    "mart_competitive": (("fact_publication", "fact_patent_filing", "dim_technology_cluster", "dim_organization"), marts.competitive),
    "mart_gap": (("fact_publication", "fact_patent_filing", "fact_npl_link", "fact_document_cluster", "dim_technology_cluster"), marts.gap),
    "mart_family": (("fact_publication", "fact_patent_filing", "fact_npl_link", "dim_patent"), marts.family),
    "seed_cluster_family": (("fact_patent_filing", "dim_paper", "fact_document_cluster", "dim_technology_cluster"), marts.cluster_families),
}
#: Steps that several others read.
STORED = ("patents_scoped", "excluded_documents", "stg_openalex_works", "stg_patents_scoped", "pv_orgs", "oa_orgs", "fuzzy_bridge", "int_org_crosswalk", "mf_npl_links", "npl_links", "fact_document_cluster", "fact_publication", "fact_patent_filing", "fact_npl_link")


def order(wanted: Iterable[str] | None = None, steps: Mapping[str, tuple[tuple[str, ...], Make]] = STEPS) -> list[str]:
    """Steps in an order that makes each after what it reads; only those that ``wanted`` needs."""
    needed, open_ = set(), list(wanted or steps)
    while open_:
        name = open_.pop()
        if name in steps and name not in needed:
            needed.add(name)
            open_ += steps[name][0]
    return [n for n in TopologicalSorter({n: [x for x in steps[n][0] if x in needed] for n in sorted(needed)}).static_order()]


def build(sources: Mapping[str, DataFrame], wanted: Iterable[str] | None = None, store: Callable[[str, DataFrame], DataFrame] = lambda name, df: df.cache()) -> dict[str, DataFrame]:
    """Every wanted step's DataFrame. ``store`` keeps a step that is read again: in memory, or as a snapshot read back."""
    made: dict[str, DataFrame] = dict(sources)
    for name in order(wanted):
        reads, make = STEPS[name]
        if absent := [x for x in reads if x not in made]:
            raise KeyError(f"{name} reads {absent}, which no step makes and no source gives")
        df = make(*[made[x] for x in reads])
        made[name] = store(name, df) if name in STORED else df
    return {k: v for k, v in made.items() if k not in sources}


class CheckFailed(RuntimeError):
    """A step's table breaks a contract; nothing that reads it was made."""


@dataclass
class State:
    """A build that keeps each step under a signature of its code and inputs, ``root/step/<signature>``.

    A step whose signature is there is read, not run; a changed source runs what descends from it alone. Tables are written whole under a name of their own, so a build that was
    stopped goes on where it stood. ``steps`` and ``tests`` (step: checks that count violations) may be given for other graphs.
    """

    root: str
    steps: Mapping[str, tuple[tuple[str, ...], Make]] = field(default_factory=lambda: STEPS)
    tests: Mapping[str, Mapping[str, Callable[[DataFrame], DataFrame]]] = field(default_factory=dict)
    ran: list[str] = field(default_factory=list)

    def signature(self, name: str, inputs: Iterable[str]) -> str:
        """Of a step's code, its checks' names and its inputs' signatures. Code is a function's source and that of its module."""
        make = self.steps[name][1]
        module = inspect.getmodule(make)
        code = (inspect.getsource(make) if make.__name__ == "<lambda>" else make.__qualname__) + (inspect.getsource(module) if module else "")
        return hashlib.sha256("\n".join([name, code, *sorted(self.tests.get(name, {})), *inputs]).encode()).hexdigest()[:32]

    def build(self, sources: Mapping[str, DataFrame], versions: Mapping[str, str], wanted: Iterable[str] | None = None) -> dict[str, DataFrame]:
        """Every wanted step's table. ``versions`` says what each source is, such as the folder that its snapshot was committed in."""
        made: dict[str, DataFrame] = dict(sources)
        signed = {k: f"source {k} {versions[k]}" for k in sources}
        self.ran.clear()
        for name in order(wanted, self.steps):
            reads, make = self.steps[name]
            if absent := [x for x in reads if x not in made]:
                raise KeyError(f"{name} reads {absent}, which no step makes and no source gives")
            signed[name] = self.signature(name, [signed[x] for x in reads])
            path = f"{self.root}/{name}/{signed[name]}"
            spark = next(iter(made.values())).sparkSession
            if not snapshots.complete(spark, path):
                self.ran.append(name)
                make(*[made[x] for x in reads]).write.mode("overwrite").parquet(path)
            made[name] = spark.read.parquet(path)
            # a table that fails stays for a look, and fails again until its code or inputs change
            failed = {k: n for k, check in self.tests.get(name, {}).items() if (n := check(made[name]).count())}
            if failed:
                raise CheckFailed(f"{name}: {failed}")
        return {k: v for k, v in made.items() if k not in sources}


def star(made: Mapping[str, DataFrame]) -> serving.Star:
    return serving.Star(**{k: made[k] for k in serving.Star.__dataclass_fields__})


def checks(made: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Violations of the contract between tables."""
    m = made
    return {
        "work_id_once": quality.repeated(m["stg_openalex_works"], ["work_id"]),
        "patent_id_once": quality.repeated(m["stg_patents_scoped"], ["patent_id"]),
        "crosswalk_once": quality.repeated(m["int_org_crosswalk"], ["source", "source_id"]),
        "competitive_once": quality.repeated(m["mart_competitive"], ["cluster_id", "side", "org_id_key", "family_id_key"]),
        "velocity_once": quality.repeated(m["mart_velocity"], ["cluster_id", "year"]),
        "confidence_known": quality.unaccepted(m["int_org_crosswalk"], "confidence", ["high", "medium", "low"]),
        "link_source_known": quality.unaccepted(m["fact_npl_link"], "link_source", ["marx_fuegi", "doi", "fuzzy_title"]),
        "link_paper_known": quality.orphans(m["fact_npl_link"], "work_id", m["dim_paper"]),
        "link_patent_known": quality.orphans(m["fact_npl_link"], "patent_id", m["dim_patent"]),
        "share_in_range": quality.outside(m["mart_competitive"], "share", 0, 1),
        "hhi_in_range": quality.outside(m["mart_gap"], "hhi", 0, 1),
        "patents_not_negative": quality.outside(m["mart_gap"], "n_patents", 0),
        "gap_lag_not_negative": quality.outside(m["mart_gap"], "npl_median_lag_years", 0),
        "one_link_source": quality.mixed_sources(m["fact_npl_link"]),
        "documents_known": quality.orphaned_documents(m["fact_document_cluster"], m["stg_openalex_works"], m["stg_patents_scoped"]),
    }
