"""Staging, facts, marts, gate, terms and serving on small tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from paperloom.operators import clusters as C
from paperloom.operators import gate
from paperloom.plans import facts, marts, serving, staging

d = dt.date


def test_scope(spark, rows):
    patents = spark.createDataFrame([(f"P{i}", f"T{i}", "2021-01-01", "utility") for i in range(1, 6)], "patent_id string, patent_title string, patent_date string, patent_type string")
    apps = spark.createDataFrame([("P1", "2020-03-15"), ("P2", "2020-03-15"), ("P3", "2012-11-01"), ("P4", "2020-06-01"), ("P5", "2020-06-01")], "patent_id string, filing_date string")
    codes = spark.createDataFrame([("P1", "G03F7/2004", 0), ("P1", "G03F7/2023", 1), ("P2", "A63C9/001", 0), ("P3", "G03F7/20", 0), ("P4", "H04L9/00", 0), ("P4", "G11C13/00", 5), ("P5", "H04L9/00", 0), ("P5", "G11C13/00", 4)], "patent_id string, cpc_group string, cpc_sequence int")
    assert rows(staging.in_scope(patents, apps, codes), "patent_id") == [("P1",), ("P5",)]


def test_staged_works(spark, rows):
    kind = "openalex_id string, doi string, title string, type string, publication_date string, publication_year int, language string, abstract string, primary_topic_id string, primary_topic_name string, institution_ids array<string>, institution_rors array<string>, institution_display_names array<string>"
    make = lambda i, doi, title, day="2020-01-02": (f"https://x/W{i}", doi, title, "article", day, 2020, "en", "a", None, None, None, None, None)
    w = spark.createDataFrame([make(1, "https://doi.org/10.5/A", "Good"), make(2, None, "No doi"), make(3, "10.7910/DVN/1", "Data"), make(4, None, "plot.PNG"), make(5, None, "seL4 3.0.1"), make(6, None, "x", None), make(7, None, "Excluded")], kind)
    out = spark.createDataFrame([("W7", "paper", "r"), ("W1", "patent", "r")], staging.NO_EXCLUSIONS)
    found = staging.staged_works(w, out)
    assert rows(found, "work_id", "doi_bare") == [("W1", "10.5/a"), ("W2", "")]
    assert found.first()["publication_date"] == d(2020, 1, 2)


def test_staged_patent_tables(spark, rows):
    p = spark.createDataFrame([("P1",)], "patent_id string")
    a = spark.createDataFrame([("P1", "A", "Org", "2", "0"), ("P1", "B", "Person", "4", "1"), ("P2", "C", "Org", "2", "0")], "patent_id string, assignee_id string, disambig_assignee_organization string, assignee_type string, assignee_sequence string")
    assert rows(staging.staged_assignees(a, p), "assignee_id", "assignee_sequence") == [("A", 0)]
    n = spark.createDataFrame([("P1", "3", "See 10.1000/ABC.1;"), ("P1", "4", None)], "patent_id string, other_reference_sequence string, other_reference_text string")
    assert rows(staging.staged_references(n, p), "ref_sequence", "doi_extracted") == [(3, "10.1000/abc.1")]


@pytest.fixture(scope="module")
def star(spark):
    clusters = spark.createDataFrame([("c1", "One", "s", ["t"]), ("c2", "Two", "s", ["t"]), ("c_noise", "Noise", "s", [])], "cluster_id string, tagline string, summary_friendly string, top_terms array<string>")
    filing = [("p1", d(2020, 1, 1), d(2022, 1, 1), "G03F7/20", "euv", 0, "o1", "c1"), ("p1", d(2020, 1, 1), d(2022, 1, 1), "G03F7/20", "euv", 1, "o2", "c1"), ("p2", d(2021, 1, 1), None, "H01S5/10", "lasers", None, None, "c1"), ("p3", d(2021, 1, 1), None, "A61K", None, 0, "o1", "c_noise"), ("p4", d(2019, 6, 1), None, "G03F7/20", "euv", 2, "o2", "c2")]
    filings = spark.createDataFrame(filing, "patent_id string, filing_date date, grant_date date, primary_cpc string, family_id string, assignee_sequence int, org_id string, cluster_id string")
    pubs = spark.createDataFrame([("w1", d(2018, 1, 1), 2018, "euv", "i1", "o1", "c1"), ("w1", d(2018, 1, 1), 2018, "euv", "i2", "o3", "c1"), ("w2", d(2020, 6, 1), 2020, None, "i1", None, "c2")], "work_id string, publication_date date, publication_year int, family_id string, institution_id string, org_id string, cluster_id string")
    links = spark.createDataFrame([("p1", "w1", "high", "marx_fuegi", 2.0), ("p4", "w1", "medium", "fuzzy_title", 1.41), ("p1", "w2", "high", "doi", None)], "patent_id string, work_id string, confidence string, link_source string, citation_lag_years double")
    orgs = spark.createDataFrame([("o1", "Alpha", "seed_crosswalk", "high"), ("o2", "Beta", "native_id", "high"), ("o3", "Gamma", "ror", "high")], "org_id string, canonical_name string, primary_match_method string, primary_confidence string")
    dim_patent = filings.select("patent_id", F.concat(F.lit("T "), "patent_id").alias("title"), "filing_date", "grant_date").distinct()
    dim_paper = spark.createDataFrame([("w1", "First paper", d(2018, 1, 1), "a", "topic"), ("w2", "Second", d(2020, 6, 1), None, None)], "work_id string, title string, publication_date date, abstract string, primary_topic_name string")
    bridge = filings.select(F.col("patent_id").alias("doc_id"), F.lit("patent").alias("doc_type"), "cluster_id").distinct()
    named = spark.createDataFrame([("c1", "euv", "EUV Lithography"), ("c2", "mixed", "Mixed")], "cluster_id string, family_id string, family_name string")
    return serving.Star(pubs, filings, links, orgs, dim_paper, dim_patent, clusters, marts.competitive(pubs, filings, clusters, orgs), marts.gap(pubs, filings, links, bridge, clusters), marts.family(pubs, filings, links, dim_patent), named)


def test_competitive_and_velocity(star, rows):
    found = {(r["side"], r["cluster_id"], r["org_id_key"], r["family_id_key"]): r for r in star.mart_competitive.collect()}
    assert found["patent", "c1", "unresolved", "lasers"]["canonical_name"] == "Unresolved"
    assert (found["patent", "c1", "o1", "euv"]["share"], found["patent", "c1", "o1", "euv"]["cluster_total"]) == (0.5, 2)
    assert sorted(found[k]["rank_in_cluster"] for k in found if k[:2] == ("patent", "c1")) == [1, 2, 3]
    v = marts.velocity(star.fact_publication, star.fact_patent_filing, star.dim_technology_cluster)
    assert ("c1", 2018, 1, 0) in rows(v, "cluster_id", "year", "paper_count", "patent_count")


def test_gap_and_family(star):
    gap = {r["cluster_id"]: r for r in star.mart_gap.collect()}
    assert (gap["c1"]["n_patents"], gap["c1"]["n_assignees"], gap["c1"]["hhi"], gap["c1"]["hhi_reportable"], gap["c1"]["pct_unresolved_patents"]) == (2, 1, None, False, 50.0)
    assert (gap["c1"]["npl_n_links"], gap["c1"]["npl_median_lag_years"], gap["c1"]["n_papers"], gap["c1"]["n_oa_institutions"]) == (2, None, 1, 2)
    family = {r["family_id"]: r for r in star.mart_family.collect()}
    assert list(family) and len(family) == 5
    assert (family["euv"]["n_patents"], family["euv"]["patent_share"], family["euv"]["total_npl_links"], family["euv"]["median_lag_years_weighted"], family["euv"]["avg_grant_lag_years"]) == (2, 0.667, 3, None, 2.0)
    assert (family["neuromorphic"]["n_patents"], family["neuromorphic"]["patent_share"]) == (0, 0.0)


def test_no_decimals_in_marts(star):
    for df in (star.mart_gap, star.mart_family, star.mart_competitive):
        assert not [c for c, kind in df.dtypes if kind.startswith("decimal")]


def test_multi_assignee_links_count_per_row_in_cluster_view(star):
    row = {r["cluster_id"]: r for r in serving.family_clusters(star, "euv").collect()}
    assert row["c1"]["npl_n_links"] == 4  # two links, two assignees
    assert row["c1"]["spillover_family_ids"] == ["lasers"]
    assert serving.family_metrics(star, "euv", ["c1"]).first()["total_npl_links"] == 2


def test_serving(star, rows):
    assert tuple(serving.unattributed_counts(star).first()) == (1, 1)
    assert tuple(serving.unclustered_counts(star).first()) == (1, 0)
    assert rows(serving.family_velocity(star, "euv")) == [(2018, 1, 0), (2019, 0, 1), (2020, 0, 1)]
    assert [r["canonical_name"] for r in serving.top_orgs(star, ["c1", "c2"], "patent").collect()] == ["Beta", "Alpha"]
    board = serving.family_leaderboard(star, "euv", "patent", 1).collect()
    assert [(r["org_id"], r["doc_count"], r["total_orgs"]) for r in board] == [("o2", 2, 2)]
    assert rows(serving.search_orgs(star), "org_id") == [("o1",), ("o3",)]
    assert rows(serving.search_orgs(star, "alp"), "org_id") == [("o1",)]
    assert [r["label"] for r in serving.search_papers(star, "first").collect()] == ["First paper (2018 · 2 patents)"]
    assert tuple(serving.dataset_totals(star).first()) == (2, 4)
    assert rows(serving.org_output_by_family(star, "o1", "patent")) == [("euv", 1), ("unattributed", 1)]
    assert [r["cluster_id"] for r in serving.org_top_clusters(star, "o1", "patent").collect()] == ["c1"]
    assert rows(serving.org_filing_years(star, "o1")) == [(2020, 1), (2021, 1)]
    assert rows(serving.org_paper_years(star, "o1")) == [(2018, 1)]
    assert rows(serving.org_intake(star, "o2")) == [("o1", "Alpha", 1), ("o3", "Gamma", 1)]
    assert rows(serving.org_influence(star, "o1")) == [("o1", "Alpha", 1), ("o2", "Beta", 2)]
    assert serving.org_flagship_paper(star, "o1").first()["n_citing_patents"] == 2
    assert serving.org_flagship_patent(star, "o1").first()["patent_id"] == "p1"
    paper = serving.trace_paper(star, "w1").first()
    assert (paper["org_name"], paper["family_id"]) == ("Alpha, Gamma", "euv")
    assert serving.trace_paper(star, "w2").first()["org_name"] is None
    assert [(r["patent_id"], r["assignee"]) for r in serving.trace_links(star, "w1").collect()] == [("p4", "Beta"), ("p1", "Alpha, Beta")]
    assert tuple(serving.fastest_link(serving.trace_links(star, "w1")).first()) == (1.41, 2)
    card = serving.cluster_card(star, "c1").first()
    assert (card["family_id"], card["total_patents"], card["family_patents"]) == ("euv", 3, 2)
    assert serving.cluster_bubble(star).count() == 2
    assert serving.family_scorecard(star).first()["family_id"] == "euv"
    assert serving.trace_family_stat(star, "euv").first()["total_npl_links"] == 3
    assert serving.org_role(star, "o1").first()["role"] == "Both researcher and IP holder"
    assert {r["lag_basis"] for r in serving.shown_lag(star.mart_gap).collect()} <= {"linked", "cohort", "none"}
    assert serving.org_active_scope(star, "o1").count() == 1
    assert serving.org_profile(star, "o1").count() == 1
    assert serving.family_top_orgs(star).count() > 0


def test_facts(spark, rows):
    cross = spark.createDataFrame([("o1", "openalex", "i1", "B", "ror", "high"), ("o1", "patentsview", "a1", "Seed", "seed_crosswalk", "high"), ("o2", "patentsview", "a2", "Z", "native_id", "high"), ("o2", "patentsview", "a3", "Y", "native_id", "high")], "org_id string, source string, source_id string, canonical_name string, match_method string, confidence string")
    assert rows(facts.organisations(cross), "org_id", "canonical_name") == [("o1", "Seed"), ("o2", "Y")]
    works = spark.createDataFrame([("w1", d(2018, 1, 1), 2018, "https://openalex.org/T11338", "EUV", "t", None, ["i1", "i1", "i9"]), ("w2", d(2018, 1, 1), 2018, None, None, "t", None, [])], "work_id string, publication_date date, publication_year int, primary_topic_id string, primary_topic_name string, title string, abstract string, institution_ids array<string>")
    bridge = spark.createDataFrame([("w1", "paper", "c1", 0.0, 0.0, "v"), ("gone", "paper", "c1", 0.0, 0.0, "v"), ("p1", "patent", "c2", 0.0, 0.0, "v")], "doc_id string, doc_type string, cluster_id string, umap_x double, umap_y double, model_version string")
    assert rows(facts.publications(works, cross, bridge), "work_id", "institution_id", "org_id", "family_id", "cluster_id") == [("w1", "i1", "o1", "euv", "c1"), ("w1", "i1", "o1", "euv", "c1"), ("w1", "i9", None, "euv", "c1")]
    patents = spark.createDataFrame([("p1", "t", d(2020, 1, 1), d(2021, 1, 1), "utility"), ("p2", "t", d(2017, 1, 1), None, "utility")], "patent_id string, title string, filing_date date, grant_date date, patent_type string")
    assert rows(facts.document_clusters(bridge, works, patents), "doc_id") == [("p1",), ("w1",)]
    assignees = spark.createDataFrame([("p1", "a1", "A", "2", 0)], "patent_id string, assignee_id string, org_name string, assignee_type string, assignee_sequence int")
    codes = spark.createDataFrame([("p1", "H01S5/10", 0), ("p1", "G03F7/20", 1)], "patent_id string, cpc_group string, cpc_sequence int")
    assert rows(facts.filings(patents, assignees, codes, cross, bridge), "patent_id", "primary_cpc", "family_id", "org_id", "cluster_id") == [("p1", "H01S5/10", "lasers", "o1", "c2"), ("p2", None, None, None, None)]
    published = spark.createDataFrame([("p1", "w1", "npl_citation", "high", 5, "front", "n")], "patent_id string, work_id string, match_method string, confidence string, confscore int, wherefound string, self string")
    matched = spark.createDataFrame([("p1", "w2", "npl_citation", "high", "10.1/x"), ("p2", "w1", "npl_citation", "medium", None)], "patent_id string, work_id string, match_method string, confidence string, doi_extracted string")
    found = facts.links(published, matched, works, patents)
    assert rows(found, "patent_id", "work_id", "link_source", "citation_lag_days", "citation_lag_years") == [("p1", "w1", "marx_fuegi", 730, 2.0)]  # p2 was filed before w1


def test_votes(spark, rows):
    votes = spark.createDataFrame([("c1", "euv")] * 8 + [("c1", "lasers")] * 2 + [("c2", "euv")] * 3 + [("c2", "mixed")] * 4 + [("c3", "a"), ("c3", "b")], "g string, v string")
    assert rows(marts.dominant_votes(votes, "g", "v", "mixed")) == [("c1", "euv"), ("c2", "mixed"), ("c3", "mixed")]


def test_gate(spark, rows):
    good = "We present a source of extreme ultraviolet light and report that it is bright in the experiments."
    other = "Wir zeigen eine Quelle für das extreme ultraviolette Licht und die Ergebnisse der Versuche mit ihr."
    papers = spark.createDataFrame([("W001", "The good title", good), ("W002", "Only a title", None), ("W003", "Only a title", ""), ("W004", "Die Quelle und das Licht", other), ("W005", "seL4 3.0.1", good), ("W006", "", good), ("W007", "A title of the source", other), ("W008", "", "Abstract not available for this one, whatever the length of the text that follows here."), ("W009", "", other)], "work_id string, title string, abstract string")
    patents = spark.createDataFrame([("P001", "Good"), ("P002", None), ("P003", "Lib 1.2")], "patent_id string, title string")
    got = {r["doc_id"]: r["text_source"] for r in gate.corpus(papers, patents).collect()}
    assert got == {"W001": "abstract", "W002": "title", "W003": "title", "W006": "abstract", "W007": "title", "P001": "title"}
    assert rows(gate.exclusions(papers, patents), "doc_id", "reason") == [("P002", "no_usable_text"), ("P003", "version_style_title"), ("W004", "non_english_content"), ("W005", "version_style_title"), ("W008", "no_usable_text"), ("W009", "non_english_content")]


def test_terms(spark):
    a, b = "photonic waveguide modulator silicon photonic", "neural network training gradient neural"
    docs = spark.createDataFrame([(f"d{i}", 0, a) for i in range(5)] + [(f"d{i}", 1, b) for i in range(5, 10)] + [("n", -1, "noise words here")], "doc_id string, label int, text string")
    found = {r["cluster_id"]: r["top_terms"] for r in C.cluster_terms(docs, most=3).collect()}
    assert set(found) == {"c_0", "c_1", "c_noise"}
    assert found["c_noise"] == []
    assert found["c_0"][0] == "photonic"
    assert found["c_1"][0] == "neural"
    assert all(len(x) <= 3 for x in found.values())
    assert [r["cluster_id"] for r in C.cluster_terms(docs.where("label < 0")).collect()] == ["c_noise"]


def test_dense_clusters(spark):
    pts = [(i, (i % 10) * 0.01, (i // 10) * 0.01) for i in range(100)] + [(100 + i, 5 + (i % 10) * 0.01, (i // 10) * 0.01) for i in range(60)] + [(999, 50.0, 50.0)]
    df = spark.createDataFrame(pts, "id long, umap_x double, umap_y double")
    found = {r["id"]: r["label"] for r in C.dense_clusters(df, "id", 0.05, least=10, smallest=50).collect()}
    assert {found[i] for i in range(100)} == {0}
    assert {found[i] for i in range(100, 160)} == {1}
    assert found[999] == -1


def test_labels_and_freeze(spark):
    t = spark.createDataFrame([("c_0", ["alpha", "beta"]), ("c_noise", [])], "cluster_id string, top_terms array<string>")
    found = {r["cluster_id"]: r for r in C.labelled(t).collect()}
    assert found["c_noise"]["tagline"] == "Frontier / Unclustered"
    assert found["c_0"]["tagline"].startswith("Alpha")
    said = C.labelled(t, answer=lambda p: F.lit('Sure: {"tagline": "Big Idea", "summary_friendly": "x"} ok'))
    assert {r["cluster_id"]: r["tagline"] for r in said.collect()}["c_0"] == "Big Idea"
    ids = spark.createDataFrame([("a",), ("b",)], "doc_id string")
    assert C.still_valid(ids, ids.union(ids))
    assert not C.still_valid(ids, ids.limit(1))
