import pytest

from paperloom.operators import quality
from paperloom.plans import build, serving
from paperloom.streaming import refresh as S

GOOD = "We present a source of extreme ultraviolet light and report that it is bright in the experiments."


@pytest.fixture(scope="module")
def sources(spark):
    df = spark.createDataFrame
    return {
        "patents": df([(f"{i}", f"Patent of the source {i}", "2022-05-01", "utility") for i in range(1, 31)], "patent_id string, patent_title string, patent_date string, patent_type string"),
        "applications": df([(f"{i}", "2020-03-15") for i in range(1, 31)], "patent_id string, filing_date string"),
        "cpc": df([(f"{i}", "G03F7/2004" if i % 2 else "G02B6/12", "G03F", "G03", "G", "inventional", "0") for i in range(1, 31)], "patent_id string, cpc_group string, cpc_subclass string, cpc_class string, cpc_section string, cpc_type string, cpc_sequence string"),
        "assignees": df([(f"{i}", f"A{i % 3}", f"Company {'abc'[i % 3]} Inc.", "2", "0") for i in range(1, 31)], "patent_id string, assignee_id string, disambig_assignee_organization string, assignee_type string, assignee_sequence string"),
        "npl": df([(f"{i}", "0", f"Bright extreme ultraviolet sources number {i} explained, doi 10.1000/x{i}.") for i in range(1, 11)], "patent_id string, other_reference_sequence string, other_reference_text string"),
        "citations": df([("1", "2"), ("1", None)], "patent_id string, citation_patent_id string"),
        "works": df([(f"https://openalex.org/W{i}", f"https://doi.org/10.1000/x{i}", f"Bright extreme ultraviolet sources number {i} explained", "article", "2018-01-01", 2018, "en", GOOD, "https://openalex.org/T11338", "EUV", [f"I{i % 2}"], [None], [f"Company {'ab'[i % 2]}"]) for i in range(1, 21)],
                    "openalex_id string, doi string, title string, type string, publication_date string, publication_year int, language string, abstract string, primary_topic_id string, primary_topic_name string, institution_ids array<string>, institution_rors array<string>, institution_display_names array<string>"),
        "seed": df([("org_a", "Company A", "company a", "")], "org_id string, canonical_name string, normalized_patentsview string, openalex_institution_id string"),
        "institution_hits": df([], "org_id string, institution_id string, display_name string"),
        "published_links": df([("us-20-b2", 20, 9, "front", "n")], "patent string, oaid long, confscore int, wherefound string, self string"),
        "clusters": df([(f"W{i}", "paper", "c_0", 0.0, 0.0, "v1") for i in range(1, 21)] + [(f"{i}", "patent", "c_0", 0.0, 0.0, "v1") for i in range(1, 31)] + [("gone", "patent", "c_0", 0.0, 0.0, "v1")], "doc_id string, doc_type string, cluster_id string, umap_x double, umap_y double, model_version string"),
        "cluster_labels": df([("c_0", "Zero", "s", ["t"])], "cluster_id string, tagline string, summary_friendly string, top_terms array<string>"),
    }


def test_build(sources, rows):
    made = build.build(sources)
    assert made["fact_npl_link"].count() == 11
    assert {r["link_source"] for r in made["fact_npl_link"].collect()} == {"marx_fuegi", "doi"}
    gap = made["mart_gap"].first()
    assert (gap["n_patents"], gap["n_papers"], gap["hhi_reportable"], gap["npl_n_links"]) == (30, 20, True, 11)
    assert made["mart_family"].where("family_id = 'euv'").first()["n_patents"] == 15
    cross = {(r["source"], r["source_id"]): r["org_id"] for r in made["int_org_crosswalk"].collect()}
    assert cross["patentsview", "A0"] == cross["openalex", "I0"] == "org_a"
    assert cross["patentsview", "A1"] == cross["openalex", "I1"] == "org_pv_company_b"
    report = dict(rows(quality.report(build.checks(made))))
    assert not any(report.values()), report
    star = build.star(made)
    assert serving.family_metrics(star, "euv").first()["n_patents"] == 15
    assert made["seed_cluster_family"].first()["family_id"] == "mixed"  # half the patents are of either family


def test_order():
    names = build.order(["mart_family"])
    assert names.index("stg_cpc") < names.index("fact_patent_filing") < names.index("mart_family")
    assert "mart_gap" not in names
    with pytest.raises(KeyError, match="patents"):
        build.build({}, ["patents_scoped"])


def test_refresh(spark, tmp_path, rows):
    kind = "id string, day string, v int"
    spark.createDataFrame([("a", "2026-01-01", 1), ("b", "2026-01-01", 1)], kind).write.parquet(f"{tmp_path}/in/v1")
    seen = []
    take = lambda df, n: seen.append(sorted(map(tuple, df.collect())))
    assert S.refresh(spark, f"{tmp_path}/in", kind, f"{tmp_path}/p", take) >= 1
    spark.createDataFrame([("a", "2026-01-02", 2)], kind).write.parquet(f"{tmp_path}/in/v2")
    S.refresh(spark, f"{tmp_path}/in", kind, f"{tmp_path}/p", take)
    assert [x for batch in seen[1:] for x in batch][-1:] == [("a", "2026-01-02", 2)]
    old, new = (spark.createDataFrame(x, kind) for x in ([("a", "2026-01-01", 1), ("b", "2026-01-01", 1)], [("a", "2026-01-02", 2)]))
    assert rows(S.upsert(old, new, ["id"], "day")) == [("a", "2026-01-02", 2), ("b", "2026-01-01", 1)]
    assert S.upsert(None, new, ["id"], "day").count() == 1
