import pytest
from pyspark.sql import functions as F

from paperloom.operators import matching as M

ORG = "assignee_id string, display_name string, normalized_name string, match_method string, confidence string"
INST = ORG.replace("assignee_id", "institution_id")


def test_patent_side(spark, rows):
    scoped = spark.createDataFrame([("P1",), ("P2",), ("P3",)], "patent_id string")
    a = spark.createDataFrame([("P1", "A001", "NVIDIA Corp", "2"), ("P2", "A001", "NVIDIA Corporation", "2"), ("P1", "A002", "ASML N.V.", "3"), ("P1", "A003", None, "2"), ("P1", "A004", "Person", "4"), ("P5", "A005", "Out", "2"), ("P3", "A006", "Qualcomm Inc", "6"), ("P3", "A007", "Gov Lab", "7")], "patent_id string, assignee_id string, disambig_assignee_organization string, assignee_type string")
    found = {r["assignee_id"]: r for r in M.patent_side_organisations(a, scoped).collect()}
    assert set(found) == {"A001", "A002", "A006", "A007"}
    assert [found[k]["normalized_name"] for k in ("A001", "A002", "A006")] == ["nvidia", "asml", "qualcomm"]
    assert (found["A001"]["match_method"], found["A001"]["confidence"]) == ("native_id", "high")


def test_paper_side(spark, rows):
    w = spark.createDataFrame([(["I1", "I2"], ["Zeta Lab", "Beta"]), (["I1"], ["Alpha Lab"]), ([], []), (None, None), (["I3"], [])], "institution_ids array<string>, institution_display_names array<string>")
    assert rows(M.paper_side_organisations(w), "institution_id", "display_name", "match_method") == [("I1", "Alpha Lab", "ror"), ("I2", "Beta", "ror")]


def pairs(spark):
    pv = spark.createDataFrame([("A001", "nvidia"), ("A002", "taiwan semiconductor manufacturing"), ("A003", "asml"), ("A004", "intel"), ("A005", "applied materials")], "assignee_id string, normalized_name string")
    oa = spark.createDataFrame([("I001", "nvidia"), ("I002", "taiwan semiconductor manufacturing"), ("I003", "asml holding"), ("I004", "totally unrelated company"), ("I005", "intel corporation")], "institution_id string, normalized_name string")
    return oa, pv


def test_bridge(spark, rows):
    oa, pv = pairs(spark)
    assert rows(M.blocked_bridge(oa, pv), "institution_id", "assignee_id") == [("I001", "A001"), ("I002", "A002"), ("I003", "A003"), ("I005", "A004")]
    empty = M.blocked_bridge(oa.limit(0), pv)
    assert empty.count() == 0
    assert dict(empty.dtypes)["similarity"] == "double"
    assert "Python" not in M.blocked_bridge(oa, pv)._jdf.queryExecution().toString()


def test_bridge_review_band(spark):
    oa = spark.createDataFrame([("I1", "acme robotic systems"), ("I2", "acme zzz qqq www")], "institution_id string, normalized_name string")
    pv = spark.createDataFrame([("A1", "acme robotics systems")], "assignee_id string, normalized_name string")
    found = {r["institution_id"]: r for r in M.blocked_bridge(oa, pv, high=99, review=80).collect()}
    assert found["I1"]["confidence"] == "medium"
    assert "I2" not in found


def test_seed(spark, rows):
    seed = spark.createDataFrame([("org_nvidia", "NVIDIA", "nvidia", "I1"), ("org_asml", "ASML", "asml", ""), ("org_asml", "ASML", "asml netherlands", None), ("org_ghost", "Ghost", "ghost", " ")], "org_id string, canonical_name string, normalized_patentsview string, openalex_institution_id string")
    pv = spark.createDataFrame([("A001", "NV", "nvidia", "m", "h"), ("A002", "AS", "asml", "m", "h"), ("A003", "AN", "asml netherlands", "m", "h"), ("A005", "Other", "other", "m", "h")], ORG)
    found = M.seed_matches(seed, pv)
    assert rows(found, "assignee_id", "org_id") == [("A001", "org_nvidia"), ("A002", "org_asml"), ("A003", "org_asml")]
    assert rows(M.seed_unmatched(seed, pv), "org_id") == [("org_ghost",)]
    oa = spark.createDataFrame([("I1", "Nvidia US", "nvidia us", "ror", "high")], INST)
    own = M.seed_institutions(seed, oa)
    assert rows(own, "org_id", "institution_id") == [("org_nvidia", "I1")]
    bridge = spark.createDataFrame([("I9", "A002")], "institution_id string, assignee_id string")
    assert M.uncovered_organisations(found, own, bridge).count() == 0
    assert rows(M.uncovered_organisations(found, own, bridge.limit(0)), "org_id") == [("org_asml",)]


def test_name_bridge(spark, rows):
    orgs = spark.createDataFrame([("org_ibm", "IBM"), ("org_ibm_research", "IBM Research")], "org_id string, canonical_name string")
    hits = spark.createDataFrame([("org_ibm", "I1", "IBM Research - Almaden"), ("org_ibm_research", "I1", "IBM Research - Almaden"), ("org_ibm", "I2", "IBM (United States)"), ("org_ibm", "I3", "Totally Unrelated")], "org_id string, institution_id string, display_name string")
    assert rows(M.name_bridge(orgs, hits), "institution_id", "org_id") == [("I1", "org_ibm_research"), ("I2", "org_ibm")]


def test_crosswalk(spark):
    seed = spark.createDataFrame([("org_nvidia", "NVIDIA", "A001", "Nvidia Corp", "seed_crosswalk", "high"), ("org_intel", "Intel", "A002", "Intel Corp", "seed_crosswalk", "high")], "org_id string, canonical_name string, assignee_id string, display_name string, match_method string, confidence string")
    none = spark.createDataFrame([], "org_id string, institution_id string, display_name string, match_method string, confidence string")
    bridge = spark.createDataFrame([("I001", "A001", 100.0, "fuzzy_high", "high"), ("I002", "A002", 100.0, "fuzzy_high", "high"), ("I003", "A003", 100.0, "fuzzy_high", "high")], "institution_id string, assignee_id string, similarity double, match_method string, confidence string")
    pv = spark.createDataFrame([(f"A00{i}", f"Name {i}", f"name {i}", "native_id", "high") for i in range(1, 5)], ORG)
    oa = spark.createDataFrame([(f"I00{i}", f"Inst {i}", f"inst {i}", "ror", "high") for i in range(1, 5)], INST)
    found = {(r["source"], r["source_id"]): r for r in M.crosswalk(seed, none, none, bridge, pv, oa).collect()}
    assert len(found) == 8
    org = lambda source, i: found[source, i]["org_id"]
    assert (org("openalex", "I001"), org("openalex", "I002")) == ("org_nvidia", "org_intel")
    assert org("patentsview", "A003") == org("openalex", "I003") == "org_pv_name_3"
    assert found["patentsview", "A003"]["match_method"] == "fuzzy_high"
    assert (org("patentsview", "A004"), found["patentsview", "A004"]["match_method"]) == ("org_pv_name_4", "native_id")
    assert (org("openalex", "I004"), found["openalex", "I004"]["match_method"]) == ("org_oa_inst_4", "ror")


def test_crosswalk_claimed_institution_emits_nothing(spark):
    seed = spark.createDataFrame([], "org_id string, canonical_name string, assignee_id string, display_name string, match_method string, confidence string")
    seed_oa = spark.createDataFrame([("org_x", "I1", "X Labs", "seed_crosswalk", "high")], "org_id string, institution_id string, display_name string, match_method string, confidence string")
    bridge = spark.createDataFrame([("I1", "A1", 100.0, "fuzzy_high", "high")], "institution_id string, assignee_id string, similarity double, match_method string, confidence string")
    pv = spark.createDataFrame([("A1", "X", "x", "native_id", "high")], ORG)
    oa = spark.createDataFrame([("I1", "X Labs", "x labs", "ror", "high")], INST)
    found = {r["source_id"]: r for r in M.crosswalk(seed, seed_oa, seed_oa.limit(0), bridge, pv, oa).collect()}
    assert (found["I1"]["org_id"], found["I1"]["canonical_name"]) == ("org_x", "X Labs")
    assert found["A1"]["match_method"] == "native_id"


TITLES = [("W100", "Extreme ultraviolet lithography source development overview"), ("W101", "Silicon photonics modulators for optical interconnects today"), ("W102", "Memristor crossbar arrays enabling neuromorphic computing systems"), ("W999", "Short title")]


def papers(spark):
    return spark.createDataFrame([(i, t, "10.1/x" if i == "W100" else "") for i, t in TITLES], "work_id string, title string, doi_bare string")


def references(spark, data):
    return spark.createDataFrame(data, "patent_id string, ref_sequence int, ref_text string, doi_extracted string")


def test_links(spark, rows):
    refs = references(spark, [
        ("US1", 0, "SMITH J., Extreme Ultraviolet Lithography Source Development Overview, Proc. SPIE, 2015", None),
        ("P1", 1, "Lee et al. Silicon photonics modulators for optical interconnects today. Nature 2018", None),
        ("P2", 0, "too short", None), ("P3", 0, "anything at all here", "10.1/x"), ("P4", 0, None, None),
    ])
    found = rows(M.matched_links(refs, papers(spark), threshold=90), "patent_id", "work_id", "confidence")
    assert found == [("P1", "W101", "medium"), ("P3", "W100", "high"), ("US1", "W100", "medium")]


def test_postings_cap(spark):
    q = spark.createDataFrame([("q", ["common", "rare"])], "q string, tokens array<string>")
    d = spark.createDataFrame([(f"d{i}", ["common"] + (["rare"] if i == 7 else [])) for i in range(9)], "d string, tokens array<string>")
    assert [(r["d"], r["shared"]) for r in M.candidates(q, d, "q", "d", postings=8).collect()] == [("d7", 1)]


@pytest.mark.parametrize(("gold", "expected"), [([("P1", "W1")], 90), ([("P1", "W2")], 100)])
def test_threshold(spark, gold, expected):
    matches = spark.createDataFrame([("P1", "W1", 92.0)], "patent_id string, work_id string, score double")
    assert M.choose_threshold(matches, spark.createDataFrame(gold, "patent_id string, work_id string")) == expected


def test_published(spark, rows):
    raw = spark.createDataFrame([("us-123-b2", 7, 5, "body", "n"), ("us-123-b2", 7, 4, "both", "n"), ("us-9-a", 7, 9, "front", "y"), ("ep-1", 7, 9, "front", "y")], "patent string, oaid long, confscore int, wherefound string, self string")
    patents = spark.createDataFrame([("123",)], "patent_id string")
    works = spark.createDataFrame([("W7",)], "work_id string")
    assert rows(M.published_links(raw, patents, works), "patent_id", "work_id", "confidence", "confscore", "wherefound") == [("123", "W7", "high", 4, "both")]
    assert M.gold_links(raw.select(F.lit("123").alias("patent_id"), F.lit("W7").alias("work_id"), "confscore"), patents, works).count() == 3
