import pytest
from pyspark.sql import functions as F

from paperloom.functions import text as X
from paperloom.functions.udfs import alike, guess_language, hashed_embedding, token_set_score


def one(spark, value, build, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(build(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    ("name", "expected"),
    [("NVIDIA Corporation", "nvidia"), ("ASML Holding N.V.", "asml"), ("Qualcomm Inc.", "qualcomm"), ("", ""), ("   ", ""), (None, ""), ("Foo Co., Ltd.", "foo"), ("Société Générale S.A.", "societe generale"), ("Holdings", "holdings"), ("Group Inc", "group"),
     ("Kabushiki Kaisha Toshiba", "kabushiki kaisha toshiba"), ("AT&T (Labs)", "at t labs"), ("Müller B.V.", "muller"), ("X_Y GmbH", "x y"), ("Taiwan L.T.D.", "taiwan")],
)
def test_organisation_name(spark, name, expected):
    assert one(spark, name, X.organisation_name) == expected


@pytest.mark.parametrize(("text", "expected"), [("taiwan semiconductor manufacturing company limited", "taiwan_semiconductor_manufacturing_company"), ("a & b", "a_b"), ("", ""), ("  X-ray  lab ", "x_ray_lab")])
def test_slug(spark, text, expected):
    assert one(spark, text, X.slug) == expected


def test_ids_and_dois(spark):
    assert one(spark, "https://openalex.org/W2741809807", X.work_id) == "W2741809807"
    assert one(spark, None, X.bare_doi) == ""
    assert one(spark, "https://doi.org/10.1/AbC", X.bare_doi) == "10.1/abc"
    assert one(spark, "see 10.1109/5.771073. More", X.doi_in) == "10.1109/5.771073"
    assert one(spark, "no doi", X.doi_in) is None


@pytest.mark.parametrize(("title", "staged", "gated"), [("libBigWig 0.1.5", True, True), ("seL4: seL4 3.0.1", True, True), ("seL4: other 3.0.1", True, False), ("IDBac v0.0.15 (beta)", True, True), ("A study of EUV 2.0 sources", False, False)])
def test_version_titles(spark, title, staged, gated):
    assert one(spark, title, X.staged_version_title) is staged
    assert one(spark, title, X.gated_version_title) is gated


def test_abstract(spark):
    kind = "map<string, array<int>>"
    assert one(spark, {"This": [0], "paper": [1], "discusses": [2], "EUV": [3]}, X.abstract_of, kind) == "This paper discusses EUV"
    assert one(spark, {"start": [0], "end": [2]}, X.abstract_of, kind) == "start  end"
    assert one(spark, {}, X.abstract_of, kind) == ""
    assert one(spark, None, X.abstract_of, kind) == ""


@pytest.mark.parametrize(("year", "lag", "expected"), [(2024, 3.37, 2021), (2024, 1.84, 2022), (2024, 0.1, 2023), (2024, None, 2022), (2024, 2.5, 2022)])
def test_grant_cutoff(spark, year, lag, expected):
    df = spark.createDataFrame([(year, lag)], "y int, l double")
    assert df.select(X.grant_cutoff_year(F.col("y"), F.col("l")).alias("r")).first()["r"] == expected


def test_families(spark):
    assert one(spark, "H10N70/00", X.patent_family) == "in_memory"
    assert one(spark, "A61K", X.patent_family) is None
    assert one(spark, None, X.patent_vote) == "mixed"
    df = spark.createDataFrame([("https://openalex.org/T10502", "A memristor synapse", None), ("https://openalex.org/T10502", "RRAM cells", "x"), ("https://openalex.org/T10502", "Logic", ""), ("https://openalex.org/T11338", "t", None)], "t string, a string, b string")
    assert [r[0] for r in df.select(X.paper_family(F.col("t"), F.col("a"), F.col("b"))).collect()] == ["neuromorphic", "in_memory", None, "euv"]


def test_confidence_role_and_cluster(spark):
    assert [one(spark, w, X.link_confidence) for w in ("front", "both", "body", "other")] == ["high", "high", "medium", "medium"]
    assert [one(spark, n, X.cluster_name, "int") for n in (-1, 0, 12)] == ["c_noise", "c_0", "c_12"]
    df = spark.createDataFrame([(0, 5), (5, 0), (1, 1), (0, 0)], "a long, b long")
    assert [r[0] for r in df.select(X.role_of(F.col("a"), F.col("b"))).collect()] == ["Primarily an IP holder", "Primarily a research institution", "Both researcher and IP holder", "Primarily a research institution"]


def test_scores():
    assert token_set_score("nvidia", "nvidia research labs") == 100
    assert token_set_score("", "x") == 0
    assert alike("abc", "abc") == 100
    assert alike("abcd", "abed") == pytest.approx(75)
    a = "deep learning for lithography hotspot detection"
    assert token_set_score(a, f"smith et al., {a} proc. spie 2019") == 100
    assert token_set_score("deep learning for lithography", "a history of naval warfare") < 60


def test_language_and_embedding():
    assert guess_language("the cat is on the mat and it was") == "en"
    assert guess_language("der Hund ist nicht auf dem Tisch und") == "de"
    assert guess_language("") is None
    v = hashed_embedding("some words", 384)
    assert v.shape == (384,)
    assert float((v * v).sum()) == pytest.approx(1, abs=1e-5)
    assert not hashed_embedding("", 8).any()
