from pyspark.sql import functions as F

from paperloom.operators import quality as Q
from paperloom.operators import relational as R

c = F.col


def test_first_per_key_and_top_k(spark, rows):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", None, "z"), ("b", 3, "w")], "k string, n int, v string")
    assert rows(R.first_per_key(df, "k", [c("n").asc_nulls_last()]), "k", "v") == [("a", "y"), ("b", "w")]
    assert [r["v"] for r in R.top_k(df, [c("n").desc_nulls_last(), c("v")], 2).collect()] == ["w", "x"]


def test_concentration(spark):
    data = [("c1", f"o{i % 2}") for i in range(10)] + [("c1", None)] * 2 + [("c2", None)]
    found = {r["g"]: r for r in R.concentration(spark.createDataFrame(data, "g string, o string"), "g", "o").collect()}
    assert (found["c1"]["hhi"], found["c1"]["total"], found["c1"]["resolved"], found["c1"]["unresolved"], found["c1"]["n_entities"]) == (0.5, 12, 10, 2, 2)
    assert found["c2"]["hhi"] is None


def test_spine_and_priority(spark, rows):
    a = spark.createDataFrame([(2020, 3)], "year int, p long")
    b = spark.createDataFrame([(2020, 1), (2021, 2)], "year int, q long")
    assert rows(R.year_spine([(a, "p"), (b, "q")], ["year"])) == [(2020, 3, 1), (2021, 0, 2)]
    one = spark.createDataFrame([("k", "first")], "k string, v string")
    two = spark.createDataFrame([("k", "second"), ("l", "third")], "k string, v string")
    assert rows(R.keep_first_by_priority([one, two], ["k"], ["v"])) == [("k", "first"), ("l", "third")]


def test_not_in_semi_within(spark, rows):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    ids = spark.createDataFrame([(1,), (None,)], "k int")
    assert rows(R.semi(df, ids, "k")) == [(1,)]
    assert (2,) in rows(R.not_in(df, ids, "k"))
    assert df.where(R.within({"k": [1]})).count() == 1
    assert df.where(R.within({"k": None})).count() == 3


def test_lists_ratio_and_reported(spark):
    df = spark.createDataFrame([("g", 2, "b"), ("g", 1, "c"), ("g", 2, "a")], "g string, n int, v string")
    assert df.groupBy("g").agg(R.ordered_list([-c("n"), c("v")], c("v")).alias("l")).first()["l"] == ["a", "b", "c"]
    assert df.groupBy("g").agg(R.ordered_string([c("v")], c("v")).alias("l")).first()["l"] == "a, b, c"
    one = spark.createDataFrame([(3, 7, 0)], "a int, b int, z int")
    assert tuple(one.select(R.ratio(c("a"), c("b"), 4), R.ratio(c("a"), c("z")), R.reported(c("a"), c("b"), 10), R.reported(c("a"), c("b"), 7)).first()) == (0.4286, None, None, 3)


def test_precision_recall_and_signature(spark):
    f = spark.createDataFrame([(1,), (2,)], "k int")
    g = spark.createDataFrame([(2,), (3,), (4,)], "k int")
    r = R.precision_recall(f, g, ["k"]).first()
    assert (r["precision"], round(r["recall"], 4)) == (0.5, 0.3333)
    empty = spark.createDataFrame([], "k int")
    assert tuple(R.precision_recall(empty, empty, ["k"]).select("precision", "recall").first()) == (0.0, 0.0)
    a = spark.createDataFrame([("b",), ("a",), ("a",)], "id string")
    b = spark.createDataFrame([("a",), ("b",)], "id string")
    s = R.signature(a, "id").first()["signature"]
    assert s == R.signature(b, "id").first()["signature"]
    assert len(s) == 16


def test_search_wild_cards(spark):
    df = spark.createDataFrame([("50% Foo",), ("50 bar",)], "v string")
    assert df.where(R.contains_ignoring_case(c("v"), "foo")).count() == 1
    assert df.where(R.contains_ignoring_case(c("v"), "50_")).count() == 2
    assert df.where(R.contains_ignoring_case(c("v"), "50%", escape=True)).count() == 1


def test_quality(spark, rows):
    df = spark.createDataFrame([(1, "a", 0.5), (1, "b", 1.5), (None, "z", -1.0)], "k int, v string, x double")
    parent = spark.createDataFrame([(2,)], "k int")
    checks = {"missing": Q.missing(df, "k"), "once": Q.repeated(df, ["k"]), "accepted": Q.unaccepted(df, "v", ["a", "b"]), "orphans": Q.orphans(df, "k", parent), "range": Q.outside(df, "x", 0, 1)}
    assert dict(rows(Q.report(checks))) == {"missing": 1, "once": 1, "accepted": 1, "orphans": 2, "range": 2}
    links = spark.createDataFrame([("p", "marx_fuegi"), ("p", "doi"), ("q", "doi"), ("q", "fuzzy_title")], "patent_id string, link_source string")
    assert rows(Q.mixed_sources(links), "patent_id") == [("p",)]
    empty = df.limit(0)
    assert Q.silently_empty(empty, df).count() == 1
    assert Q.silently_empty(df, df).count() == 0
