"""The blocked bridge against every pair scored."""

import random

import pytest
from pyspark.sql import functions as F

from paperloom.functions.udfs import token_set_score
from paperloom.operators import matching as M

NAMES = "id string, normalized_name string, a string"


def names(seed, n, prefix):
    r = random.Random(seed)
    words = ["university", "institute", "of", "technology", "tech", "technologies", "robotic", "robotics", "systems", "system", "stanford", "stanfrod", "x", "lab", "labs", "ibm", "ab", "a1", "münchen"]
    out = []
    for i in range(n):
        w = [r.choice(["university", "university", "institute", "ibm", "acme", ""]), *r.choices(words, k=r.randrange(0, 5))]
        text = " ".join(w)
        if r.random() < 0.3 and len(text) > 4:
            at = r.randrange(len(text))
            text = text[:at] + r.choice("aeiou x") + text[at + 1 :]
        out.append((f"{prefix}{i:03d}", r.choice([text, text, text, None, "", "university"]) if r.random() < 0.1 else text, "q"))
    return out


def brute(left, right, review):
    out = {}
    for i, a, _ in left:
        for j, b, _ in right:
            if a and b and a.split(" ")[0] == b.split(" ")[0] and (s := token_set_score(a, b)) >= review:
                out[i] = min(out.get(i, (0, "")), (-s, j))
    return {i: (j, -s) for i, (s, j) in out.items()}


@pytest.mark.parametrize("review", [80, 90, 95, 100])
def test_equals_all_pairs(spark, review):
    left, right = names(1, 150, "I"), names(2, 150, "A")
    a = spark.createDataFrame(left, NAMES)
    b = spark.createDataFrame(right, NAMES).withColumnRenamed("id", "assignee_id")
    got = {r["id"]: (r["assignee_id"], r["similarity"]) for r in M.blocked_bridge(a, b, "id", review=review).collect()}
    assert got == brute(left, right, review)


@pytest.mark.parametrize("review", [80, 90, 95])
def test_few_pairs_are_scored(spark, review):
    left, right = names(5, 400, "I"), names(6, 400, "A")
    a = M._named(spark.createDataFrame(left, NAMES), "normalized_name", "a")
    b = M._named(spark.createDataFrame(right, NAMES), "normalized_name", "b").withColumn("rid", F.col("b"))
    block = a.join(b, "first").count()
    scored = M.similar_candidates(a, b, review).where("bound > sure").count()
    print(review, block, scored)
    assert scored < {80: 0.5, 90: 0.2, 95: 0.1}[review] * block


def test_plan_at_100_has_no_python(spark):
    a = spark.createDataFrame(names(1, 20, "I"), NAMES)
    assert "Python" not in M.blocked_bridge(a, a.withColumnRenamed("id", "assignee_id"), "id")._jdf.queryExecution().toString()
    assert M.blocked_bridge(a.limit(0), a.withColumnRenamed("id", "assignee_id"), "id", review=80).count() == 0


def test_frequent_first_word_multiplies_nothing(spark):
    """Names of one frequent word meet one row of their block."""
    a = spark.createDataFrame([(f"I{i}", "university", "q") for i in range(300)] + [(f"J{i}", f"university of town{i}", "q") for i in range(300)], NAMES)
    b = spark.createDataFrame([(f"A{i:03d}", f"university of place{i}", "q") for i in range(300)] + [("A999", "university", "q")], NAMES).withColumnRenamed("id", "assignee_id")
    found = M.blocked_bridge(a, b, "id")
    assert {(r["id"][0], r["assignee_id"]) for r in found.collect()} == {("I", "A000"), ("J", "A999")}
    named = M._named(b.withColumnRenamed("assignee_id", "id"), "normalized_name", "b").withColumn("rid", F.lit("A"))
    assert M._containing(M._named(a, "normalized_name", "a"), named).count() == 301
