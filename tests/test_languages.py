import math
import re
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from paperloom.operators import languages as L

DATA = Path("/root/testdata/sf0.01/documents.parquet")
KIND = "doc_id long, text string, lang string, n string"
ROWS = [(1, "the house of the man", "en", ""), (2, "das Haus des Mannes und die Frau", "de", ""), (3, "la maison de l'homme", "fr", ""), (4, None, "fr", ""), (5, "the the", None, "")]


def plain(text):
    return [p[i : i + 3] for w in re.findall(r"[^\W\d_]+", (text or "").lower()) for p in [f" {w} "] for i in range(len(p) - 2)]


def test_against_plain_sums(spark):
    docs = spark.createDataFrame(ROWS, KIND)
    names, known = L.profiles(docs, most=1000)
    assert names == ["de", "en", "fr"]
    counts = {k: Counter(g for _, t, lang, _ in ROWS if lang == k for g in plain(t)) for k in names}
    chance = lambda g, k: math.log((counts[k][g] + 0.5) / (sum(counts[k].values()) + 500))
    seen = set().union(*counts.values())
    asked = [(10, "the man", None, ""), (11, "die Frau", None, ""), (12, "homme", None, ""), (13, "xyzzy 12", None, ""), (14, None, None, ""), (15, "", None, "")]
    got = {r["doc_id"]: (r["guess"], r["lead"]) for r in L.guessed(spark.createDataFrame(asked, KIND), names, known, "doc_id").collect()}
    for i, t, _, _ in asked:
        own = [g for g in plain(t) if g in seen]
        if not own:
            assert got[i] == (None, None)
            continue
        sums = sorted(((sum(chance(g, k) for g in own), k) for k in names), reverse=True)
        assert got[i][0] == sums[0][1]
        assert got[i][1] == pytest.approx((sums[0][0] - sums[1][0]) / len(own))
    high = L.guessed(spark.createDataFrame(asked, KIND), names, known, "doc_id", margin=99.0)
    assert high.where("guess is not null").count() == 0


def test_odd_tables(spark):
    none = spark.createDataFrame([], KIND)
    names, known = L.profiles(none)
    assert names == []
    assert L.guessed(spark.createDataFrame(ROWS, KIND), names, known, "doc_id").where("guess is not null").count() == 0
    assert L.guessed(none, ["en"], known, "doc_id").count() == 0
    assert L.calibrated(none, names, known, "doc_id") == 0.0
    plan = L.guessed(spark.createDataFrame(ROWS, KIND), ["en"], known, "doc_id")._jdf.queryExecution().toString()
    assert "Python" not in plan


@pytest.mark.skipif(not DATA.exists(), reason="no test tables")
def test_agreement_on_documents_not_counted(spark):
    docs = spark.read.parquet(str(DATA)).where("lang is not null")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1
    names, known = L.profiles(docs.where(~held))
    known = known.cache()
    margin = L.calibrated(docs.where(~held), names, known, "doc_id")
    found = L.guessed(docs.where(held), names, known, "doc_id", margin=margin).join(docs.select("doc_id", "lang"), "doc_id")
    r = found.agg(F.count("*").alias("n"), F.count("guess").alias("said"), F.count(F.when(F.col("guess") == F.col("lang"), 1)).alias("right")).first()
    known.unpersist()
    print(r)
    assert r["right"] / r["said"] >= 0.98
    assert r["said"] / r["n"] >= 0.95
