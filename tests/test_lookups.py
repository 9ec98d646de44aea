"""Bitmaps, substring index, token counts and the build with state, each against a plain version."""

import random
import re
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from paperloom.functions import pieces
from paperloom.operators import distinct, substrings
from paperloom.plans import build

DATA = Path("/root/testdata/sf0.001")


def test_bitmaps_equal_count_distinct(spark):
    r = random.Random(3)
    rows = [(r.choice(["euv", "lasers", None]), f"c_{r.randrange(6)}", f"20{r.randrange(10, 20)}-01-01", r.choice([None, *[f"p{i}" for i in range(70_000, 70_400)]]), r.choice([None, "o1", "o2", "o3"])) for _ in range(3000)]
    filings = spark.createDataFrame(rows, "family_id string, cluster_id string, filing_date string, patent_id string, org_id string").withColumn("filing_date", F.to_date("filing_date"))
    papers = filings.select("family_id", "cluster_id", F.col("filing_date").alias("publication_date"), F.concat(F.lit("w"), "patent_id").alias("work_id"), "org_id").where("family_id = 'euv'")
    maps = distinct.materialise(distinct.document_bitmaps(filings, papers))
    assert maps.where("kind = 'n_patents'").select("family_id", "cluster_id", "year").distinct().count() <= 3 * 6 * 10
    for _ in range(5):
        families, clusters = r.sample(["euv", "lasers", "unattributed"], 2), [f"c_{k}" for k in r.sample(range(6), r.randrange(1, 4))]
        got = {x["kind"]: x["n"] for x in distinct.counted(maps, F.col("family_id").isin(families) & F.col("cluster_id").isin(clusters)).collect()}
        own = [x for x in rows if (x[0] or "unattributed") in families and x[1] in clusters]
        both = [x for x in own if x[0] == "euv"]
        plain = {"n_patents": len({x[3] for x in own} - {None}), "n_assignees": len({x[4] for x in own} - {None}), "n_papers": len({x[3] for x in both} - {None}), "n_research_orgs": len({x[4] for x in both} - {None})}
        assert got == {k: n for k, n in plain.items() if n}
    years = {x["year"]: x["n"] for x in distinct.counted(maps, F.col("kind") == "n_patents", ["year"]).collect()}
    assert years == {y: len({x[3] for x in rows if x[2][:4] == str(y)} - {None}) for y in range(2010, 2020)}


def test_numbers_are_dense(spark):
    ids = spark.range(1000).select((F.col("id") % 700).alias("id")).unionByName(spark.createDataFrame([(None,)], "id long"))
    assert sorted(r["number"] for r in distinct.numbered(ids, "id", 7).collect()) == list(range(1, 701))


def test_search_equals_ilike(spark, tmp_path):
    r = random.Random(1)
    words = ["Lithography", "LASER", "laser diode", "ünïcode ÉTÉ", "50% off", "a_b", "x", "silicon photonics", "neuro", "back\\slash", "İstanbul", "straße"]
    rows = [(i, " ".join(r.choices(words, k=r.randrange(0, 5)))) for i in range(300)] + [(300, None), (None, "laser")]
    docs = spark.createDataFrame(rows, "id long, text string")
    path = f"{tmp_path}/index"
    substrings.build(docs, "id", "text", path, 16)
    for q in ("laser", "LaSeR d", "photon", "ser_dio", "la%phy", "été", "0% o", "a_b", "x", "", "%", "abcq", "ünï", "silicon photonics neuro", "straße", "istanbul", "İst"):
        got = sorted(x["id"] for x in substrings.search(spark, path, q, 16).collect())
        assert got == sorted(x["id"] for x in docs.where(F.col("id").isNotNull() & F.col("text").ilike(f"%{q}%")).collect()), q
    plan = substrings.search(spark, path, "laser", 16)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket[^\]]*IN", plan)


def slow_count(begins, goes_on, text):
    """Every word by trying all lengths from the longest."""
    n = 2
    for word in re.findall(r"\w+|[^\w\s]", (text or "").lower()):
        at = k = 0
        while at < len(word) <= pieces.LONGEST_WORD:
            end = next((e for e in range(len(word), at, -1) if word[at:e] in (goes_on if at else begins)), at)
            if end == at:
                break
            at, k = end, k + 1
        n += k if at == len(word) else 1
    return n


def test_token_counts(spark):
    begins, goes_on = pieces.read_vocabulary(["[UNK]", "un", "una", "##aff", "##able", "##a", "b", "##b", ",", "東"])
    c = pieces.Counter(begins, goes_on)
    assert [c.of_text(t) for t in ("unaffable", "unaable, B", None, "", "q", "b" * 99, "b" * 101, "東京")] == [3, 6, 2, 2, 3, 101, 3, 3]
    begins, goes_on = pieces.read_vocabulary(['{"model": {"vocab": {"th": 1, "the</w>": 2, "e": 3, "<|end|>": 4}}}'])
    assert (begins, goes_on) == (["e", "th", "the"],) * 2


@pytest.mark.skipif(not DATA.exists(), reason="no test tables")
def test_token_counts_of_documents(spark):
    public = pytest.importorskip("public_tokenizers")
    vocabulary = pieces.read_vocabulary(Path(public.path("word_bpe_49k.json")).read_text().split("\n"))
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    of = pieces.token_counts(spark, vocabulary)
    sets = [set(v) for v in vocabulary]
    for r in docs.select("text", of(F.col("text")).alias("n")).collect():
        assert r["n"] == slow_count(*sets, r["text"])


def doubled(a):
    return a.select((F.col("v") * 2).alias("v"))


def joined(a, b):
    return a.crossJoin(b.agg(F.count("*").alias("n")))


def test_build_with_state(spark, tmp_path):
    steps = {"twice": (("left",), doubled), "other": (("right",), doubled), "both": (("twice", "other"), joined), "alone": (("right",), lambda r: r.limit(1))}
    df = lambda *v: spark.createDataFrame([(x,) for x in v], "v int")
    sources = {"left": df(1, 2), "right": df(3)}
    state = build.State(f"file://{tmp_path}/state", steps)
    made = state.build(sources, {"left": "1", "right": "1"})
    assert sorted(state.ran) == ["alone", "both", "other", "twice"]
    assert sorted(tuple(r) for r in made["both"].collect()) == [(2, 1), (4, 1)]
    # a second build runs nothing
    state.build(sources, {"left": "1", "right": "1"})
    assert state.ran == []
    # a changed source runs its descendants alone
    made = state.build(sources | {"left": df(5)}, {"left": "2", "right": "1"})
    assert sorted(state.ran) == ["both", "twice"]
    assert [tuple(r) for r in made["both"].collect()] == [(10, 1)]
    # and so does changed code
    changed = build.State(state.root, steps | {"other": (("right",), lambda r: r.where("v > 100"))})
    changed.build(sources, {"left": "1", "right": "1"})
    assert sorted(changed.ran) == ["both", "other"]
    # what fails its checks stops what reads it
    strict = build.State(state.root, steps, {"twice": {"small": lambda d: d.where("v > 3")}})
    with pytest.raises(build.CheckFailed, match="twice"):
        strict.build(sources, {"left": "1", "right": "1"})
    assert "both" not in strict.ran
    with pytest.raises(build.CheckFailed):
        strict.build(sources, {"left": "1", "right": "1"})
    assert strict.ran == []


def test_grams_of_a_long_text(spark, tmp_path):
    """One pass over a text, however long; rows that share an id and letters beyond 16 bits are found."""
    r = random.Random(4)
    long = "".join(r.choices("abcdefgh 😀é", k=400_000)) + "zebra"
    docs = spark.createDataFrame([(1, long), (2, "A😀b"), (2, "zebra"), (3, "zeb"), (4, "ab"), (5, "")], "id long, text string")
    start = time.time()
    got = {(x["id"], x["gram"]) for x in substrings.gram_rows(docs).collect()}
    substrings.build(docs, "id", "text", f"{tmp_path}/index", 4)
    assert sorted(x["id"] for x in substrings.search(spark, f"{tmp_path}/index", "zebra", 4).collect()) == [1, 2]
    assert [x["id"] for x in substrings.search(spark, f"{tmp_path}/index", "a😀B", 4).where("id = 2").collect()] == [2]
    assert time.time() - start < 60  # minutes where each gram reads the text anew
    plain = lambda t: {t[i : i + 3] for i in range(len(t) - 2)}
    assert got == {(1, g) for g in plain(long)} | {(2, g) for t in ("a😀b", "zebra") for g in plain(t)} | {(3, "zeb")}
