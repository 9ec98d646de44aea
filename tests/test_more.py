"""Labels, display, detector, encoder path, warehouse targets, landed records and remembered answers."""

import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperloom import session
from paperloom.functions import text as X
from paperloom.functions.udfs import guess_language
from paperloom.operators import clusters as C
from paperloom.operators import relational as R
from paperloom.plans import feasibility, serving
from paperloom.sources import paged, snapshots


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_prompt_names_the_cluster_and_is_short(spark):
    terms, titles = F.array(*[F.lit(f"t{i}") for i in range(30)]), F.array(*[F.lit(f"title {i}") for i in range(9)])
    said = value(spark, C.prompt(F.lit("c_7"), terms, titles))
    assert "c_7" in said
    assert "t14" in said and "t15" not in said
    assert "- title 4" in said and "title 5" not in said


@pytest.mark.parametrize(
    ("answer", "expected"),
    [
        (json.dumps({"tagline": " Chips ", "summary_friendly": "About chips."}), ("Chips", "About chips.")),
        ('```json\n{"tagline": "A", "summary_friendly": "B"}\n```', ("A", "B")),
        ("no json", None), ('{"tagline": "only"}', None), ('{"tagline": "", "summary_friendly": "x"}', None), ("", None), (None, None),
    ],
)
def test_parsed_label(spark, answer, expected):
    got = value(spark, C.parsed_label(F.lit(answer).cast("string"), F.lit("c_9")))
    assert tuple(got) == (expected or ("Technology Cluster c_9", "A technology cluster identified from microchip hardware patent and paper data. Cluster identifier: c_9."))


@pytest.mark.parametrize(
    ("text", "limit", "expected"),
    [("short", 10, ("short", False)), ("exactly ten", 11, ("exactly ten", False)), ("one two three", 7, ("one two", True)), ("one two three", 9, ("one two", True)), ("unbroken", 4, ("unbr", True)), ("a  b", 3, ("a", True)), ("", 3, ("", False))],
)
def test_cut_at_word(spark, text, limit, expected):
    assert tuple(value(spark, X.cut_at_word(F.lit(text), limit))) == expected


def test_days_and_colours(spark):
    day = F.lit("2020-01-01").cast("date")
    for years in (0.0, 2.5, -0.25, 1.999):
        assert value(spark, X.day_after(day, F.lit(years))) == dt.date(2020, 1, 1) + dt.timedelta(days=years * 365.25)
    assert [value(spark, X.concentration_colour(F.lit(t))) for t in (-1.0, 0.0, 0.5, 1.0, 7.0)] == ["#22c55e", "#22c55e", "#888451", "#ef4444", "#ef4444"]
    assert [value(spark, X.trust_colour(F.lit(x))) for x in ("high", "medium", "low", "?")] == ["#22c55e", "#94a3b8", "#ef4444", "#94a3b8"]


def test_detector():
    said = {
        "en": "The efficient design of integrated photonic circuits remains an open problem in this area.", "fr": "La conception efficace des circuits photoniques intégrés reste un problème ouvert.", "de": "Der effiziente Entwurf integrierter Schaltungen bleibt ein offenes Problem.",
        "es": "El diseño eficiente de los circuitos integrados sigue siendo un problema abierto.", "it": "La progettazione efficiente dei circuiti integrati rimane un problema aperto.", "nl": "Het efficiënte ontwerp van geïntegreerde schakelingen blijft een open probleem.",
        "pt": "A concepção eficiente dos circuitos integrados continua a ser um problema em aberto.", "ca": "El disseny eficient dels circuits integrats és encara un problema obert per a tothom.",
    }
    assert {k: guess_language(t) for k, t in said.items()} == {k: k for k in said}
    assert guess_language("") is None and guess_language(None) is None and guess_language("12 34 !") is None


def test_encoder_is_loaded_once_a_task(spark):
    def load():
        import itertools

        calls = itertools.count()
        return lambda texts: np.array([[len(t), next(calls), len(texts)] for t in texts], dtype=np.float32)

    docs = spark.createDataFrame([(i, "x" * i) for i in range(10)], "doc_id long, text string").coalesce(1)
    found = sorted((r["doc_id"], *r["embedding"]) for r in C.encoded(docs, load, batch=4).collect())
    assert [f[1] for f in found] == list(range(10))
    assert sorted(f[2] for f in found) == list(range(10))  # one model counted all calls
    assert max(f[3] for f in found) == 4


def test_truncated_counts_tokens(spark):
    docs = spark.createDataFrame([(1, "word " * 254), (2, "word " * 255), (3, "internationalisation " * 64), (4, None)], "doc_id long, text string")
    assert [r["truncated"] for r in C.embedded(docs).orderBy("doc_id").collect()] == [False, True, True, False]


def test_signature(spark):
    ids = spark.createDataFrame([(str(i),) for i in range(500)], "i string")
    a = R.signature(ids, "i").first()[0]
    assert a == R.signature(ids.orderBy(F.rand()).repartition(7).union(ids.limit(3)), "i").first()[0]
    assert a != R.signature(ids.where("i <> '3'"), "i").first()[0]
    assert R.signature(ids.limit(0), "i").count() == 1


def test_abstract_positions(spark):
    made = lambda d: value(spark, X.abstract_of(F.from_json(F.lit(json.dumps(d)), "map<string,array<int>>")))
    assert made({"b": [1, 3], "a": [0]}) == "a b  b"
    assert made({"late": [2]}) == "  late"
    assert made({}) == ""
    assert value(spark, X.abstract_of(F.lit(None).cast("map<string,array<int>>"))) == ""


def test_warehouse(monkeypatch):
    targets = {"dev": "file:///tmp/dev/", "prod": "s3a://lake/prod"}
    monkeypatch.delenv("PAPERLOOM_TARGET", raising=False)
    assert session.warehouse(targets).path("marts", "gap") == "file:///tmp/dev/marts/gap"
    monkeypatch.setenv("PAPERLOOM_TARGET", "prod")
    w = session.warehouse(targets, credentials=lambda root: session.s3a_credentials("k", "s", "https://e", "lake"), read_only=True)
    assert w.path("x") == "s3a://lake/prod/x"
    assert w.settings["spark.hadoop.fs.s3a.bucket.lake.access.key"] == "k"
    with pytest.raises(PermissionError):
        w.path("x", writing=True)
    with pytest.raises(KeyError):
        session.warehouse(targets, "other")


def test_landed_records_and_counts(spark, tmp_path):
    df = paged.landed(spark, ({"id": i} for i in range(25)), f"file://{tmp_path}/r", "id long", at_once=10)
    assert sorted(r["id"] for r in df.collect()) == list(range(25))
    assert paged.landed(spark, [], f"file://{tmp_path}/r", "id long").count() == 0
    serve = lambda u, p, h: (200, {}, {"meta": {"count": 7}, "results": [{"id": "T1", "display_name": None, "works_count": 3}]})
    assert paged.count_works(serve, "f", "m") == 7
    assert paged.topics(serve, "optics", "m") == [("T1", "", 3)]
    assert snapshots.store_answers(spark, f"file://{tmp_path}")
    assert not snapshots.exists(spark, f"file://{tmp_path}/.round-trip")


def test_answers_are_remembered(spark):
    now, asked = [0.0], []

    def question(star, key):
        asked.append(key)
        return spark.range(2)

    a = serving.Answers(seconds=10, most=2, clock=lambda: now[0])
    assert len(a.ask(question, None, ["x"])) == len(a.ask(question, None, ["x"])) == 2
    assert len(asked) == 1
    now[0] = 11
    a.ask(question, None, ["x"])
    a.ask(question, None, "y")
    a.ask(question, None, "z")
    assert len(asked) == 4 and len(a.held) == 2
    assert len(serving.Answers(rows=2).ask(question, None, "x")) == 2
    with pytest.raises(serving.TooManyRows):
        serving.Answers(rows=1).ask(question, None, "x")


def test_too_thin(spark, rows):
    counts = spark.createDataFrame([("euv", 5, 9), ("lasers", 50, 0), ("in_memory", 50, 50)], "family_id string, n_patents long, n_links long")
    assert rows(feasibility.too_thin(counts, 10, 10)) == [("euv", "patents,links"), ("lasers", "links")]
