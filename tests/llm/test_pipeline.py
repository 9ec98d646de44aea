from itertools import combinations

import corpus_pipeline as C
import pytest


def near_copies(rows):
    """Every pair compared by the stage's rule, five-word shingles at 0.8: doc_id to the smallest id it reaches."""
    shingles = {i: {tuple(t.lower().split()[k : k + 5]) for k in range(max(1, len(t.split()) - 4))} for i, t in rows}
    least = {i: i for i in shingles}
    links = [(a, b) for a, b in combinations(shingles, 2) if len(shingles[a] & shingles[b]) >= 0.8 * len(shingles[a] | shingles[b])]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            if least[a] != least[b]:
                least[a] = least[b] = min(least[a], least[b])
                changed = True
    return least


@pytest.fixture(scope="module")
def folder(spark, docs, prose, tmp_path_factory):
    d = tmp_path_factory.mktemp("sf")
    rows = [(i, f"the {prose(i, 80)} and of", "en", f"s{i % 4}") for i in range(150)]
    rows += [(200 + i, rows[i][1], "en", "s0") for i in range(20)]  # exact copies
    for i in range(30):  # near copies: the first ten within the rule
        w = rows[i][1].split()
        for k in range(1 if i < 10 else 12):
            w[7 + 6 * k] = f"changed{i}"
        rows.append((250 + i, " ".join(w), "en", "s1"))
    rows += [(300, "12 34", "en", "s1"), (301, None, None, None), (302, "", "en", "s2")]
    rows += [(400 + i, f"the {prose(900 + i, 40)} grobblehead snarkface wretchling", "en", "s3") for i in range(40)]
    docs(rows).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i >= 400)) for i in [*range(0, 150, 2), *range(400, 440)]], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return str(d)


def test_stages(spark, folder, tmp_path):
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    names, docs, kept = [n for n, _ in C.STAGES], documents, []
    assert len(names) == 5
    for at, (_, stage) in enumerate(C.STAGES):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{at}")
        docs = spark.read.parquet(f"{tmp_path}/{at}")
        kept.append(docs)
        assert docs.columns == documents.columns or at == 4
    ids = [{r["doc_id"] for r in k.select("doc_id").collect()} for k in kept]
    assert not [i for i in ids[0] if i >= 400]
    assert set(range(150)) <= ids[0]
    assert ids[1] == ids[0] - {300, 301, 302}
    rows = [(r["doc_id"], r["text"]) for r in kept[1].collect()]
    assert ids[2] == set(near_copies(rows).values())
    assert ids[2] & set(range(250, 280)) == set(range(260, 280))
    assert ids[3] <= ids[2]
    words = lambda df: sum(len(r["text"].split()) for r in df.collect())
    assert words(kept[3]) == pytest.approx(1.5 * words(kept[2]), rel=0.01)
    assert sum(r["start"] == 0 for r in kept[4].collect()) == kept[3].count()


def test_odd_tables(spark, folder, docs, prose, tmp_path):
    """Nulls, empty and very long texts, repeated rows, ties and columns with clashing names; then no rows at all."""
    base = spark.read.parquet(f"{folder}/documents.parquet").limit(60).collect()
    rows = [tuple(r)[:4] for r in base] + [(900, None, None, None), (901, "", "", ""), (None, base[0]["text"], None, "s1"), (None, None, None, None), (902, f"the {prose(5, 30_000)} and of", "en", None)]
    rows += [(903, f"the {prose(7777, 90)} and of", "en", "s2")] * 3
    labels = spark.read.parquet(f"{folder}/labels.parquet").union(spark.createDataFrame([(None, None, None), (903, 1, None)], "doc_id long, quality int, toxic int"))
    for case, frame in (("odd", docs(rows)), ("none", docs([]))):
        frame.write.parquet(f"{tmp_path}/{case}/documents.parquet")
        (labels if case == "odd" else labels.limit(0)).write.parquet(f"{tmp_path}/{case}/labels.parquet")
        now = frame
        for at, (_, stage) in enumerate(C.STAGES):
            stage(spark, now, f"{tmp_path}/{case}").write.parquet(f"{tmp_path}/{case}/{at}")
            now = spark.read.parquet(f"{tmp_path}/{case}/{at}")
            assert at == 4 or now.columns == frame.columns
            if at == 2 and case == "odd":
                kept = [r["doc_id"] for r in now.collect()]
                assert kept.count(903) == 1
                assert kept.count(902) == 1
                assert {r["doc_id"] for r in base} - {i for i in range(400, 440)} <= set(kept) | set(range(200, 300))
        assert (now.count() > 0) == (case == "odd")


def test_run(spark, folder):
    assert C.run(spark, folder).count() > 0
    assert C.ORACLE_SQL is None
