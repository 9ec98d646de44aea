import csv
import io
import json
import random
import zipfile

import pytest

from paperloom.sources import files, paged, snapshots


def test_snapshots(spark, tmp_path, rows):
    root = f"file://{tmp_path}/lake"
    assert snapshots.latest_version(spark, root, "raw", "works") is None
    assert snapshots.latest(spark, root, "raw", "works", "id string").count() == 0
    with pytest.raises(FileNotFoundError):
        snapshots.latest(spark, root, "raw", "works")
    old = spark.createDataFrame([("a",)], "id string")
    new = spark.createDataFrame([("b",), ("c",)], "id string")
    snapshots.write(old, root, "raw", "works", "2026-01-02")
    path = snapshots.write(new, root, "raw", "works", "2026-02-01")
    assert snapshots.latest_version(spark, root, "raw", "works") == "2026-02-01"
    assert rows(snapshots.latest(spark, root, "raw", "works")) == [("b",), ("c",)]
    assert snapshots.complete(spark, path)
    snapshots.write(old, root, "raw", "works", "2026-02-01")  # complete already: stays
    assert snapshots.latest(spark, root, "raw", "works").count() == 2
    snapshots.write(old, root, "raw", "works", "2026-02-01", again=True)
    assert snapshots.latest(spark, root, "raw", "works").count() == 1
    assert not [p for p in snapshots.listed(spark, f"{root}/raw/works/*") if "staging" in p]
    assert snapshots.every_version(spark, root, "raw", "works").select("version").distinct().count() == 2
    assert snapshots.register(spark, root, "raw", {"links": None, "excluded": "doc_id string"}, ["works"]) == ["works", "excluded"]
    assert snapshots.table_stats(spark, ["works"]).first()["n_rows"] == 1
    assert snapshots.delete(spark, path)
    assert not snapshots.delete(spark, path)


def test_commits(spark, tmp_path, rows):
    root = f"file://{tmp_path}/lake"
    place = (spark, root, "raw", "works")
    rowed = lambda *names: spark.createDataFrame([(n,) for n in names], "id string")
    first = snapshots.write(rowed("a", "b"), root, "raw", "works", "2026-01-02")
    before = snapshots.latest(*place)
    # a writer that died: data without a commit, and data without an end
    rowed("x").write.parquet(snapshots.snapshot_path(root, "raw", "works", "2026-01-02", "dead"))
    rowed("y").write.parquet(snapshots.snapshot_path(root, "raw", "works", "2026-09-09", "dead"))
    assert snapshots.committed(*place) == {"2026-01-02": first}
    with pytest.raises(FileNotFoundError):
        snapshots.commit(*place, "2026-01-02", "nothing")
    second = snapshots.write(rowed("c"), root, "raw", "works", "2026-01-02", again=True)
    # who began before the rewrite still has a whole version, who begins now has the new one
    assert rows(before) == [("a",), ("b",)]
    assert rows(snapshots.latest(*place)) == [("c",)]
    assert snapshots.committed(*place) == {"2026-01-02": second}
    # two writers of one version at once: both numbered alike, one stands, and all readers agree
    for token in ("aa", "zz"):
        rowed(token).write.parquet(snapshots.snapshot_path(root, "raw", "works", "2026-03-01", token))
    (tmp_path / "lake/raw/works/_commits/v2026-03-01~000001~aa").touch()
    (tmp_path / "lake/raw/works/_commits/v2026-03-01~000001~zz").touch()
    assert rows(snapshots.latest(*place)) == [("zz",)]
    # folders of other writers count if they are whole
    rowed("other").write.parquet(snapshots.snapshot_path(root, "raw", "works", "2026-04-01"))
    (tmp_path / "lake/raw/works/v2026-05-01").mkdir()
    assert snapshots.latest_version(*place) == "2026-04-01"
    assert sorted(snapshots.every_version(*place).select("id", "version").collect()) == [("c", "2026-01-02"), ("other", "2026-04-01"), ("zz", "2026-03-01")]
    assert len(snapshots.clean(*place)) == 5
    assert not snapshots.exists(spark, first)
    assert rows(snapshots.every_version(*place), "id") == [("c",), ("other",), ("zz",)]
    assert snapshots.forget(*place, "2026-04-01")
    assert snapshots.forget(*place, "2026-03-01")
    assert not snapshots.forget(*place, "2026-03-01")
    assert snapshots.latest_version(*place) == "2026-01-02"
    assert not [x for p in snapshots.listed(spark, f"{root}/raw/works/*") for x in ("staging", "replaced") if x in p]


def test_tsv(spark, tmp_path):
    p = tmp_path / "t.tsv"
    p.write_text("patent_id\tn\nD123\t4\nRE12\tx\n")
    df = files.read_tsv(spark, str(p), ["patent_id"], {"n": "int"})
    assert [tuple(r) for r in df.collect()] == [("D123", 4), ("RE12", None)]
    with pytest.raises(ValueError, match="lacks"):
        files.read_tsv(spark, str(p), ["missing"])
    with zipfile.ZipFile(tmp_path / "u.tsv.zip", "w") as z:
        z.writestr("u.tsv", "a\n1\n")
    assert files.unpacked(str(tmp_path / "u.tsv"), str(tmp_path)).endswith("u.tsv")
    with pytest.raises(FileNotFoundError):
        files.unpacked(str(tmp_path / "v.tsv"), str(tmp_path))


def test_works(spark, tmp_path):
    work = {"id": "https://x/W1", "doi": None, "title": "T", "type": "article", "publication_date": "2020-01-01", "publication_year": 2020, "language": "en", "abstract_inverted_index": {"This": [0], "paper": [1]}, "primary_topic": {"id": "t", "display_name": "Topic"},
            "authorships": [{"institutions": [{"id": "I1", "ror": "r1", "display_name": "A"}]}, {"institutions": [{"id": "I2", "ror": None, "display_name": "B"}]}, {"institutions": []}]}
    bare = {"id": "https://x/W2", "title": "U", "authorships": None}
    p = tmp_path / "w.jsonl"
    p.write_text("\n".join(json.dumps(x) for x in (work, bare)))
    a, b = sorted(files.read_works(spark, str(p)).collect(), key=lambda r: r["openalex_id"])
    assert (a["abstract"], a["institution_ids"], a["institution_rors"], a["institution_display_names"]) == ("This paper", ["I1", "I2"], ["r1"], ["A", "B"])
    assert (b["abstract"], b["institution_ids"]) == ("", [])
    assert files.parse_works(spark.createDataFrame([(json.dumps(work),)], "value string")).first()["primary_topic_id"] == "t"
    c = tmp_path / "c.csv"
    c.write_text("a,b\n1,x\n")
    assert files.read_csv(spark, str(c)).dtypes == [("a", "string"), ("b", "string")]
    assert files.read_csv(spark, str(c), infer=True).dtypes[0] == ("a", "int")


def test_paged():
    pages = {"*": {"results": [{"id": 1}], "meta": {"next_cursor": "b"}}, "b": {"results": [], "meta": {"next_cursor": "c"}}}
    assert [w["id"] for w in paged.works(lambda u, p, h: (200, {}, pages[p["cursor"]]), "f", "m")] == [1]
    waits, tries = [], [429, 429, 200]
    assert paged.polite(lambda u, p, h: (tries.pop(0), {"Retry-After": "500"}, {"ok": 1}), "u", {}, sleep=waits.append) == {"ok": 1}
    assert waits == [120.0, 120.0]
    with pytest.raises(paged.SourceError):
        paged.polite(lambda u, p, h: (429, {}, {}), "u", {}, sleep=lambda s: None)
    assert paged.institutions(lambda u, p, h: (500, {}, {}), "ibm", "m") == []
    assert paged.institutions(lambda u, p, h: (200, {}, {"results": [{"id": "I", "display_name": None}]}), "ibm", "m") == [("I", "")]
    data = [{"k": i} for i in range(5)]
    serve = lambda u, p, h: (200, {}, {"records": [r for r in data if r["k"] > p.get("after", -1)][: p["size"]]})
    assert len(list(paged.keyset(serve, "u", {}, "k", "key", size=2))) == 5


#: What ten filters find; one answers "slow down" at first, one is empty.
FOUND = {f"f{i}": [{"id": f"https://x/W{i}{k:03d}", "title": f"T{k}"} for k in range(37 * i)] for i in range(10)}
asked_before: dict = {}


def works_api(url, params, headers):
    page = int(params["cursor"].strip("*") or 0)
    key = (params["filter"], page)
    asked_before[key] = asked_before.get(key, 0) + 1
    if params["filter"] == "f3" and asked_before[key] < 3:
        return 429, {"Retry-After": "7"}, {}
    own = FOUND[params["filter"]][page * 10 : page * 10 + 10]
    return 200, {}, {"results": own, "meta": {"next_cursor": str(page + 1)}}


def records_api(url, params, headers):
    assert headers == {"X-Api-Key": "secret"}
    own = [r for r in FOUND[params["q"]] if r["id"] > params.get("after", "")]
    return 200, {}, {"records": own[: params["size"]]}


def no_api(url, params, headers):
    return 429, {"Retry-After": "1"}, {}


def key():
    return "secret"


def no_sleep(seconds):
    assert seconds <= 120


@pytest.fixture
def importable(monkeypatch, spark):
    """Tasks import this file's functions by name."""
    import sys

    monkeypatch.setitem(sys.modules, "test_sources", sys.modules[__name__])
    spark.sparkContext.addPyFile(__file__)
    return "test_sources"


def test_pages_as_tables(spark, importable):
    slices = list(FOUND)
    df = paged.read_pages(spark, paged.WorksSource, slices, get=f"{importable}:works_api", mailto="m", sleep=f"{importable}:no_sleep")
    assert df.rdd.getNumPartitions() == 10
    asked_before.clear()
    plain = sorted(json.dumps(w) for f in slices for w in paged.works(works_api, f, "m", sleep=no_sleep))
    got = df.collect()
    assert sorted(r["value"] for r in got) == plain
    assert {r["slice"] for r in got} == set(range(1, 10))
    assert files.parse_works(df).where("openalex_id = 'https://x/W1000' and title = 'T0'").count() == 1
    queries = [{"q": f} for f in slices]
    df = paged.read_pages(spark, paged.KeysetSource, queries, get=f"{importable}:records_api", url="u", key="id", apikey=f"{importable}:key", size="25")
    assert df.rdd.getNumPartitions() == 10
    assert sorted(r["value"] for r in df.collect()) == plain
    with pytest.raises(Exception, match="slow down"):
        paged.read_pages(spark, paged.WorksSource, ["f1"], get=f"{importable}:no_api", mailto="m", sleep=f"{importable}:no_sleep").collect()


def tsv(rows):
    out = io.StringIO()
    csv.writer(out, delimiter="\t").writerows(rows)
    return out.getvalue()


def test_zipped(spark, tmp_path):
    r = random.Random(1)
    body = [[f"D{i}", r.choice(["plain", "two\nlines", 'a "quoted" word', "tab\there", "é", ""]), str(i) if i % 7 else "x"] for i in range(2500)]
    with zipfile.ZipFile(tmp_path / "a.tsv.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("one.tsv", tsv([["patent_id", "title", "n"], *body[:1000]]))
        z.writestr("two.tsv", "\ufeff" + tsv([["n", "patent_id", "title"], *[[n, p, t] for p, t, n in body[1000:]]]))
    uri = f"file://{tmp_path}/a.tsv.zip"
    df = files.read_zipped(spark, [uri], ["patent_id"], {"n": "int"}, rows=300)
    assert df.rdd.getNumPartitions() == 2
    assert df.dtypes == [("patent_id", "string"), ("title", "string"), ("n", "int")]
    wanted = sorted((p, t or "", int(n) if n != "x" else -1) for p, t, n in body)
    assert sorted((x["patent_id"], x["title"] or "", -1 if x["n"] is None else x["n"]) for x in df.collect()) == wanted
    assert files.read_zipped(spark, [uri, uri], ["patent_id"]).count() == 5000
    assert not [p for p in tmp_path.iterdir() if p.suffix != ".zip"]
    with pytest.raises(ValueError, match="lacks"):
        files.read_zipped(spark, [uri], ["missing"])
    with zipfile.ZipFile(tmp_path / "b.zip", "w") as z:
        z.writestr("one.tsv", "a\tb\n1\t2\n")
        z.writestr("two.tsv", "a\n1\n")
    with pytest.raises(Exception, match="lacks columns"):
        files.read_zipped(spark, [f"file://{tmp_path}/b.zip"], ["a"]).collect()
