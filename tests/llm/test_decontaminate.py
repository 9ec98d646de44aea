import hashlib
import random
import re

import duckdb
import pandas as pd
import pytest

from paperloom.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string, at int, gram string, items string"


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, items, window=10):
    grams = {}
    for i, t in items:
        w = words(t)
        k = min(window, len(w))
        for at in range(len(w) - k + 1) if w else ():
            grams.setdefault(tuple(w[at : at + k]), set()).add("" if i is None else str(i))
    lengths = {len(g) for g in grams}
    out = []
    for i, t in rows:
        w = words(t)
        inside, own = set(), set()
        for k in lengths:
            for at in range(len(w) - k + 1):
                if (g := tuple(w[at : at + k])) in grams:
                    inside |= set(range(at, at + k))
                    own |= grams[g]
        out.append((i, len(w), len(inside), tuple(sorted(own))))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def case():
    r = random.Random(5)
    vocabulary = [f"w{i}" for i in range(9)] + ["É", "Zoë", "X9"]
    text = lambda n: "".join(x + r.choice([" ", ", ", "\n", "--", "\x00"]) for x in r.choices(vocabulary, k=n))
    items = [(i, text(n)) for i, n in enumerate([30, 12, 10, 9, 4, 3, 3, 25, 40])] + [(9, None), (10, " ,. "), (None, text(11)), (2, text(14)), (77, text(1) + "solo")]
    rows = [(i, text(r.randrange(0, 60)) + r.choice(items)[1] * r.randrange(2) if r.random() < 0.7 else text(20)) for i, items in ((k, [(0, x[1] or "") for x in items]) for k in range(60))]
    rows += [(None, items[0][1]), (None, items[0][1]), (3, rows[3][1]), (3, "other"), (100, None), (101, ""), (102, items[0][1].upper()), (103, "solo " * 3)]
    return rows, items


def scanned(spark, docs, rows, items, **options):
    return D.scan(docs(rows), spark.createDataFrame([(i, t, 1, "g", "i") for i, t in items], ITEMS), **options)


@pytest.mark.parametrize("block", [4096, 7, 1])
def test_against_plain_search(spark, docs, case, block):
    got = [(r["id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in scanned(spark, docs, *case, block=block).collect() for _ in range(r["rows"])]
    assert sorted(got, key=str) == brute(*case)


def test_shuffled_when_the_set_is_large(spark, docs, case, monkeypatch):
    monkeypatch.setattr(D, "BROADCAST_BYTES", 0)
    got = [(r["id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in scanned(spark, docs, *case).collect() for _ in range(r["rows"])]
    assert sorted(got, key=str) == brute(*case)


def test_query_and_sql(spark, docs, case, tmp_path):
    rows, items = case
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, t, 1, "g", "i") for i, t in items], ITEMS).write.parquet(f"{tmp_path}/benchmark.parquet")
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    got = sorted((tuple(r) for r in D.op12_decontaminate(spark, str(tmp_path)).select(*names).collect()), key=str)
    plain = [(i, n, h, len(o), hashlib.sha256(",".join(o).encode()).hexdigest(), h > 0) for i, n, h, o in brute(*case)]
    assert got == sorted(plain, key=str)
    con = duckdb.connect()
    con.register("documents", pd.DataFrame({"doc_id": pd.array([r[0] for r in rows], "Int64"), "text": [r[1] for r in rows]}))
    con.register("benchmark", pd.DataFrame({"item_id": pd.array([r[0] for r in items], "Int64"), "text": [r[1] for r in items]}))
    assert sorted(con.execute(f"select {', '.join(names)} from ({D.ORACLE_SQL})").fetchall(), key=str) == got


def test_removal(spark, docs, case):
    rows, items = case
    bench = spark.createDataFrame([(i, t, 1, "g", "i") for i, t in items], ITEMS)
    table = docs(rows)
    dirty = {(i, n, o) for i, n, h, o in brute(*case) if h}
    kept = D.without_documents(table, bench)
    assert kept.columns == table.columns
    assert kept.count() == len(rows) - sum(h > 0 for _, _, h, _ in brute(*case))
    assert dirty
    cut = D.without_spans(table, bench)
    assert cut.columns == table.columns
    left = sorted(((r["doc_id"], len(words(r["text"]))) for r in cut.collect()), key=str)
    assert left == sorted(((i, n - h) for i, n, h, _ in brute(*case)), key=str)
    passage = "one two three four five six seven eight nine ten eleven"
    bench = spark.createDataFrame([(1, passage, 1, "g", "i")], ITEMS)
    texts = [f"Before it. {passage.title()}; after it!\n", passage, f"{passage} x {passage}", "Nothing here.\tAt all "]
    got = {r["doc_id"]: r["text"] for r in D.without_spans(docs(list(enumerate(texts))), bench).collect()}
    assert got == {0: "Before it; after it!\n", 1: "", 2: " x", 3: texts[3]}
    assert D.without_documents(docs(list(enumerate(texts))), bench, share=0.8).count() == 2


def test_odd_tables(spark, docs, prose):
    none = spark.createDataFrame([], ITEMS)
    assert D.scan(docs([]), none).count() == 0
    assert [(r["n_words"], r["n_hit"], r["items"]) for r in D.scan(docs([(1, "a b"), (2, None)]), none).orderBy("id").collect()] == [(2, 0, []), (0, 0, [])]
    passage = prose(1, 15)
    bench = spark.createDataFrame([(1, passage, 1, "g", "i"), (2, passage, 1, "g", "i")], ITEMS)
    long = f"{prose(2, 30_000)} {passage} {prose(3, 30_000)}"
    got = D.scan(docs([(1, long), *[(7, passage)] * 50]), bench).orderBy("id").collect()
    assert [(r["rows"], r["n_words"], r["n_hit"], r["items"]) for r in got] == [(1, 60_015, 15, ["1", "2"]), (50, 15, 15, ["1", "2"])]


def test_no_python_and_a_broadcast(spark, docs, case):
    plan = scanned(spark, docs, *case)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert not re.search("Python|Pandas|Arrow", plan)
