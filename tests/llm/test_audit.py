import itertools
import random
import re

import duckdb
import pandas as pd
import pytest

from paperloom.llm import audit as A

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LABELS = "doc_id long, quality int, toxic int, score double"


def fails(rows):
    """rows: (doc_id, text, lang); the letters that each fails."""
    out = []
    for i, t, _ in rows:
        t = t or ""
        w = WORD.findall(t)
        f = {"A"} if len(w) < 100 else set()
        f |= {"B"} if 100 * len(set(w)) < 80 * len(w) else set()
        f |= {"C"} if 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t) else set()
        f |= {"D"} if set(t) & set("#$%&*|") else set()
        f |= {"E"} if i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in rows) else set()
        out.append(f)
    return out


def brute(rows, good, toxic):
    """Every order applied to the rows themselves."""
    found, out, totals = fails(rows), {}, {}
    for part in {r[2] or "" for r in rows}:
        own = [(f, r[0] in good, r[0] in toxic) for f, r in zip(found, rows, strict=True) if (r[2] or "") == part]
        for order in itertools.permutations("ABCDE"):
            left, gone = own, []
            for step, f in enumerate(order, 1):
                removed = [x for x in left if f in x[0]]
                left = [x for x in left if f not in x[0]]
                out[part, "".join(order), step] = [len(left), len(removed), sum(f in x[0] for x in gone), sum(x[0] == {f} for x in own), sum(x[1] for x in removed), sum(x[2] for x in removed)]
                totals[part, f] = totals.get((part, f), 0) + len(removed)
                gone = gone + removed
    return {k: (*v, totals[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def some(seed, n):
    r = random.Random(seed)
    pool = [None, "", " \n", "A B C #", "word " * 120, " ".join(f"w{i}" for i in range(120)), " ".join(f"W{i}X" for i in range(110)) + " $", " ".join(f"w{i % 70}" for i in range(100)), "é" * 10, "same text"]
    return [(r.choice([None, *range(1, n)]), r.choice(pool), r.choice(["en", "de", None, ""])) for _ in range(n)]


@pytest.fixture(scope="module")
def case():
    return some(3, 60), {2, 5, 8, 13, 21}, {3, 5, 34}


def found(spark, docs, rows, good, toxic):
    labels = [(i, int(i in good), int(i in toxic), 0.1) for i in good | toxic] + [(i, None, None, 0.2) for i in good | toxic] + [(None, 1, 1, 0.3)]
    return A.audit(A.masked(docs([(i, t, p, "s") for i, t, p in rows]), spark.createDataFrame(labels, LABELS)))


def test_against_all_orders_applied_to_rows(spark, docs, case):
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r[f] for f in A.FIGURES) for r in found(spark, docs, *case).collect()}
    assert got == brute(*case)


def test_sql(spark, docs, case):
    rows, good, toxic = case
    con = duckdb.connect()
    con.register("documents", pd.DataFrame({"doc_id": pd.array([r[0] for r in rows], "Int64"), "text": [r[1] for r in rows], "lang": [r[2] for r in rows]}))
    con.register("labels", pd.DataFrame([(i, int(i in good), int(i in toxic)) for i in good | toxic], columns=["doc_id", "quality", "toxic"]))
    names = ["part", "filter_order", "step", *A.FIGURES]
    sql = sorted(con.execute(f"select {', '.join(names)} from ({A.ORACLE_SQL})").fetchall())
    assert sql == sorted(tuple(r[n] for n in names) for r in found(spark, docs, *case).collect())


def test_each_order_is_one_swap_from_the_last(monkeypatch):
    made = []
    step = A.Cells.step
    monkeypatch.setattr(A.Cells, "step", lambda self, before, bit: made.append(bit) or step(self, before, bit))
    import numpy as np

    rows = A.walk("ABCDE", [0, 3, 31], np.ones((3, 3), dtype=np.int64))
    orders = list(dict.fromkeys(r[0] for r in rows))
    assert len(orders) == len(set(orders)) == 120
    assert len(made) == 5 + 119 * 2
    for a, b in itertools.pairwise(orders):
        at = [i for i in range(5) if a[i] != b[i]]
        assert len(at) == 2 and at[1] == at[0] + 1 and a[at[0]] == b[at[1]]


def test_odd_rows(spark, docs):
    one = lambda rows: {(r["part"], r["step"]): r["removed"] for r in found(spark, docs, rows, set(), set()).where("filter_order = 'EABCD'").collect()}
    assert A.audit(A.masked(docs([]), spark.createDataFrame([], LABELS))).count() == 0
    # a null text is an empty one; a missing id is no copy and makes none; the same id twice is no copy of itself
    assert one([(1, None, "x"), (2, "", "x"), (None, "", "x")])["x", 1] == 1
    assert one([(None, "t", "x"), (None, "t", "x"), (5, "t", "y"), (5, "t", "y")]) == {(p, s): 2 * (s == 2) for p in "xy" for s in range(1, 6)}
    # copies meet across parts, in a group that holds most rows
    many = [(i, "copy", "en") for i in range(1, 400)] + [(0, "copy", "fr")]
    assert (one(many)["en", 1], one(many)["fr", 1]) == (399, 0)
    long = " ".join(f"w{i}" for i in range(200_000))
    assert one([(1, long, "x")]) == {("x", s): 0 for s in range(1, 6)}
