from collections import defaultdict

import duckdb
import pandas as pd
import pytest

from paperloom.llm import mixing as M


def water(sizes, weights, share=1.5, epochs=2):
    """Targets by sharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    cap, fixed = {s: epochs * sizes[s] for s in names}, {}
    budget = share * sum(sizes.values())
    while True:
        left = [s for s in names if s not in fixed]
        if not left:
            return fixed
        rest = budget - sum(fixed.values())
        t = {s: rest * w[s] / sum(w[x] for x in left) for s in left}
        over = [s for s in left if t[s] > cap[s]]
        if not over:
            return fixed | t
        fixed |= {s: cap[s] for s in over}


ROWS = [(i, "w " * (1 + i * 7 % 23), None, f"s{i % 5}" if i % 11 else None) for i in range(200)] + [(500, None, None, "s0"), (501, "", None, "empty"), (3, "again and again", None, "s3"), (3, "again and again", None, "s3"), (None, "no id here", None, "s1"), (None, "nor here", None, "s1"), (700, "x " * 3000, None, "one")]


def test_targets_and_taken(docs):
    found = M.mix(docs(ROWS)).collect()
    assert len(found) == len(ROWS)
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in found:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 2 * r["size"]
        assert r["source_size"] == sum(len((x[1] or "").split()) for x in ROWS if x[3] == r["source"])
    expected = water(dict(sizes), M.WEIGHTS)
    for s in sizes:
        assert target[s] == pytest.approx(expected[s])
        assert abs(taken[s] - expected[s]) <= 3
    assert sum(taken.values()) == pytest.approx(1.5 * sum(sizes.values()), abs=12)


def test_repeats(docs):
    a, b = (sorted(map(str, M.mix(docs(ROWS)).collect())) for _ in range(2))
    assert a == b


def test_sql(docs):
    frame = pd.DataFrame([(r[0], r[1], r[3]) for r in ROWS], columns=["doc_id", "text", "source"]).astype({"doc_id": "Int64"})
    con = duckdb.connect()
    con.register("documents", frame)
    sql = con.execute(M.ORACLE_SQL).fetchall()
    own = M.mix(docs(ROWS)).select("doc_id", "size", "source_size", "target", "taken").collect()
    plain = lambda rows: sorted((str(a), b, c, round(d, 6), e) for a, b, c, d, e in rows)
    assert plain(sql) == plain(map(tuple, own))


def test_rows_of_the_mix(docs):
    d = docs(ROWS)
    plan = {(r["doc_id"], r["source"]): r["taken"] for r in M.mix(d).collect()}
    out = M.mixed_rows(d)
    assert out.columns == d.columns
    words = defaultdict(int)
    for r in out.collect():
        words[r["doc_id"], r["source"]] += len((r["text"] or "").split())
    for key, n in plan.items():
        if key[0] not in (3, None):
            assert words[key] == n


def test_empty(docs):
    assert M.mix(docs([])).count() == 0
    assert M.mixed_rows(docs([])).count() == 0
    assert [r["taken"] for r in M.mix(docs([(1, None), (2, "")])).collect()] == [0, 0]
    one = M.mix(docs([(1, "a b c", None, "s")])).first()
    assert (one["target"], one["taken"]) == (4.5, 5)
