import re
from collections import Counter

import duckdb
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from paperloom.llm import quality as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    w = WORD.findall(text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {i + k for i in range(len(w) - 2) if n[tuple(w[i : i + 3])] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), sum(c in Q.SYMBOLS for c in text or ""), dup, len(covered)


FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
TEXTS = [None, "", " \t\n", "a", "a b c", "a b c a b c", "a a a a", "a a a", "x y z x y z x y", "one\ntwo\none\n\n\none", "# $ % # x", "\x0b\x0c \r é ü 東京 東京 東京 東京", "the cat and the dog " * 30, "\n".join(["same line here"] * 60), "w" * 70000 + " " + "ab " * 40000]


def test_counts(docs):
    found = Q.judged(docs(list(enumerate(TEXTS)))).orderBy("doc_id").collect()
    for r, t in zip(found, TEXTS, strict=True):
        n = brute(t)
        assert tuple(r[f] for f in FIELDS) == n
        assert r["base_failed"] == (n[0] < 50 or 100 * n[4] > 50 * n[0])
        assert not (r["base_failed"] and r["kept"])


def test_counts_of_any_text(docs):
    seen = []

    @settings(max_examples=120, deadline=None)
    @given(st.text(alphabet="ab #\n\té", max_size=40))
    def gather(t):
        seen.append(t)

    gather()
    for r, t in zip(Q.judged(docs(list(enumerate(seen)))).orderBy("doc_id").collect(), seen, strict=True):
        assert tuple(r[f] for f in FIELDS) == brute(t)


def test_verdicts(docs, prose):
    good = ("the house of the man is in the city and it was built for the people who live there " * 1 + prose(1, 60) + " and the end of it is near").replace("\n", " ")
    junk = " ".join(f"{w}$$$" for w in good.split())
    rows = Q.judged(docs([(1, good), (2, junk), (3, "foo bar baz qux quux corge grault garply waldo fred " * 1 + prose(2, 80)), (4, good[:60])])).orderBy("doc_id").collect()
    assert [r["kept"] for r in rows] == [True, False, False, False]
    assert (set(rows[1]["broken"]), rows[2]["broken"], rows[3]["broken"]) == ({"symbols", "few_stop_words"}, ["few_stop_words"], ["too_short"])
    own = Q.judged(docs([(1, good), (2, junk), (4, good[:60])]), rules=[("tiny", "mean_word", "max", 1.0)]).orderBy("doc_id").collect()
    assert [(r["base_failed"], r["kept"], r["broken"]) for r in own] == [(False, False, ["tiny"]), (False, False, ["tiny"]), (True, False, ["too_short", "tiny"])]


def test_sql(docs):
    rows = list(enumerate(TEXTS[:-1]))
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text"]))
    names = ("doc_id", *FIELDS, "base_failed", "kept")
    sql = sorted(con.execute(f"select {', '.join(names)} from ({Q.ORACLE_SQL})").fetchall())
    assert sql == sorted(tuple(r) for r in Q.judged(docs(rows)).select(*names).collect())


def test_no_user_functions(docs):
    plan = Q.judged(docs([(1, "x")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    assert "Exchange" not in plan
    assert Q.judged(docs([])).count() == 0
