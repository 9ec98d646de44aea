import hashlib

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st

from paperloom.llm import chat as C

KIND = "conv_id long, turn long, role string, text string, example long, known string"
pieces = st.lists(st.sampled_from([*C.CONTROL, "\\", "a", "é", "\n", "<", "]", "s>", "/"]), max_size=8).map("".join)


@settings(max_examples=300, deadline=None)
@given(pieces)
def test_escape_round_trip(text):
    assert C.unescape(C.escape(text)) == text


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "</s>"]), pieces), max_size=6))
def test_examples_round_trip(turns):
    found = list(C.expand(1, turns))
    replies = [t for r, t in turns if r == "assistant"]
    assert [C.unescape(e.text[e.loss_start : e.loss_end]) for e in found if e.loss_end or e.loss_start] == replies
    if turns:
        assert C.read_back(found[-1].text) == turns
        assert [e.last for e in found] == [False] * (len(found) - 1) + [True]
    at = 0
    for i, (role, _) in enumerate(turns):
        if role == "assistant":
            assert C.read_back(found[at].text) == turns[: i + 1]  # all before as context, and no more
            at += 1


ROWS = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes </s>"), (1, 2, "user", "more"), (1, 3, "assistant", "ok \\[INST]"), (1, 4, "user", "bye"), (2, 0, "system", None), (3, 0, "assistant", ""), (4, None, None, "x"), (4, 0, "user", "b"), (4, 0, "user", "a"), (4, 0, "user", "a"), (5, 0, "user", "w " * 50000), (5, 1, "assistant", "r" * 100000)]


def by_hand(rows):
    turns = [(r or "", t or "") for _, _, r, t in sorted(rows, key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or ""))]
    said = "".join(t for r, t in turns if r == "assistant")
    upto, total = 0, 0
    for i, (r, t) in enumerate(turns):
        upto += len("<s>[ROLE][/ROLE]</s>") + len(C.escape(r)) + len(C.escape(t))
        total += upto if r == "assistant" or i == len(turns) - 1 else 0
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(said), sha(said), total


def test_digests(spark):
    df = spark.createDataFrame([(*r, 9, "k") for r in [*ROWS, (None, 0, "user", "lost"), (None, 1, "assistant", "found")]], KIND)
    found = {r["conv_id"]: tuple(r)[1:] for r in C.digests(df).collect()}
    assert set(found) == {1, 2, 3, 4, 5, None}
    for k in found:
        rows = [r for r in ROWS if r[0] == k] or [(None, 0, "user", "lost"), (None, 1, "assistant", "found")]
        assert found[k] == by_hand(rows)
    assert C.digests(df.limit(0)).count() == 0
    examples = C.formatted(df)
    assert sum(len(r["text"]) for r in examples.collect()) == sum(v[-1] for v in found.values())


def test_sql(spark):
    import pandas as pd

    df = spark.createDataFrame([(*r, 9, "k") for r in ROWS], KIND)
    con = duckdb.connect()
    con.register("conversations", pd.DataFrame(ROWS, columns=["conv_id", "turn", "role", "text"]).astype({"turn": "Int64"}))
    sql = {r[0]: tuple(r[1:]) for r in con.execute(C.ORACLE_SQL).fetchall()}
    assert sql.pop(-1)[0] == 2
    assert sql == {r["conv_id"]: tuple(r)[1:] for r in C.digests(df).collect()}
