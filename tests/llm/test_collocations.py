import random
import re
from collections import Counter

import duckdb
import pandas as pd
import pytest

from paperloom.llm import collocations as C


def brute(rows, least, best, longest=5):
    """rows: (text, lang)."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und" if lang is None else lang] += len(w)
            for size in range(1, longest + 1):
                f.update((lang or "und" if lang is None else lang, tuple(w[i : i + size])) for i in range(len(w) - size + 1))
    out = []
    several = {k: a for k, a in f.items() if a >= least and len(k[1]) > 1}
    for (lang, w), a in several.items():
        if any(g == lang and len(v) > len(w) and 100 * b >= 100 * a and any(v[i : i + len(w)] == w for i in range(len(v))) for (g, v), b in several.items()):
            continue
        score, k = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
        out.append((lang, " ".join(w), a, f[lang, w[:k]], f[lang, w[k:]], n[lang], score))
    ranked = []
    for lang in {r[0] for r in out}:
        own = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:best]
        ranked += [(r[0], i, *r[1:]) for i, r in enumerate(own, 1)]
    return sorted(ranked)


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def found(docs, rows, **options):
    table = docs([(i, t, p, "s") for i, (t, p) in enumerate(rows)])
    return sorted(tuple(r[c] for c in COLUMNS) for r in C.collocations(table, **options).collect())


@pytest.fixture(scope="module")
def rows():
    r = random.Random(11)
    vocabulary = ["the", "of", "a", "b\x00", "b", "b\x01", "\x01\x01", "é", "日本", "x-y", "New", "york", "%", "a'b", "_"]
    piece = lambda: r.choice([" ", "\t", "  "]).join(r.choices(vocabulary, weights=[30, 20, *[3] * 13], k=r.randrange(0, 12)))
    texts = ["".join(piece() + r.choice([".", ", ", "\n", "?!", " new york city ", "\x0b", "; the of the "]) for _ in range(r.randrange(1, 15))) for _ in range(120)]
    return [(t, r.choice(["en", "en", "en", None, "und", "", "d\x00"])) for t in texts] + [(None, "en"), ("", None), (" . \t", "fr")]


@pytest.mark.parametrize(("least", "best", "parts"), [(3, 2000, 7), (8, 5, 1), (2, 40, 64)])
def test_against_plain_counts(docs, rows, least, best, parts):
    assert found(docs, rows, least=least, best=best, parts=parts) == brute(rows, least, best)


def joined(keys):
    """Suffixes as escaped words with NUL between them."""
    known, index, sizes = C.apart(keys) if len(keys) else ([], [], [])
    words = iter([known[int(i)].as_py().removeprefix(b"\xff") for i in index])
    return [b"\0".join(next(words) for _ in range(n)) for n in sizes]


def test_small_chunks(docs, rows, monkeypatch):
    plain = Counter()
    for t, _ in rows:
        for piece in C.normal(t).split(b"\n"):
            w = [x for x in piece.split(b" ") if x]
            plain.update(b"\0".join([b"en", *w[i : i + 5]]) for i in range(len(w)))
    for chunk in (1, 7, 50, 1 << 20):
        monkeypatch.setattr(C, "CHUNK", chunk)
        batch = C.pa.RecordBatch.from_arrays([C.pa.array(["en"] * len(rows)), C.pa.array([t for t, _ in rows])], names=["lang", "text"])
        sums = Counter()
        for one in C.chunks(iter([batch]), 5):
            keys, n = C.suffixes(*one, b"\xff" * 64, {}, 5)
            assert keys.to_pylist() == sorted(set(keys.to_pylist()))
            sums.update(dict(zip(joined(keys), n.tolist(), strict=True)))
        assert sums == plain


def test_hot_first_word_spans_tasks(spark, docs):
    r = random.Random(2)
    texts = [(" the ".join(r.choice("abcdefghij") * r.randrange(1, 4) for _ in range(80)), "en") for _ in range(60)]
    table = docs([(i, t, p, "s") for i, (t, p) in enumerate(texts)])
    words = C.materialise(C.word_counts(table, 5))
    sent = spark.sparkContext.broadcast
    codes = C._codes(words)
    bounds = C._bounds(C._read(table, "text", "lang"), sent(C._marks(words, 5)), sent(codes), 5, 16, 9000)
    assert len([b for b in bounds if b.startswith(C.shortened(b"en") + C.shortened(b"the", codes))]) >= 3
    assert found(docs, texts, least=5, parts=16) == brute(texts, 5, 2000)


@pytest.mark.parametrize("together", [1, 2, 3, 100])
@pytest.mark.parametrize("reverse", [False, True])
def test_stack_counts_prefixes(together, reverse):
    r = random.Random(9)
    codes = {b"a": b"\x01\x02", b"b": b"\x61\x62"}
    lists = {(b"l", *r.choices([b"a", b"b", b"c", b"ab"], k=r.randrange(1, 6))): r.randrange(1, 9) for _ in range(80)}
    plain = Counter()
    for w, n in lists.items():
        plain.update({w[:i]: n for i in range(1, len(w) + 1)})
    coded = {b"".join(C.shortened(x, codes) for x in w): w for w in lists}
    rows = {k: lists[w] for k, w in coded.items()}
    keys = sorted(rows, reverse=reverse)
    back = {v: k for k, v in codes.items()}
    for least in (1, 20, 10**9):
        stack, out = C.Prefixes(least), []
        for at in range(0, len(keys), together):
            some = keys[at : at + together]
            out += stack.add(C.pa.array(some, C.pa.binary()), C.np.array([rows[k] for k in some]))
        out += stack.rest()
        got = {tuple(C.restored(x, back) for x in w): n for w, n in out}
        assert len(got) == len(out)
        # prefixes of the first and last suffix are given out below the threshold, others are not
        ends = [coded[keys[0]], coded[keys[-1]]]
        edges = {w[:i] for w in ends for i in range(1, len(w) + 1)}
        assert got == {k: n for k, n in plain.items() if n >= least or k in edges}


def test_rare_words_end_suffixes(spark, docs):
    table = docs([(1, "a b c rare a b c", "en", "s"), (2, "a b c", "en", "s")])
    words = C.materialise(C.word_counts(table, 2))
    assert {(r["word"].decode(), r["n"]) for r in words.collect()} == {("a", 3), ("b", 3), ("c", 3), ("", 10)}
    data = C.normal("a b c rare a b c")
    keys, n = C.suffixes(b"en", data, len(data), C._marks(words, 2), {}, 5)
    assert dict(zip(joined(keys), n.tolist(), strict=True)) == {b"en\0a\0b\0c": 2, b"en\0b\0c": 2, b"en\0c": 2}


def test_codes(spark):
    words = spark.createDataFrame([(b"x", f"word{i}".encode(), 1000 - i) for i in range(300)] + [(b"x", b"ab", 9000), (b"x", b"", 99999)], "lang binary, word binary, n long")
    codes = C._codes(words, 100)
    assert 50 < len(codes) <= 100
    assert len(set(codes.values())) == len(codes)
    back = {v: k for k, v in codes.items()}
    for w in (b"word3", b"word299", b"ab", "é".encode(), b"a", b"\x01\x01", b"\x01\x02b", b"long-word"):
        known, _, sizes = C.apart(C.pa.array([C.shortened(b"x") + C.shortened(w, codes) + C.shortened(w, codes)], C.pa.binary()))
        assert sizes.tolist() == [3]
        assert {C.restored(k.as_py(), back) for k in known} == {b"x", C.plain(w)}


def test_exact_products(spark):
    big = 4_000_000_000_000
    counts = spark.createDataFrame([("x", "a", 1, big), ("x", "b", 1, big - 1), ("x", "a b", 2, big - 7)], "lang string, phrase string, size int, f long")
    totals = spark.createDataFrame([("x", 90_000_000_000_001)], "lang string, n long")
    r = C.scored(counts, totals).first()
    assert r["score"] == 1000 * (big - 7) * 90_000_000_000_001 // (big * (big - 1))


def test_sql(docs, rows):
    plain = [(t, p) for t, p in rows for _ in range(30) if "\x00" not in f"{t}{p}"]
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(plain, columns=["text", "lang"]))
    sql = sorted(con.execute(f"select {', '.join(COLUMNS)} from ({C.ORACLE_SQL})").fetchall())
    assert sql
    assert found(docs, plain) == sql


def test_odd_tables(docs):
    assert found(docs, []) == []
    assert found(docs, [(None, None), ("", "x")], least=1) == []
    long = ("a b " * 60_000, "x")
    assert found(docs, [long], least=100, best=1) == brute([long], 100, 1)
