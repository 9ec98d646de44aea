"""Toxicity and language on held-out rows and on odd ones."""

import math
import random
import re
import zlib

import numpy as np
import pytest

from paperloom.llm import language as L
from paperloom.llm import toxicity as T

#: Insults in many forms.
BAD = ["grobblehead", "snarkface", "wretchling"]


@pytest.fixture(scope="module")
def made(prose):
    r = random.Random(5)
    rows, labels = [], []
    for i in range(500):
        text, toxic = prose(i, 60), int(i % 5 == 0)
        if toxic:
            w = text.split()
            for _ in range(3):
                w.insert(r.randrange(len(w)), r.choice(BAD) + r.choice(["", "s", "ed"]))
            text = " ".join(w)
        rows.append((i, text))
        if i % 2 == 0:
            labels.append((i, 1, toxic))
    return rows, labels


LABELS = "doc_id long, quality int, toxic int"


def test_toxicity(spark, docs, made):
    rows, labels = made
    d = docs([*rows, (900, None), (901, ""), (None, "x"), (0, rows[0][1])])
    model = T.fit(d, spark.createDataFrame([*labels, (None, 1, 1), (5, None, None), (7777, 1, 1)], LABELS))
    found = T.scored(d, model).collect()
    assert len(found) == len(rows) + 4
    for r in found:
        if r["doc_id"] is not None:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1
        assert r["predicted"] == int(r["score"] >= 0.5)
    held = [r for r in found if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 500]
    assert np.mean([r["predicted"] == int(r["doc_id"] % 5 == 0) for r in held]) > 0.95
    assert next(r["predicted"] for r in found if r["doc_id"] == 900) == 0
    assert T.clean(d, model).columns == d.columns
    assert T.clean(d, model).count() == sum(1 - r["predicted"] for r in found)


def test_toxicity_learns_nothing_from_held_out_labels(spark, docs, made):
    rows, labels = made
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    a, b = (T.fit(docs(rows), spark.createDataFrame(x, LABELS)) for x in (labels, flipped))
    assert a.weights == b.weights
    assert a.bias == b.bias


def test_toxicity_without_positives_or_rows(spark, docs):
    none = spark.createDataFrame([], LABELS)
    assert [r["predicted"] for r in T.scored(docs([(1, "a")]), T.fit(docs([(1, "a")]), none)).collect()] == [0]
    assert T.scored(docs([]), T.fit(docs([]), none)).count() == 0


def test_non_negative_risk_steps_back():
    """Where the positives explain all unlabelled text the negative part would fall below zero: scores stay finite."""
    m = T.train(["grob a", "grob b", "grob c", "grob d"] * 3, ["grob a", "grob x"] * 5, 0.9)
    assert 0 < m.score("grob") <= 1


def slow_risk(w, a, b, prior):
    """Row by row: (positive part, negative part) of the non-negative risk."""
    loss = lambda z: math.log1p(math.exp(-z))
    z = lambda x: sum(float(p) * float(q) for p, q in zip(x, w, strict=True))
    pos = sum(loss(z(x)) for x in a) / len(a)
    return prior * pos, sum(loss(-z(x)) for x in b) / len(b) - prior * sum(loss(-z(x)) for x in a) / len(a)


def test_gradient_is_that_of_the_risk():
    rng, seen = np.random.default_rng(2), set()
    for _ in range(12):
        a, b = rng.integers(0, 2, (5, 4)).astype(float), rng.integers(0, 2, (7, 4)).astype(float)
        w, prior = rng.normal(0, 2, 4), float(rng.uniform(0.1, 0.9))
        negative, gradient = T.direction(w, a, b, prior)
        assert negative == pytest.approx(slow_risk(w, a, b, prior)[1])
        seen.add(negative >= 0)
        aim = lambda v: sum(slow_risk(v, a, b, prior)) if negative >= 0 else -slow_risk(v, a, b, prior)[1]  # noqa: B023, E731
        for k in range(4):
            step = np.zeros(4)
            step[k] = 1e-5
            assert gradient[k] == pytest.approx((aim(w + step) - aim(w - step)) / 2e-5, abs=1e-6)
    assert seen == {True, False}


def test_scores_against_plain(spark, docs, made, prose):
    rows, labels = made
    long = prose(77, 40_000)
    odd = [(800, long), (801, long + " grobblehead snarkfaces wretchlinged grobbleheads"), (802, None), (803, ""), (0, "other text of a repeated id")]
    d = docs([*rows, *odd])
    model = T.fit(d, spark.createDataFrame(labels, LABELS))

    def plain(text):
        words = {w for w in re.split(r"[\W\d_]+", (text or "").lower()) if w}
        counts = {}
        for w in words:
            for f in {w, *("^" + w[:k] for k in (4, 5, 6, 7) if len(w) >= k)}:
                counts[f] = counts.get(f, 0) + 1
        held = set(counts) | {f"{f}#{k}" for f, n in counts.items() for k in (2, 3, 5) if n >= k}
        return 1 / (1 + math.exp(-model.bias - sum(v for f, v in model.weights.items() if f in held)))

    found = [(r["doc_id"], r["score"]) for r in T.scored(d, model).collect()]
    asked = sorted((i, plain(t)) for i, t in [*rows, *odd])
    for (i, x), (j, y) in zip(sorted(found), asked, strict=True):
        assert i == j
        assert x == pytest.approx(y, abs=1e-9)
    assert T.fit(d, spark.createDataFrame(labels, LABELS)).weights == model.weights  # reruns agree


def test_a_hundred_languages_in_groups():
    """However small the array may be, languages are scored alike, and none is dropped."""
    r = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyzäöüéèñçßø"
    texts = {f"l{k:03d}": [" ".join("".join(r.choices(own, k=r.randrange(2, 7))) for _ in range(150)) for _ in range(2)] for k in range(100) for own in [r.sample(letters, 7)]}
    small = L.train(texts, table_bytes=3 << 20)
    whole = L.train(texts, table_bytes=1 << 40)
    assert len(whole.groups) == 1 < len(small.groups)
    assert sorted(k for g in small.groups for k in g) == list(range(100))
    asked = [t for k in list(texts)[::9] for t in texts[k]] + ["", None, "123", "zzz qqq"]
    one, other = small.predictions(asked), whole.predictions(asked)
    assert [x[0] for x in one] == [x[0] for x in other]
    assert np.allclose([x[1] for x in one], [x[1] for x in other])
    assert [x[0] for x in one[:-4]] == [k for k in list(texts)[::9] for _ in texts[k]]
    assert max(small.group(g)[1].nbytes for g in range(len(small.groups)) if len(small.groups[g]) > 1) <= 3 << 20
    for tiny in (100, 1):  # a language alone is always a group
        assert len(L.train({k: texts[k] for k in list(texts)[:5]}, table_bytes=tiny).groups) == 5


def test_code_lengths_are_exact(monkeypatch):
    texts = {"a": ["abracadabra abra", "cadabra"], "b": ["bonbon bon", "nob", "é"]}
    m = L.train(texts)
    for chunk in (1 << 20, 5):
        monkeypatch.setattr(L, "CHUNK", chunk)
        for t in ("abra", "bonbon nob", "xyz", "é abc bon!", "a", "cadabra bonbon " * 5):
            got = dict(zip(m.languages, m.lengths(t, 0), strict=True))
            for k in texts:
                assert got[k] == pytest.approx(slow_bits(texts[k], t), rel=1e-4)


def slow_bits(texts, text):
    """Code length by walking the contexts of every byte; three marks precede each text, as in training."""
    grams = [{} for _ in range(4)]
    for t in texts:
        raw = [-1] * 3 + list(t.encode())
        for i in range(3, len(raw)):
            for order in range(4):
                seen = grams[order].setdefault(tuple(raw[i - order : i]), {})
                seen[raw[i]] = seen.get(raw[i], 0) + 1
    total, raw = 0.0, [-1] * 3 + list(text.encode())
    every = {b for ts in (["abracadabra abra", "cadabra"], ["bonbon bon", "nob", "é"]) for t in ts for b in t.encode()}
    raw = [b if b in every else -1 for b in raw]
    for i in range(3, len(raw)):
        for order in range(3, -2, -1):
            if order < 0:
                total += 8
                break
            seen = grams[order].get(tuple(raw[i - order : i]))
            if seen is None:
                continue
            n, k = sum(seen.values()), len(seen)
            if raw[i] in seen:
                total += np.log2((n + k) / seen[raw[i]])
                break
            total += np.log2((n + k) / k)
    return total


def test_language(docs, prose):
    tongues = {"xx": "ba be bi bo bu da de di".split(), "yy": "sko ske ska fri fro grü".split(), "zz": "ção ões mão lhe nho".split()}
    rows = [(i, prose(i, 40, tongues[k]), k) for i, k in ((i, list(tongues)[i % 3]) for i in range(300))]
    d = docs([*rows, (900, None, "xx"), (901, "", None), (902, "12 34 !!", "yy"), (903, prose(1, 30, tongues["zz"]), None), (903, prose(1, 30, tongues["zz"]), None), (904, prose(2, 20000, tongues["xx"]), "xx")])
    model = L.fit(d)
    found = {r["doc_id"]: r for r in L.predicted(d, model).collect()}
    for i, _, k in rows:
        assert found[i]["lang_pred"] == k
        assert found[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1)
    assert [found[i]["lang_pred"] for i in (900, 901, 902, 903, 904)] == ["und", "und", "und", "zz", "xx"]
    assert all(0 <= r["score"] <= 1 for r in found.values())
    kept = L.accepted(d, model)
    assert kept.columns == d.columns
    assert kept.count() == 303
    assert {r["lang_pred"] for r in L.predicted(docs([(1, "abc")]), L.fit(docs([(1, "abc")]))).collect()} == {"und"}
    assert L.predicted(docs([]), L.fit(docs([]))).count() == 0
