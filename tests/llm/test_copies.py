"""SimHash near-duplicates and document sketches against brute force."""

import hashlib
import random
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from paperloom.llm import graph as G
from paperloom.llm import shingle_join as J
from paperloom.llm import simhash as S
from paperloom.llm import sketch as K


def plain_fingerprint(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_force(rows, max_bits=2):
    """All pairs compared: doc_id to (hex fingerprint, component id)."""
    prints = [plain_fingerprint(t) for _, t in rows]
    roots = list(range(len(rows)))

    def find(i: int) -> int:
        while roots[i] != i:
            i = roots[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= max_bits:
            a, b = sorted((find(i), find(j)), key=lambda x: rows[x][0])
            roots[b] = a
    least = reduce(lambda m, i: m | {find(i): min(m.get(find(i), rows[i][0]), rows[i][0])}, range(len(rows)), {})
    return {rows[i][0]: (f"{prints[i]:016x}", least[find(i)]) for i in range(len(rows))}


def test_fingerprints(prose):
    for text in [None, "", "One", "One Two", "a b c", "a b c d", "ÀÉ Über", "x y z x y z x y z", prose(1, 200), "A\tB\nC  D"]:
        assert S.fingerprint(text) == plain_fingerprint(text)


def flipped(seed, n, around):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        x = around[r.randrange(len(around))] if isinstance(around, list) else around
        for _ in range(r.randrange(5)):
            x ^= 1 << r.randrange(64)
        out.append(x)
    return out


@pytest.mark.parametrize(("seed", "chunk"), [(0, S.CHUNK), (1, S.CHUNK), (2, 7), (3, 40)])
def test_links_lose_nothing(spark, seed, chunk):
    r = random.Random(seed)
    around = [r.getrandbits(64) for _ in range(30)]
    prints = sorted(set(flipped(seed, 400, around) + [0, 1, 3, 7, 2**63, 2**64 - 1]))
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    edges = S.links(spark.createDataFrame([(signed(x),) for x in prints], "fp long"), chunk=chunk)
    found = {row["node"]: row["root"] for row in G.components(edges).collect()}
    roots = list(range(len(prints)))

    def find(i):
        while roots[i] != i:
            i = roots[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                roots[find(i)] = find(j)
    groups = {}
    for i in range(len(prints)):
        groups.setdefault(find(i), set()).add(signed(prints[i]))
    for g in groups.values():
        assert {found.get(x, x) for x in g} == {min(g)}


def test_table(spark):
    r = random.Random(6)
    prints = [r.getrandbits(64) for _ in range(50)] + [0, 2**64 - 1, 1 << 63, 3]
    bits = lambda a, b: (a ^ b).bit_count()
    rows = spark.createDataFrame([(i, x - (1 << 64) if x >> 63 else x) for i, x in enumerate(prints)], "i int, fp long")
    for i, t in rows.select("i", S.coordinates(rows["fp"])).collect():
        x = prints[i]
        assert [(t >> 2 * j) & 3 for j in range(32)] == [1 - (bits(x, int(ref)) - bits(x, 0)) // 2 for ref in S.REFERENCES]
    assert sum(int(x) for x in S.REFERENCES) == 2**64 - 1  # no bit in two references


@pytest.mark.parametrize("links_a_part", [G.LINKS_A_PART, 40])
def test_components(spark, links_a_part):
    r = random.Random(5)
    edges = [(r.randrange(-150, 150), r.randrange(-150, 150)) for _ in range(120)] + [(1000 + i, 1001 + i) for i in range(90)] + [(5, 5), (7000, 7000)]
    least = {x: x for e in edges for x in e}
    for _ in range(len(edges)):
        for a, b in edges:
            least[a] = least[b] = min(least[a], least[b])
    found = {x["node"]: x["root"] for x in G.components(spark.createDataFrame([*edges, *edges[:9]], "a long, b long"), links_a_part).collect()}
    assert found == {x: v for x, v in least.items() if any(x in e and e[0] != e[1] for e in edges)}
    assert G.components(spark.createDataFrame([], "a long, b long"), links_a_part).count() == 0


def test_portions():
    r = random.Random(7)
    for most in (1, 3, 10, None):
        keys = sorted(r.choices(range(12), k=80))
        rows, batches = pd.DataFrame({"k": keys, "v": range(80)}), []
        at = 0
        while at < 80:
            n = r.randrange(0, 9)
            batches.append(rows.iloc[at : at + n])
            at += n
        got = list(G.portions(iter(batches), ["k"], most))
        assert [v for part, _ in got for v in part["v"]] == list(range(80))
        for part, chunk in got:
            counts = [keys.count(k) for k in set(part["k"])]
            assert len(part) == sum(counts) if chunk is None else len(set(part["k"])) == 1 and len(part) <= most + 8 and most < counts[0]  # batches have 8 rows at most
        assert len({(part["k"].iloc[0], chunk) for part, chunk in got if chunk is not None}) == sum(chunk is not None for _, chunk in got)


def test_large_cell_is_exact():
    prints = np.array(sorted(set(flipped(9, 3000, 0xDEADBEEF12345678))), dtype=np.uint64)
    roots = S.linked(prints, np.zeros(len(prints), dtype=int))
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 2
    label = np.arange(len(prints))
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            break
        label = new
    assert (roots == label).all()


def test_near_duplicates(docs, prose):
    base = prose(1, 300)
    words = base.split()
    rows = [(10, base), (7, base.upper()), (3, " ".join([*words[:150], "swapped", *words[151:]])), (20, prose(2, 300)), (21, None), (22, ""), (23, " \n"), (20, prose(2, 300)), (30, "tiny"), (31, "tiny"), (40, prose(5, 30000))]
    found = [tuple(r) for r in S.near_duplicates(docs(rows)).collect()]
    expected = brute_force(rows)
    assert len(found) == len(rows)
    for doc_id, fp, component in found:
        assert (f"{fp & (2**64 - 1):016x}", component) == expected[doc_id]
    kept = S.keep_one(docs(rows))
    assert kept.columns == docs([]).columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, c in expected.values()})
    assert S.keep_one(docs([(None, "a b c"), (None, "a b c"), (1, "a b c")])).count() == 3  # rows without an id stay
    assert S.near_duplicates(docs([])).count() == 0
    assert S.keep_one(docs([])).count() == 0


def plain_sketch(text):
    words = [w for w in (text or "").lower().replace("\n", " ").split(" ") if w]
    return words, {" ".join(words[i : i + 5]) for i in range(max(0, len(words) - 4))} or ({" ".join(words)} if words else set())


TEXTS = [None, "", "One two", "a b c d e", "a b c d e f", "Same text here for two of them ok"]


def next_texts(rows):
    """Brute force: the rows in order of id and of a hash of the text, each with the one behind it."""
    h = lambda t: xxhash.xxh64_intdigest((t or "").encode(), 42) >> 1
    order = sorted(rows, key=lambda r: (r[0] if r[0] is not None else -(1 << 63), h(r[1])))
    return {(r[0], r[1] or ""): order[(i + 1) % len(order)][1] or "" for i, r in enumerate(order)}


@pytest.mark.parametrize("far", [10**12, 2**63 - 1, 70])
def test_next_and_edited(docs, prose, far):
    rows = [(i * 3, prose(i, 3 + i)) for i in range(60)] + [(-5, None), (1, ""), (2, "Tëxt with accents é"), (far, prose(9, 50)), (None, "no id"), (None, "none either"), (7, "dup b"), (7, "dup a"), (8, prose(4, 20000))]
    rows += [(11, f"one id {k}") for k in range(90)]  # ties that fill blocks
    found = K.with_next(docs(rows), block=4).collect()
    assert len(found) == len(rows)
    after = next_texts(rows)
    for r in found:
        assert r["next_text"] == after[r["doc_id"], r["text"]]
    assert [r["next_text"] for r in K.with_next(docs([(1, "only")])).collect()] == ["only"]
    assert K.with_next(docs([])).count() == 0


@pytest.mark.parametrize("ids", [[*range(3000), 10**12], [None] * 3000, [7] * 3000, [*range(1500), *[5] * 1500], [i * i * i for i in range(3000)]])
def test_blocks_are_even(docs, ids):
    block = 50
    rows = docs([(i, f"text {k}") for k, i in enumerate(ids)]).select(F.coalesce("doc_id", F.lit(K.NO_ID)).alias("o"), F.shiftrightunsigned(F.xxhash64("text"), 1).alias("h"))
    counts = [r["count"] for r in rows.groupBy(K._block(K._ranges(rows, block)).alias("b")).count().collect()]
    assert sum(counts) == len(ids)
    assert max(counts) <= 6 * block


def test_sketches(docs, prose):
    rows = [*enumerate([*TEXTS, "Same text here for two of them ok", prose(1, 400)])]
    d = docs(rows)
    found = d.select("doc_id", "text", K.sketch(d["text"]).alias("s")).orderBy("doc_id").collect()
    assert found[5]["s"] == found[6]["s"]
    for r in found:
        words, shingles = plain_sketch(r["text"])
        assert all(0 <= h < 1 << 62 for h in r["s"])
        assert r["s"] == sorted(set(r["s"]))
        assert len(r["s"]) <= len(shingles)
    assert 60 < len(found[7]["s"]) < 140  # a quarter of 396


def plain_hashes(text):
    """The shortened sketch by another XXH64: a shingle's words are hashed in turn, each hash the seed of the next."""
    words, kept = plain_sketch(text)[0], set()
    shingles = [words[i : i + 5] for i in range(len(words) - 4)] or ([[" ".join(words)]] if words else [])
    for shingle in shingles:
        h = 42
        for w in shingle:
            h = xxhash.xxh64_intdigest(w.encode(), h)
        if h < 1 << 62:
            kept.add(h >> 22)
    return sorted(kept)


def test_query(spark, docs, prose, tmp_path):
    rows = [(i, prose(i % 25, 120)) for i in range(30)] + [(30, None), (31, "Few Words"), (32, "")]
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: r for r in K.op8_fingerprints(spark, str(tmp_path)).collect()}
    like = lambda x, y, same: len(x & y) / len(x | y) if x | y else float(same)
    for i, (_, text) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        n = len(text) // 4
        edited = text[: len(text) - n] + following[:n]
        a, b, c = (set(plain_hashes(t)) for t in (text, edited, following))
        r = found[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == tuple("".join(f"{h:010x}" for h in sorted(x)) for x in (a, b))
        assert r["near_edited"] == pytest.approx(like(a, b, text == edited))
        assert r["near_next"] == pytest.approx(like(a, c, text == following))
    assert found[0]["fingerprint"] == found[25]["fingerprint"]
    assert np.mean([found[i]["near_edited"] for i in range(30)]) == pytest.approx(0.6, abs=0.06)


def test_merge_and_containment(docs, prose):
    a, b = prose(1, 300), prose(2, 100)
    x, y, both = (K.sketch(F.lit(t)) for t in (a, b, a + " " + b))
    r = docs([(1, a)]).select(K.containment(x, both).alias("p"), K.containment(both, x).alias("q"), F.size(F.array_except(K.merged(x, y), both)).alias("n"), K.containment(K.sketch(F.lit("")), x).alias("z")).first()
    assert r["p"] == 1
    assert r["q"] == pytest.approx(0.75, abs=0.12)
    assert (r["n"], r["z"]) == (0, None)


def test_spanning_forest():
    r = random.Random(4)
    for _ in range(20):
        n = 30
        edges = [(a, b, r.randrange(5)) for a in range(n) for b in range(a) if r.random() < 0.15]
        a, b, d = (np.array([e[k] for e in edges], dtype=np.int64) for k in range(3))
        kept = G.spanning(n, a, b, d)
        roots, weight, count = list(range(n)), 0, 0

        def find(i, roots=roots):
            while roots[i] != i:
                i = roots[i]
            return i

        for x, y, w in sorted(edges, key=lambda e: e[2]):
            if find(x) != find(y):
                roots[find(x)] = find(y)
                weight, count = weight + w, count + 1
        assert (len(kept), int(d[kept].sum())) == (count, weight)
    assert len(G.spanning(3, *(np.zeros(0, dtype=np.int64),) * 3)) == 0


def test_confirmed_near_copies(docs, prose):
    r = random.Random(8)
    rows, texts = [], {}
    for g in range(12):
        base = prose(100 + g, 250).split()
        for k in range(6):
            w = list(base)
            for _ in range(k):
                w[r.randrange(len(w))] = f"changed{g}{k}"
            rows.append((10 * g + k, " ".join(w)))
    rows += [(500, None), (501, ""), (502, "lone words here"), (None, rows[0][1])]
    texts = {i: {" ".join(x) for x in zip(*(t.split()[k:] for k in range(5)), strict=False)} for i, t in rows if t and i is not None and i < 500}
    found = {x["doc_id"]: x["component_id"] for x in S.near_duplicates(docs(rows), confirm=True).collect() if x["doc_id"] is not None}
    same = lambda a, b: len(texts[a] & texts[b]) / len(texts[a] | texts[b])
    near = [(a, b) for a in texts for b in texts if a < b and same(a, b) >= 0.8]
    assert all(found[a] == found[b] for a, b in near)
    for i, c in found.items():
        assert i >= 500 or i // 10 == c // 10
    assert (found[500], found[501], found[502]) == (500, 500, 502)
    kept = S.keep_one(docs(rows), confirm=True)
    assert sorted(x["doc_id"] for x in kept.where("doc_id is not null").collect()) == sorted(set(found.values()))


def test_every_near_copy_is_joined(docs, prose):
    r = random.Random(11)
    rows = []
    for g in range(60):  # a text of 100 words beside copies with one and two words changed, and one beyond the rule
        base = prose(300 + g, 100).split()
        for k, changes in enumerate((0, 1, 2, 9)):
            w = list(base)
            for at in r.sample(range(100), changes):
                w[at] = f"other{g}x{k}x{at}"
            rows.append((10 * g + k, " ".join(w)))
    for k in range(40):  # one large group around a text that all share cells with
        w = prose(77, 100).split()
        w[r.randrange(100)] = f"own{k}"
        rows.append((1000 + k, " ".join(w)))
    sets = {i: plain_sketch(t)[1] for i, t in rows}
    roots = {i: i for i in sets}

    def find(i):
        while roots[i] != i:
            i = roots[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                roots[y] = x
    assert len({find(i) for i in sets}) < len(sets) - 90
    for bits in (0, 6):
        found = {x["doc_id"]: x["component_id"] for x in S.near_duplicates(docs(rows), max_bits=bits, confirm=True).collect()}
        assert found == {i: find(i) for i in sets}


def test_parities_discard_no_pair(spark):
    r = random.Random(13)
    sets = []
    for k in range(60):
        base = [r.getrandbits(63) for _ in range(r.choice([1, 5, 400, 600, 1500]))]
        sets.append(base)
        sets.append([*base[: len(base) - len(base) // r.randrange(3, 20)], *(r.getrandbits(63) for _ in range(len(base) // 12))])
    rows = spark.createDataFrame([(i, sorted(set(x))) for i, x in enumerate(sets)], "fp long, s array<bigint>")
    kept = J.heads(rows, np.arange(J.BUCKETS) % 7).select("fp", "sid", "size", "wide", "odd").collect()
    assert all(len(x["odd"]) == J.PARITIES // 8 and 64 * len(x["wide"]) >= max(J.PARITIES, x["size"]) for x in kept)
    side = lambda k: J.heads(rows, np.arange(J.BUCKETS) % 7).select(F.col("fp").alias(k), F.col("size").alias(f"n{k}"), F.col("wide").alias(f"w{k}"))
    passed = {(x["a"], x["b"]) for x in side("a").crossJoin(side("b")).where(J._may_reach(0.8)).select("a", "b").collect()}
    alike = lambda x, y: len(set(x) & set(y)) / len(set(x) | set(y))
    scores = {(a, b): alike(sets[a], sets[b]) for a in range(len(sets)) for b in range(len(sets))}
    assert {p for p, v in scores.items() if v >= 0.8} <= passed
    assert not [p for p in passed if scores[p] < 0.5 and len(sets[p[0]]) > 5]


def test_nearer_false_links_hide_no_pair(spark, docs, monkeypatch):
    r = random.Random(12)  # here two false links are nearer than the true one, so a forest of all three leaves that out
    base = [f"w{r.randrange(10**6)}" for _ in range(90)]
    texts = []
    for k in range(14):
        w = list(base)
        for _ in range(r.randrange(0, 5)):
            w[r.randrange(90)] = f"x{k}y{r.randrange(1000)}"
        texts.append(" ".join(w))
    rows = [(i, texts[k]) for i, k in enumerate((0, 3, 11))]
    bits = lambda a, b: (S.fingerprint(rows[a][1]) ^ S.fingerprint(rows[b][1])).bit_count()
    sets = [plain_sketch(t)[1] for _, t in rows]
    alike = [(a, b) for b in range(3) for a in range(b) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    assert (alike, bits(0, 1), bits(0, 2), bits(1, 2)) == ([(0, 1)], 6, 5, 5)
    signed = [f - (1 << 64) if (f := S.fingerprint(t)) >> 63 else f for _, t in rows]
    monkeypatch.setattr(S, "links", lambda prints, max_bits: spark.createDataFrame([(signed[0], signed[2]), (signed[1], signed[2])], "a long, b long"))
    found = {x["doc_id"]: x["component_id"] for x in S.near_duplicates(docs(rows), max_bits=6, confirm=True).collect()}
    assert found == {0: 0, 1: 0, 2: 2}


def test_large_cells_are_cut(spark):
    """20,000 sets of one token: no task has more than two chunks, and any two sets meet."""
    from pyspark.sql import functions as F

    from paperloom.llm import shingle_join as J

    n, most = 20_000, 2048
    rows = spark.range(n).select(F.lit(7).cast("long").alias("token"), F.col("id").alias("sid"), F.lit(n).cast("long").alias("n"))
    dealt = rows.select("sid", F.explode(J.cells_of(F.col("token"), F.col("sid"), F.col("n"), most)).alias("cell"))
    assert dealt.groupBy("cell").count().agg(F.max("count")).first()[0] < 2 * most * 1.2
    few = dealt.where("sid % 400 = 0")
    met = few.alias("x").join(few.alias("y"), "cell").where("x.sid < y.sid").select("x.sid", F.col("y.sid").alias("other")).distinct().count()
    assert met == 50 * 49 // 2
    small = rows.withColumn("n", F.lit(100)).select(F.explode(J.cells_of(F.col("token"), F.col("sid"), F.col("n"), most)).alias("cell"))
    assert [r["cell"] for r in small.distinct().collect()] == [7]


def test_join_with_small_chunks(spark, docs, monkeypatch):
    """The join finds the same groups however small the chunks are."""
    import random

    from paperloom.llm import shingle_join as J
    from paperloom.llm import simhash as S

    r = random.Random(8)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(60):
        own = base[:]
        for _ in range(r.randrange(0, 5)):
            own[r.randrange(60)] = f"x{r.randrange(1000)}"
        rows.append((i, " ".join(own), "en", "s"))
    table = docs(rows)
    whole = sorted(x["doc_id"] for x in S.keep_one(table, confirm=True).collect())
    monkeypatch.setattr(J, "CELL_ROWS", 4)
    assert sorted(x["doc_id"] for x in S.keep_one(table, confirm=True).collect()) == whole


def test_a_cell_writes_links_and_no_pairs():
    """120 sets at about 0.75, some alike: rows that leave a cell are its sets and a forest of its links, however many pairs may be alike."""
    import numpy as np
    import pandas as pd

    from paperloom.llm import shingle_join as J

    r = random.Random(6)
    number = lambda: r.randrange(-(1 << 63), 1 << 63)
    base = [number() for _ in range(600)]
    sets = [sorted({*base[: 600 - k], *(number() for _ in range(k))}) for k in (r.choice([20, 80]) for _ in range(120))]
    s = sorted((np.array(x) for x in sets), key=len)
    n, zero, size = len(s), np.zeros(len(s), dtype=np.int64), np.array([len(x) for x in s])
    score = np.array([[len(np.intersect1d(x, y)) / len(np.union1d(x, y)) for y in s] for x in s])
    assert 3000 < ((score >= 0.7) & (score < 0.8)).sum() // 2 and ((score >= 0.8) & ~np.eye(n, dtype=bool)).any(axis=1).sum() > 20
    bits = lambda w: [np.packbits((np.bincount(x & (w - 1), minlength=w) & 1).astype(np.uint8), bitorder="little").view(np.int64) for x in s]
    odd = np.array(bits(J.PARITIES)).view(np.uint64)
    hit = J._with_partner(zero, size, np.arange(n), odd, bits(1024), 0.8)
    assert hit[((score >= 0.8) & ~np.eye(n, dtype=bool)).any(axis=1)].all()
    found = J._proven(pd.DataFrame({"sid": np.arange(n), "token": zero, "size": size, "label": np.arange(n), "s": s}), 0.8)
    assert len(found) < n and all(score[a, b] >= 0.8 for a, b in zip(found["a"], found["b"], strict=True))
    from paperloom.llm.graph import merge

    mine, plain = np.arange(n), np.arange(n)
    merge(mine, found["a"].to_numpy(), found["b"].to_numpy())
    merge(plain, *np.nonzero(score >= 0.8))
    assert (mine == plain).all()
