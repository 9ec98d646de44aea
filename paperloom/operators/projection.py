"""Vectors to the plane by their neighbours: what lies close together stays close together.

1. **Neighbours.** Random hyperplanes cut at medians of a sample deal vectors to leaves of about ``LEAF``; each leaf's nearest are exact, and several such
   trees make the first graph. Rounds of neighbour descent follow: the neighbours of a vector, to it and from it, are compared with each other,
   and a pair goes on only if it is closer than the farthest neighbour that one of the two has. Vectors are compared in blocks of alike ones: a block
   gets each vector that its lists name once, and gives back each vector's nearest alone. The graph is approximate; ``recall`` measures it.
2. **Weights.** exp(-(d - nearest) / scale), the scale such that a vector's weights sum to log2(k); both directions' weights join as a + b - ab.
3. **Start.** Two eigenvectors of the graph's normalised weights by power iteration from the first principal components.
4. **Layout.** Rounds of attraction along edges and repulsion from a drawn sample of ``DRAWN`` positions. A round deals the edges to blocks by their first end; a block moves
   its own points for some steps while the positions of all others stay as the round began.

Steps 3 and 4 deal the edges to groups of blocks once (``spread``); after that only positions travel, each once to a group that has an edge to it.

Sums over edges are of whole numbers (fixed point), draws are seeded and rows are sorted where Python sees them, so reruns agree to the last digit for the same input and partition-free keys.

Defined results: rows without an id or a vector, or with a vector of zeros, get no position; of rows that share an id one vector counts (the least); equal vectors are
neighbours at distance 0; fewer than three vectors lie at 0, 0. Cosine distance throughout.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from ..session import materialise
from .clusters import plane

NEIGHBOURS, LEAST_DISTANCE = 15, 0.1
LEAF, TREES, DESCENTS = 150, 4, 5
#: Vectors whose projections give the medians.
SAMPLED = 4000
#: Share of all neighbours that a round has to change to be followed by another.
CHANGED = 0.002
POWER_STEPS = 24
ROUNDS, STEPS, DRAWN, REPULSED = 16, 25, 2000, 5
#: All edges of a point act at once, so a step is this share of what single draws would do one after the other.
GAIN = 0.02
#: Points in a block of the layout, about, and blocks that get their positions together.
BLOCK, TOGETHER = 5000, 4
#: Numbers in the vectors that a block of the descent holds, at most about; vectors and blocks that tables too small for that are cut to.
HELD, LEAST_SHARE, SHARES = 1 << 25, 500, 24
#: Pairs that a block of the descent holds before it keeps each vector's nearest alone.
PAIRS = 1 << 20
_FIXED = float(1 << 32)


def _given(vectors: DataFrame, id_col: str, vector: str) -> DataFrame:
    """(id, given, norm): one vector an id, as it is given, and its length."""
    each = vectors.where(F.col(id_col).isNotNull() & F.col(vector).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.min(vector).alias("given"))
    norm = F.sqrt(F.aggregate(F.transform("given", lambda x: x.cast("double")), F.lit(0.0), lambda s, x: s + x * x))
    return each.withColumn("norm", norm).where("norm > 0")


def _with_units(given: DataFrame) -> DataFrame:
    return given.withColumn("v", F.transform("given", lambda x: x.cast("double") / F.col("norm")))


def unit_vectors(vectors: DataFrame, id_col: str, vector: str) -> DataFrame:
    """(id, v): one unit vector an id, as doubles."""
    return _with_units(_given(vectors, id_col, vector)).select("id", "v")


def _matrix(column) -> np.ndarray:
    return np.array([np.asarray(v, dtype=np.float64) for v in column])


def _units(frame: pd.DataFrame) -> np.ndarray:
    return _matrix(frame["given"]) / frame["norm"].to_numpy()[:, None]


def _distances(m: np.ndarray) -> np.ndarray:
    return np.round(np.clip(1.0 - m @ m.T, 0.0, 2.0), 7)


def _closest(ids: np.ndarray, d: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (row, column) of each row's k least distances besides itself."""
    n = len(ids)
    np.fill_diagonal(d, np.inf)
    k = min(k, n - 1)
    if k < 1:
        return np.zeros(0, int), np.zeros(0, int)
    order = np.argsort(d, axis=1, kind="stable")[:, :k]
    return np.repeat(np.arange(n), k), order.ravel()


def _coded(units: DataFrame, n: int, trees: int, leaf: int, seed: int) -> tuple[DataFrame, int]:
    """Units with ``codes``, their leaf in each tree, and the bits of a code."""
    sample = _matrix([r["v"] for r in units.orderBy(F.xxhash64("id", F.lit(seed))).limit(SAMPLED).collect()])
    bits = max(0, math.ceil(math.log2(max(n / leaf, 1))))
    made = []
    for t in range(trees):
        planes = np.random.default_rng([seed, t]).normal(size=(sample.shape[1], bits))
        made.append((planes, np.median(sample @ planes, axis=0) if bits else np.zeros(0)))

    @F.pandas_udf("array<long>")
    def codes(given: pd.Series, norm: pd.Series) -> pd.Series:
        m = _units(pd.DataFrame({"given": given, "norm": norm}))
        found = np.stack([((m @ p > cut) @ (1 << np.arange(bits))) if bits else np.zeros(len(m), int) for p, cut in made], axis=1)
        return pd.Series(list(found.astype(np.int64)))

    return materialise(units.select("id", "given", "norm", codes("given", "norm").alias("codes"))), bits


def _cut(rows: DataFrame, keys: list[str], most: int) -> DataFrame:
    """Rows with ``part``: what many rows share is cut by a hash. Sizes above the most are sent, at most rows / most of them."""
    sizes = rows.groupBy(keys).agg(F.ceil(F.count("*") / most).alias("parts")).where("parts > 1")
    parts = F.coalesce("parts", F.lit(1).cast("long"))
    return rows.join(F.broadcast(sizes), keys, "left").withColumn("part", F.pmod(F.xxhash64("id", *[k for k in keys if k == "tree"]), parts)).drop("parts")


def _homes(coded: DataFrame, n: int, bits: int, dimensions: int, k: int) -> DataFrame:
    """(id, block): blocks of alike vectors, by the first tree's code."""
    share = max(1, min(HELD // (3 * k * max(dimensions, 1)), max(LEAST_SHARE, n // SHARES)))
    kept = min(bits, max(0, math.ceil(math.log2(max(n / share, 1)))))
    prefix = F.element_at("codes", 1).bitwiseAND(F.lit((1 << kept) - 1))
    return _cut(coded.select("id", prefix.alias("code")), ["code"], share).select("id", F.struct("code", "part").alias("block"))


def _best(pairs: DataFrame, k: int) -> DataFrame:
    """(id, near): the k nearest of each id as (distance, neighbour), nearest first."""
    # dealt by id alone, once for both counts
    once = pairs.select("id", "neighbour", "distance").repartition("id").groupBy("id", "neighbour").agg(F.min("distance").alias("distance"))
    return once.groupBy("id").agg(F.slice(F.array_sort(F.collect_list(F.struct("distance", "neighbour"))), 1, k).alias("near"))


def _nearest(a: np.ndarray, b: np.ndarray, d: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of pairs (a, b) at distance d, the k nearest of each a, each once."""
    order = np.lexsort((d, b, a))
    a, b, d = a[order], b[order], d[order]
    first = np.ones(len(a), bool)
    first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    a, b, d = a[first], b[first], d[first]
    order = np.lexsort((b, d, a))
    a, b, d = a[order], b[order], d[order]
    rank = np.arange(len(a)) - np.searchsorted(a, a)
    return a[rank < k], b[rank < k], d[rank < k]


def _compared(lists: pd.DataFrame, held: pd.DataFrame, k: int) -> pd.DataFrame:
    """One block's lists compared: rows (members) of ids, and (id, given, norm, farthest) of all that they name."""
    held = held.sort_values("id")
    ids, m, farthest = held["id"].to_numpy(), _units(held), held["farthest"].to_numpy()
    ends = np.cumsum([len(x) for x in lists["members"]])
    places = pd.Index(ids).get_indexer(np.concatenate(list(lists["members"]))) if len(ends) else np.zeros(0, int)
    kept, pending, waiting = [], [], 0

    def keep() -> None:
        kept.append(_nearest(*(np.concatenate(c) for c in zip(*pending, strict=True)), k))
        pending.clear()

    for at in np.split(places, ends[:-1]):
        at = np.sort(at)
        d = _distances(m[at])
        np.fill_diagonal(d, np.inf)
        i, j = np.nonzero(d < farthest[at][:, None])
        pending.append((at[i], at[j], d[i, j]))
        waiting += len(i)
        if waiting > PAIRS:
            keep()
            waiting = 0
    if pending:
        keep()
    if not kept:
        return pd.DataFrame({"id": ids[:0], "neighbour": ids[:0], "distance": np.zeros(0)})
    a, b, d = _nearest(*(np.concatenate(c) for c in zip(*kept, strict=True)), k)
    return pd.DataFrame({"id": ids[a], "neighbour": ids[b], "distance": d})


def neighbour_graph(units: DataFrame, k: int = NEIGHBOURS, trees: int = TREES, leaf: int = LEAF, descents: int = DESCENTS, seed: int = 42) -> DataFrame:
    """(id, near): about the k nearest of each unit vector (id, v), as an array of (distance, neighbour).

    Where units have the vectors ``given`` (floats, say) and their ``norm``, those travel instead.
    """
    units = units if "given" in units.columns else units.withColumns({"given": F.col("v"), "norm": F.lit(1.0)})
    kind = dict(units.dtypes)["id"]
    n = units.count()
    pair = f"id {kind}, neighbour {kind}, distance double"

    def within(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        ids, d = pdf["id"].to_numpy(), _distances(_units(pdf))
        i, j = _closest(ids, d, k)
        return pd.DataFrame({"id": ids[i], "neighbour": ids[j], "distance": d[i, j]})

    coded, bits = _coded(units, n, trees, leaf, seed)
    leaves = _cut(coded.select("id", "given", "norm", F.posexplode("codes").alias("tree", "code")), ["tree", "code"], 2 * leaf)
    graph = materialise(_best(leaves.groupBy("tree", "code", "part").applyInPandas(within, pair), k))
    dimensions = (coded.agg(F.max(F.size("given"))).first()[0] or 0) if descents else 0
    homes = materialise(_homes(coded, n, bits, dimensions, k))

    for _ in range(descents):
        flat = graph.select("id", F.inline("near")).select("id", "neighbour", "distance")
        # of those that have it as a neighbour, a vector is compared with the 2 k nearest: more would be met by way of others
        back = _best(flat.select(F.col("neighbour").alias("id"), F.col("id").alias("neighbour"), "distance"), 2 * k)
        named = lambda c: F.coalesce(F.transform(c, lambda x: x["neighbour"]), F.array().cast(f"array<{kind}>"))
        members = F.array_distinct(F.concat(F.array("id"), named("near"), named("back"))).alias("members")
        lists = materialise(graph.join(back.withColumnRenamed("near", "back"), "id", "left").join(homes, "id").select("block", members))
        bound = F.when(F.size("near") < k, F.lit(3.0)).otherwise(F.element_at("near", -1)["distance"]).alias("farthest")
        known = coded.select("id", "given", "norm").join(graph.select("id", bound), "id")
        wanted = lists.repartition("block").select("block", F.explode("members").alias("id")).distinct()
        held = wanted.join(known, "id").select(F.col("block").alias("home"), "id", "given", "norm", "farthest")
        found = lists.groupBy("block").cogroup(held.groupBy("home")).applyInPandas(lambda one, other: _compared(one, other, k), pair)
        better = materialise(_best(flat.unionByName(found), k))
        both = better.join(graph.select("id", F.col("near").alias("was")), "id")
        changed = both.agg(F.sum(F.size(F.array_except("near", "was"))).alias("n")).first()["n"] or 0
        graph = better
        if changed <= CHANGED * n * k:
            break
    return graph


def recall(graph: DataFrame, exact: DataFrame) -> float:
    """Share of the exact neighbours (id, near) that the graph has, by distance: as near as the exact farthest counts."""
    both = graph.join(exact.select("id", F.element_at("near", -1)["distance"].alias("bound"), F.size("near").alias("k")), "id")
    hit = F.size(F.filter("near", lambda x: x["distance"] <= F.col("bound") + 1e-9))
    return both.agg((F.sum(F.least(hit, "k")) / F.sum("k")).alias("r")).first()["r"]


def exact_neighbours(queries: DataFrame, units: DataFrame, k: int = NEIGHBOURS, block: int = 2000) -> DataFrame:
    """(id, near) of a stated query set against all vectors, block by block."""
    kind = dict(units.dtypes)["id"]
    asked = [(r["id"], r["v"]) for r in queries.orderBy("id").collect()]
    ids, m = [a for a, _ in asked], _matrix([v for _, v in asked])
    sent = units.sparkSession.sparkContext.broadcast((ids, m))

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, m = sent.value
        for frame in frames:
            own = frame["id"].to_numpy()
            d = np.round(np.clip(1.0 - m @ _matrix(frame["v"]).T, 0.0, 2.0), 7)
            for i, a in enumerate(ids):
                d[i, own == a] = np.inf
            order = np.argsort(d, axis=1, kind="stable")[:, :k]
            i, j = np.repeat(np.arange(len(ids)), order.shape[1]), order.ravel()
            yield pd.DataFrame({"id": np.array(ids, dtype=object)[i], "neighbour": own[j], "distance": d[i, j]})[d[i, j] < np.inf]

    return _best(units.mapInPandas(search, f"id {kind}, neighbour {kind}, distance double"), k)


def fuzzy_edges(graph: DataFrame) -> DataFrame:
    """(a, b, w): weights of undirected edges, each once in both directions."""

    @F.pandas_udf("array<double>")
    def weights(distances: pd.Series) -> pd.Series:
        n = np.array([len(x) for x in distances])
        d = np.full((len(n), max(n, default=0)), np.inf)
        for row, x in zip(d, distances, strict=True):
            row[: len(x)] = x
        above = np.where(d > 0, d, np.inf).min(axis=1)
        nearest = np.where(np.isfinite(above), above, 0.0)[:, None]
        gap = np.maximum(d - nearest, 0.0)
        low, high = np.zeros(len(n)), np.full(len(n), 64.0)
        aim = np.log2(np.maximum(n, 2))
        for _ in range(60):
            scale = (low + high) / 2
            much = np.exp(-gap / np.maximum(scale, 1e-9)[:, None]).sum(axis=1) > aim
            high, low = np.where(much, scale, high), np.where(much, low, scale)
        w = np.exp(-gap / np.maximum(scale, 1e-9)[:, None])
        return pd.Series([row[:k] for row, k in zip(w, n, strict=True)])

    listed = graph.select("id", "near", weights(F.transform("near", lambda x: x["distance"])).alias("ws"))
    one = listed.select(F.col("id").alias("a"), F.inline(F.arrays_zip(F.transform("near", lambda x: x["neighbour"]).alias("b"), F.col("ws").alias("w"))))
    once = one.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("w").alias("s"), F.when(F.count("*") > 1, F.max("w") * F.min("w")).otherwise(0.0).alias("p"))
    both = once.select("a", "b", (F.col("s") - F.col("p")).alias("w")).where("w > 1e-6")
    return both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"), "w"))


def _whole(c: Column) -> Column:
    return F.round(c * _FIXED).cast("long")


def _sum(c: Column) -> Column:
    """A sum that does not depend on its order: of decimals of fixed point."""
    return F.sum(_whole(c).cast("decimal(20,0)")).cast("double") / _FIXED


def spread(edges: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Edges (g, block, a, b, w, even) by groups of blocks, the positions (to, id) that each group needs, and degrees (id, d); ``even`` is the normalised weight.

    The first two are kept where they lie, dealt by group and by id, so that rounds move none of their rows; ``unpersist`` them at the end.
    """
    by_a = edges.repartition("a")
    degree = materialise(by_a.groupBy(F.col("a").alias("id")).agg(_sum(F.col("w")).alias("d")))
    blocks = max(1, degree.count() // BLOCK)
    groups = max(min(blocks, SHARES), blocks // TOGETHER)
    even = (F.col("w") / F.sqrt(F.col("da") * F.col("db"))).alias("even")
    each = edges.join(degree.withColumnsRenamed({"id": "a", "d": "da"}), "a").join(degree.withColumnsRenamed({"id": "b", "d": "db"}), "b")
    each = each.withColumn("block", F.pmod(F.xxhash64("a"), F.lit(blocks))).select((F.col("block") % groups).alias("g"), "block", "a", "b", "w", even)
    parts = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    near = each.repartition(parts, "g").sortWithinPartitions("g").persist()
    near.count()
    own = near.select(F.col("g").alias("to"), F.col("a").alias("id"))
    needs = own.unionByName(near.select(F.col("g").alias("to"), F.col("b").alias("id"))).distinct().repartition(parts, "id").sortWithinPartitions("id").persist()
    needs.count()
    return near, needs, degree


def _placed(needs: DataFrame, at: DataFrame) -> GroupedData:
    """Positions of ``at`` (id, x, y), each once a group."""
    return needs.join(at, "id").select("to", "id", "x", "y").groupBy("to")


def _half_up(v: np.ndarray) -> np.ndarray:
    """Whole numbers next to v as ``round`` gives them: halves away from zero."""
    whole = np.trunc(v)
    return (whole + np.where(np.abs(v - whole) >= 0.5, np.sign(v), 0.0)).astype(np.int64)


def _power(edges: pd.DataFrame, places: pd.DataFrame) -> pd.DataFrame:
    """Half of each position and half of the weighted sum of its neighbours': the half of self keeps all eigenvalues positive."""
    edges = edges.sort_values("a")
    at = pd.Index(places["id"])
    ids, first = np.unique(edges["a"].to_numpy(), return_index=True)
    there, own, w = at.get_indexer(edges["b"]), at.get_indexer(ids), edges["even"].to_numpy()
    moved = {}
    for c in "xy":
        v = places[c].to_numpy()
        moved[c] = (v[own] + np.add.reduceat(_half_up(w * v[there] * _FIXED), first) / _FIXED) / 2 if len(ids) else np.zeros(0)
    return pd.DataFrame({"id": ids, **moved})


def spectral_start(near: DataFrame, needs: DataFrame, degree: DataFrame, start: DataFrame, steps: int = POWER_STEPS) -> DataFrame:
    """(id, x, y): second and third eigenvector of the normalised weights of ``spread``, by power iteration from ``start`` (id, x, y)."""
    kind = dict(degree.dtypes)["id"]
    own = degree.select("id", F.sqrt("d").alias("o"))

    def apart(df: DataFrame) -> DataFrame:
        """Both columns without the constant eigenvector, the second without the first, each of mean square 1."""
        df = materialise(df.join(own, "id").select("id", "x", "y", "o"))
        dot = lambda p, q: _sum(F.col(p) * F.col(q))
        s = df.agg(dot("o", "o").alias("oo"), dot("o", "x").alias("ox"), dot("o", "y").alias("oy")).first()
        df = df.withColumns({c: F.col(c) - F.col("o") * ((s[f"o{c}"] or 0.0) / (s["oo"] or 1.0)) for c in "xy"})
        s = df.agg(dot("x", "x").alias("xx"), dot("x", "y").alias("xy"), F.count("*").alias("n")).first()
        df = df.withColumn("y", F.col("y") - F.col("x") * ((s["xy"] or 0.0) / (s["xx"] or 1.0)))
        s2 = df.agg(dot("y", "y").alias("yy")).first()
        size = lambda v: math.sqrt((v or 0.0) / max(s["n"], 1)) or 1.0
        return df.select("id", (F.col("x") / size(s["xx"])).alias("x"), (F.col("y") / size(s2["yy"])).alias("y"))

    at = materialise(apart(start))
    for step in range(steps):
        at = near.select("g", "a", "b", "even").groupBy("g").cogroup(_placed(needs, at)).applyInPandas(_power, f"id {kind}, x double, y double")
        if step % 4 == 3 or step == steps - 1:
            at = materialise(apart(at))
    return at.join(own, "id").select("id", (F.col("x") / F.col("o")).alias("x"), (F.col("y") / F.col("o")).alias("y"))


def curve(least: float = LEAST_DISTANCE) -> tuple[float, float]:
    """(a, b) by which 1 / (1 + a d^(2 b)) is about 1 up to ``least`` and then falls as exp(-(d - least)): least squares over a grid made finer step by step."""
    d = np.linspace(0, 3, 301)[1:]
    aim = np.where(d < least, 1.0, np.exp(-(d - least)))
    a, b, width = 1.5, 1.0, 0.9
    for _ in range(40):
        grid = [(p, q) for p in np.linspace(max(a * (1 - width), 1e-3), a * (1 + width), 9) for q in np.linspace(max(b * (1 - width), 1e-3), b * (1 + width), 9)]
        a, b = min(grid, key=lambda g: float(((1 / (1 + g[0] * d ** (2 * g[1])) - aim) ** 2).sum()))
        width *= 0.75
    return float(a), float(b)


def _mover(a: float, b: float, turn: int, rounds: int, steps: int, others: np.ndarray, seed: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """One round of a group of blocks: rows (block, a, b, w) are the edges of its points, rows (id, x, y) the positions of their ends."""

    def move(pdf: pd.DataFrame, index: pd.Index, places: np.ndarray) -> pd.DataFrame:
        pdf = pdf.sort_values(["a", "b"])
        ids, own = np.unique(pdf["a"].to_numpy(), return_inverse=True)
        p = places[index.get_indexer(ids)]
        there, w = places[index.get_indexer(pdf["b"])], pdf["w"].to_numpy()[:, None]
        place = np.searchsorted(ids, pdf["b"].to_numpy())
        inside = (place < len(ids)) & (ids[np.minimum(place, len(ids) - 1)] == pdf["b"].to_numpy())
        pull = np.bincount(own, w[:, 0])[:, None]
        r = np.random.default_rng([seed, turn, int(pdf["block"].iloc[0])])
        for step in range(steps):
            rate = 1.0 - (turn * steps + step) / (rounds * steps)
            there[inside] = p[place[inside]]
            gap = p[own] - there
            d2 = (gap * gap).sum(axis=1, keepdims=True)
            force = np.where(d2 > 0, -2 * a * b * np.maximum(d2, 1e-12) ** (b - 1) / (1 + a * d2**b), 0.0)
            change = np.zeros_like(p)
            np.add.at(change, own, w * np.clip(force * gap, -4, 4))
            push = np.zeros_like(p)
            for _ in range(REPULSED):
                gap = p - others[r.integers(0, len(others), len(p))]
                d2 = (gap * gap).sum(axis=1, keepdims=True)
                push += np.where(d2 > 0, np.clip(2 * b / ((0.001 + d2) * (1 + a * d2**b)) * gap, -4, 4), 0.0)
            p = p + rate * GAIN * (2 * change + pull * push)
        return pd.DataFrame({"id": ids, "x": np.round(p[:, 0], 9), "y": np.round(p[:, 1], 9)})

    def each(edges: pd.DataFrame, positions: pd.DataFrame) -> pd.DataFrame:
        index, places = pd.Index(positions["id"]), positions[["x", "y"]].to_numpy()
        return pd.concat([move(pdf, index, places) for _, pdf in edges.groupby("block")])

    return each


def layout(near: DataFrame, needs: DataFrame, start: DataFrame, least: float = LEAST_DISTANCE, rounds: int = ROUNDS, steps: int = STEPS, seed: int = 42) -> DataFrame:
    """(id, x, y) after rounds of attraction and repulsion from ``start``, along the edges of ``spread``."""
    a, b = curve(least)
    kind = dict(start.dtypes)["id"]
    box = start.agg(F.max(F.greatest(F.abs("x"), F.abs("y")))).first()[0] or 1.0
    at = materialise(start.select("id", (F.col("x") * (10.0 / box)).alias("x"), (F.col("y") * (10.0 / box)).alias("y")))
    for turn in range(rounds):
        drawn = at.orderBy(F.xxhash64("id", F.lit(seed + turn)), "id").limit(DRAWN).collect()
        others = np.array([(r["x"], r["y"]) for r in drawn])
        pulled = near.select("g", "block", "a", "b", "w").groupBy("g").cogroup(_placed(needs, at))
        at = materialise(pulled.applyInPandas(_mover(a, b, turn, rounds, steps, others, seed), f"id {kind}, x double, y double"))
    return at


def neighbour_plane(vectors: DataFrame, id_col: str, vector: str = "embedding", k: int = NEIGHBOURS, least: float = LEAST_DISTANCE, seed: int = 42) -> DataFrame:
    """(id, umap_x, umap_y): positions by the neighbour graph."""
    units = _with_units(materialise(_given(vectors, id_col, vector)))
    n = units.count()
    if n < 3:
        return units.select(F.col("id").alias(id_col), F.lit(0.0).cast("float").alias("umap_x"), F.lit(0.0).cast("float").alias("umap_y"))
    graph = neighbour_graph(units, min(k, n - 1), seed=seed)
    edges = materialise(fuzzy_edges(graph))
    # rounded: sums inside the components' fit are not in a fixed order
    first = plane(units, "id", "v").select("id", F.round(F.col("umap_x").cast("double"), 4).alias("x"), F.round(F.col("umap_y").cast("double"), 4).alias("y"))
    near, needs, degree = spread(edges)
    placed = layout(near, needs, materialise(spectral_start(near, needs, degree, first)), least, seed=seed)
    near.unpersist()
    needs.unpersist()
    return placed.select(F.col("id").alias(id_col), F.round("x", 5).cast("float").alias("umap_x"), F.round("y", 5).cast("float").alias("umap_y"))
