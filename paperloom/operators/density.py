"""Density clusters by hierarchy: one minimum size, no radius, clusters of unlike density side by side.

Distance between two points is mutual reachability: their distance, but no less than either's core distance, which is the distance to its
``least``-th neighbour. Points joined at ever larger distances make a tree of clusters of ``smallest`` points and more; the clusters that
last longest for their size are chosen, the rest is noise (-1).

How it runs, with no task that holds all points:

1. Points at one place are one spot with a weight. A quadtree deals spots to blocks of at most ``block`` (or one ``MOST_BLOCKS``-th of all), so that dense places have small ones.
2. Core distances are exact: the blocks' boxes and weights bound how far a block has to look, and a block gets the spots within that reach.
3. Edges that may be in the minimum spanning tree: the tree of each block, and for pairs of blocks the tree's edges across. A pair is left out if both blocks
   are connected below its boxes' distance; of the others only spots within the bound meet. Ties of length are settled by ids everywhere alike, so the
   edges found hold one whole spanning tree.
4. From leaves of the quadtree upwards, each block joins the components for which an edge inside it is the shortest that leaves either; a component whose shortest edge leads
   out of the block waits for a larger block. A component below ``smallest`` carries the list of its spots, a larger one its cluster's id and size alone.
5. The tree of clusters, one row a cluster of ``smallest`` points or more, goes to one task, which chooses clusters by stability.

Rows of the driver and of step 5 are blocks (at most about four times ``MOST_BLOCKS``) and clusters.

Defined results: points without both coordinates (null or NaN) are noise; points at one place have one label; components that meet at the same distance meet
at once, so labels do not depend on order or ids; all in one cluster is no cluster: all are noise; labels are numbered by size, then least id.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

BLOCK_POINTS, MOST_BLOCKS = 512, 20_000
#: Components left over that go to one task together.
TOGETHER = 20_000
DEPTH = 26
#: Levels of the quadtree that components go up at once: a task has what is left of at most 4 ** LEVELS blocks or cells.
LEVELS = 2
#: Distances below this count as this where they are divided by.
LEAST_DISTANCE = 1e-12


def reach(dx: np.ndarray, dy: np.ndarray) -> np.ndarray:
    return np.sqrt(dx * dx + dy * dy)


def spanning_tree(ids: np.ndarray, x: np.ndarray, y: np.ndarray, core: np.ndarray) -> list[tuple[int, int, float]]:
    """Edges (place, place, length) of the one minimum spanning tree by mutual reachability, ties of length by the ends' ids."""
    n, out = len(ids), []
    # places that wait stand in front; the last of them fills the gap of the one taken
    place, ids, x, y, core = np.arange(n), ids.copy(), x.copy(), y.copy(), core.copy()
    length, low, high, from_ = np.full(n, np.inf), np.zeros(n, ids.dtype), np.zeros(n, ids.dtype), np.zeros(n, np.int64)
    at = 0
    for m in range(n - 1, 0, -1):
        here, id_, px, py, c = place[at], ids[at], x[at], y[at], core[at]
        for v in (place, ids, x, y, core, length, low, high, from_):
            v[at] = v[m]
        w = reach(x[:m] - px, y[:m] - py)
        np.maximum(w, core[:m], out=w)
        np.maximum(w, c, out=w)
        better = w < length[:m]
        same = np.flatnonzero(w == length[:m])
        if len(same):
            a, b = np.minimum(ids[same], id_), np.maximum(ids[same], id_)
            better[same] = (a < low[same]) | ((a == low[same]) & (b < high[same]))
        new = np.flatnonzero(better)
        length[new], low[new], high[new], from_[new] = w[new], np.minimum(ids[new], id_), np.maximum(ids[new], id_), here
        least = np.flatnonzero(length[:m] == length[:m].min())
        at = int(least[0] if len(least) == 1 else least[np.lexsort((high[least], low[least]))[0]])
        out.append((int(from_[at]), int(place[at]), float(length[at])))
    return out


# --- blocks -----------------------------------------------------------------------------------------------------------------------------


def _blocks(spots: DataFrame, block: int) -> DataFrame:
    """Spots with their block: (level << 52) | (column << 26) | row of a quadtree's leaf."""
    box = spots.agg(F.min("x"), F.max("x"), F.min("y"), F.max("y")).first()
    side = max(box[1] - box[0], box[3] - box[2]) or 1.0
    place = lambda c, least: F.least(F.floor((F.col(c) - least) / side * (1 << DEPTH)), F.lit((1 << DEPTH) - 1))
    at = spots.withColumns({"ux": place("x", box[0]), "uy": place("y", box[2])})
    level, full = 0, {}
    while level < DEPTH:
        cell = F.shiftleft(F.shiftright("ux", DEPTH - level), 26).bitwiseOR(F.shiftright("uy", DEPTH - level))
        found = at.groupBy(cell.alias("cell")).count().where(F.col("count") > block).collect()  # at most spots / block rows
        if not found:
            break
        full[level] = np.sort(np.array([r["cell"] for r in found], dtype=np.int64))
        level += 1

    def leaf(ux: pd.Series, uy: pd.Series) -> pd.Series:
        x, y = ux.to_numpy(np.int64), uy.to_numpy(np.int64)
        depth = np.zeros(len(x), np.int64)
        for k, cells in full.items():
            depth[(depth == k) & np.isin(x >> (DEPTH - k) << 26 | y >> (DEPTH - k), cells)] = k + 1
        return pd.Series(depth << 52 | x >> (DEPTH - depth) << 26 | y >> (DEPTH - depth))

    return at.withColumn("block", F.pandas_udf(leaf, "long")("ux", "uy")).drop("ux", "uy")


def _ancestor(block: Column, level: int) -> Column:
    up = F.greatest(F.shiftright(block, 52) - level, F.lit(0)).cast("int")
    column, row = F.shiftright(block, 26).bitwiseAND(F.lit((1 << 26) - 1)), block.bitwiseAND(F.lit((1 << 26) - 1))
    shifted = lambda v: F.call_function("shiftright", v, up)
    return F.call_function("shiftleft", F.least(F.shiftright(block, 52), F.lit(level)).cast("long"), F.lit(52)).bitwiseOR(F.call_function("shiftleft", shifted(column), F.lit(26))).bitwiseOR(shifted(row))


def _sides(boxes: pd.DataFrame) -> np.ndarray:
    """Rows x0, x1, y0, y1 of boxes."""
    return boxes[["x0", "x1", "y0", "y1"]].to_numpy(float).T


def _apart(one: np.ndarray, all_: np.ndarray, farthest: bool = False) -> np.ndarray:
    """Least (or greatest) distance between a box and each of many."""
    if farthest:
        return reach(np.maximum(all_[1] - one[0], one[1] - all_[0]), np.maximum(all_[3] - one[2], one[3] - all_[2]))
    right, above = np.maximum(all_[0] - one[1], one[0] - all_[1]), np.maximum(all_[2] - one[3], one[2] - all_[3])
    return reach(np.maximum(right, 0), np.maximum(above, 0))


def _dealt(rows: DataFrame, key: str) -> DataFrame:
    """Rows dealt to as many tasks as the session's shuffles have: few bytes, much work, so tasks are not to be put together by bytes."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def _to_box(x: Column, y: Column) -> Column:
    """Distance of a point to the box (x0, x1, y0, y1)."""
    gap = lambda v, a, b: F.greatest(F.col(a) - v, v - F.col(b), F.lit(0.0))
    return F.sqrt(gap(x, "x0", "x1") * gap(x, "x0", "x1") + gap(y, "y0", "y1") * gap(y, "y0", "y1"))


def _near(dist: Column, bound: Column) -> Column:
    """Within a bound, with room for rounding."""
    return dist <= bound * (1 + 1e-9)


def core_distances(spots: DataFrame, least: int) -> DataFrame:
    """Spots (pid, x, y, weight, block) with ``core``, the distance to the ``least``-th neighbour, copies counted."""
    spark = spots.sparkSession
    boxes = spots.groupBy("block").agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"), F.sum("weight").alias("weight")).toPandas()
    asked, sides, block, weights = [], _sides(boxes), boxes.block.to_numpy(), boxes.weight.to_numpy()
    for target, one in zip(block.tolist(), sides.T, strict=True):
        far = _apart(one, sides, farthest=True)
        # a block has one point at least: the nearest least + 2 blocks are enough
        few = np.argpartition(far, least + 1)[: least + 2] if len(far) > least + 2 else np.arange(len(far))
        order = few[np.argsort(far[few])]
        bound = float(far[order][np.searchsorted(np.cumsum(weights[order]), least + 1)])
        box = one.tolist()
        asked += [(target, b, bound, *box) for b in block[_apart(one, sides) <= bound * (1 + 1e-9)].tolist()]
    pairs = spark.createDataFrame(asked, "target long, block long, bound double, x0 double, x1 double, y0 double, y1 double")
    sent = spots.join(F.broadcast(pairs), "block").where(_near(_to_box(F.col("x"), F.col("y")), F.col("bound")))

    def kth(pdf: pd.DataFrame) -> pd.DataFrame:
        own = pdf[pdf.block == pdf.target]
        x, y, weight = (pdf[c].to_numpy() for c in ("x", "y", "weight"))
        core = np.empty(len(own))
        for i, (px, py) in enumerate(zip(own.x, own.y, strict=True)):
            d = reach(x - px, y - py)
            # the point itself is the first of its place; each place weighs one at least, so the nearest least + 1 are enough
            few = np.argpartition(d, least)[: least + 1] if len(d) > least + 1 else np.arange(len(d))
            order = few[np.argsort(d[few], kind="stable")]
            core[i] = d[order[np.searchsorted(np.cumsum(weight[order]), least + 1)]]
        return own[["pid", "x", "y", "weight", "block"]].assign(core=core)

    return _dealt(sent, "target").groupBy("target").applyInPandas(kth, "pid long, x double, y double, weight long, block long, core double")


# --- edges -------------------------------------------------------------------------------------------------------------------------------

_EDGE = "a long, ablock long, b long, bblock long, w double, lo long, hi long"


def _edges(pdf: pd.DataFrame, across: bool) -> pd.DataFrame:
    ids, block = pdf.pid.to_numpy(), pdf.block.to_numpy()
    tree = spanning_tree(ids, pdf.x.to_numpy(), pdf.y.to_numpy(), pdf.core.to_numpy())
    rows = [(ids[i], block[i], ids[j], block[j], w, min(ids[i], ids[j]), max(ids[i], ids[j])) for i, j, w in tree if not across or block[i] != block[j]]
    return pd.DataFrame(rows, columns=["a", "ablock", "b", "bblock", "w", "lo", "hi"])


def block_pairs(boxes: pd.DataFrame) -> list[tuple[int, int, float]]:
    """(row, row, bound) of the blocks that an edge of the spanning tree may join: none is longer than the bound.

    Blocks are joined in order of an upper bound: the distance of two of their spots, or the longest edge inside either. Where two sets of blocks
    meet at a bound, all their spots are connected by edges no longer, so no longer edge between them is needed.
    """
    n = len(boxes)
    x, y, core, inner = (boxes[c].to_numpy(float) for c in ("rx", "ry", "rcore", "inner"))
    # a spanning tree of the blocks' spots, lengths raised to the blocks' own longest edges
    raised = np.maximum(core, inner)
    edges = sorted((w, i, j) for i, j, w in spanning_tree(np.arange(n), x, y, raised))
    sides, of, sets = _sides(boxes), list(range(n)), {i: [i] for i in range(n)}
    out = []
    for w, i, j in edges:
        one, other = sorted((of[i], of[j]), key=lambda k: len(sets[k]))
        many = sides[:, sets[other]]
        for k in sets[one]:
            near = np.flatnonzero(_apart(sides[:, k], many) <= w * (1 + 1e-9))
            out += [(k, sets[other][m], w) for m in near]
        for k in sets[one]:
            of[k] = other
        sets[other] += sets.pop(one)
    return out


def candidate_edges(cored: DataFrame) -> DataFrame:
    """Edges among which the minimum spanning tree is; cored: (pid, x, y, weight, block, core)."""
    spark = cored.sparkSession
    inside = materialise(_dealt(cored, "block").groupBy("block").applyInPandas(lambda pdf: _edges(pdf, False), _EDGE))
    rep = F.min(F.struct("core", "pid", "x", "y"))
    boxes = cored.groupBy("block").agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"), rep.alias("r"))
    longest = inside.groupBy(F.col("ablock").alias("block")).agg(F.max("w").alias("inner"))
    known = boxes.join(longest, "block", "left").select("block", "x0", "x1", "y0", "y1", F.col("r.x").alias("rx"), F.col("r.y").alias("ry"), F.col("r.core").alias("rcore"), F.coalesce("inner", F.lit(0.0)).alias("inner")).toPandas()
    sides, block, boxed = [], known.block.tolist(), _sides(known).T.tolist()
    for k, (i, j, w) in enumerate(block_pairs(known)):
        sides += [(k, block[own], float(w), *boxed[other]) for own, other in ((i, j), (j, i))]
    if not sides:
        return inside
    pairs = spark.createDataFrame(sides, "pair long, block long, bound double, x0 double, x1 double, y0 double, y1 double")
    near = _near(_to_box(F.col("x"), F.col("y")), F.col("bound")) & _near(F.col("core"), F.col("bound"))
    met = cored.join(F.broadcast(pairs), "block").where(near).select("pair", "pid", "x", "y", "core", "block")
    return inside.unionByName(_dealt(met, "pair").groupBy("pair").applyInPandas(lambda pdf: _edges(pdf, True), _EDGE))


# --- the tree of clusters -----------------------------------------------------------------------------------------------------------------

_STATE = "kind string, g long, node long, other long, block long, w double, lo long, hi long, size long, cluster string, parent string, members array<long>"
_NEVER = (np.inf, 0, 0)


def join_components(pdf: pd.DataFrame, smallest: int) -> pd.DataFrame:
    """One block's components joined as far as its own edges settle it.

    Rows of kind n are components (w, lo, hi: the shortest edge out of the block, if any), rows of kind e edges inside. Given back: components left (n), edges between
    them (e), what each component has become (m), spots that joined a cluster (f) and clusters that joined (j), with the distance.
    """
    nodes, edges = pdf[pdf.kind == "n"], pdf[pdf.kind == "e"]
    at = {int(k): i for i, k in enumerate(nodes.node)}
    up = list(range(len(at)))
    ids, blocks, sizes = ([int(v) for v in nodes[c]] for c in ("node", "block", "size"))
    clusters = [c if isinstance(c, str) else None for c in nodes.cluster]
    members = [list(m) if m is not None else [] for m in nodes.members]
    away = [(w, lo, hi) if w == w else _NEVER for w, lo, hi in zip(nodes.w, nodes.lo, nodes.hi, strict=True)]
    out: list[tuple] = []

    def find(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    left = []
    for w, lo, hi, a, b in sorted(zip(edges.w, edges.lo, edges.hi, edges.node, edges.other, strict=True)):
        i, j, key = find(at[int(a)]), find(at[int(b)]), (w, lo, hi)
        if i == j:
            continue
        if key > away[i] or key > away[j]:
            # the shortest edge of one of the two leads elsewhere: neither may grow beyond this edge now
            away[i], away[j] = min(away[i], key), min(away[j], key)
            left.append((w, lo, hi, int(a), int(b)))
            continue
        if sizes[i] < sizes[j]:
            i, j = j, i
        both = sizes[i] + sizes[j]
        if clusters[i] and clusters[j]:
            new = f"{lo}:{hi}"
            out += [("j", None, None, None, w, None, None, None, clusters[k], new, None) for k in (i, j)]
            clusters[i] = new
        elif both >= smallest:
            # a small one joins a cluster, or two make one
            joining = members[j] + (members[i] if clusters[i] is None else [])
            clusters[i] = clusters[i] or f"{lo}:{hi}"
            out += [("f", p, None, None, w, None, None, None, clusters[i], None, None) for p in joining]
            members[i] = []
        else:
            members[i] = members[i] + members[j]
        sizes[i], away[i], members[j], up[j] = both, min(away[i], away[j]), [], i
    for k in range(len(ids)):
        r = find(k)
        out.append(("m", ids[k], ids[r], blocks[r], None, None, None, None, None, None, None))
        if r == k:
            out.append(("n", ids[k], None, blocks[k], None, None, None, sizes[k], clusters[k], None, members[k]))
    for w, lo, hi, a, b in left:
        i, j = find(at[a]), find(at[b])
        if i != j:
            out.append(("e", ids[i], ids[j], blocks[i], w, lo, hi, blocks[j], None, None, None))
    names = ["kind", "node", "other", "block", "w", "lo", "hi", "size", "cluster", "parent", "members"]
    frame = pd.DataFrame(out, columns=names).astype({c: "Int64" for c in ("node", "other", "block", "lo", "hi", "size")} | {"w": float})
    return frame.assign(g=pdf.g.iloc[0])[[c.split()[0] for c in _STATE.split(", ")]]


def cluster_tree(cored: DataFrame, edges: DataFrame, smallest: int, together: int = TOGETHER) -> tuple[DataFrame, DataFrame]:
    """(pid, cluster, w) of spots that joined a cluster, and (cluster, parent, w) of clusters that joined."""
    heavy = F.col("weight") >= smallest
    own = F.when(heavy, F.concat(F.lit("p"), F.col("pid").cast("string")))
    nodes = cored.select(F.col("pid").alias("node"), "block", F.col("weight").alias("size"), own.alias("cluster"), F.when(heavy, F.array().cast("array<long>")).otherwise(F.array("pid")).alias("members"))
    nodes, edges = materialise(nodes), materialise(edges)
    # copies at one place that are a cluster by themselves join it at their core distance
    falls = [cored.where(heavy).select("pid", own.alias("cluster"), F.col("core").alias("w"))]
    joins = []
    level = nodes.agg(F.max(F.shiftright("block", 52))).first()[0]
    while True:
        if nodes.count() <= together:
            level = 0
        ends = edges.withColumns({"ga": _ancestor(F.col("ablock"), level), "gb": _ancestor(F.col("bblock"), level)})
        local = ends.where("ga = gb").select(F.lit("e").alias("kind"), F.col("ga").alias("g"), F.col("a").alias("node"), F.col("b").alias("other"), "w", "lo", "hi")
        out = ends.where("ga <> gb")
        key = F.min(F.struct("w", "lo", "hi")).alias("away")
        away = out.select(F.col("a").alias("node"), "w", "lo", "hi").unionByName(out.select(F.col("b").alias("node"), "w", "lo", "hi")).groupBy("node").agg(key)
        comps = nodes.join(away, "node", "left").select(F.lit("n").alias("kind"), _ancestor(F.col("block"), level).alias("g"), "node", "block", "away.w", "away.lo", "away.hi", "size", "cluster", "members")
        rows = comps.unionByName(local, allowMissingColumns=True).withColumn("parent", F.lit(None).cast("string"))
        done = materialise(rows.groupBy("g").applyInPandas(lambda pdf: join_components(pdf, smallest), _STATE))
        falls.append(done.where("kind = 'f'").select(F.col("node").alias("pid"), "cluster", "w"))
        joins.append(done.where("kind = 'j'").select("cluster", "parent", "w"))
        if level == 0:
            break
        became = done.where("kind = 'm'").select("node", "other", "block")
        ends = out.select("a", "b", "w", "lo", "hi")
        for end in "ab":
            ends = ends.join(became.select(F.col("node").alias(end), F.col("other").alias(f"n{end}"), F.col("block").alias(f"{end}block")), end)
        ends = ends.select(F.col("na").alias("a"), "ablock", F.col("nb").alias("b"), "bblock", "w", "lo", "hi")
        kept = done.where("kind = 'e'").select(F.col("node").alias("a"), F.col("block").alias("ablock"), F.col("other").alias("b"), F.col("size").alias("bblock"), "w", "lo", "hi")
        edges = materialise(ends.unionByName(kept))
        nodes = done.where("kind = 'n'").select("node", "block", "size", "cluster", "members")
        level = max(level - LEVELS, 0)
    every = lambda parts: parts[0] if len(parts) == 1 else parts[0].unionByName(every(parts[1:]))
    return materialise(every(falls)), materialise(every(joins))


def chosen(clusters: pd.DataFrame) -> dict[str, str]:
    """The cluster chosen by stability for each cluster that is one or lies in one.

    Rows: cluster, parent (none at the top), w (where it joined its parent), n and rate: number and sum of 1/w of the spots that joined it.
    """
    parent = {c: p for c, p in zip(clusters.cluster, clusters.parent, strict=True) if isinstance(p, str)}
    joined = dict(zip(clusters.cluster, clusters.w, strict=True))
    n, rate = dict(zip(clusters.cluster, clusters.n, strict=True)), dict(zip(clusters.cluster, clusters.rate, strict=True))
    below: dict[str, list[str]] = defaultdict(list)
    for c, p in parent.items():
        below[p].append(c)
    tops = [c for c in clusters.cluster if c not in parent]
    order, stack = [], tops[:]
    while stack:
        c = stack.pop()
        order.append(c)
        stack += below[c]
    size = dict(n)
    kids: dict[str, list[str]] = {}
    split: dict[str, float] = {}
    for c in reversed(order):
        w = joined[below[c][0]] if below[c] else None
        # what joins at one distance joins at once; a cluster that joins another as it appears was never one
        found = [g for b in below[c] for g in (kids[b] if split[b] == w else [b]) if size[g]]
        kids[c], split[c] = found, w
        size[c] = n[c] + sum(size[k] for k in found)
        if len(found) == 1:
            only = found[0]
            n[c], rate[c], kids[c], split[c] = n[c] + n[only], rate[c] + rate[only], kids[only], split[only]
    def per(w: float) -> float:
        return 1.0 / max(w, LEAST_DISTANCE)

    # clusters as they are after the above, top down, with the distance at which each ends
    real, ends = [], {}
    stack = [(c, np.inf) for c in tops if size[c]]
    while stack:
        c, end = stack.pop()
        real.append(c)
        ends[c] = end
        stack += [(k, split[c]) for k in kids[c]]
    best: dict[str, float] = {}
    picked = set()
    for c in reversed(real):
        begun = 0.0 if ends[c] == np.inf else per(ends[c])
        own = rate[c] - n[c] * begun + sum(size[k] * (per(split[c]) - begun) for k in kids[c])
        inner = sum(best[k] for k in kids[c])
        if c in tops or inner > own:
            best[c] = inner
        else:
            best[c] = own
            picked.add(c)
    out: dict[str, str] = {}
    stack = [(c, None) for c in tops]
    real_ = set(real)
    while stack:
        c, of = stack.pop()
        of = of or (c if c in picked and c in real_ else None)
        if of:
            out[c] = of
        stack += [(k, of) for k in below[c]]
    return out


def hierarchical_clusters(points: DataFrame, id_col: str, least: int = 50, smallest: int = 50, x: str = "umap_x", y: str = "umap_y", block: int = BLOCK_POINTS, together: int = TOGETHER) -> DataFrame:
    """(id, label) of every point; -1 is noise."""
    here = points.select(id_col, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    known = ~(F.isnan("x") | F.isnan("y")) & F.col("x").isNotNull() & F.col("y").isNotNull()
    spots = materialise(here.where(known).groupBy("x", "y").agg(F.count("*").alias("weight")).withColumn("pid", F.monotonically_increasing_id()))
    sums = spots.agg(F.count("*").alias("spots"), F.sum("weight").alias("points")).first()
    if (sums["points"] or 0) <= max(2, smallest):
        return here.select(id_col, F.lit(-1).alias("label"))
    least = min(least, sums["points"] - 1)
    cored = materialise(core_distances(materialise(_blocks(spots, max(block, sums["spots"] // MOST_BLOCKS))), least))
    falls, joins = cluster_tree(cored, candidate_edges(cored), smallest, together)
    # a spot that joins a cluster where that ends belongs to the next one
    while not (late := falls.join(joins.select("cluster", "parent", F.col("w").alias("end")), "cluster").where("w >= end")).isEmpty():
        moved = falls.join(joins.select("cluster", "parent", F.col("w").alias("end")), "cluster", "left")
        falls = materialise(moved.select("pid", F.when(F.col("w") >= F.col("end"), F.col("parent")).otherwise(F.col("cluster")).alias("cluster"), "w"))
    weighed = falls.join(spots.select("pid", "weight"), "pid")
    sums_ = weighed.groupBy("cluster").agg(F.sum("weight").alias("n"), F.sum(F.col("weight") / F.greatest(F.col("w"), F.lit(LEAST_DISTANCE))).alias("rate"))
    named = joins.select("cluster").unionByName(joins.select(F.col("parent").alias("cluster"))).unionByName(falls.select("cluster")).distinct()
    rows = named.join(joins, "cluster", "left").join(sums_, "cluster", "left").select("cluster", "parent", "w", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("rate", F.lit(0.0)).alias("rate"))

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(list(chosen(pdf).items()), columns=["cluster", "choice"])

    choice = rows.withColumn("g", F.lit(0)).groupBy("g").applyInPandas(choose, "cluster string, choice string")
    labelled = here.join(spots.select("x", "y", "pid"), ["x", "y"], "left").join(falls.select("pid", "cluster"), "pid", "left").join(choice, "cluster", "left")
    labelled = materialise(labelled.select(id_col, "choice"))
    sizes = labelled.where("choice is not null").groupBy("choice").agg(F.count("*").alias("n"), F.min(id_col).alias("first"))
    # one row a cluster
    numbered = sizes.select("choice", (F.row_number().over(Window.orderBy(F.col("n").desc(), "first")) - 1).alias("label"))
    return labelled.join(numbered, "choice", "left").select(id_col, F.coalesce("label", F.lit(-1)).alias("label"))
