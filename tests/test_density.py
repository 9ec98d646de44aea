import numpy as np
import pytest

from paperloom.operators import density as D


def plain(points, least, smallest):
    """Labels of all points by the definition: every pair's distance, thresholds one after the other, clusters that split."""
    p = np.asarray(points, float)
    n = len(p)
    d = np.sqrt(((p[:, None] - p[None]) ** 2).sum(-1))
    core = np.sort(d, axis=1)[:, least]
    m = np.maximum(d, np.maximum(core[:, None], core[None]))
    # a spanning tree has all thresholds at which components meet
    inside, best, other, tree = np.zeros(n, bool), m[0].copy(), np.zeros(n, int), []
    inside[0] = True
    for _ in range(n - 1):
        j = int(np.where(inside, np.inf, best).argmin())
        tree.append((best[j], j, other[j]))
        inside[j] = True
        closer = m[j] < best
        best[closer], other[closer] = m[j][closer], j
    comp = {i: ({i}, None) for i in range(n)}  # root: members, cluster
    of = list(range(n))
    clusters = []  # dict(kids, born, falls)
    for w in sorted({t[0] for t in tree}):
        groups = {}
        link = {}

        def find(i, link=link):
            while link.get(i, i) != i:
                i = link[i]
            return i

        for v, i, j in tree:
            if v == w:
                link[find(of[i])] = find(of[j])
        for r in list(comp):
            groups.setdefault(find(r), []).append(r)
        for root, parts in groups.items():
            if len(parts) == 1:
                continue
            members = set().union(*(comp[r][0] for r in parts))
            big = [comp[r][1] for r in parts if comp[r][1] is not None]
            small = [i for r in parts if comp[r][1] is None for i in comp[r][0]]
            cluster = None
            if len(members) >= smallest:
                if len(big) == 1:
                    cluster = big[0]
                else:
                    clusters.append({"kids": big, "split": w, "falls": [], "size": 0, "top": np.inf})
                    cluster = len(clusters) - 1
                    for b in big:
                        clusters[b]["top"] = w
                clusters[cluster]["falls"] += [(i, w) for i in small]
                clusters[cluster]["size"] = len(members)
            for r in parts:
                del comp[r]
            comp[root] = (members, cluster)
            for i in members:
                of[i] = root
    per = lambda w: 1 / max(w, D.LEAST_DISTANCE)
    score, pick = {}, set()
    for k, c in enumerate(clusters):
        born = 0 if c["top"] == np.inf else per(c["top"])
        own = sum(per(w) - born for _, w in c["falls"]) + sum(clusters[b]["size"] * (per(c["split"]) - born) for b in c["kids"])
        inner = sum(score[b] for b in c["kids"])
        if c["top"] == np.inf or inner > own:
            score[k] = inner
        else:
            score[k] = own
            pick.add(k)
    label = [None] * n

    def mark(k, chosen):
        chosen = k if chosen is None and k in pick else chosen
        for i, _ in clusters[k]["falls"]:
            label[i] = chosen
        for b in clusters[k]["kids"]:
            mark(b, chosen)

    for k, c in enumerate(clusters):
        if c["top"] == np.inf:
            mark(k, None)
    names = {}
    for k in set(label) - {None}:
        names[k] = (-label.count(k), label.index(k))
    order = {k: i for i, k in enumerate(sorted(names, key=names.get))}
    return [order.get(k, -1) for k in label]


def found(spark, points, least, smallest, **options):
    df = spark.createDataFrame([(i, float(x), float(y), "c") for i, (x, y) in enumerate(points)], "id long, umap_x double, umap_y double, cluster string")
    return [r["label"] for r in D.hierarchical_clusters(df, "id", least, smallest, **options).orderBy("id").collect()]


def unlike(seed, n=2000):
    """Clusters of unlike density, one inside a sparse one, with noise."""
    r = np.random.default_rng(seed)
    parts = [r.normal((0, 0), 0.05, (n // 4, 2)), r.normal((2, 2), 0.6, (n // 4, 2)), r.normal((6, 0), 1.5, (n // 5, 2)), r.normal((6.2, 0.4), 0.04, (n // 10, 2))]
    rest = n - sum(map(len, parts))
    return np.concatenate([*parts, r.uniform(-4, 12, (rest, 2))])


@pytest.mark.parametrize("together", [D.TOGETHER, 40])
def test_unlike_densities(spark, together):
    points = unlike(1)
    labels = plain(points, 50, 50)
    assert len(set(labels)) > 3
    assert found(spark, points, 50, 50, block=150, together=together) == labels


def test_ties_and_copies(spark):
    r = np.random.default_rng(4)
    grid = r.integers(0, 12, (500, 2)).astype(float)
    points = np.concatenate([grid, grid[:80] + 40, np.repeat([[100.0, 100.0]], 30, 0), np.repeat([[5.0, 5.0]], 30, 0)])
    for least, smallest in ((5, 10), (3, 25), (12, 6)):
        assert found(spark, points, least, smallest, block=40, together=10) == plain(points, least, smallest)


def test_lines_and_small_clusters(spark):
    points = [(i, 0) for i in range(60)] + [(i * 0.1, 50) for i in range(60)] + [(i * i, 90) for i in range(30)]
    assert found(spark, points, 3, 5, block=8, together=5) == plain(points, 3, 5)


def test_odd_tables(spark):
    kinds = "id long, umap_x double, umap_y double, cluster string"
    none = spark.createDataFrame([], kinds)
    assert D.hierarchical_clusters(none, "id").count() == 0
    rows = [(1, None, 1.0, "a"), (2, float("nan"), 1.0, "b"), (3, 1.0, 1.0, "c"), (4, 2.0, 1.0, None)]
    assert {r["label"] for r in D.hierarchical_clusters(spark.createDataFrame(rows, kinds), "id").collect()} == {-1}
    assert set(found(spark, [(1.0, 1.0)] * 300, 5, 5)) == {-1}


def test_no_task_has_all_points(spark, monkeypatch):
    """Blocks, pairs of blocks and blocks joined hold a share of the points."""
    points = unlike(7)
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(points)], "id long, x double, y double")
    spots = df.groupBy("x", "y").agg(D.F.count("*").alias("weight")).withColumn("pid", D.F.monotonically_increasing_id())
    blocks = D.materialise(D._blocks(D.materialise(spots), 100))
    assert blocks.groupBy("block").count().agg({"count": "max"}).first()[0] <= 100
    cored = D.materialise(D.core_distances(blocks, 20))
    edges = D.candidate_edges(cored).count()
    assert cored.count() == len(points)
    assert edges < 3 * len(points)


def test_components_go_up_some_levels_at_once(spark, monkeypatch):
    seen, ancestor = set(), D._ancestor
    monkeypatch.setattr(D, "_ancestor", lambda block, level: seen.add(level) or ancestor(block, level))
    points = unlike(5, 1200)
    assert found(spark, points, 20, 20, block=40, together=10) == plain(points, 20, 20)
    assert max(seen) >= 4
    assert len(seen) <= max(seen) // 2 + 2


def test_blocks_are_dealt_to_all_tasks(spark):
    """Blocks have few bytes and much work: adaptive execution does not put them into one task."""
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(unlike(7, 400))], "pid long, x double, y double")
    blocks = D.materialise(D._blocks(D.materialise(df.withColumn("weight", D.F.lit(1).cast("long"))), 40))
    assert D.core_distances(blocks, 5).rdd.getNumPartitions() == 4
