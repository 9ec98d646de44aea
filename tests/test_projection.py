from pathlib import Path

import numpy as np
import pytest

from paperloom.operators import clusters as C
from paperloom.operators import projection as P

DATA = Path("/root/testdata/sf0.001/embeddings.parquet")


@pytest.fixture(scope="module")
def made(spark):
    """Vectors of eight directions in 24 dimensions, with copies and noise."""
    r = np.random.default_rng(3)
    centres = r.normal(size=(8, 24))
    rows = [(f"v{i:04d}", [float(x) for x in centres[i % 8] + 0.35 * r.normal(size=24)]) for i in range(1200)]
    rows += [("copy", rows[0][1]), ("zero", [0.0] * 24), ("none", None), (None, rows[1][1]), ("copy", rows[0][1])]
    return spark.createDataFrame(rows, "id string, embedding array<float>")


def trust(vectors, points, k=15):
    """Share kept of what is near in the plane being near among the vectors."""
    v = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    n = len(v)
    rank = (1 - v @ v.T + np.eye(n) * -9).argsort(axis=1).argsort(axis=1)
    d = ((points[:, None] - points[None]) ** 2).sum(-1) + np.eye(n) * 1e18
    near = d.argsort(axis=1)[:, :k]
    late = np.maximum(np.take_along_axis(rank, near, 1) - k, 0).sum()
    return 1 - 2 * late / (n * k * (2 * n - 3 * k - 1))


def test_neighbours(spark, made):
    units = P.materialise(P.unit_vectors(made, "id", "embedding"))
    assert units.count() == 1201
    graph = P.neighbour_graph(units, 15, trees=3, leaf=60)
    assert {r["n"] for r in graph.select(P.F.size("near").alias("n")).distinct().collect()} == {15}
    exact = P.exact_neighbours(units, units, 15)
    v = np.array([r["v"] for r in units.orderBy("id").collect()])
    d = np.round(1 - v @ v.T, 7) + np.eye(len(v)) * 9
    plain = np.sort(d, axis=1)[:, :15]
    assert np.allclose([[x["distance"] for x in r["near"]] for r in exact.orderBy("id").collect()], plain, atol=2e-7)
    assert P.recall(graph, exact) >= 0.9
    assert graph.where("id = 'copy'").first()["near"][0]["neighbour"] == "v0000"


def test_weights(spark, made):
    units = P.unit_vectors(made, "id", "embedding").limit(200)
    graph = P.neighbour_graph(P.materialise(units), 10)
    edges = P.fuzzy_edges(graph)
    w = {(r["a"], r["b"]): r["w"] for r in edges.collect()}
    assert all(abs(w[b, a] - x) < 1e-12 and 0 < x <= 1 + 1e-9 for (a, b), x in w.items())
    # a vector's weights towards its neighbours sum to log2(k) before the directions join
    near = graph.first()
    assert sum(w.get((near["id"], x["neighbour"]), 0) for x in near["near"]) >= np.log2(10) - 0.01


def test_curve():
    a, b = P.curve(0.1)
    assert abs(a - 1.577) < 0.03
    assert abs(b - 0.895) < 0.02


@pytest.mark.skipif(not DATA.exists(), reason="no test tables")
def test_plane_keeps_neighbours_better_than_components(spark):
    vectors = spark.read.parquet(str(DATA))
    ours = P.materialise(P.neighbour_plane(vectors, "vec_id"))
    again = P.neighbour_plane(vectors.repartition(7), "vec_id")
    assert ours.exceptAll(again).isEmpty()
    rows = vectors.join(ours, "vec_id").join(C.plane(vectors, "vec_id").withColumnsRenamed({"umap_x": "px", "umap_y": "py"}), "vec_id").collect()
    v = np.array([r["embedding"] for r in rows], float)
    by = {k: trust(v, np.array([(r[f"{k}x"], r[f"{k}y"]) for r in rows])) for k in ("umap_", "p")}
    print(by)
    assert by["umap_"] > by["p"]


def test_odd_tables(spark, made):
    assert P.neighbour_plane(made.limit(0), "id").count() == 0
    two = made.where("id in ('v0001', 'v0002', 'zero', 'none')")
    assert sorted(tuple(r) for r in P.neighbour_plane(two, "id").collect()) == [("v0001", 0.0, 0.0), ("v0002", 0.0, 0.0)]
    few = made.where("id < 'v0005'").collect()
    out = P.neighbour_plane(spark.createDataFrame(few, made.schema), "id")
    assert out.count() == len({r["id"] for r in few if r["id"] and r["embedding"] and any(r["embedding"])})


def test_blocks_do_not_change_the_graph(spark, made, monkeypatch):
    """Whatever the blocks, each gets a vector once, and the graph is the same."""
    units = P.materialise(P.unit_vectors(made, "id", "embedding"))
    rows = lambda graph: sorted((r["id"], [tuple(x) for x in r["near"]]) for r in graph.collect())
    one = rows(P.neighbour_graph(units, 10, trees=2, leaf=40, descents=2))
    for limits in ({"HELD": 30 * 24 * 40}, {"LEAST_SHARE": 100, "SHARES": 12, "PAIRS": 50}):
        for name, value in limits.items():
            monkeypatch.setattr(P, name, value)
        assert rows(P.neighbour_graph(units, 10, trees=2, leaf=40, descents=2)) == one
    r = np.random.default_rng(1)
    held = P.pd.DataFrame({"id": np.arange(50), "given": list(r.normal(size=(50, 6))), "norm": 1.0, "farthest": 3.0})
    lists = P.pd.DataFrame({"members": [np.arange(30), np.arange(20, 50), np.array([7])]})
    found = P._compared(lists, held, 4)
    m = np.array(list(held["given"]))
    d = P._distances(m) + np.eye(50) * 9
    d[:20, 30:], d[30:, :20] = 9, 9
    nearest = found.groupby("id")["distance"].apply(list)
    assert all(np.allclose(sorted(nearest[i]), np.sort(d[i])[:4], atol=2e-7) for i in range(50))


def test_rounds_move_positions_and_not_edges(spark, made):
    units = P.materialise(P.unit_vectors(made, "id", "embedding")).limit(300)
    edges = P.materialise(P.fuzzy_edges(P.neighbour_graph(P.materialise(units), 8, descents=1)))
    near, needs, degree = P.spread(edges)
    assert near.count() == edges.count() and near.select("a", "b", "w").exceptAll(edges).isEmpty()
    ends = edges.select(P.F.col("a").alias("id")).distinct().count()
    assert needs.count() == needs.distinct().count() and needs.select("id").distinct().count() == degree.count() == ends
    at = degree.select("id", P.F.lit(1.0).alias("x"), P.F.lit(2.0).alias("y"))
    step = near.select("g", "a", "b", "even").groupBy("g").cogroup(P._placed(needs, at)).applyInPandas(P._power, "id string, x double, y double")
    assert step.count() == ends
    plan = step._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0]
    assert "FlatMapCoGroupsInPandas" in plan and "Exchange hashpartitioning(g" not in plan
    near.unpersist()
    needs.unpersist()


def test_halves_are_rounded_as_spark_rounds_them(spark):
    values = [0.5, -0.5, 1.5, 2.5, -2.5, 0.49999999999999994, 4503599627370495.5, -3.2, 7.0, 0.0]
    ours = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").orderBy("i").select(P.F.round("v").cast("long")).collect()
    assert P._half_up(np.array(values)).tolist() == [r[0] for r in ours]
