"""Links between numbered nodes: forests inside a worker, components across the cluster, and sorted cells read in portions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

#: Links to a part of a checkpoint, about.
LINKS_A_PART = 500_000


def merge(roots: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the trees of each a and b; roots point to smaller or equal positions."""
    while len(a):
        a, b = roots[a], roots[b]
        differ = a != b
        low, high = np.minimum(a, b)[differ], np.maximum(a, b)[differ]
        np.minimum.at(roots, high, low)
        while (roots != (up := roots[roots])).any():
            roots[:] = up
        a, b = low, high


def spanning(n: int, a: np.ndarray, b: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Which edges (a, b) of weight d make a minimum spanning forest of n nodes; ties go by a, then b."""
    order = np.lexsort((b, a, d))
    a, b = a[order], b[order]
    roots, alive, chosen = np.arange(n), np.arange(len(a)), []
    while True:
        x, y = roots[a[alive]], roots[b[alive]]
        alive, x, y = alive[x != y], x[x != y], y[x != y]
        if not len(alive):
            return order[np.concatenate(chosen)] if chosen else np.zeros(0, dtype=np.int64)
        best = np.full(n, len(a))
        np.minimum.at(best, x, alive)
        np.minimum.at(best, y, alive)
        picked = np.unique(best[best < len(a)])
        chosen.append(picked)
        merge(roots, a[picked], b[picked])


def portions(batches: Iterator[pd.DataFrame], keys: list[str], most: int | None = None) -> Iterator[tuple[pd.DataFrame, int | None]]:
    """Rows sorted by ``keys`` as (whole cells, None), or as (a chunk, its number) of a cell of more than ``most`` rows.

    A portion holds ``most`` rows and a batch at most.
    """
    held: list[pd.DataFrame] = []  # of the cell that is not over yet
    last, chunks = None, 0

    def ended() -> Iterator[tuple[pd.DataFrame, int | None]]:
        if held:
            yield pd.concat(held, ignore_index=True), chunks or None
            held.clear()

    for batch in batches:
        if not len(batch):
            continue
        columns = [batch[k].to_numpy() for k in keys]
        new = np.zeros(len(batch), dtype=bool)
        for k, c in enumerate(columns):
            new[1:] |= c[1:] != c[:-1]
            new[0] |= last is None or c[0] != last[k]
        last = [c[-1] for c in columns]
        starts = np.flatnonzero(new)
        if not len(starts):
            held.append(batch)
        else:
            if starts[0]:
                held.append(batch.iloc[: starts[0]])
            yield from ended()
            chunks = 0
            if starts[0] < starts[-1]:
                yield batch.iloc[starts[0] : starts[-1]].reset_index(drop=True), None
            held.append(batch.iloc[starts[-1] :])
        if most is not None and sum(map(len, held)) > most:
            whole = pd.concat(held, ignore_index=True)
            held.clear()
            while len(whole) > most:
                yield whole.iloc[:most].reset_index(drop=True), chunks
                whole, chunks = whole.iloc[most:], chunks + 1
            held.append(whole)
    yield from ended()


def _stars(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The links (a, b) of one part as (node, root): each node with the smallest that it reaches there, itself included."""
    held = [x for x in batches if len(x)]
    if held:
        a, b = (np.concatenate([x[k].to_numpy() for x in held]) for k in "ab")
        nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        roots = np.arange(len(nodes))
        merge(roots, at[: len(a)], at[len(a) :])
        yield pd.DataFrame({"node": nodes, "root": nodes[roots]})


def components(edges: DataFrame, links_a_part: int = LINKS_A_PART) -> DataFrame:
    """(node, root): each node of ``edges`` (a, b) with the smallest node that it reaches.

    Links are merged inside parts of about ``links_a_part``; one part is the whole answer. Of more, the parts' stars are joined: labels spread
    to neighbours and then jump to their label's label; each round is checkpointed.
    """
    edges = materialise(edges.where("a <> b").select("a", "b").distinct())
    parts = 1 + edges.count() // links_a_part
    dealt = edges.coalesce(1) if parts == 1 else edges.repartition(parts, "a")
    stars = materialise(dealt.mapInPandas(_stars, "node bigint, root bigint"))
    if parts == 1:
        return stars
    both = stars.select(F.inline(F.array(F.struct(F.col("node").alias("a"), F.col("root").alias("b")), F.struct(F.col("root").alias("a"), F.col("node").alias("b"))))).distinct()
    both = materialise(both)
    labels = materialise(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")))
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        step = labels.join(near, "node").select("node", F.least("root", "near").alias("to"), F.col("root").alias("was"))
        ahead = labels.select(F.col("node").alias("to"), F.col("root").alias("further"))
        labels = materialise(step.join(ahead, "to").select("node", F.least("to", "further").alias("root"), "was"))
        if labels.where("root <> was").isEmpty():
            return labels.select("node", "root")
        labels = labels.select("node", "root")
