"""Filter interaction audit: what each filter removes in every order of the filters, by adjacent transpositions.

Each row gets a mask of the filters that it fails. Rows are counted by part and mask before anything is ordered, so an order is never applied to
rows: a step's figures are sums over the 2^k mask cells of a part. The orders are visited by single swaps of neighbours; a swap changes the
figures of the two swapped steps alone, and a filter's Shapley value is what it removes, summed along the walk.

The filter for copies looks at the whole table: a row fails it if a row with the same text has a smaller id. Texts are compared by SHA-256.
Copies are counted by (text, part, label) before they meet, so a group of any size is a few rows.

Defined results: a null text counts as empty; an empty text has no words, so it fails A alone, and E if it is not the first of its kind; a row without an id
is never a copy, makes none of another and has no label; rows alike in text and id are not copies of each other; a label that stands in several rows holds
if it holds in one of them; a null part counts with the empty string; an empty table has no part and gives no rows. Columns are read by name, so
extra columns of any name do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bind, materialise, table, words

CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: The filter that compares rows with each other.
COPIES = "E"
FIGURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
RESULT = "part string, filter_order string, step int, " + ", ".join(f"{f} long" for f in FIGURES)


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions that a text settles by itself, by the filter's letter."""
    w, chars = words(text), F.length(text)
    counts = bind(w, lambda x: F.struct(F.size(x).alias("all"), F.size(F.array_distinct(x)).alias("distinct")))
    capitals = chars - F.length(F.translate(text, CAPITALS, ""))
    return {"AB": bind(counts, lambda n: F.when(n["all"] < 100, 1).otherwise(0) + F.when(100 * n["distinct"] < 80 * n["all"], 2).otherwise(0)),
            "C": F.when(100 * capitals > 10 * chars, 4).otherwise(0), "D": F.when(text.rlike("[#$%&*|]"), 8).otherwise(0)}


def masked(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """Rows counted: (part, mask, n, good, toxic), at most one row a part and mask. Bit i of the mask stands for the i-th letter of ABCDE."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"), text.alias("text"))
    found = found.select("id", "part", F.unhex(F.sha2(F.encode("text", "UTF-8"), 256)).alias("h"), sum(text_filters(F.col("text")).values()).cast("int").alias("mask"))
    # rows without an id have no label: a salt keeps them from meeting in one task
    salt = F.when(F.col("id").isNull(), F.xxhash64("h")).otherwise(F.lit(0))
    known = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    # repeated rows become one before they meet their label
    once = found.groupBy("id", "h", "part", "mask").agg(F.count("*").alias("n")).withColumn("salt", salt)
    labelled = once.join(known.withColumn("salt", F.lit(0).cast("long")), ["id", "salt"], "left")
    has_id = F.col("id").isNotNull()
    group = labelled.groupBy("h", "part", "mask", "good", "toxic").agg(F.sum("n").alias("n"), F.sum(F.when(has_id, 0).otherwise(F.col("n"))).alias("loose"), F.min(F.when(has_id, F.struct("id", "n"))).alias("first"))
    group = materialise(group)
    first = group.groupBy("h").agg(F.min("first.id").alias("least"))
    own = F.when(F.col("first.id") == F.col("least"), F.col("first.n")).otherwise(0)
    split = group.join(first, "h").withColumn("passes", F.coalesce(F.col("loose"), F.lit(0)) + F.coalesce(own, F.lit(0)))
    bit = 1 << "ABCDE".index(COPIES)
    rows = split.select("part", "good", "toxic", F.inline(F.array(F.struct(F.col("mask").alias("mask"), F.col("passes").alias("n")), F.struct((F.col("mask") + bit).alias("mask"), (F.col("n") - F.col("passes")).alias("n")))))
    lost = lambda c: F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(c)
    return rows.groupBy("part", "mask").agg(F.sum("n").alias("n"), lost("good"), lost("toxic"))


def swaps(k: int) -> Iterator[int]:
    """Places of the neighbours to swap (i with i + 1) so that all k! orders are visited, each once: k! - 1 swaps.

    The largest element runs through an order of the rest from one end to the other, then the rest makes its next swap, and so on.
    """
    if k < 2:
        return
    rest, down = swaps(k - 1), True
    while True:
        yield from range(k - 2, -1, -1) if down else range(k - 1)
        if (at := next(rest, None)) is None:
            return
        yield at + 1 if down else at
        down = not down


class Cells:
    """A part's mask cells: counts by mask of rows, of good and of toxic ones."""

    def __init__(self, k: int, masks: Sequence[int], counts: np.ndarray):
        self.masks = np.arange(1 << k)
        self.counts = np.zeros((1 << k, 3), dtype=np.int64)
        np.add.at(self.counts, np.asarray(masks, dtype=np.int64), counts)

    def step(self, before: int, bit: int) -> tuple[int, ...]:
        """(kept, removed, redundant, unique_fails, good_lost, toxic_lost) of the filter ``bit`` after the filters ``before``."""
        fails, gone = self.masks & bit > 0, self.masks & before > 0
        n, removed = self.counts[:, 0], self.counts[fails & ~gone].sum(axis=0)
        return int(n[~fails & ~gone].sum()), int(removed[0]), int(n[fails & gone].sum()), int(n[bit]), int(removed[1]), int(removed[2])


def walk(letters: str, masks: Sequence[int], counts: np.ndarray) -> list[tuple]:
    """(filter_order, step, figures ..., shapley) of every order: each order differs from the last by one swap, and two steps are computed anew."""
    k = len(letters)
    cells, order = Cells(k, masks, counts), list(range(k))
    before = [sum(1 << i for i in order[:at]) for at in range(k)]
    steps = [cells.step(before[at], 1 << order[at]) for at in range(k)]
    visited: list[tuple[str, list[int], list[tuple]]] = []
    total = [0] * k

    def visit() -> None:
        visited.append(("".join(letters[i] for i in order), order[:], steps[:]))
        for at, i in enumerate(order):
            total[i] += steps[at][1]

    visit()
    for at in swaps(k):
        order[at], order[at + 1] = order[at + 1], order[at]
        before[at + 1] = before[at] | 1 << order[at]
        steps[at], steps[at + 1] = cells.step(before[at], 1 << order[at]), cells.step(before[at + 1], 1 << order[at + 1])
        visit()
    return [(name, at + 1, *figures[at], total[i]) for name, own, figures in visited for at, i in enumerate(own)]


def audit(cells: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """One row a part, order and step, from mask cells (part, mask, n, good, toxic); a part is at most 2^k rows in its task."""

    def of(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = walk(letters, pdf["mask"].tolist(), pdf[["n", "good", "toxic"]].to_numpy(dtype=np.int64))
        return pd.DataFrame([(pdf["part"].iloc[0], *r) for r in rows], columns=["part", "filter_order", "step", *FIGURES])

    return cells.groupBy("part").applyInPandas(of, RESULT)


def op11_filter_audit(spark, sf_dir: str) -> DataFrame:
    return audit(masked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


ORACLE_SQL = r"""
WITH facts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
marks AS (SELECT doc_id AS of, max(coalesce(quality = 1, false)) AS good, max(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
failing AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         (CASE WHEN len(w) < 100 THEN ['A'] ELSE [] END) || (CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN ['B'] ELSE [] END)
         || (CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN ['C'] ELSE [] END)
         || (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN ['D'] ELSE [] END)
         || (CASE WHEN coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) THEN ['E'] ELSE [] END) AS fails
  FROM facts LEFT JOIN marks ON of = doc_id),
cells AS (SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM failing GROUP BY part, fails),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
  SELECT [a.f, b.f, c.f, d.f, e.f] AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (SELECT array_to_string(o, '') AS filter_order, step, o[step] AS f, o[1:step - 1] AS earlier FROM orders, (SELECT unnest(range(1, 6)) AS step)),
counted AS (
  SELECT part, filter_order, step::INT AS step, f,
         sum(CASE WHEN NOT list_contains(fails, f) AND NOT list_has_any(fails, earlier) THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN list_contains(fails, f) AND NOT list_has_any(fails, earlier) THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN list_contains(fails, f) AND list_has_any(fails, earlier) THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN fails = [f] THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN list_contains(fails, f) AND NOT list_has_any(fails, earlier) THEN good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN list_contains(fails, f) AND NOT list_has_any(fails, earlier) THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM steps, cells GROUP BY part, filter_order, step, f)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM counted
"""
