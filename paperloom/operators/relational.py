"""Relational operators that the models share. None collects; each is one plan to Catalyst."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _columns(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def first_per_key(df: DataFrame, keys: str | Sequence[str], order: Sequence[Column], most: int = 1) -> DataFrame:
    """The first ``most`` rows of each key in ``order`` (give a total order: ties are settled by nothing else)."""
    n = F.row_number().over(Window.partitionBy(*_columns(keys)).orderBy(*order))
    return df.withColumn("__n", n).where(F.col("__n") <= most).drop("__n")


def ranked(df: DataFrame, keys: str | Sequence[str], order: Sequence[Column], name: str = "rnk") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*_columns(keys)).orderBy(*order)))


def keep_first_by_priority(layers: Sequence[DataFrame], keys: Sequence[str], tie: Sequence[str]) -> DataFrame:
    """Union of ``layers``, each key's row from the earliest layer that has it; ``tie`` orders rows inside a layer."""
    tagged = [x.withColumn("__layer", F.lit(i)) for i, x in enumerate(layers)]
    every = reduce(lambda a, b: a.unionByName(b), tagged)
    return first_per_key(every, keys, [F.col("__layer"), *[F.col(c).asc_nulls_last() for c in tie]]).drop("__layer")


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """Planned as TakeOrderedAndProject: each task keeps k rows."""
    return df.orderBy(*order).limit(k)


def ordered_list(order: Sequence[Column], value: Column) -> Column:
    """Aggregate: values as an array in ascending ``order``."""
    fields = [c.alias(f"o{i}") for i, c in enumerate(order)]
    return F.transform(F.array_sort(F.collect_list(F.struct(*fields, value.alias("v")))), lambda r: r["v"])


def ordered_string(order: Sequence[Column], value: Column, separator: str = ", ") -> Column:
    return F.array_join(ordered_list(order, value), separator)


def ratio(a: Column, b: Column, digits: int | None = None) -> Column:
    """Double quotient, null over zero; never a decimal."""
    out = a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0))
    return out if digits is None else F.round(out, digits)


def reported(value: Column, size: Column, least: int) -> Column:
    """``value`` where ``size`` reaches ``least``, else null."""
    return F.when(F.coalesce(size, F.lit(0)) >= least, value)


def concentration(df: DataFrame, group: str | Sequence[str], entity: str, digits: int = 4) -> DataFrame:
    """Herfindahl index of ``entity`` in each group over rows that have one, with the counts beside.

    Counts are made per (group, entity) first, so the second step sees a row an entity and no self-join is needed.
    """
    keys = _columns(group)
    counts = df.groupBy(*keys, entity).agg(F.count("*").alias("n"))
    known = F.col(entity).isNotNull()
    sums = counts.groupBy(*keys).agg(
        F.sum("n").alias("total"),
        F.sum(F.when(known, F.col("n"))).alias("resolved"),
        F.sum(F.when(~known, F.col("n"))).alias("unresolved"),
        F.count(F.when(known, 1)).alias("n_entities"),
        F.sum(F.when(known, F.col("n").cast("double") * F.col("n"))).alias("squares"),
    )
    return sums.withColumn("hhi", F.round(F.col("squares") / (F.col("resolved").cast("double") * F.col("resolved")), digits)).drop("squares")


def year_spine(series: Sequence[tuple[DataFrame, str]], keys: Sequence[str]) -> DataFrame:
    """Count series (frame, count column) side by side over the union of their keys; absent counts are 0."""
    stacked = [x.select(*keys, *[(F.col(name) if name == own else F.lit(None)).cast("long").alias(name) for _, name in series]) for x, own in series]
    every = reduce(lambda a, b: a.unionByName(b), stacked)
    return every.groupBy(*keys).agg(*[F.coalesce(F.max(name), F.lit(0)).alias(name) for _, name in series])


def semi(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(key), key, "left_semi")


def not_in(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among non-null ``ids``; rows without a key go, as under SQL's NOT IN, unless ids are empty."""
    given = ids.select(F.col(key).alias("__id")).where("__id is not null")
    return df.join(given, F.col(key) == F.col("__id"), "left_anti")


def within(scope: dict[str, Sequence[str] | None]) -> Column:
    """Conjunction of value lists by column; an empty or absent list restricts nothing."""
    return reduce(lambda a, b: a & b, [F.col(c).isin(*v) for c, v in scope.items() if v], F.lit(True))


def contains_ignoring_case(value: Column, query: str, escape: bool = False) -> Column:
    """ILIKE '%query%'; ``%`` and ``_`` in the query act as wild cards unless ``escape``."""
    if escape:
        query = query.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return value.ilike(f"%{query}%")


def precision_recall(found: DataFrame, gold: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: true and false positives, false negatives, precision and recall (0 where undefined)."""
    f, g = found.select(*keys).distinct().withColumn("f", F.lit(1)), gold.select(*keys).distinct().withColumn("g", F.lit(1))
    both = f.join(g, list(keys), "full").agg(
        F.count(F.when(F.col("f").isNotNull() & F.col("g").isNotNull(), 1)).alias("true_positives"),
        F.count(F.when(F.col("f").isNotNull() & F.col("g").isNull(), 1)).alias("false_positives"),
        F.count(F.when(F.col("f").isNull() & F.col("g").isNotNull(), 1)).alias("false_negatives"),
    )
    t = F.col("true_positives")
    return both.withColumn("precision", F.coalesce(ratio(t, t + F.col("false_positives")), F.lit(0.0))).withColumn("recall", F.coalesce(ratio(t, t + F.col("false_negatives")), F.lit(0.0)))


def signature(df: DataFrame, id_col: str, digits: int = 16) -> DataFrame:
    """One row: digest of the distinct ids, whatever their order.

    Ids are dealt to 4096 buckets by the first digits of their md5; a bucket's digest is that of its ids in order, and the
    signature that of the buckets' digests in order. So no row holds more than a bucket's ids.
    """
    ids = df.select(F.col(id_col).cast("string").alias("id")).where("id is not null").distinct()
    buckets = ids.groupBy(F.substring(F.md5("id"), 1, 3).alias("bucket")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list("id")), "\n"), 256).alias("digest"))
    digests = F.transform(F.array_sort(F.collect_list(F.struct("bucket", "digest"))), lambda x: x["digest"])  # 4096 at most
    return buckets.agg(F.substring(F.sha2(F.array_join(digests, ""), 256), 1, digits).alias("signature"))
