"""Mixing sources to target weights by capped water-filling; DataFrame functions only.

The budget (``share`` times all words) goes to the sources by weight. A source whose part passes ``epochs``
times its words is clamped there and the excess is shared again by weight, until no source is above. In
ascending order of cap over weight the clamped sources are a prefix, so one pass of running sums finds the level.

A source then takes each of its documents a whole number of times and a seeded sample of them once more. The
sample is the start of the source's documents in the order of md5(seed:doc_id); the one document at the sample's
end gives just the first words that are missing to the target. The end is found in two steps: running sums over
the sums of 4096 hash buckets, then over the rows of the one bucket where the target falls. So no source, hot or
not, is ever gathered in a task, and whether a row is taken depends on its key and its source's few numbers alone.

Defined results: a null text has no words; a null source is a source of its own, last in order; rows of a source that
share a doc_id (or lack one) are drawn together, the one at the end shared out evenly (short of the target by less than
a word each); a source without words takes none; an empty table gives no rows. Only the named columns are read for
the plan, so extra columns of any name do no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, materialise, table

WEIGHTS = (3, 1, 2)
SHARE = 1.5
EPOCHS = 2
SEED = 42
#: Hex digits of the key that name a bucket.
BUCKET_DIGITS = 3
#: Sources up to which their numbers are sent to every executor; beyond it a shuffled join is used.
BROADCAST_SOURCES = 50_000


def sizes(docs: DataFrame, seed: int, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(doc_id, source, size, key) of each row."""
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("-"))))
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"), key.alias("key"))


def targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """(source, source_size, target): one row a source."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.pmod(F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1, F.lit(len(weights)))
    weighed = totals.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))).withColumn("cap", epochs * F.col("source_size").cast("double"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    rows = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = share * F.sum(F.col("source_size").cast("double")).over(everything) - F.coalesce(F.sum("cap").over(rows), F.lit(0.0))
    level = left / F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    # the level that holds is that of the first source it leaves below its cap
    open_level = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source", "level"))
    holds = F.min(open_level).over(everything)["level"]
    return weighed.withColumn("level", level).select("source", "source_size", F.least("cap", F.coalesce(holds * F.col("weight"), F.col("cap"))).alias("target"))


def plan(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """One row a source: source_size, target, whole repetitions, and where its sample ends.

    Rows with a key below ``end_key`` are taken once more; those at ``end_key`` give ``end_words`` words each.
    """
    asked = F.round("target").cast("long")
    aims = materialise(targets(sized, weights, share, epochs).withColumn("whole", F.when(F.col("source_size") > 0, F.floor(asked / F.col("source_size"))).otherwise(F.lit(0)).cast("long")).withColumn("rest", asked - F.col("whole") * F.col("source_size")))
    bucket = F.substring("key", 1, BUCKET_DIGITS)
    buckets = sized.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("words"))
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    goals = _small(aims.select(F.col("source").alias("of"), "rest"))
    ends = buckets.withColumn("upto", upto).join(goals, F.col("source").eqNullSafe(F.col("of"))).where("upto > rest and upto - words <= rest")
    ends = _small(materialise(ends.select("of", F.col("bucket").alias("end_bucket"), (F.col("rest") - F.col("upto") + F.col("words")).alias("open"))))
    edge = sized.join(ends, F.col("source").eqNullSafe(F.col("of")) & (bucket == F.col("end_bucket")))
    keys = edge.groupBy("of", "key", "open").agg(F.sum("size").alias("words"), F.count("*").alias("rows"))
    upto = F.sum("words").over(Window.partitionBy("of").orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    last = keys.withColumn("upto", upto).where("upto > open and upto - words <= open")
    last = last.select("of", F.col("key").alias("end_key"), F.floor((F.col("open") - F.col("upto") + F.col("words")) / F.col("rows")).cast("long").alias("end_words"))
    joined = aims.join(last, F.col("source").eqNullSafe(F.col("of")), "left")
    return materialise(joined.select(F.col("source").alias("__source"), "source_size", "target", "whole", F.coalesce("end_key", F.lit("")).alias("end_key"), F.coalesce("end_words", F.lit(0)).cast("long").alias("end_words")))


def _small(sources: DataFrame) -> DataFrame:
    return F.broadcast(sources) if sources.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES else sources


def _once_more(size: Column) -> Column:
    """Words of a row in the fractional repetition."""
    return F.when(F.col("key") < F.col("end_key"), size).when(F.col("key") == F.col("end_key"), F.least("end_words", size)).otherwise(F.lit(0))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row a document: (doc_id, source, size, source_size, target, whole, more, taken)."""
    sized = materialise(sizes(docs, seed, id_col, text_col, source_col))
    joined = sized.join(_small(plan(sized, weights, share, epochs)), F.col("source").eqNullSafe(F.col("__source")))
    mixed = joined.withColumn("more", _once_more(F.col("size")).cast("long"))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "whole", "more", (F.col("size") * F.col("whole") + F.col("more")).alias("taken"))


def mixed_rows(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself, with the columns of ``docs``: each row as often as it is taken, the last of a sample cut after its words."""
    columns = docs.columns
    sized = materialise(sizes(docs, seed, id_col, text_col, source_col))
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("-"))))
    known = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("__row"), key.alias("key"))
    joined = known.join(_small(plan(sized, weights, share, epochs)), F.col(f"__row.{source_col}").eqNullSafe(F.col("__source")))
    text = F.col(f"__row.{text_col}")
    whole, below, at = F.col("whole"), F.col("key") < F.col("end_key"), (F.col("key") == F.col("end_key")) & (F.col("end_words") > 0)
    start = _first_words(text, F.col("end_words"))
    copies = F.concat(F.when(whole > 0, F.array_repeat(text, whole.cast("int"))).otherwise(F.array().cast("array<string>")), F.when(below, F.array(text)).when(at, F.array(start)).otherwise(F.array().cast("array<string>")))
    # a row without words is in the mix as often as its source is taken whole
    out = joined.select("__row", F.explode(copies).alias("__text"))
    return out.select(*[(F.col("__text") if c == text_col else F.col(f"__row.`{c}`")).alias(c) for c in columns])


def _first_words(text: Column, n: Column) -> Column:
    """A text up to the end of its n-th word, white space as it was."""
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0)), F.lit(1), F.greatest(n, F.lit(0)).cast("int")), "")


def op2_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5('42:' || coalesce(doc_id::VARCHAR, '-')) AS key,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT source, source_size, 2 * source_size::DOUBLE AS cap,
         CASE ((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3) WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight
  FROM totals),
levels AS (
  SELECT *, row_number() OVER o AS n,
         (1.5::DOUBLE * (SELECT sum(source_size)::DOUBLE FROM totals) - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
           / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed WINDOW o AS (ORDER BY cap / weight, source IS NULL, source)),
level AS (SELECT arg_min(level, n) AS holds FROM levels WHERE level * weight <= cap),
aims AS (
  SELECT source, source_size, least(cap, coalesce(holds * weight, cap)) AS target,
         round(least(cap, coalesce(holds * weight, cap)))::BIGINT AS asked
  FROM levels, level),
parts AS (
  SELECT *, CASE WHEN source_size > 0 THEN asked // source_size ELSE 0 END AS whole FROM aims),
placed AS (
  SELECT s.doc_id, s.size, p.source_size, p.target, p.whole, p.asked - p.whole * p.source_size AS rest,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
         sum(s.size) OVER (PARTITION BY s.source, s.key) AS words,
         count(*) OVER (PARTITION BY s.source, s.key) AS together
  FROM sized s JOIN parts p ON s.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       (size * whole + CASE WHEN upto <= rest THEN size
                            WHEN upto - words <= rest THEN least(size, (rest - upto + words) // together) ELSE 0 END)::BIGINT AS taken
FROM placed
"""
