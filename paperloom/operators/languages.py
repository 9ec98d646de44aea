"""Language of a text by three-letter sequences of its words, against profiles counted on labelled texts; built-in functions only.

A profile row is a sequence with its log chance in every language, smoothed. A text's languages are compared by the sums over its known sequences. The text is
refused (null) if it has none, or if the best language leads the next by less for each sequence than ``calibrated`` allows: the margin that a given share of
rightly guessed labelled texts passes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise

#: Sequences in a profile, the most frequent ones.
MOST = 20_000
#: Share of rightly guessed texts that may be refused.
REFUSED = 0.01


def grams(text: Column) -> Column:
    """Three-letter sequences of a text's words in lower case, with a blank before and after each word."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"\p{L}[\p{L}\p{M}]*"), F.lit(0))
    padded = F.transform(words, lambda w: F.concat(F.lit(" "), w, F.lit(" ")))
    return F.flatten(F.transform(padded, lambda p: F.transform(F.sequence(F.lit(1), F.length(p) - 2), lambda i: F.substr(p, i, F.lit(3)))))


def profiles(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", most: int = MOST) -> tuple[list[str], DataFrame]:
    """(languages in order, (gram, chances)): counted on all rows with a text and a language; at most ``most`` rows of one number a language."""
    labelled = docs.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), text_col).hint("rebalance")
    each = labelled.select("lang", F.explode(grams(F.col(text_col))).alias("gram"))
    counts = materialise(each.groupBy("gram", "lang").agg(F.count("*").alias("n")))
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).orderBy("lang").collect()}  # one row a language
    languages = list(totals)
    chance = lambda k: F.log((F.coalesce(F.max(F.when(F.col("lang") == k, F.col("n"))), F.lit(0)) + 0.5) / (totals[k] + 0.5 * most))
    rows = counts.groupBy("gram").agg(F.sum("n").alias("n"), F.array(*[chance(k) for k in languages]).alias("chances") if languages else F.array().cast("array<double>").alias("chances"))
    return languages, rows.orderBy(F.desc("n"), "gram").limit(most).select("gram", "chances")


def guessed(docs: DataFrame, languages: Sequence[str], known: DataFrame, id_col: str, text_col: str = "text", margin: float = 0.0) -> DataFrame:
    """(id, guess, lead) of every row: the likeliest language, null if refused, and its lead for each known sequence. Rows that share an id are one text."""
    # a scan may be one task, however many texts it has
    each = docs.select(id_col, text_col).hint("rebalance").select(id_col, F.explode_outer(grams(F.col(text_col))).alias("gram")).join(F.broadcast(known), "gram", "left")  # MOST rows
    sums = [F.sum(F.get("chances", F.lit(i))).alias(f"s{i}") for i in range(len(languages))]
    one = each.groupBy(id_col).agg(F.count("chances").alias("n"), *sums)
    if not languages:
        return one.select(id_col, F.lit(None).cast("string").alias("guess"), F.lit(None).cast("double").alias("lead"))
    # ties go to the first language in order
    order = F.sort_array(F.array(*[F.struct(F.col(f"s{i}").alias("s"), F.lit(-i).alias("at")) for i in range(len(languages))]), asc=False)
    ranked = one.withColumn("o", order)
    second = F.get("o", F.lit(1))["s"] if len(languages) > 1 else F.lit(float("-inf"))
    lead = F.when(F.col("n") > 0, (F.get("o", F.lit(0))["s"] - second) / F.col("n"))
    best = F.get(F.array(*[F.lit(k) for k in languages]), -F.get("o", F.lit(0))["at"])
    return ranked.select(id_col, F.when((F.col("n") > 0) & (lead >= margin), best).alias("guess"), lead.alias("lead"))


def refused(guesses: DataFrame, margin: float) -> DataFrame:
    """``guessed`` rows without the guesses whose lead is below ``margin``."""
    return guesses.withColumn("guess", F.when(F.col("lead") >= margin, F.col("guess")))


def least_lead(guesses: DataFrame, labelled: DataFrame, id_col: str, lang_col: str = "lang", share: float = REFUSED) -> float:
    """The lead that all but ``share`` of the rightly guessed rows of ``labelled`` have, by guesses made of them already; 0 where there are none."""
    right = guesses.join(labelled.select(id_col, lang_col), id_col).where(F.col("guess") == F.col(lang_col))
    found = right.agg(F.percentile_approx("lead", share, 10_000).alias("m")).first()["m"]
    return max(0.0, found or 0.0)


def calibrated(docs: DataFrame, languages: Sequence[str], known: DataFrame, id_col: str, text_col: str = "text", lang_col: str = "lang", refused: float = REFUSED) -> float:
    """The lead that all but ``refused`` of the rightly guessed labelled texts have; 0 where there are none."""
    return least_lead(guessed(docs, languages, known, id_col, text_col), docs, id_col, lang_col, refused)
