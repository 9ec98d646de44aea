"""Quality rules: a table of thresholds compiled into one Spark projection, without user functions.

``RULES`` names a measure, a bound and its direction; ``judged`` turns the table into columns of one ``select``.
Nothing is shuffled, so hot sources and groups of copies cost what other rows cost.

Words in repeated three-word windows: hashes of the windows tell whether any is repeated at all (no two equal
hashes, no two equal windows); only then are the windows themselves sorted and compared, so the count is exact.

Defined results: a null text counts as empty; an empty text has zero for every count, fails the base rule and is not
kept; rows are judged by themselves, so repeated rows repeat; an empty table gives no rows. Only the id and text
columns are read, so extra columns of any name do no harm. Ratios of a text without words or lines are 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, bind, table, words

#: Characters counted as symbols.
SYMBOLS = "#*$%&|<>"
#: Stop words of English, German, French and Spanish.
STOP_WORDS = (
    "a an and are as at be but by for from has have he in is it its not of on or she that the they this to was we were which will with you "
    "als am auch auf aus bei bin das dass dem den der des die ein eine einem einen einer es für ich im ist mit nach nicht oder sich sie sind über um und von vor war wie wird zu zum zur "
    "au aux avec ce cette ces dans de des du elle elles en est et être il ils je la le les leur lui mais ne nous on ou par pas plus pour qu que qui sa se ses son sont sur un une vous "
    "al como con cuando del donde el ella ellas ellos entre era es esta este ha hay las lo los más me mi muy ni no nos o para pero por porque que se sin sobre son su sus también te un una uno y ya"
).split()
PUNCTUATION = ".,;:!?()\"'"
#: (rule, measure, "max" or "min", threshold). A text is kept if it breaks none of these and no base rule (under 50 words, half of them repeated).
RULES = (
    ("words_too_short", "mean_word", "min", 2.0),
    ("words_too_long", "mean_word", "max", 12.0),
    ("symbols", "symbol_ratio", "max", 0.1),
    ("few_stop_words", "stop_ratio", "min", 0.06),
    ("repeated_lines", "dup_line_ratio", "max", 0.4),
)


def _repeated(found: Column) -> Column:
    """Words of an array that lie in a three-word window found twice or more."""

    def exact(w: Column) -> Column:
        windows = F.array_sort(F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.struct(F.concat_ws(" ", w[i], w[i + 1], w[i + 2]).alias("t"), i.alias("i"))))

        def again(s: Column) -> Column:
            same = lambda x, j: F.coalesce(F.get(s, j)["t"] == x["t"], F.lit(False))
            starts = F.array_sort(F.transform(F.filter(s, lambda x, j: same(x, j - 1) | same(x, j + 1)), lambda x: x["i"]))
            nothing = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
            return F.aggregate(starts, nothing, lambda a, p: F.struct((a["n"] + p + 3 - F.greatest(a["end"], p)).alias("n"), (p + 3).alias("end")), lambda a: a["n"])

        return bind(windows, again)

    def counted(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2]))
        return F.when(F.size(w) < 4, F.lit(0)).otherwise(F.when(F.size(F.array_distinct(hashes)) == F.size(w) - 2, F.lit(0)).otherwise(exact(w)))

    return counted(found)


def measures(text: Column) -> Column:
    """A struct of all measures of a text."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))

    def of(w: Column) -> Column:
        def lined(x: Column) -> Column:
            return F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup"))

        stop = F.size(F.filter(w, lambda x: F.lower(F.btrim(x, F.lit(PUNCTUATION))).isin(*dict.fromkeys(STOP_WORDS))))
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
            (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            bind(lines, lined).alias("lines"),
            _repeated(w).cast("long").alias("n_repeat_words"),
            stop.cast("long").alias("n_stop_words"),
        )

    return bind(words(text), of)


def ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a.cast("double") / b.cast("double")).otherwise(F.lit(0.0))


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> DataFrame:
    """One row a document: its counts and ratios, the rules that it breaks, base_failed and kept."""
    m = docs.select(F.col(id_col).alias("doc_id"), measures(F.col(text_col)).alias("m"))
    n = F.col("m.n_words")
    values = {
        "n_words": n.cast("double"),
        "repeat_ratio": ratio(F.col("m.n_repeat_words"), n),
        "mean_word": ratio(F.col("m.word_chars"), n),
        "symbol_ratio": ratio(F.col("m.n_symbols"), n),
        "stop_ratio": ratio(F.col("m.n_stop_words"), n),
        "dup_line_ratio": ratio(F.col("m.lines.dup"), F.col("m.lines.n")),
    }
    # the base rules hold whatever the table says, and are compared in whole numbers
    base_rules = {"too_short": n < 50, "repeated_words": 100 * F.col("m.n_repeat_words") > 50 * n}
    base = base_rules["too_short"] | base_rules["repeated_words"]
    broken = base_rules | {name: (values[what] < bound if way == "min" else values[what] > bound) for name, what, way, bound in rules}
    return m.select(
        "doc_id", "m.n_words", "m.word_chars", "m.n_symbols", F.col("m.lines.dup").cast("long").alias("n_dup_lines"), "m.n_repeat_words",
        base.alias("base_failed"),
        F.array_compact(F.array(*[F.when(x, F.lit(name)) for name, x in broken.items()])).alias("broken"),
        *[x.alias(k) for k, x in values.items() if k != "n_words"],
    ).withColumn("kept", F.size("broken") == 0)


def op4_quality_rules(spark, sf_dir: str) -> DataFrame:
    found = judged(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _sql() -> str:
    stop = ", ".join("'" + x + "'" for x in dict.fromkeys(STOP_WORDS))
    marks = PUNCTUATION.replace("'", "''")
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
windows AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS t
            FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, t) AS n FROM windows) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM again, range(3) AS o(k) GROUP BY r),
c AS (SELECT w.r, doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
        (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, len(l) AS n_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
        len(list_filter(w, lambda x: lower(trim(x, '{marks}')) IN ({stop}))) AS n_stop
      FROM w LEFT JOIN covered ON w.r = covered.r),
b AS (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND word_chars::DOUBLE / n_words >= 2.0 AND word_chars::DOUBLE / n_words <= 12.0
        AND n_symbols::DOUBLE / n_words <= 0.1::DOUBLE AND n_stop::DOUBLE / n_words >= 0.06::DOUBLE
        AND n_dup_lines::DOUBLE / n_lines <= 0.4::DOUBLE) AS kept
FROM b
"""


ORACLE_SQL = _sql()
