"""Benchmark decontamination: windows of test words looked up among a corpus's windows; DataFrame functions only.

A benchmark's windows (runs of ``WINDOW`` normalised words; an item of fewer words is one window) are made distinct and sent to every executor as the
hash table of a broadcast join. Documents are cut into blocks of words that overlap by a window less one word, every window of a block is looked up
as it streams by, and the join compares the words themselves where hashes agree, so a hit is verified where it is found. What is shuffled is one
row a document and its hits. The benchmark's size is measured first: beyond ``BROADCAST_BYTES`` of windows the same join is left to a shuffle.

``hits`` finds, ``scan`` sums up by document, ``without_spans`` cuts hit words out of the texts and ``without_documents`` drops documents.

Defined results: a null text has no words, no hit and is not contaminated; an item without words has no window; items that share an item_id count as one, and
null ids as the empty string; a document is scanned as one, however long; rows alike in id and text are judged once and all returned; rows
that share an id alone are judged by themselves; an empty benchmark contaminates nothing; an empty table gives no rows. Columns are read by
name, so extra columns of any name do no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .audit import CAPITALS
from .common import bind, materialise, table

#: Words in a window.
WINDOW = 10
#: Bytes of distinct windows up to which they are sent to every executor.
BROADCAST_BYTES = 64 << 20
#: Words of a document in one block.
BLOCK = 4096
#: Characters that no word holds: ASCII besides digits and small letters.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"


def normal_words(text: Column) -> Column:
    """Words after A-Z became small: runs of digits, small letters and whatever is not ASCII. A null text has none."""
    small = F.translate(F.coalesce(text, F.lit("")), CAPITALS, CAPITALS.lower())
    return F.array_remove(F.split(small, BETWEEN + "+"), "")


def _windows(w: Column, length: Column | int, starts: Column) -> Column:
    """Space-joined windows of so many words at the given number of first places; no array where there is none."""
    return F.transform(F.sequence(F.lit(1), starts), lambda i: F.array_join(F.slice(w, i, length), " "))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct windows with the items that hold them: (gram, length, items)."""
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), normal_words(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    length = F.least(F.size("w"), F.lit(window))
    one = items.select("item", length.alias("length"), F.explode(_windows(F.col("w"), length, F.size("w") - length + 1)).alias("gram"))
    return one.groupBy("gram", "length").agg(F.collect_set("item").alias("items"))


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """Rows alike in id and text have one key."""
    return F.unhex(F.md5(F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.coalesce(F.col(text_col), F.lit("")))))


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """(key, id, n, at, length, items): a row a window of a document that is a benchmark's, with the place of its first word from 0, and rows with null ``at``
    that stand for the documents themselves, hit or not; n is their number of words."""
    grams = materialise(benchmark_windows(benchmark, window))
    size = grams.agg(F.sum(F.length(F.encode("gram", "UTF-8")) + 16 + 16 * F.size("items")).alias("bytes"), F.sort_array(F.collect_set("length")).alias("lengths")).first()
    lengths, known = size["lengths"] or [], grams
    if (size["bytes"] or 0) <= BROADCAST_BYTES:
        known = F.broadcast(grams)
    found = docs.select(row_key(id_col, text_col).alias("key"), F.col(id_col).alias("id"), normal_words(F.col(text_col)).alias("w")).withColumn("n", F.size("w"))
    longest = max(lengths, default=1)
    # block 0 is there for every document; the others start at multiples of its size
    blocks = F.transform(F.sequence(F.lit(0), F.greatest(F.col("n") - 1, F.lit(0)), F.lit(block)), lambda b: F.struct(b.alias("first"), F.slice("w", b + 1, block + longest - 1).alias("w")))
    cut = found.select("key", "id", "n", F.explode(blocks).alias("b"))

    def of(length: int) -> Column:
        starts = F.least(F.size("b.w") - length + 1, F.lit(block))
        places = F.when(starts > 0, F.sequence(F.lit(1), F.greatest(starts, F.lit(1)))).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.struct((F.col("b.first") + i - 1).alias("at"), F.lit(length).alias("length"), F.array_join(F.slice("b.w", i, length), " ").alias("gram")))

    itself = F.when(F.col("b.first") == 0, F.array(F.struct(F.lit(None).cast("int").alias("at"), F.lit(0).alias("length"), F.lit(None).cast("string").alias("gram"))))
    every = F.concat(F.coalesce(itself, F.array().cast("array<struct<at:int,length:int,gram:string>>")), *[of(k) for k in lengths])
    windows = cut.select("key", "id", "n", F.inline(every))
    joined = windows.join(known, ["gram", "length"], "left").where(F.col("at").isNull() | F.col("items").isNotNull())
    return joined.select("key", "id", "n", "at", "length", "items")


def _covered(spans: Column) -> Column:
    """Words inside sorted (at, length) spans."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    step = lambda a, s: F.struct((a["n"] + F.greatest(s["at"] + s["length"] - F.greatest(a["end"], s["at"]), F.lit(0))).alias("n"), F.greatest(a["end"], s["at"] + s["length"]).alias("end"))
    return F.aggregate(spans, start, step, lambda a: a["n"])


def _merged(spans: Column) -> Column:
    """Sorted (at, length) spans made disjoint: (at, end). Spans that touch become one."""
    inside = F.array_sort(F.array_distinct(F.flatten(F.transform(spans, lambda s: F.sequence(s["at"], s["at"] + s["length"] - 1)))))

    def runs(p: Column) -> Column:
        first = F.filter(p, lambda x, i: F.coalesce(F.get(p, i - 1) < x - 1, F.lit(True)))
        last = F.filter(p, lambda x, i: F.coalesce(F.get(p, i + 1) > x + 1, F.lit(True)))
        return F.zip_with(first, last, lambda a, b: F.struct(a.alias("at"), (b + 1).alias("end")))

    return bind(inside, runs)


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """One row a distinct (id, text): (key, id, rows, n_words, n_hit, items, spans). items are sorted as strings; spans (at, length) are sorted."""
    found = hits(docs, benchmark, window, id_col, text_col, block)
    itself = F.col("at").isNull()
    one = found.groupBy("key").agg(
        F.first("id").alias("id"), F.sum(F.when(itself, 1).otherwise(0)).alias("rows"), F.max("n").cast("long").alias("n_words"),
        F.array_sort(F.collect_set(F.when(~itself, F.struct("at", "length")))).alias("spans"), F.collect_set("items").alias("sets"),
    )
    items = F.array_sort(F.array_distinct(F.flatten("sets")))
    return one.select("key", "id", "rows", "n_words", _covered(F.col("spans")).cast("long").alias("n_hit"), items.alias("items"), "spans")


def without_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: float = 0.0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents of which at most ``share`` of the words is a benchmark's; columns as they were."""
    bad = scan(docs, benchmark, window, id_col, text_col).where(F.col("n_hit") > share * F.col("n_words")).select(F.col("key").alias("__key"))
    return docs.withColumn("__key", row_key(id_col, text_col)).join(bad, "__key", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def without_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All documents, hit words cut out together with what stands before them; columns as they were, texts without a hit untouched."""
    bad = scan(docs, benchmark, window, id_col, text_col).where("n_hit > 0").select(F.col("key").alias("__key"), _merged(F.col("spans")).alias("__spans"))
    joined = docs.withColumn("__key", row_key(id_col, text_col)).join(bad, "__key", "left")
    word, between = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
    pieces = F.regexp_extract_all(F.col(f"`{text_col}`"), F.lit(f"{between}*{word}"), F.lit(0))
    tail = F.regexp_extract(F.col(f"`{text_col}`"), f"{between}*$", 0)

    def kept(p: Column) -> Column:
        # between the end of a span and the start of the next one
        ends = F.concat(F.array(F.lit(0)), F.transform("__spans", lambda s: s["end"]))
        starts = F.concat(F.transform("__spans", lambda s: s["at"]), F.array(F.size(p)))
        runs = F.zip_with(ends, starts, lambda e, s: F.slice(p, e + 1, F.greatest(s - e, F.lit(0))))
        return F.concat(F.array_join(F.flatten(runs), ""), tail)

    text = F.when(F.col("__spans").isNull(), F.col(f"`{text_col}`")).otherwise(bind(pieces, kept))
    return joined.select(*[(text if c == text_col else F.col(f"`{c}`")).alias(c) for c in docs.columns])


def op12_decontaminate(spark, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.encode(F.array_join("items", ","), "UTF-8"), 256)
    rows = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    return rows.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), digest.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
b AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark),
sized AS (SELECT item, w, least(len(w), 10) AS length FROM b WHERE len(w) > 0),
grams AS (SELECT DISTINCT item, length, unnest(list_transform(range(1, len(w) - length + 2), lambda i: array_to_string(w[i:i + length - 1], ' '))) AS gram FROM sized),
lengths AS (SELECT DISTINCT length FROM grams),
starts AS (SELECT rid, length, w, unnest(range(1, len(w) - length + 2)) AS pos FROM d, lengths WHERE len(w) >= length),
found AS (SELECT rid, item, pos, s.length FROM starts s JOIN grams g ON g.length = s.length AND g.gram = array_to_string(w[pos:pos + s.length - 1], ' ')),
places AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(pos, pos + length)) AS p FROM (SELECT DISTINCT rid, pos, length FROM found)) GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS all_items FROM (SELECT DISTINCT rid, item FROM found) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(all_items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (rid) LEFT JOIN items USING (rid)
"""
