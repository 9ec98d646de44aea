"""Document fingerprints by a threshold-scaled sketch; DataFrame functions only.

Of a text's five-word shingles (lower-cased) the sketch keeps every hash below a fixed fraction of the hash range, so
the sketches of two texts, however unequal, keep or drop a shared shingle alike: sketches merge by union, and
containment and resemblance are estimated by counting.

The edited text of a document takes its end from the next document in order of doc_id. Documents are dealt to blocks of about ``BLOCK``
that are ranges of (doc_id, hash of the text): quantiles of the ids cut them into ranges of like numbers of documents, each range is cut at powers
of two, and an id that fills a range by itself is cut by the hash. The first document of a block is dealt once more to the block before,
so the next document is always the next row of the block.

Defined results: a null text counts as empty; fewer words than a shingle make one shingle of the whole sequence; no words
make an empty sketch; two empty sketches are alike (1) only if the texts are equal, an empty and another are not (0);
rows that share a doc_id follow each other in order of a hash of their text; rows without one come first; rows alike in both stay in one block; a single document is its own
next; an empty table gives no rows. Only the id and text columns are read, so extra columns of any name do no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bind, materialise, table, words

SHINGLE = 5
#: The sketch keeps hashes of which so many leading bits are zero: a quarter of the range.
ZERO_BITS = 2
#: Documents to a block, about.
BLOCK = 256
#: Ranges that the ids' quantiles make, at most; no range has much more than its share of the documents.
RANGES = 256
#: Block starts up to which they are sent to every executor; beyond it a shuffled join is used.
BROADCAST_BLOCKS = 200_000
NO_ID = -(1 << 63)
#: Bits of a hash that a fingerprint keeps.
KEPT_BITS = 40


def sketch(text: Column, shingle: int = SHINGLE, zero_bits: int = ZERO_BITS) -> Column:
    """Sorted distinct hashes (bigint) of the shingles kept; of all of them where ``zero_bits`` is 0."""

    def of(w: Column) -> Column:
        last = F.size(w) - shingle
        many = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(shingle)]))
        one = F.array(F.xxhash64(F.concat_ws(" ", w)))
        hashes = F.when(F.size(w) == 0, F.array().cast("array<bigint>")).when(last < 0, one).otherwise(many)
        kept = F.filter(hashes, lambda h: F.shiftrightunsigned(h, 64 - zero_bits) == 0) if zero_bits else hashes
        return F.array_sort(F.array_distinct(kept))

    return bind(words(F.lower(F.coalesce(text, F.lit("")))), of)


def resemblance(a: Column, b: Column, same_text: Column) -> Column:
    """Estimated share of distinct shingles that two texts have in common."""
    both = F.size(F.array_intersect(a, b)).cast("double")
    either = F.size(a) + F.size(b) - both
    return F.when(either > 0, both / either).otherwise(same_text.cast("double"))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b has; null where a's sketch is empty."""
    return F.when(F.size(a) > 0, F.size(F.array_intersect(a, b)).cast("double") / F.size(a))


def merged(a: Column, b: Column) -> Column:
    """The sketch of two texts' shingles together."""
    return F.array_sort(F.array_union(a, b))


def shortened(hashes: Column, zero_bits: int = ZERO_BITS) -> Column:
    """The sketch as a fingerprint has it: the KEPT_BITS bits of each hash behind the zero bits, in order."""
    return F.array_distinct(F.transform(hashes, lambda h: F.shiftrightunsigned(h, 64 - zero_bits - KEPT_BITS)))


def written(short: Column) -> Column:
    """A shortened sketch as text: ten hex digits of each hash."""
    return F.array_join(F.transform(short, lambda h: F.lpad(F.lower(F.hex(h)), KEPT_BITS // 4, "0")), "")


def _ranges(rows: DataFrame, block: int) -> list[tuple[int, int, int]]:
    """(first id, shift of the id, shift of the hash) of ranges in order; a range's blocks are equal ids or hashes after the shift."""
    o = F.col("o")
    n = rows.count()
    count = max(1, min(RANGES, n // (4 * block)))
    got = rows.agg(F.min(o).alias("least"), F.max(o).alias("most"), F.percentile_approx(o, [i / count for i in range(count)], 20_000).alias("q")).first()
    if not n:
        return [(0, 0, 63)]
    quantiles = [got["least"], *got["q"][1:]]
    weight = {v: quantiles.count(v) for v in quantiles}
    # ids that fill a range are ranges of their own, and so are missing ids
    alone = {v for v, k in weight.items() if k > 1} | ({NO_ID} & weight.keys())
    edges = sorted({*quantiles, *(v + 1 for v in alone if v < got["most"])})
    out = []
    for at, first in enumerate(edges):
        end = edges[at + 1] if at + 1 < len(edges) else got["most"] + 1
        docs = max(1, n * weight.get(first, 1) // count)
        if first in alone:
            out.append((first, 0, 63 - max(0, (docs // block).bit_length())))
        else:
            out.append((first, min(63, max(0, ((end - first) * block // docs).bit_length() - 1)), 63))
    return out


def _block(ranges: list[tuple[int, int, int]]) -> Column:
    """struct(r, id, part): the block of (o, h), in the order of both."""
    first = F.array(*[F.lit(x[0]).cast("bigint") for x in ranges])

    def of(r: Column) -> Column:
        shifts = [F.get(F.array(*[F.lit(x[k]) for x in ranges]), r) for k in (1, 2)]
        return F.struct(r.alias("r"), F.call_function("shiftright", F.col("o"), shifts[0]).alias("id"), F.call_function("shiftrightunsigned", F.col("h"), shifts[1]).alias("part"))

    return bind(F.size(F.filter(first, lambda f: f <= F.col("o"))) - 1, of)


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """Each document with the next one: (doc_id, text, sketch, next_text, next_sketch); sketches are shortened."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumns({"o": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), "h": F.shiftrightunsigned(F.xxhash64("text"), 1)})
    known = rows.withColumn("block", _block(_ranges(rows.select("o"), block)))
    firsts = materialise(known.groupBy("block").agg(F.min(F.struct("o", "h")).alias("first")))
    # one row a block, about 1/BLOCK of the documents; a range's first block comes after the last of the range before, the very first after the last
    lasts = firsts.groupBy("block.r").agg(F.max("block").alias("last"))  # one row a range
    every = Window.orderBy("r").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = F.broadcast(lasts.select(F.col("r").alias("of"), F.coalesce(F.lag("last").over(Window.orderBy("r")), F.last("last").over(every)).alias("end")))
    firsts = firsts.join(ends, F.col("block.r") == F.col("of"))
    before = F.coalesce(F.lag("block").over(Window.partitionBy("of").orderBy("block")), F.col("end"))
    starts = materialise(firsts.select("first.o", "first.h", before.alias("before")))
    if starts.limit(BROADCAST_BLOCKS + 1).count() <= BROADCAST_BLOCKS:
        starts = F.broadcast(starts)
    dealt = known.join(starts, ["o", "h"], "left")
    own = F.struct("block", F.lit(0).alias("borrowed"))
    again = F.when(F.col("before").isNotNull(), F.struct(F.col("before").alias("block"), F.lit(1).alias("borrowed")))
    # texts alone are shuffled; sketches are made where the blocks are
    dealt = dealt.select("doc_id", "text", "o", "h", F.inline(F.array_compact(F.array(own, again)))).repartition("block").withColumn("sketch", shortened(sketch(F.col("text"))))
    follows = Window.partitionBy("block").orderBy("borrowed", "o", "h", "text")
    paired = dealt.withColumn("next", F.lead(F.struct("text", "sketch")).over(follows)).where("borrowed = 0")
    return paired.select("doc_id", "text", "sketch", F.col("next.text").alias("next_text"), F.col("next.sketch").alias("next_sketch"))


def edited(text: Column, following: Column) -> Column:
    """The text with its last quarter replaced by as many characters of the next one."""
    n = F.length(text)
    quarter = F.floor(n / 4).cast("int")
    return F.concat(F.substr(text, F.lit(1), n - quarter), F.substr(following, F.lit(1), quarter))


def op8_fingerprints(spark, sf_dir: str) -> DataFrame:
    pairs = with_next(table(spark, sf_dir, "documents"))

    def of(e: Column) -> Column:
        return bind(shortened(sketch(e)), lambda s: F.struct(
            F.sha2(F.encode(e, "UTF-8"), 256).alias("edited_sha256"), written(s).alias("edited_fingerprint"),
            resemblance(F.col("sketch"), s, F.col("text") == e).alias("near_edited"),
        ))

    out = pairs.withColumn("e", bind(edited(F.col("text"), F.col("next_text")), of))
    near_next = resemblance(F.col("sketch"), F.col("next_sketch"), F.col("text") == F.col("next_text"))
    return out.select("doc_id", F.length("text").cast("long").alias("n_chars"), "e.edited_sha256", written(F.col("sketch")).alias("fingerprint"), "e.edited_fingerprint", "e.near_edited", near_next.alias("near_next"))
