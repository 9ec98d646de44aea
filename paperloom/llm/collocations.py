"""Phrases whose words occur together more often than apart, by suffix-sigma.

Texts are cut into pieces at punctuation and line ends and these into words; everything is counted per language. Every place of a piece gives a suffix of at
most ``MAX_WORDS`` words. Suffixes are summed in the tasks that read the texts, dealt by language and first word, sorted in reverse order, and
one stack a task counts all their prefixes, so a phrase of any length costs no pass of its own.

* **Hot words.** A first word may begin a third of all suffixes. Tasks are therefore ranges of the sorted suffixes, so that a hot word spans as many tasks as it
  needs. Bounds are quantiles of a sample of the documents; they settle balance alone: prefixes that a task shares with its neighbours are given out
  whatever their count and added up afterwards, so counts are exact for any bounds.
* **Codes.** The ``CODED`` words most frequent stand as two bytes in suffixes, so the dictionary is as large for any input; others stand as they are.
* **Rare words.** A phrase of ``MIN_COUNT`` occurrences has no word with fewer. Words are counted first; a map of ``FILTER_BITS`` bits, as large for any
  input, marks the hashes of words that are frequent enough, and suffixes end where a word has no mark. Words that share a mark cost rows, not exactness.
* **Parts** of a phrase are at least as frequent as the phrase, so their counts are among those counted: joins by (language, part) find them.

Products are decimals of 38 digits: exact while counts stay below 10^15.

Defined results: a null text counts as empty and a null language as ``und``; empty pieces have no words; ties of score and count are settled by the phrase in order
of UTF-8 bytes; repeated rows count as often as they occur; an empty table gives no rows. Characters that separate nothing (other control characters, NUL
among them) belong to words. Columns are read by name, so extra columns of any name do no harm.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator, Mapping
from types import MappingProxyType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded_batches, materialise, table

MAX_WORDS = 5
MIN_COUNT = 100
#: Phrases a language, best first.
BEST = 2000
#: A phrase goes if a longer one has so many of a hundred of its occurrences.
ABSORBED = 100
FILTER_BITS = 1 << 24
#: Words with a code, at most 253 * 253.
CODED = 60_000
#: Bytes of text looked at together.
CHUNK = 6 << 20
#: Bits of a chunk's count of a suffix.
_PART = 40
#: Suffixes counted together by the stack.
TOGETHER = 100_000
#: Sampled suffixes that the bounds of tasks are taken from, about, and bytes of a bound.
SAMPLE = 20_000
BOUND_BYTES = 64

_ENDS = b".,;:!?\n\x0b\x0c\r"
_NORMAL = bytes.maketrans(bytes(range(65, 91)) + _ENDS + b"\t", bytes(range(97, 123)) + b"\n" * len(_ENDS) + b" ")
NO_LANGUAGE = "und"


def normal(text: str | None) -> bytes:
    """A text with A-Z small, line feeds between pieces and blanks between words. NUL and \\x01 are escaped, so NUL can end words."""
    return escaped((text or "").encode("utf-8").translate(_NORMAL))


#: Bytes that begin and end a word without a code; UTF-8 has no such byte, and NUL is escaped.
_OPEN, _CLOSE = 0xFF, 0x00


def escaped(data: bytes) -> bytes:
    return data.replace(b"\x01", b"\x01\x02").replace(b"\x00", b"\x01\x01") if b"\x01" in data or b"\x00" in data else data


def plain(data: bytes) -> bytes:
    return data.replace(b"\x01\x01", b"\x00").replace(b"\x01\x02", b"\x01") if b"\x01" in data else data


def portions(data: bytes, longest: int, most: int | None = None) -> Iterator[tuple[bytes, int]]:
    """A normal text in portions with the end of the places that each answers for; a portion goes on for as many words as a suffix needs."""
    most, at = most or CHUNK, 0
    while len(data) - at > 2 * most:
        cut = at + most
        while cut < len(data) and data[cut] not in b" \n":
            cut += 1
        end = cut
        for _ in range(longest):
            while end < len(data) and data[end] in b" \n":
                end += 1
            while end < len(data) and data[end] not in b" \n":
                end += 1
        yield data[at:end], cut - at
        at = cut
    yield data[at:], len(data) - at


def chunks(batches: Iterator[pa.RecordBatch], longest: int) -> Iterator[tuple[bytes, bytes, int]]:
    """(language, text, places) of about ``CHUNK`` bytes: texts of a language joined, long ones in portions."""
    held: dict[bytes, list[bytes]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1), strict=True):
            key, data = escaped(lang.as_py().encode("utf-8")), normal(text.as_py())
            if len(data) > CHUNK:
                yield from ((key, *p) for p in portions(data, longest))
                continue
            held.setdefault(key, []).append(data)
            size += len(data) + 64
            if size > CHUNK:
                yield from ((k, d := b"\n".join(v), len(d)) for k, v in held.items())
                held, size = {}, 0
    yield from ((k, d := b"\n".join(v), len(d)) for k, v in held.items())


def words_of(data: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words, and for each word in order which of them it is, its piece and its place in the text."""
    b = np.frombuffer(data, np.uint8)
    line = b == 10
    inside = ~(line | (b == 32))
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(b[inside])]).dictionary_encode()
    return words.dictionary, words.indices.to_numpy(), np.searchsorted(np.flatnonzero(line), starts), starts


def _read(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    bounded_batches(docs.sparkSession)
    return docs.select(F.coalesce(F.col(lang_col), F.lit(NO_LANGUAGE)).alias("lang"), F.col(text_col).alias("text"))


def word_counts(docs: DataFrame, least: int, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, word, n) of words that occur ``least`` times or more, and of each language with an empty word: all its words. Both escaped."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, data, places in chunks(batches, 0):
            words, index, _, starts = words_of(data)
            n = np.bincount(index[starts < places], minlength=len(words))
            own, n = [*words.to_pylist(), b""], np.append(n, n.sum())
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(own), pa.binary()), pa.array(own, pa.binary()), pa.array(n, pa.int64())], names=["lang", "word", "n"])

    counted = _read(docs, text_col, lang_col).mapInArrow(count, "lang binary, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    return counted.where((F.col("n") >= least) | (F.length("word") == 0))


def _marks(counts: DataFrame, least: int, bits: int = FILTER_BITS) -> bytes:
    """A map of bits that is set at the hash of every word frequent enough; as large for any input."""
    place = F.pmod(F.crc32(F.concat("lang", F.lit(b"\0"), "word")), F.lit(bits))
    # the functions number bits from 1, 32768 of them to a row of 4096 bytes
    rows = counts.where((F.col("n") >= least) & (F.length("word") > 0)).select((place + 1).alias("p")).groupBy(F.bitmap_bucket_number("p").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("m"))
    marks = bytearray(bits // 8)
    for r in rows.collect():  # bits / 32768 rows at most
        at = (r["b"] - 1) * 4096
        marks[at : at + 4096] = r["m"]
    return bytes(marks)


def _codes(counts: DataFrame, most: int = CODED) -> dict[bytes, bytes]:
    """Two bytes for each of the ``most`` (or somewhat fewer) words most frequent."""
    words = counts.where(F.length("word").between(3, 64)).groupBy("word").agg(F.sum("n").alias("n"))
    grade = F.floor(F.log2("n") * 16).alias("grade")
    upto, least = 0, None
    for r in words.groupBy(grade).count().orderBy(F.desc("grade")).collect():  # a thousand rows at most
        if (upto := upto + r["count"]) > most:
            break
        least = r["grade"]
    if least is None:
        return {}
    chosen = sorted(bytes(r["word"]) for r in words.where(grade >= least).select("word").collect())
    return {w: bytes((1 + k // 253, 1 + k % 253)) for k, w in enumerate(chosen)}


def shortened(word: bytes, codes: Mapping[bytes, bytes] = MappingProxyType({})) -> bytes:
    """A word as it stands in suffixes: its code, or itself between two bytes. None begins another, so suffixes need nothing between words and sort as their words do."""
    return codes.get(word) or bytes((_OPEN,)) + word + bytes((_CLOSE,))


def restored(short: bytes, words: Mapping[bytes, bytes]) -> bytes:
    """The word that ``apart`` found."""
    return plain(short[1:]) if short[0] == _OPEN else words[short]


def apart(keys: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words of suffixes (codes, or words behind their first byte), which of them each word is in order, and the words of each suffix."""
    keys = keys.cast(pa.large_binary())
    ends = np.frombuffer(keys.buffers()[1], np.int64)[keys.offset : keys.offset + len(keys) + 1]
    data = np.frombuffer(keys.buffers()[2], np.uint8)[ends[0] : ends[-1]]
    opens, closes = data == _OPEN, data == _CLOSE
    inside = np.cumsum(opens.astype(np.int64) - closes) > 0
    coded = ~inside & ~closes
    # codes are pairs, so every other byte of them begins a word
    starts = opens | (coded & (np.cumsum(coded) % 2 == 1))
    kept = coded | inside
    offsets = np.append(np.flatnonzero(starts[kept]), kept.sum()).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data[kept])]).dictionary_encode()
    return words.dictionary, words.indices.to_numpy(), np.add.reduceat(starts.astype(np.int64), ends[:-1] - ends[0])


def suffixes(lang: bytes, data: bytes, places: int, marks: bytes, codes: Mapping[bytes, bytes], longest: int = MAX_WORDS) -> tuple[pa.Array, np.ndarray]:
    """Distinct suffixes of frequent words, cut to ``longest`` words, in order of bytes, and how often each begins at one of the first ``places``."""
    words, index, piece, starts = words_of(data)
    own = words.to_pylist()
    short = [shortened(w, codes) for w in own]
    bits = 8 * len(marks)
    hashes = [zlib.crc32(w, zlib.crc32(lang + b"\0")) % bits for w in own]
    frequent = np.array([marks[h >> 3] >> (h & 7) & 1 for h in hashes], bool)
    order = sorted(range(len(own)), key=short.__getitem__)
    rank = np.empty(len(own) + 1, np.int64)
    rank[order] = np.arange(1, len(own) + 1)
    ids = np.where(frequent[index], rank[index], 0) if len(own) else np.zeros(0, np.int64)
    columns = [ids]
    for k in range(1, longest):
        following = np.zeros_like(ids)
        if len(ids) > k:
            following[:-k] = np.where((piece[k:] == piece[:-k]) & (columns[-1][:-k] > 0), ids[k:], 0)
        columns.append(following)
    begins = (ids > 0) & (starts < places)
    columns = [c[begins] for c in columns]
    # two numbers a suffix: words of a chunk are fewer than 2 ^ 21 by its bytes
    keys = [np.zeros(len(columns[0]), np.int64) for _ in range((longest + 2) // 3)]
    for k, c in enumerate(columns):
        keys[k // 3] |= c << (42 - 21 * (k % 3))
    by = np.lexsort(keys[::-1])
    new = np.ones(len(by), bool)
    if len(by):
        new[1:] = np.logical_or.reduce([k[by][1:] != k[by][:-1] for k in keys])
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(by)))
    sorted_words = pa.array([b"", *(short[i] for i in order)], pa.binary())
    parts = [pc.take(sorted_words, pa.array(np.where(c[by][first] > 0, c[by][first], 0), mask=c[by][first] == 0)) for c in columns]
    heads = pa.array([shortened(lang)] * len(first), pa.binary())
    return (pc.binary_join_element_wise(heads, *parts, b"", null_handling="skip") if len(first) else pa.array([], pa.binary())), n


class Prefixes:
    """Counts all prefixes of suffixes that come sorted, in either order, by one stack.

    The stack holds the words of the last suffix with the counts of its prefixes so far; a prefix is complete once a suffix comes that does not begin
    with it. Suffixes come many at a time: those that begin and end among them never reach the stack. Prefixes of the first and of the last suffix
    of all may go on in other tasks and are given out whatever their count.
    """

    def __init__(self, least: int):
        self.least = least
        self.stack: list[list] = []  # word, count, whether the first suffix began it
        self.begun = False

    def _closed(self, keep: int, every: bool = False) -> Iterator[tuple[list[bytes], int]]:
        while len(self.stack) > keep:
            words = [s[0] for s in self.stack]
            _, n, edge = self.stack.pop()
            if edge or every or n >= self.least:
                yield words, n

    def add(self, keys: pa.Array, n: np.ndarray) -> Iterator[tuple[list[bytes], int]]:
        """(words, count) of prefixes that are complete."""
        if not len(keys):
            return
        known, index, sizes = apart(keys)
        words = np.full((len(keys), int(sizes.max())), -1, np.int64)
        words[np.repeat(np.arange(len(keys)), sizes), np.arange(len(index)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = index
        name = lambda row, depth: [known[int(w)].as_py() for w in words[row, : depth + 1]]
        top = name(0, int(sizes[0]) - 1)
        shared = 0
        while shared < min(len(top), len(self.stack)) and self.stack[shared][0] == top[shared]:
            shared += 1
        yield from self._closed(shared)
        new = np.zeros(len(keys), bool)
        new[0] = True
        open_: list[list] = []
        ended = None
        for depth in range(words.shape[1]):
            new[1:] |= words[1:, depth] != words[:-1, depth]
            first = np.flatnonzero(new)
            first = first[words[first, depth] >= 0]
            ends = np.flatnonzero(new)
            sums = np.add.reduceat(n, ends)[np.searchsorted(ends, first)]
            last = words[-1, depth] >= 0
            for g in np.flatnonzero((sums >= self.least) | (first == 0) | (np.arange(len(first)) == len(first) - 1)):
                row, count, edge = int(first[g]), int(sums[g]), False
                if row == 0:
                    edge = not self.begun
                    if depth < shared:
                        count, edge = count + self.stack[depth][1], self.stack[depth][2]
                if last and g == len(first) - 1:
                    open_.append([known[int(words[row, depth])].as_py(), count, edge])
                elif edge or count >= self.least:
                    yield name(row, depth), count
        self.stack, self.begun = open_, True

    def rest(self) -> Iterator[tuple[list[bytes], int]]:
        yield from self._closed(0, every=True)


def _bounds(read: DataFrame, marks, codes, longest: int, parts: int, total: int, sample: int = SAMPLE) -> list[bytes]:
    """At most ``parts`` - 1 suffixes that cut the sorted suffixes into parts of like size, judged by about ``sample`` of them."""
    n = read.count()
    share = min(1.0, sample / 10 / max(n, 1))
    one_of = max(1, int(total * share / sample))

    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, longest):
            keys, _ = suffixes(*chunk, marks.value, codes.value, longest)
            yield pa.RecordBatch.from_arrays([pa.array([k[:BOUND_BYTES] for k in keys.to_pylist() if zlib.crc32(k) % one_of == 0], pa.binary())], names=["s"])

    rows = (read.sample(share, seed=42) if share < 1 else read).mapInArrow(drawn, "s binary").collect()
    keys = sorted({bytes(r["s"]) for r in rows})
    return sorted({keys[i * len(keys) // parts] for i in range(1, parts)}) if keys else []


def phrase_counts(docs: DataFrame, words: DataFrame, least: int = MIN_COUNT, longest: int = MAX_WORDS, parts: int | None = None, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, phrase, size, f) of all phrases of 1 to ``longest`` words that occur ``least`` times or more."""
    spark = docs.sparkSession
    read = _read(docs, text_col, lang_col)
    marks, codes = (spark.sparkContext.broadcast(x) for x in (_marks(words, least), _codes(words)))
    parts = parts or max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    total = words.where(F.length("word") == 0).agg(F.sum("n")).first()[0] or 0
    bounds = spark.sparkContext.broadcast(_bounds(read, marks, codes, longest, parts, total))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Suffixes of a chunk with the number of the range that each lies in."""
        for chunk in chunks(batches, longest):
            keys, n = suffixes(*chunk, marks.value, codes.value, longest)
            ends = [bisect_left(range(len(keys)), b, key=lambda i: keys[i].as_py()) for b in bounds.value]
            part = np.searchsorted(np.array(ends, np.int64), np.arange(len(keys)), side="right")
            yield pa.RecordBatch.from_arrays([pa.array(part << _PART | n, pa.int64()), keys], names=["n", "s"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {short: plain(word) for word, short in codes.value.items()}
        stack = Prefixes(least)

        def out(found: Iterator[tuple[list[bytes], int]]) -> Iterator[pa.RecordBatch]:
            rows = [(restored(w[0], known).decode(), b" ".join(restored(x, known) for x in w[1:]).decode(), len(w) - 1, n) for w, n in found if len(w) > 1]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.string(), pa.int32(), pa.int64()), strict=True)], names=["lang", "phrase", "size", "n"])

        def together() -> Iterator[pa.Table]:
            held, size = [], 0
            for b in batches:
                held, size = [*held, b], size + b.num_rows
                if size >= TOGETHER:
                    yield pa.Table.from_batches(held).combine_chunks()
                    held, size = [], 0
            if held:
                yield pa.Table.from_batches(held).combine_chunks()

        for t in together():
            for s, n in zip(t.column(0).chunks, t.column(1).chunks, strict=True):
                yield from out(stack.add(s, n.to_numpy()))
        yield from out(stack.rest())

    # a range's number stands above the count
    sums = read.mapInArrow(dealt, "n long, s binary").repartitionById(len(bounds.value) + 1, F.shiftright("n", _PART).cast("int"))
    found = sums.sortWithinPartitions(F.desc("s")).select("s", F.col("n").bitwiseAND(F.lit((1 << _PART) - 1)).alias("n")).mapInArrow(counted, "lang string, phrase string, size int, n long")
    return found.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("f")).where(F.col("f") >= least)


def _wide(c: Column) -> Column:
    return c.cast("decimal(18,0)")


def scored(counts: DataFrame, totals: DataFrame, absorbed: int = ABSORBED) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of phrases of two words and more that no longer phrase absorbs; totals: (lang, n)."""
    several = counts.where("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"))
    # a longer phrase that holds this one is at most as frequent as the one that adds a single word to it
    inner = F.array(F.expr("substring_index(phrase, ' ', size - 1)"), F.expr("substring_index(phrase, ' ', 1 - size)"))
    longer = several.where("size > 2").select("lang", F.explode(inner).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = several.join(longer, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < absorbed * F.col("a"))).drop("longer")
    cuts = kept.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.withColumns({"left": F.expr("substring_index(phrase, ' ', k)"), "right": F.expr("substring_index(phrase, ' ', k - size)")})
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    cuts = cuts.join(totals, "lang")
    cuts = cuts.withColumns({"over": _wide(1000 * F.col("a")) * _wide(F.col("n")), "under": _wide(F.col("l")) * _wide(F.col("r"))}).withColumn("score", F.expr("over div under"))
    worst = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return worst.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def collocations(docs: DataFrame, least: int = MIN_COUNT, longest: int = MAX_WORDS, best: int = BEST, absorbed: int = ABSORBED, parts: int | None = None, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Each language's first ``best`` phrases: (lang, rank, phrase, a, l, r, n, score)."""
    words = materialise(word_counts(docs, least, text_col, lang_col))
    # languages come escaped from the words' counts
    lang = F.decode(F.col("lang"), "UTF-8")
    unescaped = F.replace(F.replace(lang, F.lit("\x01\x01"), F.lit("\x00")), F.lit("\x01\x02"), F.lit("\x01"))
    totals = words.where(F.length("word") == 0).select(unescaped.alias("lang"), "n")
    counts = materialise(phrase_counts(docs, words, least, longest, parts, text_col, lang_col))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored(counts, totals, absorbed).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH pieces AS (
  SELECT rid, lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece
  FROM (SELECT row_number() OVER () AS rid, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents)),
words AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
runs AS (SELECT lang, size, w, unnest(range(1, len(w) - size + 2)) AS pos FROM words, (SELECT unnest(range(1, 6)) AS size) WHERE len(w) >= size),
counts AS (
  SELECT lang, size, phrase, count(*) AS f FROM (SELECT lang, size, array_to_string(w[pos:pos + size - 1], ' ') AS phrase FROM runs) GROUP BY lang, size, phrase HAVING count(*) >= 100),
split AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE size > 1),
inside AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT lang, w, a, size, m, unnest(range(1, size - m + 2)) AS i FROM split, (SELECT unnest(range(2, 5)) AS m) WHERE m < size) GROUP BY ALL),
kept AS (SELECT s.* FROM split s LEFT JOIN inside i ON i.lang = s.lang AND i.phrase = s.phrase WHERE longer IS NULL OR 100 * longer < 100 * a),
cuts AS (SELECT *, unnest(range(1, size)) AS k FROM kept),
judged AS (
  SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r, n, 1000::HUGEINT * a * n // (x.f::HUGEINT * y.f) AS score
  FROM cuts c JOIN totals t ON t.lang = c.lang JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:k], ' ') JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:c.size], ' ')),
worst AS (SELECT * FROM judged QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM worst QUALIFY rank <= 2000
"""
