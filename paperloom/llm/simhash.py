"""SimHash near-duplicates by pivot distance tables.

A fingerprint has a bit set where more than half of a text's shingle hashes have it. Two fingerprints
link when they differ in at most ``max_bits`` bits (2).

Each fingerprint x has a row in a table of distances to reference fingerprints: the empty one, 0, and the ``REFERENCES``, r_1 to r_32,
each with two neighbouring bits set. Its coordinate c_j is 1 - (d(x, r_j) - d(x, 0)) / 2, which is 0, 1 or 2. As the references share no
bit, the coordinates of two fingerprints differ by no more in sum than the fingerprints do in bits (triangle inequality, one reference at a
time); so of linked fingerprints at most ``max_bits`` coordinates differ. With the coordinates in ``max_bits`` + ``INTACT`` bands, at least
``INTACT`` bands agree in full: a fingerprint is dealt to a cell for each choice of so many bands (ten at two bits), and every link falls
in some cell. Inside a cell, pairs whose distances to the dense references ``PIVOTS`` differ by more than ``max_bits`` in any coordinate are
discarded, and the survivors are verified bit by bit. A cell returns a spanning forest of its links, never all of its pairs.

Distinct fingerprints alone are dealt, so copies cost one row. A cell of more than ``CHUNK`` of them is cut into chunks while it is read,
and each two of its chunks are compared in a task of their own: no task holds more than two chunks, and no pair is skipped.

``keep_one`` can confirm links on five-word shingles. What those links leave apart is then sought by an exact join on shingles
(``shingle_join.alike``), as fingerprints of texts at ``CONFIRM`` or more may differ in many bits.

Defined results: a null or empty text has fingerprint zero and links like any other; fewer words than the
shingle length make one shingle of the whole sequence; repeated rows share a fingerprint and a component;
a component's id is the smallest non-null doc_id in it (null if it has none); an empty table gives an
empty result. Only the id and text columns are read, so extra columns of any name do no harm.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, bounded_batches, materialise, release
from .graph import components, merge, portions
from .shingle_join import CONFIRM_SHINGLE, alike, confirmed, heads, occurrences
from .sketch import sketch

SHINGLE = 3
SEED = 42
MAX_BITS = 2
#: References of the dealing table: each has two neighbouring bits set, and no bit is set in two.
REFERENCES = np.uint64(3) << np.arange(0, 64, 2, dtype=np.uint64)
#: Bands of coordinates that any linked pair agrees on.
INTACT = 3
#: Dense reference fingerprints: a fixed pseudo-random sequence.
PIVOTS = np.random.default_rng(20).integers(0, 2**64, 24, dtype=np.uint64)
#: Rows of a cell compared with the rest at a time; rows up to which cells are compared together; rows of a cell held at once.
ROWS_AT_ONCE, SMALL_CELL, CHUNK = 512, 32, 8192

_word = re.compile(WORD)
_lower = {i: i + 32 for i in range(ord("A"), ord("Z") + 1)}


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash of one text."""
    found = _word.findall((text or "").translate(_lower))
    if not found:
        return 0
    if len(found) <= shingle:
        hashes = [xxhash.xxh64_intdigest(" ".join(found), seed)]
    else:
        hashes = [xxhash.xxh64_intdigest(" ".join(x), seed) for x in zip(*(found[i:] for i in range(shingle)), strict=False)]
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):  # bounded memory for very long texts
        part = np.array(hashes[at : at + (1 << 16)], dtype="<u8")
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, shingle: int = SHINGLE, seed: int = SEED) -> Column:
    """``fingerprint`` as a signed bigint column."""

    @F.pandas_udf("bigint")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle, seed) for t in texts], dtype=np.uint64).view(np.int64))

    return simhash(text)


def _survivors(prints: np.ndarray, table: np.ndarray, a: np.ndarray, b: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    for k in range(table.shape[1]):  # the maximum coordinate difference, one coordinate after another
        keep = np.abs(table[a, k] - table[b, k]) <= max_bits
        a, b = a[keep], b[keep]
        if not len(a):
            return a, b
    keep = np.bitwise_count(prints[a] ^ prints[b]) <= max_bits
    return a[keep], b[keep]


def _survivors(prints: np.ndarray, table: np.ndarray, a: np.ndarray, b: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    for k in range(table.shape[1]):  # the maximum coordinate difference, one coordinate after another
        keep = np.abs(table[a, k] - table[b, k]) <= max_bits
        a, b = a[keep], b[keep]
        if not len(a):
            return a, b
    keep = np.bitwise_count(prints[a] ^ prints[b]) <= max_bits
    return a[keep], b[keep]


def _pairs(prints: np.ndarray, cells: np.ndarray, max_bits: int, pivots: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of linked pairs inside cells, in portions: small cells by their gaps, each large one by blocks of rows."""
    n = len(prints)
    starts = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]]) if n else np.array([], dtype=int)
    lengths = np.diff(np.r_[starts, n])
    starts, lengths = starts[lengths > 1], lengths[lengths > 1]
    small = lengths <= SMALL_CELL
    if small.any():
        of = np.concatenate([np.arange(s, s + k) for s, k in zip(starts[small], lengths[small], strict=True)])
        table = _table(prints[of], pivots)
        run = np.repeat(np.arange(small.sum()), lengths[small])
        for gap in range(1, int(lengths[small].max())):
            a = np.flatnonzero(run[gap:] == run[:-gap])
            a, b = _survivors(prints[of], table, a, a + gap, max_bits)
            if len(a):
                yield of[a], of[b]
    for start, length in zip(starts[~small], lengths[~small], strict=True):
        part = prints[start : start + length]
        table = _table(part, pivots)
        order = np.argsort(table[:, 0], kind="stable")
        first = table[order, 0].astype(np.int16)
        second = table[order, 1].astype(np.int16)
        for at in range(0, length, ROWS_AT_ONCE):
            rows = np.arange(at, min(at + ROWS_AT_ONCE, length))
            end = np.searchsorted(first, first[rows[-1]] + max_bits, side="right")
            for other in range(at, end, 8 * ROWS_AT_ONCE):
                columns = np.arange(other, min(other + 8 * ROWS_AT_ONCE, end))
                near = np.abs(first[rows][:, None] - first[columns][None, :]) <= max_bits
                near &= rows[:, None] < columns[None, :]
                near &= np.abs(second[rows][:, None] - second[columns][None, :]) <= max_bits
                x, y = np.nonzero(near)
                x, y = _survivors(part, table[:, 2:], order[rows[x]], order[columns[y]], max_bits)
                if len(x):
                    yield x + start, y + start


def linked(prints: np.ndarray, cells: np.ndarray, max_bits: int = MAX_BITS, pivots: np.ndarray = PIVOTS) -> np.ndarray:
    """For each position the first position that it reaches through links inside its cell.

    ``cells`` has one number a row, equal numbers adjacent; ``prints`` are unsigned and sorted inside a cell.
    """
    roots = np.arange(len(prints))
    for a, b in _pairs(prints, cells, max_bits, pivots):
        merge(roots, a, b)
    return roots


def _table(prints: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.bitwise_count(prints[:, None] ^ pivots[None, :]).astype(np.int8)


def coordinates(fp: Column) -> Column:
    """The dealing table's row as one bigint, two bits a coordinate, from the lowest.

    1 - (d(x, r) - d(x, 0)) / 2 counts the bits of r that x has: one where its two bits differ, two where both are set.
    """
    low, other = F.lit(0x5555555555555555), F.shiftrightunsigned(fp, 1)
    return fp.bitwiseXOR(other).bitwiseAND(low).bitwiseOR(F.shiftleft(fp.bitwiseAND(other).bitwiseAND(low), 1))


def _masks(max_bits: int) -> list[int]:
    """One mask of coordinates for each choice of INTACT of max_bits + INTACT bands."""
    count, n = max_bits + INTACT, len(REFERENCES)
    edges = [2 * round(n * k / count) for k in range(count + 1)]
    out = []
    for chosen in combinations(range(count), INTACT):
        mask = sum((1 << edges[k + 1]) - (1 << edges[k]) for k in chosen)
        out.append(mask - (1 << 64) if mask >= 1 << 63 else mask)
    return out


def _forest(part: pd.DataFrame, keys: list[str], max_bits: int) -> pd.DataFrame:
    signed = part["fp"].to_numpy()
    new = np.zeros(len(part), dtype=bool)
    for c in (part[k].to_numpy() for k in keys):
        new[1:] |= c[1:] != c[:-1]
    roots = linked(signed.view(np.uint64), np.cumsum(new), max_bits)
    child = np.flatnonzero(roots != np.arange(len(roots)))
    return pd.DataFrame({"a": signed[child], "b": signed[roots[child]]})


def links(prints: DataFrame, max_bits: int = MAX_BITS, chunk: int = CHUNK) -> DataFrame:
    """(a, b): edges that join whatever distinct fingerprints (column ``fp``) link, directly or not."""
    if not 0 <= max_bits <= 8:
        raise ValueError("links of 0 to 8 bits are found")
    table, cell = coordinates(F.col("fp")), ["choice", "cell"]
    cells = prints.select("fp", F.posexplode(F.array(*[table.bitwiseAND(F.lit(m)) for m in _masks(max_bits)])).alias(*cell))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, number in portions(batches, cell, chunk):
            if number is None:
                yield _forest(part, cell, max_bits).assign(choice=0, cell=0, chunk=-1)
            else:  # too large to hold: its rows come again
                yield pd.DataFrame({"a": part["fp"], "b": part["fp"], "choice": part["choice"], "cell": part["cell"], "chunk": number})

    dealt = cells.repartition(*cell).sortWithinPartitions(*cell, "fp")
    found = materialise(dealt.mapInPandas(search, "a bigint, b bigint, choice int, cell bigint, chunk int"))
    edges, large = found.where("chunk < 0").select("a", "b"), found.where("chunk >= 0").select(F.col("a").alias("fp"), *cell, "chunk")
    counts = large.groupBy(*cell).agg((F.max("chunk") + 1).alias("chunks"))
    if counts.isEmpty():
        return edges
    two = [*cell, "low", "high"]
    again = large.join(counts, cell).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    again = again.select("fp", *cell, F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high")).repartition(*two).sortWithinPartitions(*two, "fp")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, _ in portions(batches, two, 2 * chunk):  # no more than two chunks meet
            yield _forest(part, two, max_bits)

    return materialise(edges.unionByName(again.mapInPandas(compare, "a bigint, b bigint")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS, confirm: bool = False) -> DataFrame:
    """One row a document: (doc_id, fp, component_id).

    With ``confirm``, fingerprints that differ link where the documents' five-word shingles are alike, and only there, however many bits
    differ: links within ``max_bits`` are confirmed first, and ``alike`` finds all others.
    """
    bounded_batches(docs.sparkSession)
    shingles = [sketch(F.col(text_col), CONFIRM_SHINGLE, 0).alias("s")] if confirm else []
    prints = docs.select(F.col(id_col).alias("doc_id"), fingerprint_column(F.col(text_col)).alias("fp"), *shingles)
    prints = materialise(heads(prints, occurrences(docs, text_col)) if confirm else prints)
    distinct = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    edges = links(distinct, max_bits)
    if confirm:
        edges = materialise(confirmed(edges, prints, docs, id_col, text_col))
        release(docs.sparkSession)
        edges = alike(prints, edges, docs, id_col, text_col)
    if edges.isEmpty():
        classes = distinct.select("fp", F.col("least").alias("component_id"))
    else:
        rooted = distinct.join(components(edges).withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
        smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
        classes = rooted.join(smallest, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS, confirm: bool = False) -> DataFrame:
    """The documents with one of each component: that whose id names it. Rows without an id stay."""
    classes = materialise(near_duplicates(docs, id_col, text_col, max_bits, confirm).where("doc_id is not null").select("doc_id", "component_id"))
    gone = classes.where("doc_id <> component_id").select(F.col("doc_id").alias("__gone")).distinct()
    kept = docs.join(gone, docs[id_col] == F.col("__gone"), "left_anti")
    repeated = materialise(classes.where("doc_id = component_id").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("__again")))
    if repeated.isEmpty():
        return kept
    single = kept.join(repeated, kept[id_col] == F.col("__again"), "left_anti")
    return single.unionByName(kept.join(repeated, kept[id_col] == F.col("__again"), "left_semi").dropDuplicates([id_col]))


def op10_simhash(spark, sf_dir: str) -> DataFrame:
    from .common import table

    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
