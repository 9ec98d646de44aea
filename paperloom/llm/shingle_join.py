"""An exact join of near copies on word shingles, for what SimHash links leave apart.

Of two sets of shingle hashes at a Jaccard similarity of ``least`` or more, each has a share of ``least`` at least in the other, so the sets'
first hashes in any common order, a share of 1 - ``least`` and one more, have one in common. Sets that share such a hash meet in its cell.
The order is by how often the hashes' buckets (``BUCKETS`` of them) occur in all documents, then by hash: a passage that many documents share
comes last, and documents do not meet for its sake.

Pairs are discarded in turn by size, by ``PARITIES`` bits that are each set where an odd number of hashes falls to it, and by as many such bits
as a set has hashes: two sets differ in no fewer hashes than in these bits, so no pair at ``least`` is lost. What is left is compared hash by hash, the
last of it inside the cells.
No hash, cell or pair is capped. A cell of more than 2 ``CELL_ROWS`` sets is cut into chunks of about ``CELL_ROWS``, and every two chunks are a task of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, release
from .graph import components, portions, spanning
from .sketch import resemblance, sketch

#: Links are confirmed on shingles of so many words at such a Jaccard similarity.
CONFIRM_SHINGLE, CONFIRM = 5, 0.8
#: Buckets of hashes whose occurrences are counted to order them.
BUCKETS = 1 << 17
#: Bits of the parities that every row of a cell carries.
PARITIES = 512
#: Rows of a cell compared with the rest at a time; rows up to which cells are compared together; pairs held back.
ROWS_AT_ONCE, SMALL_CELL, HELD_PAIRS = 512, 32, 1_000_000
#: Sets of a large cell to a chunk.
CELL_ROWS = 8192
#: Hashes of the sets of a large cell to a chunk, where sets come with all their hashes.
CELL_HASHES = 1 << 20
#: Parities that a set's hashes are made to before sets are compared hash by hash.
PROVEN_BITS = 4096
#: Documents up to which the ids of those asked for are sent to every executor (some 40 bytes each).
BROADCAST_ROWS = 500_000


def cells_of(token: Column, sid: Column, n: Column, most: int | None = None) -> Column:
    """The cells that a set goes to: its token's, or where that has more than two chunks one with each other chunk, so that any two sets of a token meet."""
    chunks = F.ceil(n / F.lit(most or CELL_ROWS))
    own = F.pmod(F.xxhash64(sid), chunks)
    others = F.filter(F.sequence(F.lit(0).cast("long"), chunks - 1), lambda j: j != own)
    return F.when(chunks <= 2, F.array(token)).otherwise(F.transform(others, lambda j: F.xxhash64(token, F.least(own, j), F.greatest(own, j))))


def _hashes_of(asked: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``asked`` (__id, sid, ...) with the shingle hashes s of that document whose set has the hash ``sid``: documents may share an id."""
    asked = materialise(asked)
    few = F.broadcast(asked) if asked.count() <= BROADCAST_ROWS else asked  # a few numbers a row; texts are shuffled only beyond that
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).join(few, "__id")
    # explode keeps the filter from computing the shingles once more
    found = texts.select(*asked.columns, F.explode(F.array(sketch(F.col("__text"), CONFIRM_SHINGLE, 0))).alias("s"))
    return found.where(F.xxhash64("s") == F.col("sid")).dropDuplicates(["__id", "sid"])


def _alike_pairs(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) of sids whose sets (sid, s) reach ``least``."""
    a, b = (sets.select(F.col("sid").alias(k), F.col("s").alias(f"s{k}")) for k in "ab")
    return pairs.join(a, "a").join(b, "b").where(resemblance(F.col("sa"), F.col("sb"), F.lit(True)) >= least).select("a", "b")


def occurrences(docs: DataFrame, text_col: str) -> np.ndarray:
    """How many shingles of all documents fall to each bucket of hashes; summed map-side, so ``BUCKETS`` rows a task are shuffled at most."""
    each = docs.select(F.explode(F.transform(sketch(F.col(text_col), CONFIRM_SHINGLE, 0), lambda h: h.bitwiseAND(F.lit(BUCKETS - 1)))).alias("bucket"))
    found = each.groupBy("bucket").count().toArrow()  # one row a bucket
    out = np.zeros(BUCKETS, dtype=np.int64)
    out[found["bucket"].to_numpy()] = found["count"].to_numpy()
    return out


def summaries(sets: Column, counts: np.ndarray, least: float = CONFIRM) -> Column:
    """struct(head, odd, wide): a set's first hashes; PARITIES bits of it as bytes; and as longs the least power of two of bits that is no less than the set or PARITIES."""

    @F.pandas_udf("struct<head: array<bigint>, odd: binary, wide: array<bigint>>")
    def summed(sets: pd.Series) -> pd.DataFrame:
        first, few, many = [], [], []
        for s in sets:
            first.append(s[np.lexsort((s, counts[s & (BUCKETS - 1)]))[: int((1 - least) * len(s) + 1e-6) + 1]])
            width = max(PARITIES, 1 << max(0, len(s) - 1).bit_length())
            bits = (np.bincount(s & (width - 1), minlength=width) & 1).astype(np.uint8)
            wide = np.packbits(bits, bitorder="little").view(np.int64)
            many.append(wide)
            few.append(np.bitwise_xor.reduce(wide.reshape(-1, PARITIES // 64), axis=0).tobytes())
        return pd.DataFrame({"head": pd.Series(first, dtype=object), "odd": pd.Series(few, dtype=object), "wide": pd.Series(many, dtype=object)})

    return summed(sets)


def heads(prints: DataFrame, counts: np.ndarray, least: float = CONFIRM) -> DataFrame:
    """``prints`` with sid, size, head, odd and wide for the shingles s: a hash of their set, its size, and its ``summaries``."""
    kept = [c for c in prints.columns if c != "s"]
    return prints.withColumn("p", summaries(F.col("s"), counts, least)).select(*kept, F.xxhash64("s").alias("sid"), F.size("s").alias("size"), "p.head", "p.odd", "p.wide")


def _may_reach(least: float) -> Column:
    """Whether sizes (na, nb) and wide parities (wa, wb) let a pair reach ``least``."""
    half = lambda w: F.zip_with(F.slice(w, F.lit(1), (F.size(w) / 2).cast("int")), F.slice(w, (F.size(w) / 2).cast("int") + 1, (F.size(w) / 2).cast("int")), lambda x, y: x.bitwiseXOR(y))
    wa, wb = (F.when(F.size(x) > F.size(y), half(F.col(x))).otherwise(F.col(x)) for x, y in (("wa", "wb"), ("wb", "wa")))
    differ = F.aggregate(F.zip_with(wa, wb, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
    return (F.least("na", "nb") >= least * F.greatest("na", "nb") - 1e-6) & (differ <= (F.col("na") + F.col("nb")) * ((1 - least) / (1 + least)) + 1e-6)


def confirmed(edges: DataFrame, prints: DataFrame, docs: DataFrame, id_col: str, text_col: str, least: float = CONFIRM) -> DataFrame:
    """The links (a, b) between fingerprints of which one document each shares enough shingles; ``prints`` is as ``alike`` takes it."""
    asked = edges.select(F.explode(F.array("a", "b")).alias("fp")).distinct()
    owners = prints.where("doc_id is not null").join(asked, "fp").groupBy("fp").agg(F.min_by(F.struct("doc_id", "sid"), F.struct("doc_id", "sid")).alias("x")).select("fp", F.col("x.doc_id").alias("__id"), F.col("x.sid").alias("sid"))
    sets = materialise(_hashes_of(owners, docs, id_col, text_col).select("sid", "s").dropDuplicates(["sid"]))
    named = [owners.select(F.col("fp").alias(k), F.col("sid").alias(f"s{k}")) for k in "ab"]
    pairs = edges.join(named[0], "a").join(named[1], "b")
    right = _alike_pairs(pairs.select(F.col("sa").alias("a"), F.col("sb").alias("b")).distinct(), sets, least).select(F.col("a").alias("sa"), F.col("b").alias("sb"))
    return pairs.join(right, ["sa", "sb"]).select("a", "b")


def _maybe_alike(cells: np.ndarray, size: np.ndarray, label: np.ndarray, odd: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(a, b, parities that differ) of pairs inside cells with other labels that can reach ``least``; rows are sorted by size inside a cell."""

    def able(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keep = (label[a] != label[b]) & (np.minimum(size[a], size[b]) >= least * np.maximum(size[a], size[b]) - 1e-6)
        a, b = a[keep], b[keep]
        most, d = (size[a] + size[b]) * ((1 - least) / (1 + least)) + 1e-6, np.zeros(len(a), dtype=np.int64)
        for k in range(odd.shape[1]):
            d = d + np.bitwise_count(odd[a, k] ^ odd[b, k])
            keep = d <= most
            a, b, d, most = a[keep], b[keep], d[keep], most[keep]
        return a, b, d

    starts = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]]) if len(cells) else np.array([], dtype=int)
    lengths = np.diff(np.r_[starts, len(cells)])
    small = lengths <= SMALL_CELL
    of = np.flatnonzero(np.repeat(small, lengths))
    for gap in range(1, int(lengths[small].max(initial=1))):
        at = np.flatnonzero(cells[of[gap:]] == cells[of[:-gap]])
        yield able(of[at], of[at + gap])
    for start, length in zip(starts[~small], lengths[~small], strict=True):
        own = label[start : start + length]
        names, counts = np.unique(own, return_counts=True)
        most = own == names[counts.argmax()]  # rows of one label aren't compared with each other
        fewer, sizes = np.flatnonzero(~most), size[start : start + length]
        for at in range(0, len(fewer), ROWS_AT_ONCE):
            rows = fewer[at : at + ROWS_AT_ONCE]
            low, high = np.searchsorted(sizes, least * sizes[rows[0]] - 1e-6), np.searchsorted(sizes, sizes[rows[-1]] / least + 1e-6, side="right")
            for other in range(low, high, 8 * ROWS_AT_ONCE):
                columns = np.arange(other, min(other + 8 * ROWS_AT_ONCE, high))
                x, y = np.nonzero(most[columns][None, :] | (rows[:, None] < columns[None, :]))
                yield able(rows[x] + start, columns[y] + start)


def _shortest_between(pairs: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], label: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """One portion: pairs that make a minimum spanning forest of the labels."""
    kept = tuple(np.zeros(0, dtype=np.int64) for _ in range(3))
    held: list[tuple[np.ndarray, ...]] = []

    def cut() -> None:
        nonlocal kept
        a, b, d = (np.concatenate([x, *(h[k] for h in held)]) for k, x in enumerate(kept))
        held.clear()
        chosen = spanning(len(label), label[a], label[b], d)
        kept = a[chosen], b[chosen], d[chosen]

    for pair in pairs:
        held.append(pair)
        if sum(len(x[0]) for x in held) > 4 * len(label) + HELD_PAIRS:
            cut()
    cut()
    return [kept]


def _columns(part: pd.DataFrame) -> tuple[np.ndarray, ...]:
    """sid, token, size, label and odd parities (a row of longs each) of a portion."""
    odd = np.frombuffer(b"".join(part["odd"]), dtype=np.uint64).reshape(len(part), -1)
    return part["sid"].to_numpy(), part["token"].to_numpy(), part["size"].to_numpy().astype(np.int64), part["label"].to_numpy(), odd


def _with_partner(token: np.ndarray, size: np.ndarray, label: np.ndarray, odd: np.ndarray, wide: list[np.ndarray], least: float) -> np.ndarray:
    """Which rows may reach ``least`` with another of their cell that has another label, by their wide parities too."""
    hit = np.zeros(len(token), dtype=bool)
    for a, b, _ in _maybe_alike(token, size, label, odd, least):
        new = ~(hit[a] & hit[b])
        for x, y in zip(a[new].tolist(), b[new].tolist(), strict=True):
            if hit[x] and hit[y]:
                continue
            p, q = sorted((wide[x], wide[y]), key=len)
            while len(q) > len(p):
                q = q[: len(q) // 2] ^ q[len(q) // 2 :]
            if np.bitwise_count((p ^ q).view(np.uint64)).sum() <= (size[x] + size[y]) * ((1 - least) / (1 + least)) + 1e-6:
                hit[x] = hit[y] = True
    return hit


def _proven(part: pd.DataFrame, least: float) -> pd.DataFrame:
    """(a, b): a spanning forest of the portion's links between labels; rows (sid, token, size, label, s) are sorted by size inside a cell."""
    sid, s = part["sid"].to_numpy(), list(part["s"])
    label, node = np.unique(part["label"].to_numpy(), return_inverse=True)
    odd = np.zeros((len(s), PROVEN_BITS // 64), dtype=np.uint64)
    for at, x in enumerate(s):
        odd[at] = np.packbits((np.bincount(x & (PROVEN_BITS - 1), minlength=PROVEN_BITS) & 1).astype(np.uint8), bitorder="little").view(np.uint64)
    roots, found = list(range(len(label))), []

    def root(n: int) -> int:
        while roots[n] != n:
            roots[n] = n = roots[roots[n]]
        return n

    for a, b, _ in _maybe_alike(part["token"].to_numpy(), part["size"].to_numpy().astype(np.int64), node, odd, least):
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            p, q = root(node[x]), root(node[y])
            if p == q:  # joined by now
                continue
            both = len(np.intersect1d(s[x], s[y], assume_unique=True))
            if both / (len(s[x]) + len(s[y]) - both) >= least:
                roots[max(p, q)] = min(p, q)
                found.append((min(sid[x], sid[y]), max(sid[x], sid[y])))
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def alike(prints: DataFrame, edges: DataFrame, docs: DataFrame, id_col: str, text_col: str, least: float = CONFIRM) -> DataFrame:
    """(a, b): fingerprints to join beyond ``edges`` so that all documents whose shingles reach ``least`` end together.

    ``prints`` has (doc_id, fp) and what ``heads`` adds; documents without an id are left out. A spanning forest of the pairs that may be
    alike is confirmed first. Of what that leaves apart, sets that may be alike to another go back to their cells with all their hashes and are
    compared there, each pair, so what is written grows with the cells' rows and not with their pairs.
    """
    sets = prints.where("doc_id is not null and size > 0")
    owners = materialise(sets.groupBy("sid").agg(F.min("fp").alias("owner"), F.min("doc_id").alias("__id"), F.first("size").alias("size"), F.first("odd").alias("odd"), F.first("wide").alias("wide")))
    edges = edges.unionByName(sets.select("sid", "fp").distinct().join(owners.select("sid", "owner"), "sid").where("fp <> owner").select(F.col("owner").alias("a"), F.col("fp").alias("b")))
    first = sets.select("sid", F.explode("head").alias("token")).repartition("token")  # one exchange for both sides of the join
    again = first.groupBy("token").agg(F.min("sid").alias("x"), F.max("sid").alias("y")).where("x <> y").select("token")
    rows = materialise(first.join(again, "token", "left_semi").distinct())
    release(prints.sparkSession)
    # of cells with the same members one is enough
    members = rows.groupBy("token").agg(F.count("*").alias("n"), F.bit_xor("sid").alias("x"), F.bit_xor(F.xxhash64("sid")).alias("y"))
    rows = materialise(rows.join(members.groupBy("n", "x", "y").agg(F.min("token").alias("token")).select("token", "n"), "token"))
    release(prints.sparkSession)

    def dealt(edges: DataFrame, *carried: str) -> DataFrame:
        """Rows of all cells, a cell's by size, with the label of the edges so far."""
        own = owners.select("sid", F.col("owner").alias("fp"), "size", "odd", *carried)
        labels = own.withColumn("label", F.col("fp")) if edges.isEmpty() else own.join(components(edges).withColumnRenamed("node", "fp"), "fp", "left").withColumn("label", F.coalesce("root", "fp"))
        cells = rows.select("sid", F.explode(cells_of(F.col("token"), F.col("sid"), F.col("n"))).alias("token"))
        return cells.join(labels.select("sid", "size", "odd", "label", *carried), "sid").repartition("token").sortWithinPartitions("token", "size")

    def nearest(edges: DataFrame) -> DataFrame:
        """(a, b): a spanning forest of each portion's pairs that may be alike."""

        def found(part: pd.DataFrame) -> Iterator[pd.DataFrame]:
            sid, token, size, label, odd = _columns(part)
            for a, b, _ in _shortest_between(_maybe_alike(token, size, label, odd, least), np.unique(label, return_inverse=True)[1]):
                yield pd.DataFrame({"a": np.minimum(sid[a], sid[b]), "b": np.maximum(sid[a], sid[b])})

        pairs = dealt(edges).mapInPandas(lambda batches: (x for part, _ in portions(batches, ["token"]) for x in found(part)), "a bigint, b bigint").distinct()
        a, b = (owners.select(F.col("sid").alias(k), F.col("size").alias(f"n{k}"), F.col("wide").alias(f"w{k}")) for k in "ab")
        return materialise(pairs.join(a, "a").join(b, "b").where(_may_reach(least)).select("a", "b"))

    def unsettled(edges: DataFrame) -> DataFrame:
        """(token, sid, size, label): sets that may be alike to another of their cell that the edges leave apart; at most the rows of the cells."""

        def met(part: pd.DataFrame) -> pd.DataFrame:
            _, token, size, label, odd = _columns(part)
            return part.loc[_with_partner(token, size, label, odd, list(part["wide"]), least), ["token", "sid", "size", "label"]]

        return materialise(dealt(edges, "wide").mapInPandas(lambda batches: (met(part) for part, _ in portions(batches, ["token"])), "token bigint, sid bigint, size int, label bigint"))

    def settled(open_: DataFrame) -> DataFrame:
        """(a, b): fingerprints to join, a spanning forest a portion; sets are compared hash by hash where they meet, so no pair leaves a task but as a link."""
        held = materialise(_hashes_of(open_.select("sid").distinct().join(owners.select("sid", "__id"), "sid"), docs, id_col, text_col).select("sid", "s"))
        total = open_.groupBy("token").agg(F.sum("size").alias("hashes"))
        cells = open_.join(total, "token").select("sid", "size", "label", F.explode(cells_of(F.col("token"), F.col("sid"), F.col("hashes"), CELL_HASHES)).alias("token"))
        cells = cells.join(held, "sid").select("sid", "token", "size", "label", "s").repartition("token").sortWithinPartitions("token", "size")
        links = cells.mapInPandas(lambda batches: (_proven(part, least) for part, _ in portions(batches, ["token"])), "a bigint, b bigint")
        a, b = (owners.select(F.col("sid").alias(k), F.col("owner").alias(f"fp{k}")) for k in "ab")
        return links.distinct().join(a, "a").join(b, "b").select(F.col("fpa").alias("a"), F.col("fpb").alias("b"))

    def right(pairs: DataFrame) -> DataFrame:
        asked = pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct().join(owners.select("sid", "__id"), "sid")
        held = materialise(_hashes_of(asked, docs, id_col, text_col).select("sid", "s"))
        a, b = (owners.select(F.col("sid").alias(k), F.col("owner").alias(f"fp{k}")) for k in "ab")
        return _alike_pairs(pairs, held, least).join(a, "a").join(b, "b").select(F.col("fpa").alias("a"), F.col("fpb").alias("b"))

    edges = materialise(edges)
    tried = nearest(edges)
    if tried.isEmpty():
        return edges
    edges = materialise(edges.unionByName(right(tried)))
    release(prints.sparkSession)
    open_ = unsettled(edges)
    return edges if open_.isEmpty() else materialise(edges.unionByName(settled(open_)))
