"""Language identification by prediction with partial matching (PPM).

Each language has a tree of byte contexts of order 3 and less. The code length of a byte is that of the longest
context that has it: -log2(count / (total + distinct)), with an escape of -log2(distinct / (total + distinct))
for each longer context that the language knows and that lacks the byte; a context that it does not know costs
nothing; below order 0 a byte costs 8 bits. Statistics are frozen after training, so a byte's length depends on
the byte and the three before it alone: a worker flattens the trees into one array of lengths, a row for each known
context and a column for each byte, and scoring is two look-ups a byte over the whole text. The language with
the least total length is predicted; the score is its posterior under equal priors.

Bounds, all parameters: training reads at most ``SAMPLE`` documents of a language (whole texts, those of least hash, none of more than
``LONGEST`` characters). What goes to the executors are the counts of contexts seen, about one or two megabytes a language. Languages whose flat array would take more
than ``TABLE_BYTES`` together are scored in groups, one after the other over the same texts: a language's lengths do not depend on the others, so any number of
languages gives what one array would.

Defined results: null texts and texts without a letter are ``und`` with score 0, as is everything when no row has a language
to learn; bytes never seen in training cost the same in every language but for the escapes; repeated rows repeat;
ties go to the first language in order; an empty table gives no rows. Only the named columns are read, so
extra columns of any name do no harm.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, table

SAMPLE = 300
#: Characters of a document that is trained on, and bytes of the table, at most.
LONGEST, TABLE_BYTES = 100_000, 256 << 20
ORDER = 3
FOLDS, HELD_OUT = 3, 1
UNKNOWN = "und"
#: Bytes scored at a time.
CHUNK = 1 << 20

_letter = re.compile(r"[^\W\d_]")


#: Of one language and each order: codes of the contexts with the byte that follows, sorted, and how often they occur.
Tree = tuple[tuple[np.ndarray, np.ndarray], ...]


def flattened(trees: list[Tree], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(row of each context of three symbols, length in bits by row, symbol and language)."""
    known = np.unique(np.concatenate([t[ORDER][0] // width for t in trees]))
    rows = np.tile(np.arange(width**2, dtype=np.int32), width)  # contexts not known go to the row of their last two symbols
    rows[known] = width**2 + np.arange(len(known), dtype=np.int32)
    bits = np.empty((width**2 + len(known), width, len(trees)), dtype=np.float32)
    for at, tree in enumerate(trees):
        lower = np.full((1, width), 8.0)
        for order in range(ORDER + 1):
            codes, counts = tree[order]
            contexts = codes // width
            if order == ORDER:
                lower = lower[known % width**2]
                place = np.searchsorted(known, contexts)
            else:
                lower = np.tile(lower, (width if order else 1, 1))
                place = contexts
            total = np.bincount(place, counts, len(lower))
            distinct = np.bincount(place, minlength=len(lower))
            has = total > 0
            escape = np.zeros(len(lower))
            escape[has] = np.log2((total[has] + distinct[has]) / distinct[has])
            lower = lower + escape[:, None]
            lower[place, codes % width] = np.log2((total[place] + distinct[place]) / counts)
            if order == ORDER - 1:
                bits[: width**2, :, at] = lower
        bits[width**2 :, :, at] = lower
    return rows, bits.reshape(-1, len(trees))


class Model:
    """Context trees by language, flattened a group of languages at a time."""

    def __init__(self, languages: list[str], symbols: np.ndarray, width: int, trees: list[Tree], table_bytes: int = TABLE_BYTES):
        self.languages, self.symbols, self.width, self.trees, self.table_bytes = languages, symbols, width, trees, table_bytes
        self._flat: tuple[int, tuple] | None = None
        self.groups: list[list[int]] = []
        known: np.ndarray = np.zeros(0, dtype=np.int64)
        for k, tree in enumerate(trees):
            both = np.union1d(known, tree[ORDER][0] // width)
            if self.groups and 4 * width * (width**2 + len(both)) * (len(self.groups[-1]) + 1) <= table_bytes:
                self.groups[-1].append(k)
                known = both
            else:
                self.groups.append([k])
                known = np.unique(tree[ORDER][0] // width)

    def group(self, g: int) -> tuple[np.ndarray, np.ndarray]:
        if self._flat is None or self._flat[0] != g:
            self._flat = None  # one group's array at a time
            self._flat = (g, flattened([self.trees[k] for k in self.groups[g]], self.width))
        return self._flat[1]

    def lengths(self, text: str, g: int) -> np.ndarray:
        """Code length of the whole text in each language of a group, in bits."""
        rows, bits = self.group(g)
        raw = text.encode("utf-8", "surrogatepass")
        total = np.zeros(bits.shape[1])
        for at in range(0, len(raw), CHUNK):
            lead = min(at, ORDER)
            part = self.symbols[np.frombuffer(raw, dtype=np.uint8, offset=at - lead, count=min(CHUNK, len(raw) - at) + lead)]
            part = np.concatenate([np.full(ORDER - lead, self.width - 1, dtype=np.int32), part])
            context = (part[:-3] * self.width + part[1:-2]) * self.width + part[2:-1]
            total += bits[rows[context] * self.width + part[3:]].sum(0, dtype=np.float64)
        return total

    def predictions(self, texts: Iterable[str | None]) -> list[tuple[str, float]]:
        texts = list(texts)
        spoken = [k for k, t in enumerate(texts) if t and self.languages and _letter.search(t)]
        bits = np.zeros((len(spoken), len(self.languages)))
        for g, group in enumerate(self.groups if spoken else []):
            for row, k in enumerate(spoken):
                bits[row, group] = self.lengths(texts[k], g)
        out = [(UNKNOWN, 0.0)] * len(texts)
        for row, k in zip(bits, spoken, strict=True):
            best = int(row.argmin())
            out[k] = (self.languages[best], float(1 / np.exp2(-np.minimum(row - row[best], 200)).sum()))
        return out

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.predictions([text])[0]


NOTHING = Model([], np.zeros(256, dtype=np.int32), 1, [])


def train(texts: Mapping[str, Iterable[str]], table_bytes: int = TABLE_BYTES) -> Model:
    """Count contexts of each language's texts."""
    languages = sorted(texts)
    raw = {k: [np.frombuffer(t.encode("utf-8", "surrogatepass"), dtype=np.uint8) for t in texts[k] if t] for k in languages}
    seen = np.zeros(256, dtype=bool)
    for parts in raw.values():
        for x in parts:
            seen[x] = True
    if not seen.any():
        return NOTHING
    width = int(seen.sum()) + 1  # the last symbol stands for bytes never seen and for what precedes a text
    symbols = np.full(256, width - 1, dtype=np.int32)
    symbols[seen] = np.arange(width - 1)
    none = np.full(ORDER, width - 1, dtype=np.int64)
    trees = []
    for k in languages:
        stream = [np.concatenate([none, symbols[x].astype(np.int64)]) for x in raw[k]]
        tree = []
        for order in range(ORDER + 1):
            grams = []
            for x in stream:
                code = np.zeros(len(x) - ORDER, dtype=np.int64)
                for back in range(order, -1, -1):
                    code = code * width + x[ORDER - back : len(x) - back]
                grams.append(code)
            tree.append(np.unique(np.concatenate(grams), return_counts=True) if grams else (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)))
        trees.append(tuple(tree))
    return Model(languages, symbols, width, trees, table_bytes)


def fold(id_col: str = "doc_id", folds: int = FOLDS) -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> Model:
    """Train on documents with a language outside the held-out fold: ``sample`` of each language at most."""
    learned = docs.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & (fold(id_col) != HELD_OUT) & (F.coalesce(F.length(text_col), F.lit(0)) <= LONGEST))
    counts = {r[0]: r[1] for r in learned.groupBy(F.col(lang_col)).count().collect()}  # one row a language
    if not counts:
        return NOTHING
    draw = F.shiftrightunsigned(F.xxhash64(id_col), 11) / F.lit(float(1 << 53))
    share = F.element_at(F.create_map(*[F.lit(x) for k, n in sorted(counts.items()) for x in (k, min(1.0, 3.0 * sample / n + 1e-9))]), F.col(lang_col))
    some = learned.where(draw < share).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), draw.alias("draw"), F.col(id_col).alias("doc_id"))
    ranked = some.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("draw", "doc_id", "text"))).where(F.col("n") <= sample)
    texts: dict[str, list[str]] = {k: [] for k in counts}
    for r in ranked.select("lang", "text").collect():
        texts[r["lang"]].append(r["text"])
    return train(texts)


def predicted_column(text: Column, model: Model, spark) -> Column:
    """struct(lang_pred, score); the model goes to the executors once."""
    shared = spark.sparkContext.broadcast((model.languages, model.symbols, model.width, model.trees, model.table_bytes))
    held: list[Model] = []  # a worker's own, for as long as it has this function

    @F.pandas_udf("lang_pred string, score double")
    def language(texts: pd.Series) -> pd.DataFrame:
        if not held:
            held.append(Model(*shared.value))
        return pd.DataFrame(held[0].predictions(texts), columns=["lang_pred", "score"])

    return language(text)


def predicted(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document."""
    bounded_batches(docs.sparkSession)
    found = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(fold(id_col) == HELD_OUT, F.lit(False)).alias("held_out"), predicted_column(F.col(text_col), model, docs.sparkSession).alias("p"))
    return found.select("doc_id", "held_out", "p.lang_pred", "p.score")


def accepted(docs: DataFrame, model: Model, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The documents with a language predicted at a score of ``least`` or more, with all their columns."""
    bounded_batches(docs.sparkSession)
    p = predicted_column(F.col(text_col), model, docs.sparkSession)
    return docs.where((p["lang_pred"] != UNKNOWN) & (p["score"] >= least))


def op6_language(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predicted(docs, fit(docs))
