"""Packing documents into fixed windows of tokens: best-fit decreasing over a segment tree.

An overlong document is first cut into full windows; its rest and the shorter documents are then placed
longest first, each into the open window that it leaves tightest. The segment tree is indexed by remaining
capacity and holds the number of open windows at each, so the tightest fit is one descent.

Documents are tokenised where they are read. Pieces go to groups of some thousand documents, dealt by a hash of
the piece, and each group is packed by itself; a group leaves a handful of unfilled windows at most. A group is sorted by Spark and placed
while it streams by: a worker holds the open windows and one batch of pieces, never a group, so neither very long documents nor rows repeated
any number of times (which share a group) need more memory.

Defined results: a null text counts as empty and is one piece holding the end-of-text id alone; repeated rows
are packed once each; ties go by doc_id, start and payload; a null doc_id is kept; an empty table gives no rows.
Only the id and text columns are read, so extra columns of any name do no harm.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, table

WINDOW = 4096
END_OF_TEXT = 2
#: Documents to a group. A document has one piece at most that is not a full window.
GROUP = 8192
#: Words, and parts of words, whose ids a worker remembers in each of two generations (some 200 bytes each).
REMEMBERED = (300_000, 500_000)
#: Characters that Python takes for white space and the tokenizer's pattern does not.
NOT_SPACE = "\x1c\x1d\x1e\x1f"
#: Marks that often end a word.
MARKS = ".,;:!?"
#: Bytes as the tokenizer's vocabulary writes them: printable ones as they are, the others as letters from U+0100 on.
_SHOWN = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
BYTES = dict(zip([*_SHOWN, *(b for b in range(256) if b not in _SHOWN)], [*_SHOWN, *range(256, 512)], strict=False))
#: Fixed value: the tokenizer's pattern of a word's parts.
PARTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class Remembered(dict):
    """Results of ``find`` for the keys asked most lately, in two generations of ``most`` keys."""

    def __init__(self, find, most: int):
        self.find, self.most, self.older = find, most, {}

    def __missing__(self, key: str) -> bytes:
        found = self.older.get(key)
        if found is None:
            found = self.find(key)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = found
        return found


class WordTokens:
    """Ids of a text as little-endian unsigned 32-bit bytes, word by word.

    The tokenizer cuts at white space before anything else and drops it, so a text's ids are those of its words
    in turn; a word's ids are those of the parts that the tokenizer's pattern finds in it, lower-cased. Words beyond
    Latin letters, where lower case and composition depend on context, words with the one Latin letter whose lower case is a letter and a mark
    (U+0130) and words with a special token's mark go to the tokenizer whole.
    """

    def __init__(self, path: str, remembered: tuple[int, int] = REMEMBERED):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.pattern, self.latin = regex.compile(PARTS), regex.compile("[\x00-\u012f\u0131-\u024f]*")
        self.model = self.tokenizer.model
        probes = ("the", "antidisestablishment", "naïve", "łódź", "7", "...", "'s")
        direct = all(self._by_model(x) == self._encoded(x) for x in probes)  # a vocabulary of bytes, as BYTES has them
        self.parts = Remembered(self._by_model if direct else self._encoded, remembered[1])
        self.words = Remembered(self._by_parts, remembered[0])

    def _encoded(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _by_model(self, part: str) -> bytes:
        """Ids of one part by the merges alone: a lower-cased Latin part is what the tokenizer's earlier steps would leave as it is."""
        if not part.isprintable():
            return self._encoded(part)
        ids = [t.id for t in self.model.tokenize(part if part.isascii() else part.encode().decode("latin-1").translate(BYTES))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _by_parts(self, word: str) -> bytes:
        if not (word.isascii() or self.latin.fullmatch(word)) or "<|" in word:
            return self._encoded(word)
        if (core := word.rstrip(MARKS)).isalpha():  # letters, then marks: one part each
            return self.parts[core.lower()] + (self.parts[word[len(core) :]] if len(core) < len(word) else b"")
        return b"".join(map(self.parts.__getitem__, self.pattern.findall(word.lower())))

    def encode(self, text: str) -> bytes:
        if any(c in text for c in NOT_SPACE):
            return self._encoded(text)
        return b"".join(map(self.words.__getitem__, text.split()))


_loaded: dict[tuple, WordTokens] = {}


def tokens_of(path: str, remembered: tuple[int, int] = REMEMBERED) -> WordTokens:
    """The worker's own; it stays from task to task."""
    if (path, remembered) not in _loaded:
        _loaded.clear()
        _loaded[path, remembered] = WordTokens(path, remembered)
    return _loaded[path, remembered]


def tokenised(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, end: int = END_OF_TEXT, payload: str = "ids", remembered: tuple[int, int] = REMEMBERED) -> DataFrame:
    """Pieces (doc_id, start, length, doc_tokens, payload): a document's ids, then ``end``, cut into windows.

    ``payload`` says what of a piece's ids is carried: ``ids`` (array of int) or ``ids_crc32`` (their checksum).
    """
    kind = {"ids": "ids array<int>", "ids_crc32": "ids_crc32 bigint"}[payload]
    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, start bigint, length bigint, doc_tokens bigint, {kind}"
    last = int(end).to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokens_of(tokenizer, remembered)
        for batch in batches:
            row, starts, lengths, totals, parts = [], [], [], [], []
            for at, text in enumerate(batch.column(1).to_pylist()):
                ids = words.encode(text or "") + last
                n = len(ids) // 4
                for start in range(0, n, window):
                    part = ids[4 * start : 4 * (start + window)]
                    row.append(at)
                    starts.append(start)
                    lengths.append(len(part) // 4)
                    totals.append(n)
                    parts.append(zlib.crc32(part) if payload == "ids_crc32" else np.frombuffer(part, dtype="<i4"))
            carried = pa.array(parts, pa.int64() if payload == "ids_crc32" else pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int64())), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(totals, pa.int64()), carried], names=["doc_id", "start", "length", "doc_tokens", payload])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(cut, schema)


class OpenWindows:
    """Open windows by remaining capacity; a segment tree counts those at each capacity."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.count = [0] * (2 * self.size)
        self.at: list[list[int]] = [[] for _ in range(window + 1)]

    def _change(self, capacity: int, by: int) -> None:
        node = capacity + self.size
        while node:
            self.count[node] += by
            node >>= 1

    def add(self, capacity: int, window: int) -> None:
        self.at[capacity].append(window)
        self._change(capacity, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """The tightest open window that holds ``need``: (its capacity, its number)."""
        count, node = self.count, need + self.size
        if not count[node]:
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if count[2 * node] else 2 * node + 1
        capacity = node - self.size
        self._change(capacity, -1)
        return capacity, self.at[capacity].pop()


class Packer:
    """Places pieces that come longest first."""

    def __init__(self, window: int = WINDOW):
        self.window, self.opened, self.n = window, OpenWindows(window), 0

    def place(self, length: int) -> tuple[int, int]:
        """(window number, offset) of a piece of 1 to ``window`` tokens."""
        found = self.opened.take(length) if length < self.window else None
        if found is None:
            found, self.n = (self.window, self.n), self.n + 1
        capacity, number = found
        if capacity > length:
            self.opened.add(capacity - length, number)
        return number, self.window - capacity


def best_fit_decreasing(lengths: list[int], window: int = WINDOW) -> list[tuple[int, int]]:
    """(window number, offset) of each length; ``lengths`` descend and are 1 to ``window``."""
    return list(map(Packer(window).place, lengths))


def pack(pieces: DataFrame, groups: int, window: int = WINDOW) -> DataFrame:
    """``pieces`` (doc_id, start, length, ...) with sequence_id and offset (from 0, without gaps).

    A sequence id is the group's number times 2**32 plus the window's number in the group.
    """
    carried = [f for f in pieces.schema if f.name not in ("sequence_id", "offset")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in carried) + ", sequence_id bigint, offset bigint"
    names = [f.name for f in carried]

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, packer = None, Packer(window)
        for batch in batches:
            sequences, offsets = [], []
            for group, length in zip(batch.column(len(names)).to_pylist(), batch.column(names.index("length")).to_pylist(), strict=True):
                if group != now:
                    now, packer = group, Packer(window)
                number, offset = packer.place(length)
                sequences.append((group << 32) + number)
                offsets.append(offset)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(names))), pa.array(sequences, pa.int64()), pa.array(offsets, pa.int64())], names=[*names, "sequence_id", "offset"])

    dealt = pieces.select(*names).withColumn("__group", F.pmod(F.xxhash64(*names), F.lit(groups)).cast("bigint"))
    ordered = dealt.repartition("__group").sortWithinPartitions("__group", F.desc("length"), *[n for n in names if n != "length"])
    return ordered.mapInArrow(placed, schema)


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, end: int = END_OF_TEXT, payload: str = "ids", group: int = GROUP, remembered: tuple[int, int] = REMEMBERED) -> DataFrame:
    """Every document's pieces with their place: (doc_id, start, length, doc_tokens, payload, sequence_id, offset)."""
    bounded_batches(docs.sparkSession)
    groups = max(1, -(-docs.count() // group))
    return pack(tokenised(docs, tokenizer, id_col, text_col, window, end, payload, remembered), groups, window)


def op1_packing(spark, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    import public_tokenizers

    packed = pack_documents(table(spark, sf_dir, "documents"), tokenizer or public_tokenizers.path("word_bpe_49k.json"), payload="ids_crc32")
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
