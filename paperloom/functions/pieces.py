"""Counts of a text's sub-word tokens by a given vocabulary, longest piece first."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Words whose counts a worker remembers.
KNOWN = 200_000
#: Letters of the longest word that is cut; a longer one is one unknown token.
LONGEST_WORD = 100
_parts = re.compile(r"\w+|[^\w\s]")


def read_vocabulary(lines: Iterable[str]) -> tuple[list[str], list[str]]:
    """(pieces that begin a word, pieces that go on in one) of a vocabulary: one piece a line, ``##`` before those that go on; or the JSON of a merge vocabulary, whose pieces do both."""
    text = "\n".join(lines)
    if text.lstrip().startswith("{"):
        own = [p.removesuffix("</w>") for p in json.loads(text)["model"]["vocab"]]
        both = sorted({p for p in own if p and not p.startswith("<|")})
        return both, both
    own = [p for p in text.split("\n") if p]
    return [p for p in own if not p.startswith("##")], [p[2:] for p in own if p.startswith("##")]


class Trie:
    """Pieces by their letters; a node's None says that a piece ends there."""

    def __init__(self, pieces: Iterable[str]):
        self.root: dict = {}
        for p in pieces:
            node = self.root
            for c in p:
                node = node.setdefault(c, {})
            node[None] = None

    def longest(self, word: str, at: int) -> int:
        """Where the longest piece that begins at a place ends; that place if none does."""
        node, end = self.root, at
        for i in range(at, len(word)):
            node = node.get(word[i])
            if node is None:
                break
            if None in node:
                end = i + 1
        return end


class Counter:
    def __init__(self, begins: Iterable[str], goes_on: Iterable[str]):
        self.begins, self.goes_on, self.known = Trie(begins), Trie(goes_on), {}

    def of_word(self, word: str) -> int:
        """Pieces of a word; a word that cannot be cut whole is one unknown token."""
        if (n := self.known.get(word)) is None:
            if len(self.known) > KNOWN:
                self.known.clear()
            n, at = 0, 0
            while at < len(word) <= LONGEST_WORD:
                end = (self.goes_on if at else self.begins).longest(word, at)
                if end == at:
                    break
                n, at = n + 1, end
            n = self.known[word] = n if at == len(word) else 1
        return n

    def of_text(self, text: str | None) -> int:
        """Tokens of a text with the two special ones."""
        return 2 + sum(map(self.of_word, _parts.findall((text or "").lower())))


def token_counts(spark: SparkSession, vocabulary: tuple[list[str], list[str]]):
    """A function of a text column: its number of tokens. The vocabulary goes to the executors once, and a trie is built once a task."""
    sent = spark.sparkContext.broadcast(vocabulary)

    @F.pandas_udf("int")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = Counter(*sent.value)
        for texts in batches:
            yield pd.Series([counter.of_text(t) for t in texts], dtype="int32")

    def of(text: Column) -> Column:
        return counted(text)

    return of
