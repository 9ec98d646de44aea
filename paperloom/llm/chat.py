"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are context, and the reply alone is under
the loss mask. A conversation whose last turn isn't the assistant's (or that has none) is written once more in full
with nothing under the mask, so that no turn is lost.

A turn is written ``<s>[ROLE]role[/ROLE]text</s>``. Control strings inside roles and texts are escaped: each backslash
is doubled, and a backslash is put before each control string; taking one backslash away before any
character undoes both.

Rows are dealt by conversation and sorted by turn inside a partition; a worker reads conversations one after another
and keeps one prefix, which grows by a turn at a time, so its memory is that of the longest conversation's
text. Examples are as long as prefix-target expansion makes them.

Defined results: a null text or role is empty; turns with a null number come first; equal turn numbers go by role, then
text; repeated rows are turns of their own; rows with a null conv_id are one conversation; an empty table gives no rows. Only the four
named columns are read, so extra columns of any name do no harm.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, table

#: Strings that mean something to the template or to models trained on it.
CONTROL = ("<s>", "</s>", "[ROLE]", "[/ROLE]", "[INST]", "[/INST]")
TRAINED = "assistant"
#: Characters of examples in one batch to Spark.
BATCH_CHARS = 16 << 20

_special = re.compile("|".join(map(re.escape, CONTROL)))
_escaped = re.compile(r"\\(.)", re.S)
_piece = re.compile(r"\\.|<s>\[ROLE\]|\[/ROLE\]|</s>", re.S)


class Example(NamedTuple):
    conv_id: object
    example: int  # 0, 1, ... in a conversation
    text: str
    loss_start: int  # both 0 where nothing is trained
    loss_end: int
    last: bool  # the conversation's last: it holds all turns


def escape(text: str) -> str:
    return _special.sub(lambda m: "\\" + m[0], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _escaped.sub(r"\1", text)


def expand(conv_id, turns: list[tuple[str, str]]) -> Iterator[Example]:
    """Examples of one conversation, given as (role, text) in order."""
    prefix, n = "", 0
    for at, (role, text) in enumerate(turns):
        start = len(prefix) + len("<s>[ROLE]") + len(own := escape(role)) + len("[/ROLE]")
        said = escape(text)
        prefix += f"<s>[ROLE]{own}[/ROLE]{said}</s>"
        last = at == len(turns) - 1
        if role == TRAINED:
            yield Example(conv_id, n, prefix, start, start + len(said), last)
            n += 1
        elif last:
            yield Example(conv_id, n, prefix, 0, 0, True)


def read_back(text: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of an example."""
    turns, role, begin = [], "", 0
    for m in _piece.finditer(text):
        if m[0] == "<s>[ROLE]":
            begin = m.end()
        elif m[0] == "[/ROLE]":
            role, begin = unescape(text[begin : m.start()]), m.end()
        elif m[0] == "</s>":
            turns.append((role, unescape(text[begin : m.start()])))
    return turns


def _conversations(batches: Iterable[pd.DataFrame]) -> Iterator[tuple[object, list[tuple[str, str]]]]:
    """Conversations of a partition's sorted rows; one may span batches."""
    now, turns = None, []
    for batch in batches:
        for conv_id, known, role, text in zip(batch["conv_id"], batch["known"], batch["role"], batch["text"], strict=True):
            key = conv_id if known else None
            if turns and key != now:
                yield now, turns
                turns = []
            now = key
            turns.append((role, text))
    if turns:
        yield now, turns


def _dealt(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    bounded_batches(rows.sparkSession)
    known = rows.select(
        F.coalesce(F.col(conv_col).cast("long"), F.lit(0)).alias("conv_id"), F.col(conv_col).isNotNull().alias("known"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    return known.repartition("conv_id", "known").sortWithinPartitions("conv_id", "known", "turn", "role", "text").select("conv_id", "known", "role", "text")


def formatted(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The examples: (conv_id, example, text, loss_start, loss_end, last); offsets count characters."""

    def written(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, size = [], 0
        for conv_id, turns in _conversations(batches):
            for e in expand(conv_id, turns):
                out.append(e)
                size += len(e.text)
                if size > BATCH_CHARS:
                    yield pd.DataFrame(out, columns=Example._fields).astype({"conv_id": "Int64"})
                    out, size = [], 0
        yield pd.DataFrame(out, columns=Example._fields).astype({"conv_id": "Int64"})

    return _dealt(rows, conv_col, turn_col, role_col, text_col).mapInPandas(written, "conv_id bigint, example bigint, text string, loss_start bigint, loss_end bigint, last boolean")


def digest(examples: Iterable[Example]) -> tuple:
    """What a conversation's examples say when read back: see the fields of ``digests``."""
    trained, size, turns, conv_id = [], 0, [], None
    for e in examples:
        conv_id = e.conv_id
        trained.append(unescape(e.text[e.loss_start : e.loss_end]))
        size += len(e.text)
        if e.last:
            turns = read_back(e.text)
    sha = lambda parts: hashlib.sha256("".join(parts).encode("utf-8", "surrogatepass")).hexdigest()
    return conv_id, len(turns), sha(f"{role}\n{text}\n" for role, text in turns), sum(map(len, trained)), sha(trained), size


DIGESTS = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def digests(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row a conversation, read back from its examples in the worker that writes them: turns, loss and size."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = []
        names = [x.split()[0] for x in DIGESTS.split(", ")]
        for conv_id, turns in _conversations(batches):
            out.append(digest(expand(conv_id, turns)))
            if len(out) >= 4096:
                yield pd.DataFrame(out, columns=names).astype({"conv_id": "Int64"})
                out = []
        yield pd.DataFrame(out, columns=names).astype({"conv_id": "Int64"})

    return _dealt(rows, conv_col, turn_col, role_col, text_col).mapInPandas(read, DIGESTS)


def op9_chat(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.sql(f"SELECT cast(-1 AS bigint) AS conv_id, cast(x.turn AS bigint) AS turn, x.role, '{said}' AS text FROM VALUES (0, 'user'), (1, 'assistant') AS x(turn, role)")
    return digests(rows.unionByName(more))


ORACLE_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, row_number() OVER o AS n, count(*) OVER (PARTITION BY conv_id) AS of,
         length('<s>[ROLE][/ROLE]</s>')
         + length(regexp_replace(replace(role, '\', '\\'), '(</?s>|\[/?(?:ROLE|INST)\])', '\\\1', 'g'))
         + length(regexp_replace(replace(text, '\', '\\'), '(</?s>|\[/?(?:ROLE|INST)\])', '\\\1', 'g')) AS w
  FROM t WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
p AS (SELECT *, sum(w) OVER (PARTITION BY conv_id ORDER BY n) AS upto FROM e)
SELECT conv_id::BIGINT AS conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(upto) FILTER (role = 'assistant' OR n = of)::BIGINT AS formatted_chars
FROM p GROUP BY conv_id
"""
