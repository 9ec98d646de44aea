"""Paged web sources. ``get(url, params, headers)`` is given by the caller and returns (status, headers, body).

``WorksSource`` and ``KeysetSource`` read them as tables: a filter, or a search, is a slice and a slice is a task, which keeps its cursor to itself and gives its
records on as they come. The driver sees slices alone. Transport and key are given by the names of functions, which tasks import.
"""

from __future__ import annotations

import importlib
import json
import time
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import batched

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql import types as T

from .snapshots import delete

Get = Callable[[str, dict, dict], tuple[int, dict, dict]]
MOST_TRIES, LONGEST_WAIT, PAGE = 3, 120.0, 200
WORKS_URL = "https://api.openalex.org/works"
INSTITUTIONS_URL = "https://api.openalex.org/institutions"
TOPICS_URL = "https://api.openalex.org/topics"


class SourceError(RuntimeError):
    pass


def polite(get: Get, url: str, params: dict, headers: dict | None = None, sleep=time.sleep) -> dict:
    """One page's body; waits as told, up to two minutes, and tries three times when asked to slow down."""
    for attempt in range(MOST_TRIES):
        status, said, body = get(url, params, headers or {})
        if status == 200:
            return body
        if status != 429:
            raise SourceError(f"{url}: status {status}")
        sleep(min(float(said.get("Retry-After", 2**attempt)), LONGEST_WAIT))
    raise SourceError(f"{url}: still asked to slow down after {MOST_TRIES} tries")


def works(get: Get, filters: str, mailto: str, sleep=time.sleep) -> Iterator[dict]:
    """All works that a filter names, by cursor."""
    cursor: str | None = "*"
    while cursor:
        page = polite(get, WORKS_URL, {"filter": filters, "per-page": PAGE, "cursor": cursor, "mailto": mailto}, sleep=sleep)
        yield from page.get("results", [])
        cursor = page.get("meta", {}).get("next_cursor") if page.get("results") else None


def institutions(get: Get, name: str, mailto: str, most: int = 25, sleep=time.sleep) -> list[tuple[str, str]]:
    """(id, display name) of institutions found by name; none on an error."""
    try:
        page = polite(get, INSTITUTIONS_URL, {"search": name, "per-page": most, "mailto": mailto}, sleep=sleep)
    except SourceError:
        return []
    return [(r["id"], r.get("display_name") or "") for r in page.get("results", [])][:most]


def keyset(get: Get, url: str, query: dict, key: str, api_key: str, size: int = 1000, sleep=time.sleep) -> Iterator[dict]:
    """Records of a search that pages by the last record's key; a short page is the last."""
    after = None
    while True:
        params = query | {"size": size} | ({"after": after} if after is not None else {})
        rows = polite(get, url, params, {"X-Api-Key": api_key}, sleep=sleep).get("records", [])
        yield from rows
        if len(rows) < size:
            return
        after = rows[-1][key]


def count_works(get: Get, filters: str, mailto: str, sleep=time.sleep) -> int:
    """How many works a filter names, from the first page's header."""
    page = polite(get, WORKS_URL, {"filter": filters, "per-page": 1, "mailto": mailto}, sleep=sleep)
    return int(page.get("meta", {}).get("count", 0))


def topics(get: Get, name: str, mailto: str, most: int = 10, sleep=time.sleep) -> list[tuple[str, str, int]]:
    """(id, display name, works) of topics found by name."""
    page = polite(get, TOPICS_URL, {"search": name, "per-page": most, "mailto": mailto}, sleep=sleep)
    return [(r["id"], r.get("display_name") or "", int(r.get("works_count") or 0)) for r in page.get("results", [])][:most]


def landed(spark: SparkSession, records: Iterable[dict], path: str, schema: T.StructType | str, at_once: int = 10_000) -> DataFrame:
    """Records as a table: written to ``path`` in portions of ``at_once`` as they arrive, so the driver holds one portion."""
    delete(spark, path)
    spark.createDataFrame([], schema).write.parquet(path)
    for portion in batched(records, at_once):
        spark.createDataFrame(list(portion), schema).coalesce(1).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def named(name: str) -> Callable:
    """The function that ``module:function`` names."""
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


class Slice(InputPartition):
    def __init__(self, number: int, asked: str):
        super().__init__(number)
        self.number, self.asked = number, asked


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = dict(options)

    def partitions(self) -> list[Slice]:
        return [Slice(i, json.dumps(x)) for i, x in enumerate(json.loads(self.options["slices"]))]

    def records(self, asked) -> Iterator[dict]:
        raise NotImplementedError

    def read(self, partition: Slice) -> Iterator[tuple]:
        if partition is None or not hasattr(partition, "asked"):
            return
        for record in self.records(json.loads(partition.asked)):
            yield partition.number, json.dumps(record)


class _WorksReader(_Reader):
    def records(self, asked) -> Iterator[dict]:
        return works(named(self.options["get"]), asked, self.options["mailto"], named(self.options.get("sleep", "time:sleep")))


class _KeysetReader(_Reader):
    def records(self, asked) -> Iterator[dict]:
        o = self.options
        return keyset(named(o["get"]), o["url"], asked, o["key"], named(o["apikey"])(), int(o.get("size", 1000)), named(o.get("sleep", "time:sleep")))


class WorksSource(DataSource):
    """Works by cursor: options ``slices`` (JSON array of filters), ``get``, ``mailto``."""

    reader_of = _WorksReader

    @classmethod
    def name(cls) -> str:
        return "paged_works"

    def schema(self) -> str:
        return "slice int, value string"

    def reader(self, schema) -> DataSourceReader:
        return self.reader_of(self.options)


class KeysetSource(WorksSource):
    """Records by last key: options ``slices`` (JSON array of queries), ``get``, ``url``, ``key``, ``apikey`` (names a function), ``size``."""

    reader_of = _KeysetReader

    @classmethod
    def name(cls) -> str:
        return "paged_keyset"


def read_pages(spark: SparkSession, source: type[DataSource], slices: Sequence, **options: str) -> DataFrame:
    """(slice, value): records as JSON, a task a slice. An error of one slice fails its task, which Spark tries again."""
    spark.dataSource.register(source)
    return spark.read.format(source.name()).options(slices=json.dumps(list(slices)), **options).load()
