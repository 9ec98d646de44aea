"""Text sources: tab-separated bulk files, CSV seeds, JSON works."""

from __future__ import annotations

import csv
import io
import json
import os
import zipfile
from collections.abc import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.text import abstract_of
from .paged import named

WORK_SCHEMA = (
    "id string, doi string, title string, type string, publication_date string, publication_year int, language string,"
    " abstract_inverted_index map<string, array<int>>, primary_topic struct<id: string, display_name: string>,"
    " authorships array<struct<institutions: array<struct<id: string, ror: string, display_name: string>>>>"
)


def unpacked(path: str, folder: str, fetch: Callable[[str], str] | None = None) -> str:
    """Local path of a bulk file: as it is, from its zip, or fetched by ``fetch(name)`` first. For a driver's own disk."""
    if os.path.exists(path):
        return path
    packed = path + ".zip"
    if not os.path.exists(packed):
        if fetch is None:
            raise FileNotFoundError(path)
        packed = fetch(os.path.basename(packed))
    with zipfile.ZipFile(packed) as z:
        return z.extract(z.namelist()[0], folder)


def opened(uri: str):
    """A file of any store that Arrow reaches, open for reading at any place."""
    if "://" not in uri:
        return open(uri, "rb")  # noqa: SIM115
    fs, path = pafs.FileSystem.from_uri(uri)
    return fs.open_input_file(path)


def _header(line: str) -> list[str]:
    return next(csv.reader([line], delimiter="\t"), [])


class Member(InputPartition):
    def __init__(self, uri: str, name: str):
        super().__init__(name)
        self.uri, self.name = uri, name


class _ZipReader(DataSourceReader):
    def __init__(self, options: dict, columns: list[str]):
        self.options, self.columns = dict(options), columns

    def partitions(self) -> list[Member]:
        return list(_members(self.options))

    def read(self, partition: Member) -> Iterator[pa.RecordBatch]:
        open_, at_once = named(self.options["open"]), int(self.options["rows"])
        schema = pa.schema([(c, pa.string()) for c in self.columns])
        with open_(partition.uri) as raw, zipfile.ZipFile(raw) as packed, packed.open(partition.name) as member:
            lines = csv.reader(io.TextIOWrapper(member, "utf-8-sig", newline=""), delimiter="\t")
            has = next(lines, [])
            if absent := [c for c in self.columns if c not in has]:
                raise ValueError(f"{partition.uri}!{partition.name} lacks columns {absent}; it has {has}")
            places, rows = [has.index(c) for c in self.columns], []

            def batch() -> pa.RecordBatch:
                # a short row has nulls at its end, and an empty field is null, as in files that are not packed
                return pa.RecordBatch.from_arrays([pa.array([(r[p] or None) if p < len(r) else None for r in rows], pa.string()) for p in places], schema=schema)

            for row in lines:
                if row:
                    rows.append(row)
                if len(rows) >= at_once:
                    yield batch()
                    rows = []
            if rows:
                yield batch()


def _members(options: Mapping[str, str]) -> Iterator[Member]:
    open_ = named(options["open"])
    for uri in json.loads(options["uris"]):
        with open_(uri) as raw, zipfile.ZipFile(raw) as packed:
            yield from (Member(uri, n) for n in packed.namelist() if not n.endswith("/"))


class ZippedSource(DataSource):
    """Tab-separated members of zip files, a task a member, read as a stream where the task runs.

    The driver reads the zips' directories and one header. Options: ``uris`` (JSON array), ``open`` (names the function that opens one), ``rows`` a batch.
    """

    @classmethod
    def name(cls) -> str:
        return "zipped_tsv"

    def _columns(self) -> list[str]:
        first = next(iter(_members(self.options)), None)
        if first is None:
            return []
        with named(self.options["open"])(first.uri) as raw, zipfile.ZipFile(raw) as packed, packed.open(first.name) as member:
            return _header(io.TextIOWrapper(member, "utf-8-sig", newline="").readline().rstrip("\r\n"))

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self._columns()])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _ZipReader(self.options, schema.fieldNames())


def read_zipped(spark: SparkSession, uris: Sequence[str], required: Sequence[str], types: Mapping[str, str] | None = None, open_: str = "paperloom.sources.files:opened", rows: int = 10_000) -> DataFrame:
    """Tab-separated files inside zips, as ``read_tsv`` reads them unpacked; every member has to have the first one's columns, in any order."""
    spark.dataSource.register(ZippedSource)
    df = spark.read.format("zipped_tsv").options(uris=json.dumps(list(uris)), open=open_, rows=str(rows)).load()
    return _typed(df, ", ".join(uris), required, types)


def read_tsv(spark: SparkSession, path: str, required: Sequence[str], types: Mapping[str, str] | None = None) -> DataFrame:
    """Tab-separated file with a header: all columns are text but those in ``types``; a missing required one is an error."""
    df = spark.read.option("sep", "\t").option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return _typed(df, path, required, types)


def _typed(df: DataFrame, path: str, required: Sequence[str], types: Mapping[str, str] | None) -> DataFrame:
    if absent := [c for c in required if c not in df.columns]:
        raise ValueError(f"{path} lacks columns {absent}; it has {df.columns}")
    return df.select(*[F.expr(f"try_cast(`{c}` AS {types[c]})").alias(c) if types and c in types else F.col(c) for c in df.columns])


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType | None = None, infer: bool = False) -> DataFrame:
    """CSV with a header: all text, by a schema, or inferred."""
    reader = spark.read.option("header", True).option("inferSchema", infer)
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def institutions(field: str) -> Column:
    """A field of all institutions of all authorships, in order, without nulls or blanks."""
    values = F.flatten(F.transform(F.coalesce(F.col("authorships"), F.array()), lambda a: F.transform(F.coalesce(a["institutions"], F.array()), lambda i: i[field])))
    return F.filter(values, lambda v: v.isNotNull() & (v != ""))


def flat_works(raw: DataFrame) -> DataFrame:
    """One row a work from parsed JSON (WORK_SCHEMA)."""
    return raw.select(
        F.col("id").alias("openalex_id"), "doi", "title", "type", "publication_date", "publication_year", "language",
        abstract_of(F.col("abstract_inverted_index")).alias("abstract"),
        F.col("primary_topic.id").alias("primary_topic_id"), F.col("primary_topic.display_name").alias("primary_topic_name"),
        institutions("id").alias("institution_ids"), institutions("ror").alias("institution_rors"), institutions("display_name").alias("institution_display_names"),
    )


def read_works(spark: SparkSession, path: str) -> DataFrame:
    """Works as JSON lines."""
    return flat_works(spark.read.schema(WORK_SCHEMA).json(path))


def parse_works(lines: DataFrame, column: str = "value") -> DataFrame:
    return flat_works(lines.select(F.from_json(F.col(column), WORK_SCHEMA).alias("w")).select("w.*"))
