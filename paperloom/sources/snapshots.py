"""Versioned Parquet snapshots of entities: resolve, read, commit, probe, delete.

Data lie in folders ``root/layer/entity/vYYYY-MM-DD.<token>/``, each written once under a token of its own and never renamed. A snapshot is committed by an empty file, written
last, whose name says all: ``root/layer/entity/_commits/vYYYY-MM-DD~<number>~<token>``. Making an empty file is atomic on object stores and on file systems, so a
reader sees the snapshot before or the one after, whole; a writer that dies leaves a folder that no commit names. A rewrite of a version is a
commit with the next number; what it replaces stays for readers that have begun until ``clean``. Folders ``vYYYY-MM-DD/`` with a ``_SUCCESS`` file, as
other writers leave them, are read too where a version has no commit.

Paths go through Hadoop's file system, so any store that Spark reads will do.
"""

from __future__ import annotations

import re
import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

VERSION = re.compile(r"/v([0-9-]+)(?:/|$)")
_COMMIT = re.compile(r"/v([0-9-]+)~(\d+)~(\w+)$")


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def listed(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that a glob pattern matches, in order."""
    fs, p = _fs(spark, pattern)
    return sorted(s.getPath().toString().replace("\\", "/") for s in (fs.globStatus(p) or []))


def snapshot_path(root: str, layer: str, entity: str, version: str, token: str | None = None) -> str:
    return f"{root}/{layer}/{entity}/v{version}" + (f".{token}" if token else "")


def committed(spark: SparkSession, root: str, layer: str, entity: str) -> dict[str, str]:
    """The folder of each version: its last commit's, or one that another writer left whole."""
    found = {m[1]: snapshot_path(root, layer, entity, m[1]) for p in listed(spark, f"{root}/{layer}/{entity}/v*") if (m := VERSION.search(p)) and complete(spark, p)}
    newest: dict[str, tuple[int, str]] = {}
    for p in listed(spark, f"{root}/{layer}/{entity}/_commits/v*"):
        if m := _COMMIT.search(p):
            newest[m[1]] = max(newest.get(m[1], (0, "")), (int(m[2]), m[3]))
    return found | {v: snapshot_path(root, layer, entity, v, token) for v, (_, token) in newest.items()}


def latest_version(spark: SparkSession, root: str, layer: str, entity: str) -> str | None:
    """The greatest snapshot date, compared as text; None if there is none."""
    return max(committed(spark, root, layer, entity), default=None)


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def complete(spark: SparkSession, path: str) -> bool:
    """Whether a snapshot was written to its end."""
    return exists(spark, f"{path}/_SUCCESS")


def delete(spark: SparkSession, path: str) -> bool:
    """Remove a path; False if it wasn't there."""
    fs, p = _fs(spark, path)
    return fs.exists(p) and fs.delete(p, True)


def empty(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    """A typed relation without rows, for optional sources that are absent."""
    return spark.createDataFrame([], schema)


def latest(spark: SparkSession, root: str, layer: str, entity: str, schema: T.StructType | None = None) -> DataFrame:
    """The latest snapshot; with ``schema``, an empty relation where there is none."""
    folders = committed(spark, root, layer, entity)
    if not folders:
        if schema is None:
            raise FileNotFoundError(f"no snapshot of {layer}/{entity} under {root}")
        return empty(spark, schema)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(folders[max(folders)])


def every_version(spark: SparkSession, root: str, layer: str, entity: str) -> DataFrame:
    """All snapshots together, with their version as a column."""
    from pyspark.sql import functions as F

    folders = committed(spark, root, layer, entity)
    if not folders:
        raise FileNotFoundError(f"no snapshot of {layer}/{entity} under {root}")
    df = spark.read.option("basePath", f"{root}/{layer}/{entity}").parquet(*folders.values())
    return df.withColumn("version", F.regexp_extract(F.input_file_name(), "/v([0-9-]+)[./]", 1))


def write(df: DataFrame, root: str, layer: str, entity: str, version: str | None = None, again: bool = False) -> str:
    """Write and commit a snapshot; one of the same version stays unless ``again``. The folder that readers get from now on."""
    spark = df.sparkSession
    version = version or date.today().isoformat()
    if (stands := committed(spark, root, layer, entity).get(version)) and not again:
        return stands
    token = uuid.uuid4().hex
    folder = snapshot_path(root, layer, entity, version, token)
    df.write.parquet(folder)
    commit(spark, root, layer, entity, version, token)
    return folder


def commit(spark: SparkSession, root: str, layer: str, entity: str, version: str, token: str) -> None:
    """Make a folder that is written to its end the one that readers get. Of two writers at once the later commit, or the greater token, stands."""
    if not complete(spark, snapshot_path(root, layer, entity, version, token)):
        raise FileNotFoundError(f"{snapshot_path(root, layer, entity, version, token)} was not written to its end")
    numbers = [int(m[2]) for p in listed(spark, f"{root}/{layer}/{entity}/_commits/v{version}~*") if (m := _COMMIT.search(p))]
    fs, path = _fs(spark, f"{root}/{layer}/{entity}/_commits/v{version}~{max(numbers, default=0) + 1:06d}~{token}")
    fs.create(path, False).close()


def forget(spark: SparkSession, root: str, layer: str, entity: str, version: str) -> bool:
    """Take a version away: its commits first, so that no reader begins with it. False if there was none."""
    folder = committed(spark, root, layer, entity).get(version)
    # oldest first: while one is left, it is the newest that readers see
    for p in sorted(listed(spark, f"{root}/{layer}/{entity}/_commits/v{version}~*")):
        delete(spark, p)
    return delete(spark, folder) if folder else False


def clean(spark: SparkSession, root: str, layer: str, entity: str) -> list[str]:
    """Delete folders that no last commit names: replaced ones and what dead writers left. For when no writer is at work and readers have ended."""
    kept = {p.rsplit("/", 1)[1] for p in committed(spark, root, layer, entity).values()}
    gone = [p for p in listed(spark, f"{root}/{layer}/{entity}/v*") if p.rsplit("/", 1)[1] not in kept]
    for p in listed(spark, f"{root}/{layer}/{entity}/_commits/v*"):
        m = _COMMIT.search(p)
        if m and f"v{m[1]}.{m[3]}" not in kept:
            delete(spark, p)
    for p in gone:
        delete(spark, p)
    return gone


def register(spark: SparkSession, root: str, layer: str, optional: dict[str, T.StructType | None], required: list[str]) -> list[str]:
    """Temporary views of the latest snapshots; optional entities are skipped (None) or empty (a schema) where absent."""
    made = []
    for entity in [*required, *optional]:
        if entity in optional and latest_version(spark, root, layer, entity) is None and optional[entity] is None:
            continue
        latest(spark, root, layer, entity, optional.get(entity)).createOrReplaceTempView(entity)
        made.append(entity)
    return made


def table_stats(spark: SparkSession, names: list[str]) -> DataFrame:
    """Columns and row counts of catalog tables and views."""
    rows = [(n, spark.table(n).count(), c.name, c.dataType) for n in names for c in spark.catalog.listColumns(n)]
    return spark.createDataFrame(rows, "table string, n_rows long, column string, type string")


def store_answers(spark: SparkSession, root: str, rows: int = 3) -> bool:
    """Whether a few rows written under ``root`` are read back and can be deleted: a check of a store and its credentials."""
    path = f"{root}/.round-trip"
    spark.range(rows).write.mode("overwrite").parquet(path)
    same = spark.read.parquet(path).count() == rows
    return delete(spark, path) and same
