"""Session builder: adaptive execution, UTC, Arrow; everything else is the cluster's to say."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Warehouse:
    """Where a target's tables lie, and the settings that its store asks for."""

    root: str
    settings: Mapping[str, str] = field(default_factory=dict)
    read_only: bool = False

    def path(self, *parts: str, writing: bool = False) -> str:
        if writing and self.read_only:
            raise PermissionError(f"{self.root} is open for reading alone")
        return "/".join([self.root.rstrip("/"), *parts])


def warehouse(targets: Mapping[str, str], target: str | None = None, credentials: Callable[[str], Mapping[str, str]] | None = None, read_only: bool = False) -> Warehouse:
    """The warehouse of a target ("dev" unless PAPERLOOM_TARGET or ``target`` names another).

    ``targets`` maps names to root addresses; ``credentials`` gives an address's store settings, such as those of ``s3a_credentials``,
    and is asked only now, so secrets stay out of the code.
    """
    name = target or os.environ.get("PAPERLOOM_TARGET", "dev")
    if name not in targets:
        raise KeyError(f"no warehouse target {name!r}; there are {sorted(targets)}")
    return Warehouse(targets[name], dict(credentials(targets[name])) if credentials else {}, read_only)


def s3a_credentials(key: str, secret: str, endpoint: str | None = None, bucket: str | None = None) -> dict[str, str]:
    """Settings by which executors and driver reach an object store, for one bucket or all."""
    scope = f"spark.hadoop.fs.s3a.bucket.{bucket}." if bucket else "spark.hadoop.fs.s3a."
    out = {f"{scope}access.key": key, f"{scope}secret.key": secret}
    return out | ({f"{scope}endpoint": endpoint, f"{scope}path.style.access": "true"} if endpoint else {})


def build_session(app: str = "paperloom", store: Warehouse | None = None, **conf: str) -> SparkSession:
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    } | dict(store.settings if store else {}) | {k.replace("__", "."): v for k, v in conf.items()}
    return SparkSession.builder.appName(app).config(map=settings).getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints: the one that the cluster names, or a new one where a single machine names none (in tests)."""
    context = spark.sparkContext
    if (set_already := context.getCheckpointDir()) is not None:
        return set_already
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="paperloom-checkpoint-")
    context.setCheckpointDir(named)
    return context.getCheckpointDir()


def materialise(df: DataFrame) -> DataFrame:
    """Cut lineage by a checkpoint in the shared folder.

    A checkpoint keeps the guess of its plan's size, which joins in a loop multiply without end; the rows are wrapped anew without it.
    """
    spark = df.sparkSession
    shared_folder(spark)
    stored = df.checkpoint(eager=True)._jdf
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(stored.queryExecution().toRdd(), stored.schema(), False), spark)
