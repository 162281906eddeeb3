"""Tables written in the middle of a plan.

A staged table cuts the lineage: what follows re-reads files on the shared
folder instead of repeating the joins before it, also after an executor is lost.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager, contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


@lru_cache(maxsize=1)
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="starmill-")


def stage_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a session on one machine may go without one, and gets a temporary folder, or name
    one of its own file system. Elsewhere the warehouse is taken for want of one, and a folder
    of the local file system must be a mount that all machines share:
    it is refused if rows that tasks write there are not all read back, as each executor then
    writes to its own disk. On YARN, which brings a file system that all share, it is refused
    unread. ``SHARED_MOUNT`` vouches for a mount in both cases.
    """
    master = spark.conf.get("spark.master", "")
    one_machine = re.fullmatch(r"local(-cluster)?(\[.*\])?", master)
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not one_machine:
        folder = spark.conf.get("spark.sql.warehouse.dir", None)
    if folder:
        mounted = spark.conf.get(SHARED_MOUNT, "false").lower() == "true"
        if not one_machine and not mounted and _scheme(spark, folder) == "file" and (
            master.startswith("yarn") or not _is_shared(spark, folder.rstrip("/"), spark.conf.get("spark.app.id", "app"))
        ):
            raise RuntimeError(f"{folder} is on the disk of each machine; set spark.checkpoint.dir to a folder "
                               f"that all executors share, or {SHARED_MOUNT} to true if they do")
        return folder.rstrip("/")
    if not one_machine:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_folder()


@lru_cache(maxsize=None)
def _is_shared(spark: SparkSession, folder: str, application: str) -> bool:
    """Whether the rows that tasks write to a folder are all read back; once a session and folder."""
    tasks = max(8, spark.sparkContext.defaultParallelism)
    return _read_back(spark.range(0, tasks, 1, tasks), f"{folder}/starmill/{application}/shared-{uuid.uuid4().hex}") == tasks


def _read_back(rows: DataFrame, path: str) -> int:
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path).count()


# Set to true if a folder of the local file system is a mount that all machines share.
SHARED_MOUNT = "spark.starmill.sharedMount"


def _scheme(spark: SparkSession, folder: str) -> str:
    found = re.match(r"([a-zA-Z][a-zA-Z0-9+.-]*):", folder)
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"
    return found[1] if found else default.partition(":")[0]


_SCOPE = "starmill.stage"


@contextmanager
def stage_scope(spark: SparkSession, name: str) -> Iterator[str]:
    """Put what is staged within into one folder, which can be deleted with the result."""
    before = spark.sparkContext.getLocalProperty(_SCOPE)
    scope = f"{name}-{uuid.uuid4().hex}"
    spark.sparkContext.setLocalProperty(_SCOPE, scope)
    try:
        yield f"{_app_folder(spark)}/{scope}"
    finally:
        spark.sparkContext.setLocalProperty(_SCOPE, before)


def _app_folder(spark: SparkSession) -> str:
    return f"{stage_folder(spark)}/starmill/{spark.conf.get('spark.app.id', 'app')}"


def new_stage_path(spark: SparkSession, name: str) -> str:
    scope = spark.sparkContext.getLocalProperty(_SCOPE)
    inside = f"{scope}/" if scope else ""
    return f"{_app_folder(spark)}/{inside}{name}-{uuid.uuid4().hex}"


def observed(df: DataFrame) -> tuple[DataFrame, Callable[[], int]]:
    """The rows, and their number once they have been written: no second scan."""
    written = Observation()
    return (
        df.observe(written, F.count(F.lit(1)).alias("rows")),
        lambda: written.get["rows"],
    )


# Shuffle files go when the action that made them ends, not when the driver next collects garbage.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def session_option(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """Within, an option of the session has this value."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def _shuffles_go(spark: SparkSession) -> AbstractContextManager[None]:
    """Within, a write leaves no shuffle files: the table it wrote is read instead of them."""
    return session_option(spark, SHUFFLES_GO, "true")


def _write(df: DataFrame, path: str) -> None:
    with _shuffles_go(df.sparkSession):
        df.write.mode("overwrite").parquet(path)


def write_counted(df: DataFrame, path: str) -> int:
    rows, counted = observed(df)
    _write(rows, path)
    return counted()


def stage(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """Write a table to the shared folder and read it back, with its row count."""
    spark = df.sparkSession
    path = new_stage_path(spark, name)
    rows = write_counted(df, path)
    return spark.read.schema(df.schema).parquet(path), rows


def write_once(df: DataFrame, name: str) -> DataFrame:
    """``stage`` without counting."""
    spark = df.sparkSession
    path = new_stage_path(spark, name)
    _write(df, path)
    return spark.read.schema(df.schema).parquet(path)
