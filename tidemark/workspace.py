"""Folders for staged tables, stream targets and checkpoints."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="tidemark-")


def shared_root(spark: SparkSession) -> str:
    """The shared folder the cluster names, in its settings or through the context.

    A local one serves only where driver and executors are one process (tests); elsewhere each
    executor would write to its own disk, so a missing folder is an error.
    """
    named = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder that all executors of {master} share")
    return _local_root()


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses. Nothing is created yet."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


_passing: ContextVar[list[str] | None] = ContextVar("_passing", default=None)


def note_folder(path: str) -> None:
    """Tell the enclosing :func:`passing`, if any, that an intermediate table is written here."""
    if (made := _passing.get()) is not None:
        made.append(path)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables written inside (by this thread) go at the end, and so do shuffle files of ended jobs.

    For builds whose result is itself written inside: nothing lazy may leave the block.
    """
    made: list[str] = []
    token = _passing.set(made)
    try:
        yield
    finally:
        _passing.reset(token)
        for path in made:
            remove_folder(spark, path)
        if made:
            release_shuffles(spark)


def remove_folder(spark: SparkSession, path: str) -> None:
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jvm_path, True)


def release_shuffles(spark: SparkSession) -> None:
    """Let executors delete the shuffle files of ended jobs now: Spark does so when the driver collects its garbage,
    which on a driver with little work may be long after the disks are full."""
    spark.sparkContext._jvm.System.gc()


def path_exists(spark: SparkSession, path: str) -> bool:
    """Look a path up through the file system Spark itself would use for it."""
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    file_system = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(file_system.exists(jvm_path))
