"""The shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_WRITTEN: ContextVar[list[str] | None] = ContextVar("written", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where the session names none, a local session gets a temporary folder;
    on a cluster that is an error, since executors could not see it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="evenkeel-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/evenkeel-{name}-{uuid.uuid4().hex}"


def write_scratch(df: DataFrame, name: str = "table") -> str:
    """Write a table to the shared folder; returns its path."""
    path = scratch_path(df.sparkSession, name)
    written = _WRITTEN.get()
    if written is not None:
        written.append(path)
    df.write.parquet(path)
    return path


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write a table to the shared folder once and read it back.

    Cuts the lineage and survives the loss of executors. Unlike
    ``checkpoint()`` the copy is columnar, so later steps read only the
    columns they need.
    """
    return df.sparkSession.read.schema(df.schema).parquet(write_scratch(df, name))


@contextmanager
def written_tables() -> Iterator[list[str]]:
    """Lists the paths of tables that ``materialize`` writes meanwhile."""
    paths: list[str] = []
    token = _WRITTEN.set(paths)
    try:
        yield paths
    finally:
        _WRITTEN.reset(token)


def remove_tables(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete tables that ``materialize`` wrote; frames that read them are
    of no use afterwards."""
    settings = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(settings).delete(place, True)
