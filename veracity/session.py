"""Session-level helpers: the shared folder, lineage cuts and scratch tables.

Intermediate tables go to the shared folder the cluster names in
``spark.checkpoint.dir`` — never to a machine-local temporary folder, which
other executors cannot see and which disappears with the node.  Only a
session whose master is local (unit tests, a laptop) gets a folder of its own
when it names none; any other raises ``NoSharedFolder``.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Spark's own setting: shuffle files go when the query that made them ends, not at some later collection.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class NoSharedFolder(RuntimeError):
    """The session runs on a cluster but names no folder that its executors share."""


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; a local session without one gets a temporary folder."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):  # local-cluster has executors of its own
            raise NoSharedFolder(f"set spark.checkpoint.dir to a folder all executors share (master is '{master}')")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="veracity-checkpoints-"))
        configured = spark.sparkContext.getCheckpointDir()
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique path under the shared folder."""
    return f"{shared_dir(spark)}/veracity-{label}-{uuid.uuid4().hex}"


class Scratch:
    """The scratch tables written in one block (see ``scratch_tables``)."""

    def __init__(self) -> None:
        self.tables: list[tuple[DataFrame, str]] = []

    def take(self, df: DataFrame) -> list[tuple[DataFrame, str]]:
        mine = [t for t in self.tables if t[0] is df]
        self.tables = [t for t in self.tables if t[0] is not df]
        return mine

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that nothing unwritten reads any more."""
        for df in tables:
            for _, path in self.take(df):
                delete_path(df.sparkSession, path)

    def keep(self, df: DataFrame) -> DataFrame:
        """Hand a table to the enclosing block, or to the caller where there is none."""
        mine, outer = self.take(df), self.outer
        if outer is not None:
            outer.tables += mine
        return df

    outer: "Scratch | None" = None


_SCRATCH: ContextVar[Scratch | None] = ContextVar("scratch tables", default=None)


@contextmanager
def scratch_tables():
    """A block whose ``materialize`` tables are deleted at its end, also on failure, but for those kept.

    What the block returns must be a table given to ``keep``: a lazy frame
    over any other table would find its files gone.
    """
    block = Scratch()
    block.outer = _SCRATCH.get()
    token = _SCRATCH.set(block)
    try:
        yield block
    finally:
        _SCRATCH.reset(token)
        block.drop(*[df for df, _ in block.tables])


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder on whichever file system holds it."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder on whichever file system holds it; none where there is no such folder."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(context._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in system.listStatus(folder)) if system.exists(folder) else []


def materialize(df: DataFrame, label: str = "table", path: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    This cuts lineage (a lost executor re-reads files instead of recomputing
    a shuffle) and keeps the table columnar, so every later branch reads
    only the columns it needs — unlike an in-memory cache, which holds whole
    rows and is bounded by executor memory.  The shuffle files of the write go
    when it ends.  Inside ``scratch_tables`` the table belongs to that block.
    """
    spark = df.sparkSession
    target = path or scratch_path(spark, label)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.mode("overwrite").parquet(target)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    table = spark.read.parquet(target)
    block = _SCRATCH.get()
    if block is not None and path is None:
        block.tables.append((table, target))
    return table
