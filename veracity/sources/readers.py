"""Parquet sources with ordered fallbacks.

Paths are any Hadoop URI (local, HDFS, object store).  Existence is decided
by Spark's own file listing, not by ``os.path``, so the same code works on a
cluster.  Schemas come from the Parquet footers.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

# Fixed value: the file name the reference layout falls back to when the
# configured data path is missing.
DEFAULT_SINGLE_FILE = "synthetic_data.parquet"


def _is_missing(exc: AnalysisException) -> bool:
    text = str(exc)
    return "PATH_NOT_FOUND" in text or "Path does not exist" in text


def read_parquet(spark: SparkSession, path: str | Sequence[str], *fallbacks: str) -> DataFrame:
    """Read the first candidate that exists: ``path`` (or each of a list), then ``fallbacks``.

    Raises ``FileNotFoundError`` naming every candidate when none exists.
    """
    candidates = [path] if isinstance(path, str) else list(path)
    candidates += list(fallbacks)
    for candidate in candidates:
        try:
            return spark.read.parquet(candidate)
        except AnalysisException as exc:
            if not _is_missing(exc):
                raise
    raise FileNotFoundError(f"no Parquet data at any of: {', '.join(candidates)}")


def read_with_single_file_fallback(
    spark: SparkSession, path: str, single_file: str = DEFAULT_SINGLE_FILE
) -> DataFrame:
    """The configured path, else ``single_file`` in the same folder (source S1)."""
    sibling = f"{os.path.dirname(path.rstrip('/'))}/{single_file}"
    return read_parquet(spark, path, sibling)


def read_dir_or_file(spark: SparkSession, directory: str, single_file: str = DEFAULT_SINGLE_FILE) -> DataFrame:
    """The directory, else ``single_file`` inside it (source S2)."""
    return read_parquet(spark, directory, f"{directory.rstrip('/')}/{single_file}")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``<sf_dir>/<name>.parquet``, listed afresh on every call, so files added meanwhile are read."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
