"""Queries over the results log (one row per check per run).

Every query takes an optional ``since`` date; on a log written by
``append_results_log`` (partitioned by ``run_date``) it prunes whole
partitions at the scan.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veracity.functions.render import ORDINAL, PASS


def _since(log: DataFrame, since: str | _dt.date | None) -> DataFrame:
    if since is None:
        return log
    if "run_date" in log.columns:
        return log.where(F.col("run_date") >= F.lit(since).cast("date"))
    return log.where(F.to_date("run_ts") >= F.lit(since).cast("date"))


def run_history(log: DataFrame, since: str | _dt.date | None = None) -> DataFrame:
    """Runs with their check counts, newest first."""
    return (
        _since(log, since)
        .groupBy("run_id", "run_ts")
        .agg(F.count(F.lit(1)).alias("check_count"))
        .orderBy(F.col("run_ts").desc(), F.col("run_id"))
    )


def non_passing(log: DataFrame, digits: int = 4, since: str | _dt.date | None = None) -> DataFrame:
    """FAIL / ERROR results with rounded metrics, in log order."""
    return (
        _since(log, since)
        .where(F.col("status") != F.lit(PASS))
        .select(
            "run_id",
            "run_ts",
            "check_name",
            "status",
            F.round("metric", digits).alias("metric"),
            "message",
            ORDINAL,
        )
        .orderBy("run_ts", "run_id", ORDINAL)
    )


def latest_results(log: DataFrame, k: int = 18, since: str | _dt.date | None = None) -> DataFrame:
    """The ``k`` most recent log rows (a top-k: ``TakeOrderedAndProject``, no full sort)."""
    return (
        _since(log, since)
        .orderBy(F.col("run_ts").desc(), F.col("run_id").desc(), F.col(ORDINAL).desc())
        .limit(k)
        .select("run_id", "run_ts", "check_name", "status", "metric", "message")
    )
