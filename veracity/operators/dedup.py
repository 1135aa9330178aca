"""Keep-latest deduplication.

Rows whose key or order column is NULL bypass deduplication and are kept as
they are (the reference's behaviour).  They never enter the shuffle, so a
NULL key — typically the largest "group" — cannot become a hot partition.
The rest keep the first row per key under ``order DESC, tiebreak DESC``.

``row_number() == 1`` right after the window lets Catalyst insert a
``WindowGroupLimit``: a partial limit *before* the exchange trims each map
task to one row per key, so a hot key ships one row per task, and the final
limit after the exchange finishes the job.  A tie-break is required: with
equal order values the survivor would otherwise depend on task scheduling.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veracity.functions.columns import col_ref

RN = "__veracity_row_number"


def _cols(df: DataFrame, names: str | Sequence[str]) -> list[Column]:
    if isinstance(names, str):
        names = [names]
    return [col_ref(df, n) for n in names]


def keep_latest(
    df: DataFrame,
    key: str | Sequence[str],
    order_by: str | Sequence[str],
    tiebreak: str | Sequence[str],
) -> DataFrame:
    """Latest row per ``key`` by ``order_by`` (descending), ties broken by ``tiebreak`` (descending)."""
    keys = _cols(df, key)
    orders = _cols(df, order_by)
    ties = _cols(df, tiebreak)
    if not ties:
        raise ValueError("keep_latest needs a tie-break column for a deterministic survivor")
    eligible = F.lit(True)
    for c in keys + orders:
        eligible = eligible & c.isNotNull()
    if RN in df.columns:
        raise ValueError(f"column name '{RN}' is reserved for the row number")
    window = Window.partitionBy(*keys).orderBy(*[c.desc() for c in orders + ties])
    survivors = (
        df.where(eligible).withColumn(RN, F.row_number().over(window)).where(F.col(RN) == 1).drop(RN)
    )
    bypass = df.where(~eligible)
    return survivors.unionByName(bypass, allowMissingColumns=True)


def dedup_transactions(df: DataFrame, tiebreak: str | Sequence[str] = "row_key") -> DataFrame:
    """The reference's dedup: latest ``start_date`` per ``transaction_id``."""
    return keep_latest(df, "transaction_id", "start_date", tiebreak)
