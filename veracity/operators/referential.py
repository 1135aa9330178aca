"""Referential integrity: keys absent from a reference table.

Counting lives in ``keyed.py``.  This module returns the orphan *rows*.  Where
the reference's integer keys fit an exact bitmap (``bitmap.py``), each row is
decided where it is read and nothing is shuffled; otherwise it is a left anti
join, with NULL keys and hot keys kept out of the shuffle.

A NULL key never equals anything, so by default it counts as missing (the
reference's left-anti semantics); ``nulls_violate=False`` ignores NULL keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veracity.functions.columns import fresh_names
from veracity.operators.bitmap import is_integer, key_bitmap, with_presence
from veracity.operators.skew import HOT_ROWS, hot_keys, split_rows
from veracity.operators.uniqueness import KEY, group_sizes
from veracity.session import materialize

REF = "__ref_key"


def reference_keys(ref: DataFrame, ref_key: Column) -> DataFrame:
    """Distinct non-NULL reference keys: a key that holds much of the reference is combined before the shuffle."""
    return ref.select(ref_key.alias(REF)).where(F.col(REF).isNotNull()).distinct()


def orphan_rows(
    df: DataFrame,
    key: Column,
    ref: DataFrame,
    ref_key: Column,
    nulls_violate: bool = True,
    *,
    hot_rows: int | None = HOT_ROWS,
    dtype: T.DataType | None = None,
) -> DataFrame:
    """The rows of ``df`` whose key has no partner; ``dtype`` is the key's type, if known.

    Reads the reference's keys when called.  In the join, NULL keys never find a partner: their rows are taken by a filter and
    never enter the join's shuffle (where they would all hash to one task).
    Keys with more than ``hot_rows`` rows are split off (``skew.split_rows``)
    and decided against the reference by a small join of the keys alone;
    ``hot_rows=None`` skips that check and leaves skew to AQE.
    """
    bitmap = key_bitmap(ref, ref_key) if is_integer(dtype) else None
    if bitmap is not None:
        key_name, held = fresh_names(df, "__key", "__present")
        marked = with_presence(df.withColumn(key_name, key), key_name, bitmap, held)
        return marked.where(~F.coalesce(F.col(held), F.lit(not nulls_violate))).drop(key_name, held)
    keys = reference_keys(ref, ref_key)
    present = df.where(key.isNotNull())
    hot = hot_keys(materialize(group_sizes(present, key), "key-sizes"), hot_rows) if hot_rows else None
    if hot is None:
        orphans = present.join(keys, key == keys[REF], "left_anti")
    else:
        hot_orphans = hot.join(keys, hot[KEY] == keys[REF], "left_anti")
        hot_part, rest = split_rows(present, key, hot)
        small = F.broadcast(hot_orphans)  # a subset of the checked hot set
        orphans = hot_part.join(small, key == small[KEY], "left_semi").unionByName(
            rest.join(keys, key == keys[REF], "left_anti")
        )
    if nulls_violate:
        orphans = orphans.unionByName(df.where(key.isNull()))
    return orphans
