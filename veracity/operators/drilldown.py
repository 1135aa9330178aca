"""Drill-down: the rows behind a check's count.

``failing_rows(df, spec)`` returns the violating rows of any row-level check
(the same predicate the fused count used), the rows in duplicate groups for
a uniqueness check, and the orphan rows for a referential check.  The rows
are lazy DataFrames and nothing is printed; for keyed checks the call itself
reads keys (group sizes are written once, a reference's keys become a bitmap).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veracity.operators.checks import (
    ReferenceCheck,
    CheckError,
    CompileContext,
    GroupCheck,
    RowCheck,
    compile_check,
)
from veracity.operators.referential import orphan_rows
from veracity.operators.skew import HOT_ROWS, hot_keys, split_rows
from veracity.operators.uniqueness import KEY, SIZE, group_sizes
from veracity.session import materialize
from veracity.spec import CheckSpec


def rows_in_duplicate_groups(df: DataFrame, key: Column, *, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Rows whose non-NULL ``key`` value occurs more than once.

    Group sizes come from a partial-first aggregate (written once to the
    shared folder when the hot-key check also needs them); rows are then kept
    by a left-semi join against the duplicated values.  Values with more than
    ``hot_rows`` rows are duplicates by definition: their rows are split off
    by a broadcast against that checked, bounded set, so the shuffled semi
    join never sees a hot key (``hot_rows=None`` leaves skew to AQE).
    """
    sizes = group_sizes(df, key)
    if hot_rows:
        # Read twice (hot-key check, duplicate set): write it once to the
        # shared folder instead of aggregating the table twice.
        sizes = materialize(sizes, "key-sizes")
    dups = sizes.where(F.col(KEY).isNotNull() & (F.col(SIZE) > 1))
    hot = hot_keys(sizes, hot_rows) if hot_rows else None
    if hot is None:
        keys = dups.select(KEY)
        return df.join(keys, key == keys[KEY], "left_semi")
    hot_part, rest = split_rows(df, key, hot)
    # The hot threshold may have been raised to keep the set small: cold is whatever is not in it.
    cold = dups.select(KEY).join(F.broadcast(hot), KEY, "left_anti")
    return hot_part.unionByName(rest.join(cold, key == cold[KEY], "left_semi"))


def failing_rows(
    df: DataFrame,
    check: CheckSpec | Mapping[str, Any],
    *,
    base_dir: str | None = None,
    references: Mapping[str, DataFrame] | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """The rows that violate ``check``; raises ``CheckError`` for schema-only or statistic checks.

    For uniqueness and referential checks, keys with more than ``hot_rows``
    rows are split off before the shuffled join (see ``operators.skew``).
    """
    spec = check if isinstance(check, CheckSpec) else CheckSpec.from_dict(check)
    shape = compile_check(df, spec, CompileContext(df.sparkSession, base_dir, dict(references or {})))
    if isinstance(shape, RowCheck):
        return df.where(shape.predicate)
    if isinstance(shape, GroupCheck):
        return rows_in_duplicate_groups(df, shape.key, hot_rows=hot_rows)
    if isinstance(shape, ReferenceCheck):
        return orphan_rows(
            df, shape.key, shape.reference, shape.reference_key, shape.nulls_violate, hot_rows=hot_rows, dtype=shape.dtype
        )
    raise CheckError(f"check '{spec.name}' ({spec.kind}) has no row-level violations")


def preview(df: DataFrame, n: int = 20, order_by: Sequence[str] | None = None) -> DataFrame:
    """First ``n`` rows, ordered when ``order_by`` is given (a top-k, not a full sort)."""
    if order_by:
        df = df.orderBy(*[F.col(c) for c in order_by])
    return df.limit(n)
