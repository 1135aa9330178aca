"""Group sizes: rows per distinct value of a column.

The building block for duplicate drill-down and the hot-key check.  It is a
partial-first hash aggregate, so a hot value (even a third of all rows)
collapses to one row per map task before the shuffle; the NULL group is kept
as its own row.  Counting for the uniqueness *check* happens in
``keyed.py``, shared with referential checks on the same column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY, SIZE = "__key", "__size"


def group_sizes(df: DataFrame, key: Column) -> DataFrame:
    """``(__key, __size)``: one row per distinct value, NULL included."""
    return df.groupBy(key.alias(KEY)).agg(F.count(F.lit(1)).alias(SIZE))
