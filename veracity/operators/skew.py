"""Hot keys in row-returning joins.

Counting never needs this: every count in the engine is a partial-first
aggregate, so a key holding a third of all rows collapses map-side.  The
drill-down joins return *rows*, though, and a shuffled join sends every row
of one key to one task.  ``split_hot`` separates such keys first:

* keys with more than ``hot_rows`` rows are *hot*; there are at most
  ``total_rows / hot_rows`` of them, and they are broadcast only as far as
  ``max_hot_keys`` keys and ``MAX_HOT_BYTES`` bytes go (a small job over the
  written group sizes says how many that is) — the largest keys first;
* rows of hot keys are decided by a broadcast join against that small set
  (no shuffle); the remaining rows take the ordinary shuffled join, in which
  no key is larger than ``hot_rows``;
* NULL keys never match an equi-join, so their rows are routed around the
  join instead of being hashed into one partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veracity.operators.uniqueness import KEY, SIZE

HOT_ROWS = 4_000_000
MAX_HOT_KEYS = 100_000
MAX_HOT_BYTES = 32 << 20


def hot_keys(sizes: DataFrame, hot_rows: int = HOT_ROWS, max_hot_keys: int = MAX_HOT_KEYS,
             max_bytes: int = MAX_HOT_BYTES) -> DataFrame | None:
    """Non-NULL keys of ``(__key, __size)`` with more than ``hot_rows`` rows, or None.

    Where that is more than ``max_hot_keys`` keys, or they could be more than
    ``max_bytes`` bytes, the largest ones that fit.  ``sizes`` is read twice: pass
    a written (materialized) table.
    """
    above = sizes.where(F.col(KEY).isNotNull() & (F.col(SIZE) > max(int(hot_rows), 1)))
    width = F.octet_length(F.to_json(F.struct(KEY)))
    n, widest = above.agg(F.count(F.lit(1)), F.max(width)).first()
    if not n:
        return None
    fit = max(1, min(max_hot_keys, max_bytes // max(widest, 1)))
    if n > fit:
        above = above.orderBy(F.desc(SIZE), F.xxhash64(KEY)).limit(fit)
    return above.select(KEY)


def split_rows(df: DataFrame, key: Column, hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of hot keys, all other rows) — both by broadcast join against the checked hot set."""
    small = F.broadcast(hot)
    return (
        df.join(small, key == small[KEY], "left_semi"),
        df.join(small, key == small[KEY], "left_anti"),
    )
