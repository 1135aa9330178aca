"""Exact membership bitmaps over the integer keys of a reference table.

A key ``k`` is bit ``k mod 64`` of word ``k >> 6``, so a table of
``(word, bits)`` holds exactly the keys of the reference: 16 bytes for up to
64 neighbouring keys.  Joined to the checked rows by word, it decides each row
where it is read; only rows whose key is absent go on.  Its size is known
before it is broadcast: up to ``SMALL`` words are fetched and become part of the
plan, up to ``MAX_WORDS`` are written to the shared folder once.  Beyond that, or
for keys that are no integers, there is no bitmap and the callers take their
shuffled way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veracity.session import materialize

SMALL = 1 << 14  # 256 KB of words
MAX_WORDS = 1 << 19  # 8 MB of words

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def is_integer(dtype: T.DataType | None) -> bool:
    return isinstance(dtype, _INTEGERS)


def key_bitmap(reference: DataFrame, key: Column, small: int = SMALL, max_words: int = MAX_WORDS) -> DataFrame | None:
    """``(word, bits)`` of the non-NULL integer keys, or None when it exceeds ``max_words`` rows.

    Reads the key column now: whether the table may be broadcast has to be
    known before a plan is built on it.
    """
    words = reference.select(key.cast("bigint").alias("k")).where("k IS NOT NULL").groupBy(F.expr("shiftright(k, 6) AS word")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(k & 63 AS INT))) AS bits"))
    rows = words.limit(small + 1).collect()
    if len(rows) <= small:
        return reference.sparkSession.createDataFrame(rows, "word bigint, bits bigint")
    words = materialize(words, "key-bitmap")
    return words if words.limit(max_words + 1).count() <= max_words else None


def with_presence(df: DataFrame, key: str, bitmap: DataFrame, name: str) -> DataFrame:
    """``df`` with a boolean column ``name``: is the key (SQL text) in the reference (NULL for a NULL key)."""
    word, bits = f"{name}_word", f"{name}_bits"
    k = f"CAST({key} AS BIGINT)"
    joined = df.join(F.broadcast(bitmap.toDF(word, bits)), F.expr(f"shiftright({k}, 6) = {word}"), "left")
    held = f"CASE WHEN {k} IS NOT NULL THEN coalesce({bits} & shiftleft(1L, CAST({k} & 63 AS INT)) != 0, false) END"
    return joined.withColumn(name, F.expr(held)).drop(word, bits)
