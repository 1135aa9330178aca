"""A fixed-size membership filter that spares large rows a shuffle they do not need."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veracity.functions.columns import fresh_names

MAX_BITS, BITS_PER_KEY = 1 << 24, 8


def maybe_in(rows: DataFrame, keys: list[str], wanted: DataFrame, flag: str | None = None) -> DataFrame:
    """Rows whose key may be among ``wanted`` (no key is missed), or all rows with that as column ``flag``.

    The filter is a bitmap of at most ``MAX_BITS`` bits, one hash per key, kept
    as a table of 64-bit words and broadcast: at most 2**18 rows however many
    keys there are.  A full bitmap passes everything, so results never depend
    on it, only how many rows go on to the exact join.
    """
    n = wanted.count()
    bits = min(MAX_BITS, max(1 << 10, 1 << (BITS_PER_KEY * max(n, 1) - 1).bit_length()))
    place = lambda: F.pmod(F.xxhash64(*keys, F.lit(101)), F.lit(bits))
    bit = lambda at: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(at, F.lit(64)).cast("int"))
    word, held = fresh_names(rows, "bloom_word", "bloom_bits")
    words = wanted.select(place().alias("at")).groupBy(F.floor(F.col("at") / 64).cast("long").alias(word)).agg(
        F.bit_or(bit(F.col("at"))).alias(held))
    marked = rows.withColumn(word, F.floor(place() / 64).cast("long")).join(F.broadcast(words), word, "left")
    hit: Column = F.coalesce(F.col(held).bitwiseAND(bit(place())) != 0, F.lit(False))
    if flag is None:
        return marked.where(hit).drop(word, held)
    return marked.withColumn(flag, hit).drop(word, held)
