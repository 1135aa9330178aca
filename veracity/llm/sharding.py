"""Sharding by extendible hashing.

Rows are placed by the leading bits of a 64-bit hash.  Every bucket is a hash
prefix; only a bucket over the byte limit splits on another bit, so shards have
different depths and no shard is split without need.  The directory is built
``BITS`` bits at a time: one aggregate of the bytes per deepest prefix, rolled
up to the shallower ones, gives every split of that stride; only rows of
buckets still too large go on to the next.  Sizes and directory stay tables.

Rows equal in id and text share all their bits; they are counted once and, if
together over the limit, dealt to numbered parts of their bucket.  One row
larger than the limit is a shard by itself.

Defined cases: a null text has 0 bytes; null ids are hashed as null; repeated
rows get one result row each; extra columns are ignored; an empty table has no
shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veracity.llm.columns import doc_columns
from veracity.session import materialize

BITS, LIMIT, COPIES = 8, 16 << 20, 10_000


def _prefix(depth: Column | int, name: str = "h") -> Column:
    """The first ``depth`` bits of the hash as a number (0 bits: 0)."""
    depth = F.lit(depth) if isinstance(depth, int) else depth
    return F.when(depth == 0, F.lit(0).cast("long")).otherwise(
        F.call_function("shiftrightunsigned", F.col(name), (F.lit(64) - depth).cast("int")))


def _leaves(active: DataFrame, depth: int, limit: int) -> DataFrame:
    """``(deep, leaf_depth, leaf, leaf_bytes)``: the bucket of each deepest prefix of this stride, null if still too large."""
    bottom = min(depth + BITS, 64)
    cells = active.groupBy(_prefix(bottom).alias("deep")).agg(
        F.sum(F.col("bytes") * F.col("copies")).alias("size"), F.min("h").alias("lo"), F.max("h").alias("hi"))
    levels = cells.withColumn("level", F.explode(F.sequence(F.lit(depth), F.lit(bottom)))).withColumn(
        "prefix", _prefix(F.col("level"), "lo"))
    buckets = levels.groupBy("level", "prefix").agg(F.sum("size").alias("leaf_bytes"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    fits = buckets.where((F.col("leaf_bytes") <= limit) | (F.col("lo") == F.col("hi"))).select("level", "prefix", "leaf_bytes")
    found = levels.select("deep", "level", "prefix").join(fits, ["level", "prefix"]).groupBy("deep").agg(
        F.min(F.struct(F.col("level").alias("leaf_depth"), F.col("prefix").alias("leaf"), "leaf_bytes")).alias("leaf"))
    return cells.select("deep").join(found, "deep", "left").select("deep", "leaf.leaf_depth", "leaf.leaf", "leaf.leaf_bytes")


def _items(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("doc_id", "text").alias("h"),
                       F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes"))


def directory_of(items: DataFrame, limit: int) -> DataFrame:
    """Distinct items ``(doc_id, h, bytes, copies)`` with the bucket each belongs to."""
    active, done, depth = items, [], 0
    while True:
        leaves = _leaves(active, depth, limit)
        placed = materialize(active.withColumn("deep", _prefix(min(depth + BITS, 64))).join(leaves, "deep").drop("deep"),
                             "shard-stride")
        done.append(placed.where("leaf_depth is not null"))
        active, depth = placed.where("leaf_depth is null").select("doc_id", "h", "bytes", "copies"), depth + BITS
        if depth >= 64 or active.isEmpty():
            break
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    return result


def assign_shards(docs: DataFrame, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, shard, shard_depth, shard_bytes`` per row; a shard is its prefix bits, ``/part`` for dealt copies."""
    docs = doc_columns(docs, id_col, text_col)
    items = materialize(_items(docs).groupBy("doc_id", "h", "bytes").agg(F.count(F.lit(1)).alias("copies")), "shard-items")
    placed = directory_of(items, limit)
    per_part = F.greatest(F.floor(F.lit(limit) / F.greatest("bytes", F.lit(1))), F.lit(1)).cast("long")
    placed = placed.withColumn("per", F.when(F.col("leaf_bytes") > limit, per_part))
    runs = placed.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES).cast("long"))))
    most = items.agg(F.max("copies")).first()[0] or 0
    if most > COPIES:  # spread the copies of one row over tasks before writing them out
        runs = runs.repartition("h", "run")
    rows = runs.withColumn("copy", F.explode(F.sequence(
        F.col("run"), F.least(F.col("run") + COPIES, F.col("copies")) - 1)))
    part = F.floor(F.col("copy") / F.col("per"))
    bits = F.when(F.col("leaf_depth") == 0, F.lit("")).otherwise(
        F.expr("lpad(right(bin(leaf), leaf_depth), leaf_depth, '0')"))
    return rows.select(
        "doc_id", F.col("bytes").alias("n_bytes"),
        F.concat(F.lit("s"), bits, F.when(F.col("copies") > F.col("per"), F.concat(F.lit("/"), part.cast("string")))
                 .otherwise(F.lit(""))).alias("shard"),
        F.col("leaf_depth").cast("int").alias("shard_depth"),
        F.when(F.col("copies") > F.col("per"), F.least(F.col("per"), F.col("copies") - part * F.col("per")) * F.col("bytes"))
        .otherwise(F.col("leaf_bytes")).cast("long").alias("shard_bytes"))


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes all columns of ``docs`` as Parquet, one folder per bucket (copies of one row stay in theirs)."""
    items = _items(doc_columns(docs, id_col, text_col))
    items = materialize(items.groupBy("doc_id", "h", "bytes").agg(F.count(F.lit(1)).alias("copies")), "shard-items")
    bits = F.expr("concat('s', if(leaf_depth = 0, '', lpad(right(bin(leaf), leaf_depth), leaf_depth, '0')))")
    places = directory_of(items, limit).select(F.col("h").alias("shard_hash"), bits.alias("shard")).distinct()
    hashed = docs.withColumn("shard_hash", F.xxhash64(docs[id_col].cast("long"), docs[text_col].cast("string")))
    hashed.join(places, "shard_hash").drop("shard_hash").write.partitionBy("shard").parquet(path)
