"""A key holding a third of all rows: exact results, hot rows kept off the shuffled join."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from veracity import Suite, failing_rows
from veracity.operators.dedup import keep_latest

N = 30_000


@pytest.fixture(scope="module")
def skewed(spark):
    # key 7 holds a third of the rows, NULL another sixth; the rest are spread out
    k = F.col("id")
    key = (F.when(k % 3 == 0, F.lit(7)).when(k % 6 == 1, F.lit(None)).otherwise(k % 5000 + 100)).cast("bigint")
    return spark.range(N).select(k.alias("row"), key.alias("k"), (k % 97).cast("double").alias("v"))


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def brute_dups(skewed):
    counts = {}
    for r in skewed.select("k").collect():
        counts[r["k"]] = counts.get(r["k"], 0) + 1
    return sum(n for key, n in counts.items() if key is not None and n > 1)


def test_duplicate_rows_split_hot_key(spark, skewed):
    spec = {"check_name": "u", "check_type": "uniqueness", "params": {"column": "k"}}
    split = failing_rows(skewed, spec, hot_rows=1000)
    plain = failing_rows(skewed, spec, hot_rows=None)
    expected = brute_dups(skewed)
    assert split.count() == plain.count() == expected
    assert sorted(r["row"] for r in split.collect()) == sorted(r["row"] for r in plain.collect())
    assert "BroadcastHashJoin" in plan(split)
    assert Suite([spec]).results(skewed).first()["violations"] == expected


def test_orphan_rows_split_hot_key_and_nulls(spark, skewed, monkeypatch):
    from veracity.operators import referential

    monkeypatch.setattr(referential, "key_bitmap", lambda *a: None)  # as for keys that are no integers
    ref = spark.range(100, 2600).select(F.col("id").alias("rk"))  # key 7 and half the others are orphans
    spec = {"check_name": "ri", "check_type": "consistency", "sub_type": "referential_integrity",
            "params": {"column": "k", "reference": ref, "reference_column": "rk"}}
    split = failing_rows(skewed, spec, hot_rows=1000)
    plain = failing_rows(skewed, spec, hot_rows=None)
    refs = {r["rk"] for r in ref.collect()}
    expected = sorted(r["row"] for r in skewed.collect() if r["k"] is None or r["k"] not in refs)
    assert sorted(r["row"] for r in split.collect()) == expected
    assert sorted(r["row"] for r in plain.collect()) == expected
    assert Suite([spec]).results(skewed).first()["violations"] == len(expected)
    nn = dict(spec, params=dict(spec["params"], nulls_are_violations=False))
    assert failing_rows(skewed, nn, hot_rows=1000).count() == sum(
        1 for r in skewed.collect() if r["k"] is not None and r["k"] not in refs)


def test_keep_latest_hot_key(spark, skewed):
    out = keep_latest(skewed, "k", "v", "row")
    assert out.where(F.col("k") == 7).count() == 1
    assert out.where(F.col("k").isNull()).count() == skewed.where(F.col("k").isNull()).count()
    best = skewed.where(F.col("k") == 7).orderBy(F.col("v").desc(), F.col("row").desc()).first()["row"]
    assert out.where(F.col("k") == 7).first()["row"] == best


def test_hot_set_is_capped(spark):
    from veracity.operators.skew import hot_keys
    from veracity.operators.uniqueness import KEY, SIZE

    sizes = spark.createDataFrame([(k, 10 * k) for k in range(1, 101)] + [(None, 10_000)],
                                  f"{KEY} int, {SIZE} long")
    assert sorted(r[0] for r in hot_keys(sizes, hot_rows=5, max_hot_keys=10).collect()) == list(range(91, 101))  # the largest
    assert hot_keys(sizes, hot_rows=10_000) is None  # NULL is never hot


def test_hot_set_is_capped_in_bytes_and_with_equal_sizes(spark):
    from veracity.operators.skew import hot_keys
    from veracity.operators.uniqueness import KEY, SIZE

    sizes = spark.createDataFrame([(str(k) * 100, 50) for k in range(10, 60)], f"{KEY} string, {SIZE} long")
    assert hot_keys(sizes, hot_rows=5).count() == 50
    assert hot_keys(sizes, hot_rows=5, max_hot_keys=7).count() == 7  # all of one size: some of them, not none
    assert 1 <= hot_keys(sizes, hot_rows=5, max_bytes=1000).count() <= 4
    assert hot_keys(sizes, hot_rows=5, max_bytes=1).count() == 1
