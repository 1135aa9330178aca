"""Keyed checks: compact keys agree with grouping by value, bitmaps are exact, columns do not mix."""

import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from veracity import Suite
from veracity.operators import bitmap as B
from veracity.operators import keyed
from veracity.operators.checks import CheckError

MIN, MAX = -(2**63), 2**63 - 1


def unique(column):
    return {"check_name": f"u_{column}", "check_type": "uniqueness", "params": {"column": column}}


def refers(column, reference, name="r", **params):
    return {"check_name": f"{name}_{column}", "check_type": "consistency", "sub_type": "referential_integrity",
            "params": {"column": column, "reference": reference, "reference_column": "k", **params}}


def facts(df, checks):
    return {r.check_name: (r.violations, r.total_rows, r.details) for r in Suite(checks).results(df).collect()}


LONG = "x" * 40
VALUES = {
    "tinyint": [1, 1, 2, None], "bigint": [MIN, MIN, MAX, 0, None, None], "date": [dt.date(1969, 1, 1), dt.date(1969, 1, 1), dt.date(2020, 1, 1)],
    "timestamp": [dt.datetime(2020, 1, 1, 0, 0, 0, 1), dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 1)], "timestamp_ntz": [dt.datetime(2020, 1, 1)] * 2 + [None],
    "double": [0.0, -0.0, float("nan"), float("nan"), 1e300, None], "float": [0.1, 0.1, 0.2], "boolean": [True, True, False, None],
    "decimal(10,2)": [decimal.Decimal("1.10"), decimal.Decimal("1.1"), decimal.Decimal("2")],
    "string": ["", "", "a", "=a", "#40:a", LONG, LONG, LONG + "y", "é" * 17, "é" * 17, None, "1", "NULL"],
    "binary": [b"", b"", b"\x00", LONG.encode(), LONG.encode(), None], "array<int>": [[1], [1], [2], None], "struct<a:int>": [(1,), (1,), (2,)],
}


@pytest.mark.parametrize("dtype", VALUES)
def test_keys_agree_with_grouping_by_value(spark, dtype):
    df = spark.createDataFrame([(v,) for v in VALUES[dtype]], f"k {dtype}")
    groups = df.where("k IS NOT NULL").groupBy("k").count().where("count > 1").agg(F.sum("count"), F.count(F.lit(1))).first()
    ref = df.groupBy("k").count().where("count = 1").select("k")
    missing = df.where("k IS NULL").count() + df.where("k IS NOT NULL").join(ref, "k", "left_anti").count()
    got = facts(df, [unique("k"), refers("k", ref)])
    assert got["u_k"] == (groups[0] or 0, df.count(), f'{{"violations":{groups[0] or 0},"total_rows":{df.count()},"duplicate_values":{groups[1]}}}')
    assert got["r_k"][0] == missing


def test_columns_do_not_mix(spark):
    df = spark.createDataFrame([(1, 1, "1"), (2, 1, "2"), (3, 5, "1"), (None, 5, None)], "a long, b int, c string")
    got = facts(df, [unique("a"), unique("b"), unique("c"), refers("a", df.selectExpr("b AS k")), refers("c", df.selectExpr("a AS k"))])
    assert {k: v[:2] for k, v in got.items()} == {"u_a": (0, 4), "u_b": (4, 4), "u_c": (2, 4), "r_a": (3, 4), "r_c": (1, 4)}


@pytest.mark.parametrize("small,most", [(1 << 14, 1 << 19), (2, 1 << 19), (2, 3)])
def test_bitmaps_are_exact(spark, monkeypatch, small, most):
    """Part of the plan, written to the shared folder, or too large for a bitmap: the counts are the same."""
    keys = [0, 1, 63, 64, -1, -64, -65, MIN, MAX, 10**12, None, 5, 5]
    tried = [*keys, 2, -2, 62, 65, MIN + 1, MAX - 1, None, 10**12 + 64, 2, 2]
    ref = spark.createDataFrame([(k,) for k in keys], "k long")
    other = spark.createDataFrame([(2,), (0,)], "k int")
    df = spark.createDataFrame([(k,) for k in tried], "a long")
    build = B.key_bitmap
    seen = []
    monkeypatch.setattr(keyed, "key_bitmap", lambda r, k: seen.append(build(r, k, small, most)) or seen[-1])
    got = facts(df, [refers("a", ref, "one"), refers("a", other, "two", nulls_are_violations=False)])
    present = {k for k in keys if k is not None}
    absent = [k for k in tried if k not in present and k is not None]
    assert got["one_a"][0] == len(absent) + 2 and f'"missing_keys":{len(set(absent))}' in got["one_a"][2]
    assert got["two_a"][0] == sum(k not in (2, 0, None) for k in tried) and got["two_a"][1] == len(tried)
    assert (seen[0] is None) == (most == 3)


def test_empty_sides(spark):
    some, none = spark.createDataFrame([(1,), (None,)], "k long"), spark.createDataFrame([], "k long")
    assert facts(none, [unique("k"), refers("k", some)])["r_k"][:2] == (0, 0)
    assert facts(none, [refers("k", some)])["r_k"][:2] == (0, 0)
    assert facts(some, [refers("k", none)])["r_k"][:2] == (2, 2)


def test_one_bad_column_leaves_the_others(spark):
    df = spark.createDataFrame([(1, {"a": 1}), (1, None)], "a long, m map<string,int>")
    got = {r.check_name: (r.status, r.violations) for r in Suite([unique("m"), unique("a")]).results(df).collect()}
    assert got["u_a"] == ("FAIL", 2) and got["u_m"][0] in ("ERROR", "PASS")


def test_checks_without_a_type_are_counted_by_value(spark):
    from veracity.operators.checks import GroupCheck, register

    @register("test_keyed_untyped")
    def _compile(df, spec, ctx):
        if not spec.param("column"):
            raise CheckError("no column")
        return GroupCheck(F.col(spec.param("column")), spec.param("column"))

    df = spark.createDataFrame([(1,), (1,), (2,)], "k long")
    checks = [{"check_name": "x", "check_type": "test_keyed_untyped", "params": {"column": "k"}}, unique("k")]
    assert {v[0] for v in facts(df, checks).values()} == {2}


def test_orphan_rows_agree_with_the_join(spark, monkeypatch):
    from veracity import failing_rows
    from veracity.operators import referential

    df = spark.createDataFrame([(k, i, "x") for i, k in enumerate([1, 2, 2, None, -1, MIN, MAX, 70, 70])], "a long, __present int, __KEY_word string")
    ref = spark.createDataFrame([(1,), (MAX,), (None,), (71,)], "k long")
    for nulls in (True, False):
        check = refers("a", ref, nulls_are_violations=nulls)
        got = sorted(map(str, failing_rows(df, check).collect()))
        with monkeypatch.context() as m:
            m.setattr(referential, "key_bitmap", lambda *a: None)
            assert got == sorted(map(str, failing_rows(df, check).collect()))
        assert len(got) == 6 + nulls
