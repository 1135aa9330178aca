"""Edge semantics on small in-memory frames (FIXTURES.md §5)."""

import math

import pytest
from conftest import rows_by_name
from pyspark.sql import types as T

from veracity import Suite, failing_rows
from veracity.spec import SpecError


def c(name, t, sub=None, **p):
    d = {"check_name": name, "check_type": t, "params": p}
    if sub:
        d["sub_type"] = sub
    return d


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_empty_input_passes_everything(spark):
    df = frame(spark, [], "x double, s string")
    res = rows_by_name(Suite([
        c("nn", "completeness", column="x", threshold=0.0),
        c("u", "uniqueness", column="s"),
        c("r", "validity", "range", column="x", min_value=0),
        c("cond", "consistency", condition_sql="x > 0"),
        c("len", "format", "string_length", column="s", max_length=1),
        c("mean", "stats", "mean_deviation", column="x", expected_mean=1, max_deviation_stddevs=1),
        c("ri", "consistency", "referential_integrity", column="s", reference=frame(spark, [("a",)], "s string")),
    ]).results(df))
    for name, r in res.items():
        assert r["status"] == "PASS", name
        assert r["metric"] == 0.0, name
        assert r["total_rows"] == 0, name


def test_nan_null_inf(spark):
    df = frame(spark, [(1.0,), (float("nan"),), (None,), (-1.0,), (float("inf"),)], "x double")
    res = rows_by_name(Suite([
        c("nn", "completeness", column="x"),
        c("min0", "validity", "range", column="x", min_value=0.0),
        c("max10", "validity", "range", column="x", max_value=10.0),
        c("mean", "stats", "mean_deviation", column="x", expected_mean=0.0, max_deviation_stddevs=3.0),
    ]).results(df))
    assert res["nn"]["violations"] == 2  # NULL and NaN
    assert res["nn"]["total_rows"] == 5  # denominator is all rows
    assert res["min0"]["violations"] == 1  # NaN never violates a minimum
    assert res["max10"]["violations"] == 2  # NaN and +Inf exceed a maximum
    assert res["mean"]["status"] == "ERROR" and res["mean"]["metric"] is None  # Inf in data


def test_constant_column(spark):
    df = frame(spark, [(5.0,)] * 4, "x double")
    res = rows_by_name(Suite([
        c("off", "stats", "mean_deviation", column="x", expected_mean=6.0, max_deviation_stddevs=3.0),
        c("on", "stats", "mean_deviation", column="x", expected_mean=5.0, max_deviation_stddevs=3.0),
    ]).results(df))
    assert res["off"]["status"] == "FAIL" and res["off"]["metric"] is None
    assert res["on"]["status"] == "PASS" and res["on"]["metric"] == 0.0


def test_all_null_column(spark):
    df = frame(spark, [(None,), (None,)], "x double")
    res = rows_by_name(Suite([
        c("u", "uniqueness", column="x"),
        c("mean", "stats", "mean_deviation", column="x", expected_mean=0, max_deviation_stddevs=1),
    ]).results(df))
    assert res["u"]["status"] == "PASS" and res["u"]["violations"] == 0 and res["u"]["total_rows"] == 2
    assert res["mean"]["status"] == "ERROR"


def test_strings_under_ansi(spark):
    df = frame(spark, [("abc",), ("1.5",), (None,), ("NaN",), ("-2",)], "s string")
    res = rows_by_name(Suite([
        c("nn", "completeness", column="s"),
        c("min0", "validity", "range", column="s", min_value=0),
    ]).results(df))
    assert res["nn"]["violations"] == 1  # only the NULL; "NaN" text is a value
    assert res["min0"]["violations"] == 1  # "-2"; "abc" is not a number and never violates


def test_allowed_lists(spark):
    df = frame(spark, [(1,), (2,), (None,)], "x int")
    res = rows_by_name(Suite([
        c("empty", "validity", "categorical", column="x", allowed_values=[]),
        c("with_null", "validity", "categorical", column="x", allowed_values=[1, None]),
        c("as_text", "validity", "categorical", column="x", allowed_values=["1"]),
        c("bad_literal", "validity", "categorical", column="x", allowed_values=["one"]),
    ]).results(df))
    assert res["empty"]["violations"] == 2
    assert res["with_null"]["violations"] == 1
    assert res["as_text"]["violations"] == 1
    assert res["bad_literal"]["status"] == "ERROR"


def test_strict_dates(spark):
    values = ["2024-01-05", "2024-1-5", "2024-02-30", "2024-01-05abc", "x", "", " 2024-01-05", "2024-13-01", None]
    df = frame(spark, [(v,) for v in values], "d string")
    bad = failing_rows(df, c("d", "format", "date_format", column="d", expected_format="yyyy-MM-dd"))
    assert sorted(r["d"] for r in bad.collect()) == sorted(v for v in values[1:] if v is not None)


def test_errors_are_isolated(spark):
    df = frame(spark, [(1.0, "a"), (2.0, "b")], "x double, s string")
    res = rows_by_name(Suite([
        c("ok", "completeness", column="x"),
        c("missing", "completeness", column="nope"),
        c("bad_sql", "consistency", condition_sql="x >=>= 1"),
        c("unknown_col_sql", "consistency", condition_sql="y > 1"),
        c("unknown_type", "volume", column="x"),
        c("unknown_sub", "format", "checksum", column="x"),
        c("wrong_type", "format", "string_length", column="x", max_length=2),
        c("no_file", "consistency", "referential_integrity", column="s", reference_data_path="/nonexistent/x.parquet"),
        c("non_numeric", "stats", "mean_deviation", column="s", expected_mean=0, max_deviation_stddevs=1),
    ]).results(df))
    assert res["ok"]["status"] == "PASS"
    for name in ("missing", "bad_sql", "unknown_col_sql", "unknown_type", "unknown_sub", "wrong_type",
                 "no_file", "non_numeric"):
        assert res[name]["status"] == "ERROR", name
        assert res[name]["metric"] is None and res[name]["violations"] is None
        assert res[name]["total_rows"] == 2


def test_runtime_error_isolated_by_run(spark):
    df = frame(spark, [("1",), ("x",)], "s string")
    suite = Suite([
        c("ok", "completeness", column="s"),
        c("ansi_cast", "consistency", condition_sql="CAST(s AS INT) > 0"),
    ])
    res = rows_by_name(suite.run(df))
    assert res["ok"]["status"] == "PASS"
    assert res["ansi_cast"]["status"] == "ERROR"
    assert res["ansi_cast"]["total_rows"] == 2


def test_no_constraints_reports_true_total(spark):
    df = frame(spark, [(1.0, "a")], "x double, s string")
    res = rows_by_name(Suite([
        c("r", "validity", "range", column="x"),
        c("l", "format", "string_length", column="s"),
    ]).results(df))
    assert res["r"]["status"] == "PASS" and res["r"]["total_rows"] == 1
    assert res["l"]["status"] == "PASS" and res["l"]["total_rows"] == 1


def test_names_count_dots_nested(spark):
    schema = T.StructType([
        T.StructField("count", T.LongType()),
        T.StructField("a.b", T.StringType()),
        T.StructField("n", T.StructType([T.StructField("f", T.DoubleType())])),
    ])
    df = frame(spark, [(1, "x", (1.0,)), (1, "x", (None,)), (2, None, (3.0,))], schema)
    res = rows_by_name(Suite([
        c("u_count", "uniqueness", column="count"),
        c("nn_dot", "completeness", column="a.b"),
        c("nn_nested", "completeness", column="n.f"),
        c("type_nested", "format", "data_type", column="n.f", expected_spark_type_str="double"),
    ]).results(df))
    assert res["u_count"]["violations"] == 2
    assert res["nn_dot"]["violations"] == 1
    assert res["nn_nested"]["violations"] == 1
    assert res["type_nested"]["status"] == "PASS"


def test_referential_nulls(spark):
    df = frame(spark, [(1,), (2,), (None,), (2,)], "k int")
    ref = frame(spark, [(1,), (None,)], "k int")
    res = rows_by_name(Suite([
        c("ri", "consistency", "referential_integrity", column="k", reference=ref),
        c("ri_nn", "consistency", "referential_integrity", column="k", reference=ref, nulls_are_violations=False),
    ]).results(df))
    assert res["ri"]["violations"] == 3  # both 2s and the NULL key
    assert res["ri_nn"]["violations"] == 2
    orphans = failing_rows(df, c("ri", "consistency", "referential_integrity", column="k", reference=ref))
    assert orphans.count() == 3


def test_threshold_inclusive(spark):
    df = frame(spark, [(None,), (1.0,), (2.0,), (3.0,)], "x double")
    res = rows_by_name(Suite([
        c("at", "completeness", column="x", threshold=0.25),
        c("below", "completeness", column="x", threshold=0.2499),
    ]).results(df))
    assert res["at"]["status"] == "PASS" and math.isclose(res["at"]["metric"], 0.25)
    assert res["below"]["status"] == "FAIL"


def test_spec_validation():
    with pytest.raises(SpecError):
        Suite([{"check_type": "completeness"}])
    with pytest.raises(SpecError):
        Suite([{"check_name": "a"}])
    with pytest.raises(SpecError):
        Suite([c("a", "completeness", column="x"), c("a", "uniqueness", column="x")])


def test_user_registered_check(spark):
    from pyspark.sql import functions as F

    from veracity import register
    from veracity.operators.checks import RowCheck

    @register("validity", "even")
    def _even(df, spec, ctx):
        col = F.col(spec.param("column"))
        return RowCheck(col.isNotNull() & (col % 2 != 0), "are odd")

    df = frame(spark, [(1,), (2,), (3,)], "x int")
    res = rows_by_name(Suite([c("even", "validity", "even", column="x")]).results(df))
    assert res["even"]["violations"] == 2


def test_run_strategies_agree(spark, dedup):
    from veracity.plans.flow import standard_suite

    suite = Suite(standard_suite("/root/testdata/sf0.01/customer.parquet", reference_column="c_custkey",
                                 expected_mean=255000.0, start_date_type="timestamp_ntz"))
    cols = ["check_name", "status", "violations", "total_rows"]
    lazy = [tuple(r) for r in suite.results(dedup).select(cols).collect()]
    mat = [tuple(r) for r in suite.run(dedup, materialize_input=True).select(cols).collect()]
    per = [tuple(r) for r in suite.run(dedup, persist=True).select(cols).collect()]
    assert lazy == mat == per
    assert not dedup.is_cached


def test_reference_forms(spark):
    from conftest import SF001

    df = spark.read.parquet(f"{SF001}/orders.parquet")
    base = {"check_name": "ri", "check_type": "consistency", "sub_type": "referential_integrity"}
    forms = [
        {"column": "o_custkey", "reference": f"{SF001}/customer.parquet", "reference_column": "c_custkey"},
        {"column": "o_custkey", "reference_data_path": "customer.parquet", "reference_column": "c_custkey"},
        {"column": "o_custkey", "reference": "no_such_table", "reference_column": "c_custkey"},
    ]
    got = [Suite([dict(base, params=p)], base_dir=SF001).results(df).first() for p in forms]
    assert got[0]["status"] == got[1]["status"] != "ERROR"
    assert got[0]["violations"] == got[1]["violations"]
    assert got[2]["status"] == "ERROR"


def test_invalid_date_pattern_is_an_error_row_in_the_lazy_plan(spark):
    df = frame(spark, [("2024-01-05",), ("x",)], "d string")
    res = rows_by_name(Suite([
        c("ok", "completeness", column="d"),
        c("bad", "format", "date_format", column="d", expected_format="yyyy-MM-dd'"),
        c("good", "format", "date_format", column="d", expected_format="yyyy-MM-dd"),
    ]).results(df))
    assert res["ok"]["status"] == "PASS"
    assert res["bad"]["status"] == "ERROR"
    assert res["good"]["violations"] == 1


def test_invalid_regex_is_an_error_row_in_the_lazy_plan(spark):
    df = frame(spark, [("a@b",), ("x",)], "s string")
    res = rows_by_name(Suite([
        c("bad", "validity", "regex", column="s", pattern="([a-z"),
        c("good", "validity", "regex", column="s", pattern="@"),
    ]).results(df))
    assert res["bad"]["status"] == "ERROR"
    assert res["good"]["violations"] == 1


def test_uncastable_reference_is_an_error_row_and_maps_group(spark):
    df = spark.createDataFrame([({"a": 1}, 1), ({"a": 1}, 2), ({"b": 2}, 3)], "m map<string,int>, k int")
    ref = spark.createDataFrame([((1, 2),)], "r struct<x:int,y:int>")
    res = rows_by_name(Suite([
        c("u_map", "uniqueness", column="m"),
        c("u_k", "uniqueness", column="k"),
        c("ri_struct", "consistency", "referential_integrity", column="k", reference=ref, reference_column="r"),
    ]).results(df))
    assert res["u_map"]["violations"] == 2  # Spark 4.1 groups by map values
    assert res["ri_struct"]["status"] == "ERROR"  # struct keys do not cast to int
    assert res["u_k"]["status"] == "PASS" and res["u_k"]["total_rows"] == 3


def test_keep_latest_keeps_user_columns_with_helper_like_names(spark):
    from veracity import keep_latest

    df = frame(spark, [("a", 1, 10), ("a", 2, 20), (None, 3, 30)], "k string, o int, __rn int")
    out = {tuple(r) for r in keep_latest(df, "k", "o", "__rn").collect()}
    assert out == {("a", 2, 20), (None, 3, 30)}
