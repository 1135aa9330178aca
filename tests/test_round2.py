"""Faults the first verdict found: each once lost rows or gave another answer."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from veracity import Suite, session
from veracity.operators import drilldown, skew
from veracity.operators.clean import ClampMin, apply_rules
from veracity.operators.drilldown import failing_rows, rows_in_duplicate_groups
from veracity.sources import sinks
from veracity.sources.readers import read_table


def test_raised_hot_threshold_loses_no_rows(spark, monkeypatch):
    rows = [(k, i) for k in range(6) for i in range(10)] + [(100, 1)]
    df = spark.createDataFrame(rows, "k long, i long")
    small = lambda sizes, hot_rows: skew.hot_keys(sizes, hot_rows, 2)
    monkeypatch.setattr(drilldown, "hot_keys", small)
    assert rows_in_duplicate_groups(df, F.col("k"), hot_rows=4).count() == 60
    uneven = spark.createDataFrame([(k, i) for k in range(6) for i in range(5 + 3 * k)], "k long, i long")
    assert rows_in_duplicate_groups(uneven, F.col("k"), hot_rows=4).count() == uneven.count()


def test_two_reference_columns_of_one_table(spark):
    ref = spark.createDataFrame([(1, 10), (2, 20)], "a long, b long")
    df = spark.createDataFrame([(1,), (2,)], "x long")
    checks = [{"check_name": c, "check_type": "consistency", "sub_type": "referential_integrity",
               "params": {"column": "x", "reference": ref, "reference_column": c}} for c in ("a", "b")]
    got = {r.check_name: r.violations for r in Suite(checks).results(df).collect()}
    assert got == {"a": 0, "b": 2}


def test_table_log_keeps_earlier_runs(spark):
    name = f"log_{uuid.uuid4().hex}"
    results = Suite([{"check_name": "n", "check_type": "completeness", "params": {"column": "id"}}]).results(spark.range(5))
    for run in ("one", "two", "two"):
        sinks.append_results_log(results, name, run, "2024-01-01 00:00:00", "src", kind="table")
    try:
        assert sorted(r.run_id for r in sinks.read_results_log(spark, name, "table").collect()) == ["one", "two"]
    finally:
        spark.sql(f"drop table {name}")
        spark.sql(f"drop table {name}_ledger")


def test_materialized_input_keeps_every_column(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a long, b long, c long")
    suite = Suite([{"check_name": "three", "check_type": "consistency", "params": {"condition_sql": "size(array(*)) = 3"}}])
    assert suite.run(df, materialize_input=True).first().status == suite.results(df).first().status == "PASS"


def test_tables_are_read_afresh(spark, tmp_path):
    spark.range(10).write.parquet(f"{tmp_path}/t.parquet")
    assert read_table(spark, str(tmp_path), "t").count() == 10
    spark.range(5).write.mode("append").parquet(f"{tmp_path}/t.parquet")
    assert read_table(spark, str(tmp_path), "t").count() == 15


def test_reference_values_compare_in_the_common_type(spark):
    df = spark.createDataFrame([(1,), (2,)], "x long")
    text = spark.createDataFrame([("1",), ("zz",)], "x string")
    halves, longs = spark.createDataFrame([(1.5,), (2.0,)], "y double"), spark.createDataFrame([(1,)], "y long")
    for frame, ref in ((df, halves), (text, longs)):
        check = {"check_name": "r", "check_type": "consistency", "sub_type": "referential_integrity",
                 "params": {"column": "x", "reference": ref, "reference_column": "y"}}
        assert Suite([check]).results(frame).first().violations == 1 == failing_rows(frame, check).count()


def test_bad_parameters_are_error_rows(spark):
    df = spark.createDataFrame([(1, "a", dt.date(2024, 1, 1))], "n long, s string, d date")
    bad = [("range", {"column": "n", "max_val": 0}), ("range", {"column": "n", "min_value": "zz"}),
           ("range", {"column": "d", "min_value": "not a date"}), ("categorical", {"column": "d", "allowed_values": ["x"]}),
           ("range", {"column": "n", "min_value": 0, "threshold": "5%"}), ("range", {"column": "n", "threshold": None})]
    checks = [{"check_name": f"bad{i}", "check_type": "validity", "sub_type": s, "params": p} for i, (s, p) in enumerate(bad)]
    checks.append({"check_name": "good", "check_type": "completeness", "sub_type": "ignored", "params": {"column": "n"}})
    checks.append({"check_name": "inf", "check_type": "validity", "sub_type": "range",
                   "params": {"column": "n", "max_value": float("inf")}})
    rows = {r.check_name: r for r in Suite(checks).results(df).collect()}
    assert [rows[f"bad{i}"].status for i in range(len(bad))] == ["ERROR"] * len(bad)
    assert rows["good"].status == rows["inf"].status == "PASS" and "Infinity" not in rows["inf"].parameters


def test_clamp_keeps_the_type(spark):
    df = spark.createDataFrame([(-1, 2)], "a long, b long")
    out = apply_rules(df, [ClampMin("a")])
    assert out.schema["a"].dataType == df.schema["a"].dataType and out.first().a == 0


def test_scratch_tables_go_with_their_block(spark):
    with session.scratch_tables() as outer:
        with session.scratch_tables() as inner:
            gone, kept = session.materialize(spark.range(3)), session.materialize(spark.range(4))
            paths = [p for _, p in inner.tables]
            inner.keep(kept)
        assert kept.count() == 4 and [p for _, p in outer.tables] == paths[1:]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(paths[1])


def test_a_cluster_must_name_its_shared_folder():
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Context:
        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(session.NoSharedFolder):
        session.shared_dir(Session())
