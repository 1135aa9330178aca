"""Report sinks, results log, history queries and readers."""

import datetime as dt

import pytest

from veracity import Suite
from veracity.plans import history
from veracity.session import scratch_path
from veracity.sources import sinks
from veracity.sources.readers import read_dir_or_file, read_parquet, read_with_single_file_fallback

CHECKS = [
    {"check_name": "nn", "check_type": "completeness", "params": {"column": "x"}},
    {"check_name": "cond, with \"quotes\"", "check_type": "consistency",
     "params": {"condition_sql": "s != 'a,b\nc'", "threshold": 0.5}},
    {"check_name": "flat", "check_type": "stats", "sub_type": "mean_deviation",
     "params": {"column": "x", "expected_mean": 9, "max_deviation_stddevs": 1}},
]


@pytest.fixture(scope="module")
def results(spark):
    df = spark.createDataFrame([(1.0, "a,b\nc"), (1.0, "x")], "x double, s string")
    return Suite(CHECKS).results(df)


@pytest.mark.parametrize("fmt", ["parquet", "json", "csv"])
def test_roundtrip(spark, results, fmt):
    path = scratch_path(spark, f"rt-{fmt}")
    sinks.write_results(results, path, fmt)
    back = sinks.read_results(spark, path, fmt)
    cols = ["check_name", "status", "metric", "violations", "total_rows", "message", "parameters", "details"]
    assert sorted(map(tuple, back.select(cols).collect())) == sorted(map(tuple, sinks.sanitize(results).select(cols).collect()))


def test_non_finite_metric_is_null(spark, results):
    flat = {r["check_name"]: r for r in results.collect()}["flat"]
    assert flat["status"] == "FAIL" and flat["metric"] is None


def test_report_and_log(spark, results):
    base = scratch_path(spark, "log")
    written = sinks.write_report(results, f"{base}/report", ("json", "csv"))
    assert spark.read.json(written["json"]).count() == 3
    assert len(spark.read.json(written["json"]).inputFiles()) == 1  # one report file
    t1, t2 = dt.datetime(2024, 1, 1, 0, 0), dt.datetime(2024, 1, 2, 0, 0)
    sinks.append_results_log(results, f"{base}/log", "r1", t1, "src")
    sinks.append_results_log(results, f"{base}/log", "r2", t2, "src")
    sinks.append_results_log(results, f"{base}/log", "r2", t2, "src")  # a retried run replaces itself
    log = sinks.read_results_log(spark, f"{base}/log")
    assert log.columns == sinks.LOG_SCHEMA.fieldNames()
    assert log.count() == 6
    runs = history.run_history(log).collect()
    assert [(r["run_id"], r["check_count"]) for r in runs] == [("r2", 3), ("r1", 3)]
    failing = history.non_passing(log).collect()
    assert [r["run_id"] for r in failing] == ["r1", "r2"]
    latest = history.latest_results(log, 2).collect()
    assert {r["run_id"] for r in latest} == {"r2"}
    recent = history.run_history(log, since="2024-01-02")
    assert [r["run_id"] for r in recent.collect()] == ["r2"]
    text = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in text and "run_date" in text


def test_readers_fallback(spark, results, tmp_path_factory):
    base = scratch_path(spark, "readers")
    sinks.write_results(results, f"{base}/synthetic_data.parquet", "parquet")
    assert read_with_single_file_fallback(spark, f"{base}/missing_dir").count() == 3
    assert read_dir_or_file(spark, base + "/synthetic_data.parquet").count() == 3
    assert read_parquet(spark, [f"{base}/nope", f"{base}/synthetic_data.parquet"]).count() == 3
    with pytest.raises(FileNotFoundError):
        read_parquet(spark, f"{base}/nope", f"{base}/nope2")


def test_stream_suite_batches(spark):
    from conftest import SF001

    from veracity.streaming.microbatch import run_suite_on_stream

    out = run_suite_on_stream(spark, f"{SF001}/orders.parquet", [
        {"check_name": "nn", "check_type": "completeness", "params": {"column": "o_custkey"}},
        {"check_name": "u", "check_type": "uniqueness", "params": {"column": "o_orderkey"}},
    ])
    rows = out.collect()
    assert {r["batch_id"] for r in rows} == {0}
    assert {r["check_name"]: r["status"] for r in rows} == {"nn": "PASS", "u": "PASS"}
    assert rows[0]["total_rows"] == spark.read.parquet(f"{SF001}/orders.parquet").count()
