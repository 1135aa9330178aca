"""Streaming: per-batch suites and running (stateful) totals over several micro-batches."""

from conftest import SF01, rows_by_name

from veracity import Suite
from veracity.session import scratch_path
from veracity.streaming.microbatch import run_running_results, run_suite_on_stream

CHECKS = [
    {"check_name": "nn", "check_type": "completeness", "params": {"column": "o_custkey"}},
    {"check_name": "min", "check_type": "validity", "sub_type": "range",
     "params": {"column": "o_totalprice", "min_value": 100000}},
    {"check_name": "status", "check_type": "validity", "sub_type": "categorical",
     "params": {"column": "o_orderstatus", "allowed_values": ["O", "F"]}},
    {"check_name": "mean", "check_type": "stats", "sub_type": "mean_deviation",
     "params": {"column": "o_totalprice", "expected_mean": 150000, "max_deviation_stddevs": 1}},
]


def split_orders(spark, parts=4):
    path = scratch_path(spark, "orders-split")
    spark.read.parquet(f"{SF01}/orders.parquet").repartition(parts).write.parquet(path)
    return path


def test_running_totals_equal_batch_suite(spark):
    path = split_orders(spark)
    running = rows_by_name(run_running_results(spark, path, CHECKS, max_files_per_trigger=1))
    batch = rows_by_name(Suite(CHECKS).results(spark.read.parquet(path)))
    for name in ("nn", "min", "status"):
        assert running[name]["violations"] == batch[name]["violations"], name
        assert running[name]["total_rows"] == batch[name]["total_rows"] == 15000
    assert abs(running["mean"]["metric"] - batch["mean"]["metric"]) < 1e-9


def test_per_batch_results(spark):
    path = split_orders(spark)
    out = run_suite_on_stream(spark, path, CHECKS[:3], max_files_per_trigger=1)
    per_batch = out.where("check_name = 'nn'").groupBy("batch_id").sum("total_rows").collect()
    assert len(per_batch) == 4
    assert sum(r[1] for r in per_batch) == 15000
