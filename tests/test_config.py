"""The reference's configuration shape, end to end: read → clean → dedup → suite → report → log."""

import os

from conftest import SF01

from veracity.plans import history
from veracity.plans.config import run_config
from veracity.plans.flow import standard_suite
from veracity.session import scratch_path
from veracity.sources import sinks


def test_run_config_end_to_end(spark, txn):
    base = scratch_path(spark, "config")
    txn.write.parquet(f"{base}/data/synthetic_errors/synthetic_data.parquet")
    checks = standard_suite(f"{SF01}/customer.parquet", reference_column="c_custkey",
                            expected_mean=255000.0, start_date_type="timestamp_ntz")
    config_text = f"""
data_source: "data/synthetic_errors/missing_dir"
cleaning:
  dedup: {{tiebreak: row_key}}
checks: {__import__("json").dumps(checks)}
reporting:
  output_formats: ["json", "csv"]
  report_dir: "reports"
  report_filename_prefix: "dq_report"
database_logging:
  enabled: true
  path: "log"
"""
    results = run_config(spark, config_text, base_dir=base, run_id="run-1")
    rows = results.collect()
    assert len(rows) == 18
    assert sorted(r["check_name"] for r in rows if r["status"] == "FAIL") == [
        "check_user_id_not_null", "check_user_id_unique"]
    reports = os.listdir(f"{base}/reports")
    assert len(reports) == 1 and reports[0].startswith("dq_report_")
    assert spark.read.json(f"{base}/reports/{reports[0]}/json").count() == 18
    log = sinks.read_results_log(spark, f"{base}/log")
    assert [tuple(r) for r in history.run_history(log).select("run_id", "check_count").collect()] == [("run-1", 18)]


def test_run_config_default_tiebreak_is_deterministic(spark, txn):
    base = scratch_path(spark, "config2")
    txn.write.parquet(f"{base}/t.parquet")
    cfg = {"data_source": f"{base}/t.parquet",
           "checks": [{"check_name": "u", "check_type": "uniqueness", "params": {"column": "transaction_id"}}]}
    a = run_config(spark, cfg).first()
    b = run_config(spark, cfg).first()
    assert a["violations"] == b["violations"] == 10


def test_command_line(spark, txn, capsys):
    import json

    from veracity.__main__ import main

    base = scratch_path(spark, "cli")
    txn.write.parquet(f"{base}/data.parquet")
    cfg = {
        "data_source": "data.parquet",
        "cleaning": False,
        "checks": [
            {"check_name": "price_min", "check_type": "validity", "sub_type": "range",
             "params": {"column": "price", "min_value": 0.0, "threshold": 0.5}},
            {"check_name": "ids_unique", "check_type": "uniqueness", "params": {"column": "transaction_id"}},
        ],
    }
    with open(f"{base}/pipeline.json", "w") as fh:
        json.dump(cfg, fh)
    assert main(["run", f"{base}/pipeline.json"], spark=spark) == 1  # ids_unique fails
    out = capsys.readouterr().out
    assert "price_min" in out and "ids_unique" in out
    assert main(["failures", f"{base}/pipeline.json", "price_min", "--limit", "3"], spark=spark) == 0
    assert "150 failing rows for 'price_min'" in capsys.readouterr().out


def test_command_line_generate(spark, capsys):
    from veracity.__main__ import main

    base = scratch_path(spark, "gen")
    assert main(["generate", base, "--rows", "20000", "--partitions", "2"], spark=spark) == 0
    txn = spark.read.parquet(f"{base}/transactions")
    users = spark.read.parquet(f"{base}/users")
    assert txn.count() == 20000
    assert 19000 < users.count() < 20000
    assert len(txn.inputFiles()) == 2


def test_quickstart_example(spark):
    import importlib.util

    from conftest import ROOT, SF001

    spec = importlib.util.spec_from_file_location("quickstart", f"{ROOT}/examples/quickstart.py")
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    out = mod.main(SF001, spark=spark)
    assert out["checks"] == 18 and out["orphans"] > 0


def test_example_yaml_through_the_command_line(spark, capsys):
    from conftest import ROOT, SF001

    from veracity.__main__ import main
    from veracity.plans.config import load_config

    path = f"{ROOT}/examples/orders_checks.yaml"
    cfg = load_config(path)
    cfg["reporting"] = {"output_formats": ["json"], "report_dir": scratch_path(spark, "example-reports")}
    import json

    local = scratch_path(spark, "example-config") + ".json"
    with open(local, "w") as fh:
        json.dump(cfg, fh)
    code = main(["run", local, "--base-dir", SF001], spark=spark)
    out = capsys.readouterr().out
    assert code in (0, 1)
    for check in cfg["checks"]:
        assert check["check_name"] in out
