"""End-to-end example on the driver's tables.

    python examples/quickstart.py [/root/testdata/sf0.01]

Builds the dirty transactions fixture from ``orders``, cleans and
deduplicates it, runs the 18-check suite against ``customer`` as the users
reference, writes a JSON + CSV report, appends the run to a results log, and
shows the orphan rows behind the referential check.
"""

from __future__ import annotations

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402


def main(sf_dir: str = "/root/testdata/sf0.01", spark: SparkSession | None = None) -> dict:
    from veracity import Suite, failing_rows
    from veracity.plans import history
    from veracity.plans.fixtures import transactions_from_orders
    from veracity.plans.flow import clean_and_dedup, standard_suite
    from veracity.session import scratch_path
    from veracity.sources import sinks

    if spark is None:
        spark = (SparkSession.builder.master("local[*]").config("spark.ui.enabled", "false")
                 .config("spark.sql.shuffle.partitions", "8").getOrCreate())
        if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="veracity-example-"))

    raw = transactions_from_orders(spark.read.parquet(f"{sf_dir}/orders.parquet"))
    checks = standard_suite(f"{sf_dir}/customer.parquet", reference_column="c_custkey",
                            expected_mean=255000.0, start_date_type=["timestamp", "timestamp_ntz"])

    # eager run: the cleaned, deduplicated table is written once to the shared folder
    results = Suite(checks).run(clean_and_dedup(raw), materialize_input=True)
    results.select("check_name", "status", "metric", "message").show(len(checks), truncate=90)

    out = scratch_path(spark, "example")
    sinks.write_report(results, f"{out}/report", ("json", "csv"))
    sinks.append_results_log(results, f"{out}/log", "example-run", data_source=sf_dir)
    history.run_history(sinks.read_results_log(spark, f"{out}/log")).show(truncate=False)

    orphans = failing_rows(raw, checks[-1])
    orphans.select("row_key", "user_id", "transaction_id").show(5)
    return {"checks": results.count(), "failed": results.where("status != 'PASS'").count(),
            "orphans": orphans.count(), "output": out}


if __name__ == "__main__":
    print(main(*sys.argv[1:2]))
