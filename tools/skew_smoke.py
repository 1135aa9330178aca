"""Skew smoke run: N generated transactions where one user_id and one transaction_id
each hold a third of all rows; times the suite, dedup and the drill-downs.

    python tools/skew_smoke.py [rows]      (default 5,000,000)
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def main() -> None:
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 5_000_000
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g")
             .config("spark.sql.shuffle.partitions", "32").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="veracity-skew-"))

    from veracity import Suite, failing_rows
    from veracity.operators import synth
    from veracity.plans.flow import clean_and_dedup, standard_suite

    keys = spark.range(1, n + 1, numPartitions=32)
    txn = synth.inject_transaction_errors(synth.generate_transactions(keys, "id"))
    hot = (F.col("user_id") % 3) == 0
    txn = txn.withColumns({
        "transaction_id": F.when(hot, F.lit("txn_hot")).otherwise(F.col("transaction_id")),
        "user_id": F.when(hot, F.lit(42)).otherwise(F.col("user_id")),
    })
    users = synth.generate_reference(spark.range(1, n + 1).select(F.col("id").alias("user_id")), distinct=False)
    checks = standard_suite(users)
    times = {}

    for label in ("suite_lazy_cold", "suite_lazy"):
        t = time.time()
        res = Suite(checks).results(clean_and_dedup(txn, tiebreak="email")).collect()
        times[label] = round(time.time() - t, 2)
    t = time.time()
    Suite(checks).run(clean_and_dedup(txn, tiebreak="email"), materialize_input=True)
    times["suite_materialized"] = round(time.time() - t, 2)
    t = time.time()
    dedup_rows = clean_and_dedup(txn, tiebreak="email").count()
    times["dedup_count"] = round(time.time() - t, 2)
    t = time.time()
    dup_rows = failing_rows(txn, {"check_name": "u", "check_type": "uniqueness",
                                  "params": {"column": "transaction_id"}}).count()
    times["duplicate_rows"] = round(time.time() - t, 2)
    t = time.time()
    orphans = failing_rows(txn, {"check_name": "ri", "check_type": "consistency", "sub_type": "referential_integrity",
                                 "params": {"column": "user_id", "reference": users}}).count()
    times["orphan_rows"] = round(time.time() - t, 2)
    status = {r["check_name"]: (r["status"], r["violations"]) for r in res}
    print(json.dumps({"rows": n, "times": times, "dedup_rows": dedup_rows, "duplicate_rows": dup_rows,
                      "orphan_rows": orphans, "uniqueness": status["check_transaction_id_unique_post_dedupe"]}))


if __name__ == "__main__":
    main()
