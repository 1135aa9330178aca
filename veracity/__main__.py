"""Command line: ``run``, ``failures`` and ``generate``.

``run CONFIG`` executes a configured pipeline (read → clean → dedup → checks →
report → results log, see ``plans/config.py``) and prints the results;
``failures CONFIG CHECK`` shows the failing rows of one configured check on the
raw data; ``generate OUT_DIR`` writes synthetic transactions with the
reference's error rates and a users table with holes and extras.
The command line owns the session (``--master``, default: the environment's
``spark-submit`` / ``local[*]``); the library itself never creates one.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import SparkSession


def _session(master: str | None) -> SparkSession:
    builder = SparkSession.builder.appName("veracity")
    if master:
        builder = builder.master(master)
    return builder.getOrCreate()


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="python -m veracity")
    parser.add_argument("--master", default=None, help="Spark master (default: from the environment)")
    sub = parser.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="run a configured pipeline and print the results")
    run.add_argument("config")
    run.add_argument("--base-dir", default=None, help="resolve relative paths here (default: the config's folder)")
    run.add_argument("--run-id", default=None)
    gen = sub.add_parser("generate", help="write synthetic transactions (with errors) and a users table")
    gen.add_argument("out_dir")
    gen.add_argument("--rows", type=int, default=1_000_000)
    gen.add_argument("--partitions", type=int, default=None, help="output files per table (default: Spark's)")
    gen.add_argument("--seed", type=int, default=7)
    fail = sub.add_parser("failures", help="show the failing rows of one configured check")
    fail.add_argument("config")
    fail.add_argument("check_name")
    fail.add_argument("--base-dir", default=None)
    fail.add_argument("--limit", type=int, default=20)
    args = parser.parse_args(argv)

    from veracity.operators.drilldown import failing_rows, preview
    from veracity.plans.config import load_config, run_config
    from veracity.sources.readers import read_with_single_file_fallback

    spark = spark or _session(args.master)
    if args.command == "generate":
        from veracity.operators import synth

        keys = spark.range(1, args.rows + 1)
        txn = synth.inject_transaction_errors(synth.generate_transactions(keys, "id", seed=args.seed))
        users = synth.generate_reference(spark.range(1, args.rows + 1).withColumnRenamed("id", "user_id"),
                                         distinct=False)
        out = args.out_dir.rstrip("/")
        for name, df in (("transactions", txn), ("users", users)):
            if args.partitions:
                df = df.repartition(args.partitions)
            df.write.mode("overwrite").parquet(f"{out}/{name}")
        print(f"wrote {out}/transactions and {out}/users")
        return 0
    config = load_config(args.config)
    base_dir = args.base_dir or os.path.dirname(os.path.abspath(args.config))
    if args.command == "run":
        results = run_config(spark, config, base_dir=base_dir, run_id=args.run_id)
        results.select("check_name", "status", "metric", "violations", "total_rows", "message").show(
            len(config.get("checks") or []) or 20, truncate=False
        )
        return 0 if all(r["status"] == "PASS" for r in results.select("status").collect()) else 1
    checks = {c.get("check_name"): c for c in config.get("checks") or []}
    if args.check_name not in checks:
        print(f"no check named '{args.check_name}' in {args.config}", file=sys.stderr)
        return 2
    source = config["data_source"]
    if "://" not in source and not os.path.isabs(source):
        source = os.path.join(base_dir, source)
    rows = failing_rows(read_with_single_file_fallback(spark, source), checks[args.check_name], base_dir=base_dir)
    print(f"{rows.count()} failing rows for '{args.check_name}'")
    preview(rows, args.limit).show(args.limit, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
