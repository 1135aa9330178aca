import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    builder = (
        SparkSession.builder.master("local[4]")
        .appName("veracity-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    # Tests own their shared folder only when the session names none.
    if not session.conf.get("spark.checkpoint.dir", None) and not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="veracity-test-ckpt-"))
    yield session


@pytest.fixture(scope="session")
def txn(spark):
    from veracity.plans.fixtures import transactions_from_orders

    return transactions_from_orders(spark.read.parquet(f"{SF01}/orders.parquet"))


@pytest.fixture(scope="session")
def dedup(txn):
    from veracity.plans.flow import clean_and_dedup

    return clean_and_dedup(txn)


def rows_by_name(results):
    return {r["check_name"]: r for r in results.collect()}
