"""Golden values at sf0.01 (FIXTURES.md §4), identical in Spark and DuckDB."""

from conftest import SF01, rows_by_name
from pyspark.sql import functions as F

from veracity import Suite
from veracity.operators.clean import EMAIL_PATTERN
from veracity.operators.drilldown import failing_rows
from veracity.operators.extensions import repair_audit
from veracity.plans.flow import standard_suite

CUSTOMER = f"{SF01}/customer.parquet"


def c(name, t, sub=None, **p):
    d = {"check_name": name, "check_type": t, "params": p}
    if sub:
        d["sub_type"] = sub
    return d


CHECKS = [
    c("nn_user", "completeness", column="user_id"),
    c("nn_price", "completeness", column="price"),
    c("nn_qty", "completeness", column="quantity"),
    c("nn_txn", "completeness", column="transaction_id"),
    c("u_user", "uniqueness", column="user_id"),
    c("u_txn", "uniqueness", column="transaction_id"),
    c("r_min", "validity", "range", column="price", min_value=0),
    c("r_max", "validity", "range", column="price", max_value=400000),
    c("rx", "validity", "regex", column="email", pattern=EMAIL_PATTERN),
    c("cat_c", "validity", "categorical", column="country_code",
      allowed_values=["US", "CA", "MX", "GB", "DE", "FR", "UNKNOWN"]),
    c("cat_s", "validity", "categorical", column="order_status",
      allowed_values=["COMPLETED", "PENDING", "CANCELLED", "FAILED", "UNKNOWN"]),
    c("cond", "consistency", condition_sql="end_date >= start_date"),
    c("len_p", "format", "string_length", column="product_id", fixed_length=4),
    c("len_c", "format", "string_length", column="country_code", min_length=2, max_length=7),
    c("date", "format", "date_format", column="date_text", expected_format="yyyy-MM-dd"),
    c("ri", "consistency", "referential_integrity", column="user_id",
      reference_data_path=CUSTOMER, reference_column="c_custkey"),
    c("ri_nn", "consistency", "referential_integrity", column="user_id",
      reference_data_path=CUSTOMER, reference_column="c_custkey", nulls_are_violations=False),
    c("mean", "stats", "mean_deviation", column="price", expected_mean=255000, max_deviation_stddevs=3),
]

TXN_EXPECTED = {
    "nn_user": 15, "nn_price": 750, "nn_qty": 750, "nn_txn": 30, "u_user": 14737, "u_txn": 904,
    "r_min": 150, "r_max": 3557, "rx": 300, "cat_c": 2142, "cat_s": 3000, "cond": 1500, "len_p": 75,
    "len_c": 0, "date": 750, "ri": 315, "ri_nn": 300,
}
DEDUP_EXPECTED = {
    "nn_user": 15, "nn_price": 730, "nn_qty": 729, "nn_txn": 30, "u_user": 14294, "u_txn": 10,
    "r_min": 0, "r_max": 3446, "rx": 0, "cat_c": 0, "cat_s": 0, "cond": 1457, "len_p": 74,
    "len_c": 0, "date": 724, "ri": 303, "ri_nn": 288,
}


def test_txn_golden(txn):
    got = rows_by_name(Suite(CHECKS).results(txn))
    for name, v in TXN_EXPECTED.items():
        assert got[name]["violations"] == v, name
        assert got[name]["total_rows"] == 15000
    assert round(got["mean"]["metric"], 6) == 0.061809
    assert '"actual_mean":245592.36' in got["mean"]["details"]


def test_dedup_golden(dedup):
    assert dedup.count() == 14553
    got = rows_by_name(Suite(CHECKS).results(dedup))
    for name, v in DEDUP_EXPECTED.items():
        assert got[name]["violations"] == v, name
        assert got[name]["total_rows"] == 14553
    assert round(got["mean"]["metric"], 6) == 0.047487


def test_full_suite_16_pass_2_fail(dedup):
    suite = standard_suite(CUSTOMER, reference_column="c_custkey", expected_mean=255000.0,
                           start_date_type="timestamp_ntz")
    res = Suite(suite).results(dedup).collect()
    assert [r["check_name"] for r in res] == [s["check_name"] for s in suite]
    fails = sorted(r["check_name"] for r in res if r["status"] == "FAIL")
    assert fails == ["check_user_id_not_null", "check_user_id_unique"]
    assert sum(r["status"] == "PASS" for r in res) == 16


def test_full_suite_timestamp_name(dedup):
    suite = standard_suite(CUSTOMER, reference_column="c_custkey", expected_mean=255000.0)
    res = rows_by_name(Suite(suite).results(dedup))
    assert res["check_start_date_data_type"]["status"] == "FAIL"
    assert sum(r["status"] == "PASS" for r in res.values()) == 15


def test_flag_and_bypass(txn, dedup):
    from veracity.operators.clean import clean_transactions

    clean = clean_transactions(txn)
    assert clean.where("dates_marked_inconsistent").count() == 1500
    assert dedup.where("dates_marked_inconsistent").count() == 1457
    assert clean.where("start_date IS NULL").count() == 50
    assert clean.where("transaction_id IS NULL OR start_date IS NULL").count() == 80


def test_failing_rows_price(txn, dedup):
    rows = failing_rows(txn, c("r_min", "validity", "range", column="price", min_value=0))
    agg = rows.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("price"), 2).alias("s")).first()
    assert (agg["n"], agg["s"]) == (150, -34986605.96)
    orig = dedup.where("price_original < 0").agg(F.count(F.lit(1)), F.round(F.sum("price_original"), 2)).first()
    assert tuple(orig) == (149, -34814224.73)


def test_repair_audit(dedup):
    got = {r["column"]: r["repaired_rows"] for r in repair_audit(
        dedup, ["price", "email", "country_code", "order_status"]).collect()}
    assert got == {"price": 149, "email": 293, "country_code": 2077, "order_status": 2907}


def test_driver_tables(spark):
    t = lambda n: spark.read.parquet(f"{SF01}/{n}.parquet")
    r = rows_by_name(Suite([
        c("docs_unique", "uniqueness", column="text"),
        c("acct", "validity", "range", column="c_acctbal", min_value=0),
    ][:1]).results(t("documents")))
    assert r["docs_unique"]["violations"] == 135
    r = rows_by_name(Suite([c("acct", "validity", "range", column="c_acctbal", min_value=0)]).results(t("customer")))
    assert r["acct"]["violations"] == 122
    r = rows_by_name(Suite([c("url", "validity", "regex", column="url", pattern="^https://")]).results(t("pages")))
    assert r["url"]["violations"] == 84
    r = rows_by_name(Suite([c("role", "validity", "categorical", column="role",
                              allowed_values=["user", "assistant"])]).results(t("conversations")))
    assert r["role"]["violations"] == 24
    r = rows_by_name(Suite([c("labels", "consistency", "referential_integrity", column="doc_id",
                              reference=t("labels"))]).results(t("documents")))
    assert r["labels"]["violations"] == 601
    r = rows_by_name(Suite([c("m", "stats", "mean_deviation", column="value", expected_mean=0,
                              max_deviation_stddevs=3)]).results(t("events")))
    assert '"actual_mean":49.63' in r["m"]["details"]
