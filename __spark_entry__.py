"""

Every query reads the driver's tables (or data Spark derives from them) and
runs over the whole table.  The Spark side goes through the ``veracity``
library; the oracle side is plain DuckDB SQL written independently from the
check semantics (NULL / NaN rules, inclusive thresholds, all-row
denominators), so agreement is evidence, not tautology.  Results are compared
on ``check_name, status, violations, total_rows, metric`` (metric rounded to
6 places; violations -1 where a check has no count, e.g. ERROR rows and
statistics).
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable
from functools import reduce

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from veracity import Suite, compact  # noqa: E402
from veracity.operators import synth  # noqa: E402
from veracity.operators.clean import EMAIL_PATTERN, ClampMin, apply_rules, clean_transactions  # noqa: E402
from veracity.operators.dedup import keep_latest  # noqa: E402
from veracity.operators.drilldown import failing_rows, preview  # noqa: E402
from veracity.operators.extensions import castable_check, gate_split, repair_audit  # noqa: E402
from veracity.plans import history  # noqa: E402
from veracity.plans.fixtures import transactions_from_orders  # noqa: E402
from veracity.plans.flow import check_transactions, clean_and_dedup, standard_suite  # noqa: E402
from veracity.session import materialize, scratch_path  # noqa: E402
from veracity.sources import sinks  # noqa: E402
from veracity.sources.readers import read_dir_or_file, read_parquet, read_table, read_with_single_file_fallback  # noqa: E402
from veracity.streaming.microbatch import run_running_results, run_suite_on_stream  # noqa: E402
from veracity.streaming.state import check_stream_so_far  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"

# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_table(spark, sf, name)


def _txn(spark: SparkSession, sf: str) -> DataFrame:
    return transactions_from_orders(_t(spark, sf, "orders"))


def _dedup(spark: SparkSession, sf: str) -> DataFrame:
    return clean_and_dedup(_txn(spark, sf))


def _suite(df: DataFrame, checks: list[dict]) -> DataFrame:
    return compact(Suite(checks).results(df))


def _c(name: str, check_type: str, sub_type: str | None = None, **params) -> dict:
    d = {"check_name": name, "check_type": check_type, "params": params}
    if sub_type:
        d["sub_type"] = sub_type
    return d


def _full_suite(sf: str, reference: str | None = None) -> list[dict]:
    return standard_suite(
        reference or f"{sf.rstrip('/')}/customer.parquet",
        reference_column="c_custkey",
        expected_mean=255000.0,
        start_date_type="timestamp_ntz",
    )


COMPLETENESS = [
    _c("user_id_not_null", "completeness", column="user_id", threshold=0.0),
    _c("price_not_null", "completeness", column="price", threshold=0.06),
    _c("quantity_not_null", "completeness", column="quantity", threshold=0.06),
    _c("transaction_id_not_null", "completeness", column="transaction_id", threshold=0.0),
]
UNIQUENESS = [
    _c("user_id_unique", "uniqueness", column="user_id", threshold=0.0),
    _c("transaction_id_unique", "uniqueness", column="transaction_id", threshold=0.001),
]
FUSED = COMPLETENESS + [
    _c("price_min_0", "validity", "range", column="price", min_value=0.0, threshold=0.001),
    _c("price_max_400k", "validity", "range", column="price", max_value=400000.0, threshold=0.2),
    _c("email_format", "validity", "regex", column="email", pattern=EMAIL_PATTERN, threshold=0.001),
    _c("country_allowed", "validity", "categorical", column="country_code",
       allowed_values=["US", "CA", "MX", "GB", "DE", "FR", "UNKNOWN"], threshold=0.001),
    _c("status_allowed", "validity", "categorical", column="order_status",
       allowed_values=["COMPLETED", "PENDING", "CANCELLED", "FAILED", "UNKNOWN"], threshold=0.001),
    _c("end_after_start", "consistency", condition_sql="end_date >= start_date", threshold=0.12),
    _c("product_id_len_4", "format", "string_length", column="product_id", fixed_length=4, threshold=0.01),
    _c("country_len_2_7", "format", "string_length", column="country_code", min_length=2, max_length=7, threshold=0.0),
    _c("email_len_max_20", "format", "string_length", column="email", max_length=20, threshold=0.5),
    _c("date_text_format", "format", "date_format", column="date_text", expected_format="yyyy-MM-dd", threshold=0.05),
]
ISOLATION = [
    _c("price_not_null", "completeness", column="price", threshold=0.06),
    _c("no_such_column", "completeness", column="does_not_exist", threshold=0.0),
    _c("bad_sql", "consistency", condition_sql="end_date >=>= start_date", threshold=0.0),
    _c("unknown_type", "volume", column="price"),
    _c("unknown_sub_type", "validity", "checksum", column="price"),
    _c("length_of_number", "format", "string_length", column="price", max_length=3),
    _c("transaction_id_unique", "uniqueness", column="transaction_id", threshold=0.001),
    _c("ref_missing_file", "consistency", "referential_integrity", column="user_id",
       reference_data_path="/nonexistent/users.parquet", reference_column="user_id"),
]


def q_completeness(spark, sf):
    return _suite(_txn(spark, sf), COMPLETENESS)


def q_uniqueness(spark, sf):
    return _suite(_txn(spark, sf), UNIQUENESS)


def q_uniqueness_documents(spark, sf):
    return _suite(_t(spark, sf, "documents"), [_c("doc_text_unique", "uniqueness", column="text", threshold=0.0)])


def q_duplicate_groups(spark, sf):
    return failing_rows(_t(spark, sf, "lineitem"), _c("orderkey_unique", "uniqueness", column="l_orderkey"))


def q_range_min(spark, sf):
    a = _suite(_txn(spark, sf), [_c("price_min_0", "validity", "range", column="price", min_value=0.0, threshold=0.001)])
    b = _suite(_t(spark, sf, "customer"),
               [_c("acctbal_min_0", "validity", "range", column="c_acctbal", min_value=0.0, threshold=0.1)])
    return a.unionByName(b)


def q_range_max_nan(spark, sf):
    return _suite(_txn(spark, sf),
                  [_c("price_max_400k", "validity", "range", column="price", max_value=400000.0, threshold=0.2)])


def q_regex_email(spark, sf):
    return _suite(_txn(spark, sf),
                  [_c("email_format", "validity", "regex", column="email", pattern=EMAIL_PATTERN, threshold=0.001)])


def q_regex_url(spark, sf):
    return _suite(_t(spark, sf, "pages"),
                  [_c("url_https", "validity", "regex", column="url", pattern="^https://", threshold=0.25)])


def q_categorical(spark, sf):
    return _suite(_txn(spark, sf), FUSED[7:9])


def q_categorical_role(spark, sf):
    return _suite(_t(spark, sf, "conversations"),
                  [_c("role_allowed", "validity", "categorical", column="role",
                      allowed_values=["user", "assistant"], threshold=0.0)])


def q_custom_condition(spark, sf):
    return _suite(_txn(spark, sf), [FUSED[9]])


def q_condition_text_length(spark, sf):
    return _suite(_t(spark, sf, "documents"),
                  [_c("n_chars_matches", "consistency", "custom_condition", condition_sql="n_chars = length(text)")])


def q_condition_joined(spark, sf):
    li, o = _t(spark, sf, "lineitem"), _t(spark, sf, "orders")
    joined = li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner")
    return _suite(joined, [_c("ship_after_order", "consistency", condition_sql="l_shipdate >= o_orderdate",
                              threshold=0.5)])


def q_ref_integrity(spark, sf):
    path = f"{sf.rstrip('/')}/customer.parquet"
    return _suite(_txn(spark, sf), [
        _c("user_in_customer", "consistency", "referential_integrity", column="user_id",
           reference_data_path=path, reference_column="c_custkey", threshold=0.03),
        _c("user_in_customer_non_null", "consistency", "referential_integrity", column="user_id",
           reference_data_path=path, reference_column="c_custkey", threshold=0.03, nulls_are_violations=False),
    ])


def q_ref_integrity_docs(spark, sf):
    a = _suite(_t(spark, sf, "documents"), [
        _c("doc_labelled", "consistency", "referential_integrity", column="doc_id",
           reference=_t(spark, sf, "labels"), reference_column="doc_id", threshold=0.5)])
    b = _suite(_t(spark, sf, "orders"), [
        _c("order_has_lines", "consistency", "referential_integrity", column="o_orderkey",
           reference=_t(spark, sf, "lineitem"), reference_column="l_orderkey", threshold=0.01)])
    return a.unionByName(b)


def q_length_fixed(spark, sf):
    return _suite(_txn(spark, sf), [FUSED[10]])


def q_length_range(spark, sf):
    return _suite(_txn(spark, sf), FUSED[11:13])


def q_date_format(spark, sf):
    return _suite(_txn(spark, sf), [FUSED[13]])


DATA_TYPES = [
    _c("orderkey_bigint", "format", "data_type", column="o_orderkey", expected_spark_type_str="bigint"),
    _c("totalprice_double", "format", "data_type", column="o_totalprice", expected_spark_type_str=" DOUBLE "),
    _c("orderdate_ntz", "format", "data_type", column="o_orderdate", expected_spark_type_str="timestamp_ntz"),
    _c("status_is_int", "format", "data_type", column="o_orderstatus", expected_spark_type_str="int"),
]


def q_data_type(spark, sf):
    return _suite(_t(spark, sf, "orders"), DATA_TYPES)


def q_mean_deviation(spark, sf):
    a = _suite(_txn(spark, sf), [_c("price_mean", "stats", "mean_deviation", column="price",
                                    expected_mean=255000.0, max_deviation_stddevs=3.0)])
    b = _suite(_t(spark, sf, "events"), [_c("value_mean", "stats", "mean_deviation", column="value",
                                            expected_mean=50.0, max_deviation_stddevs=0.001)])
    return a.unionByName(b)


def q_mean_deviation_inf(spark, sf):
    flat = _t(spark, sf, "orders").select((F.col("o_totalprice") * 0).alias("zero"))
    return _suite(flat, [
        _c("zero_vs_one", "stats", "mean_deviation", column="zero", expected_mean=1.0, max_deviation_stddevs=3.0),
        _c("zero_vs_zero", "stats", "mean_deviation", column="zero", expected_mean=0.0, max_deviation_stddevs=3.0),
    ])


def q_suite_fused(spark, sf):
    return _suite(_txn(spark, sf), FUSED)


def q_suite_full(spark, sf):
    """Cleaned and deduplicated once, into a table that both branches of the suite read."""
    return compact(check_transactions(_txn(spark, sf), _full_suite(sf)))


def q_suite_full_lazy(spark, sf):
    """The same suite as one lazy plan: nothing is written, every branch deduplicates for itself."""
    return _suite(_dedup(spark, sf), _full_suite(sf))


def q_suite_full_eager(spark, sf):
    """The same suite over an input deduplicated and written once."""
    return compact(Suite(_full_suite(sf)).run(_dedup(spark, sf), materialize_input=True))


def q_ref_mixed_types(spark, sf):
    """References of other types than the checked column: a double with fractions, and text."""
    c = _t(spark, sf, "customer")
    half = c.select((F.col("c_custkey") + F.when(F.col("c_custkey") % 2 == 0, 0.5).otherwise(0.0)).alias("k"))
    text = c.select(F.col("c_custkey").cast("string").alias("k"))
    return _suite(_txn(spark, sf), [
        _c("user_in_double", "consistency", "referential_integrity", column="user_id", reference=half, reference_column="k"),
        _c("user_in_text", "consistency", "referential_integrity", column="user_id", reference=text, reference_column="k"),
    ])


def q_suite_error_isolation(spark, sf):
    return _suite(_txn(spark, sf), ISOLATION)


def _clean(spark, sf):
    return clean_transactions(_txn(spark, sf))


def q_clean_backup(spark, sf):
    return _clean(spark, sf).select("row_key", "price_original", "email_original",
                                    "country_code_original", "order_status_original")


def q_clean_clamp(spark, sf):
    return _clean(spark, sf).select("row_key", "price")


def q_clean_regex_null(spark, sf):
    return _clean(spark, sf).select("row_key", "email")


def q_clean_whitelist(spark, sf):
    return _clean(spark, sf).select("row_key", "country_code", "order_status")


def q_clean_flag(spark, sf):
    return _clean(spark, sf).select("row_key", "dates_marked_inconsistent")


def q_dedup_keep_latest(spark, sf):
    return _dedup(spark, sf)


def q_dedup_all_null(spark, sf):
    nulls = _clean(spark, sf).where(F.col("transaction_id").isNull())
    return keep_latest(nulls, "transaction_id", "start_date", "row_key")


def q_dedup_events(spark, sf):
    return keep_latest(_t(spark, sf, "events"), "user_id", "ts", "event_id")


def q_failing_rows_range(spark, sf):
    return failing_rows(_txn(spark, sf), FUSED[4])


def q_failing_rows_preview(spark, sf):
    """The first 20 failing rows by key — a preview, where the limit is the feature (S10, L1)."""
    return preview(failing_rows(_txn(spark, sf), FUSED[6]), 20, order_by=["row_key"])


def q_failing_rows_ref(spark, sf):
    return failing_rows(_txn(spark, sf), _c("user_in_customer", "consistency", "referential_integrity",
                                            column="user_id", reference=_t(spark, sf, "customer"),
                                            reference_column="c_custkey"))


def q_report_roundtrip(spark, sf):
    results = materialize(Suite(FUSED + UNIQUENESS).results(_txn(spark, sf)), "results")
    base = scratch_path(spark, "report")
    parts = []
    for fmt in ("parquet", "json", "csv"):
        sinks.write_results(results, f"{base}/{fmt}", fmt)
        back = sinks.read_results(spark, f"{base}/{fmt}", fmt)
        parts.append(compact(back).withColumn("format", F.lit(fmt)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


REPORT_TS = "2024-01-01 00:00:00"


def q_report_entries(spark, sf):
    """What a reader of the report sees: every entry of the JSON and the CSV report, read back."""
    base = scratch_path(spark, "report-entries")
    written = sinks.write_report(Suite(FUSED + UNIQUENESS).results(_txn(spark, sf)), base, ("json", "csv"), REPORT_TS)
    schema = "check_name string, timestamp timestamp, status string, metric double, message string, parameters string, details string, ordinal int"
    parts = [sinks.read_results(spark, path, fmt, schema).withColumn("format", F.lit(fmt)) for fmt, path in written.items()]
    return _wall_clock(parts[0].unionByName(parts[1]), "timestamp").withColumn("metric", F.round("metric", 6)).withColumn(
        "details", F.regexp_replace("details", '"violations":.*"total_rows"', '"total_rows"'))


def q_log_for_dashboard(spark, sf):
    """The log's rows in the layout of the table that dashboards read."""
    rows = sinks.with_run_columns(Suite(FUSED).results(_txn(spark, sf)), "run-1", REPORT_TS, "txn")
    return _wall_clock(sinks.for_table(rows), "dq_check_timestamp", "check_run_timestamp").withColumn("metric", F.round("metric", 6)).drop("details")


def q_reader_fallbacks(spark, sf):
    """A missing path falls back to the single file beside it; a missing folder to the file inside; a present one is read."""
    base = scratch_path(spark, "fallbacks")
    _t(spark, sf, "customer").write.parquet(f"{base}/data/synthetic_data.parquet")
    _t(spark, sf, "nation").write.parquet(f"{base}/parts")
    found = {"beside": read_with_single_file_fallback(spark, f"{base}/data/missing"),
             "inside": read_dir_or_file(spark, f"{base}/data/nothing", "../synthetic_data.parquet"),
             "folder": read_dir_or_file(spark, f"{base}/parts"),
             "third": read_parquet(spark, [f"{base}/no", f"{base}/none", f"{base}/parts"])}
    counted = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("source"), "n") for name, df in found.items()]
    return reduce(DataFrame.unionByName, counted)


def q_failing_rows_none(spark, sf):
    """Drill-down where nothing fails, and on a table without rows: no rows, the table's columns."""
    impossible = _c("price_floor", "validity", "range", column="price", min_value=-1e15)
    none = failing_rows(_txn(spark, sf), impossible)
    return none.unionByName(failing_rows(_txn(spark, sf).limit(0), FUSED[4]))


def q_clean_clamp_types(spark, sf):
    """A fractional bound on integer, decimal and floating columns, which keep their types."""
    li = _t(spark, sf, "lineitem")
    typed = li.select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("int").alias("n"),
                      F.col("l_extendedprice").cast("decimal(12,1)").alias("d"), F.col("l_discount").alias("x"))
    out = apply_rules(typed, [ClampMin("n", 10.5), ClampMin("d", 20000.25), ClampMin("x", 0.045)])
    return out.withColumn("types", F.lit(",".join(t for _, t in out.dtypes[2:]))).withColumn("d", F.col("d").cast("double"))


RUNS = (("run-raw", "2024-01-01 00:00:00"), ("run-clean", "2024-01-01 00:05:00"))


def _log(spark, sf):
    """Two suite runs (raw and cleaned) appended to a results log, read back from storage."""
    suite = Suite(_full_suite(sf))
    path = scratch_path(spark, "results-log")
    sinks.append_results_log(suite.results(_txn(spark, sf)), path, RUNS[0][0], RUNS[0][1], "txn")
    sinks.append_results_log(check_transactions(_txn(spark, sf), _full_suite(sf)), path, RUNS[1][0], RUNS[1][1], "dedup")
    return sinks.read_results_log(spark, path)


def _ts_text(df: DataFrame) -> DataFrame:
    return df.withColumn("run_ts", F.date_format("run_ts", "yyyy-MM-dd HH:mm:ss"))


def q_results_log_runs(spark, sf):
    return _ts_text(history.run_history(_log(spark, sf)))


def q_results_log_failures(spark, sf):
    return _ts_text(history.non_passing(_log(spark, sf)).drop("message", "ordinal"))


def q_results_log_latest(spark, sf):
    return _ts_text(history.latest_results(_log(spark, sf), 18).drop("message")).withColumn(
        "metric", F.round("metric", 6))


def _wall_clock(df: DataFrame, *columns: str) -> DataFrame:
    """Instants as the text of the session's clock, the same in every engine."""
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in columns})


def q_results_log_table(spark, sf):
    """A catalog table: a run repeated on another date takes the place of its first attempt."""
    name = f"results_log_{uuid.uuid4().hex}"
    suite, txn = Suite(FUSED), _txn(spark, sf)
    tries = [("first", "2024-01-01 23:59:00", txn.limit(0)), ("second", "2024-01-02 08:00:00", txn), ("first", "2024-01-02 00:01:00", txn)]
    for run_id, run_ts, data in tries:
        sinks.append_results_log(suite.results(data), name, run_id, run_ts, "txn", kind="table")
    log = sinks.read_results_log(spark, name, kind="table")
    rows = materialize(log.select("run_id", F.date_format("run_ts", "yyyy-MM-dd HH:mm:ss").alias("run_ts"), "check_name", "status",
                                  "violations", "total_rows", F.col("run_date").cast("string").alias("run_date")), "log-rows")
    for table in (name, f"{name}_ledger"):
        spark.sql(f"DROP TABLE {table}")
    return rows


RUNTIME = FUSED[:3] + [
    _c("not_a_date", "consistency", condition_sql="CAST(date_text AS DATE) > DATE'2020-01-01'"),
    FUSED[4],
    _c("by_zero", "consistency", condition_sql="100 / (row_key % 5) > 0"),
    *UNIQUENESS,
    FUSED[9],
]


def q_suite_runtime_isolation(spark, sf):
    """Two conditions that only fail on data, among seven checks that do not."""
    return compact(Suite(RUNTIME).run(_txn(spark, sf)))


def q_gen_transactions(spark, sf):
    keys = _t(spark, sf, "orders").select("o_orderkey")
    return _wall_clock(synth.generate_transactions(keys, "o_orderkey"), "start_date", "end_date")


def q_gen_errors(spark, sf):
    """All six error kinds on generated rows with sparse keys."""
    keys = _t(spark, sf, "orders").select((F.col("o_orderkey") * SPARSE).alias("k"))
    return _wall_clock(synth.inject_transaction_errors(synth.generate_transactions(keys, "k")), "start_date", "end_date")


def q_gen_reference(spark, sf):
    keys = _t(spark, sf, "orders").select("o_orderkey")
    return _wall_clock(synth.generate_reference(synth.generate_transactions(keys, "o_orderkey")), "signup_date")


def _base(spark, sf):
    o = _t(spark, sf, "orders")
    k = F.col("o_orderkey")
    return o.select(
        k.alias("row_key"),
        F.concat(F.lit("txn_"), k.cast("string")).alias("transaction_id"),
        F.col("o_totalprice").alias("price"),
        (F.lit(1) + k % 9).cast("double").alias("quantity"),
        F.concat(F.lit("user"), k.cast("string"), F.lit("@example.com")).alias("email"),
        F.col("o_orderdate").alias("start_date"),
        (F.col("o_orderdate") + F.make_dt_interval(days=(F.lit(1) + k % 60).cast("int"))).alias("end_date"),
    )


def _sel(m: int, r: int):
    return (F.col("row_key") % m) == r


def q_inject_missing(spark, sf):
    df = synth.inject_missing(_base(spark, sf), "price", _sel(20, 3), nan=True)
    return synth.inject_missing(df, "quantity", _sel(20, 6), nan=False).select("row_key", "price", "quantity")


def q_inject_negate(spark, sf):
    return synth.inject_negate(_base(spark, sf), "price", _sel(100, 8)).select("row_key", "price")


def q_inject_format(spark, sf):
    return synth.inject_bad_format(_base(spark, sf), "email", _sel(50, 11)).select("row_key", "email")


def q_inject_duplicate(spark, sf):
    src = F.concat(F.lit("txn_"), (F.col("row_key") - 1).cast("string"))
    return synth.inject_duplicate_key(_base(spark, sf), "transaction_id", _sel(33, 32), src).select(
        "row_key", "transaction_id")


SPARSE, DUPLICATE_RATE, DUPLICATE_SEED = 7, 0.05, 3


def q_inject_duplicates(spark, sf):
    """Ids of other rows on keys 7, 14, 21, …: no key has a predecessor."""
    sparse = _base(spark, sf).withColumn("row_key", F.col("row_key") * SPARSE)
    return synth.inject_duplicates(sparse, "transaction_id", "row_key", DUPLICATE_RATE, DUPLICATE_SEED).select(
        "row_key", "transaction_id")


def q_inject_swap(spark, sf):
    return synth.inject_swap(_base(spark, sf), "start_date", "end_date", _sel(10, 4)).select(
        "row_key", "start_date", "end_date")


def q_repair_audit(spark, sf):
    return repair_audit(_dedup(spark, sf), ["price", "email", "country_code", "order_status"])


GATE = [FUSED[4], FUSED[6], FUSED[10], FUSED[13]]


GATE_KEYED = GATE + [
    _c("transaction_id_unique", "uniqueness", column="transaction_id"),
    _c("user_in_customer", "consistency", "referential_integrity", column="user_id", reference="customer", reference_column="c_custkey"),
    _c("country_in_segments", "consistency", "referential_integrity", column="country_code", reference="customer",
       reference_column="c_mktsegment", nulls_are_violations=False),
]


def q_gate_split_keyed(spark, sf):
    """Rows with the names of the checks they fail; keys of more than 3 rows count as hot."""
    accepted, quarantined = gate_split(_txn(spark, sf), GATE_KEYED, references={"customer": _t(spark, sf, "customer")}, hot_rows=3)
    return accepted.select("row_key", F.lit("").alias("failed")).unionByName(
        quarantined.select("row_key", F.array_join("failed_checks", ",").alias("failed")))


def q_gate_split(spark, sf):
    accepted, quarantined = gate_split(_txn(spark, sf), GATE)
    return accepted.select("row_key", F.lit(False).alias("quarantined")).unionByName(
        quarantined.select("row_key", F.lit(True).alias("quarantined")))


CASTS = [
    castable_check("totalprice_text_to_double", "o_totalprice_text", "double"),
    castable_check("priority_to_int", "o_orderpriority", "int", threshold=1.0),
]


def q_castability(spark, sf):
    o = _t(spark, sf, "orders").withColumn("o_totalprice_text", F.col("o_totalprice").cast("string"))
    return _suite(o, CASTS)


def q_microbatch_suite(spark, sf):
    out = run_suite_on_stream(spark, f"{sf.rstrip('/')}/orders.parquet", DATA_TYPES[:3] + [
        _c("totalprice_min_0", "validity", "range", column="o_totalprice", min_value=0.0),
        _c("custkey_not_null", "completeness", column="o_custkey"),
    ])
    return out.select("batch_id", "check_name", "status", "violations", "total_rows",
                      F.round("metric", 6).alias("metric"))


STREAM_RUNNING = [
    _c("custkey_not_null", "completeness", column="o_custkey"),
    _c("totalprice_min_100k", "validity", "range", column="o_totalprice", min_value=100000.0, threshold=0.25),
    _c("status_known", "validity", "categorical", column="o_orderstatus", allowed_values=["O", "F", "P"]),
    _c("totalprice_mean", "stats", "mean_deviation", column="o_totalprice", expected_mean=150000.0,
       max_deviation_stddevs=1.0),
    _c("orderkey_unique", "uniqueness", column="o_orderkey"),
]


def q_streaming_running_totals(spark, sf):
    out = run_running_results(spark, f"{sf.rstrip('/')}/orders.parquet", STREAM_RUNNING)
    return compact(out)


SO_FAR = STREAM_RUNNING + [
    _c("custkey_unique", "uniqueness", column="o_custkey", threshold=1.0),
    _c("custkey_in_customer", "consistency", "referential_integrity", column="o_custkey", reference_column="c_custkey"),
    _c("status_in_line_status", "consistency", "referential_integrity", column="o_orderstatus", reference_column="l_linestatus"),
]


def _so_far(spark, sf):
    return [c | {"params": c["params"] | {"reference": _t(spark, sf, r)}} if (r := {"c_custkey": "customer", "l_linestatus": "lineitem"}.get(
        c["params"].get("reference_column"))) else c for c in SO_FAR]


def q_stream_suite_so_far(spark, sf):
    """The orders as a stream of five files, one a batch, the states merged half-way and two batches delivered twice."""
    base = scratch_path(spark, "so-far")
    orders = _t(spark, sf, "orders")
    orders.repartition(5, "o_orderkey").write.parquet(f"{base}/in")
    stream = spark.readStream.schema(orders.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    query, state = check_stream_so_far(stream, _so_far(spark, sf), f"{base}/state", f"{base}/checkpoint", compact_every=3)
    query.awaitTermination()
    for batch_id in (0, 4):  # 0 is merged already, 4 replaces itself
        path = [f.path for f in _batch_files(spark, f"{base}/checkpoint", batch_id)]
        state.add(spark.read.schema(orders.schema).parquet(*path), batch_id)
    return compact(state.results())


def _batch_files(spark, checkpoint, batch_id):
    """The files a batch was made of, from the file source's own log."""
    log = spark.read.text(f"{checkpoint}/sources/0/{batch_id}").where("value LIKE '{%'")
    return log.select(F.get_json_object("value", "$.path").alias("path")).collect()


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "completeness": q_completeness,
    "uniqueness": q_uniqueness,
    "uniqueness_documents": q_uniqueness_documents,
    "duplicate_groups": q_duplicate_groups,
    "range_min": q_range_min,
    "range_max_nan": q_range_max_nan,
    "regex_email": q_regex_email,
    "regex_url": q_regex_url,
    "categorical": q_categorical,
    "categorical_role": q_categorical_role,
    "custom_condition": q_custom_condition,
    "condition_text_length": q_condition_text_length,
    "condition_joined": q_condition_joined,
    "ref_integrity": q_ref_integrity,
    "ref_integrity_docs": q_ref_integrity_docs,
    "length_fixed": q_length_fixed,
    "length_range": q_length_range,
    "date_format": q_date_format,
    "data_type": q_data_type,
    "mean_deviation": q_mean_deviation,
    "mean_deviation_inf": q_mean_deviation_inf,
    "suite_fused": q_suite_fused,
    "suite_full": q_suite_full,
    "suite_full_lazy": q_suite_full_lazy,
    "suite_full_eager": q_suite_full_eager,
    "ref_mixed_types": q_ref_mixed_types,
    "suite_error_isolation": q_suite_error_isolation,
    "clean_backup": q_clean_backup,
    "clean_clamp": q_clean_clamp,
    "clean_regex_null": q_clean_regex_null,
    "clean_whitelist": q_clean_whitelist,
    "clean_flag": q_clean_flag,
    "dedup_keep_latest": q_dedup_keep_latest,
    "dedup_all_null": q_dedup_all_null,
    "dedup_events": q_dedup_events,
    "failing_rows_range": q_failing_rows_range,
    "failing_rows_preview": q_failing_rows_preview,
    "failing_rows_ref": q_failing_rows_ref,
    "report_roundtrip": q_report_roundtrip,
    "report_entries": q_report_entries,
    "log_for_dashboard": q_log_for_dashboard,
    "reader_fallbacks": q_reader_fallbacks,
    "failing_rows_none": q_failing_rows_none,
    "clean_clamp_types": q_clean_clamp_types,
    "results_log_runs": q_results_log_runs,
    "results_log_failures": q_results_log_failures,
    "results_log_latest": q_results_log_latest,
    "results_log_table": q_results_log_table,
    "suite_runtime_isolation": q_suite_runtime_isolation,
    "gen_transactions": q_gen_transactions,
    "gen_errors": q_gen_errors,
    "gen_reference": q_gen_reference,
    "inject_missing": q_inject_missing,
    "inject_negate": q_inject_negate,
    "inject_format": q_inject_format,
    "inject_duplicate": q_inject_duplicate,
    "inject_duplicates": q_inject_duplicates,
    "inject_swap": q_inject_swap,
    "repair_audit": q_repair_audit,
    "gate_split": q_gate_split,
    "gate_split_keyed": q_gate_split_keyed,
    "castability": q_castability,
    "microbatch_suite": q_microbatch_suite,
    "streaming_running_totals": q_streaming_running_totals,
    "stream_suite_so_far": q_stream_suite_so_far,
}


def _llm_module(name: str):
    """A module of the training-data subpackage, or None where it, or a package it needs, is not installed."""
    import importlib

    try:
        return importlib.import_module(name)
    except ModuleNotFoundError as error:
        missing = error.name or ""
        if missing.startswith("veracity") and not missing.startswith("veracity.llm"):
            raise  # a fault of the library itself
        return None


_LLM, _PIPELINE = _llm_module("veracity.llm.queries"), _llm_module("corpus_pipeline")
if _LLM:
    _QUERIES |= _LLM.QUERIES
if _PIPELINE:
    _QUERIES["pipeline"] = _PIPELINE.run


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: clean + dedup + the 18-check suite on the sf0.001 fixture."""
    return q_suite_full(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


# ---------------------------------------------------------------------------
# Oracle side (DuckDB SQL)
# ---------------------------------------------------------------------------

from oracle_sql import oracle_queries  # noqa: E402


def oracle_sql() -> dict[str, str]:
    return oracle_queries() | (_LLM.ORACLES if _LLM else {})
