"""End-to-end flow: read → clean → keep-latest dedup → suite → results.

``standard_suite`` is the reference's 18-check suite (same names, kinds and
thresholds); ``check_transactions`` cleans and deduplicates once, into a table
in the shared folder, and runs the suite on that.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from veracity.operators.clean import ALLOWED_COUNTRIES, ALLOWED_STATUSES, EMAIL_PATTERN, UNKNOWN, clean_transactions
from veracity.operators.dedup import dedup_transactions
from veracity.plans.suite import Suite
from veracity.session import materialize


def standard_suite(
    reference: DataFrame | str,
    *,
    reference_column: str = "user_id",
    expected_mean: float = 255.0,
    start_date_type: str | Sequence[str] = "timestamp",
    email_pattern: str = EMAIL_PATTERN,
) -> list[dict]:
    """The reference's 18 checks (7 categories); ``reference`` is a DataFrame, table or Parquet path."""
    ref_param = {"reference": reference} if isinstance(reference, DataFrame) else {"reference_data_path": reference}
    # Check names, kinds and thresholds of the reference suite.
    return [
        {"check_name": "check_user_id_not_null", "check_type": "completeness",
         "params": {"column": "user_id", "threshold": 0.0}},
        {"check_name": "check_price_not_null", "check_type": "completeness",
         "params": {"column": "price", "threshold": 0.06}},
        {"check_name": "check_quantity_not_null", "check_type": "completeness",
         "params": {"column": "quantity", "threshold": 0.06}},
        {"check_name": "check_user_id_unique", "check_type": "uniqueness",
         "params": {"column": "user_id", "threshold": 0.0}},
        {"check_name": "check_transaction_id_unique_post_dedupe", "check_type": "uniqueness",
         "params": {"column": "transaction_id", "threshold": 0.001}},
        {"check_name": "check_price_range_post_clean", "check_type": "validity", "sub_type": "range",
         "params": {"column": "price", "min_value": 0.0, "threshold": 0.001}},
        {"check_name": "check_email_format_post_clean", "check_type": "validity", "sub_type": "regex",
         "params": {"column": "email", "pattern": email_pattern, "threshold": 0.001}},
        {"check_name": "check_country_code_values_post_clean", "check_type": "validity", "sub_type": "categorical",
         "params": {"column": "country_code", "allowed_values": [*ALLOWED_COUNTRIES, UNKNOWN], "threshold": 0.001}},
        {"check_name": "check_order_status_values_post_clean", "check_type": "validity", "sub_type": "categorical",
         "params": {"column": "order_status", "allowed_values": [*ALLOWED_STATUSES, UNKNOWN], "threshold": 0.001}},
        {"check_name": "check_end_date_after_start_date_final", "check_type": "consistency",
         "params": {"condition_sql": "end_date >= start_date", "threshold": 0.12}},
        {"check_name": "check_product_id_length", "check_type": "format", "sub_type": "string_length",
         "params": {"column": "product_id", "fixed_length": 4, "threshold": 0.01}},
        {"check_name": "check_country_code_length_post_clean", "check_type": "format", "sub_type": "string_length",
         "params": {"column": "country_code", "min_length": 2, "max_length": 7, "threshold": 0.001}},
        {"check_name": "check_user_id_data_type", "check_type": "format", "sub_type": "data_type",
         "params": {"column": "user_id", "expected_spark_type_str": "bigint", "threshold": 0.0}},
        {"check_name": "check_price_data_type_post_clean", "check_type": "format", "sub_type": "data_type",
         "params": {"column": "price", "expected_spark_type_str": "double", "threshold": 0.0}},
        {"check_name": "check_start_date_data_type", "check_type": "format", "sub_type": "data_type",
         "params": {"column": "start_date", "expected_spark_type_str": start_date_type, "threshold": 0.0}},
        {"check_name": "check_dates_marked_inconsistent_data_type", "check_type": "format", "sub_type": "data_type",
         "params": {"column": "dates_marked_inconsistent", "expected_spark_type_str": "boolean", "threshold": 0.0}},
        {"check_name": "check_price_mean_deviation", "check_type": "stats", "sub_type": "mean_deviation",
         "params": {"column": "price", "expected_mean": expected_mean, "max_deviation_stddevs": 3.0}},
        {"check_name": "check_user_id_exists_in_users_ref", "check_type": "consistency",
         "sub_type": "referential_integrity",
         "params": {"column": "user_id", **ref_param, "reference_column": reference_column, "threshold": 0.03}},
    ]


def clean_and_dedup(raw: DataFrame, tiebreak: str | Sequence[str] = "row_key", email_pattern: str = EMAIL_PATTERN) -> DataFrame:
    return dedup_transactions(clean_transactions(raw, email_pattern), tiebreak)


def check_transactions(
    raw: DataFrame,
    checks: Sequence[dict],
    *,
    tiebreak: str | Sequence[str] = "row_key",
    eager: bool = False,
    share: bool = True,
    materialize_path: str | None = None,
) -> DataFrame:
    """Clean, dedup and check ``raw``.

    The cleaned, deduplicated table is written once (to ``materialize_path`` or
    the shared folder) when this is called, so the dedup shuffle runs once for
    all branches of the suite; the results over it are lazy.  ``eager=True``
    runs the suite too, isolating runtime failures per check, and deletes a
    table written to the shared folder.  ``share=False`` writes nothing: one
    lazy plan, in which every branch cleans and deduplicates for itself.
    """
    cleaned = clean_and_dedup(raw, tiebreak)
    suite = Suite(checks)
    if eager:
        return suite.run(cleaned, materialize_input=True, materialize_path=materialize_path)
    if share:
        cleaned = materialize(cleaned, "cleaned", materialize_path)
    return suite.results(cleaned)
