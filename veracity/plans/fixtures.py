"""The deterministic dirty transactions fixture, derived from ``orders``.

Base columns follow the reference's transaction schema; errors are injected
with the library's own injection expressions using *modulus* selectors on the
order key, so every count is exact and a SQL engine can reproduce the table.
It is one projection over ``orders`` — it grows with the table and never
shuffles.

Where two injections touch one column the outer expression wins, so the
rarer override (NULL) wraps the other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veracity.operators import synth

# Fixture domains.
FIXTURE_COUNTRIES = ("US", "CA", "MX", "GB", "DE", "FR", "INVALID")
FIXTURE_STATUSES = ("COMPLETED", "PENDING", "CANCELLED", "FAILED", "UNK")
ORPHAN_OFFSET = 1_000_000
GOOD_DATE_TEXT = "2024-01-05"


def _mod(k, m: int, r: int):
    return (k % F.lit(m)) == F.lit(r)


def transactions_from_orders(orders: DataFrame) -> DataFrame:
    """One projection over ``orders``: base columns with the injections composed in."""
    k = F.col("o_orderkey")
    date = F.col("o_orderdate")
    later = date + F.make_dt_interval(days=(F.lit(1) + k % 60).cast("int"))
    start, end = synth.swapped_values(date, later, _mod(k, 10, 4))
    user = synth.value_where(F.col("o_custkey"), _mod(k, 50, 9), F.col("o_custkey") + ORPHAN_OFFSET)
    txn_id = synth.value_where(
        F.concat(F.lit("txn_"), k.cast("string")), _mod(k, 33, 32), F.concat(F.lit("txn_"), (k - 1).cast("string"))
    )
    date_text = synth.value_where(F.lit(GOOD_DATE_TEXT), _mod(k, 40, 1), F.lit("2024/01/05"))
    date_text = synth.value_where(date_text, _mod(k, 40, 2), F.lit("2024-02-30"))
    return orders.select(
        synth.missing_value(user, _mod(k, 1000, 13), nan=False).alias("user_id"),
        synth.missing_value(txn_id, _mod(k, 500, 7), nan=False).alias("transaction_id"),
        k.alias("row_key"),
        synth.bad_format_value(
            F.concat(F.lit("P"), (F.lit(100) + k % 100).cast("string")), _mod(k, 200, 5), F.lit("P9")
        ).alias("product_id"),
        synth.missing_value(synth.negated_value(F.col("o_totalprice"), _mod(k, 100, 8)), _mod(k, 20, 3)).alias(
            "price"
        ),
        synth.missing_value((F.lit(1) + k % 9).cast("double"), _mod(k, 20, 6), nan=False).alias("quantity"),
        synth.bad_format_value(F.concat(F.lit("user"), k.cast("string"), F.lit("@example.com")), _mod(k, 50, 11)).alias(
            "email"
        ),
        F.element_at(F.array(*[F.lit(v) for v in FIXTURE_COUNTRIES]), (k % 7 + 1).cast("int")).alias("country_code"),
        F.element_at(F.array(*[F.lit(v) for v in FIXTURE_STATUSES]), (k % 5 + 1).cast("int")).alias("order_status"),
        synth.missing_value(start, _mod(k, 300, 17), nan=False).alias("start_date"),
        end.alias("end_date"),
        synth.missing_value(date_text, _mod(k, 40, 3), nan=False).alias("date_text"),
    )
