"""Distributed test-data synthesis and error injection.

Rows are born on the executors from an existing key column (any table's
primary key, or ``spark.range``), and every value is a pure function of the
key and a seed (``digits``: integer arithmetic that any SQL engine repeats
exactly) — no driver-side row building, no random state, and the same output
on every re-run or task retry.

Injectors work on any DataFrame.  Each takes a boolean *selector* Column
choosing the rows to corrupt; ``hash_selector(key, rate)`` picks a
reproducible fraction, and tests pass modulus selectors (``key % 20 == 3``)
so the expected counts are exact.  All injectors are single projections but
``inject_duplicates``, which gives rows the key of another row of any table.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veracity.functions.columns import col_ref, column_type, fresh_names, quote
from veracity.operators.bitmap import is_integer
from veracity.session import materialize

# The reference generator's domains and error rates.
COUNTRY_CODES = ("US", "CA", "MX", "GB", "DE", "FR", "INVALID")
ORDER_STATUSES = ("COMPLETED", "PENDING", "CANCELLED", "FAILED", "UNK")
PRICE_MIN, PRICE_MAX = 5.0, 500.0
QUANTITY_MAX = 9
PRODUCT_MIN, PRODUCT_SPAN = 100, 100
TXN_SUFFIX_MIN, TXN_SUFFIX_SPAN = 1000, 9000
START = _dt.datetime(2022, 1, 1)
START_SPAN_S = 365 * 24 * 60 * 60 - 1  # to the last second of the year
MIN_DURATION_S = 3600
MAX_DURATION_S = 60 * 60 * 24 * 60
RATE_MISSING_PRICE = 0.05
RATE_MISSING_QUANTITY = 0.05
RATE_NEGATIVE_PRICE = 0.01
RATE_BAD_EMAIL = 0.02
RATE_DUPLICATE_ID = 0.03
RATE_SWAPPED_DATES = 0.10
REFERENCE_KEEP_RATE = 0.98
REFERENCE_EXTRA_RATE = 0.005
SIGNUP_START = _dt.datetime(2021, 1, 1)
SIGNUP_SPAN_DAYS = 365 * 2 + 1

_BUCKETS = 1_000_000
RANK_BUCKETS = 4096


#: Modulus (a prime) and multipliers of the mixing rounds; every product stays within a bigint.
_PRIME = 2_147_483_647
_ROUNDS = ((48_271, 15), (69_621, 13), (16_807, 0))


def digits(key: Column, seed: int) -> Column:
    """31 well-mixed bits from an integer key and a seed: multiply modulo a prime, fold high bits onto low ones, thrice."""
    k, prime = key.cast("bigint"), F.lit(_PRIME)
    high = F.pmod(F.call_function("div", k, prime), prime)
    h = F.pmod(F.pmod(k, prime) + high * 31 + F.lit(7919 * seed), prime)
    for factor, shift in _ROUNDS:
        h = F.pmod(h * factor, prime)
        if shift:
            h = h.bitwiseXOR(F.shiftright(h, shift))
    return h


def uniform_int(key: Column, seed: int, span: int) -> Column:
    """Deterministic integer in ``[0, span)`` from an integer ``key`` (hash any other type first) and ``seed``."""
    return F.pmod(digits(key, seed), F.lit(span))


def hash_selector(key: Column, rate: float, seed: int = 42) -> Column:
    """True for a reproducible ``rate`` fraction of integer keys."""
    return uniform_int(key, seed, _BUCKETS) < F.lit(int(round(rate * _BUCKETS)))


# --- injectors -------------------------------------------------------------
#
# Each injection is first a Column expression (``*_value``): the value of a
# column after corrupting the selected rows.  Expressions compose, so a whole
# fixture can be built as one projection; the DataFrame-level injectors
# below apply one expression to one column.


def _on(selector: Column) -> Column:
    """A NULL selector selects nothing."""
    return F.coalesce(selector, F.lit(False))


def value_where(current: Column, selector: Column, value: Column) -> Column:
    return F.when(_on(selector), value).otherwise(current)


def missing_value(current: Column, selector: Column, nan: bool = True) -> Column:
    if nan:
        return F.when(_on(selector), F.lit(float("nan"))).otherwise(current)
    return F.when(~_on(selector), current)  # NULL of the column's own type


def negated_value(current: Column, selector: Column) -> Column:
    return F.when(_on(selector), -current).otherwise(current)


def bad_format_value(current: Column, selector: Column, bad: Column | None = None) -> Column:
    if bad is None:
        bad = F.concat(F.regexp_replace(current, "@.*$", ""), F.lit("_invalid-format"))
    return F.when(_on(selector), bad).otherwise(current)


def inject_value(df: DataFrame, column: str, selector: Column, value: Column) -> DataFrame:
    """Selected rows take ``value``."""
    return df.withColumn(column, value_where(col_ref(df, column), selector, value))


def inject_missing(df: DataFrame, column: str, selector: Column, nan: bool = True) -> DataFrame:
    """Selected rows become NaN (floating columns, ``nan=True``) or NULL."""
    return df.withColumn(column, missing_value(col_ref(df, column), selector, nan))


def inject_negate(df: DataFrame, column: str, selector: Column) -> DataFrame:
    """Selected rows are multiplied by −1 (NaN stays NaN, NULL stays NULL)."""
    return df.withColumn(column, negated_value(col_ref(df, column), selector))


def inject_bad_format(df: DataFrame, column: str, selector: Column, bad: Column | None = None) -> DataFrame:
    """Selected rows get a malformed value; default: e-mail local part + ``_invalid-format``."""
    return df.withColumn(column, bad_format_value(col_ref(df, column), selector, bad))


def inject_duplicate_key(df: DataFrame, column: str, selector: Column, source_key: Column) -> DataFrame:
    """Selected rows take another row's key, given as an expression of the row.

    ``source_key`` computes the key of a *different* row (e.g. the previous
    id), so sources and targets never need to meet in a join or a global
    ranking — the injection stays a projection at any scale.
    """
    return df.withColumn(column, value_where(col_ref(df, column), selector, source_key))


def _ranked(df: DataFrame, bucket: str, order: list[str], rank: str) -> DataFrame:
    """0, 1, 2, … in ``rank`` by (bucket, order): places inside buckets plus the sizes of the buckets before."""
    place = F.row_number().over(Window.partitionBy(bucket).orderBy(*order))
    sizes = df.groupBy(bucket).agg(F.count(F.lit(1)).alias(f"{rank}_size"))  # one row per bucket: a fixed number
    ahead = F.sum(f"{rank}_size").over(Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1))
    before = sizes.select(bucket, F.coalesce(ahead, F.lit(0)).alias(f"{rank}_before"))
    return df.withColumn(rank, place).join(F.broadcast(before), bucket).withColumn(
        rank, F.col(rank) - 1 + F.col(f"{rank}_before")).drop(f"{rank}_before")


def inject_duplicates(df: DataFrame, column: str, key: str, rate: float, seed: int = 0, buckets: int = RANK_BUCKETS) -> DataFrame:
    """A ``rate`` of the rows take the ``column`` of another row, whatever the keys look like.

    Targets and, disjoint from them, sources (twice as many) are picked by
    hashing ``key``; each side is ranked by (hash bucket, key), and target
    ``i`` takes the value of source ``i``.  Ranking needs no global sort: rows
    are placed inside their bucket, and the ``buckets`` sizes are added up.
    Only picked rows are written (when this is called, to the shared folder)
    and shuffled; all others pass through a projection.

    A source's value is never NULL and no source serves two targets unless
    targets outnumber sources; rows with a NULL key are never picked; without a
    source nothing changes.  ``key`` should tell rows apart: equal keys share
    a bucket.  A key that is no integer is hashed first.
    """
    k = col_ref(df, key)
    if not is_integer(column_type(df, key)):
        k = F.when(k.isNotNull(), F.xxhash64(k))
    target = _on(hash_selector(k, rate, seed))
    source = ~target & _on(hash_selector(k, 2 * rate, seed + 1)) & col_ref(df, column).isNotNull()
    bucket, role, rank, value = fresh_names(df, "__bucket", "__role", "__rank", "__value")
    picked = materialize(df.where(target | source).withColumns({bucket: uniform_int(k, seed + 2, buckets), role: target}), "picked")
    sources = picked.where(~F.col(role))
    n = sources.count()
    if not n:
        return df
    order = [quote(key), quote(column)]
    values = _ranked(sources, bucket, order, rank).select(F.col(rank), col_ref(sources, column).alias(value))
    wanted = _ranked(picked.where(role), bucket, order, rank).withColumn(rank, F.col(rank) % F.lit(n))
    changed = wanted.join(values, rank).withColumn(column, F.col(value))
    return df.where(~target).unionByName(changed.select(*[quote(c) for c in df.columns]))


def swapped_values(a: Column, b: Column, selector: Column) -> tuple[Column, Column]:
    """(new a, new b): both read from the pre-image."""
    return value_where(a, selector, b), value_where(b, selector, a)


def inject_swap(df: DataFrame, a: str, b: str, selector: Column) -> DataFrame:
    """Selected rows exchange the values of ``a`` and ``b`` (both read before writing)."""
    new_a, new_b = swapped_values(col_ref(df, a), col_ref(df, b), selector)
    return df.withColumns({a: new_a, b: new_b})


# --- generators ------------------------------------------------------------


def _pick(values: tuple[str, ...], key: Column, seed: int) -> Column:
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (uniform_int(key, seed, len(values)) + 1).cast("int"))


def _txn_id(key: Column, seed: int) -> Column:
    suffix = uniform_int(key, seed + 1, TXN_SUFFIX_SPAN) + TXN_SUFFIX_MIN
    return F.concat(F.lit("txn_"), key.cast("string"), F.lit("_"), suffix.cast("string"))


def generate_transactions(keys: DataFrame, key: str = "id", seed: int = 7) -> DataFrame:
    """Clean transaction rows, one per key (schema of the reference generator).

    ``keys`` is any DataFrame with a unique, non-NULL integer column ``key``:
    ``spark.range(n)`` for a fixed size, or a table's primary key so the
    output grows with that table.
    """
    k = col_ref(keys, key).cast("bigint")
    start = F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(
        secs=uniform_int(k, seed + 2, START_SPAN_S - MAX_DURATION_S).cast("int")
    )
    duration = uniform_int(k, seed + 3, MAX_DURATION_S - MIN_DURATION_S + 1) + MIN_DURATION_S
    cents = uniform_int(k, seed + 4, round((PRICE_MAX - PRICE_MIN) * 100) + 1) + round(PRICE_MIN * 100)
    return keys.select(
        k.alias("user_id"),
        _txn_id(k, seed).alias("transaction_id"),
        F.concat(F.lit("P"), (uniform_int(k, seed + 5, PRODUCT_SPAN) + PRODUCT_MIN).cast("string")).alias("product_id"),
        (cents / 100).alias("price"),
        (uniform_int(k, seed + 6, QUANTITY_MAX) + 1).cast("double").alias("quantity"),
        F.concat(F.lit("user"), k.cast("string"), F.lit("@example.com")).alias("email"),
        _pick(COUNTRY_CODES, k, seed + 7).alias("country_code"),
        _pick(ORDER_STATUSES, k, seed + 8).alias("order_status"),
        # The reference's data model: session-time-zone TIMESTAMP columns.
        start.cast("timestamp").alias("start_date"),
        (start + F.make_dt_interval(secs=duration.cast("int"))).cast("timestamp").alias("end_date"),
    )


def inject_transaction_errors(df: DataFrame, seed: int = 11) -> DataFrame:
    """The reference's six error kinds at its rates, selected by hashing ``user_id``, whichever ids there are."""
    k = F.col("user_id")
    df = inject_missing(df, "price", hash_selector(k, RATE_MISSING_PRICE, seed))
    df = inject_missing(df, "quantity", hash_selector(k, RATE_MISSING_QUANTITY, seed + 1))
    df = inject_negate(df, "price", hash_selector(k, RATE_NEGATIVE_PRICE, seed + 2))
    df = inject_bad_format(df, "email", hash_selector(k, RATE_BAD_EMAIL, seed + 3))
    df = inject_swap(df, "start_date", "end_date", hash_selector(k, RATE_SWAPPED_DATES, seed + 4))
    return inject_duplicates(df, "transaction_id", "user_id", RATE_DUPLICATE_ID, seed + 5)


def generate_reference(
    transactions: DataFrame,
    key: str = "user_id",
    keep_rate: float = REFERENCE_KEEP_RATE,
    extra_rate: float = REFERENCE_EXTRA_RATE,
    offset: int = 10**12,
    seed: int = 13,
    distinct: bool = True,
) -> DataFrame:
    """A users dimension with holes and extras.

    Keeps a ``keep_rate`` hash-sample of the distinct keys and adds an
    ``extra_rate`` share of ids shifted by ``offset`` (out of range by
    construction), with ``user_name`` and ``signup_date`` derived per id.
    """
    k = col_ref(transactions, key)
    ids = transactions.select(k.cast("bigint").alias("user_id")).where(F.col("user_id").isNotNull())
    if distinct:
        ids = ids.distinct()
    u = F.col("user_id")
    kept = ids.where(hash_selector(u, keep_rate, seed))
    extra = ids.where(hash_selector(u, extra_rate, seed + 1)).select((u + F.lit(offset)).alias("user_id"))
    users = kept.unionByName(extra)
    signup = F.lit(SIGNUP_START).cast("timestamp_ntz") + F.make_dt_interval(
        days=uniform_int(u, seed + 2, SIGNUP_SPAN_DAYS).cast("int")
    )
    return users.select(
        u,
        F.concat(F.lit("user_"), u.cast("string")).alias("user_name"),
        signup.cast("timestamp").alias("signup_date"),
    )
