"""Generators and injectors: invariants and recovered error rates (property style)."""

from conftest import rows_by_name
from pyspark.sql import functions as F

from veracity import Suite
from veracity.operators import synth
from veracity.plans.flow import clean_and_dedup, standard_suite

N = 200_000


def frac(df, cond):
    return df.where(cond).count() / df.count()


def test_hash_selector_rate(spark):
    df = spark.range(N)
    for rate in (0.01, 0.05, 0.10):
        assert abs(frac(df, synth.hash_selector(F.col("id"), rate, seed=3)) - rate) < 0.003


def test_generated_domains(spark):
    t = synth.generate_transactions(spark.range(1, N + 1), "id")
    agg = t.agg(
        F.min("price"), F.max("price"), F.min("quantity"), F.max("quantity"),
        F.count_distinct("transaction_id"), F.count_if(F.col("end_date") <= F.col("start_date")),
        F.min(F.expr("timestampdiff(SECOND, start_date, end_date)")),
        F.max(F.expr("timestampdiff(SECOND, start_date, end_date)")),
        F.min("start_date"), F.max("end_date"),
    ).first()
    assert 5.0 <= agg[0] and agg[1] <= 500.0
    assert agg[2] == 1.0 and agg[3] == 9.0
    assert agg[4] == N
    assert agg[5] == 0
    assert agg[6] >= 3600 and agg[7] <= 60 * 86400
    assert agg[8].year == 2022 and agg[9].year == 2022
    codes = {r[0] for r in t.select("country_code").distinct().collect()}
    assert codes == set(synth.COUNTRY_CODES)
    statuses = {r[0] for r in t.select("order_status").distinct().collect()}
    assert statuses == set(synth.ORDER_STATUSES)


def test_injected_rates_are_recovered(spark):
    t = synth.inject_transaction_errors(synth.generate_transactions(spark.range(1, N + 1), "id"))
    users = synth.generate_reference(t.select("user_id"), distinct=False)
    res = rows_by_name(Suite([
        {"check_name": "nan_price", "check_type": "completeness", "params": {"column": "price"}},
        {"check_name": "nan_qty", "check_type": "completeness", "params": {"column": "quantity"}},
        {"check_name": "neg", "check_type": "validity", "sub_type": "range",
         "params": {"column": "price", "min_value": 0}},
        {"check_name": "swap", "check_type": "consistency", "params": {"condition_sql": "end_date >= start_date"}},
        {"check_name": "email", "check_type": "validity", "sub_type": "regex",
         "params": {"column": "email", "pattern": "@"}},
        {"check_name": "ri", "check_type": "consistency", "sub_type": "referential_integrity",
         "params": {"column": "user_id", "reference": users}},
    ]).results(t))
    for name, rate in (("nan_price", 0.05), ("nan_qty", 0.05), ("swap", 0.10), ("email", 0.02), ("ri", 0.02)):
        assert abs(res[name]["metric"] - rate) < 0.004, name
    assert abs(res["neg"]["metric"] - 0.0095) < 0.003  # 1 % negated, NaN stays NaN
    dup_rows = Suite([{"check_name": "u", "check_type": "uniqueness", "params": {"column": "transaction_id"}}]
                     ).results(t).first()["violations"]
    assert abs(dup_rows / N - 0.06) < 0.004  # each duplicated id is held by exactly a target and its source
    groups = t.groupBy("transaction_id").count()
    assert groups.where("count > 2").count() == 0  # sources and targets are disjoint
    extra = users.where(F.col("user_id") > 10**12).count()
    assert abs(extra / N - 0.005) < 0.002


def test_reference_pipeline_on_generated_data(spark):
    t = synth.inject_transaction_errors(synth.generate_transactions(spark.range(1, 50_001), "id"))
    users = synth.generate_reference(t.select("user_id"), distinct=False)
    res = Suite(standard_suite(users)).results(clean_and_dedup(t, tiebreak="user_id")).collect()
    status = {r["check_name"]: r["status"] for r in res}
    # the reference's published outcome: every check passes on cleaned data
    assert all(s == "PASS" for s in status.values()), status


def test_duplicates_on_sparse_keys(spark):
    """Every key is even, so no row has a predecessor; the former injector found no source for any of them."""
    t = synth.generate_transactions(spark.range(0, 2 * N, 2), "id")
    out = synth.inject_duplicates(t, "transaction_id", "user_id", 0.03)
    assert out.columns == t.columns and out.count() == N
    changed = out.alias("o").join(t.alias("t"), "user_id").where("o.transaction_id <> t.transaction_id").select(
        "user_id", F.col("o.transaction_id").alias("now"))
    assert abs(changed.count() / N - 0.03) < 0.002
    sources = changed.join(t.withColumnRenamed("user_id", "source"), F.col("now") == F.col("transaction_id"))
    assert sources.count() == changed.count() == sources.select("source").distinct().count()
    assert sources.join(changed.select(F.col("user_id").alias("source")), "source").count() == 0  # disjoint from the targets


def test_duplicates_at_the_edges(spark):
    rows = [(None, "n", 1000), (None, None, 1001)] + [(f"k{i % 50}", f"v{i}" if i % 3 else None, i) for i in range(200)]
    df = spark.createDataFrame(rows, "`my key` string, v string, `__rank` int")
    out = synth.inject_duplicates(df, "v", "my key", 0.3, seed=1)
    assert out.columns == df.columns and out.count() == len(rows)
    after = {r["__rank"]: r["v"] for r in out.collect()}
    assert sorted(after) == sorted(r[2] for r in rows) and after[1000] == "n" and after[1001] is None
    assert {v for v in after.values() if v} <= {r[1] for r in rows}
    assert any(after[r[2]] != r[1] for r in rows)
    assert synth.inject_duplicates(df.limit(0), "v", "my key", 0.3).count() == 0
    assert synth.inject_duplicates(df.withColumn("v", F.lit(None).cast("string")), "v", "my key", 0.3).where("v IS NOT NULL").count() == 0


def test_digits_of_extreme_keys(spark):
    keys = spark.createDataFrame([(-(2**63),), (2**63 - 1,), (0,), (-1,), (None,)], "k long")
    got = [r[0] for r in keys.select(synth.uniform_int(F.col("k"), 5, 1000)).collect()]
    assert got[-1] is None and all(0 <= g < 1000 for g in got[:-1])


def test_modulus_injectors_exact(spark):
    df = spark.range(1, 1001).select(F.col("id").alias("k"), F.col("id").cast("double").alias("x"),
                                     F.lit("a@b.io").alias("e"), F.col("id").alias("s"), (F.col("id") + 1).alias("t"))
    sel = (F.col("k") % 20) == 3
    assert synth.inject_missing(df, "x", sel).where(F.isnan("x")).count() == 50
    assert synth.inject_missing(df, "x", sel, nan=False).where(F.col("x").isNull()).count() == 50
    assert synth.inject_negate(df, "x", sel).where(F.col("x") < 0).count() == 50
    assert synth.inject_bad_format(df, "e", sel).where(~F.col("e").contains("@")).count() == 50
    swapped = synth.inject_swap(df, "s", "t", sel)
    assert swapped.where(F.col("t") < F.col("s")).count() == 50
    dup = synth.inject_duplicate_key(df, "k", sel, F.col("k") - 1)
    assert dup.groupBy("k").count().where("count > 1").count() == 50
