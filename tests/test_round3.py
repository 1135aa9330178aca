"""Runtime isolation, the log's ledger, and row tags for keyed checks."""

import math

import pytest
from pyspark.errors import PySparkRuntimeError
from pyspark.sql import functions as F

from veracity import Suite
from veracity.operators.checks import CheckError
from veracity.operators.extensions import FAILED_CHECKS, gate_split, tag_rows
from veracity.session import scratch_path
from veracity.sources import sinks


def c(name, kind, sub=None, **params):
    return {"check_name": name, "check_type": kind, "params": params} | ({"sub_type": sub} if sub else {})


def conditions(n, faulty):
    return [c(f"c{i}", "consistency", condition_sql=f"1 / (id - {50 if i in faulty else -50}) < 2") for i in range(n)]


@pytest.mark.parametrize("n,faulty", [(18, {7}), (18, {0, 17}), (1, {0}), (3, {0, 1, 2})])
def test_isolation_takes_few_plans(spark, monkeypatch, n, faulty):
    plans, real = [], Suite.results
    monkeypatch.setattr(Suite, "results", lambda self, df: plans.append(len(self.specs)) or real(self, df))
    got = Suite([*conditions(n, faulty), c("u", "uniqueness", column="id")]).run(spark.range(100).repartition(3)).collect()
    assert [r.check_name for r in got] == [*(f"c{i}" for i in range(n)), "u"] and [r.ordinal for r in got] == list(range(n + 1))
    assert {i for i, r in enumerate(got) if r.status == "ERROR"} == faulty
    assert all(r.total_rows == 100 and ("zero" in r.message) == (r.status == "ERROR") for r in got)
    assert len(plans) <= 2 * len(faulty) * math.ceil(math.log2(n + 1)) + 1


def test_other_failures_are_raised(spark, monkeypatch):
    class Lost:
        def collect(self):
            raise PySparkRuntimeError("ExecutorLostFailure")

    calls = []
    monkeypatch.setattr(Suite, "results", lambda self, df: calls.append(1) or Lost())
    with pytest.raises(PySparkRuntimeError):
        Suite(conditions(8, ())).run(spark.range(10))
    assert len(calls) == 1


def test_a_faulty_input_is_raised(spark):
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        Suite(conditions(4, ())).run(spark.range(10).withColumn("id", F.expr("CAST(8 / (id - 5) AS BIGINT)")))


def test_ledger(spark):
    path, suite = scratch_path(spark, "log"), Suite([c("n", "completeness", column="id"), c("u", "uniqueness", column="id")])
    put = lambda run, ts, rows: sinks.append_results_log(suite.results(spark.range(rows)), path, run, ts)
    put("a", "2024-01-01 23:59:59", 3)
    put("b", "2024-01-02 00:00:00", 4)
    put("a", "2024-01-02 00:00:01", 5)  # the same run, repeated after midnight
    log = sinks.read_results_log(spark, path)
    assert log.columns == sinks.LOG_SCHEMA.fieldNames()
    assert sorted((r.run_id, r.total_rows, str(r.run_date)) for r in log.collect()) == [("a", 5, "2024-01-02")] * 2 + [("b", 4, "2024-01-02")] * 2
    lost = suite.results(spark.range(9))  # a writer that never got to its line in the ledger
    sinks.with_run_columns(lost, "b", "2024-01-03 00:00:00").withColumns(
        {"run_date": F.to_date("run_ts"), "attempt": F.lit("lost")}).write.mode("append").partitionBy("run_date").parquet(f"{path}/rows")
    assert sinks.read_results_log(spark, path).where("total_rows = 9").count() == 0 and sinks.read_results_log(spark, path).count() == 4


ROWS = [(1, "a", 1.0, 1), (2, "a", -0.0, None), (None, None, 0.0, 3), (4, "b" * 60, float("nan"), 4), (5, "b" * 60, float("nan"), 5),
        (None, "~1", None, 6), (7, "c", 2.0, 7), (7, "", 3.0, 8), (7, "", 4.0, 9), (7, "x", 4.0, 10)]
SCHEMA = "k long, t string, d double, __failed_0 int"
GATE = [c("u_d", "uniqueness", column="d"), c("small", "validity", "range", column="k", max_value=6), c("u_k", "uniqueness", column="k"),
        c("r_k", "consistency", "referential_integrity", column="k", reference="r", reference_column="k"),
        c("r_t", "consistency", "referential_integrity", column="t", reference="r", reference_column="t", nulls_are_violations=False)]


@pytest.mark.parametrize("hot_rows", [1, 2, 100])
def test_tags(spark, hot_rows):
    df, ref = spark.createDataFrame(ROWS, SCHEMA), spark.createDataFrame([(1, "a"), (7, "b" * 60), (None, "")], "k long, t string")
    out = tag_rows(df, GATE, references={"r": ref}, hot_rows=hot_rows)
    assert out.columns == [*df.columns, FAILED_CHECKS]
    got = sorted((str(r[:4]), r[4]) for r in out.collect())
    values = [["z" if r[2] in (0.0, -0.0) and r[2] is not None else str(r[2]) for r in ROWS], [r[0] for r in ROWS]]
    want = []
    for k, t, d, x in ROWS:
        fails = []
        if d is not None and values[0].count("z" if d == 0 else str(d)) > 1:
            fails.append("u_d")
        if k is not None and k > 6:
            fails.append("small")
        if k is not None and values[1].count(k) > 1:
            fails.append("u_k")
        if k not in (1, 7):
            fails.append("r_k")
        if t is not None and t not in ("a", "b" * 60, ""):
            fails.append("r_t")
        want.append((str((k, t, d, x)), fails))
    assert got == sorted(want)
    accepted, quarantined = gate_split(df, GATE, references={"r": ref}, hot_rows=hot_rows)
    assert accepted.columns == df.columns and quarantined.columns == out.columns
    assert accepted.count() == sum(not f for _, f in want) and quarantined.count() == sum(bool(f) for _, f in want)


def test_tags_of_an_empty_table_and_unfit_checks(spark):
    df, ref = spark.createDataFrame([], SCHEMA), spark.createDataFrame([(1, "a")], "k long, t string")
    assert tag_rows(df, GATE, references={"r": ref}).count() == 0
    for check in (c("s", "format", "data_type", column="k", expected_spark_type_str="bigint"),
                  c("m", "stats", "mean_deviation", column="k", expected_mean=1, max_deviation_stddevs=1)):
        with pytest.raises(CheckError):
            gate_split(df, [check])
    with pytest.raises(ValueError):
        tag_rows(df.withColumn(FAILED_CHECKS, F.lit(1)), GATE[:1])
