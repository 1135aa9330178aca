"""The suite over a whole stream: mergeable states equal one pass, batches come again, generations merge."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from veracity import Suite
from veracity.operators.fused import fused_results_of_state, fused_state, merged_fused_state
from veracity.plans.suite import fused_only
from veracity.session import list_folder, scratch_path
from veracity.streaming.state import SuiteState

REF = [(1,), (2,), (None,)]


def checks(ref):
    def c(name, kind, sub=None, **params):
        return {"check_name": name, "check_type": kind, "params": params} | ({"sub_type": sub} if sub else {})

    return [c("nn", "completeness", column="x"), c("min", "validity", "range", column="x", min_value=0), c("u_k", "uniqueness", column="k"),
            c("u_t", "uniqueness", column="t"), c("mean", "stats", "mean_deviation", column="x", expected_mean=3.0, max_deviation_stddevs=1.0),
            c("ri", "consistency", "referential_integrity", column="k", reference=ref, reference_column="r"), c("type", "format", "data_type",
            column="k", expected_spark_type_str="bigint"), c("bad", "validity", "regex", column="gone", pattern="x"),
            c("u_a", "uniqueness", column="a")]


SCHEMA = "k long, t string, x double, a array<int>"
BATCHES = [[(1, "a", 1.0, [1]), (1, None, float("nan"), None), (None, "b" * 50, -2.0, [1])], [], [(2, "a", None, [2])],
           [(3, "b" * 50, 7.5, [3]), (1, "c", 1e9, [4]), (None, "d", 0.0, None)], [(9, None, None, None)]]


def facts(results, skip=()):
    return {r.check_name: (r.status, r.violations, r.total_rows, r.metric and round(r.metric, 9), r.message, r.details if "mean" not in r.check_name else "")
            for r in results.collect() if r.check_name not in skip}


@pytest.fixture(scope="module")
def ref(spark):
    return spark.createDataFrame(REF, "r long")


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("every", [100, 2])
def test_state_equals_one_pass(spark, ref, every):
    state = SuiteState(spark, checks(ref), frame(spark, []), scratch_path(spark, "state"), compact_every=every)
    with pytest.raises(LookupError):
        state.results()
    sofar = []
    for i, rows in enumerate(BATCHES):
        state.add(frame(spark, rows), i)
        sofar += rows
        if i in (1, 4):
            want = facts(Suite(checks(ref)).results(frame(spark, sofar)), {"u_a"})
            got = facts(state.results())
            assert got.pop("u_a")[0] == "ERROR" and got == want
            state.add(frame(spark, rows), i)  # delivered again
            assert facts(state.results(), {"u_a"}) == want
    assert (state.generation > 0) == (every == 2)
    again = SuiteState(spark, checks(ref), frame(spark, []), state.path, compact_every=every)  # a new driver
    again.add(frame(spark, BATCHES[0]), 0)
    assert facts(again.results(), {"u_a"}) == facts(Suite(checks(ref)).results(frame(spark, sofar)), {"u_a"})


def test_a_batch_counts_once_it_is_committed(spark, ref):
    state = SuiteState(spark, checks(ref), frame(spark, []), scratch_path(spark, "state"))
    state.add(frame(spark, BATCHES[0]), 0)
    before = facts(state.results())
    keys = spark.createDataFrame([(0, 77, None, 5)], "__column int, __number long, __text string, __rows long")
    keys.write.parquet(f"{state.path}/gen=0/keys/batch_id=1")  # the driver was lost before the counts
    keys.write.parquet(f"{state.path}/gen=1/keys/batch_id=1")  # and here while merging
    assert facts(state.results()) == before
    again = SuiteState(spark, checks(ref), frame(spark, []), state.path)
    assert again.generation == 0 and facts(again.results()) == before
    again.add(frame(spark, BATCHES[3]), 1)
    again.compact()
    assert list_folder(spark, state.path) == ["gen=1"]
    assert facts(again.results(), {"u_a"}) == facts(Suite(checks(ref)).results(frame(spark, BATCHES[0] + BATCHES[3])), {"u_a"})


def test_moments_merge(spark):
    df = spark.range(10_000).select(F.when(F.col("id") % 7 > 0, 1e6 + F.sin("id")).alias("x"), (F.col("id") % 13).alias("part"))
    suite = Suite([{"check_name": "m", "check_type": "stats", "sub_type": "mean_deviation",
                    "params": {"column": "x", "expected_mean": 1e6 + 0.5, "max_deviation_stddevs": 2.0}}])
    items = fused_only(suite.compile(df))
    states = None
    for p in range(13):
        one = fused_state(df.where(F.col("part") == p), items).withColumn("o", F.lit(p))
        states = one if states is None else states.unionByName(one)
    got = fused_results_of_state(merged_fused_state(states, items, "o"), items).first()
    want = suite.results(df).first()
    assert abs(got.metric - want.metric) < 1e-9 and got.status == want.status and got.total_rows == want.total_rows == 10_000


def test_stream_in_batches(spark):
    import __spark_entry__ as E
    from conftest import SF001

    got = {r.check_name: r for r in E.q_stream_suite_so_far(spark, SF001).collect()}
    assert len(got) == len(E.SO_FAR) and all(r.status != "ERROR" for r in got.values())
