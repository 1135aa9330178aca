"""Physical-plan shape: one scan per fused suite, pruning, pushdown, pre-aggregation, group limit."""

import contextlib
import io
import re

from conftest import SF01
from pyspark.sql import functions as F

from veracity import Suite, failing_rows
from veracity.operators.dedup import keep_latest
from veracity.session import materialize as real


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def c(name, t, sub=None, **p):
    d = {"check_name": name, "check_type": t, "params": p}
    if sub:
        d["sub_type"] = sub
    return d


def test_fused_suite_is_one_scan_with_pruning(spark):
    orders = spark.read.parquet(f"{SF01}/orders.parquet")
    res = Suite([
        c("a", "completeness", column="o_custkey"),
        c("b", "validity", "range", column="o_totalprice", min_value=0),
        c("c", "validity", "categorical", column="o_orderstatus", allowed_values=["O", "F", "P"]),
        c("d", "consistency", condition_sql="o_totalprice > 0"),
        c("e", "stats", "mean_deviation", column="o_totalprice", expected_mean=1, max_deviation_stddevs=1),
        c("f", "format", "data_type", column="o_orderkey", expected_spark_type_str="bigint"),
    ]).results(orders)
    text = plan(res)
    tree = text.split("\n\n")[0]
    assert tree.count("Scan parquet") == 1
    read = re.search(r"ReadSchema: (struct<[^>]*>)", text).group(1)
    assert "o_orderdate" not in read and "o_orderpriority" not in read and "o_orderkey" not in read
    assert "Generate" in tree  # unpivot of the single aggregate row
    assert tree.count("Exchange") == 1  # the one-row partial → final exchange


def test_uniqueness_is_partial_aggregate(spark):
    li = spark.read.parquet(f"{SF01}/lineitem.parquet")
    text = plan(Suite([c("u", "uniqueness", column="l_orderkey")]).results(li))
    tree = [ln.strip(" +-:") for ln in text.split("\n\n")[0].splitlines()]
    scan = next(i for i, ln in enumerate(tree) if ln.startswith("Scan parquet"))
    above = [ln for ln in reversed(tree[:scan]) if not ln.startswith(("Project", "Filter", "ColumnarToRow"))]
    assert above[0].startswith("HashAggregate")  # partial aggregate right above the scan
    assert above[1].startswith("Exchange")
    assert "ReadSchema: struct<l_orderkey:bigint>" in text


def test_unique_and_referential_on_one_column_share_a_shuffle(spark):
    orders = spark.read.parquet(f"{SF01}/orders.parquet")
    cust = spark.read.parquet(f"{SF01}/customer.parquet")
    text = plan(Suite([
        c("u", "uniqueness", column="o_custkey"),
        c("ri", "consistency", "referential_integrity", column="o_custkey", reference=cust,
          reference_column="c_custkey"),
        c("ri2", "consistency", "referential_integrity", column="o_custkey", reference=cust,
          reference_column="c_custkey", nulls_are_violations=False),
    ]).results(orders))
    tree = text.split("\n\n")[0]
    assert tree.count("Scan parquet") == 2  # the checked column once, the reference once
    assert tree.count("Exchange") == 2  # one key co-group, one single-row total


def test_referential_count_needs_no_shuffle_of_present_keys(spark):
    """An integer reference is a bitmap in the plan: the checked rows meet it in a broadcast join and only orphans go on."""
    orders = spark.read.parquet(f"{SF01}/orders.parquet")
    cust = spark.read.parquet(f"{SF01}/customer.parquet")
    text = plan(Suite([c("ri", "consistency", "referential_integrity", column="o_custkey",
                         reference=cust, reference_column="c_custkey")]).results(orders))
    tree = text.split("\n\n")[0]
    assert tree.count("Scan parquet") == 1 and "ReadSchema: struct<o_custkey:bigint>" in text
    assert tree.count("BroadcastHashJoin LeftOuter") == 1 and "SortMergeJoin" not in tree
    exchanges = [ln for ln in tree.splitlines() if "Exchange" in ln and "Broadcast" not in ln]
    assert len(exchanges) == 2  # one of pre-aggregated orphans, one of the single-row total


def test_referential_count_on_text_is_a_cogroup_not_a_join(spark):
    orders = spark.read.parquet(f"{SF01}/orders.parquet")
    text = plan(Suite([c("ri", "consistency", "referential_integrity", column="o_orderpriority",
                         reference=orders, reference_column="o_orderstatus")]).results(orders))
    tree = [ln.strip(" +-:") for ln in text.split("\n\n")[0].splitlines()]
    assert not any("Join" in ln for ln in tree)
    union = next(i for i, ln in enumerate(tree) if ln.startswith("Union"))
    assert tree[union - 1].startswith("HashAggregate")  # partial aggregate over both sides' keys
    assert tree[union - 2].startswith("Exchange")
    assert sum(ln.startswith("Exchange") for ln in tree) == 2  # key co-group + the one-row total


def test_all_keyed_columns_share_one_read_and_one_shuffle(spark):
    orders = spark.read.parquet(f"{SF01}/orders.parquet")
    res = Suite([c("a", "uniqueness", column="o_orderkey"), c("b", "uniqueness", column="o_custkey"),
                 c("d", "uniqueness", column="o_orderdate"), c("e", "uniqueness", column="o_orderpriority")]).results(orders)
    tree = plan(res).split("\n\n")[0]
    assert tree.count("Scan parquet") == 1 and tree.count("Exchange") == 2


def test_long_text_stays_out_of_the_exchange(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    text = plan(Suite([c("u", "uniqueness", column="text")]).results(docs))
    assert "sha2" in text and not re.search(r"Exchange\nInput \[\d+\]: \[[^\]]*\btext#", text)


def test_standard_suite_deduplicates_once(spark, txn, monkeypatch):
    """The flagship: one dedup shuffle and two raw scans in the write, then two scans of the written table."""
    import __spark_entry__ as E
    from veracity.plans import flow

    written = []
    monkeypatch.setattr(flow, "materialize", lambda df, *a: written.append(plan(df).split("\n\n")[0]) or real(df, *a))
    results = plan(flow.check_transactions(txn, E._full_suite(SF01))).split("\n\n")[0]
    assert len(written) == 1 and written[0].count("Scan parquet") == 2 and written[0].count("Exchange") == 1
    assert results.count("Scan parquet") == 3 and "Window" not in results  # fused, keyed, and the reference's keys


def test_keep_latest_trims_before_shuffle(spark):
    events = spark.read.parquet(f"{SF01}/events.parquet")
    text = plan(keep_latest(events, "user_id", "ts", "event_id"))
    tree = text.split("\n\n")[0]
    partial = [i for i, ln in enumerate(tree.splitlines()) if "WindowGroupLimit" in ln]
    exchange = [i for i, ln in enumerate(tree.splitlines()) if "Exchange" in ln]
    assert len(partial) == 2 and partial[0] < exchange[0] < partial[1]
    assert "Partial" in text and "Final" in text


def test_failing_rows_pushdown(spark):
    cust = spark.read.parquet(f"{SF01}/customer.parquet")
    text = plan(failing_rows(cust, c("r", "validity", "range", column="c_acctbal", min_value=0)))
    assert "PushedFilters: [IsNotNull(c_acctbal), LessThan(c_acctbal,0.0)]" in text
    assert "Exchange" not in text


def test_cleaning_is_one_projection(spark, txn):
    from veracity.operators.clean import clean_transactions

    text = plan(clean_transactions(txn).where(F.col("dates_marked_inconsistent")))
    assert "Exchange" not in text and "Window" not in text


def test_orphan_rows_of_an_integer_key_are_not_shuffled(spark):
    orders = spark.read.parquet(f"{SF01}/orders.parquet")
    cust = spark.read.parquet(f"{SF01}/customer.parquet")
    rows = failing_rows(orders, c("ri", "consistency", "referential_integrity", column="o_custkey",
                                  reference=cust, reference_column="c_custkey"))
    tree = plan(rows).split("\n\n")[0]
    assert rows.columns == orders.columns
    assert tree.count("Scan parquet") == 1 and "BroadcastHashJoin" in tree
    assert not any("Exchange" in ln and "Broadcast" not in ln for ln in tree.splitlines())


def test_orphan_rows_are_a_left_anti_join_with_null_bypass(spark):
    orders = spark.read.parquet(f"{SF01}/orders.parquet")
    rows = failing_rows(orders, c("ri", "consistency", "referential_integrity", column="o_orderpriority",
                                  reference=orders, reference_column="o_orderstatus"))
    text = plan(rows)
    tree = text.split("\n\n")[0]
    assert "LeftAnti" in tree
    assert "Union" in tree  # NULL-key rows come from a filter, outside the join
    assert "IsNull(o_orderpriority)" in text and "IsNotNull(o_orderpriority)" in text  # both pushed to the scans
