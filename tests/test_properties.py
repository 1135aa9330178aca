"""Property tests: every check kind against a brute-force count on random small columns."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from veracity import Suite

FLOATS = st.one_of(
    st.none(),
    st.just(float("nan")),
    st.sampled_from([float("inf"), float("-inf"), 0.0, -0.0]),
    st.floats(min_value=-1000, max_value=1000, allow_nan=False, allow_infinity=False),
)
WORDS = st.one_of(st.none(), st.sampled_from(["", "a", "ab", "abc", "a@b.io", "x@y", "US", "CA", "ZZZ"]))
KEYS = st.one_of(st.none(), st.integers(min_value=0, max_value=6))

ROWS = st.lists(st.tuples(FLOATS, WORDS, KEYS), min_size=0, max_size=25)
REF = st.lists(st.one_of(st.none(), st.integers(min_value=0, max_value=6)), max_size=6)


def checks(ref_df):
    return [
        {"check_name": "nn_x", "check_type": "completeness", "params": {"column": "x"}},
        {"check_name": "nn_s", "check_type": "completeness", "params": {"column": "s"}},
        {"check_name": "range", "check_type": "validity", "sub_type": "range",
         "params": {"column": "x", "min_value": -10.0, "max_value": 10.0}},
        {"check_name": "regex", "check_type": "validity", "sub_type": "regex",
         "params": {"column": "s", "pattern": "@"}},
        {"check_name": "cat", "check_type": "validity", "sub_type": "categorical",
         "params": {"column": "s", "allowed_values": ["US", "CA", None]}},
        {"check_name": "len", "check_type": "format", "sub_type": "string_length",
         "params": {"column": "s", "min_length": 1, "max_length": 2}},
        {"check_name": "cond", "check_type": "consistency", "params": {"condition_sql": "x < 100"}},
        {"check_name": "uniq", "check_type": "uniqueness", "params": {"column": "k"}},
        {"check_name": "ri", "check_type": "consistency", "sub_type": "referential_integrity",
         "params": {"column": "k", "reference": ref_df, "reference_column": "r"}},
    ]


def nan(v):
    return isinstance(v, float) and math.isnan(v)


def brute(rows, ref):
    xs, ss, ks = [r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows]
    refs = {r for r in ref if r is not None}
    counts = {k: ks.count(k) for k in ks if k is not None}
    return {
        "nn_x": sum(x is None or nan(x) for x in xs),
        "nn_s": sum(s is None for s in ss),
        # NaN sorts above every number: it exceeds the maximum, never the minimum
        "range": sum(x is not None and (nan(x) or x < -10 or x > 10) for x in xs),
        "regex": sum(s is not None and "@" not in s for s in ss),
        "cat": sum(s is not None and s not in ("US", "CA") for s in ss),
        "len": sum(s is not None and not (1 <= len(s) <= 2) for s in ss),
        # NOT (x < 100): NULL passes; NaN < 100 is false in Spark, so NaN violates
        "cond": sum(x is not None and (nan(x) or not x < 100) for x in xs),
        "uniq": sum(n for n in counts.values() if n > 1),
        "ri": sum(k is None or k not in refs for k in ks),
    }


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS, ref=REF)
def test_checks_match_brute_force(spark, rows, ref):
    df = spark.createDataFrame(rows, "x double, s string, k int")
    ref_df = spark.createDataFrame([(r,) for r in ref], "r int")
    got = {r["check_name"]: r for r in Suite(checks(ref_df)).results(df).collect()}
    want = brute(rows, ref)
    for name, v in want.items():
        assert got[name]["violations"] == v, (name, rows, ref)
        assert got[name]["total_rows"] == len(rows), name
        expected_metric = 0.0 if not rows else v / len(rows)
        assert math.isclose(got[name]["metric"], expected_metric), name
        assert got[name]["status"] == ("PASS" if expected_metric <= 0.0 else "FAIL"), name


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(FLOATS, max_size=20), expected=st.floats(-50, 50), k=st.floats(0.01, 5))
def test_mean_deviation_matches_brute_force(spark, values, expected, k):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = Suite([{"check_name": "m", "check_type": "stats", "sub_type": "mean_deviation",
                  "params": {"column": "x", "expected_mean": expected, "max_deviation_stddevs": k}}]
                ).results(df).first()
    valid = [v for v in values if v is not None and not nan(v)]
    if not values:
        assert (got["status"], got["metric"]) == ("PASS", 0.0)
        return
    if not valid or any(math.isinf(v) for v in valid):
        assert got["status"] == "ERROR" and got["metric"] is None
        return
    mean = sum(valid) / len(valid)
    sd = math.sqrt(sum((v - mean) ** 2 for v in valid) / len(valid))
    if sd == 0 or got["metric"] is None:
        # zero spread: PASS with 0.0 when the mean is exact, else an infinite deviation
        assert got["status"] in ("PASS", "FAIL")
        if got["status"] == "PASS" and got["metric"] is not None:
            assert got["metric"] == 0.0
        return
    dev = abs(mean - expected) / sd
    assert math.isclose(got["metric"], dev, rel_tol=1e-6, abs_tol=1e-9)
    if not math.isclose(dev, k, rel_tol=1e-9):
        assert got["status"] == ("FAIL" if dev > k else "PASS")


TXN_ROWS = st.lists(
    st.tuples(
        st.one_of(st.none(), st.sampled_from(["t1", "t2", "t3"])),  # transaction_id
        st.one_of(st.none(), st.integers(min_value=0, max_value=3)),  # start day
        st.one_of(st.none(), st.integers(min_value=0, max_value=3)),  # end day
        st.one_of(st.none(), st.just(float("nan")), st.sampled_from([-5.0, 0.0, 7.5])),  # price
        st.one_of(st.none(), st.sampled_from(["a@b.io", "bad", "x@y"])),  # email
        st.one_of(st.none(), st.sampled_from(["US", "XX", "FR"])),  # country
        st.one_of(st.none(), st.sampled_from(["PENDING", "UNK"])),  # status
    ),
    max_size=15,
)


def py_clean(r):
    import datetime as dt

    txn_id, s, e, price, email, country, status = r
    day = lambda d: None if d is None else dt.datetime(2024, 1, 1) + dt.timedelta(days=d)
    start, end = day(s), day(e)
    import re as _re

    ok_email = email is not None and _re.search(r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$", email)
    return {
        "transaction_id": txn_id, "start_date": start, "end_date": end,
        "price": None if price is None else (0.0 if price < 0 else price),
        "email": email if ok_email else None,
        "country_code": None if country is None else (country if country in ("US", "FR") else "UNKNOWN"),
        "order_status": None if status is None else (status if status == "PENDING" else "UNKNOWN"),
        "dates_marked_inconsistent": bool(start is not None and end is not None and end < start),
    }


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=TXN_ROWS)
def test_clean_and_dedup_match_brute_force(spark, rows):
    import datetime as dt

    from pyspark.sql import functions as F

    from veracity.plans.flow import clean_and_dedup

    day = lambda d: None if d is None else dt.datetime(2024, 1, 1) + dt.timedelta(days=d)
    data = [(i, r[0], day(r[1]), day(r[2]), r[3], r[4], r[5], r[6]) for i, r in enumerate(rows)]
    df = spark.createDataFrame(
        data, "row_key long, transaction_id string, start_date timestamp_ntz, end_date timestamp_ntz, "
              "price double, email string, country_code string, order_status string")
    got = {r["row_key"]: r.asDict() for r in clean_and_dedup(df).collect()}

    cleaned = {i: py_clean(r) for i, r in enumerate(rows)}
    keep = {i for i, c in cleaned.items() if c["transaction_id"] is None or c["start_date"] is None}
    groups: dict = {}
    for i, c in cleaned.items():
        if i not in keep:
            groups.setdefault(c["transaction_id"], []).append(i)
    for members in groups.values():
        keep.add(max(members, key=lambda i: (cleaned[i]["start_date"], i)))  # latest start, then row_key
    assert set(got) == keep
    for i in keep:
        want, have = cleaned[i], got[i]
        for col, v in want.items():
            h = have[col]
            if isinstance(v, float) and math.isnan(v):
                assert isinstance(h, float) and math.isnan(h), col
            else:
                assert h == v, (col, h, v)
        assert (have["price_original"] is None) == (rows[i][3] is None)
