"""Result-row expressions.

Each check ends as one row of the results DataFrame.  The helpers here build
that row as a SQL ``named_struct`` over already-aggregated values (a
violation count, a total, statistics), so status, metric, message and
details are computed by Spark next to the aggregate — nothing is pulled to
the driver to format a message.

The rows are rendered as SQL text and handed to ``selectExpr`` in one call:
building the same trees from Column objects costs hundreds of driver↔JVM
round trips per check, which dominated small runs.  User-supplied text
(names, patterns, SQL conditions) is embedded as a hex-decoded literal, so no
quoting rule or parser setting can change its meaning.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import types as T

from veracity.spec import CheckSpec

PASS, FAIL, ERROR = "PASS", "FAIL", "ERROR"

RESULT_SCHEMA = T.StructType(
    [
        T.StructField("check_name", T.StringType()),
        T.StructField("check_type", T.StringType()),
        T.StructField("sub_type", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("metric", T.DoubleType()),
        T.StructField("violations", T.LongType()),
        T.StructField("total_rows", T.LongType()),
        T.StructField("threshold", T.DoubleType()),
        T.StructField("message", T.StringType()),
        T.StructField("parameters", T.StringType()),
        T.StructField("details", T.StringType()),
    ]
)
RESULT_COLUMNS = [f.name for f in RESULT_SCHEMA.fields]
ORDINAL = "ordinal"
# Results as returned by a suite: the schema above plus the suite position.
RESULTS_SCHEMA = T.StructType(RESULT_SCHEMA.fields + [T.StructField(ORDINAL, T.IntegerType())])

_SAFE = set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 _-.,:;()[]=<>/|+*!?#@$%&^~{}")


# --- SQL literal rendering -------------------------------------------------


def s_str(value: str | None) -> str:
    """A STRING literal; anything beyond plain characters goes through hex."""
    if value is None:
        return "CAST(NULL AS STRING)"
    if all(ch in _SAFE for ch in value):
        return f"'{value}'"
    return f"decode(unhex('{value.encode('utf-8').hex()}'), 'UTF-8')"


def s_double(value: float | None) -> str:
    if value is None:
        return "CAST(NULL AS DOUBLE)"
    value = float(value)
    if math.isnan(value):
        return "CAST('NaN' AS DOUBLE)"
    if math.isinf(value):
        return "CAST('Infinity' AS DOUBLE)" if value > 0 else "CAST('-Infinity' AS DOUBLE)"
    return f"CAST({value!r} AS DOUBLE)"


def s_bool(value: bool) -> str:
    return "true" if value else "false"


def ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _details(values: Mapping[str, str]) -> str:
    if not values:
        return "'{}'"
    fields = ", ".join(f"{s_str(k)}, {v}" for k, v in values.items())
    return f"to_json(named_struct({fields}), map('ignoreNullFields', 'false'))"


def result_struct(
    spec: CheckSpec,
    ordinal: int,
    *,
    status: str,
    metric: str,
    violations: str,
    total_rows: str,
    message: str,
    details: str,
) -> str:
    """SQL for one result row, as a struct with the result schema plus ``ordinal``."""
    parts = [
        ("ordinal", f"CAST({int(ordinal)} AS INT)"),
        ("check_name", s_str(spec.name)),
        ("check_type", s_str(spec.check_type)),
        ("sub_type", s_str(spec.sub_type)),
        ("status", f"CAST({status} AS STRING)"),
        ("metric", f"CAST({metric} AS DOUBLE)"),
        ("violations", f"CAST({violations} AS BIGINT)"),
        ("total_rows", f"CAST({total_rows} AS BIGINT)"),
        ("threshold", s_double(spec.threshold)),
        ("message", f"CAST({message} AS STRING)"),
        ("parameters", s_str(spec.parameters_json())),
        ("details", f"CAST({details} AS STRING)"),
    ]
    return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in parts) + ")"


def ratio_metric(violations: str, total: str) -> str:
    """violations / total, 0.0 on an empty input (no division by zero)."""
    return f"(CASE WHEN {total} = 0 THEN CAST(0.0 AS DOUBLE) ELSE CAST({violations} AS DOUBLE) / CAST({total} AS DOUBLE) END)"


def ratio_result(
    spec: CheckSpec,
    ordinal: int,
    violations: str,
    total: str,
    describe: str,
    extra: Mapping[str, str] | None = None,
) -> str:
    """PASS iff violations / total <= threshold (inclusive)."""
    metric = ratio_metric(violations, total)
    thr = s_double(spec.threshold)
    message = (
        f"format_string({s_str('%d of %d rows (%.2f%%) %s. Threshold: %.2f%%')}, "
        f"{violations}, {total}, {metric} * 100, {s_str(describe)}, {thr} * 100)"
    )
    details = {"violations": violations, "total_rows": total, **(extra or {})}
    return result_struct(
        spec,
        ordinal,
        status=f"CASE WHEN {metric} <= {thr} THEN '{PASS}' ELSE '{FAIL}' END",
        metric=metric,
        violations=violations,
        total_rows=total,
        message=message,
        details=_details(details),
    )


def error_result(spec: CheckSpec, ordinal: int, total: str, reason: str) -> str:
    """ERROR row: metric and violations NULL, the true row count kept."""
    return result_struct(
        spec,
        ordinal,
        status=f"'{ERROR}'",
        metric="NULL",
        violations="NULL",
        total_rows=total,
        message=s_str(f"Check '{spec.name}' ({spec.kind}) could not run: {reason}"),
        details=_details({"error": s_str(reason)}),
    )


def schema_result(spec: CheckSpec, ordinal: int, total: str, column: str, actual: str, expected: Sequence[str]) -> str:
    """Schema-only type check: metric 0.0 on a match, 1.0 otherwise."""
    matched = actual in expected
    metric = s_double(0.0 if matched else 1.0)
    thr = s_double(spec.threshold)
    shown = expected[0] if len(expected) == 1 else "|".join(expected)
    text = f"Column '{column}' has type '{actual}', expected '{shown}'" + ("." if matched else " (mismatch).")
    return result_struct(
        spec,
        ordinal,
        status=f"CASE WHEN {metric} <= {thr} THEN '{PASS}' ELSE '{FAIL}' END",
        metric=metric,
        violations=str(0 if matched else 1),
        total_rows=total,
        message=s_str(text),
        details=_details({"actual_type": s_str(actual), "expected_type": s_str(shown), "matched": s_bool(matched)}),
    )


def _finite(x: str) -> str:
    return f"(NOT isnan({x}) AND abs({x}) != CAST('Infinity' AS DOUBLE))"


def mean_deviation_result(
    spec: CheckSpec,
    ordinal: int,
    total: str,
    mean: str,
    stddev: str,
    valid: str,
    column: str,
    expected_mean: float,
    max_stddevs: float,
) -> str:
    """|mean - expected| / stddev_pop, FAIL iff above ``max_stddevs``.

    Empty input → PASS 0.0.  No valid value, or an infinite mean / stddev
    (±Inf in the data) → ERROR.  Zero stddev → deviation 0.0 when the mean
    equals the expectation, else infinite: FAIL with a NULL metric, since a
    non-finite metric cannot be stored.  ``threshold`` only appears in the
    message, as a user-facing annotation.
    """
    exp = s_double(expected_mean)
    mx = s_double(max_stddevs)
    dev = f"(abs({mean} - {exp}) / {stddev})"
    empty = f"({total} = 0)"
    no_values = f"({valid} = 0)"
    bad = f"(NOT {_finite(mean)} OR NOT {_finite(stddev)})"
    flat = f"({stddev} = 0)"
    status = (
        f"CASE WHEN {empty} THEN '{PASS}' WHEN {no_values} OR {bad} THEN '{ERROR}' "
        f"WHEN {flat} THEN (CASE WHEN {mean} = {exp} THEN '{PASS}' ELSE '{FAIL}' END) "
        f"WHEN {dev} > {mx} THEN '{FAIL}' ELSE '{PASS}' END"
    )
    metric = (
        f"CASE WHEN {empty} THEN CAST(0.0 AS DOUBLE) WHEN {no_values} OR {bad} THEN NULL "
        f"WHEN {flat} THEN (CASE WHEN {mean} = {exp} THEN CAST(0.0 AS DOUBLE) END) ELSE {dev} END"
    )
    fmt_empty = s_str(f"Mean deviation of '{column}': empty input.")
    fmt_none = s_str(f"Mean deviation of '{column}': no non-NULL, non-NaN values.")
    fmt_bad = s_str(f"Mean deviation of '{column}': statistics are not finite (mean=%s, stddev=%s).")
    fmt_flat = s_str(f"Mean deviation of '{column}': mean=%.4f, stddev=0, expected %.4f; deviation is %s.")
    fmt_dev = s_str(
        f"Mean deviation of '{column}': mean=%.4f, stddev=%.4f, expected %.4f; "
        "deviation %.4f stddevs (max %.4f). Threshold (annotation): %.4f"
    )
    message = (
        f"CASE WHEN {empty} THEN {fmt_empty} WHEN {no_values} THEN {fmt_none} "
        f"WHEN {bad} THEN format_string({fmt_bad}, CAST({mean} AS STRING), CAST({stddev} AS STRING)) "
        f"WHEN {flat} THEN format_string({fmt_flat}, {mean}, {exp}, "
        f"CASE WHEN {mean} = {exp} THEN '0' ELSE 'infinite' END) "
        f"ELSE format_string({fmt_dev}, {mean}, {stddev}, {exp}, {dev}, {mx}, {s_double(spec.threshold)}) END"
    )
    return result_struct(
        spec,
        ordinal,
        status=status,
        metric=metric,
        violations="NULL",
        total_rows=total,
        message=message,
        details=_details(
            {
                "actual_mean": mean,
                "actual_stddev": stddev,
                "valid_rows": valid,
                "expected_mean": exp,
                "max_deviation_stddevs": mx,
            }
        ),
    )
