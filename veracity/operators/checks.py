"""Check compilers and their registry.

A compiler turns a ``CheckSpec`` plus the DataFrame under test into one of a
few *shapes*; the suite planner fuses shapes that share a pass:

* ``RowCheck``     — a violation predicate, counted inside the fused aggregate
* ``StatCheck``    — a value column whose mean / stddev_pop the fused aggregate computes
* ``SchemaCheck``  — answered from the schema alone (no data read)
* ``GroupCheck``   — needs a group-by on one column (uniqueness)
* ``ReferenceCheck``— needs the keys of a reference table (referential integrity)

Compilers raise on bad parameters, missing columns or wrong types; the suite
turns that into an ERROR row for that check only.  Users extend the engine
with ``@register("my_type", "my_sub_type")``.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veracity.functions import predicates as P
from veracity.functions.columns import as_checked_type, col_ref, column_type, is_floating, is_numeric
from veracity.spec import CheckSpec


class CheckError(ValueError):
    """The check cannot be evaluated; reported as an ERROR row."""


@dataclass(frozen=True)
class RowCheck:
    predicate: Column
    describe: str
    column: str | None = None


@dataclass(frozen=True)
class StatCheck:
    value: Column
    column: str
    expected_mean: float
    max_stddevs: float


@dataclass(frozen=True)
class SchemaCheck:
    column: str
    actual: str
    expected: list[str]


@dataclass(frozen=True)
class GroupCheck:
    key: Column
    column: str
    dtype: T.DataType | None = None


@dataclass(frozen=True)
class ReferenceCheck:
    key: Column
    column: str
    reference: DataFrame
    reference_key: Column
    reference_label: str
    nulls_violate: bool = True
    dtype: T.DataType | None = None


Shape = RowCheck | StatCheck | SchemaCheck | GroupCheck | ReferenceCheck


@dataclass
class CompileContext:
    """What compilers may need beyond the DataFrame: a session and a base path."""

    spark: SparkSession
    base_dir: str | None = None
    references: dict[str, DataFrame] = field(default_factory=dict)


Compiler = Callable[[DataFrame, CheckSpec, CompileContext], Shape]
_REGISTRY: dict[tuple[str, str | None], Compiler] = {}
_PARAMS: dict[Compiler, frozenset[str]] = {}
ANY_SUB_TYPE = "*"


def register(check_type: str, *sub_types: str | None, params: str | None = None) -> Callable[[Compiler], Compiler]:
    """Register a compiler for ``check_type`` and each given ``sub_type`` (default: None; ``ANY_SUB_TYPE``: every one).

    ``params`` names the parameters the check takes besides ``threshold``; any
    other is then an ERROR row, so a misspelt one cannot pass unseen.
    Without it, every parameter is taken.
    """
    keys = sub_types or (None,)

    def deco(fn: Compiler) -> Compiler:
        for sub in keys:
            _REGISTRY[(check_type, sub)] = fn
        if params is not None:
            _PARAMS[fn] = frozenset(params.split()) | {"threshold"}
        return fn

    return deco


def registered() -> list[tuple[str, str | None]]:
    return sorted(_REGISTRY, key=lambda k: (k[0], k[1] or ""))


def resolve(spec: CheckSpec) -> Compiler:
    fn = _REGISTRY.get((spec.check_type, spec.sub_type)) or _REGISTRY.get((spec.check_type, ANY_SUB_TYPE))
    if fn is None:
        if any(t == spec.check_type for t, _ in _REGISTRY):
            raise CheckError(f"unknown sub_type '{spec.sub_type}' for check_type '{spec.check_type}'")
        raise CheckError(f"unknown check_type '{spec.check_type}'")
    return fn


def compile_check(df: DataFrame, spec: CheckSpec, ctx: CompileContext) -> Shape:
    compiler = resolve(spec)
    if compiler in _PARAMS and (unknown := sorted(set(spec.params) - _PARAMS[compiler])):
        raise CheckError(f"unknown parameter {', '.join(map(repr, unknown))} for {spec.kind}")
    if problem := spec.threshold_error():
        raise CheckError(problem)
    return compiler(df, spec, ctx)


def _column(spec: CheckSpec) -> str:
    name = spec.param("column")
    if not isinstance(name, str) or not name:
        raise CheckError("parameter 'column' is required")
    return name


def _resolve(df: DataFrame, name: str):
    try:
        return col_ref(df, name), column_type(df, name)
    except Exception as exc:  # AnalysisException: unresolved column
        raise CheckError(f"column '{name}' does not exist") from exc


_PROBED: set[tuple] = set()


def _probe(ctx: CompileContext, expr: Column, what: str, key: tuple) -> None:
    """Evaluate ``expr`` on one row now.

    Some user-supplied literals (a date pattern, a regex) are only compiled
    when a task runs, and a bad one would fail the whole fused job; a
    one-row job at build time turns that into an ERROR row for this check.
    A literal that passed is remembered (``key`` includes the parser policy).
    """
    if key in _PROBED:
        return
    try:
        ctx.spark.range(1).select(expr.alias("__probe")).collect()
    except Exception as exc:
        raise CheckError(f"{what}: {str(exc).strip().splitlines()[0]}") from exc
    _PROBED.add(key)


def _probe_dates(ctx: CompileContext, dtype: T.DataType, values: list) -> None:
    """A date given as text is only parsed when a task runs: parse it now."""
    if P.is_temporal(dtype):
        for value in values:
            _probe(ctx, F.lit(value).cast(dtype), f"invalid {dtype.simpleString()} {value!r}",
                   ("literal", dtype.simpleString(), str(value)))


def _wrap(fn: Callable[[], Any]) -> Any:
    try:
        return fn()
    except P.PredicateError as exc:
        raise CheckError(str(exc)) from exc


def _beyond(lo: Any, hi: Any) -> str:
    """What lies outside the bounds given, in words."""
    return " or ".join(words for words, bound in ((f"below {lo}", lo), (f"above {hi}", hi)) if bound is not None)


# --- completeness ---------------------------------------------------------


@register("completeness", None, ANY_SUB_TYPE, params="column")
def _completeness(df: DataFrame, spec: CheckSpec, ctx: CompileContext) -> Shape:
    name = _column(spec)
    c, dtype = _resolve(df, name)
    what = "NULL or NaN" if is_floating(dtype) else "NULL"
    return RowCheck(P.missing(c, dtype), f"are {what} in '{name}'", name)


# --- validity -------------------------------------------------------------


@register("validity", "range", params="column min_value max_value")
def _range(df: DataFrame, spec: CheckSpec, ctx: CompileContext) -> Shape:
    name = _column(spec)
    c, dtype = _resolve(df, name)
    lo, hi = spec.param("min_value"), spec.param("max_value")
    pred = _wrap(lambda: P.outside_range(c, dtype, lo, hi))
    _probe_dates(ctx, dtype, [v for v in (lo, hi) if v is not None])
    if pred is None:
        return RowCheck(F.lit(False), f"checked in '{name}' with no range given", name)
    return RowCheck(pred, f"are {_beyond(lo, hi)} in '{name}'", name)


@register("validity", "regex", params="column pattern")
def _regex(df: DataFrame, spec: CheckSpec, ctx: CompileContext) -> Shape:
    name = _column(spec)
    c, dtype = _resolve(df, name)
    pattern = spec.param("pattern")
    pred = _wrap(lambda: P.regex_miss(c, dtype, pattern))
    _probe(ctx, F.lit("x").rlike(pattern), f"invalid regex '{pattern}'", ("regex", pattern))
    return RowCheck(pred, f"do not match regex '{pattern}' in '{name}'", name)


@register("validity", "categorical", params="column allowed_values")
def _categorical(df: DataFrame, spec: CheckSpec, ctx: CompileContext) -> Shape:
    name = _column(spec)
    c, dtype = _resolve(df, name)
    allowed = spec.param("allowed_values")
    pred = _wrap(lambda: P.not_allowed(c, dtype, allowed))
    _probe_dates(ctx, dtype, [v for v in allowed if v is not None])
    return RowCheck(pred, f"are not in {list(allowed)} in '{name}'", name)


# --- consistency ----------------------------------------------------------


@register("consistency", None, "custom_condition", params="condition_sql")
def _custom(df: DataFrame, spec: CheckSpec, ctx: CompileContext) -> Shape:
    condition = spec.param("condition_sql")
    pred = _wrap(lambda: P.condition_fails(condition))
    return RowCheck(pred, f"fail condition ({condition})")


def _reference_frame(spec: CheckSpec, ctx: CompileContext) -> tuple[DataFrame, str]:
    """Reference keys from a DataFrame, a registered name, a table or a Parquet path."""
    ref = spec.param("reference")
    if isinstance(ref, DataFrame):
        return ref, "<DataFrame>"
    if isinstance(ref, str) and ref in ctx.references:
        return ctx.references[ref], ref
    if isinstance(ref, str) and ref and "/" not in ref and not ref.endswith(".parquet"):
        try:
            return ctx.spark.table(ref), ref
        except Exception as exc:  # AnalysisException: no such table
            raise CheckError(f"reference table '{ref}' does not exist") from exc
    path = ref if isinstance(ref, str) and ref else spec.param("reference_data_path")
    if not isinstance(path, str) or not path:
        raise CheckError("referential integrity needs 'reference' or 'reference_data_path'")
    if path in ctx.references:
        return ctx.references[path], path
    full = path
    if ctx.base_dir and "://" not in path and not os.path.isabs(path):
        full = os.path.join(ctx.base_dir, path)
    from veracity.sources.readers import read_parquet

    try:
        return read_parquet(ctx.spark, full), path
    except FileNotFoundError as exc:
        raise CheckError(str(exc)) from exc


@register("consistency", "referential_integrity",
          params="column reference reference_data_path reference_column nulls_are_violations")
def _referential(df: DataFrame, spec: CheckSpec, ctx: CompileContext) -> Shape:
    name = _column(spec)
    c, dtype = _resolve(df, name)
    ref, label = _reference_frame(spec, ctx)
    ref_col = spec.param("reference_column") or name
    try:
        rc, ref_type = col_ref(ref, ref_col), column_type(ref, ref_col)
    except Exception as exc:
        raise CheckError(f"reference column '{ref_col}' does not exist in {label}") from exc
    nulls = spec.param("nulls_are_violations", True)
    rc = as_checked_type(rc, ref_type, dtype, ctx.spark)
    return ReferenceCheck(c, name, ref, rc, f"{label}.{ref_col}", bool(nulls), dtype)


# --- format ---------------------------------------------------------------


@register("format", "string_length", params="column min_length max_length fixed_length")
def _length(df: DataFrame, spec: CheckSpec, ctx: CompileContext) -> Shape:
    name = _column(spec)
    c, dtype = _resolve(df, name)
    lo, hi, fixed = spec.param("min_length"), spec.param("max_length"), spec.param("fixed_length")
    pred = _wrap(lambda: P.length_violation(c, dtype, lo, hi, fixed))
    if pred is None:
        return RowCheck(F.lit(False), f"checked in '{name}' with no length constraint", name)
    off = f"other than {fixed}" if fixed is not None else _beyond(lo, hi)
    return RowCheck(pred, f"have a length {off} in '{name}'", name)


@register("format", "date_format", params="column expected_format")
def _date_format(df: DataFrame, spec: CheckSpec, ctx: CompileContext) -> Shape:
    name = _column(spec)
    c, dtype = _resolve(df, name)
    fmt = spec.param("expected_format")
    pred = _wrap(lambda: P.unparseable_timestamp(c, dtype, fmt))
    policy = ctx.spark.conf.get("spark.sql.legacy.timeParserPolicy", "CORRECTED")
    _probe(ctx, F.try_to_timestamp(F.lit("2000-01-01"), F.lit(fmt)), f"invalid date format '{fmt}'",
           ("date", fmt, policy))
    return RowCheck(pred, f"cannot be parsed as '{fmt}' in '{name}'", name)


@register("format", "data_type", params="column expected_spark_type_str expected_type")
def _data_type(df: DataFrame, spec: CheckSpec, ctx: CompileContext) -> Shape:
    name = _column(spec)
    _, dtype = _resolve(df, name)
    expected = spec.param("expected_spark_type_str", spec.param("expected_type"))
    if isinstance(expected, str):
        expected = [expected]
    if not expected or not all(isinstance(e, str) for e in expected):
        raise CheckError("data type check needs 'expected_spark_type_str'")
    return SchemaCheck(name, dtype.simpleString().lower(), [e.strip().lower() for e in expected])


# --- stats ----------------------------------------------------------------


@register("stats", "mean_deviation", params="column expected_mean max_deviation_stddevs")
def _mean_deviation(df: DataFrame, spec: CheckSpec, ctx: CompileContext) -> Shape:
    name = _column(spec)
    c, dtype = _resolve(df, name)
    if not is_numeric(dtype):
        raise CheckError(f"column '{name}' is not numeric ({dtype.simpleString()})")
    try:
        expected = float(spec.param("expected_mean"))
        max_dev = float(spec.param("max_deviation_stddevs"))
    except (TypeError, ValueError) as exc:
        raise CheckError("mean deviation needs numeric 'expected_mean' and 'max_deviation_stddevs'") from exc
    value = c.cast("double")
    if is_floating(dtype):
        value = F.when(~F.isnan(c), value)
    return StatCheck(value, name, expected, max_dev)


# --- uniqueness -----------------------------------------------------------


@register("uniqueness", None, ANY_SUB_TYPE, params="column")
def _uniqueness(df: DataFrame, spec: CheckSpec, ctx: CompileContext) -> Shape:
    name = _column(spec)
    c, dtype = _resolve(df, name)
    return GroupCheck(c, name, dtype)
