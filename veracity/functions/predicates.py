"""Violation predicates.

Every function returns a boolean ``Column`` that is *true exactly for a
violating row*.  NULL or false both mean "not a violation", which is what
``count_if`` and ``filter`` agree on, so the same predicate drives the fused
count, the drill-down filter and the quality gate.
"""

from __future__ import annotations

import datetime as _dt
import decimal as _decimal
from collections.abc import Iterable, Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veracity.functions.columns import is_floating, is_numeric, is_string


class PredicateError(ValueError):
    """Parameters cannot be turned into a predicate for this column."""


def missing(c: Column, dtype: T.DataType) -> Column:
    """NULL, or NaN for floating columns (NaN is not NULL in Spark)."""
    if is_floating(dtype):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def is_temporal(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType))


def _bound(value: Any, dtype: T.DataType) -> Column:
    if is_temporal(dtype):
        return F.lit(value).cast(dtype)
    if isinstance(value, str):  # a number as text, as configuration files may give it
        try:
            return F.lit(float(value))
        except ValueError as exc:
            raise PredicateError(f"range bound {value!r} is not a number") from exc
    return F.lit(value)


def outside_range(c: Column, dtype: T.DataType, min_value: Any = None, max_value: Any = None) -> Column | None:
    """Non-NULL and below ``min_value`` or above ``max_value`` (bounds inclusive).

    NaN sorts above every number, so NaN violates a maximum but never a
    minimum.  Strings are compared as numbers via ``try_cast``: values that
    are not numbers are NULL and never violate.  Returns None when no bound
    is given.
    """
    if min_value is None and max_value is None:
        return None
    value = c
    if is_string(dtype):
        value = c.try_cast("double")
    elif not is_numeric(dtype) and not isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        raise PredicateError(f"range bounds need a numeric, date or string column, got {dtype.simpleString()}")
    conds = []
    if min_value is not None:
        conds.append(value < _bound(min_value, dtype))
    if max_value is not None:
        conds.append(value > _bound(max_value, dtype))
    cond = conds[0] if len(conds) == 1 else (conds[0] | conds[1])
    return value.isNotNull() & cond


def regex_miss(c: Column, dtype: T.DataType, pattern: str) -> Column:
    """Non-NULL and the (unanchored, Java) regex finds no match."""
    if not isinstance(pattern, str) or not pattern:
        raise PredicateError("regex check needs a non-empty 'pattern'")
    value = c if is_string(dtype) else c.cast("string")
    return value.isNotNull() & ~value.rlike(pattern)


def _literal_for(value: Any, dtype: T.DataType) -> Any:
    """Convert an allowed value to the column's Python type, or raise."""
    if is_string(dtype):
        return value if isinstance(value, str) else str(value)
    if isinstance(dtype, T.BooleanType):
        if isinstance(value, bool):
            return value
        if isinstance(value, str) and value.lower() in ("true", "false"):
            return value.lower() == "true"
        raise PredicateError(f"allowed value {value!r} is not a boolean")
    if isinstance(dtype, T.IntegralType):
        if isinstance(value, bool):
            raise PredicateError(f"allowed value {value!r} is not an integer")
        try:
            as_float = float(value)
        except (TypeError, ValueError) as exc:
            raise PredicateError(f"allowed value {value!r} is not an integer") from exc
        if not as_float.is_integer():
            raise PredicateError(f"allowed value {value!r} is not an integer")
        return int(as_float)
    if isinstance(dtype, T.DecimalType):
        try:
            return _decimal.Decimal(str(value))
        except _decimal.InvalidOperation as exc:
            raise PredicateError(f"allowed value {value!r} is not a decimal") from exc
    if is_numeric(dtype):
        try:
            return float(value)
        except (TypeError, ValueError) as exc:
            raise PredicateError(f"allowed value {value!r} is not a number") from exc
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        if isinstance(value, (_dt.date, _dt.datetime, str)):
            return value
        raise PredicateError(f"allowed value {value!r} is not a date/time")
    return value


def not_allowed(c: Column, dtype: T.DataType, allowed_values: Sequence[Any] | None) -> Column:
    """Non-NULL and not in ``allowed_values``.

    NULL entries are dropped from the list (NULL cells are never violations,
    and keeping a NULL in ``IN`` would turn every miss into unknown).  An
    empty list makes every non-NULL cell a violation.  Values are converted
    to the column type when the suite is built; a value that cannot be
    converted raises, which the suite reports as an ERROR row.
    """
    if allowed_values is None or isinstance(allowed_values, (str, bytes)):
        raise PredicateError("categorical check needs a list 'allowed_values'")
    values = [_literal_for(v, dtype) for v in allowed_values if v is not None]
    if not values:
        return c.isNotNull()
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        lits = [F.lit(v).cast(dtype) for v in values]
        return c.isNotNull() & ~c.isin(*lits)
    return c.isNotNull() & ~c.isin(*values)


def condition_fails(condition_sql: str) -> Column:
    """``NOT (condition)`` is true; a NULL condition is not a violation."""
    if not isinstance(condition_sql, str) or not condition_sql.strip():
        raise PredicateError("consistency check needs a non-empty 'condition_sql'")
    return F.expr(f"NOT ({condition_sql})")


def length_violation(
    c: Column,
    dtype: T.DataType,
    min_length: int | None = None,
    max_length: int | None = None,
    fixed_length: int | None = None,
) -> Column | None:
    """Non-NULL string whose character length breaks the constraint.

    ``fixed_length`` overrides ``min_length`` / ``max_length``.  Returns None
    when no constraint is given.
    """
    if not is_string(dtype):
        raise PredicateError(f"length check needs a string column, got {dtype.simpleString()}")
    n = F.length(c)
    if fixed_length is not None:
        cond = n != F.lit(int(fixed_length))
    else:
        conds = []
        if min_length is not None:
            conds.append(n < F.lit(int(min_length)))
        if max_length is not None:
            conds.append(n > F.lit(int(max_length)))
        if not conds:
            return None
        cond = conds[0] if len(conds) == 1 else (conds[0] | conds[1])
    return c.isNotNull() & cond


def unparseable_timestamp(c: Column, dtype: T.DataType, expected_format: str) -> Column:
    """Non-NULL string that ``try_to_timestamp(c, fmt)`` cannot parse.

    ``try_to_timestamp`` keeps ANSI mode from failing the job on bad input and
    honours the session's time-parser policy (strict by default).
    """
    if not is_string(dtype):
        raise PredicateError(f"date format check needs a string column, got {dtype.simpleString()}")
    if not isinstance(expected_format, str) or not expected_format:
        raise PredicateError("date format check needs 'expected_format'")
    return c.isNotNull() & F.try_to_timestamp(c, F.lit(expected_format)).isNull()


def any_of(predicates: Iterable[Column]) -> Column:
    """OR-fold of predicates, each coalesced to false so the fold is never NULL."""
    folded: Column | None = None
    for p in predicates:
        p = F.coalesce(p, F.lit(False))
        folded = p if folded is None else (folded | p)
    return folded if folded is not None else F.lit(False)
