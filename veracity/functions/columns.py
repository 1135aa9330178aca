"""Column references and type helpers.

Column names may contain dots, spaces or backticks, or name a nested field.
A name that exists literally at the top level is quoted; anything else is
handed to ``F.col`` so ``a.b`` resolves as a struct field.  Types are read
from ``df.select(ref).schema`` — analysis only, no job — which also works for
nested fields, unlike ``df.schema[name]``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col_ref(df: DataFrame, name: str) -> Column:
    if "." not in name and "`" not in name:
        return F.col(name)  # a plain name means the same quoted or not: no schema lookup
    if name in df.columns:
        return F.col(quote(name))
    return F.col(name)


def fresh_names(df: DataFrame, *names: str) -> list[str]:
    """``names`` as they are where ``df`` has no such column, else with underscores added."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while any(c.startswith(name.lower()) for c in taken):  # helpers may extend a name
            name += "_"
        out.append(name)
    return out


class MissingColumn(LookupError):
    """The column does not exist in the DataFrame."""


def _case_sensitive(df: DataFrame) -> bool:
    return str(df.sparkSession.conf.get("spark.sql.caseSensitive", "false")).lower() == "true"


def column_type(df: DataFrame, name: str) -> T.DataType:
    """Data type of ``name``; raises ``MissingColumn`` / ``AnalysisException`` when it does not resolve."""
    fields = df.schema.fields  # cached on the DataFrame after the first call
    for f in fields:
        if f.name == name:
            return f.dataType
    if not _case_sensitive(df):
        for f in fields:
            if f.name.lower() == name.lower():
                return f.dataType
    if "." not in name:
        raise MissingColumn(f"column '{name}' does not exist")
    return df.select(col_ref(df, name)).schema[0].dataType


def is_floating(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.FloatType, T.DoubleType))


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def is_string(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StringType, T.VarcharType, T.CharType))


def as_checked_type(ref: Column, ref_type: T.DataType, key_type: T.DataType, spark: SparkSession) -> Column:
    """Reference values in the checked column's type; NULL for a value that no checked value can equal.

    Values are equal when they are in the common type of both columns (1.5
    equals no bigint); with text on one side, when the reference's value,
    converted to the checked type, is the checked one.  Counting and drill-down
    share this column, so they cannot disagree.
    """
    if ref_type == key_type:
        return ref
    converted = ref.try_cast(key_type)
    if is_string(ref_type) or is_string(key_type):
        return converted
    both = F.coalesce(F.lit(None).cast(key_type), F.lit(None).cast(ref_type))
    common = spark.range(0).select(both).schema[0].dataType  # analysis only; raises where there is none
    return F.when(converted.try_cast(common) == ref.try_cast(common), converted)


def is_finite(c: Column) -> Column:
    """True for a real number; NULL for NULL; false for NaN and ±Inf."""
    return ~F.isnan(c) & (c != F.lit(float("inf"))) & (c != F.lit(float("-inf")))


def non_finite_to_null(c: Column) -> Column:
    """NaN / ±Inf → NULL (sinks cannot carry them as numbers)."""
    return F.when(is_finite(c), c)
