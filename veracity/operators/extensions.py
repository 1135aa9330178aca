"""Extensions built on the check machinery.

* ``repair_audit`` — per repaired column, how many rows the cleaning rules
  changed (``NOT (c <=> c_original)``), in one aggregate.
* ``tag_rows`` / ``gate_split`` — the checks each row fails, and accepted /
  quarantined rows by them, uniqueness and references included.
* ``format/castable`` — value-level counterpart of the schema type check:
  non-NULL values that do not cast to a target type.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veracity.functions.columns import col_ref, fresh_names
from veracity.functions.predicates import any_of
from veracity.operators.checks import (
    CheckError,
    CompileContext,
    GroupCheck,
    ReferenceCheck,
    RowCheck,
    _column,
    _resolve,
    compile_check,
    register,
)
from veracity.operators.keyed import COLUMN, FAILED, NUMBER, ROWS, TEXT, key_parts, violating_keys
from veracity.operators.skew import HOT_ROWS, MAX_HOT_KEYS
from veracity.session import materialize
from veracity.spec import CheckSpec, build_specs


def repair_audit(df: DataFrame, columns: Sequence[str], suffix: str = "_original") -> DataFrame:
    """``(column, repaired_rows, total_rows)``: rows whose value differs from its backup."""
    aggs = [F.count(F.lit(1)).alias("__total")]
    for i, c in enumerate(columns):
        changed = ~col_ref(df, c).eqNullSafe(col_ref(df, f"{c}{suffix}"))
        aggs.append(F.count_if(changed).alias(f"__r{i}"))
    row = df.agg(*aggs)
    structs = [
        F.struct(F.lit(c).alias("column"), F.col(f"__r{i}").alias("repaired_rows"), F.col("__total").alias("total_rows"))
        for i, c in enumerate(columns)
    ]
    return row.select(F.explode(F.array(*structs)).alias("__a")).select("__a.*")


FAILED_CHECKS = "failed_checks"


SALTS = 4096


def _with_failed_keys(df: DataFrame, key: Column, dtype: T.DataType, bad: DataFrame, name: str, hot_rows: int) -> DataFrame:
    """``df`` with the names of the checks its key fails (NULL: none) in ``name``.

    ``bad`` holds the failing keys of one column (written).  Keys of more than
    ``hot_rows`` rows are broadcast, the largest ``MAX_HOT_KEYS`` of them at
    most (a key is a number or a text of bounded length); their rows, and those
    with a NULL key, meet no partner in the shuffled join, so there they carry a
    salt in place of the key and spread over all tasks.
    """
    number, text, hot_failed, cold_failed, k = fresh_names(df, "__k_number", "__k_text", "__hot_failed", "__cold_failed", "__k")
    parts = key_parts(k, dtype)
    out = df.withColumn(k, key).withColumns({number: F.expr(parts[0]), text: F.expr(parts[1])}).drop(k)
    nulls = bad.where(f"{NUMBER} IS NULL AND {TEXT} IS NULL").select(FAILED).first()
    real = bad.where(f"{NUMBER} IS NOT NULL OR {TEXT} IS NOT NULL").select(
        F.coalesce(NUMBER, F.lit(0)).alias(NUMBER), F.coalesce(TEXT, F.lit("")).alias(TEXT), ROWS, FAILED)
    hot = real.where(F.col(ROWS) > hot_rows).orderBy(F.desc(ROWS), NUMBER, TEXT).limit(MAX_HOT_KEYS).drop(ROWS)
    null_key = F.col(number).isNull() & F.col(text).isNull()
    out = out.withColumns({number: F.coalesce(number, F.lit(0)), text: F.when(~null_key, F.coalesce(text, F.lit("")))})
    if not hot.isEmpty():
        small = F.broadcast(hot.withColumnRenamed(FAILED, hot_failed).toDF(f"{number}h", f"{text}h", hot_failed))
        out = out.join(small, (F.col(number) == F.col(f"{number}h")) & (F.col(text) == F.col(f"{text}h")), "left").drop(f"{number}h", f"{text}h")
        real = real.join(F.broadcast(hot), [NUMBER, TEXT], "left_anti")
    else:
        out = out.withColumn(hot_failed, F.lit(None).cast("array<string>"))
    salt = F.concat(F.lit("~"), (F.monotonically_increasing_id() % SALTS).cast("string"))  # no key starts with it
    out = out.withColumn(text, F.when(F.col(text).isNull() | F.col(hot_failed).isNotNull(), salt).otherwise(F.col(text)))
    cold = real.select(F.col(NUMBER).alias(f"{number}c"), F.col(TEXT).alias(f"{text}c"), F.col(FAILED).alias(cold_failed))
    out = out.join(cold, (F.col(number) == F.col(f"{number}c")) & (F.col(text) == F.col(f"{text}c")), "left")
    of_null = F.when(key.isNull(), F.array(*[F.lit(n) for n in nulls[0]]).cast("array<string>")) if nulls else F.lit(None).cast("array<string>")
    return out.withColumn(name, F.coalesce(hot_failed, cold_failed, of_null)).drop(
        number, text, hot_failed, cold_failed, f"{number}c", f"{text}c")


def tag_rows(
    df: DataFrame,
    checks: Sequence[CheckSpec | Mapping[str, Any]],
    *,
    base_dir: str | None = None,
    references: Mapping[str, DataFrame] | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``df`` with ``failed_checks``: the names, in suite order, of the checks each row fails.

    Row checks are predicates; uniqueness and referential checks are decided
    per key, in one count over all their columns, and brought back to the rows
    by joins on the compact key.  Failing keys are written when this is called.
    Checks without rows of their own (schema, statistics) are rejected.
    """
    if FAILED_CHECKS in df.columns:
        raise ValueError(f"column name '{FAILED_CHECKS}' is taken")
    ctx = CompileContext(df.sparkSession, base_dir, dict(references or {}))
    predicates, keyed, order = {}, {}, []
    for ordinal, spec in enumerate(build_specs(checks)):
        shape = compile_check(df, spec, ctx)
        order.append(spec.name)
        if isinstance(shape, RowCheck):
            predicates[spec.name] = shape.predicate
        elif isinstance(shape, (GroupCheck, ReferenceCheck)) and key_parts("k", shape.dtype):
            keyed.setdefault(shape.column, []).append((ordinal, spec, shape))
        else:
            raise CheckError(f"check '{spec.name}' decides no single rows and cannot gate them")
    out, tags = df, []
    if keyed:
        bad = materialize(violating_keys(df, keyed), "failing-keys")
        for number, items in enumerate(keyed.values()):
            (tag,) = fresh_names(out, f"__failed_{number}")
            shape = items[0][2]
            out = _with_failed_keys(out, shape.key, shape.dtype, bad.where(F.col(COLUMN) == number), tag, hot_rows)
            tags.append(tag)
    named = F.array(*[F.when(p, F.lit(n)) for n, p in predicates.items()]).cast("array<string>")
    every = F.array_compact(F.concat(named, *[F.coalesce(F.col(t), F.array().cast("array<string>")) for t in tags]))
    in_order = F.filter(F.array(*[F.lit(n) for n in order]).cast("array<string>"), lambda n: F.array_contains(every, n))
    return out.withColumn(FAILED_CHECKS, in_order).drop(*tags)


def gate_split(
    df: DataFrame,
    checks: Sequence[CheckSpec | Mapping[str, Any]],
    *,
    base_dir: str | None = None,
    references: Mapping[str, DataFrame] | None = None,
    hot_rows: int = HOT_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantined) by the checks that decide rows, uniqueness and references among them.

    Every row lands in exactly one half; quarantined rows gain a
    ``failed_checks`` array.  With row checks alone both halves are filters.
    With keyed checks the tagged table is written once and both read it.
    """
    tagged = tag_rows(df, checks, base_dir=base_dir, references=references, hot_rows=hot_rows)
    bad = F.size(FAILED_CHECKS) > 0
    ctx = CompileContext(df.sparkSession, base_dir, dict(references or {}))
    shapes = [compile_check(df, spec, ctx) for spec in build_specs(checks)]
    if all(isinstance(shape, RowCheck) for shape in shapes):
        fails = any_of(F.coalesce(shape.predicate, F.lit(False)) for shape in shapes)
        return df.where(~fails), tagged.where(bad)
    tagged = materialize(tagged, "tagged")
    return tagged.where(~bad).drop(FAILED_CHECKS), tagged.where(bad)


@register("format", "castable")
def _castable(df: DataFrame, spec: CheckSpec, ctx: CompileContext) -> RowCheck:
    name = _column(spec)
    c, _ = _resolve(df, name)
    target = spec.param("target_type")
    if not isinstance(target, str) or not target:
        raise CheckError("castable check needs 'target_type'")
    return RowCheck(c.isNotNull() & c.try_cast(target).isNull(), f"do not cast to {target} in '{name}'", name)


def castable_check(name: str, column: str, target_type: str, threshold: float = 0.0) -> dict:
    return {
        "check_name": name,
        "check_type": "format",
        "sub_type": "castable",
        "params": {"column": column, "target_type": target_type, "threshold": threshold},
    }
