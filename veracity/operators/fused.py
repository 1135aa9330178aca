"""The fused pass: every row-level check, statistic and schema check at once.

All such checks over one DataFrame become a single global aggregate —
``count(1)``, one ``count_if(predicate)`` per row check and ``avg`` /
``stddev_pop`` / ``count`` per statistic — so the table is scanned once,
only the referenced columns are read, each task folds its rows into one
partial buffer and a single row crosses the exchange.  That row is then
unpivoted with ``explode(array(struct, ...))`` into one result row per check.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veracity.functions import render as R
from veracity.operators.checks import RowCheck, SchemaCheck, StatCheck
from veracity.spec import CheckSpec

TOTAL = "__total"

FusedItem = tuple[int, CheckSpec, object]


def _name(prefix: str, ordinal: int) -> str:
    return f"__{prefix}{ordinal}"


def fused_aggregates(items: Sequence[FusedItem]) -> list:
    aggs = [F.count(F.lit(1)).alias(TOTAL)]
    for ordinal, _, shape in items:
        if isinstance(shape, RowCheck):
            aggs.append(F.count_if(shape.predicate).alias(_name("v", ordinal)))
        elif isinstance(shape, StatCheck):
            aggs.append(F.avg(shape.value).alias(_name("mean", ordinal)))
            aggs.append(F.stddev_pop(shape.value).alias(_name("sd", ordinal)))
            aggs.append(F.count(shape.value).alias(_name("valid", ordinal)))
    return aggs


def result_structs(items: Sequence[FusedItem]) -> list[str]:
    total = TOTAL
    structs = []
    for ordinal, spec, shape in items:
        if isinstance(shape, RowCheck):
            structs.append(R.ratio_result(spec, ordinal, _name("v", ordinal), total, shape.describe))
        elif isinstance(shape, StatCheck):
            structs.append(
                R.mean_deviation_result(
                    spec,
                    ordinal,
                    total,
                    _name("mean", ordinal),
                    _name("sd", ordinal),
                    _name("valid", ordinal),
                    shape.column,
                    shape.expected_mean,
                    shape.max_stddevs,
                )
            )
        elif isinstance(shape, SchemaCheck):
            structs.append(R.schema_result(spec, ordinal, total, shape.column, shape.actual, shape.expected))
        else:
            structs.append(R.error_result(spec, ordinal, total, str(shape)))
    return structs


# --- mergeable states ------------------------------------------------------


def fused_state(df: DataFrame, items: Sequence[FusedItem]) -> DataFrame:
    """One row: the counts and moments (``valid``, ``mean``, squared deviations ``m2``) of every item over ``df``."""
    aggs = [F.count(F.lit(1)).alias(TOTAL)]
    for ordinal, _, shape in items:
        if isinstance(shape, RowCheck):
            aggs.append(F.count_if(shape.predicate).alias(_name("v", ordinal)))
        elif isinstance(shape, StatCheck):
            valid = F.count(shape.value)
            aggs.append(F.struct(valid.alias("n"), F.avg(shape.value).alias("mean"),
                                 (F.var_pop(shape.value) * valid).alias("m2")).alias(_name("s", ordinal)))
    return df.agg(*aggs)


#: Two sets of moments as those of all their values; a side without values leaves the other as it is.
_MERGE = ("CASE WHEN y.n = 0 THEN x WHEN x.n = 0 THEN y ELSE named_struct('n', x.n + y.n, "
          "'mean', x.mean + (y.mean - x.mean) * y.n / (x.n + y.n), "
          "'m2', x.m2 + y.m2 + (y.mean - x.mean) * (y.mean - x.mean) * x.n / (x.n + y.n) * y.n) END")
_NO_VALUES = "named_struct('n', 0L, 'mean', CAST(NULL AS DOUBLE), 'm2', CAST(NULL AS DOUBLE))"


def merged_fused_state(states: DataFrame, items: Sequence[FusedItem], order_by: str) -> DataFrame:
    """One state for all of ``states`` (few rows: one per batch), merged in the order of ``order_by``."""
    aggs = [f"coalesce(sum({TOTAL}), 0L) AS {TOTAL}"]
    for ordinal, _, shape in items:
        if isinstance(shape, RowCheck):
            aggs.append(f"coalesce(sum({_name('v', ordinal)}), 0L) AS {_name('v', ordinal)}")
        elif isinstance(shape, StatCheck):
            s = _name("s", ordinal)
            aggs.append(f"reduce(transform(array_sort(collect_list(struct({order_by} AS o, {s} AS s))), e -> e.s), {_NO_VALUES}, "
                        f"(x, y) -> {_MERGE}) AS {s}")
    return states.agg(*map(F.expr, aggs))


def fused_results_of_state(state: DataFrame, items: Sequence[FusedItem]) -> DataFrame:
    """The results ``fused_results`` gives on the rows of a merged state."""
    names = ["*"]
    for ordinal, _, shape in items:
        if isinstance(shape, StatCheck):
            s = _name("s", ordinal)
            names += [f"{s}.mean AS {_name('mean', ordinal)}", f"sqrt({s}.m2 / nullif({s}.n, 0L)) AS {_name('sd', ordinal)}",
                      f"{s}.n AS {_name('valid', ordinal)}"]
    return state.selectExpr(*names).selectExpr(f"inline(array({', '.join(result_structs(items))}))")


def fused_results(df: DataFrame, items: Sequence[FusedItem]) -> DataFrame:
    """One result row per item; errors (any non-shape item) become ERROR rows."""
    row = df.agg(*fused_aggregates(items))
    return row.selectExpr(f"explode(array({', '.join(result_structs(items))})) AS __r").select("__r.*")
