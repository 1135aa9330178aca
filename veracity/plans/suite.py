"""Suite planning: compile checks, fuse them, and return results as a DataFrame.

``Suite.results(df)`` returns the results DataFrame (one row per check, in
suite order) whose plan is

* one fused global aggregate for all row checks, statistics, schema checks
  and build-time errors,
* one count of ``(column, key)`` for all uniqueness and referential checks,
  whatever their columns,

unioned together: two reads of ``df``, each of its own columns.  ``df`` itself
is not run until an action.  Building the plan may run small jobs of its own:
patterns and date literals are tried on one row, and the keys of integer
references are read into a bitmap.  ``Suite.run(df)`` is the
eager form: it optionally materializes the input once in the shared folder,
executes the plan and, if the data breaks it (e.g. an ANSI failure inside a
user's SQL condition), halves the checks until those at fault stand alone and
become ERROR rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from typing import Any

from pyspark import StorageLevel
from pyspark import errors as E
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veracity.functions import render as R
from veracity.operators.checks import (
    ReferenceCheck,
    CheckError,
    CompileContext,
    GroupCheck,
    RowCheck,
    StatCheck,
    compile_check,
)
from veracity.operators.fused import fused_results
from veracity.operators.keyed import key_parts, keyed_results, keyed_results_by_value
from veracity.session import materialize, scratch_tables
from veracity.spec import CheckSpec, build_specs


#: What a task raises because of the values it met.  Failures of the cluster have other classes.
DATA_ERRORS = (E.ArithmeticException, E.ArrayIndexOutOfBoundsException, E.DateTimeException, E.NumberFormatException,
               E.SparkRuntimeException, E.SparkUpgradeException, E.PythonException, E.IllegalArgumentException)


def _describe_error(exc: BaseException) -> str:
    return str(exc).strip() or type(exc).__name__


class Suite:
    """An ordered, validated list of checks."""

    def __init__(
        self,
        checks: Iterable[CheckSpec | Mapping[str, Any]],
        *,
        base_dir: str | None = None,
        references: Mapping[str, DataFrame] | None = None,
    ):
        self.specs = build_specs(checks)
        self.base_dir = base_dir
        self.references = dict(references or {})

    def __len__(self) -> int:
        return len(self.specs)

    # -- compilation -----------------------------------------------------

    def compile(self, df: DataFrame) -> list[tuple[int, CheckSpec, object]]:
        """``(ordinal, spec, shape-or-error)`` per check; analysis errors caught here."""
        ctx = CompileContext(df.sparkSession, self.base_dir, self.references)
        out: list[tuple[int, CheckSpec, object]] = []
        for ordinal, spec in enumerate(self.specs):
            try:
                shape = compile_check(df, spec, ctx)
            except Exception as exc:  # CheckError, AnalysisException, ParseException, ...
                shape = CheckError(_describe_error(exc))
            out.append((ordinal, spec, shape))
        # Analyze every predicate now (no job) so a bad column or bad SQL is an
        # ERROR row for its check instead of failing the whole plan.  One
        # analysis for all; per-check analysis only to locate a failure.
        exprs = [(i, _expression(shape)) for i, (_, _, shape) in enumerate(out)]
        exprs = [(i, e) for i, e in exprs if e is not None]
        if exprs:
            try:
                df.select(*[e.alias(f"__p{i}") for i, e in exprs]).schema
            except Exception:
                for i, e in exprs:
                    try:
                        df.select(e.alias("__p")).schema
                    except Exception as exc:
                        ordinal, spec, _ = out[i]
                        out[i] = (ordinal, spec, CheckError(_describe_error(exc)))
        return out

    # -- lazy plan -------------------------------------------------------

    def results(self, df: DataFrame) -> DataFrame:
        """The results DataFrame (lazy), ordered by suite position."""
        compiled = self.compile(df)
        # All uniqueness and referential checks share one count of (column, key).
        keyed = keyed_items(compiled)
        keyed_branches, failed = self._keyed_branches(df, keyed)
        fused_items = fused_only(compiled) + failed
        branches: list[DataFrame] = []
        if fused_items:
            branches.append(fused_results(df, fused_items))
        branches += keyed_branches
        if not branches:
            return df.sparkSession.createDataFrame([], R.RESULTS_SCHEMA)
        union = reduce(lambda a, b: a.unionByName(b), branches)
        return in_suite_order(union)

    @staticmethod
    def _keyed_branches(df: DataFrame, keyed: dict[str, list]) -> tuple[list[DataFrame], list]:
        """One branch for all columns with a compact key form, one for each other; checks that cannot be analyzed apart.

        Building a branch analyzes it: a column that cannot be grouped, or a
        reference key that cannot be cast, is an ERROR row.
        """
        branches: list[DataFrame] = []
        failed: list[tuple[int, CheckSpec, object]] = []
        compact_form = {c: items for c, items in keyed.items() if key_parts("k", items[0][2].dtype)}

        def attempt(build, items_of: dict[str, list]) -> None:
            try:
                branches.append(build(items_of))
                return
            except Exception as exc:
                if len(items_of) == 1 and len(next(iter(items_of.values()))) == 1:
                    ordinal, spec, _ = next(iter(items_of.values()))[0]
                    failed.append((ordinal, spec, CheckError(_describe_error(exc))))
                    return
            for column, items in items_of.items():  # locate the one at fault
                parts = [{column: items}] if len(items_of) > 1 else [{column: [item]} for item in items]
                for part in parts:
                    attempt(build, part)

        if compact_form:
            attempt(lambda items_of: keyed_results(df, items_of), compact_form)
        for column, items in keyed.items():
            if column not in compact_form:
                attempt(lambda items_of: keyed_results_by_value(df, *next(iter(items_of.items()))), {column: items})
        return branches, failed

    # -- eager run -------------------------------------------------------

    def run(
        self,
        df: DataFrame,
        *,
        materialize_input: bool = False,
        materialize_path: str | None = None,
        persist: bool = False,
    ) -> DataFrame:
        """Execute now; returns a small local-backed DataFrame of results.

        The branches of the plan (the fused aggregate, each keyed co-group)
        each read ``df``.  When ``df`` is expensive (cleaning + a dedup
        shuffle), compute it once:

        * ``materialize_input`` writes the columns the suite references as
          Parquet to ``materialize_path`` or a fresh folder under
          ``spark.checkpoint.dir``; branches then read only their own columns
          and a lost executor re-reads files instead of recomputing the
          shuffle.  The choice for very large inputs.
        * ``persist`` keeps it with ``MEMORY_AND_DISK`` for the duration of
          the run (lost blocks are recomputed from lineage), unpersisted after.
        """
        spark = df.sparkSession
        with scratch_tables():  # the written input goes when the results are here
            source = df
            ours = False  # unpersist only what this run persisted
            if materialize_input or materialize_path:
                # Every column: a check may read any of them (size(array(*)), registered checks with own parameters).
                source = materialize(df, "suite-input", materialize_path)
            elif persist and not df.is_cached:
                source = df.persist(StorageLevel.MEMORY_AND_DISK)
                ours = True
            try:
                rows = self._collect(source, self.specs, written=source is not df)
            finally:
                if ours:
                    source.unpersist()
            ordinal = {s.name: i for i, s in enumerate(self.specs)}
            rows = [(*r[:-1], ordinal[r["check_name"]]) for r in rows]
            return spark.createDataFrame(sorted(rows, key=lambda r: r[-1]), R.RESULTS_SCHEMA)

    def _collect(self, df: DataFrame, specs: list[CheckSpec], written: bool) -> list:
        """Rows for ``specs``; where data breaks the plan, its halves, until the check at fault stands alone.

        A suite of n checks with f faulty ones takes about 2 f log2(n) plans.  The
        input is written before the first of them, so they read files, and a
        failure of the input itself is raised.  Anything that is no fault of
        the data (a lost executor, a full disk, a cancelled job) is raised as it is.
        """
        part = Suite(specs, base_dir=self.base_dir, references=self.references)
        try:
            return part.results(df).collect()
        except DATA_ERRORS as exc:
            error = exc
        if not written:
            df = materialize(df, "suite-input")
        if len(specs) == 1:
            total = int(df.count())
            row = R.error_result(specs[0], 0, str(total), _describe_error(error))
            return df.sparkSession.range(1).selectExpr(f"{row} AS __r").select("__r.*").select(*R.RESULT_COLUMNS, R.ORDINAL).collect()
        middle = len(specs) // 2
        return self._collect(df, specs[:middle], True) + self._collect(df, specs[middle:], True)


def keyed_items(compiled: Iterable[tuple[int, CheckSpec, object]]) -> dict[str, list]:
    """The uniqueness and referential checks by column."""
    keyed: dict[str, list] = {}
    for item in compiled:
        if isinstance(item[2], (GroupCheck, ReferenceCheck)):
            keyed.setdefault(item[2].column, []).append(item)
    return keyed


def fused_only(compiled: Iterable[tuple[int, CheckSpec, object]]) -> list[tuple[int, CheckSpec, object]]:
    return [c for c in compiled if not isinstance(c[2], (GroupCheck, ReferenceCheck))]


def in_suite_order(results: DataFrame) -> DataFrame:
    """One row per check: gathered into one partition and sorted there (a global sort would run every branch twice)."""
    return results.coalesce(1).sortWithinPartitions(R.ORDINAL).select(*R.RESULT_COLUMNS, R.ORDINAL)


def _expression(shape: object):
    if isinstance(shape, RowCheck):
        return shape.predicate
    if isinstance(shape, StatCheck):
        return shape.value
    return None


def run_checks(df: DataFrame, checks: Iterable[CheckSpec | Mapping[str, Any]], **kwargs: Any) -> DataFrame:
    """Lazy results for ``checks`` on ``df`` (shorthand for ``Suite(checks).results(df)``)."""
    return Suite(checks, **kwargs).results(df)


def compact(results: DataFrame, digits: int = 6) -> DataFrame:
    """Comparable core of a results frame: name, status, counts and rounded metric.

    ``violations`` is -1 where the check has no violation count (ERROR rows,
    statistics), so the column stays a plain non-NULL integer.
    """
    return results.select(
        "check_name",
        "status",
        F.coalesce(F.col("violations"), F.lit(-1).cast("bigint")).alias("violations"),
        "total_rows",
        F.round("metric", digits).alias("metric"),
    )
