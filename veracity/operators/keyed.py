"""Keyed checks: one count of ``(column, key)`` for every keyed check of a suite.

Uniqueness and referential integrity both need, per key value of a column,
how many checked rows carry it; referential integrity also needs whether the
reference carries it.  Each checked row becomes one small row per keyed
column, ``(column number, key)``, the references add theirs, and a single
partial-first aggregate counts them all: one read of the input and one shuffle
of pre-aggregated keys, however many columns are keyed.  A hot key on any side
collapses to one row per map task.  A second, global aggregate turns the
counts into every check's violations, and the rows are unpivoted like the
fused pass.

* **Keys of a bounded size.**  Integers, dates and timestamps travel as
  ``bigint``; other values as text, and text longer than ``INLINE_BYTES`` as its
  length and 256-bit digest, so no long text enters the exchange.
* **References of integer keys.**  A column that only referential checks use is
  decided where it is read, by an exact bitmap of the reference's keys
  (``bitmap.py``): only absent keys enter the aggregate.
* Values that have no such form (arrays, structs, collated text) are counted by
  value, one co-grouped aggregate per column (``side_counts``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veracity.functions import render as R
from veracity.operators.bitmap import is_integer, key_bitmap, with_presence
from veracity.operators.checks import ReferenceCheck, GroupCheck
from veracity.spec import CheckSpec

KEY, SIDE = "__key", "__side"
COLUMN, NUMBER, TEXT, PRESENT, ROWS = "__column", "__number", "__text", "__present", "__rows"
FAILED = "__failed"
INLINE_BYTES = 32
_ROWS = -1  # the column number under which the rows themselves are counted

KeyedItem = tuple[int, CheckSpec, GroupCheck | ReferenceCheck]


_NO_NUMBER, _NO_TEXT = "CAST(NULL AS BIGINT)", "CAST(NULL AS STRING)"


def key_parts(k: str, dtype: T.DataType | None) -> tuple[str, str] | None:
    """SQL for ``(bigint, string)``, equal exactly where values of ``k`` are one group; both NULL for NULL; None: no such form."""
    if is_integer(dtype):
        return f"CAST({k} AS BIGINT)", _NO_TEXT
    if isinstance(dtype, T.DateType):
        return f"CAST(unix_date({k}) AS BIGINT)", _NO_TEXT
    if isinstance(dtype, T.TimestampType):
        return f"unix_micros({k})", _NO_TEXT
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return _NO_NUMBER, f"CAST({k} + CAST(0 AS {dtype.simpleString()}) AS STRING)"  # -0.0 and 0.0 are one value
    if isinstance(dtype, (T.DecimalType, T.BooleanType, T.TimestampNTZType)):
        return _NO_NUMBER, f"CAST({k} AS STRING)"
    if dtype == T.StringType() or isinstance(dtype, (T.BinaryType, T.CharType, T.VarcharType)):
        short = f"hex({k})" if isinstance(dtype, T.BinaryType) else k
        return _NO_NUMBER, (f"CASE WHEN octet_length({k}) <= {INLINE_BYTES} THEN concat('=', {short}) WHEN {k} IS NOT NULL "
                            f"THEN concat('#', CAST(octet_length({k}) AS STRING), ':', sha2(CAST({k} AS BINARY), 256)) END")
    return None


@dataclass
class _Keyed:
    """One keyed column: its number, key and the references it is compared with."""

    number: int
    key: Column
    dtype: T.DataType | None
    references: list[tuple[DataFrame, Column]] = field(default_factory=list)
    side_of: dict[int, int] = field(default_factory=dict)  # ordinal of a check -> side of its reference
    bitmaps: list[DataFrame] = field(default_factory=list)


def _sides(items: Sequence[KeyedItem], column: _Keyed) -> None:
    seen: dict[object, int] = {}  # the same reference key column is read once
    for ordinal, _, shape in items:
        if isinstance(shape, ReferenceCheck):
            table = id(shape.reference) if shape.reference_label.startswith("<") else shape.reference_label
            ident = (table, str(shape.reference_key))  # two columns of one table are two sides
            if ident not in seen:
                column.references.append((shape.reference, shape.reference_key))
                seen[ident] = len(column.references)
            column.side_of[ordinal] = seen[ident]


def _bitmaps(column: _Keyed, items: Sequence[KeyedItem]) -> list[DataFrame]:
    """A bitmap per reference when they can decide the column alone, else none."""
    if not is_integer(column.dtype) or any(isinstance(shape, GroupCheck) for _, _, shape in items):
        return []
    bitmaps = []
    for reference, key in column.references:
        bitmap = key_bitmap(reference, key)
        if bitmap is None:
            return []
        bitmaps.append(bitmap)
    return bitmaps


def _entry(number: int, parts: tuple[str, str], side: int, present: Sequence[str]) -> str:
    fields = [(COLUMN, str(number)), (NUMBER, parts[0]), (TEXT, parts[1]), (SIDE, str(side)),
              *[(f"{PRESENT}{j}", p) for j, p in enumerate(present, start=1)]]
    return "named_struct(" + ", ".join(f"'{name}', {value}" for name, value in fields) + ")"


def _spread(df: DataFrame, entries: Sequence[str]) -> DataFrame:
    """One row per entry that is not NULL."""
    if len(entries) == 1:
        return df.selectExpr(f"{entries[0]} AS __e").where("__e IS NOT NULL").select("__e.*")
    return df.selectExpr(f"inline(array_compact(array({', '.join(entries)})))")


def _entries(df: DataFrame, columns: Sequence[_Keyed], sides: int) -> DataFrame:
    """The small rows of the checked table and of every reference."""
    unknown = "CAST(NULL AS BOOLEAN)"
    marked, entries = df.select(*[c.key.alias(f"{KEY}{c.number}") for c in columns]), []
    for c in columns:
        k = f"{KEY}{c.number}"
        for j, bitmap in enumerate(c.bitmaps, start=1):
            marked = with_presence(marked, k, bitmap, f"{k}_{j}")
        held = [f"{k}_{j}" if j <= len(c.bitmaps) else unknown for j in range(1, sides + 1)]
        entry = _entry(c.number, key_parts(k, c.dtype), 0, held)
        if c.bitmaps:  # a key every reference holds violates nothing
            entry = f"CASE WHEN NOT coalesce({' AND '.join(held[:len(c.bitmaps)])}, false) THEN {entry} END"
        entries.append(entry)
    if all(c.bitmaps for c in columns):
        entries.append(_entry(_ROWS, (_NO_NUMBER, _NO_TEXT), 0, [unknown] * sides))
    out = _spread(marked, entries)
    for c in columns:
        for j, (reference, key) in enumerate([] if c.bitmaps else c.references, start=1):
            entry = _entry(c.number, key_parts(KEY, c.dtype), j, [unknown] * sides)
            out = out.unionByName(_spread(reference.select(key.alias(KEY)).where(f"{KEY} IS NOT NULL"), [entry]))
    return out


def _group_result(spec: CheckSpec, ordinal: int, column: str) -> str:
    return R.ratio_result(spec, ordinal, f"__v{ordinal}", "__total", f"hold values that occur more than once in '{column}'",
                          {"duplicate_values": f"__d{ordinal}"})


def _reference_result(spec: CheckSpec, ordinal: int, column: str, shape: ReferenceCheck) -> str:
    nulls = "" if shape.nulls_violate else " (NULL keys ignored)"
    return R.ratio_result(spec, ordinal, f"__v{ordinal}", "__total",
                          f"have a '{column}' not found in {shape.reference_label}{nulls}", {"missing_keys": f"__m{ordinal}"})


def _sum(condition: str, rows: str) -> str:
    return f"coalesce(sum(CASE WHEN {condition} THEN {rows} END), 0L)"


def _columns(items_of: dict[str, list[KeyedItem]]) -> dict[str, _Keyed]:
    columns = {}
    for number, (name, items) in enumerate(items_of.items()):
        columns[name] = _Keyed(number, items[0][2].key, items[0][2].dtype)
        _sides(items, columns[name])
    return columns


def _finish(counts: DataFrame, columns: dict[str, _Keyed], items_of: dict[str, list[KeyedItem]]) -> DataFrame:
    """Result rows from one row per ``(column, key)`` with ``__n0`` checked rows and what the references hold."""
    real = f"({NUMBER} IS NOT NULL OR {TEXT} IS NOT NULL)"
    counter = next((c.number for c in columns.values() if not c.bitmaps), _ROWS)
    aggs, structs = [f"{_sum(f'{COLUMN} = {counter}', '__n0')} AS __total"], []
    for name, items in items_of.items():
        column = columns[name]
        mine = f"{COLUMN} = {column.number}"
        for ordinal, spec, shape in items:
            if isinstance(shape, GroupCheck):
                dup = f"{mine} AND {real} AND __n0 > 1"
                aggs += [f"{_sum(dup, '__n0')} AS __v{ordinal}", f"count_if({dup}) AS __d{ordinal}"]
                structs.append(_group_result(spec, ordinal, name))
            else:
                j = column.side_of[ordinal]
                held = f"{PRESENT}{j}" if column.bitmaps else f"__n{j} > 0"
                absent = f"{mine} AND {real} AND __n0 > 0 AND NOT ({held})"
                counted = f"({absent}) OR ({mine} AND NOT {real})" if shape.nulls_violate else absent
                aggs += [f"{_sum(counted, '__n0')} AS __v{ordinal}", f"count_if({absent}) AS __m{ordinal}"]
                structs.append(_reference_result(spec, ordinal, name, shape))
    return counts.agg(*map(F.expr, aggs)).selectExpr(f"inline(array({', '.join(structs)}))")


def keyed_results(df: DataFrame, items_of: dict[str, list[KeyedItem]]) -> DataFrame:
    """Result rows for every uniqueness / referential check, by column, in one pass over ``df``.

    Every column must have a ``key_parts`` form.
    """
    columns = _columns(items_of)
    for name, items in items_of.items():
        columns[name].bitmaps = _bitmaps(columns[name], items)
    sides = max(len(c.references) for c in columns.values())
    counts = _entries(df, list(columns.values()), sides).groupBy(COLUMN, NUMBER, TEXT).agg(
        *[F.expr(f"count_if({SIDE} = {j}) AS __n{j}") for j in range(sides + 1)],
        *[F.expr(f"max({PRESENT}{j}) AS {PRESENT}{j}") for j in range(1, sides + 1)])  # equal for all rows of a key
    return _finish(counts, columns, items_of)


def key_state(df: DataFrame, items_of: dict[str, list[KeyedItem]]) -> DataFrame:
    """``(column, number, text, n)``: the checked rows of each key, to be added up with those of other rows."""
    columns = [replace(c, references=[]) for c in _columns(items_of).values()]
    return _entries(df, columns, 0).groupBy(COLUMN, NUMBER, TEXT).agg(F.count(F.lit(1)).alias(ROWS))


def merged_key_state(states: DataFrame) -> DataFrame:
    return states.groupBy(COLUMN, NUMBER, TEXT).agg(F.sum(ROWS).alias(ROWS))


def keyed_results_of_state(states: DataFrame, items_of: dict[str, list[KeyedItem]]) -> DataFrame:
    """The results ``keyed_results`` gives on all rows whose ``key_state`` is in ``states``."""
    columns = _columns(items_of)
    sides = max(len(c.references) for c in columns.values())
    rows = states.select(COLUMN, NUMBER, TEXT, F.lit(0).alias(SIDE), ROWS)
    for c in columns.values():
        for j, (reference, key) in enumerate(c.references, start=1):
            rows = rows.unionByName(_spread(reference.select(key.alias(KEY)).where(f"{KEY} IS NOT NULL"), [
                _entry(c.number, key_parts(KEY, c.dtype), j, [])]).withColumn(ROWS, F.lit(1).cast("bigint")))
    counts = rows.groupBy(COLUMN, NUMBER, TEXT).agg(*[
        F.expr(f"coalesce(sum(CASE WHEN {SIDE} = {j} THEN {ROWS} END), 0L) AS __n{j}") for j in range(sides + 1)])
    return _finish(counts, columns, items_of)


def violating_keys(df: DataFrame, items_of: dict[str, list[KeyedItem]]) -> DataFrame:
    """``(column, number, text, n, failed)``: keys whose rows fail checks, and the names of those; NULL keys too."""
    columns = _columns(items_of)
    sides = max(len(c.references) for c in columns.values())
    counts = _entries(df, list(columns.values()), sides).groupBy(COLUMN, NUMBER, TEXT).agg(
        *[F.expr(f"count_if({SIDE} = {j}) AS __n{j}") for j in range(sides + 1)])
    real, failed = f"({NUMBER} IS NOT NULL OR {TEXT} IS NOT NULL)", []
    for name, items in items_of.items():
        for _, spec, shape in items:
            if isinstance(shape, GroupCheck):
                bad = f"{real} AND __n0 > 1"
            else:
                bad = f"{real} AND __n{columns[name].side_of[_]} = 0"
                bad = f"({bad}) OR NOT {real}" if shape.nulls_violate else bad
            failed.append(f"CASE WHEN {COLUMN} = {columns[name].number} AND ({bad}) THEN {R.s_str(spec.name)} END")
    return counts.where("__n0 > 0").selectExpr(
        COLUMN, NUMBER, TEXT, f"__n0 AS {ROWS}", f"array_compact(array({', '.join(failed)})) AS {FAILED}").where(f"size({FAILED}) > 0")


def side_counts(df: DataFrame, key: Column, references: Sequence[tuple[DataFrame, Column]]) -> DataFrame:
    """``(__key, __n0, __n1, ...)``: rows per key value in ``df`` and in each reference (keys of one type)."""
    union = df.select(key.alias(KEY), F.lit(0).alias(SIDE))
    for j, (ref, ref_key) in enumerate(references, start=1):
        union = union.unionByName(ref.select(ref_key.alias(KEY), F.lit(j).alias(SIDE)).where(F.col(KEY).isNotNull()))
    return union.groupBy(KEY).agg(*[F.count_if(F.col(SIDE) == j).alias(f"__n{j}") for j in range(len(references) + 1)])


def keyed_results_by_value(df: DataFrame, name: str, items: Sequence[KeyedItem]) -> DataFrame:
    """Result rows for the checks on one column whose values are grouped as they are."""
    column = _Keyed(0, items[0][2].key, None)
    _sides(items, column)
    counts = side_counts(df, column.key, column.references)
    aggs, structs = ["coalesce(sum(__n0), 0L) AS __total"], []
    for ordinal, spec, shape in items:
        if isinstance(shape, GroupCheck):
            dup = f"{KEY} IS NOT NULL AND __n0 > 1"
            aggs += [f"{_sum(dup, '__n0')} AS __v{ordinal}", f"count_if({dup}) AS __d{ordinal}"]
            structs.append(_group_result(spec, ordinal, name))
        else:
            absent = f"{KEY} IS NOT NULL AND __n0 > 0 AND __n{column.side_of[ordinal]} = 0"
            counted = f"({absent}) OR {KEY} IS NULL" if shape.nulls_violate else absent
            aggs += [f"{_sum(counted, '__n0')} AS __v{ordinal}", f"count_if({absent}) AS __m{ordinal}"]
            structs.append(_reference_result(spec, ordinal, name, shape))
    return counts.agg(*map(F.expr, aggs)).selectExpr(f"inline(array({', '.join(structs)}))")
