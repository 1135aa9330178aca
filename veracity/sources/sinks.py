"""Result sinks: reports and the append-only results log.

Results are a DataFrame, so every sink is a DataFrame writer: Parquet, JSON
lines and CSV reports, an appended Parquet / catalog table, or JDBC.  Non-
finite metrics (NaN, ±Inf) become NULL before any sink, since neither JSON
nor a SQL DOUBLE column round-trips them reliably.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veracity.functions.columns import non_finite_to_null
from veracity.functions.render import ORDINAL, RESULT_COLUMNS, RESULTS_SCHEMA
from veracity.session import materialize, scratch_tables

REPORT_COLUMNS = ["check_name", "timestamp", "status", "metric", "message", "parameters", "details"]
RUN_COLUMNS = ["run_id", "run_ts", "data_source"]
LOG_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("run_ts", T.TimestampType()),
        T.StructField("data_source", T.StringType()),
        *RESULTS_SCHEMA.fields,
        T.StructField("run_date", T.DateType()),
    ]
)
LOG_PARTITION = "run_date"
ATTEMPT = "attempt"


def sanitize(results: DataFrame) -> DataFrame:
    """NaN / ±Inf metric → NULL."""
    return results.withColumn("metric", non_finite_to_null(F.col("metric")))


def with_run_columns(
    results: DataFrame,
    run_id: str,
    run_ts: _dt.datetime | None = None,
    data_source: str | None = None,
) -> DataFrame:
    """Prefix ``run_id``, ``run_ts`` (one timestamp for the whole run) and ``data_source``."""
    ts = F.lit(run_ts).cast("timestamp") if run_ts is not None else F.current_timestamp()
    cols = [c for c in RESULT_COLUMNS + [ORDINAL] if c in results.columns]
    return sanitize(results).select(
        F.lit(run_id).cast("string").alias("run_id"),
        ts.alias("run_ts"),
        F.lit(data_source).cast("string").alias("data_source"),
        *cols,
    )


def report_frame(results: DataFrame, run_ts: _dt.datetime | None = None) -> DataFrame:
    """The report entry: name, timestamp, status, metric, message, parameters, details."""
    ts = F.lit(run_ts).cast("timestamp") if run_ts is not None else F.current_timestamp()
    out = sanitize(results).withColumn("timestamp", ts)
    if ORDINAL in results.columns:
        out = out.select(*REPORT_COLUMNS, ORDINAL)
    else:
        out = out.select(*REPORT_COLUMNS)
    return out


_CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true", "encoding": "UTF-8"}


def write_results(
    results: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partitions: int | None = None,
) -> None:
    """Write a results (or report / log) frame as ``parquet``, ``json`` or ``csv``.

    ``partitions`` optionally coalesces first; the default keeps Spark's
    partitioning (results are tiny, but logs grow with every run).
    """
    df = sanitize(results) if "metric" in results.columns else results
    if partitions:
        df = df.coalesce(partitions)
    writer = df.write.mode(mode)
    if fmt == "parquet":
        writer.parquet(path)
    elif fmt == "json":
        writer.option("ignoreNullFields", "false").json(path)
    elif fmt == "csv":
        writer.options(**_CSV_OPTIONS).csv(path)
    else:
        raise ValueError(f"unknown format '{fmt}' (parquet, json, csv)")


def read_results(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType = RESULTS_SCHEMA) -> DataFrame:
    """Read back what ``write_results`` wrote, with the declared schema (no inference)."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    if fmt == "json":
        return spark.read.schema(schema).json(path)
    if fmt == "csv":
        return spark.read.schema(schema).options(**_CSV_OPTIONS).csv(path)
    raise ValueError(f"unknown format '{fmt}' (parquet, json, csv)")


def write_report(
    results: DataFrame,
    directory: str,
    formats: Sequence[str] = ("json",),
    run_ts: _dt.datetime | None = None,
    partitions: int | None = 1,
) -> dict[str, str]:
    """Write the report entries once per format under ``directory/<format>``.

    A report has one row per check, so by default it is one file per format
    (``partitions=None`` keeps the frame's own partitioning).
    """
    written = {}
    with scratch_tables():
        report = materialize(report_frame(results, run_ts), "report")  # the suite runs once, whatever the formats
        for fmt in formats:
            target = f"{directory.rstrip('/')}/{fmt}"
            write_results(report, target, fmt, partitions=partitions)
            written[fmt] = target
    return written


# The columns of the log table that existing dashboards read, and what fills them.
DASHBOARD_COLUMNS = {
    "check_name": "check_name", "dq_check_timestamp": "run_ts", "status": "status", "metric": "metric", "message": "message",
    "parameters": "parameters", "details": "details", "data_source": "data_source", "pipeline_run_id": "run_id",
    "check_run_timestamp": "run_ts",
}


def for_table(rows: DataFrame, columns: Mapping[str, str] = DASHBOARD_COLUMNS) -> DataFrame:
    """Log rows in the layout of an existing table: its column names, each from one of ours."""
    return rows.select(*[F.col(ours).alias(theirs) for theirs, ours in columns.items()])


def append_results_log(
    results: DataFrame,
    target: str,
    run_id: str,
    run_ts: _dt.datetime | None = None,
    data_source: str | None = None,
    *,
    kind: str = "parquet",
    jdbc_properties: Mapping[str, str] | None = None,
    jdbc_columns: Mapping[str, str] | None = None,
) -> DataFrame:
    """Append one run to the results log and return its rows.

    ``kind``: ``parquet`` (``target`` is a folder) or ``table`` (a catalog table,
    created on first append).  The rows are written as an *attempt* of their
    own; the run counts once a line naming the attempt is in the ledger
    (``<target>/ledger`` or the table ``<target>_ledger``).  Both writes only add
    files, so a writer lost on the way leaves the log as it was, and a run
    repeated under its id, on whatever date, takes the place of its earlier
    attempt: ``read_results_log`` shows the last committed one.

    ``jdbc`` (``target`` is ``url|table``) is a plain append in one transaction:
    a run repeated there is there twice.  ``jdbc_columns`` maps the columns of
    an existing table to ours (``for_table``).
    """
    rows = with_run_columns(results, run_id, run_ts, data_source)
    if kind == "jdbc":
        url, _, table = target.partition("|")
        rows = for_table(rows, jdbc_columns) if jdbc_columns else rows
        rows.coalesce(1).write.jdbc(url, table, mode="append", properties=dict(jdbc_properties or {}))
        return rows
    if kind not in ("parquet", "table"):
        raise ValueError(f"unknown results log kind '{kind}'")
    spark, attempt = results.sparkSession, uuid.uuid4().hex
    # One run is one row per check: a single file, in the folder of its date, so history over a range of dates reads only that.
    dated = rows.withColumn(LOG_PARTITION, F.to_date("run_ts")).withColumn(ATTEMPT, F.lit(attempt)).coalesce(1)
    writer = dated.write.mode("append").partitionBy(LOG_PARTITION)
    line = spark.range(1, numPartitions=1).select(F.lit(run_id).alias("run_id"), F.lit(attempt).alias(ATTEMPT),
                                                  F.current_timestamp().alias("committed"))
    if kind == "parquet":
        writer.parquet(f"{target.rstrip('/')}/rows")
        line.write.mode("append").parquet(f"{target.rstrip('/')}/ledger")
    else:
        writer.saveAsTable(target)
        line.write.mode("append").saveAsTable(f"{target}_ledger")
    return rows


def read_results_log(spark: SparkSession, target: str, kind: str = "parquet") -> DataFrame:
    """The last committed attempt of every run, with the log's declared columns."""
    if kind == "table":
        rows, ledger = spark.table(target), spark.table(f"{target}_ledger")
    else:
        schema = T.StructType([*LOG_SCHEMA.fields, T.StructField(ATTEMPT, T.StringType())])
        rows = spark.read.schema(schema).parquet(f"{target.rstrip('/')}/rows")
        ledger = spark.read.schema(f"run_id string, {ATTEMPT} string, committed timestamp").parquet(f"{target.rstrip('/')}/ledger")
    last = ledger.groupBy("run_id").agg(F.max_by(ATTEMPT, F.struct("committed", ATTEMPT)).alias(ATTEMPT))
    return rows.join(last, ["run_id", ATTEMPT], "left_semi").select(*LOG_SCHEMA.fieldNames())
