"""Config-driven runs: the reference's configuration shape, executed as Spark jobs.

A config is a mapping (YAML or JSON text, or a dict) with

* ``data_source`` — Parquet path (a missing path falls back to
  ``synthetic_data.parquet`` beside it), relative paths resolved against
  ``base_dir``;
* ``checks`` — the check list (``check_name``, ``check_type``, ``sub_type``,
  ``params``);
* optional ``cleaning`` — ``false`` to check the raw data; otherwise the
  transaction cleaning rules and keep-latest dedup run first, with
  ``cleaning.dedup`` overriding ``key`` / ``order_by`` / ``tiebreak``;
* optional ``reporting`` — ``output_formats`` (default ``["json"]``),
  ``report_dir``, ``report_filename_prefix``;
* optional ``database_logging`` — ``enabled``, and where to append: ``path``
  (Parquet), ``jdbc_url`` + ``table_name`` (a JDBC URL in the environment variable
  ``DB_CONNECTION_STRING`` comes before ``jdbc_url``; ``columns`` maps the table's
  columns to the log's), or just ``table_name`` (catalog table).

Reading the config file is the only driver-side I/O; everything else is a
DataFrame job.
"""

from __future__ import annotations

import datetime as _dt
import json
import os
import uuid
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veracity.functions.columns import quote
from veracity.operators.clean import clean_transactions
from veracity.operators.dedup import keep_latest
from veracity.plans.suite import Suite
from veracity.sources import sinks
from veracity.sources.readers import read_with_single_file_fallback


# Where existing configs expect the log.
LOG_TABLE = "dq_results_log"
CONNECTION_VARIABLE = "DB_CONNECTION_STRING"


def parse_config(text: str) -> dict:
    """YAML when PyYAML is installed (JSON is valid YAML), JSON otherwise."""
    try:
        import yaml
    except ImportError:  # pragma: no cover - depends on the environment
        return json.loads(text)
    return yaml.safe_load(text)


def load_config(path: str) -> dict:
    with open(path, encoding="utf-8") as fh:
        return parse_config(fh.read())


def _resolve(path: str, base_dir: str | None) -> str:
    if base_dir and "://" not in path and not os.path.isabs(path):
        return os.path.join(base_dir, path)
    return path


def row_hash(df: DataFrame) -> Column:
    """A deterministic tie-break over all columns: equal rows hash equal, others almost never do."""
    return F.xxhash64(*[F.col(quote(c)) for c in df.columns])


def prepare(raw: DataFrame, cleaning: Any) -> DataFrame:
    """Apply the configured cleaning and dedup (or none)."""
    if cleaning is False:
        return raw
    opts = cleaning if isinstance(cleaning, Mapping) else {}
    cleaned = clean_transactions(raw)
    dedup = opts.get("dedup", {})
    if dedup is False:
        return cleaned
    tiebreak = dedup.get("tiebreak")
    if not tiebreak:
        cleaned = cleaned.withColumn("__veracity_row_hash", row_hash(cleaned))
        tiebreak = "__veracity_row_hash"
    out = keep_latest(cleaned, dedup.get("key", "transaction_id"), dedup.get("order_by", "start_date"), tiebreak)
    return out.drop("__veracity_row_hash")


def run_config(
    spark: SparkSession,
    config: Mapping[str, Any] | str,
    *,
    base_dir: str | None = None,
    run_id: str | None = None,
    run_ts: _dt.datetime | None = None,
) -> DataFrame:
    """Run a whole configured pipeline eagerly; returns the results DataFrame."""
    if isinstance(config, str):
        config = load_config(config) if os.path.exists(config) else parse_config(config)
    source = config.get("data_source")
    if not source:
        raise ValueError("config needs 'data_source'")
    source = _resolve(source, base_dir)
    raw = read_with_single_file_fallback(spark, source)
    prepared = prepare(raw, config.get("cleaning", True))
    suite = Suite(config.get("checks") or [], base_dir=base_dir)
    results = suite.run(prepared, materialize_input=True)

    run_ts = run_ts or _dt.datetime.now().replace(microsecond=0)
    run_id = run_id or str(uuid.uuid4())
    reporting = config.get("reporting")
    if reporting:
        folder = _resolve(reporting.get("report_dir", "reports"), base_dir)
        prefix = reporting.get("report_filename_prefix", "dq_report")
        stamp = run_ts.strftime("%Y%m%d_%H%M%S")
        sinks.write_report(results, f"{folder}/{prefix}_{stamp}", reporting.get("output_formats", ["json"]), run_ts)
    logging = config.get("database_logging") or {}
    if logging.get("enabled"):
        table = logging.get("table_name", LOG_TABLE)
        url = os.environ.get(CONNECTION_VARIABLE) or logging.get("jdbc_url")
        if logging.get("path"):
            sinks.append_results_log(results, _resolve(logging["path"], base_dir), run_id, run_ts, source)
        elif url:
            sinks.append_results_log(results, f"{url}|{table}", run_id, run_ts, source, kind="jdbc",
                                     jdbc_properties=logging.get("properties"), jdbc_columns=logging.get("columns"))
        else:
            sinks.append_results_log(results, table, run_id, run_ts, source, kind="table")
    return results
