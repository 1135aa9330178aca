"""The suite on a stream: one results set per micro-batch.

``foreachBatch`` hands each micro-batch over as an ordinary DataFrame, so the
same fused plan runs on it.  Each batch's results are written to
``<sink>/batch_id=<n>`` with overwrite, which makes a replayed batch (after
a failure, the checkpoint re-delivers it) idempotent instead of appending
duplicates.  The checkpoint and the sink live in the shared folder.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veracity.plans.suite import Suite
from veracity.session import scratch_path
from veracity.spec import CheckSpec


def suite_batch_writer(suite: Suite, sink: str):
    """A ``foreachBatch`` function writing each batch's results under ``sink``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        results = suite.results(batch).withColumn("batch_ts", F.current_timestamp())
        results.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    return write


def check_stream(
    stream: DataFrame,
    checks: Sequence[CheckSpec | Mapping[str, Any]],
    sink: str,
    checkpoint: str,
    *,
    available_now: bool = True,
    processing_time: str | None = None,
):
    """Start a streaming query that runs ``checks`` on every micro-batch; returns the query."""
    writer = stream.writeStream.foreachBatch(suite_batch_writer(Suite(checks), sink)).option(
        "checkpointLocation", checkpoint
    )
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def run_suite_on_stream(
    spark: SparkSession,
    path: str,
    checks: Sequence[CheckSpec | Mapping[str, Any]],
    *,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Stream the Parquet files at ``path`` once (available-now) and return all batch results."""
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    source = path.rstrip("/")
    if source.endswith(".parquet"):
        # A single file: the file source treats a plain path as a partition
        # base folder, so name the file through a glob matching only itself.
        source = f"{source[:-1]}[{source[-1]}]"
    stream = reader.parquet(source)
    base = scratch_path(spark, "stream")
    query = check_stream(stream, checks, f"{base}/results", f"{base}/checkpoint")
    query.awaitTermination()
    return spark.read.parquet(f"{base}/results")


def running_results(stream: DataFrame, checks: Sequence[CheckSpec | Mapping[str, Any]]) -> DataFrame:
    """Cumulative results over everything the stream has delivered so far.

    The fused aggregate of the row-level checks and statistics runs as a
    streaming global aggregation: the state store keeps one running buffer
    (counts, sums, moments), so state stays constant-size however long the
    stream runs.  Use with ``outputMode("complete")``.  Checks that need
    all keys ever seen (uniqueness, referential) are reported as ERROR here;
    run them per batch with ``check_stream``.
    """
    from veracity.operators.checks import ReferenceCheck, CheckError, GroupCheck
    from veracity.operators.fused import fused_results

    suite = Suite(checks)
    items = []
    for ordinal, spec, shape in suite.compile(stream):
        if isinstance(shape, (GroupCheck, ReferenceCheck)):
            shape = CheckError("needs every key seen so far; run it per micro-batch (check_stream)")
        items.append((ordinal, spec, shape))
    return fused_results(stream, items)


def run_running_results(
    spark: SparkSession,
    path: str,
    checks: Sequence[CheckSpec | Mapping[str, Any]],
    *,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Stream the Parquet files at ``path`` once and return the final running results."""
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    source = path.rstrip("/")
    if source.endswith(".parquet"):
        source = f"{source[:-1]}[{source[-1]}]"
    base = scratch_path(spark, "running")
    sink = f"{base}/results"

    def write(batch: DataFrame, batch_id: int) -> None:
        # complete mode: every batch carries the full running totals
        batch.write.mode("overwrite").parquet(sink)

    query = (
        running_results(reader.parquet(source), checks)
        .writeStream.outputMode("complete")
        .foreachBatch(write)
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.parquet(sink)
