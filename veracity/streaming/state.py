"""A suite over everything a stream has delivered so far, uniqueness and references included.

Each micro-batch is reduced once to mergeable states, and never read again:

* one row of counts and moments for all row checks and statistics
  (``fused_state``),
* the rows per ``(column, key)`` of all keyed checks (``key_state``).

They go to ``batch_id=<n>`` folders, written with overwrite, keys first: the
row of counts is what commits a batch, so a batch that failed half-way does
not count, and one delivered again replaces itself.  Results merge the states
of all committed batches and compare the keys with the references as they are
then.

After ``compact_every`` batches the states are merged into a new generation,
which counts from the moment its row of counts is there; batches up to its own
are then ignored when they come again.  So folders do not pile up, and the
state holds one row per distinct key however long the stream runs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from veracity.operators.checks import CheckError
from veracity.operators.fused import fused_results_of_state, fused_state, merged_fused_state
from veracity.operators.keyed import key_parts, key_state, keyed_results_of_state, merged_key_state
from veracity.plans.suite import Suite, fused_only, in_suite_order, keyed_items
from veracity.session import delete_path, list_folder
from veracity.spec import CheckSpec

BATCH = "batch_id"


class SuiteState:
    """The running state of one suite under ``path`` (a folder all executors share)."""

    def __init__(self, spark: SparkSession, checks: Sequence[CheckSpec | Mapping[str, Any]], like: DataFrame, path: str,
                 *, compact_every: int = 100):
        """``like`` has the columns of the batches, such as the stream itself."""
        self.spark, self.path, self.compact_every = spark, path.rstrip("/"), compact_every
        compiled = Suite(checks).compile(like)
        self.keyed = keyed_items(compiled)
        self.fused = fused_only(compiled)
        for column in [c for c, items in self.keyed.items() if not key_parts("k", items[0][2].dtype)]:
            self.fused += [(i, spec, CheckError(f"values of '{column}' cannot be kept as state")) for i, spec, _ in self.keyed.pop(column)]
        self.generation, self.merged_to = self._latest()
        for name in list_folder(spark, self.path):  # generations merged before a driver was lost
            if name.startswith("gen=") and int(name.partition("=")[2]) < self.generation:
                delete_path(spark, f"{self.path}/{name}")

    def _folder(self, kind: str, generation: int | None = None) -> str:
        return f"{self.path}/gen={self.generation if generation is None else generation}/{kind}"

    def _batches(self, kind: str, generation: int) -> list[int]:
        """Batches whose write has ended."""
        folder = self._folder(kind, generation)
        names = [n for n in list_folder(self.spark, folder) if n.startswith(f"{BATCH}=")]
        return sorted(int(n.partition("=")[2]) for n in names if "_SUCCESS" in list_folder(self.spark, f"{folder}/{n}"))

    def _latest(self) -> tuple[int, int]:
        """The newest committed generation and the last batch merged into it (-1: none)."""
        found = sorted((int(n.partition("=")[2]) for n in list_folder(self.spark, self.path) if n.startswith("gen=")), reverse=True)
        for generation in found:
            batches = self._batches("counts", generation)
            if generation == 0 or batches:
                return generation, batches[0] if generation else -1
        return 0, -1

    def add(self, batch: DataFrame, batch_id: int) -> None:
        """Reduce a micro-batch to its states; one that is there already is replaced, one merged already is ignored."""
        if batch_id <= self.merged_to:
            return
        if self.keyed:
            key_state(batch, self.keyed).write.mode("overwrite").parquet(f"{self._folder('keys')}/{BATCH}={batch_id}")
        fused_state(batch, self.fused).write.mode("overwrite").parquet(f"{self._folder('counts')}/{BATCH}={batch_id}")
        if len(self._batches("counts", self.generation)) > self.compact_every:
            self.compact()

    def _read(self, kind: str) -> DataFrame:
        committed = self._batches("counts", self.generation)
        folder = self._folder(kind)
        parts = [f"{folder}/{BATCH}={b}" for b in committed]
        return self.spark.read.option("basePath", folder).parquet(*parts)

    def compact(self) -> None:
        """Merge all committed batches into a new generation and delete the old one."""
        committed = self._batches("counts", self.generation)
        if not committed:
            return
        old, last, new = self.generation, committed[-1], self.generation + 1
        if self.keyed:
            merged_key_state(self._read("keys")).write.mode("overwrite").parquet(f"{self._folder('keys', new)}/{BATCH}={last}")
        merged = merged_fused_state(self._read("counts"), self.fused, BATCH)
        merged.write.mode("overwrite").parquet(f"{self._folder('counts', new)}/{BATCH}={last}")
        self.generation, self.merged_to = new, last
        delete_path(self.spark, f"{self.path}/gen={old}")

    def results(self) -> DataFrame:
        """One result row per check over all committed batches, as the suite gives on all their rows."""
        if not self._batches("counts", self.generation):
            raise LookupError(f"no batch has been committed under {self.path}")
        parts = []
        if self.fused:
            parts.append(fused_results_of_state(merged_fused_state(self._read("counts"), self.fused, BATCH), self.fused))
        if self.keyed:
            parts.append(keyed_results_of_state(self._read("keys"), self.keyed))
        return in_suite_order(reduce(DataFrame.unionByName, parts))


def check_stream_so_far(
    stream: DataFrame,
    checks: Sequence[CheckSpec | Mapping[str, Any]],
    path: str,
    checkpoint: str,
    *,
    compact_every: int = 100,
    processing_time: str | None = None,
):
    """Start a query that keeps the suite's state under ``path``; returns ``(query, state)``.

    ``state.results()`` may be asked at any time.  Without ``processing_time`` the
    query takes what is there now and ends.
    """
    state = SuiteState(stream.sparkSession, checks, stream, path, compact_every=compact_every)
    writer = stream.writeStream.foreachBatch(state.add).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)
    return writer.start(), state
