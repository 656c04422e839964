"""The keyed-state operators on a stream.

Each micro-batch runs the same skew-safe plan as a batch, with the state read from, and its changes appended
to, a versioned table in a shared folder. A version is written under its batch id, and batch N reads only
versions below N, so a replayed batch finds the same state and overwrites the same output: exactly once.

A batch costs what its keys cost: only the state of keys that occur in it is merged, compared and written. State files
are sorted by buckets of the key's hash, so that a batch of few keys also reads few of their row groups.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.state import Stateful, assign_sequence, check_state, hold_key, hold_release
from ..session import child_names, delete_path, path_exists

BUCKET = "_rv_bucket"


@dataclass(frozen=True)
class Step:
    """What a micro-batch does with the state before it; ``key`` makes the column with the state key of each of its rows."""

    key: Callable[[], Column]
    run: Callable[[DataFrame, "DataFrame | None"], Stateful]

    def __call__(self, batch: DataFrame, before: DataFrame | None) -> Stateful:
        return self.run(batch, before)


class StateTable:
    """Per-key state as deltas by batch, with a full version every ``compact_every`` batches.

    Compaction rewrites the whole state once in ``compact_every`` batches. Versions that not even a replay of the
    current batch needs are removed.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, compact_every: int = 10, buckets: int = 256):
        self.spark = spark
        self.path = path
        self.key = key
        self.compact_every = compact_every
        self.buckets = buckets

    def _found(self, before: int) -> tuple[list[tuple[int, str, str]], int]:
        """Finished versions below a batch as (number, kind, folder), and the number of the newest full one."""
        found = []
        for name in child_names(self.spark, self.path):
            kind, _, number = name.partition("-")
            if kind in ("full", "delta") and number.isdigit() and int(number) < before:
                # A folder without its success marker is an unfinished write.
                if path_exists(self.spark, os.path.join(self.path, name, "_SUCCESS")):
                    found.append((int(number), kind, name))
        return found, max((n for n, kind, _ in found if kind == "full"), default=-1)

    def _bucket(self, key: str) -> Column:
        return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(self.buckets)).cast("int")

    def read(self, before: int, keys: DataFrame | None = None) -> DataFrame | None:
        """State as it was before a batch, of the given keys if any are given; None before the first batch."""
        found, full = self._found(before)
        chosen = sorted((n, name) for n, kind, name in found if n > full or (n == full and kind == "full"))
        parts = [
            self.spark.read.parquet(os.path.join(self.path, name)).withColumn("_rv_version", F.lit(n)) for n, name in chosen
        ]
        if not parts:
            return None
        merged = parts[0]
        for part in parts[1:]:
            merged = merged.unionByName(part)
        if keys is not None:
            asked = keys.select(F.col(self.key).cast("string").alias("_rv_asked")).distinct()
            # at most as many rows as there are buckets
            touched = [r[0] for r in asked.select(self._bucket("_rv_asked")).distinct().collect()]
            if len(touched) < self.buckets:
                merged = merged.filter(F.col(BUCKET).isin(touched))
            merged = merged.join(asked, merged[self.key].eqNullSafe(asked["_rv_asked"]), "left_semi")
        values = [c for c in merged.columns if c not in (self.key, "_rv_version", BUCKET)]
        newest = F.max_by(F.struct(*values), "_rv_version").alias("_rv_newest")
        return merged.groupBy(self.key).agg(newest).select(self.key, *[f"_rv_newest.{c}" for c in values])

    def _store(self, name: str, state: DataFrame) -> None:
        rows = state.withColumn(BUCKET, self._bucket(self.key)).repartition(BUCKET).sortWithinPartitions(BUCKET)
        rows.write.mode("overwrite").parquet(os.path.join(self.path, name))

    def write(self, batch_id: int, state: DataFrame) -> None:
        """Store the keys a batch changed, and everything as one version when it is time to compact."""
        self._store(f"delta-{batch_id:012d}", state.filter("updated").drop("updated"))
        if batch_id % self.compact_every == self.compact_every - 1:
            self._store(f"full-{batch_id:012d}", self.read(batch_id + 1))

    def remove_superseded(self, before: int) -> None:
        """Remove what the newest full version below a batch covers; a batch starts when those before are committed."""
        found, full = self._found(before)
        for n, kind, name in found:
            if n < full or (n == full and kind == "delta"):
                delete_path(self.spark, os.path.join(self.path, name), recursive=True)


def run_stateful(
    stream: DataFrame,
    step: Step | Callable[[DataFrame, "DataFrame | None"], Stateful],
    state: StateTable,
    output: str,
    checkpoint: str,
    *,
    trigger: dict | None = None,
):
    """Start the query; rows land in ``output`` as parquet, one folder ``batch=<id>`` per micro-batch.

    A plain function as ``step`` gets the state of all keys, a :class:`Step` that of the batch's keys.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            state.remove_superseded(batch_id)
            keys = batch.select(step.key().alias(state.key)) if isinstance(step, Step) else None
            before = state.read(batch_id, keys)
            if before is not None and "value" in before.columns:
                before = before.filter("value is not null")
            result = step(batch, before)
            target = os.path.join(output, f"batch={batch_id}")
            result.rows.write.mode("overwrite").parquet(target)
            state.write(batch_id, result.state)
        finally:
            batch.unpersist()

    return (
        stream.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def stream_check_state(key: str, value: str, order_by: Sequence[str], **options) -> Step:
    """Step of :func:`run_stateful` for compare-and-route; its state table is keyed by ``key``."""
    return Step(
        lambda: F.col(key).cast("string"),
        lambda batch, before: check_state(batch, key, value, order_by, initial_state=before, **options),
    )


def stream_hold_release(topic, key, op, order_by: Sequence[str], dup_value=None, **options) -> Step:
    """Step of :func:`run_stateful` for the hold/release gate; its state table is keyed by ``key``."""
    return Step(
        lambda: hold_key(topic, key),
        lambda batch, before: hold_release(batch, topic, key, op, order_by, dup_value, initial_holds=before, **options),
    )


def stream_assign_sequence(sequence: str, order_by: Sequence[str], **options) -> Step:
    """Step of :func:`run_stateful` for sequence numbers; its state table is keyed by ``sequence``."""
    return Step(
        lambda: F.col(sequence).cast("string"),
        lambda batch, before: assign_sequence(batch, sequence, before, order_by, **options),
    )


def apply_per_batch(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, *, trigger=None):
    """Run a table-changing sink per micro-batch; it is handed the batch id so that a replay can overwrite."""
    return (
        stream.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
