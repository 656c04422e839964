"""Tables that last: rows kept by key in parquet, changed bucket by bucket, read by version.

A table is a folder. Its rows lie in buckets by a hash of some columns, each bucket in files of one earlier write, and
``_versions/N.json`` says for version N which write holds which bucket. A change writes the buckets it touches anew,
with everything they hold, and then puts the next version into place by one rename that fails if the version exists. So
a change is seen as a whole or not at all, a job that breaks off leaves the version before it, and of two writers that
start from one version the second fails. What was read keeps its version: its files stay until :meth:`vacuum`.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Sequence
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.template import quoted
from ..session import child_names, delete_path, read_text, rename_new, write_text

VERSIONS, DATA, BUCKET = "_versions", "data", "_rv_bucket"


class TableConflict(RuntimeError):
    """Another writer put the next version into place first."""


class KeyedTable:
    """One table folder as it was at ``version``. Use :meth:`create` or :meth:`open`; changes move it on."""

    def __init__(self, spark: SparkSession, path: str, version: int, manifest: dict[str, Any]):
        self.spark, self.path, self.version = spark, path, version
        self._manifest = manifest
        self.schema = StructType.fromJson(manifest["schema"])
        self.by: list[str] = manifest["by"]
        self.buckets: int = manifest["buckets"]

    # -- opening ---------------------------------------------------------------

    @classmethod
    def create(cls, spark: SparkSession, path: str, schema: StructType | str, by: Sequence[str], buckets: int = 64) -> KeyedTable:
        """A new, empty table. ``by`` names the columns whose hash gives the bucket: the key, or the part of it that
        rows are changed by. A bucket is what a change rewrites, so choose so many that one is a few hundred MB."""
        if isinstance(schema, str):
            schema = spark.createDataFrame([], schema).schema
        missing = [c for c in by if c not in schema.names]
        if missing or not by or buckets < 1:
            raise ValueError(f"a table needs columns to bucket by, of its own: {missing or list(by)}")
        manifest = {"schema": json.loads(schema.json()), "by": list(by), "buckets": buckets, "parts": {}}
        table = cls(spark, path, 0, manifest)
        table._commit(manifest)
        return table

    @classmethod
    def open(cls, spark: SparkSession, path: str, version: int | None = None) -> KeyedTable:
        """The table at its latest version, or at an earlier one that was not vacuumed."""
        there = cls._versions(spark, path)
        if not there or (version is not None and version not in there):
            raise FileNotFoundError(f"no table{'' if version is None else f' version {version}'} in {path}")
        version = max(there) if version is None else version
        return cls(spark, path, version, json.loads(read_text(spark, cls._file(path, version))))

    @staticmethod
    def _file(path: str, version: int) -> str:
        return os.path.join(path, VERSIONS, f"{version:012d}.json")

    @staticmethod
    def _versions(spark: SparkSession, path: str) -> list[int]:
        names = child_names(spark, os.path.join(path, VERSIONS))
        return [int(n[: -len(".json")]) for n in names if n.endswith(".json") and n[0].isdigit()]

    # -- reading ---------------------------------------------------------------

    def read(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """The rows of this version; with ``buckets`` only theirs."""
        parts = self._manifest["parts"]
        chosen = parts if buckets is None else {str(b): parts[str(b)] for b in buckets if str(b) in parts}
        if not chosen:
            return self.spark.createDataFrame([], self.schema)
        paths = [os.path.join(self.path, DATA, write, f"{BUCKET}={bucket}") for bucket, write in chosen.items()]
        return self.spark.read.schema(self.schema).parquet(*paths)

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The rows whose bucket columns are among ``keys`` (which has them); only the buckets of these are read."""
        keys = keys.select(*[quoted(c).cast(self.schema[c].dataType).alias(c) for c in self.by]).distinct()
        return self.read(self.touched(keys)).join(keys, self.by, "left_semi")

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets that the rows' keys belong to: at most as many numbers as there are buckets."""
        return sorted(r[0] for r in rows.select(self._bucket().alias("b")).distinct().collect())

    def _bucket(self):
        return F.pmod(F.xxhash64(*[quoted(c).cast(self.schema[c].dataType) for c in self.by]), F.lit(self.buckets)).cast("int")

    # -- changing --------------------------------------------------------------

    def update(self, change: Callable[[DataFrame], Any], touching: DataFrame) -> Any:
        """Rewrite the buckets of ``touching`` (rows with the bucket columns) as ``change`` makes them.

        ``change`` gets the rows of these buckets and returns the new ones, alone or as ``.cells`` or ``.target`` of a
        result with more to it. What it returns is returned; it still reads the version before.
        """
        buckets = self.touched(touching)
        result = change(self.read(buckets))
        new = next((getattr(result, n) for n in ("cells", "target") if not isinstance(result, DataFrame) and hasattr(result, n)), result)
        if buckets:
            self._write(new, buckets)
        return result

    def replace(self, rows: DataFrame) -> None:
        """Let ``rows`` be all there is."""
        self._write(rows, list(range(self.buckets)))

    def clear(self) -> None:
        """Remove every row. No data is read or written."""
        self._commit({**self._manifest, "parts": {}})

    def _write(self, rows: DataFrame, buckets: Sequence[int]) -> None:
        rows = rows.select(*[quoted(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])
        write = uuid.uuid4().hex
        folder = os.path.join(self.path, DATA, write)
        # rebalanced by bucket: few files for small buckets, several tasks for a large one
        rows.withColumn(BUCKET, self._bucket()).hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(folder)
        written = {n.split("=")[1] for n in child_names(self.spark, folder) if n.startswith(f"{BUCKET}=")}
        outside = written - {str(b) for b in buckets}
        if outside:
            delete_path(self.spark, folder, recursive=True)
            raise ValueError(f"the change makes rows of buckets it does not touch: {sorted(outside)}")
        parts = {b: w for b, w in self._manifest["parts"].items() if int(b) not in set(buckets)}
        self._commit({**self._manifest, "parts": {**parts, **{b: write for b in sorted(written, key=int)}}})

    def _commit(self, manifest: dict[str, Any]) -> None:
        version = self.version + 1
        aside = os.path.join(self.path, VERSIONS, f".{uuid.uuid4().hex}")
        write_text(self.spark, aside, json.dumps(manifest))
        if not rename_new(self.spark, aside, self._file(self.path, version)):
            delete_path(self.spark, aside)
            raise TableConflict(f"version {version} of {self.path} is there already")
        self.version, self._manifest = version, manifest

    def vacuum(self, keep: int = 1) -> int:
        """Delete versions but the latest ``keep``, and files that none of those names; returns how many were deleted.

        Not to be run while another writer is at work: its files belong to no version yet.
        """
        if keep < 1:
            raise ValueError("at least one version stays")
        versions = sorted(self._versions(self.spark, self.path))
        kept = [json.loads(read_text(self.spark, self._file(self.path, v))) for v in versions[-keep:]]
        used = {(w, b) for m in kept for b, w in m["parts"].items()}
        gone = 0
        for version in versions[:-keep]:
            gone += delete_path(self.spark, self._file(self.path, version))
        data = os.path.join(self.path, DATA)
        for write in child_names(self.spark, data):
            held = {b for w, b in used if w == write}
            if not held:
                gone += delete_path(self.spark, os.path.join(data, write), recursive=True)
                continue
            for name in child_names(self.spark, os.path.join(data, write)):
                if name.startswith(f"{BUCKET}=") and name.split("=")[1] not in held:
                    gone += delete_path(self.spark, os.path.join(data, write, name), recursive=True)
        return gone


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is a table folder."""
    try:
        KeyedTable.open(spark, path)
    except (FileNotFoundError, PySparkException):
        return False
    return True
