"""Registered queries and, where SQL can say the same, their oracle text."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

#: Rows of a task that parses each of them.
TASK_ROWS = 100_000

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register ``(spark, sf_dir) -> DataFrame`` under a name."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if oracle:
            ORACLES[name] = oracle
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def spread(df: DataFrame) -> DataFrame:
    """A scan spread over all cores, and over more tasks where one would get more than TASK_ROWS rows.

    A small file is one task, which would leave the costly parsing behind it to one core, and the parts of a large one
    grow with it and are uneven. A scan that already has enough tasks is returned as it is, without an exchange. Counting
    reads no more than the footers of parquet files.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = cores * max(1, -(-df.count() // (TASK_ROWS * cores)))
    return df.repartition(tasks) if df.rdd.getNumPartitions() < tasks else df
