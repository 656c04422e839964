"""Keyed state over a set of rows: compare-and-route, hold/release, sequence numbers.

Row-at-a-time state becomes running values over the rows ordered within a key. State from before the set
enters as extra rows that sort first. Groups of any size are handled by :mod:`rivulet.plans.skew`.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.skew import DEFAULT_HOT_ROWS, OrderedGroups, Running
from .routing import REASON, ROUTE, with_route

# Fixed value: what a hold stores when no duplicate value is given.
HOLDING = "!--holding--!"

# Which earlier value is the state, by when it is replaced. Replacing an equal value changes nothing.
_STATE_KIND = {"greater": "max", "less": "min", "not_equal": "last", "equal": "first", "never": "first"}


class Stateful(NamedTuple):
    """Processed rows, and the state after them (``updated`` marks keys that had rows)."""

    rows: DataFrame
    state: DataFrame


def _column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _seeded(df: DataFrame, seeds: DataFrame | None, order_by: Sequence[str | Column]) -> tuple[DataFrame, list[str]]:
    """Rows with state rows in front; returns the columns to order by."""
    order = [f"_rv_s{i}" for i in range(len(order_by))]
    rows = df.withColumns({"_rv_row": F.lit(1), **{n: _column(c) for n, c in zip(order, order_by)}})
    if seeds is not None:
        rows = rows.unionByName(seeds.withColumn("_rv_row", F.lit(0)), allowMissingColumns=True)
    return rows, ["_rv_row", *order]


def _finish(df: DataFrame) -> DataFrame:
    out = df.filter(F.col("_rv_row") == 1)
    return out.drop(*[c for c in out.columns if c.startswith("_rv_")])


def _failed(df: DataFrame) -> Column:
    """Rows that failed before: they keep their route and reason and leave the state alone."""
    if ROUTE not in df.columns or REASON not in df.columns:
        return F.lit(False)
    return F.coalesce(F.col(ROUTE) == "failure", F.lit(False))


def check_state(
    df: DataFrame,
    key: str | Column,
    value: str | Column | None,
    order_by: Sequence[str | Column],
    replace_when: str = "greater",
    prev_col: str | None = None,
    initial_state: DataFrame | None = None,
    *,
    hot_rows: int = DEFAULT_HOT_ROWS,
) -> Stateful:
    """Compare each row's value with the state of its key and route ``less``/``equal``/``greater``.

    The first value of a key is ``initial``; a missing value is ``empty`` and leaves the state alone. An empty
    ``value`` falls back to the content. ``replace_when`` is greater, less, equal, not_equal or never.
    ``initial_state`` and the returned state are (key, value). Comparison is on text.
    """
    kind = _STATE_KIND[replace_when]
    text = F.lit(None).cast("string") if value is None else F.nullif(_column(value).cast("string"), F.lit(""))
    if "content" in df.columns:
        text = F.coalesce(text, F.nullif(F.col("content"), F.lit("")))
    work = df.withColumns({"_rv_key": _column(key).cast("string"), "_rv_value": F.when(~_failed(df), text)})
    seeds = None
    if initial_state is not None:
        seeds = initial_state.select(
            F.col("key").cast("string").alias("_rv_key"),
            F.nullif(F.col("value").cast("string"), F.lit("")).alias("_rv_value"),
        )
    work, order = _seeded(work, seeds, order_by)
    groups = OrderedGroups(work, ["_rv_key"], order, hot_rows)
    groups.with_running(Running("_rv_state", kind, F.col("_rv_value")))
    now, state = F.col("_rv_value"), F.col("_rv_state")
    route = (
        F.when(now.isNull(), F.lit("empty"))
        .when(state.isNull(), F.lit("initial"))
        .when(now < state, F.lit("less"))
        .when(now == state, F.lit("equal"))
        .otherwise(F.lit("greater"))
    )
    rows = with_route(groups.df, route)
    if prev_col:
        rows = rows.withColumn(prev_col, F.when(now.isNotNull(), state))
    where = F.when(now.isNotNull(), F.struct(*order))
    final = {
        "max": F.max("_rv_value"),
        "min": F.min("_rv_value"),
        "last": F.max_by("_rv_value", where),
        "first": F.min_by("_rv_value", where),
    }[kind]
    new_state = (
        work.groupBy(F.col("_rv_key").alias("key"))
        .agg(final.alias("value"), (F.max("_rv_row") == 1).alias("updated"))
        .filter("value is not null")
    )
    return Stateful(_finish(rows), new_state)


def hold_key(topic: str | Column, key: str | Column) -> Column:
    """Topic and key joined by a dot: the name a hold is known by."""
    return F.concat(
        F.coalesce(_column(topic).cast("string"), F.lit("")), F.lit("."), F.coalesce(_column(key).cast("string"), F.lit(""))
    )


def hold_release(
    df: DataFrame,
    topic: str | Column,
    key: str | Column,
    op: str | Column,
    order_by: Sequence[str | Column],
    dup_value: str | Column | None = None,
    initial_holds: DataFrame | None = None,
    *,
    hot_rows: int = DEFAULT_HOT_ROWS,
) -> Stateful:
    """A gate per topic and key. ``op`` is ``hold`` or ``release``.

    A hold passes (``success``) when nothing is held; otherwise it is a ``duplicate`` if its duplicate value
    equals the held one, else ``busy``. A release is ``success``, or ``missing`` when nothing is held.
    ``initial_holds`` and the returned state are (key, value) of what is held; a released key has a null value.

    Right after any hold the key is held and right after a release it is free, so whether it is held depends
    on the previous row alone, and the held value is that of the last hold that found it free.
    """
    dup = F.lit(None).cast("string") if dup_value is None else F.nullif(_column(dup_value).cast("string"), F.lit(""))
    work = df.withColumns({"_rv_key": hold_key(topic, key), "_rv_op": F.when(~_failed(df), _column(op)), "_rv_dup": dup})
    seeds = None
    if initial_holds is not None:
        seeds = initial_holds.filter("value is not null").select(
            F.col("key").cast("string").alias("_rv_key"),
            F.lit("hold").alias("_rv_op"),
            F.col("value").cast("string").alias("_rv_dup"),
        )
    work, order = _seeded(work, seeds, order_by)
    # an unknown operation fails and leaves the state as it was
    work = work.withColumn("_rv_op", F.when(F.col("_rv_op").isin("hold", "release"), F.col("_rv_op")))
    groups = OrderedGroups(work, ["_rv_key"], order, hot_rows)
    groups.with_running(Running("_rv_before", "last", F.col("_rv_op")))
    held = F.coalesce(F.col("_rv_before") == "hold", F.lit(False))
    stored = F.when((F.col("_rv_op") == "hold") & ~held, F.coalesce(F.col("_rv_dup"), F.lit(HOLDING)))
    groups.df = groups.df.withColumn("_rv_stored", stored)
    groups.with_running(Running("_rv_held", "last", F.col("_rv_stored")))
    route = (
        F.when(F.col("_rv_op").isNull(), F.lit("failure"))
        .when(F.col("_rv_op") == "release", F.when(held, F.lit("success")).otherwise(F.lit("missing")))
        .when(~held, F.lit("success"))
        .when(F.col("_rv_dup") == F.col("_rv_held"), F.lit("duplicate"))
        .otherwise(F.lit("busy"))
    )
    place = F.struct(*order)
    state = (
        groups.df.groupBy(F.col("_rv_key").alias("key"))
        .agg(
            F.max_by("_rv_op", F.when(F.col("_rv_op").isNotNull(), place)).alias("_rv_last"),
            F.max_by("_rv_stored", F.when(F.col("_rv_stored").isNotNull(), place)).alias("value"),
            (F.max("_rv_row") == 1).alias("updated"),
        )
        .select("key", F.when(F.col("_rv_last") == "hold", F.col("value")).alias("value"), "updated")
    )
    return Stateful(_finish(with_route(groups.df, route)), state)


def hold(df: DataFrame, topic, key, order_by, dup_value=None, initial_holds=None, **options) -> Stateful:
    """:func:`hold_release` where every row is a hold."""
    return hold_release(df, topic, key, F.lit("hold"), order_by, dup_value, initial_holds, **options)


def release(df: DataFrame, topic, key, order_by, initial_holds=None, **options) -> Stateful:
    """:func:`hold_release` where every row is a release."""
    return hold_release(df, topic, key, F.lit("release"), order_by, None, initial_holds, **options)


def assign_sequence(
    df: DataFrame,
    sequence: str | Column,
    counters: DataFrame | None,
    order_by: Sequence[str | Column],
    start: int = 1,
    increment: int = 1,
    into: str = "sequence_value",
    *,
    hot_rows: int = DEFAULT_HOT_ROWS,
) -> Stateful:
    """Give each row the next number of its named sequence.

    ``counters`` holds (sequence, current) of sequences in use; a new one begins at ``start``. The returned
    state is (sequence, current, updated).
    """
    work = df.withColumn("_rv_key", _column(sequence).cast("string"))
    seeds = None
    if counters is not None:
        seeds = counters.select(
            F.col("sequence").cast("string").alias("_rv_key"), F.col("current").cast("bigint").alias("_rv_current")
        )
    else:
        work = work.withColumn("_rv_current", F.lit(None).cast("bigint"))
    work, order = _seeded(work, seeds, order_by)
    groups = OrderedGroups(work, ["_rv_key"], order, hot_rows)
    is_row = F.when((F.col("_rv_row") == 1) & ~_failed(work), F.lit(1))
    running = [Running("_rv_before", "count", is_row)]
    step = F.lit(increment).cast("bigint")
    value = F.lit(start).cast("bigint") + step * F.col("_rv_before")
    if counters is not None:
        # Only the state row in front holds a number, so the greatest one so far is that one.
        running.append(Running("_rv_base", "max", F.col("_rv_current")))
        value = F.coalesce(F.col("_rv_base") + step * (F.col("_rv_before") + 1), value)
    value = F.when(~_failed(work), value)
    groups.with_running(*running)
    counts = work.groupBy(F.col("_rv_key").alias("sequence")).agg(
        F.max("_rv_current").alias("_rv_current"), F.count(is_row).alias("_rv_rows")
    )
    current = F.coalesce(
        F.col("_rv_current") + step * F.col("_rv_rows"),
        F.lit(start).cast("bigint") + step * (F.col("_rv_rows") - 1),
    )
    counts = counts.filter((F.col("_rv_rows") > 0) | F.col("_rv_current").isNotNull())  # none of failed rows alone
    state = counts.select("sequence", current.alias("current"), (F.col("_rv_rows") > 0).alias("updated"))
    rows = with_route(groups.df.withColumn("_rv_out", value), "success").withColumn(into, F.col("_rv_out"))
    return Stateful(_finish(rows), state)
