"""Queries of the keyed-state operators, over tables and over streams."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import assign_sequence, check_state, hold_release
from ..session import is_directory, work_path
from ..streaming import StateTable, run_stateful, stream_assign_sequence, stream_check_state, stream_hold_release
from .inputs import gate_events, state_events
from .registry import query, table

# The state before each row, by when it is replaced; state from customers comes first.
_BEFORE = {
    "greater": "max(v)",
    "less": "min(v)",
    "not_equal": "last_value(v ignore nulls)",
    "equal": "first_value(v ignore nulls)",
    "never": "first_value(v ignore nulls)",
}


def _check_oracle(mode: str, key: str = "user_id", seeded: bool = True) -> str:
    seeds = "union all select -1, c_custkey, lower(c_mktsegment) from customer" if seeded else ""
    return f"""
    with s as (
      select event_id, {key} as k, nullif(event_type, 'error') as v from events {seeds}),
    b as (
      select *, {_BEFORE[mode]} over (
        partition by k order by event_id rows between unbounded preceding and 1 preceding) as prev from s)
    select event_id, case when v is not null then prev end as prev,
           case when v is null then 'empty' when prev is null then 'initial' when v < prev then 'less'
                when v = prev then 'equal' else 'greater' end as route
    from b where event_id >= 0
    """


def _initial(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.lower("c_mktsegment").alias("value")
    )


def _check(mode: str):
    def run(spark, sf_dir):
        out = check_state(
            state_events(spark, sf_dir), "user_id", "state_value", ["event_id"], mode, "prev", _initial(spark, sf_dir)
        )
        return out.rows.select("event_id", "prev", "route")

    return run


for _mode in _BEFORE:
    query(f"check_state_{_mode}", _check_oracle(_mode))(_check(_mode))


@query("check_state_large_groups", _check_oracle("not_equal", "event_type", seeded=False))
def check_large(spark, sf_dir):
    """Few, large keys and a low threshold, so that the groups are cut into chunks."""
    events = state_events(spark, sf_dir)
    out = check_state(events, "event_type", "state_value", ["event_id"], "not_equal", "prev", hot_rows=200)
    return out.rows.select("event_id", "prev", "route")


@query(
    "check_state_final",
    """
    with s as (
      select event_id, user_id as k, nullif(event_type, 'error') as v from events
      union all select -1, c_custkey, lower(c_mktsegment) from customer)
    select cast(k as varchar) as key, max(v) as value, case when max(event_id) >= 0 then 1 else 0 end as updated
    from s group by k having max(v) is not null
    """,
)
def check_final(spark, sf_dir):
    out = check_state(state_events(spark, sf_dir), "user_id", "state_value", ["event_id"], initial_state=_initial(spark, sf_dir))
    return out.state.withColumn("updated", F.col("updated").cast("int"))


def _gate_oracle(key: str) -> str:
    return f"""
    with g as (
      select event_id, {key} as k, case when event_type in ('purchase', 'error') then 'release' else 'hold' end as op,
             case when value >= 10 then cast(cast(floor(value) as bigint) % 2 as varchar) end as dup from events),
    s as (
      select *, count(*) filter (op = 'release') over (
        partition by k order by event_id rows between unbounded preceding and 1 preceding) as seg from g),
    f as (
      select *, min(event_id) filter (op = 'hold') over (partition by k, seg) as first_hold from s),
    h as (
      select *, max(case when event_id = first_hold then coalesce(dup, '!--holding--!') end) over (partition by k, seg) as held
      from f)
    select event_id, case when op = 'release' then case when first_hold < event_id then 'success' else 'missing' end
                          when event_id = first_hold then 'success' when dup = held then 'duplicate' else 'busy' end as route
    from h
    """


@query("hold_release", _gate_oracle("user_id"))
def gate(spark, sf_dir):
    out = hold_release(gate_events(spark, sf_dir), F.lit("user"), "user_id", "op", ["event_id"], "dup")
    return out.rows.select("event_id", "route")


@query("hold_release_large_groups", _gate_oracle("user_id % 3"))
def gate_large(spark, sf_dir):
    """Three keys and a low threshold, so that the groups are cut into chunks."""
    out = hold_release(
        gate_events(spark, sf_dir), F.lit("user"), F.col("user_id") % 3, "op", ["event_id"], "dup", hot_rows=200
    )
    return out.rows.select("event_id", "route")


_SEQUENCE = """
    with counters as (select c_mktsegment as s, count(*) as cur from customer where c_mktsegment < 'G' group by 1),
    n as (select c_custkey, c_mktsegment, row_number() over (partition by c_mktsegment order by c_custkey) as rn from customer)
"""


def _counters(spark, sf_dir):
    low = table(spark, sf_dir, "customer").filter("c_mktsegment < 'G'")
    return low.groupBy(F.col("c_mktsegment").alias("sequence")).agg(F.count(F.lit(1)).alias("current"))


@query(
    "assign_sequence",
    f"{_SEQUENCE} select c_custkey, coalesce(cur + 5 * rn, 100 + 5 * (rn - 1)) as sequence_value from n left join counters on s = c_mktsegment",
)
def sequence(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    out = assign_sequence(customers, "c_mktsegment", _counters(spark, sf_dir), ["c_custkey"], 100, 5)
    return out.rows.select("c_custkey", "sequence_value")


@query(
    "assign_sequence_counters",
    f"""
    {_SEQUENCE} select c_mktsegment as sequence, coalesce(max(cur) + 5 * count(*), 100 + 5 * (count(*) - 1)) as current
    from n left join counters on s = c_mktsegment group by 1
    """,
)
def sequence_counters(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    out = assign_sequence(customers, "c_mktsegment", _counters(spark, sf_dir), ["c_custkey"], 100, 5)
    return out.state.select("sequence", "current")


@query("assign_sequence_single", "select o_orderkey, row_number() over (order by o_orderkey) as sequence_value from orders")
def sequence_single(spark, sf_dir):
    """One sequence for all rows, cut into chunks instead of one task."""
    out = assign_sequence(table(spark, sf_dir, "orders"), F.lit("all"), None, ["o_orderkey"], hot_rows=1000)
    return out.rows.select("o_orderkey", "sequence_value")


# -- streams ------------------------------------------------------------------


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a file stream, whether it is one file or a folder of files."""
    path = os.path.join(sf_dir, "events.parquet")
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if is_directory(spark, path):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def run_to_end(stream: DataFrame, step, key: str) -> DataFrame:
    """Process all that is available through a stateful step and read the rows it wrote."""
    spark = stream.sparkSession
    base = work_path(spark, "stream")
    state = StateTable(spark, os.path.join(base, "state"), key)
    output = os.path.join(base, "rows")
    run_stateful(stream, step, state, output, os.path.join(base, "checkpoint")).awaitTermination()
    return spark.read.parquet(output)


@query("stream_check_state", _check_oracle("greater", seeded=False))
def stream_check(spark, sf_dir):
    value = F.when(F.col("event_type") != "error", F.col("event_type"))
    stream = event_stream(spark, sf_dir).select("event_id", "user_id", value.alias("state_value"))
    step = stream_check_state("user_id", "state_value", ["event_id"], replace_when="greater", prev_col="prev")
    return run_to_end(stream, step, "key").select("event_id", "prev", "route")


@query("stream_hold_release", _gate_oracle("user_id"))
def stream_gate(spark, sf_dir):
    op = F.when(F.col("event_type").isin("purchase", "error"), F.lit("release")).otherwise(F.lit("hold"))
    dup = F.when(F.col("value") >= 10, (F.floor("value") % 2).cast("string"))
    stream = event_stream(spark, sf_dir).select("event_id", "user_id", op.alias("op"), dup.alias("dup"))
    step = stream_hold_release(F.lit("user"), "user_id", "op", ["event_id"], "dup")
    return run_to_end(stream, step, "key").select("event_id", "route")


@query(
    "stream_assign_sequence",
    "select event_id, 10 * row_number() over (partition by event_type order by event_id) as sequence_value from events",
)
def stream_sequence(spark, sf_dir):
    stream = event_stream(spark, sf_dir).select("event_id", "event_type")
    step = stream_assign_sequence("event_type", ["event_id"], start=10, increment=10)
    return run_to_end(stream, step, "sequence").select("event_id", "sequence_value")
