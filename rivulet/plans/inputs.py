"""Operator inputs derived from the given tables, row by row and over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .registry import spread, table

KEEP_NULLS = {"ignoreNullFields": "false"}


def order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """o_orderkey and a JSON object of the order in ``content``; a null, a nested object and an array included."""
    fields = F.struct(
        "o_orderkey",
        "o_orderstatus",
        "o_orderpriority",
        F.lit(None).cast("string").alias("o_note"),
        F.struct("o_custkey").alias("nested"),
        F.array("o_custkey").alias("listed"),
    )
    return spread(table(spark, sf_dir, "orders")).select("o_orderkey", F.to_json(fields, KEEP_NULLS).alias("content"))


def order_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON array per order: two objects with a bare number between them."""
    first = F.to_json(F.struct("o_orderkey", "o_orderstatus"))
    second = F.to_json(F.struct("o_orderkey", "o_orderpriority"))
    text = F.concat(F.lit("["), first, F.lit(",7,"), second, F.lit("]"))
    return spread(table(spark, sf_dir, "orders")).select("o_orderkey", text.alias("content"))


def mixed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event JSON, cut short for errors and a bare number for signups."""
    props = F.col("props")
    text = (
        F.when(F.col("event_type") == "error", F.substring(props, F.lit(1), F.length(props) - 1))
        .when(F.col("event_type") == "signup", F.col("event_id").cast("string"))
        .otherwise(props)
    )
    return spread(table(spark, sf_dir, "events")).select("event_id", text.alias("content"))


def order_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested XML per order: ``<order><head>…</head><lines><line>…</line><line>…</line></lines></order>``."""

    def tag(name: str, *inner: Column) -> Column:
        return F.concat(F.lit(f"<{name}>"), *inner, F.lit(f"</{name}>"))

    def line(number: int, value: Column) -> Column:
        return tag("line", tag("no", F.lit(str(number))), tag("what", value.cast("string")))

    text = tag(
        "order",
        tag("head", tag("id", F.col("o_orderkey").cast("string")), tag("status", F.col("o_orderstatus"))),
        tag("lines", line(1, F.col("o_orderpriority")), line(2, F.col("o_custkey"))),
    )
    return spread(table(spark, sf_dir, "orders")).select("o_orderkey", text.alias("content"))


def checked_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``<order>`` with an id that is no number for low priority and a missing end tag for medium."""
    low = F.col("o_orderpriority") == "5-LOW"
    medium = F.col("o_orderpriority") == "3-MEDIUM"
    number = F.concat(F.when(low, F.lit("x")).otherwise(F.lit("")), F.col("o_orderkey").cast("string"))
    end = F.when(medium, F.lit("")).otherwise(F.lit("</order>"))
    text = F.concat(
        F.lit("<order><id>"), number, F.lit("</id><status>"), F.col("o_orderstatus"), F.lit("</status>"), end
    )
    return spread(table(spark, sf_dir, "orders")).select("o_orderkey", text.alias("content"))


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change records of the orders table, ``n`` numbering an order's changes.

    1 inserts a new order under the negated key; 2 updates every order; 3 deletes low-priority ones; 4 inserts
    those of them in state P again; 5 is an operation of an unknown kind on urgent ones.
    """
    orders = spread(table(spark, sf_dir, "orders"))
    low = F.col("o_orderpriority") == "5-LOW"
    key = F.col("o_orderkey")
    new_key = (-key - 1).alias("o_orderkey")
    none = F.lit(None).cast("string")
    before = F.to_json(F.struct("o_orderkey", "o_orderstatus", "o_orderpriority"))
    inserted = F.to_json(F.struct(new_key, "o_custkey", "o_orderstatus", "o_orderpriority"))
    updated = F.to_json(F.struct("o_orderkey", F.lit("it's").alias("o_orderstatus"), none.alias("o_note")), KEEP_NULLS)
    again = F.to_json(F.struct("o_orderkey", F.lit("N").alias("o_orderstatus")))

    def change(n: int, op: str, when: Column, old: Column, new: Column) -> Column:
        return F.when(
            when, F.struct(F.lit(n).alias("n"), F.lit(op).alias("op"), old.alias("before"), new.alias("after"))
        )

    always = F.lit(True)
    changes = F.array_compact(
        F.array(
            change(1, "I", always, none, inserted),
            change(2, "U", always, before, updated),
            change(3, "D", low, before, none),
            change(4, "I", low & (F.col("o_orderstatus") == "P"), none, again),
            change(5, "T", F.col("o_orderpriority") == "1-URGENT", before, before),
        )
    )
    pos = F.lpad((key * 10 + F.col("c.n")).cast("string"), 20, "0")

    def member(name: str, json: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f',"{name}":'), json), F.lit(""))

    text = F.concat(
        F.lit('{"table":"src.Orders","op_type":"'),
        F.col("c.op"),
        F.lit('","op_ts":"t","current_ts":"t","pos":"'),
        pos,
        F.lit('","primary_keys":["o_orderkey"]'),
        member("before", F.col("c.before")),
        member("after", F.col("c.after")),
        F.lit("}"),
    )
    return orders.select("o_orderkey", F.explode_outer(changes).alias("c")).select(
        "o_orderkey", F.col("c.n").alias("n"), text.alias("content")
    )


def customer_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a keyed wide-column table."""
    return cells_of(
        table(spark, sf_dir, "customer"),
        "c_custkey",
        [("f", "name", "c_name"), ("f", "nation", "c_nationkey"), ("g", "segment", "c_mktsegment")],
    )


def supplier_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as a keyed wide-column table."""
    return cells_of(
        table(spark, sf_dir, "supplier"), "s_suppkey", [("f", "name", "s_name"), ("f", "nation", "s_nationkey")]
    )


def cells_of(df: DataFrame, key: str, columns: list[tuple[str, str, str]]) -> DataFrame:
    """Unpivot columns, given as (family, qualifier, column), into cells."""
    cells = [
        F.struct(F.lit(f).alias("family"), F.lit(q).alias("qualifier"), F.col(c).cast("string").alias("value"))
        for f, q, c in columns
    ]
    exploded = df.select(F.col(key).cast("string").alias("row_key"), F.explode(F.array(*cells)).alias("c"))
    return exploded.select("row_key", "c.*")


def state_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their type as the value to compare; errors have none."""
    value = F.when(F.col("event_type") == "error", F.lit("")).otherwise(F.col("event_type"))
    return table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", value.alias("state_value"))


def gate_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as holds and releases; a duplicate value on those worth 10 or more."""
    op = F.when(F.col("event_type").isin("purchase", "error"), F.lit("release")).otherwise(F.lit("hold"))
    dup = F.when(F.col("value") >= 10, (F.floor("value") % 2).cast("string"))
    return table(spark, sf_dir, "events").select("event_id", "user_id", op.alias("op"), dup.alias("dup"))
