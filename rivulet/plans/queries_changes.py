"""Queries of the change-record operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import apply_changes, changes_to_sql, enrich, merge_change_images
from .inputs import order_changes
from .registry import query, table

# The change records in SQL: one row per order and change number.
_CHANGES = """
    changes as (
      select *, 1 as n, 'I' as op from orders union all
      select *, 2, 'U' from orders union all
      select *, 3, 'D' from orders where o_orderpriority = '5-LOW' union all
      select *, 4, 'I' from orders where o_orderpriority = '5-LOW' and o_orderstatus = 'P' union all
      select *, 5, 'T' from orders where o_orderpriority = '1-URGENT')
"""


@query(
    "merge_change_images",
    f"""
    with {_CHANGES}
    select o_orderkey, n, case when op = 'T' then 'unsupported op_type' else 'success' end as route,
      case n
        when 1 then '{{"OP_TYPE":"I","O_CUSTKEY":' || o_custkey || ',"O_ORDERKEY":' || (-o_orderkey - 1) ||
          ',"O_ORDERPRIORITY":"' || o_orderpriority || '","O_ORDERSTATUS":"' || o_orderstatus ||
          '","TABLE":"DW.ORDERS","batch":"b-1"}}'
        when 2 then '{{"OP_TYPE":"U","O_NOTE":null,"O_ORDERKEY":' || o_orderkey || ',"O_ORDERPRIORITY":"' ||
          o_orderpriority || '","O_ORDERSTATUS":"it''s","TABLE":"DW.ORDERS","batch":"b-2"}}'
        when 3 then '{{"OP_TYPE":"D","O_ORDERKEY":' || o_orderkey || ',"O_ORDERPRIORITY":"' || o_orderpriority ||
          '","O_ORDERSTATUS":"' || o_orderstatus || '","TABLE":"DW.ORDERS","batch":"b-3"}}'
        when 4 then '{{"OP_TYPE":"I","O_ORDERKEY":' || o_orderkey ||
          ',"O_ORDERSTATUS":"N","TABLE":"DW.ORDERS","batch":"b-4"}}'
      end as merged
    from changes
    """,
)
def merge_images(spark, sf_dir):
    out = merge_change_images(
        order_changes(spark, sf_dir), "upper", "dw", "table,op_type", "merged", {"batch": "b-${n}"}
    )
    return out.select("o_orderkey", "n", "route", "merged")


@query(
    "changes_to_sql",
    f"""
    with {_CHANGES}
    select o_orderkey, n, case when op = 'T' then 'unsupported op_type' else 'success' end as route,
      case n
        when 1 then 'INSERT INTO dw.orders (o_orderkey, o_custkey, state, o_orderpriority) VALUES (''' ||
          (-o_orderkey - 1) || ''', ''' || o_custkey || ''', ''' || o_orderstatus || ''', ''' || o_orderpriority || ''');'
        when 2 then 'UPDATE dw.orders SET state = ''it''''s'', o_note = null WHERE o_orderkey = ''' || o_orderkey || ''';'
        when 3 then 'DELETE FROM dw.orders WHERE o_orderkey = ''' || o_orderkey || ''';'
        when 4 then 'INSERT INTO dw.orders (o_orderkey, state) VALUES (''' || o_orderkey || ''', ''N'');'
      end as dml
    from changes
    """,
)
def change_statements(spark, sf_dir):
    out = changes_to_sql(
        order_changes(spark, sf_dir), "lower", "dw", True, "dml", column_map={"Orders.o_orderstatus": "State"}
    )
    return out.select("o_orderkey", "n", "route", "dml")


@query(
    "apply_changes",
    """
    select o_orderkey, o_custkey, 'it''s' as o_orderstatus, o_orderpriority, null as o_note from orders
    where o_orderpriority <> '5-LOW'
    union all
    select -o_orderkey - 1, o_custkey, o_orderstatus, o_orderpriority, null from orders
    union all
    select o_orderkey, null, 'N', null, null from orders where o_orderpriority = '5-LOW' and o_orderstatus = 'P'
    """,
)
def apply_to_table(spark, sf_dir):
    target = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", F.lit("kept?").alias("o_note")
    )
    return apply_changes(target, order_changes(spark, sf_dir), ["o_orderkey"])


@query(
    "changes_enriched",
    f"""
    with {_CHANGES}
    select o_orderkey, n, '{{"change":"' || n || '","nation":"' || coalesce(n_name, 'none') || '","status":"' ||
      case n when 1 then o_orderstatus when 2 then 'it''s' when 3 then o_orderstatus when 4 then 'N' end || '"}}' as content
    from changes left join nation on n_nationkey = n where op <> 'T'
    """,
)
def changes_enriched(spark, sf_dir):
    """Flagship: change records to merged rows, flattened, enriched from a lookup, and written as JSON."""
    from ..operators import json_to_columns, sql_to_lookup

    merged = merge_change_images(order_changes(spark, sf_dir)).filter("route = 'success'")
    flat = json_to_columns(merged, fields={"o_orderstatus": "string"}, fragments="never", emit_original=False)
    lookup = sql_to_lookup(table(spark, sf_dir, "nation"), "n_nationkey", "n_name", order_by=["n_nationkey"])
    spec = {
        "extract-to-json": {
            "status": "${o_orderstatus}",
            "change": "${n}",
            "nation": {"value": "${n}", "type": "CACHE", "default": "none"},
        }
    }
    return enrich(flat, spec, {"cache": lookup}).select("o_orderkey", "n", "content")
