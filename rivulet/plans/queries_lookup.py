"""Queries of the SQL sources, lookups, and keyed cells."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from ..operators import (
    attach_lookup,
    enrich,
    enrich_each,
    kt_check_and_put,
    kt_contains,
    kt_get,
    kt_get_and_put_if_absent,
    kt_get_by_filter,
    kt_last_cell_by_filter,
    kt_put,
    kt_put_if_absent,
    kt_remove,
    scan_cells,
    sql_to_lookup,
    xml_extract,
)
from ..session import work_path
from ..sources import ingest_files, run_sql_script, sql_rows, sql_scalar, truncate_tables
from .inputs import customer_cells, order_xml, supplier_cells
from .registry import query, table


def view(spark, sf_dir, name: str) -> str:
    """A temporary view of a given table under a fresh name."""
    fresh = f"{name}_{uuid.uuid4().hex[:8]}"
    table(spark, sf_dir, name).createOrReplaceTempView(fresh)
    return fresh


_ROWS = """
    select c_custkey, coalesce(cast(o_orderkey as varchar), null) as o_orderkey, o_orderstatus,
           case when o_orderkey is not null then row_number() over (partition by c_custkey order by o_orderkey) end as fragment_index,
           case when o_orderkey is not null then count(*) over (partition by c_custkey) end as fragment_count,
           case when o_orderkey is null then 'empty' else 'success' end as route
    from customer left join orders on o_custkey = c_custkey
"""


@query("sql_rows", _ROWS)
def rows_of_query(spark, sf_dir):
    orders = view(spark, sf_dir, "orders")
    text = f"select o_custkey as `o.o_custkey`, o_orderkey as `o.o_orderkey`, o_orderstatus from {orders}"
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    out = sql_rows(customers, text, {"c_custkey": "o.o_custkey"}, ["o.o_orderkey"], strip_qualifiers=True)
    return out.select("c_custkey", "o_orderkey", "o_orderstatus", "fragment_index", "fragment_count", "route")


@query(
    "sql_rows_large_groups",
    """
    select n_nationkey, cast(c_custkey as varchar) as c_custkey,
           case when c_custkey is not null then row_number() over (partition by n_nationkey order by c_custkey) end as fragment_index,
           case when c_custkey is not null then count(*) over (partition by n_nationkey) end as fragment_count,
           case when c_custkey is null then 'empty' else 'success' end as route
    from nation left join customer on c_nationkey = n_nationkey
    """,
)
def rows_large_groups(spark, sf_dir):
    """The same operator with a low threshold, so that groups are cut into chunks."""
    customers = table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey")
    out = sql_rows(nations, customers, {"n_nationkey": "c_nationkey"}, ["c_custkey"], hot_rows=20)
    return out.select("n_nationkey", "c_custkey", "fragment_index", "fragment_count", "route")


@query(
    "sql_scalar",
    """
    select c_custkey, first_status, case when first_status is null then 'empty' else 'success' end as route
    from customer left join (
      select o_custkey, o_orderstatus as first_status from orders
      qualify row_number() over (partition by o_custkey order by o_orderkey) = 1) on o_custkey = c_custkey
    """,
)
def scalar_of_query(spark, sf_dir):
    orders = view(spark, sf_dir, "orders")
    text = f"select o_orderstatus, o_custkey, o_orderkey from {orders}"
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    out = sql_scalar(customers, text, {"c_custkey": "o_custkey"}, ["o_orderkey"], "first_status")
    return out.select("c_custkey", "first_status", "route")


@query(
    "sql_scalar_uncorrelated",
    "select c_custkey, (select cast(max(o_orderkey) as varchar) from orders) as content, 'success' as route from customer",
)
def scalar_alone(spark, sf_dir):
    orders = view(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    return sql_scalar(customers, f"select max(o_orderkey) from {orders}").select("c_custkey", "content", "route")


@query(
    "run_sql_script",
    """
    select o_orderpriority, count(*) as orders, 3 as statements_done from orders where o_orderstatus = 'F' group by 1
    union all
    select 'ALL', count(*), 3 from orders
    """,
)
def script(spark, sf_dir):
    orders = view(spark, sf_dir, "orders")
    name = f"script_{uuid.uuid4().hex[:8]}"
    text = f"""
        CREATE TABLE {name} (o_orderpriority STRING, orders BIGINT) USING parquet LOCATION '{work_path(spark, name)}';
        INSERT INTO {name} SELECT o_orderpriority, count(*) FROM {orders} WHERE o_orderstatus = 'F' GROUP BY 1;;
        INSERT INTO {name} SELECT 'ALL', count(*) FROM {orders};
        SELECT no_such_column FROM {name};
        INSERT INTO {name} VALUES ('never', 0)
    """
    report = run_sql_script(spark, text)
    done = report.filter("status = 'success'").count()
    return spark.table(name).withColumn("statements_done", F.lit(done))


@query(
    "truncate_tables",
    "select 'customers' as table_name, 'success' as route, count(*) as rows_before, 0 as rows_after from customer",
)
def truncate(spark, sf_dir):
    name = f"truncate_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{work_path(spark, name)}' AS SELECT * FROM {view(spark, sf_dir, 'customer')}")
    before = spark.table(name).count()
    report = truncate_tables(spark, name)
    after = spark.table(name).count()
    return report.select(
        F.lit("customers").alias("table_name"), "route",
        F.lit(before).cast("bigint").alias("rows_before"), F.lit(after).cast("bigint").alias("rows_after"),
    )


@query(
    "ingest_files",
    """
    select c_mktsegment as segment, 'success' as route, c_name as line, null as reason from customer
    union all
    select 'NOWHERE', 'comms.failure', null, 'dir_does_not_exist'
    """,
)
def ingest(spark, sf_dir):
    """Customer names written as compressed text files, one directory per segment, and read back."""
    customers = table(spark, sf_dir, "customer")
    base = work_path(spark, "files")
    customers.select("c_mktsegment", "c_name").write.partitionBy("c_mktsegment").option("compression", "gzip").text(base)
    segments = customers.select(F.col("c_mktsegment").alias("segment")).distinct()
    gone = spark.createDataFrame([("NOWHERE",)], "segment string")
    dirs = segments.union(gone).withColumn(
        "directory", F.concat(F.lit(os.path.join(base, "c_mktsegment=")), F.col("segment"))
    )
    out = ingest_files(spark, dirs, regex=r"part-.*\.txt\.gz", emit_original=False)
    lines = F.explode_outer(F.split(F.rtrim(F.col("content"), F.lit("\n")), "\n")).alias("line")
    return out.select("segment", "route", lines, F.col("failure_reason").alias("reason"))


_LOOKUP = """
    with pairs as (
      select c_mktsegment as key, c_name as value, c_custkey, 0 as turn from customer
      union all
      select 'N-' || c_nationkey, c_name, c_custkey, 1 from customer where c_nationkey > 4)
    select key, value from pairs qualify row_number() over (partition by key order by c_custkey desc, turn desc) = 1
"""


def segment_lookup(spark, sf_dir):
    alias = F.when(F.col("c_nationkey") > 4, F.concat(F.lit("N-"), F.col("c_nationkey")))
    customers = table(spark, sf_dir, "customer").withColumn("other", alias)
    return sql_to_lookup(customers, "c_mktsegment", "c_name", "other", ["c_custkey"])


@query("sql_to_lookup", _LOOKUP)
def build_lookup(spark, sf_dir):
    return segment_lookup(spark, sf_dir)


@query(
    "attach_lookup",
    f"""
    with lookup as ({_LOOKUP})
    select s_suppkey, value as latest_customer from supplier left join lookup on key = 'N-' || s_nationkey
    """,
)
def attach(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier")
    out = attach_lookup(suppliers, segment_lookup(spark, sf_dir), "N-${s_nationkey}", "latest_customer")
    return out.select("s_suppkey", "latest_customer")


@query(
    "xml_extract_lookup",
    """
    select c_custkey, o_orderstatus as status, case when o_orderkey is null then 'failure' else 'success' end as route
    from customer left join orders on o_orderkey = c_custkey
    """,
)
def extract_from_lookup(spark, sf_dir):
    stored = order_xml(spark, sf_dir).select(F.col("o_orderkey").cast("string").alias("key"), F.col("content").alias("value"))
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    out = xml_extract(customers, {"status": "/order/head/status"}, lookup=stored, lookup_key="${c_custkey}")
    return out.select("c_custkey", "status", "route")


def enrichment_sources(spark, sf_dir):
    nations = sql_to_lookup(table(spark, sf_dir, "nation"), "n_nationkey", "n_name", order_by=["n_nationkey"])
    return {
        "cache": nations,
        "tables": {"supplier": supplier_cells(spark, sf_dir), "customer": customer_cells(spark, sf_dir)},
    }


_FIRST_ORDER = """
    (select o_custkey, o_orderstatus from orders
     qualify row_number() over (partition by o_custkey order by o_orderkey) = 1)
"""


@query(
    "enrich_columns",
    f"""
    select c_custkey, 'customer ' || c_custkey as who, null as nothing, coalesce(nullif(c_mktsegment, 'BUILDING'), 'B') as seg,
           n_name as nation, coalesce(cast(s_nationkey as varchar), 'none') as supplier_nation,
           coalesce(o_orderstatus, '-') as first_status, cast(c_nationkey as bigint) as nation_no, 'success' as route
    from customer left join nation on n_nationkey = c_nationkey left join supplier on s_suppkey = c_custkey
      left join {_FIRST_ORDER} on o_custkey = c_custkey
    """,
)
def enrich_to_columns(spark, sf_dir):
    orders = view(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer").withColumn("segment", F.nullif("c_mktsegment", F.lit("BUILDING")))
    spec = {
        "extract-to-attributes": {
            "who": "customer ${c_custkey}",
            "nothing": None,
            "seg": {"value": "${segment}", "default": "B"},
            "nation": {"value": "${c_nationkey}", "type": "CACHE"},
            "supplier_nation": {"value": "${c_custkey}", "type": "HBASE", "hbase-table": "supplier", "default": "none"},
            "first_status": {
                "type": "SQL",
                "value": f"select o_orderstatus, o_custkey, o_orderkey from {orders}",
                "on": {"c_custkey": "o_custkey"},
                "order-by": ["o_orderkey"],
                "default": "-",
            },
            "nation_no": {"value": "${c_nationkey}", "to-type": "long"},
        }
    }
    out = enrich(customers, spec, enrichment_sources(spark, sf_dir))
    return out.select("c_custkey", *spec["extract-to-attributes"], "route")


@query(
    "enrich_json",
    """
    select c_custkey, case when c_mktsegment = 'MACHINERY' then 'failure' else 'success' end as route,
      case when c_mktsegment = 'MACHINERY' then 'before' else
        '{"blank":-1,"key":' || c_custkey || ',"nation":"' || n_name || '","supplier":"' ||
        coalesce(cast(s_nationkey as varchar), 'none') || '"}' end as content
    from customer left join nation on n_nationkey = c_nationkey left join supplier on s_suppkey = c_custkey
    """,
)
def enrich_to_json(spark, sf_dir):
    number = F.concat(F.col("c_custkey"), F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("?")).otherwise(F.lit("")))
    customers = table(spark, sf_dir, "customer").withColumns({"number": number, "content": F.lit("before")})
    spec = {
        "extract-to-json": {
            "key": {"value": "${number}", "to-type": "long"},
            "nation": {"value": "${c_nationkey}", "type": "CACHE_KEY"},
            "supplier": {"value": "${c_custkey}", "type": "HBASE_SCAN", "hbase-table": "supplier", "default": "none"},
            "blank": {"value": "", "default": -1, "to-type": "int"},
        }
    }
    return enrich(customers, spec, enrichment_sources(spark, sf_dir)).select("c_custkey", "route", "content")


@query(
    "enrich_by_filter",
    """
    with found as (select c_nationkey, count(*) as n, min(c_mktsegment) as seg from customer group by 1)
    select s_suppkey, case when n > 1 then 'failure' else 'success' end as route,
           case when n > 1 then null else coalesce(seg, 'nobody') end as segment
    from supplier left join found on c_nationkey = s_nationkey
    """,
)
def enrich_filter(spark, sf_dir):
    """A lookup through a cell's value: one match gives its last cell, several are a failure."""
    spec = {
        "extract-to-attributes": {
            "segment": {
                "value": "${s_nationkey}", "type": "HBASE_FILTER", "hbase-table": "customer",
                "match": {"family": "f", "qualifier": "nation"}, "default": "nobody",
            }
        }
    }
    suppliers = table(spark, sf_dir, "supplier")
    return enrich(suppliers, spec, enrichment_sources(spark, sf_dir)).select("s_suppkey", "route", "segment")


# -- keyed cells ---------------------------------------------------------------

_SCAN = """
    select cast(c_custkey as varchar) as id, c_name as name, cast(c_nationkey as varchar) as nation,
           c_mktsegment as segment, row_number() over (order by cast(c_custkey as varchar)) as fragment_index,
           count(*) over () as fragment_count from customer
"""


def _scan(name_format: str, prefix_f: str, prefix_g: str):
    def run(spark, sf_dir):
        names = {prefix_f + "name": "name", prefix_f + "nation": "nation", prefix_g + "segment": "segment"}
        out = scan_cells(
            customer_cells(spark, sf_dir), row_key_name="id", name_format=name_format, table_name="customers",
            names=list(names), hot_rows=500,
        )
        return out.withColumnsRenamed(names).select("id", "name", "nation", "segment", "fragment_index", "fragment_count")

    return run


query("scan_cells", _SCAN)(_scan("qualifier", "", ""))
query("scan_cells_family_qualifier", _SCAN)(_scan("family.qualifier", "f.", "g."))
query("scan_cells_table_qualifier", _SCAN)(_scan("tablename.qualifier", "customers.", "customers."))
query("scan_cells_table_family_qualifier", _SCAN)(_scan("tablename.family.qualifier", "customers.f.", "customers.g."))


@query(
    "scan_cells_filtered",
    """
    select cast(c_custkey as varchar) as row_key, c_mktsegment as segment, 3 as n_cells from customer
    where c_nationkey in (3, 4, 5)
    """,
)
def scan_map(spark, sf_dir):
    nation = (F.col("qualifier") == "nation") & F.col("value").isin("3", "4", "5")
    out = scan_cells(customer_cells(spark, sf_dir), having=nation, fragments=False)
    cells = F.col("attributes")
    return out.select("row_key", F.try_element_at(cells, F.lit("segment")).alias("segment"), F.size(cells).alias("n_cells"))


def order_keys(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("row_key"))


def status_cells(spark, sf_dir):
    """New cells from orders: two existing cells of the customer rows get requests, in order-key order."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("row_key"),
        F.lit("g").alias("family"),
        F.when(F.col("o_orderstatus") == "F", F.lit("segment")).otherwise(F.lit("status")).alias("qualifier"),
        F.col("o_orderpriority").alias("value"),
        "o_orderkey",
    )


_CELLS = """
    cells as (
      select cast(c_custkey as varchar) as row_key, 'f' as family, 'name' as qualifier, c_name as value from customer union all
      select cast(c_custkey as varchar), 'f', 'nation', cast(c_nationkey as varchar) from customer union all
      select cast(c_custkey as varchar), 'g', 'segment', c_mktsegment from customer),
    new as (
      select cast(o_custkey as varchar) as row_key, 'g' as family,
             case when o_orderstatus = 'F' then 'segment' else 'status' end as qualifier, o_orderpriority as value, o_orderkey
      from orders)
"""


@query(
    "kt_get",
    "select o_orderkey, c_mktsegment as segment from orders left join customer on c_custkey = o_custkey",
)
def get(spark, sf_dir):
    out = kt_get(order_keys(spark, sf_dir), customer_cells(spark, sf_dir), "g", "segment", into="segment")
    return out.select("o_orderkey", "segment")


@query(
    "kt_contains",
    "select p_partkey, case when c_custkey is null then 0 else 1 end as present from part left join customer on c_custkey = p_partkey",
)
def contains(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey")
    return kt_contains(parts, customer_cells(spark, sf_dir), "p_partkey").withColumn("present", F.col("present").cast("int"))


@query(
    "kt_put",
    f"""
    with {_CELLS}, last as (
      select * from new qualify row_number() over (partition by row_key, qualifier order by o_orderkey desc) = 1)
    select row_key, family, qualifier, value from last
    union all
    select * from cells where not exists (
      select 1 from last where last.row_key = cells.row_key and last.family = cells.family and last.qualifier = cells.qualifier)
    """,
)
def put(spark, sf_dir):
    return kt_put(customer_cells(spark, sf_dir), status_cells(spark, sf_dir), ["o_orderkey"])


_IF_ABSENT = f"""
    with {_CELLS}, requests as (
      select new.*, cells.value as old, row_number() over (partition by new.row_key, new.qualifier order by o_orderkey) as turn,
             first_value(new.value) over (partition by new.row_key, new.qualifier order by o_orderkey) as first_new
      from new left join cells on new.row_key = cells.row_key and new.family = cells.family and new.qualifier = cells.qualifier)
"""


@query(
    "kt_put_if_absent",
    f"{_IF_ABSENT} select o_orderkey, case when old is null and turn = 1 then 1 else 0 end as inserted from requests",
)
def put_if_absent(spark, sf_dir):
    change = kt_put_if_absent(customer_cells(spark, sf_dir), status_cells(spark, sf_dir), ["o_orderkey"])
    return change.results.select("o_orderkey", F.col("inserted").cast("int").alias("inserted"))


@query(
    "kt_put_if_absent_table",
    f"""
    {_IF_ABSENT} select * from cells union all
    select row_key, family, qualifier, value from requests where old is null and turn = 1
    """,
)
def put_if_absent_table(spark, sf_dir):
    return kt_put_if_absent(customer_cells(spark, sf_dir), status_cells(spark, sf_dir), ["o_orderkey"]).cells


@query(
    "kt_get_and_put_if_absent",
    f"""
    {_IF_ABSENT} select o_orderkey, case when old is null and turn = 1 then null else coalesce(old, first_new) end as old_value
    from requests
    """,
)
def get_and_put(spark, sf_dir):
    change = kt_get_and_put_if_absent(customer_cells(spark, sf_dir), status_cells(spark, sf_dir), ["o_orderkey"])
    return change.results.select("o_orderkey", "old_value")


@query(
    "kt_check_and_put",
    f"""
    {_IF_ABSENT} select o_orderkey, case
      when turn = 1 and old is not distinct from case when qualifier = 'segment' then 'BUILDING' end then 'put'
      else 'refused' end as outcome
    from requests
    """,
)
def check_and_put(spark, sf_dir):
    expected = F.when(F.col("qualifier") == "segment", F.lit("BUILDING"))
    requests = status_cells(spark, sf_dir).withColumn("expected", expected)
    change = kt_check_and_put(customer_cells(spark, sf_dir), requests, ["o_orderkey"])
    return change.results.select("o_orderkey", "outcome")


@query(
    "kt_check_and_put_table",
    f"""
    {_IF_ABSENT}, puts as (
      select * from requests where turn = 1 and old is not distinct from case when qualifier = 'segment' then 'BUILDING' end)
    select row_key, family, qualifier, value from puts
    union all
    select * from cells where not exists (
      select 1 from puts where puts.row_key = cells.row_key and puts.family = cells.family and puts.qualifier = cells.qualifier)
    """,
)
def check_and_put_table(spark, sf_dir):
    expected = F.when(F.col("qualifier") == "segment", F.lit("BUILDING"))
    requests = status_cells(spark, sf_dir).withColumn("expected", expected)
    return kt_check_and_put(customer_cells(spark, sf_dir), requests, ["o_orderkey"]).cells


@query(
    "kt_check_and_put_chain",
    """
    with recursive asked as (
      select o_orderkey, o_custkey, o_orderstatus as v, case o_orderkey % 3 when 0 then 'F' when 1 then 'O' end as e,
             row_number() over (partition by o_custkey order by o_orderkey) as turn from orders),
    decided as (
      select o_orderkey, o_custkey, turn, case when e is null then v end as state,
             case when e is null then 'put' else 'refused' end as outcome from asked where turn = 1
      union all
      select a.o_orderkey, a.o_custkey, a.turn, case when a.e is not distinct from d.state then a.v else d.state end,
             case when a.e is not distinct from d.state then 'put' else 'refused' end
      from asked a join decided d on a.o_custkey = d.o_custkey and a.turn = d.turn + 1)
    select o_orderkey, outcome from decided
    """,
)
def check_and_put_chain(spark, sf_dir):
    """Requests that expect what earlier ones of the same call left behind."""
    number = F.col("o_orderkey") % 3
    requests = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("row_key"), F.lit("g").alias("family"), F.lit("state").alias("qualifier"),
        F.col("o_orderstatus").alias("value"), F.when(number == 0, F.lit("F")).when(number == 1, F.lit("O")).alias("expected"),
        "o_orderkey",
    )
    change = kt_check_and_put(customer_cells(spark, sf_dir), requests, ["o_orderkey"])
    return change.results.select("o_orderkey", "outcome")


@query(
    "kt_get_by_filter",
    "select 1 as rows_found, c_mktsegment as value, 'success' as route from customer where c_name = 'Customer#000000007'",
)
def get_by_filter(spark, sf_dir):
    one = (F.col("qualifier") == "name") & (F.col("value") == "Customer#000000007")
    return kt_get_by_filter(customer_cells(spark, sf_dir), one, "g", "segment").select("rows_found", "value", "route")


@query(
    "kt_last_cell_by_filter",
    "select count(*) as rows_found, null as value, 'failure' as route from customer where c_mktsegment = 'BUILDING'",
)
def last_by_filter(spark, sf_dir):
    many = (F.col("qualifier") == "segment") & (F.col("value") == "BUILDING")
    return kt_last_cell_by_filter(customer_cells(spark, sf_dir), many).select("rows_found", "value", "route")


@query(
    "kt_last_cell_by_filter_value",
    "select 1 as rows_found, c_mktsegment as value, 'success' as route from customer where c_name = 'Customer#000000007'",
)
def last_by_filter_value(spark, sf_dir):
    one = (F.col("qualifier") == "name") & (F.col("value") == "Customer#000000007")
    return kt_last_cell_by_filter(customer_cells(spark, sf_dir), one).select("rows_found", "value", "route")


@query(
    "kt_remove",
    f"with {_CELLS} select * from cells where row_key not in (select cast(s_suppkey as varchar) from supplier)",
)
def remove(spark, sf_dir):
    return kt_remove(customer_cells(spark, sf_dir), table(spark, sf_dir, "supplier"), "s_suppkey").cells


@query(
    "kt_remove_results",
    "select p_partkey, case when c_custkey is null then 0 else 1 end as existed from part left join customer on c_custkey = p_partkey",
)
def remove_results(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey")
    change = kt_remove(customer_cells(spark, sf_dir), parts, "p_partkey")
    return change.results.withColumn("existed", F.col("existed").cast("int"))


@query("sql_rows_template", _ROWS)
def rows_of_template(spark, sf_dir):
    """As sql_rows, the row's key written into the query's text, outside quotes and (as text) within."""
    orders = view(spark, sf_dir, "orders")
    text = f"""
        select o_orderkey, o_orderstatus from {orders} -- of customer ${{c_custkey}}
        where o_custkey = ${{c_custkey}} and concat('c-', o_custkey) = 'c-${{c_custkey}}';
    """
    out = sql_rows(table(spark, sf_dir, "customer").select("c_custkey"), text, order_by=["o_orderkey"])
    # numbers in order of the key, which the row's text order is not
    return out.select("c_custkey", "o_orderkey", "o_orderstatus", "fragment_index", "fragment_count", "route")


@query(
    "sql_scalar_template",
    """
    select c_custkey, case when c_custkey % 10 = 0 then 'failure' else 'success' end as route,
           case when c_custkey % 10 <> 0 then cast(count(o_orderkey) as varchar) end as orders
    from customer left join orders on o_custkey = c_custkey group by c_custkey
    """,
)
def scalar_of_template(spark, sf_dir):
    """A count for each row; text that is no number outside quotes fails its row."""
    orders = view(spark, sf_dir, "orders")
    number = F.concat(F.col("c_custkey").cast("string"), F.when(F.col("c_custkey") % 10 == 0, F.lit("?")).otherwise(F.lit("")))
    customers = table(spark, sf_dir, "customer").select("c_custkey", number.alias("number"))
    out = sql_scalar(customers, f"select count(*) from {orders} where o_custkey = ${{number}}", into="orders")
    return out.select("c_custkey", "route", "orders")


@query(
    "enrich_sql_template",
    f"""
    select c_custkey, coalesce(o_orderstatus, '-') as first_status, coalesce(n, 0) as orders, 'success' as route
    from customer left join {_FIRST_ORDER} f on f.o_custkey = c_custkey
      left join (select o_custkey, count(*) as n from orders where o_orderstatus = 'F' group by 1) g on g.o_custkey = c_custkey
    """,
)
def enrich_templated(spark, sf_dir):
    orders = view(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.lit("F").alias("wanted"))
    spec = {
        "extract-to-attributes": {
            "first_status": {
                "type": "SQL", "value": f"select o_orderstatus, o_orderkey from {orders} where o_custkey = ${{c_custkey}}",
                "order-by": ["o_orderkey"], "default": "-",
            },
            "orders": {
                "type": "SQL", "value": f"select count(*) from {orders} where o_custkey = ${{c_custkey}} and o_orderstatus = '${{wanted}}'",
                "to-type": "long",
            },
        }
    }
    return enrich(customers, spec).select("c_custkey", "first_status", "orders", "route")


@query(
    "enrich_failures",
    """
    select c_custkey, kind, 'failure' as route, 'before' as content,
      case kind when 'cache' then 'x: there is no cache to look in' when 'table' then 'x: there is no table gone to look in'
        when 'argument' then 'x: hbase-table argument missing' else 'x: no column for ${nope} outside quotes in: select ${nope}' end as reason
    from customer, (values ('cache'), ('table'), ('argument'), ('query')) as k(kind)
    """,
)
def enrich_that_fails(spark, sf_dir):
    """Entries that cannot be looked up at all send every row to failure, content untouched."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.lit("before").alias("content"))
    broken = {
        "cache": {"value": "${c_custkey}", "type": "CACHE"},
        "table": {"value": "${c_custkey}", "type": "HBASE", "hbase-table": "gone"},
        "argument": {"value": "${c_custkey}", "type": "HBASE"},
        "query": {"value": "select ${nope}", "type": "SQL"},
    }
    tables = {"tables": enrichment_sources(spark, sf_dir)["tables"]}
    out = None
    for kind, entry in broken.items():
        rows = enrich(customers.withColumn("kind", F.lit(kind)), {"extract-to-json": {"x": entry}}, tables)
        out = rows if out is None else out.unionAll(rows)
    return out.select("c_custkey", "kind", "route", "content", F.col("failure_reason").alias("reason"))


@query(
    "enrich_spec_column",
    """
    select c_custkey, case when c_custkey % 4 = 3 or c_custkey % 4 = 2 and c_custkey % 20 = 2 then 'failure' else 'success' end as route,
      case when c_custkey % 4 = 0 then '{"nation":"' || n_name || '","no":' || c_nationkey || '}'
        when c_custkey % 4 = 2 and c_custkey % 20 <> 2 then '{"segment":"' || c_mktsegment || '"}' else 'before' end as content,
      case when c_custkey % 4 = 1 then coalesce(cast(s_nationkey as varchar), 'none') end as supplier_nation,
      case when c_custkey % 4 = 3 then 'the spec is no JSON object'
        when c_custkey % 20 = 2 then 'segment: there is no table gone to look in' end as reason
    from customer left join nation on n_nationkey = c_nationkey left join supplier on s_suppkey = c_custkey
    """,
)
def enrich_by_own_spec(spark, sf_dir):
    """Four kinds of specs in a column: cache and typed literal, cell with default, cell of one's own key, broken."""
    which = F.col("c_custkey") % 4
    gone = F.when(F.col("c_custkey") % 20 == 2, F.lit("gone")).otherwise(F.lit("customer"))
    spec = (
        F.when(which == 0, F.lit('{"extract-to-json":{"nation":{"value":"${c_nationkey}","type":"CACHE"},"no":{"value":"${c_nationkey}","to-type":"long"}}}'))
        .when(which == 1, F.lit('{"extract-to-attributes":{"supplier_nation":{"value":"${c_custkey}","type":"HBASE","hbase-table":"supplier","default":"none"}}}'))
        .when(which == 2, F.concat(F.lit('{"extract-to-json":{"segment":{"value":"${c_custkey}","type":"HBASE_SCAN","hbase-table":"'), gone, F.lit('"}}}')))
        .otherwise(F.lit("{broken"))
    )
    customers = table(spark, sf_dir, "customer").withColumns({"spec": spec, "content": F.lit("before")})
    out = enrich_each(customers, "spec", enrichment_sources(spark, sf_dir))
    return out.select(
        "c_custkey", "route", "content", F.try_element_at("attributes", F.lit("supplier_nation")).alias("supplier_nation"),
        F.col("failure_reason").alias("reason"),
    )


@query(
    "enrich_many_lookups",
    """
    select c_custkey, a.n_name as c0, b.n_name as c1, d.n_name as c2, coalesce(e.n_name, 'none') as c3
    from customer left join nation a on a.n_nationkey = c_nationkey left join nation b on b.n_nationkey = c_custkey % 25
      left join nation d on d.n_nationkey = (c_custkey + c_nationkey) % 25 left join nation e on e.n_nationkey = c_custkey
    """,
)
def enrich_many(spark, sf_dir):
    """Several entries of one lookup meet it in one join."""
    customers = table(spark, sf_dir, "customer").withColumns({
        "k1": F.col("c_custkey") % 25, "k2": (F.col("c_custkey") + F.col("c_nationkey")) % 25,
    })
    keys = {"c0": "${c_nationkey}", "c1": "${k1}", "c2": "${k2}"}
    entries = {name: {"value": key, "type": "CACHE"} for name, key in keys.items()}
    entries["c3"] = {"value": "${c_custkey}", "type": "CACHE", "default": "none"}
    out = enrich(customers, {"extract-to-attributes": entries}, enrichment_sources(spark, sf_dir))
    return out.select("c_custkey", *entries)
