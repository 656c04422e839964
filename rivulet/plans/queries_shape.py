"""Queries of the shaping, XML and function operators."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from .. import functions as X
from ..operators import (
    attributes_to_json,
    columns_to_json,
    content_to_column,
    json_to_columns,
    json_to_csv,
    promote,
    route_counts,
    split_routes,
    update_columns,
    validate_xml,
    xml_extract,
    xml_to_columns,
)
from ..session import work_path, write_text
from .inputs import checked_xml, mixed_documents, order_arrays, order_documents, order_xml
from .registry import query, spread, table


@query(
    "json_to_columns",
    "select event_id, cast(json_extract_string(props, '$.k') as bigint) as k, 'success' as route from events",
)
def json_typed(spark, sf_dir):
    events = spread(table(spark, sf_dir, "events")).select("event_id", "props")
    out = json_to_columns(events, "props", fields={"k": "bigint"}, fragments="never", emit_original=False)
    return out.select("event_id", "k", "route")


@query(
    "json_to_columns_map",
    """
    select o_orderkey, cast(o_orderkey as varchar) as id, o_orderstatus as status, '' as note,
           0 as has_nested, 4 as n_names, 'success' as route, null as kept_content from orders
    union all
    select o_orderkey, null, null, null, null, null, 'original',
           '{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '","o_orderpriority":"' ||
           o_orderpriority || '","o_note":null,"nested":{"o_custkey":' || o_custkey || '},"listed":[' || o_custkey || ']}'
    from orders
    """,
)
def json_map(spark, sf_dir):
    out = json_to_columns(order_documents(spark, sf_dir))
    found = F.col("attributes")
    return out.select(
        "o_orderkey",
        F.try_element_at(found, F.lit("o_orderkey")).alias("id"),
        F.try_element_at(found, F.lit("o_orderstatus")).alias("status"),
        F.try_element_at(found, F.lit("o_note")).alias("note"),
        (F.map_contains_key(found, "nested") | F.map_contains_key(found, "listed")).cast("int").alias("has_nested"),
        F.when(found.isNotNull(), F.size(found)).alias("n_names"),
        "route",
        F.col("content").alias("kept_content"),
    )


@query(
    "json_array_fragments",
    """
    select o_orderkey, 1 as fragment_index, 2 as fragment_count, '0' as fragment_size,
           o_orderstatus as status, null as priority, 'success' as route from orders
    union all
    select o_orderkey, 2, 2, '0', null, o_orderpriority, 'success' from orders
    union all
    select o_orderkey, null, null, null, null, null, 'original' from orders
    """,
)
def json_fragments(spark, sf_dir):
    out = promote(json_to_columns(order_arrays(spark, sf_dir), fragments="arrays"), ["o_orderstatus", "o_orderpriority"])
    return out.select(
        "o_orderkey", "fragment_index", "fragment_count", "fragment_size",
        F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"), "route",
    )


@query(
    "json_rename_prefix",
    """
    select o_orderkey, cast(o_orderkey as varchar) as p_id, '' as p_extra, o_orderstatus as p_o_orderstatus,
           '' as p_o_note from orders
    """,
)
def json_rename(spark, sf_dir):
    names = {"o_orderkey": "id", "absent": "extra"}
    out = json_to_columns(order_documents(spark, sf_dir), prefix="p_", rename=names, emit_original=False)
    wanted = ["p_id", "p_extra", "p_o_orderstatus", "p_o_note"]
    return promote(out, wanted).select("o_orderkey", *wanted)


@query(
    "json_to_csv",
    """
    select o_orderkey, 'success' as route,
           '"o_orderkey","o_orderpriority","gone"' || chr(10) || '"' || o_orderkey || '","","' || '"' || chr(10) ||
           '"' || o_orderkey || '","' || replace(o_orderpriority, '"', '""') || '",""' as csv from orders
    """,
)
def csv_of_arrays(spark, sf_dir):
    # The second element is text that holds an object.
    orders = spread(table(spark, sf_dir, "orders"))
    first = F.to_json(F.struct("o_orderkey", "o_orderstatus"))
    second = F.to_json(F.struct("o_orderkey", "o_orderpriority"))
    text = F.concat(F.lit("["), first, F.lit(","), F.lit('"'), F.replace(second, F.lit('"'), F.lit('\\"')), F.lit('"]'))
    out = json_to_csv(orders.select("o_orderkey", text.alias("content")), ["o_orderkey", "o_orderpriority", "gone"])
    return out.select("o_orderkey", "route", F.col("content").alias("csv"))


@query(
    "json_to_csv_plain",
    """
    select event_id, case when event_type = 'error' then 'failure' else 'success' end as route,
           case when event_type = 'error' then left(props, length(props) - 1) when event_type = 'signup' then ''
                else json_extract_string(props, '$.k') || '|' end as csv from events
    """,
)
def csv_plain(spark, sf_dir):
    out = json_to_csv(mixed_documents(spark, sf_dir), ["k", "z"], delimiter="|", header=False, quoted=False)
    return out.select("event_id", "route", F.col("content").alias("csv"))


@query(
    "columns_to_json",
    """
    select p_partkey, '{"brand":"' || p_brand || '","gone":null,"p_size":"' || p_size || '","source":"part ' ||
           p_partkey || '","type":"' || p_type || '"}' as content from part
    """,
)
def columns_json(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(
        "p_partkey", "p_size", F.col("p_brand").alias("in.brand"), F.col("p_type").alias("in.type")
    )
    out = columns_to_json(
        part, prefix="in.", regex="p_s.*", names="gone", constants_={"source": "part ${p_partkey}"}
    )
    return out.select("p_partkey", "content")


@query(
    "attributes_to_json",
    """
    select o_orderkey, '{"id":"' || o_orderkey || '","o_orderstatus":"' || o_orderstatus || '","src":"orders"}' as content
    from orders
    """,
)
def map_json(spark, sf_dir):
    flat = json_to_columns(order_documents(spark, sf_dir), rename={"o_orderkey": "x.id"}, emit_original=False)
    out = attributes_to_json(flat, prefix="x.", regex=".*status", constants_={"src": "orders"})
    return out.select("o_orderkey", "content")


@query("content_to_column", "select doc_id, text as content, lang || ':' || text as body from documents")
def copy_content(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", F.col("text").alias("content"))
    return content_to_column(docs, "body", "concat(lang, ':', body)").select("doc_id", "content", "body")


@query(
    "update_columns",
    """
    select c_custkey, 'Dear ' || c_name as content, 'seg-' || c_mktsegment as tag,
           'seg-' || c_mktsegment || '/' || c_nationkey as path, '${c_name}' as raw, 'success' as route from customer
    """,
)
def set_columns(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").withColumn("content", F.lit("old"))
    out = update_columns(
        customer, "Dear ${c_name}", {"tag": "seg-${c_mktsegment}", "path": "${tag}/${c_nationkey}"},
        eval_content=True, eval_columns=True,
    )
    out = update_columns(out, columns={"raw": "${c_name}"})
    return out.select("c_custkey", "content", "tag", "path", "raw", "route")


@query(
    "update_columns_recursive",
    """
    select c_custkey, case when c_mktsegment = 'BUILDING' then 'failure' else 'success' end as route,
           case when c_mktsegment <> 'BUILDING' then 'Dear ' || c_name end as content from customer
    """,
)
def set_recursive(spark, sf_dir):
    # Each hop refers to the next column; for one segment the last hop grows for ever.
    hop2 = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("${hop2}+")).otherwise(F.lit("${c_name}"))
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", F.lit("").alias("content"), F.lit("Dear ${hop2}").alias("hop1"), hop2.alias("hop2")
    )
    out = update_columns(customer, "${hop1}", eval_content=True, recursive=True)
    return out.select("c_custkey", "route", F.when(F.col("route") == "success", F.col("content")).alias("content"))


@query(
    "update_columns_deep",
    """
    select c_custkey, case when c_mktsegment = 'BUILDING' then 'old' else 'at ' || c_name end as content,
           case when c_mktsegment = 'BUILDING' then 'failure' else 'success' end as route from customer
    """,
)
def set_deep(spark, sf_dir):
    """Twelve hops, each to an earlier column; for one segment the first leads back to the last."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", F.lit("old").alias("content"))
    first = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("${hop12}")).otherwise(F.lit("${c_name}"))
    hops = customer.withColumn("hop1", first)
    hops = hops.withColumns({f"hop{i}": F.lit(f"${{hop{i - 1}}}") for i in range(2, 13)})
    out = update_columns(hops, "at ${hop12}", eval_content=True, recursive=True)
    return out.select("c_custkey", "content", "route")


@query(
    "split_routes",
    """
    select event_id, k from (
      select event_id, cast(json_extract_string(props, '$.k') as bigint) as k, event_id % 3 = 0 as bad from events) where not bad
    union all
    select event_id, null from events where event_id % 3 = 0
    """,
)
def by_route(spark, sf_dir):
    """Broken texts in every third row; both outputs put together again."""
    events = table(spark, sf_dir, "events")
    text = F.when(F.col("event_id") % 3 == 0, F.lit("{broken")).otherwise(F.col("props"))
    out = json_to_columns(events.select("event_id", text.alias("props")), "props", fields={"k": "bigint"}, fragments="never", emit_original=False)
    parts = split_routes(out, ["success", "failure"])
    return parts["success"].select("event_id", "k").unionByName(parts["failure"].select("event_id", F.lit(None).cast("bigint").alias("k")))


@query(
    "xml_extract",
    """
    select o_orderkey, cast(o_orderkey as varchar) as id, '2' as last_no, '' as nothing,
           '1' || o_orderpriority || '2' || o_custkey as all_lines, 'success' as route from orders
    """,
)
def extract_xml(spark, sf_dir):
    paths = {
        "id": "/order/head/id",
        "last_no": "/order/lines/line[last()]/no",
        "nothing": "/order/none",
        "all_lines": "/order/lines",
    }
    return xml_extract(order_xml(spark, sf_dir), paths).select("o_orderkey", *paths, "route")


_XML_LINES = """
    select o_orderkey, '1' as no, o_orderpriority as what, 1 as fragment_index, 2 as fragment_count, 'success' as route
    from orders
    union all
    select o_orderkey, '2', cast(o_custkey as varchar), 2, 2, 'success' from orders
    union all
    select o_orderkey, null, null, null, null, 'original' from orders
"""


@query("xml_to_columns_table", _XML_LINES)
def xml_table(spark, sf_dir):
    out = promote(xml_to_columns(order_xml(spark, sf_dir), "/order/lines"), ["no", "what"])
    return out.select("o_orderkey", "no", "what", "fragment_index", "fragment_count", "route")


@query("xml_to_columns_fields", _XML_LINES)
def xml_table_native(spark, sf_dir):
    out = xml_to_columns(order_xml(spark, sf_dir), "/order/lines", fields=["no", "what"], record_tag="line")
    return out.select("o_orderkey", "no", "what", "fragment_index", "fragment_count", "route")


@query(
    "xml_to_columns_record",
    """
    select o_orderkey, cast(o_orderkey as varchar) as x_key, o_orderstatus as x_status, '' as key, null as fragment_index
    from orders
    """,
)
def xml_record(spark, sf_dir):
    out = xml_to_columns(
        order_xml(spark, sf_dir), "/order/head", "record", prefix="x_", rename={"id": "key"}, emit_original=False
    )
    return promote(out, ["x_key", "x_status", "key"]).select("o_orderkey", "x_key", "x_status", "key", "fragment_index")


ORDER_XSD = """<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema">
<xs:element name="order"><xs:complexType><xs:sequence>
<xs:element name="id" type="xs:integer"/><xs:element name="status" type="xs:string"/>
</xs:sequence></xs:complexType></xs:element></xs:schema>"""


@query(
    "validate_xml",
    """
    select o_orderkey, case when o_orderpriority in ('5-LOW', '3-MEDIUM') then 'invalid' else 'success' end as route
    from orders
    """,
)
def check_xml(spark, sf_dir):
    return validate_xml(checked_xml(spark, sf_dir), xsd_text=ORDER_XSD).select("o_orderkey", "route")


@query(
    "route_counts",
    """
    select route, count(*) as records from (
      select case when event_type in ('error', 'signup') then 'failure' else 'original' end as route from events
      union all
      select 'success' from events where event_type not in ('error', 'signup')) group by route
    """,
)
def count_routes(spark, sf_dir):
    return route_counts(json_to_columns(mixed_documents(spark, sf_dir)))


@query(
    "scalar_functions",
    """
    select p_partkey, upper(p_name) as up, lower(p_type) as low,
           case when p_type = 'SMALL' then p_partkey end as as_long,
           case when p_type = 'SMALL' then 0 else 1 end as bad_long,
           cast(p_size as double) as as_double, coalesce(nullif(p_type, 'LARGE'), 'none') as or_default,
           'widget' as bare_name, 'dw.' || p_name as moved, p_name as dropped,
           '''' || replace(p_name, 'e', '''''') || '''' as literal, '"' || replace(p_name, 'e', '""') || '"' as csv,
           case when p_type = 'SMALL' then 'LITTLE' else p_type end as mapped, 'part ' || p_name || '/' as rendered,
           p_name as round_trip from part
    """,
)
def scalar_functions(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    name, kind = F.col("p_name"), F.col("p_type")
    digits = F.concat(F.col("p_partkey").cast("string"), F.when(kind == "SMALL", F.lit("")).otherwise(F.lit(" ")))
    as_long, bad_long = X.convert_type(digits, "long")
    as_double, _ = X.convert_type(F.col("p_size").cast("string"), "decimal")
    qualified = F.concat(F.lit("src."), name)
    mapped = X.map_column_name_expr(F.lit("part"), kind, {"part.SMALL": "little"}, "upper")
    return part.select(
        "p_partkey",
        X.apply_case(name, "Upper").alias("up"),
        X.apply_case(kind, "Lower").alias("low"),
        as_long.alias("as_long"),
        bad_long.cast("int").alias("bad_long"),
        as_double.alias("as_double"),
        X.to_text(F.nullif(kind, F.lit("LARGE")), "none").alias("or_default"),
        X.strip_qualifier_expr(F.lit("a.b.widget")).alias("bare_name"),
        X.override_schema(qualified, "dw").alias("moved"),
        X.override_schema(qualified, "").alias("dropped"),
        X.sql_literal(F.replace(name, F.lit("e"), F.lit("'"))).alias("literal"),
        X.csv_quote(F.replace(name, F.lit("e"), F.lit('"'))).alias("csv"),
        mapped.alias("mapped"),
        X.render_template("part ${p_name}/${none}", part.columns).alias("rendered"),
        X.decode_content(X.encode_content(name)).alias("round_trip"),
    )


_DIRTY_XML = """
    select o_orderkey, case o_orderkey % 5 when 1 then 'failure' else 'success' end as route,
      case o_orderkey % 5 when 0 then o_orderstatus when 2 then ' ' || o_orderstatus || ' ' when 4 then o_orderstatus || '&' end as status,
      case o_orderkey % 5 when 4 then o_orderpriority end as priority
    from orders where o_orderkey % 5 <> 3
"""


def dirty_xml(spark, sf_dir):
    """By key: plain, text after the end, blanks around the value, another root, prefixed and nested names with an escape."""
    status, kind = F.col("o_orderstatus"), F.col("o_orderkey") % 5
    plain = F.concat(F.lit("<o><line><status>"), status, F.lit("</status></line></o>"))
    text = (
        F.when(kind == 0, plain).when(kind == 1, F.concat(plain, F.lit("junk")))
        .when(kind == 2, F.concat(F.lit("<o><line><status> "), status, F.lit(" </status></line><note/></o>")))
        .when(kind == 3, F.concat(F.lit("<other><line><status>"), status, F.lit("</status></line></other>")))
        .otherwise(F.concat(
            F.lit('<o xmlns:n="urn:n"><line><status><b>'), status, F.lit("</b>&amp;</status><n:priority>"), F.col("o_orderpriority"),
            F.lit("</n:priority></line></o>"),
        ))
    )
    return spread(table(spark, sf_dir, "orders")).select("o_orderkey", text.alias("content"))


@query("xml_to_columns_dirty", _DIRTY_XML)
def xml_dirty(spark, sf_dir):
    out = xml_to_columns(dirty_xml(spark, sf_dir), "/o", fields=["status", "n:priority"], record_tag="line", emit_original=False)
    return out.select("o_orderkey", "route", "status", F.col("`n:priority`").alias("priority"))


@query("xml_to_columns_dirty_map", _DIRTY_XML)
def xml_dirty_map(spark, sf_dir):
    """The same documents without naming the fields."""
    out = xml_to_columns(dirty_xml(spark, sf_dir), "/o", record_tag="line", emit_original=False)
    named = {"status": "status", "priority": "n:priority"}
    return out.select("o_orderkey", "route", *[F.try_element_at("attributes", F.lit(n)).alias(c) for c, n in named.items()])


@query(
    "validate_xml_namespaces",
    "select o_orderkey, case when o_orderkey % 4 = 3 then 'invalid' else 'success' end as route from orders",
)
def check_xml_of_namespaces(spark, sf_dir):
    """A set of schemas, two of one namespace and one without any; a root of none of them is invalid."""
    paths = []
    for name, target in (("a", "urn:a"), ("b", "urn:a"), ("c", "")):
        head = f' targetNamespace="{target}"' if target else ""
        paths.append(os.path.join(work_path(spark, "xsd"), f"{name}.xsd"))
        write_text(
            spark, paths[-1],
            f'<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema"{head}><xs:element name="{name}" type="xs:integer"/></xs:schema>',
        )
    kind = F.col("o_orderkey") % 4
    tag = F.when(kind == 0, F.lit("a")).when(kind == 1, F.lit("b")).otherwise(F.lit("c"))
    space = F.when(kind == 2, F.lit("")).otherwise(F.lit(' xmlns="urn:a"'))
    text = F.concat(F.lit("<"), tag, space, F.lit(">"), F.col("o_orderkey").cast("string"), F.lit("</"), tag, F.lit(">"))
    orders = spread(table(spark, sf_dir, "orders")).select("o_orderkey", text.alias("content"))
    return validate_xml(orders, xsd_path=paths).select("o_orderkey", "route")
