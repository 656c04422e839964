"""XML extraction, flattening and validation."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping, Sequence
from xml.sax.saxutils import quoteattr

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import last_key_wins, path_exists, read_text, work_path, write_text
from .routing import failing, with_route
from .shape import added_names, empty_entries, one_row_per_record, renamed

BAD_XML = "the text is not well-formed XML"


#: What may stand before a root: a declaration, and a document type without declarations of its own.
PROLOG = (
    r"""^(?:<\?xml\s+version\s*=\s*["']1\.0["'](?:\s+encoding\s*=\s*["'][A-Za-z][\w.-]*["'])?"""
    r"""(?:\s+standalone\s*=\s*["'](?:yes|no)["'])?\s*\?>)?\s*"""
    r"""(?:<!DOCTYPE\s+[A-Za-z_][\w:.-]*(?:\s+(?:SYSTEM|PUBLIC\s+"[\w /:.+-]*")\s+"[^"<>&]*")?\s*>)?"""
)


#: A text that begins with the only start tag of a name and ends with an end tag of it: one element, if it parses.
ONE_ELEMENT = r"(?s)^[ \t\r\n]*<([A-Za-z_][A-Za-z0-9_:.-]*)(?=[ \t\r\n>])(?!.*<\1[ \t\r\n/>]).*</\1[ \t\r\n]*>[ \t\r\n]*$"


def well_formed(xml: Column) -> Column:
    """Whether the whole text is one XML document (false for null).

    Spark's parser stops at the end of the root, so the text without its prolog is parsed inside an element whose name
    the text cannot hold; that must then have one element and no loose text. Where the names of its ends show that, the
    text is not parsed again to find out.
    """
    name = F.concat(F.lit("r"), F.md5(xml))
    body = F.regexp_replace(xml, PROLOG, "")
    inside = F.concat(F.lit("<"), name, F.lit(">"), body, F.lit("</"), name, F.lit(">"))
    parses = F.from_xml(inside, "_corrupt_record string")["_corrupt_record"].isNull()
    alone = F.xpath_boolean(inside, F.lit("count(/*/*) = 1 and not(/*/text()[normalize-space()])"))
    return xml.isNotNull() & F.when(parses, F.when(body.rlike(ONE_ELEMENT), True).otherwise(alone)).otherwise(False)


def xml_extract(
    df: DataFrame,
    paths: Mapping[str, str],
    *,
    source: str | None = None,
    lookup: DataFrame | None = None,
    lookup_key: Column | str | None = None,
) -> DataFrame:
    """Evaluate named XPath expressions to text columns (``''`` where nothing matches).

    The XML comes from the column ``source``, else from the ``lookup`` entry under ``lookup_key``, else from
    the content. Each path is fixed for the call; filter afterwards for a part that depends on the row.
    """
    work = df
    if source:
        work = work.withColumn("_rv_xml", F.col(source))
    elif lookup is not None and lookup_key is not None:
        from .lookup import attach_lookup

        work = attach_lookup(work, lookup, lookup_key, "_rv_xml")
    else:
        work = work.withColumn("_rv_xml", F.col("content"))
    work = work.withColumn("_rv_ok", well_formed(F.col("_rv_xml")))
    # One evaluation, hence one parse, for all paths; the separator is a character XML text cannot hold.
    separator = "\u0001"
    strings = [f"string({path})" for path in paths.values()]
    joined = strings[0] if len(strings) == 1 else f"concat({f", '{separator}', ".join(strings)})"
    found = F.split(F.xpath_string("_rv_xml", F.lit(joined)), separator, -1)
    work = work.withColumn("_rv_found", F.when(F.col("_rv_ok"), found))
    values = {name: F.get("_rv_found", F.lit(i)) for i, name in enumerate(paths)}
    reason = F.when(F.col("_rv_xml").isNull(), F.lit("no XML to evaluate")).when(~F.col("_rv_ok"), F.lit(BAD_XML))
    return failing(work.withColumns(values), reason).drop("_rv_xml", "_rv_ok", "_rv_found")


def _records_udf(root: str, table: bool, record_tag: str | None):
    """Child elements of each record below ``root`` as name to text; null for text that is no XML.

    Names are as written, prefixes included. Everything is defined inside, so that it travels to the workers by value.
    """

    def found_in(document, above):
        # a colon would mean a namespace to the path language, so names and paths have another character for it
        path = root.replace(":", "\uf03a")
        if path.startswith("/"):
            above.append(document)
            return above.findall("." + path)
        return document.findall(path)

    def records(text: str | None) -> list[dict[str, str]] | None:
        import xml.etree.ElementTree as ET
        from xml.parsers import expat

        if text is None:
            return None
        build = ET.TreeBuilder()
        parser = expat.ParserCreate()
        parser.buffer_text = True
        parser.StartElementHandler = lambda tag, attributes: build.start(tag.replace(":", "\uf03a"), attributes)
        parser.EndElementHandler = lambda tag: build.end(tag.replace(":", "\uf03a"))
        parser.CharacterDataHandler = build.data
        try:
            parser.Parse(text, True)
        except expat.ExpatError:
            return None
        found = found_in(build.close(), ET.Element("above"))
        if table:
            found = [child for parent in found for child in parent]
        if record_tag:
            found = [record for record in found if record.tag == record_tag.replace(":", "\uf03a")]
        return [{field.tag.replace("\uf03a", ":"): "".join(field.itertext()) for field in record} for record in found]

    @F.arrow_udf("array<map<string,string>>")
    def parse(texts: pa.Array) -> pa.Array:
        # Flat lists with offsets: rows to records, records to fields.
        row_ends, record_ends, names, values, bad = [0], [0], [], [], []
        for text in texts.to_pylist():
            found = records(text)
            bad.append(found is None)
            for record in found or ():
                names.extend(record)
                values.extend(record.values())
                record_ends.append(len(names))
            row_ends.append(len(record_ends) - 1)
        maps = pa.MapArray.from_arrays(record_ends, pa.array(names, pa.string()), pa.array(values, pa.string()))
        return pa.ListArray.from_arrays(pa.array(row_ends, pa.int32()), maps, mask=pa.array(bad, pa.bool_()))

    import xml.etree.ElementTree as ET

    found_in(ET.Element("none"), ET.Element("above"))  # a path that cannot be read fails here, not in the tasks
    return parse


def xml_to_columns(
    df: DataFrame,
    root: str = "/*",
    parse_type: str = "table",
    *,
    source: str = "content",
    prefix: str = "",
    rename: Mapping[str, str] | None = None,
    always_add: bool | Sequence[str] = True,
    fields: Sequence[str] | None = None,
    record_tag: str | None = None,
    emit_original: bool = True,
    into: str = "attributes",
) -> DataFrame:
    """Flatten XML records: one row per record, child element names with their text.

    ``table``: every child of ``root`` is a record, numbered as fragments. ``record``: each element matched
    by ``root`` is a record. Names differ per row, so they come as a map column ``into``; names in ``fields`` come as
    ordinary columns instead, null where a record has none of that name. ``record_tag`` takes the records of one name.
    Names and ``root`` are as written in the text, prefixes included; of a name that comes twice in a record the last
    stays. Routes: ``success`` rows, the ``original`` row, ``failure`` for malformed text, and for all rows if ``root``
    cannot be read as a path.
    """
    if parse_type not in ("table", "record"):
        raise ValueError("parse_type must be table or record")
    last_key_wins(df)
    rename = dict(rename or {})
    table = parse_type == "table"
    try:
        parse = _records_udf(root, table, record_tag)
    except (SyntaxError, KeyError, ValueError, TypeError) as error:
        return failing(df, F.lit(f"cannot read {root} as a path: {error}"))
    work = df.withColumn("_rv_records", parse(F.col(source)))

    def build(record: Column) -> dict[str, Column]:
        if fields:
            return {prefix + rename.get(name, name): F.try_element_at(record, F.lit(name)) for name in fields}
        return {into: _named(record, rename, prefix, always_add)}

    work = work.withColumn("_rv_reason", F.when(F.col("_rv_records").isNull(), F.lit(BAD_XML)))
    return one_row_per_record(df, work, build, F.lit(table), emit_original)


def _named(record: Column, rename: Mapping[str, str], prefix: str, always_add: bool | Sequence[str]) -> Column:
    out = record
    if rename or prefix:
        out = F.transform_keys(out, lambda k, v: F.concat(F.lit(prefix), renamed(k, rename)))
    # Always-added names carry no prefix here, unlike their JSON counterpart.
    added = added_names(rename, always_add)
    return F.map_concat(empty_entries(added), out) if added else out


def validate_xml(
    df: DataFrame,
    *,
    xsd_path: str | Sequence[str] | None = None,
    xsd_text: str | None = None,
    source: str = "content",
) -> DataFrame:
    """Validate against an XSD: ``success``, ``invalid`` (malformed text included) or ``failure``.

    A path wins over text and may list several files, by comma or as a sequence, of any target namespaces; a row is
    valid when the schema set taken together accepts it. With a schema that cannot be read every row is ``invalid``. Files must be reachable by the executors (a shared path).
    """
    spark = df.sparkSession
    paths = xsd_path.split(",") if isinstance(xsd_path, str) else list(xsd_path or [])
    paths = [p for p in paths if p]
    if paths:
        missing = [p for p in paths if not path_exists(spark, p)]
        if missing:
            return failing(df, F.lit(f"{missing[0]} (no such file)"))
        path = paths[0] if len(paths) == 1 else _wrapped(spark, paths)
    elif xsd_text:
        path = os.path.join(work_path(spark, "xsd"), "schema.xsd")
        write_text(spark, path, xsd_text)
    else:
        raise ValueError("give xsd_path or xsd_text")
    def parse(xml: Column) -> Column:
        return F.from_xml(xml, "_rv_any string, _corrupt_record string", {"rowValidationXSDPath": path})

    try:  # a schema that cannot be read would end the job in the tasks
        spark.range(1).select(parse(F.concat(F.lit("<a/>"), F.col("id").cast("string")))).collect()
    except (PySparkException, Py4JJavaError) as error:
        said = str(error).split("\n")
        told = next((line for line in said if "SAXParseException" in line), said[0])
        return with_route(df, "invalid", F.lit(f"the schema cannot be read: {told.strip()}"))
    text = F.coalesce(F.col(source), F.lit(""))
    parsed = parse(text)
    work = df.withColumn("_rv_bad", parsed["_corrupt_record"].isNotNull() | (F.trim(text) == ""))
    reason = F.when(F.col("_rv_bad"), F.lit("the XML does not satisfy the schema"))
    route = F.when(F.col("_rv_bad"), F.lit("invalid")).otherwise(F.lit("success"))
    return with_route(work, route, reason).drop("_rv_bad")


def _wrapped(spark, paths: Sequence[str]) -> str:
    """One schema that holds all of the given ones: those of a target namespace are imported, the others included."""
    folder = work_path(spark, "xsd")

    def schema(name: str, head: str, lines: list[str]) -> str:
        path = os.path.join(folder, name)
        write_text(spark, path, f'<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema"{head}>{"".join(lines)}</xs:schema>')
        return path

    by_namespace: dict[str, list[str]] = {}
    for p in paths:
        found = re.search(r"""<(?:[\w.-]+:)?schema\b[^>]*?\stargetNamespace\s*=\s*(?:"([^"]*)"|'([^']*)')""", read_text(spark, p))
        by_namespace.setdefault(next((g for g in found.groups() if g), "") if found else "", []).append(p)
    included = [f"<xs:include schemaLocation={quoteattr(p)}/>" for p in by_namespace.pop("", [])]
    imported = []
    for i, (namespace, files) in enumerate(by_namespace.items()):
        # a namespace is imported from one place only, so several files of one meet in a schema of their own
        each = [f"<xs:include schemaLocation={quoteattr(p)}/>" for p in files]
        place = files[0] if len(files) == 1 else schema(f"namespace{i}.xsd", f" targetNamespace={quoteattr(namespace)}", each)
        imported.append(f"<xs:import namespace={quoteattr(namespace)} schemaLocation={quoteattr(place)}/>")
    return schema("schemas.xsd", "", included + imported)
