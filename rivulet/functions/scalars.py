"""Column helpers. Everything here is a built-in expression, so it stays inside the JVM."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names accepted for a target type and the Spark type each one yields.
TARGET_TYPES = {
    "int": "int",
    "long": "bigint",
    "float": "float",
    "decimal": "double",
    "double": "double",
    "string": "string",
}

# Text forms that count as whole numbers: an optional sign and digits, no blanks.
WHOLE_NUMBER = r"^[+-]?[0-9]+$"


def apply_case(col: Column, mode: str = "none") -> Column:
    """``upper`` / ``lower`` / ``none`` (case of the mode itself is ignored)."""
    mode = mode.lower()
    if mode == "upper":
        return F.upper(col)
    if mode == "lower":
        return F.lower(col)
    return col


def apply_case_text(text: str, mode: str = "none") -> str:
    """:func:`apply_case` for a name known while the plan is built."""
    return {"upper": text.upper(), "lower": text.lower()}.get(mode.lower(), text)


def map_column_name(table: str, column: str, mapping: Mapping[str, str], mode: str = "none") -> str:
    """Target name of ``table.column`` when both are known while the plan is built."""
    return apply_case_text(mapping.get(f"{table}.{column}", column), mode)


def map_column_name_expr(table: Column, column: Column, mapping: Mapping[str, str], mode: str = "none") -> Column:
    """Target name of ``table.column`` when either comes from the data."""
    if not mapping:
        return apply_case(column, mode)
    pairs = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return apply_case(F.coalesce(F.try_element_at(pairs, F.concat(table, F.lit("."), column)), column), mode)


def convert_type(col: Column, to_type: str | None) -> tuple[Column, Column]:
    """(converted value, "this row failed" flag). Null converts to null; an unknown type is text."""
    spark_type = TARGET_TYPES.get(to_type or "string", "string")
    if spark_type == "string":
        return col, F.lit(False)
    if spark_type in ("int", "bigint"):
        value = F.when(col.rlike(WHOLE_NUMBER), col.try_cast(spark_type))
    else:
        value = col.try_cast(spark_type)
    return value, col.isNotNull() & value.isNull()


def to_text(col: Column, default: str | None = "") -> Column:
    """Any value as text, null as ``default``."""
    text = col.cast("string")
    return text if default is None else F.coalesce(text, F.lit(default))


def strip_qualifier(name: str) -> str:
    """Drop everything up to the last dot of a name."""
    return re.sub(r"^.*[.]", "", name, count=1)


def strip_qualifier_expr(col: Column) -> Column:
    """:func:`strip_qualifier` for names held in a column."""
    return F.regexp_replace(col, r"^.*[.]", "")


def override_schema(table: Column, schema: str | None) -> Column:
    """None keeps ``schema.table``; ``''`` drops the qualifier; a name replaces it."""
    if schema is None:
        return table
    bare = F.regexp_replace(table, r"^[^.]*\.", "")
    return bare if schema == "" else F.concat(F.lit(schema + "."), bare)


def sql_literal(col: Column) -> Column:
    """A quoted SQL text literal, quotes doubled; ``null`` for null."""
    return F.coalesce(F.concat(F.lit("'"), F.replace(col, F.lit("'"), F.lit("''")), F.lit("'")), F.lit("null"))


def csv_quote(col: Column, quoted: bool = True) -> Column:
    """One CSV field; a missing value is empty. Unquoted mode does not escape."""
    text = F.coalesce(col, F.lit(""))
    if not quoted:
        return text
    return F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))


def decode_content(col: Column) -> Column:
    """Bytes to text (UTF-8)."""
    return F.decode(col, "UTF-8")


def encode_content(col: Column) -> Column:
    """Text to bytes (UTF-8)."""
    return F.encode(col, "UTF-8")
