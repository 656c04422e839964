"""``${name}`` templates, turned into plain concatenation while the plan is built."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REFERENCE = r"\$\{([^{}]*)\}"


def quoted(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def _value(name: str, columns: set[str], attributes: Column | None) -> Column:
    if name in columns:
        return F.coalesce(quoted(name).cast("string"), F.lit(""))
    if attributes is not None:
        return F.coalesce(F.try_element_at(attributes, F.lit(name)), F.lit(""))
    return F.lit("")


def render_template(text: str, columns: Iterable[str], attributes: Column | None = None) -> Column:
    """``text`` with each ``${name}`` replaced by the row's value; unknown names and nulls give ``''``."""
    known = set(columns)
    pieces: list[Column] = []
    for i, piece in enumerate(re.split(REFERENCE, text)):
        if i % 2:
            pieces.append(_value(piece.strip(), known, attributes))
        elif piece:
            pieces.append(F.lit(piece))
    if not pieces:
        return F.lit("")
    return pieces[0] if len(pieces) == 1 else F.concat(*pieces)


def rerender(col: Column, columns: Iterable[str]) -> Column:
    """One more round over text that is only known per row (a value may itself hold ``${name}``)."""
    for name in columns:
        col = F.replace(col, F.lit("${" + name + "}"), F.coalesce(quoted(name).cast("string"), F.lit("")))
    return col


def constants(df: DataFrame, values: Mapping[str, str | Column], attributes: Column | None = None) -> dict[str, Column]:
    """Extra named values of an operator: templates become expressions, columns pass through."""
    return {
        name: value if isinstance(value, Column) else render_template(value, df.columns, attributes)
        for name, value in values.items()
    }


#: Strings, names in backticks, comments, and references of a SQL text; whatever lies between is left as it is.
_SQL_PARTS = re.compile(
    r"(?P<text>'(?:[^'\\]|''|\\.)*'|\"(?:[^\"\\]|\"\"|\\.)*\")|(?P<name>`(?:[^`]|``)*`)|(?P<comment>--[^\n]*|/\*.*?\*/)"
    r"|(?P<use>" + REFERENCE + ")",
    re.DOTALL,
)
_LIMIT = re.compile(r"\b(limit|offset)\b", re.IGNORECASE)
_NUMBER = r"^\s*-?[0-9]{1,28}(\.[0-9]{1,10})?\s*$"
_PLAIN_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal", "boolean", "date", "timestamp")


class SqlTemplate(NamedTuple):
    """A SQL text whose references became columns of ``alias``: the text, these columns, and what is wrong with a row."""

    text: str
    columns: dict[str, Column]
    reason: Column


class TemplateError(ValueError):
    """A reference in a SQL text that cannot become a column."""


def sql_template(text: str, df: DataFrame, alias: str) -> SqlTemplate:
    """Turn each ``${name}`` of a SQL text into a column of ``alias``, so that the text is planned once for all rows.

    Within quotes a reference stands for the row's text, null and unknown names for none. Outside quotes it stands for
    a value: that of a number, a boolean, a date or a timestamp as it is, that of text if it reads as a number; a row
    whose value is null or no number has a reason. Anything else would be a part of the statement itself, which differs
    by row, and raises :class:`TemplateError`. So does LIMIT or OFFSET: planned for all rows at once, it is not applied row
    by row where a value stands in an expression.
    """
    kinds = dict(df.dtypes)
    columns: dict[str, Column] = {}
    reasons: list[Column] = []

    def column(value: Column) -> str:
        name = f"_rv_c{len(columns)}"
        columns[name] = value
        return f"{alias}.{name}"

    def outside(name: str) -> str:
        kind = kinds.get(name)
        if kind is None:
            raise TemplateError(f"no column for ${{{name}}} outside quotes in: {text}")
        value, shown = quoted(name), F.lit(f"${{{name}}} has no value outside quotes in: {text}")
        if kind == "string":
            reasons.append(F.when(~F.coalesce(value.rlike(_NUMBER), F.lit(False)), shown))
            value = F.trim(value).try_cast("decimal(38,10)")
        elif kind.split("(")[0] in _PLAIN_TYPES:
            reasons.append(F.when(value.isNull(), shown))
        else:
            raise TemplateError(f"${{{name}}} is a {kind} and cannot stand outside quotes in: {text}")
        return column(value)

    def inside(literal: str) -> str:
        pieces = re.split(REFERENCE, literal)
        if len(pieces) == 1:
            return literal
        # the whole text becomes one column: the pieces around the references keep their escapes
        quote, texts = literal[0], pieces[0::2]
        texts = [texts[0][1:], *texts[1:-1], texts[-1][:-1]]
        parts = [F.expr(quote + t + quote) for t in texts]
        for i, name in enumerate(pieces[1::2]):
            parts.insert(2 * i + 1, _value(name.strip(), set(kinds), None))
        return column(F.concat(*parts))

    def rewritten(match: re.Match) -> str:
        if match["text"]:
            return inside(match["text"])
        return outside(re.match(REFERENCE, match["use"])[1].strip()) if match["use"] else match[0]

    if _LIMIT.search(_SQL_PARTS.sub(" ", text)):
        raise TemplateError(f"a text with references cannot limit its rows, say which come first instead: {text}")
    return SqlTemplate(_SQL_PARTS.sub(rewritten, text), columns, F.coalesce(F.lit(None).cast("string"), *reasons))


def has_references(text: str) -> bool:
    return re.search(REFERENCE, text) is not None
