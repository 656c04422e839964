"""Moving values between the content, columns, JSON and CSV."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import csv_quote
from ..functions.template import REFERENCE, constants, quoted, render_template, rerender
from ..session import last_key_wins
from .routing import failing, with_route

# Relaxed JSON as the flows accept it.
LAX_JSON = {"allowUnquotedFieldNames": "true", "allowSingleQuotes": "true", "allowComments": "true"}

FRAGMENT_COLUMNS = ("fragment_identifier", "fragment_index", "fragment_count", "fragment_size")
OBJECT = "map<string,variant>"


def content_to_column(df: DataFrame, name: str, expression: str | Column | None = None) -> DataFrame:
    """Copy the content to a column; ``expression`` (Spark SQL or a Column) may then rework that column."""
    out = df.withColumn(name, F.col("content"))
    if expression is not None:
        out = out.withColumn(name, F.expr(expression) if isinstance(expression, str) else expression)
    return with_route(out, "success")


def _refers_to_itself(text: Column, holders: list[str]) -> Column:
    """Whether references lead from ``text`` round in a circle: some are left after a step for each holder."""
    if not holders:
        return F.lit(False)

    def names(value: Column) -> Column:
        return F.array_distinct(F.regexp_extract_all(F.coalesce(value, F.lit("")), F.lit(REFERENCE), F.lit(1)))

    leads = F.create_map(*[part for c in holders for part in (F.lit(c), names(quoted(c)))])
    none = F.array().cast("array<string>")
    left = F.aggregate(
        F.sequence(F.lit(1), F.lit(len(holders) + 1)), names(text),
        lambda open_, _: F.when(F.size(open_) == 0, open_).otherwise(
            F.array_distinct(F.flatten(F.transform(open_, lambda n: F.coalesce(F.try_element_at(leads, n), none))))
        ),
    )
    return F.size(left) > 0


def update_columns(
    df: DataFrame,
    content: str | None = None,
    columns: Mapping[str, str] | None = None,
    *,
    eval_content: bool = False,
    eval_columns: bool = False,
    recursive: bool = False,
) -> DataFrame:
    """Set the content and/or columns from text, in order, so that later ones see earlier updates.

    Evaluated text has its ``${name}`` parts filled in. With ``recursive`` the result is evaluated again until it no
    longer changes. Text that refers to itself, directly or through other columns, would never settle: such a row goes
    to ``failure`` and keeps what it had. Any other text settles within one round for each column that can hold a
    reference, one more, and one for each reference inside another's name.
    """
    unsettled: list[Column] = []
    helpers: list[str] = []

    def assign(out: DataFrame, name: str, text: str, evaluate: bool) -> DataFrame:
        if not evaluate:
            return out.withColumn(name, F.lit(text))
        known = [c for c in out.columns if c not in helpers]
        if not recursive:
            return out.withColumn(name, render_template(text, known))
        start, loops, now = [f"_rv_{part}{len(helpers)}" for part in ("start", "loops", "now")]
        holders = [c for c in known if out.schema[c].dataType == T.StringType()]
        out = out.withColumn(start, render_template(text, known))
        out = out.withColumn(loops, _refers_to_itself(F.col(start), holders))
        rounds = len(holders) + 1 + F.regexp_count(F.col(start), F.lit(r"\$\{"))
        settled = F.aggregate(
            F.sequence(F.lit(1), rounds), F.col(start),
            lambda so_far, _: F.when(so_far.contains("${"), rerender(so_far, known)).otherwise(so_far),
        )
        out = out.withColumn(now, F.when(~F.col(loops), settled))
        helpers.extend([start, loops, now])
        # references put together from parts are not seen beforehand
        bad = F.col(loops) | (F.col(now) != rerender(F.col(now), known))
        kept = quoted(name).cast("string") if name in known else F.lit(None).cast("string")
        failed = f"_rv_bad{len(helpers)}"
        helpers.append(failed)
        unsettled.append(F.col(failed))
        out = out.withColumn(failed, bad)
        return out.withColumn(name, F.when(F.col(failed), kept).otherwise(F.regexp_replace(now, r"\$\{[^{}]*\}", "")))

    out = df
    if content:
        out = assign(out, "content", content, eval_content)
    for name, text in (columns or {}).items():
        out = assign(out, name, text, eval_columns)
    reason = F.lit(None).cast("string")
    for flag in unsettled:
        reason = F.when(flag, F.lit("the text refers to itself; no number of rounds settles it")).otherwise(reason)
    return failing(out, reason).drop(*helpers)


def columns_to_json(
    df: DataFrame,
    *,
    prefix: str | None = None,
    strip_prefix: bool = True,
    regex: str | None = None,
    names: Sequence[str] | str | None = None,
    delimiter: str = ",",
    constants_: Mapping[str, str | Column] | None = None,
    into: str = "content",
) -> DataFrame:
    """Build a JSON object from the chosen columns, keys sorted, values as text.

    Columns are chosen by prefix, by a regular expression over the whole name, and by list (names are
    used as given, a missing one gives JSON null); ``constants_`` are added last and win.
    """
    chosen: dict[str, Column] = {}
    available = [c for c in df.columns if c != "content"]
    if prefix:
        for name in available:
            if name.startswith(prefix):
                chosen[name[len(prefix):] if strip_prefix else name] = quoted(name).cast("string")
    if regex:
        for name in available:
            if re.fullmatch(regex, name):
                chosen[name] = quoted(name).cast("string")
    for name in _name_list(names, delimiter):
        chosen[name] = quoted(name).cast("string") if name in available else F.lit(None).cast("string")
    chosen.update(constants(df, constants_ or {}))
    return with_route(df.withColumn(into, json_object(chosen)), "success")


def json_object(values: Mapping[str, Column]) -> Column:
    """A JSON object with sorted keys; nulls are kept."""
    if not values:
        return F.lit("{}")
    return F.to_json(F.struct(*[values[k].alias(k) for k in sorted(values)]), {"ignoreNullFields": "false"})


def attributes_to_json(
    df: DataFrame,
    attributes: str = "attributes",
    *,
    prefix: str | None = None,
    strip_prefix: bool = True,
    regex: str | None = None,
    names: Sequence[str] | str | None = None,
    delimiter: str = ",",
    constants_: Mapping[str, str | Column] | None = None,
    into: str = "content",
) -> DataFrame:
    """:func:`columns_to_json` where the names are only known per row and live in a map column."""
    last_key_wins(df)
    source = F.col(attributes)
    parts = [F.create_map().cast("map<string,string>")]
    if prefix:
        picked = F.map_filter(source, lambda k, v: F.startswith(k, F.lit(prefix)))
        if strip_prefix:
            picked = F.transform_keys(picked, lambda k, v: F.substring(k, len(prefix) + 1, 2**31 - 1))
        parts.append(picked)
    if regex:
        parts.append(F.map_filter(source, lambda k, v: k.rlike(f"^(?:{regex})$")))
    for name in _name_list(names, delimiter):
        parts.append(F.create_map(F.lit(name), F.try_element_at(source, F.lit(name))))
    for name, value in constants(df, constants_ or {}, source).items():
        parts.append(F.create_map(F.lit(name), value))
    merged = F.map_from_entries(F.sort_array(F.map_entries(F.map_concat(*parts))))
    return with_route(df.withColumn(into, F.to_json(merged, {"ignoreNullFields": "false"})), "success")


def _name_list(names: Sequence[str] | str | None, delimiter: str) -> list[str]:
    if not names:
        return []
    return names.split(delimiter) if isinstance(names, str) else list(names)


def is_nested(value: Column) -> Column:
    """Whether a variant holds an object or an array."""
    return value.try_cast(OBJECT).isNotNull() | value.try_cast("array<variant>").isNotNull()


def as_texts(entries: Column) -> Column:
    """A map of variants as a map of texts: numbers with all their digits, nested values as JSON."""
    return F.transform_values(entries, lambda k, v: v.try_cast("string"))


def listed(text: Column) -> Column:
    """The text as what a JSON array lists. Parsed alone, what follows its first document would go unseen; parsed like
    this it spoils the array or makes a second element."""
    return F.concat(F.lit("["), text, F.lit("\n]"))


def only_element(parsed: Column) -> Column:
    """The element of an array of one; null for any other."""
    return F.when(F.size(parsed) == 1, F.get(parsed, F.lit(0)))


def variant_path(name: str) -> str:
    """Path of a top-level field whatever characters its name holds."""
    return "$['" + name.replace("\\", "\\\\").replace("'", "\\'") + "']"


def json_to_columns(
    df: DataFrame,
    source: str = "content",
    *,
    prefix: str = "",
    add_nulls: bool = True,
    fragments: str = "always",
    rename: Mapping[str, str] | None = None,
    always_add: bool | Sequence[str] = True,
    fields: Mapping[str, str] | None = None,
    emit_original: bool = True,
    into: str = "attributes",
    lax: bool = True,
) -> DataFrame:
    """Flatten JSON objects: one row per object, its scalar values as named text.

    An array gives one row per object element (other elements are skipped). Nested objects and arrays are
    dropped. The names differ per row, so they come as a map column ``into``; give ``fields`` (name to
    type) to get ordinary typed columns instead. ``always_add`` gives every record the new names of ``rename``
    (or the names listed), empty where the record lacks them. ``fragments`` is ``always``, ``never`` or ``arrays``.
    Routes: ``success`` rows, the ``original`` row, and ``failure`` where the text is no
    object or array, or has anything after it.
    """
    if fragments not in ("always", "never", "arrays"):
        raise ValueError("fragments must be always, never or arrays")
    last_key_wins(df)
    rename = dict(rename or {})
    parsed = F.from_json(listed(F.col(source).cast("string")), "array<variant>", LAX_JSON if lax else {})
    work = df.withColumn("_rv_all", parsed).withColumn("_rv_json", only_element(F.col("_rv_all")))
    work = work.withColumn("_rv_list", F.col("_rv_json").try_cast("array<variant>"))
    json, elements = F.col("_rv_json"), F.col("_rv_list")
    is_array = elements.isNotNull()
    if fields:
        # The objects stay variants; each declared field is then one path into them.
        objects = F.filter(elements, lambda e: e.try_cast(OBJECT).isNotNull())
        alone = F.when(json.try_cast(OBJECT).isNotNull(), F.array(json))
    else:
        objects = F.filter(F.transform(elements, lambda e: e.try_cast(OBJECT)), lambda m: m.isNotNull())
        # A scalar casts to null, which the filter then takes out.
        one = F.array_compact(F.array(json.try_cast(OBJECT)))
        alone = F.when(F.size(one) == 1, one)
    work = work.withColumns(
        {
            "_rv_records": F.when(is_array, objects).otherwise(alone),
            "_rv_array": is_array,
            "_rv_valid": json.isNotNull(),
        }
    ).drop("_rv_all", "_rv_json", "_rv_list")
    reason = F.when(~F.col("_rv_valid"), F.lit("the text is not valid JSON")).when(
        F.col("_rv_records").isNull(), F.lit("the JSON is not an array or an object")
    )
    return one_row_per_record(
        df,
        work.withColumn("_rv_reason", reason),
        lambda record: _record_columns(record, fields, rename, prefix, add_nulls, always_add, into),
        {"always": F.lit(True), "never": F.lit(False), "arrays": F.col("_rv_array")}[fragments],
        emit_original,
    )


def one_row_per_record(
    df: DataFrame,
    work: DataFrame,
    build: Callable[[Column], dict[str, Column]],
    numbered_row: Column,
    emit_original: bool,
) -> DataFrame:
    """Spread the array ``_rv_records`` over rows, followed by the original row (or the failed one).

    Records are never null, so a null element stands for that last row; ``_rv_reason`` tells a failure.
    """
    records, reason = F.col("_rv_records"), F.col("_rv_reason")
    last_row = F.array(F.lit(None).cast(work.schema["_rv_records"].dataType.elementType))
    good = F.coalesce(records, F.slice(last_row, 1, 0))
    if emit_original:
        rows = F.concat(good, last_row)
    else:
        rows = F.when(reason.isNotNull(), last_row).otherwise(good)
    work = work.withColumns({"_rv_id": F.uuid(), "_rv_total": F.size(good), "_rv_rows": rows}).drop("_rv_records")
    names = [c for c in work.columns if c != "_rv_rows"]
    # The outer form: for the inner one Spark would first filter on the array's size, parsing each text twice.
    work = work.select(*[quoted(c) for c in names], F.posexplode_outer("_rv_rows").alias("_rv_at", "_rv_record"))
    if not emit_original:
        work = work.filter(F.col("_rv_at").isNotNull())
    is_record = F.col("_rv_record").isNotNull()
    added = build(F.col("_rv_record"))
    added.update(
        fragment_values(is_record & numbered_row, F.col("_rv_id"), F.col("_rv_at") + 1, F.col("_rv_total"))
    )
    if "content" in df.columns:
        added["content"] = F.when(~is_record, F.col("content"))
    other = F.when(reason.isNotNull(), F.lit("failure")).otherwise(F.lit("original"))
    out = with_route(work.withColumns(added), F.when(is_record, F.lit("success")).otherwise(other), reason)
    return out.drop(*[c for c in out.columns if c.startswith("_rv_")])


def _record_columns(
    record: Column,
    fields: Mapping[str, str] | None,
    rename: Mapping[str, str],
    prefix: str,
    add_nulls: bool,
    always_add: bool | Sequence[str],
    into: str,
) -> dict[str, Column]:
    if not fields:
        return {into: _text_record(record, rename, prefix, add_nulls, always_add)}
    return {
        prefix + rename.get(name, name): _typed_field(record, name, kind, add_nulls) for name, kind in fields.items()
    }


def fragment_values(when: Column, identifier: Column, index: Column, count: Column) -> dict[str, Column]:
    """The four fragment columns, null on rows that are no fragments."""
    values = (identifier, index.cast("bigint"), count.cast("bigint"), F.lit("0"))
    return {name: F.when(when, value) for name, value in zip(FRAGMENT_COLUMNS, values)}


def _text_record(
    obj: Column, rename: Mapping[str, str], prefix: str, add_nulls: bool, always_add: bool | Sequence[str]
) -> Column:
    leaves = F.map_filter(obj, lambda k, v: ~is_nested(v))
    if add_nulls:
        text = F.transform_values(leaves, lambda k, v: F.coalesce(v.try_cast("string"), F.lit("")))
    else:
        text = F.transform_values(leaves, lambda k, v: v.try_cast("string"))
        text = F.map_filter(text, lambda k, v: v.isNotNull())
    if rename or prefix:
        text = F.transform_keys(text, lambda k, v: F.concat(F.lit(prefix), renamed(k, rename)))
    added = added_names(rename, always_add) if add_nulls else []
    return F.map_concat(empty_entries([prefix + name for name in added]), text) if added else text


def positional_rename(
    names: Sequence[str] | str, new_names: Sequence[str] | str, delimiter: str = ","
) -> tuple[dict[str, str], list[str]]:
    """(``rename``, ``always_add``) from a list of names and one of new names; surplus names keep theirs."""
    new = _name_list(new_names, delimiter)
    return dict(reversed(list(zip(_name_list(names, delimiter), new)))), new


def added_names(rename: Mapping[str, str], always_add: bool | Sequence[str]) -> list[str]:
    """Names every record gets."""
    if isinstance(always_add, bool):
        return list(dict.fromkeys(rename.values())) if always_add else []
    return list(always_add)


def empty_entries(names: Sequence[str]) -> Column:
    """A map of empty texts."""
    return F.create_map(*[F.lit(x) for name in names for x in (name, "")])


def renamed(name: Column, rename: Mapping[str, str]) -> Column:
    """New name of a field, the name itself where none is given."""
    for old, new in rename.items():
        name = F.when(name == old, F.lit(new)).otherwise(name) if len(rename) == 1 else name
    if len(rename) > 1:
        pairs = F.create_map(*[F.lit(x) for pair in rename.items() for x in pair])
        name = F.coalesce(F.try_element_at(pairs, name), name)
    return name


def _typed_field(element: Column, name: str, kind: str, add_nulls: bool) -> Column:
    value = F.try_variant_get(element, F.lit(variant_path(name)), kind)
    if kind.lower() != "string":
        return value
    child = F.try_variant_get(element, F.lit(variant_path(name)), "variant")
    value = F.when(~is_nested(child), value)
    if add_nulls:
        value = F.when(F.is_variant_null(child), F.lit("")).otherwise(value)
    return value


def promote(df: DataFrame, names: Iterable[str], source: str = "attributes") -> DataFrame:
    """Turn entries of a map column into columns of their own."""
    return df.withColumns({name: F.try_element_at(F.col(source), F.lit(name)) for name in names})


def csv_fields(fields: Sequence[str] | T.StructType | str) -> list[str]:
    """Field names from a list, a Spark schema, or the text of ``{"fields":[{"name":…}]}``."""
    if isinstance(fields, T.StructType):
        return fields.fieldNames()
    if isinstance(fields, str):
        return [field["name"] for field in json.loads(fields)["fields"]]
    return list(fields)


def json_to_csv(
    df: DataFrame,
    fields: Sequence[str] | T.StructType | str,
    *,
    delimiter: str = ",",
    header: bool = True,
    quoted: bool = True,
    source: str = "content",
    into: str = "content",
) -> DataFrame:
    """JSON object, array of objects, or array of texts that hold objects, to CSV text.

    ``fields`` picks and orders the columns; a missing or null value is empty. An empty array gives empty
    text without a header. An element that is no object sends the row to ``failure``, as does text after the document.
    """
    names = csv_fields(fields)
    text = F.trim(F.col(source))
    as_list = F.from_json(F.col(source), "array<string>", LAX_JSON)
    elements = F.when(F.startswith(text, F.lit("[")), as_list).when(F.startswith(text, F.lit("{")), F.array(F.col(source)))
    # A lone scalar is valid JSON with nothing to list: only the header comes out.
    whole = F.size(F.from_json(listed(F.col(source).cast("string")), "array<string>", LAX_JSON)) == 1
    empty = F.array().cast("array<string>")
    items = F.coalesce(elements, F.when(~F.rlike(text, F.lit(r"^[\[{]")), empty))
    work = df.withColumn("_rv_items", F.when(whole, items))
    found = F.transform("_rv_items", lambda e: F.from_json(listed(e), f"array<{OBJECT}>", LAX_JSON))
    work = work.withColumn("_rv_records", F.transform(found, lambda one: as_texts(only_element(one))))

    def line(record: Column) -> Column:
        cells = [csv_quote(F.try_element_at(record, F.lit(name)), quoted) for name in names]
        return F.concat_ws(delimiter, *cells)

    head = delimiter.join(f'"{n}"' if quoted else n for n in names)
    lines = F.transform("_rv_records", line)
    if header:
        lines = F.concat(F.array(F.lit(head)), lines)
    blank = F.startswith(text, F.lit("[")) & (F.size("_rv_items") == 0)
    csv = F.when(blank, F.lit("")).otherwise(F.array_join(lines, "\n"))
    reason = F.when(F.col("_rv_items").isNull(), F.lit("the text is not valid JSON")).when(
        F.exists("_rv_records", lambda r: r.isNull()),
        F.lit("array elements must be JSON objects or text that holds one"),
    )
    work = work.withColumn("_rv_reason", reason)
    kept = F.col(into) if into in df.columns else F.lit(None).cast("string")
    out = work.withColumn(into, F.when(F.col("_rv_reason").isNull(), csv).otherwise(kept))
    return failing(out, F.col("_rv_reason")).drop("_rv_items", "_rv_records", "_rv_reason")
