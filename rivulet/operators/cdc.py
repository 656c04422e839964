"""Change records with before and after images: merged rows, DML text, and applying them to a table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import apply_case, apply_case_text, map_column_name_expr, override_schema, sql_literal
from ..functions.template import constants as constant_columns
from ..functions.template import quoted
from ..plans.skew import DEFAULT_HOT_ROWS, OrderedGroups, Running
from ..session import last_key_wins, written
from .routing import with_route
from .shape import OBJECT, as_texts, is_nested, listed, only_element

# Change kinds and the route of any other kind.
INSERT, UPDATE, DELETE = "I", "U", "D"
UNSUPPORTED = "unsupported op_type"

CHANGE = f"table string, op_type string, pos string, primary_keys array<string>, before {OBJECT}, after {OBJECT}"


def _with_record(df: DataFrame, source: str, members: str, build: Callable[[Column], Column]) -> DataFrame:
    """``df`` with ``_rv_c``, the change record as ``build`` makes it; null where the text is not one record and no more.

    A generator stands between the parsing and its uses: a filter on a route made from the record would otherwise be
    pushed below and parse the text again.
    """
    parsed = F.transform(F.from_json(listed(F.col(source).cast("string")), f"array<struct<{members}>>"), build)
    made = F.explode_outer(F.array(F.struct(parsed.alias("all"))))
    return df.select("*", made.alias("_rv_made")).withColumn("_rv_c", only_element(F.col("_rv_made.all"))).drop("_rv_made")


def _with_texts(df: DataFrame, source: str) -> DataFrame:
    """``_rv_c`` with its images as text per column; numbers keep all their digits, nested values stay JSON."""
    return _with_record(
        df, source, CHANGE,
        lambda r: r.withField("before", as_texts(r["before"])).withField("after", as_texts(r["after"])),
    )


def merge_change_images(
    df: DataFrame,
    case: str = "none",
    target_schema: str | None = None,
    header_fields: Sequence[str] | str = (),
    into: str = "content",
    constants: Mapping[str, str | Column] | None = None,
    *,
    trim: bool = False,
    source: str = "content",
) -> DataFrame:
    """One JSON object per change: header fields, then ``before``, then ``after`` on top, then constants.

    An explicit null in ``after`` wins. Keys (not those of constants) take the case and are sorted; values keep
    their JSON types. A header list given as text is split on commas without trimming unless ``trim``.
    """
    last_key_wins(df)
    if isinstance(header_fields, str):
        header_fields = header_fields.split(",")
    if trim:
        header_fields = [f.strip() for f in header_fields]
    header_fields = [f for f in dict.fromkeys(header_fields) if f not in ("primary_keys", "before", "after")]
    # Maps keep the key order of the text; a variant member is null when absent, a JSON null when explicit.
    members = [f"`{f}` variant" for f in dict.fromkeys(["table", "op_type", *header_fields])]
    work = _with_record(df, source, ", ".join([*members, f"before {OBJECT}", f"after {OBJECT}"]), lambda r: r)
    doc = F.col("_rv_c")
    table = apply_case(override_schema(doc["table"].try_cast("string"), target_schema), case)
    nothing = F.create_map().cast(OBJECT)
    parts = []
    for field in header_fields:
        member = doc.getField(field)
        entry = F.create_map(F.lit(apply_case_text(field, case)), table.cast("variant") if field == "table" else member)
        parts.append(F.when(member.isNotNull() & ~is_nested(member), entry).otherwise(nothing))
    for image in ("before", "after"):
        values = F.coalesce(doc[image], nothing)
        parts.append(F.transform_keys(values, lambda k, v: apply_case(k, case)) if case.lower() != "none" else values)
    for name, value in constant_columns(df, constants or {}).items():
        parts.append(F.create_map(F.lit(name), value.cast("string").cast("variant")))
    work = work.withColumns(
        {
            "_rv_merged": F.map_concat(*parts),
            "_rv_op": doc["op_type"].try_cast("string"),
            "_rv_table": doc["table"].try_cast("string"),
        }
    )
    reason = (
        F.when(F.col("_rv_op").isNull(), F.lit("the text is not a change record with an op_type"))
        .when(F.col("_rv_op").isin(INSERT, UPDATE, DELETE) & F.col("_rv_table").isNull(), F.lit("the change has no table"))
    )
    route = (
        F.when(reason.isNotNull(), F.lit("failure"))
        .when(F.col("_rv_op").isin(INSERT, UPDATE, DELETE), F.lit("success"))
        .otherwise(F.lit(UNSUPPORTED))
    )
    out = with_route(work, route, reason)
    kept = F.col(into) if into in df.columns else F.lit(None).cast("string")
    # A variant object holds its fields sorted by name.
    text = F.to_json(F.to_variant_object("_rv_merged"))
    out = out.withColumn(into, F.when(F.col("route") == "success", text).otherwise(kept))
    return out.drop("_rv_c", "_rv_merged", "_rv_op", "_rv_table")


def changes_to_sql(
    df: DataFrame,
    case: str = "none",
    target_schema: str | None = None,
    semicolon: bool = False,
    into: str = "content",
    key_columns: Sequence[str] | str | None = None,
    column_map: Mapping[str, str] | None = None,
    *,
    source: str = "content",
) -> DataFrame:
    """One DML statement per change, values quoted.

    ``column_map`` maps ``table.column`` (the table without its schema) to a target name. Routes: ``success``,
    ``unsupported op_type``, ``skipped`` (an update with nothing but key columns) and ``failure``.
    """
    work = _with_texts(df, source)
    work = work.select("*", *[F.col(f"_rv_c.{n}").alias(f"_rv_{n}") for n in ("table", "op_type", "before", "after")])
    if key_columns:
        given = key_columns.split(",") if isinstance(key_columns, str) else list(key_columns)
        keys = F.array(*[F.lit(k) for k in given])
    else:
        keys = F.coalesce(F.col("_rv_c.primary_keys"), F.array().cast("array<string>"))
    work = work.withColumns({"_rv_keys": keys, "_rv_bare": F.regexp_replace("_rv_table", r"^[^.]*\.", "")})
    keys, before, after, op = F.col("_rv_keys"), F.col("_rv_before"), F.col("_rv_after"), F.col("_rv_op_type")
    table = apply_case(override_schema(F.col("_rv_table"), target_schema), case)

    def target(name: Column) -> Column:
        return map_column_name_expr(F.col("_rv_bare"), name, column_map or {}, case)

    cells = F.map_entries(after)
    insert = F.concat(
        F.lit("INSERT INTO "),
        table,
        F.lit(" ("),
        F.array_join(F.transform(cells, lambda e: target(e["key"])), ", "),
        F.lit(") VALUES ("),
        F.array_join(F.transform(cells, lambda e: sql_literal(e["value"])), ", "),
        F.lit(")"),
    )
    changed = F.map_entries(F.map_filter(after, lambda k, v: ~F.array_contains(keys, k)))
    work = work.withColumn("_rv_changed", F.when(op == UPDATE, changed))
    changed = F.col("_rv_changed")
    assignments = F.transform(changed, lambda e: F.concat(target(e["key"]), F.lit(" = "), sql_literal(e["value"])))

    def condition(name: Column) -> Column:
        value = F.try_element_at(before, name)
        test = F.when(value.isNull(), F.lit("IS null")).otherwise(F.concat(F.lit("= "), sql_literal(value)))
        return F.concat(target(name), F.lit(" "), test)

    where = F.concat(F.lit(" WHERE "), F.array_join(F.transform(keys, condition), " AND "))
    update = F.concat(F.lit("UPDATE "), table, F.lit(" SET "), F.array_join(assignments, ", "), where)
    delete = F.concat(F.lit("DELETE FROM "), table, where)
    statement = F.when(op == INSERT, insert).when(op == UPDATE, update).otherwise(delete)
    if semicolon:
        statement = F.concat(statement, F.lit(";"))

    keyed = op.isin(UPDATE, DELETE)
    reason = (
        F.when(op.isNull() & F.col("_rv_table").isNull(), F.lit("the text is not a change record"))
        .when(op.isNull(), F.lit("the change has no op_type"))
        .when(~op.isin(INSERT, UPDATE, DELETE), F.lit(None).cast("string"))
        .when(F.col("_rv_table").isNull(), F.lit("the change has no table"))
        .when(keyed & (F.size(keys) == 0), F.lit("primary key column(s) are required for this operation"))
        .when(keyed & before.isNull(), F.lit("the change has no before image"))
        .when((op != DELETE) & after.isNull(), F.lit("the change has no after image"))
    )
    route = (
        F.when(reason.isNotNull(), F.lit("failure"))
        .when(~op.isin(INSERT, UPDATE, DELETE), F.lit(UNSUPPORTED))
        .when((op == UPDATE) & (F.size(changed) == 0), F.lit("skipped"))
        .otherwise(F.lit("success"))
    )
    out = with_route(work, route, reason)
    kept = F.col(into) if into in df.columns else F.lit(None).cast("string")
    out = out.withColumn(into, F.when(F.col("route") == "success", statement).otherwise(kept))
    return out.drop(*[c for c in out.columns if c.startswith("_rv_")])


class Applied(NamedTuple):
    """A changed table, and every change with its ``outcome`` and ``failure_reason``."""

    target: DataFrame
    outcomes: DataFrame

    @property
    def rejected(self) -> DataFrame:
        """The changes that did not apply, or not with all their columns."""
        return self.outcomes.filter("outcome <> 'applied'")


def _parsed(
    target: DataFrame, changes: DataFrame, keys: Sequence[str], order_by: str, source: str, *more: Column
) -> DataFrame:
    """Key columns of the target's types, place, operation, images and table of each change."""
    order = F.col(order_by) if order_by in changes.columns else F.col(f"_rv_c.{order_by}")
    work = _with_texts(changes, source)
    after = F.col("_rv_c.after")
    image = F.coalesce(F.when(F.col("_rv_c.op_type") == INSERT, after).otherwise(F.col("_rv_c.before")), after)
    return work.select(
        *[F.try_element_at(image, F.lit(k)).try_cast(target.schema[k].dataType).alias(k) for k in keys],
        order.alias("_rv_pos"),
        F.col("_rv_c.op_type").alias("_rv_op"),
        after.alias("_rv_after"),
        F.col("_rv_c.table").alias("_rv_table"),
        *more,
    )


def _present(name: str) -> Column:
    return F.map_contains_key(F.col("_rv_after"), name)


def _new_value(name: str) -> Column:
    return F.try_element_at(F.col("_rv_after"), F.lit(name))


def apply_changes(
    target: DataFrame, changes: DataFrame, keys: Sequence[str], order_by: str = "pos", source: str = "content",
    table: str | None = None,
) -> DataFrame:
    """The target table after a set of change records, as a new DataFrame with the target's columns.

    Changes of a key apply in the order of ``order_by`` (a column of ``changes`` or a field of the record): an
    insert starts the row afresh, an update overlays just the columns present in ``after``, a delete removes the
    row. An update of a row that is not there, or no longer, changes nothing, as its DML statement would; a change
    without its key or its place in the order is passed over, and a value that cannot be converted leaves the stored
    one. ``table`` limits the changes to those of one table (as named in the records); ``pos`` is compared as text.
    The changes of a key are folded by one partial aggregation, however many there are.
    """
    return _fold(target, _parsed(target, changes, keys, order_by, source), keys, table)


def _fold(target: DataFrame, work: DataFrame, keys: Sequence[str], table: str | None) -> DataFrame:
    fields = {f.name: f.dataType for f in target.schema.fields}
    others = [name for name in fields if name not in keys]
    op = F.col("_rv_op")
    ours = F.lit(True) if table is None else F.col("_rv_table").eqNullSafe(F.lit(table))
    known = op.isin(INSERT, UPDATE, DELETE) & ours
    present = op.isin(INSERT, UPDATE) & ours

    def fits(name: str) -> Column:
        value = _new_value(name)
        return _present(name) & (value.isNull() | value.try_cast(fields[name]).isNotNull())

    latest = [
        F.max(F.when(present & fits(name), F.struct("_rv_pos", _new_value(name).alias("value")))).alias(f"_rv_new_{i}")
        for i, name in enumerate(others)
    ]
    folded = work.groupBy(*keys).agg(
        F.max_by("_rv_op", F.when(known, F.col("_rv_pos"))).alias("_rv_last"),
        F.max(F.when(op.isin(INSERT, DELETE) & ours, F.col("_rv_pos"))).alias("_rv_reset"),
        F.max_by("_rv_op", F.when(op.isin(INSERT, DELETE) & ours, F.col("_rv_pos"))).alias("_rv_reset_op"),
        *latest,
    ).filter("_rv_last is not null").dropna(subset=list(keys))
    joined = target.withColumn("_rv_there", F.lit(True)).join(folded, list(keys), "full_outer").filter(
        F.coalesce(F.col("_rv_reset_op") == INSERT, F.col("_rv_there"), F.lit(False))
    )
    reset = F.col("_rv_reset")
    out = [F.col(k) for k in keys]
    for i, name in enumerate(others):
        new = F.col(f"_rv_new_{i}")
        valid = new.isNotNull() & (reset.isNull() | (new["_rv_pos"] >= reset))
        value = F.when(valid, new["value"].try_cast(fields[name])).when(reset.isNull(), F.col(name))
        out.append(value.alias(name))
    return joined.select(*out).select(*target.columns)


def settle_changes(
    target: DataFrame, changes: DataFrame, keys: Sequence[str], order_by: str = "pos", source: str = "content",
    table: str | None = None, *, hot_rows: int = DEFAULT_HOT_ROWS,
) -> Applied:
    """As :func:`apply_changes`, and what became of every change: nothing is passed over in silence.

    ``outcomes`` has the columns of ``changes``, ``outcome`` and ``failure_reason``: ``applied``; ``partly``, where some
    columns could not hold their values; ``rejected``, where the text is no change record, the operation unknown, the
    table another one, the key or the place missing, the image missing, an update has nothing but its key, or an update
    or delete meets no row. Whether there is a row follows from the last insert or delete of the key before the change,
    and from ``target`` where there is none. Changes of one place go by their text.

    The records are parsed once and stored in the shared folder. A key with very many changes is cut along its order.
    """
    fields = {f.name: f.dataType for f in target.schema.fields}
    others = [name for name in fields if name not in keys]
    row = F.struct(*[quoted(c) for c in changes.columns]).alias("_rv_row")
    work = written(
        _parsed(
            target, changes, keys, order_by, source, row, F.col("_rv_c").isNotNull().alias("_rv_record"),
            F.col(source).cast("string").alias("_rv_text"),
        ),
        "changes",
    )
    op = F.col("_rv_op")
    known = op.isin(INSERT, UPDATE, DELETE)
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    bad = F.filter(
        F.array(*[
            F.when(_present(n) & _new_value(n).isNotNull() & _new_value(n).try_cast(fields[n]).isNull(),
                   F.concat(F.lit(f"{n} cannot hold '"), _new_value(n), F.lit("'")))
            for n in others
        ]).cast("array<string>"),
        lambda x: x.isNotNull(),
    )
    plain = (
        F.when(~F.col("_rv_record"), F.lit("the text is not a change record"))
        .when(op.isNull(), F.lit("the change has no op_type"))
        .when(~known, F.concat(F.lit(f"{UNSUPPORTED}: "), op))
        .when(F.lit(False) if table is None else ~F.col("_rv_table").eqNullSafe(F.lit(table)), F.lit("the change is of another table"))
        .when(no_key, F.lit("the change has no key"))
        .when(F.col("_rv_pos").isNull(), F.lit("the change has no place in the order"))
        .when((op != DELETE) & F.col("_rv_after").isNull(), F.lit("the change has no after image"))
        .when((op == UPDATE) & ~F.arrays_overlap(F.map_keys("_rv_after"), F.array(*map(F.lit, others)).cast("array<string>")), F.lit("the update has nothing but its key"))
    )
    work = work.withColumns({"_rv_plain": plain, "_rv_bad": F.when(op != DELETE, bad)})
    # changes that cannot apply whatever came before do not meet the others
    hopeless = work.filter("_rv_plain is not null").withColumn("_rv_reason", F.col("_rv_plain"))
    groups = OrderedGroups(work.filter("_rv_plain is null"), list(keys), ["_rv_pos", "_rv_text"], hot_rows).with_running(
        Running("_rv_before", "last", F.when(op.isin(INSERT, DELETE), op))
    )
    there = target.select(*[quoted(k).alias(f"_rv_t{i}") for i, k in enumerate(keys)]).distinct().withColumn("_rv_there", F.lit(True))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & (F.col(k) == F.col(f"_rv_t{i}"))
    rest = groups.result().join(there, same, "left")
    row_there = F.coalesce(F.col("_rv_before") == INSERT, F.col("_rv_there"), F.lit(False))
    rest = rest.withColumn("_rv_reason", F.when((op != INSERT) & ~row_there, F.lit("there is no such row")))
    names = ["_rv_row", "_rv_reason", "_rv_bad"]
    decided = hopeless.select(*names).unionByName(rest.select(*names))
    partly = F.size(F.coalesce("_rv_bad", F.array().cast("array<string>"))) > 0
    outcomes = decided.select(
        "_rv_row.*",
        F.when(F.col("_rv_reason").isNotNull(), F.lit("rejected")).when(partly, F.lit("partly")).otherwise(F.lit("applied")).alias("outcome"),
        F.coalesce("_rv_reason", F.when(partly, F.array_join("_rv_bad", "; "))).alias("failure_reason"),
    )
    return Applied(_fold(target, work, keys, table), outcomes)
