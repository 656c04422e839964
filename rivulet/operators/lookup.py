"""Enrichment from lookup tables, keyed cells and queries. Every lookup is a join.

No join here carries a broadcast hint: lookup tables grow with the data, so adaptive execution picks a
broadcast from the measured size and splits skewed shuffle partitions otherwise.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import convert_type
from ..functions.template import TemplateError, has_references, quoted, render_template
from ..plans.correlated import asking, correlated
from .routing import failing
from .shape import json_object

# Section and entry names of an enrichment spec.
TO_COLUMNS = "extract-to-attributes"
TO_JSON = "extract-to-json"
CACHE_TYPES = ("CACHE", "CACHE_KEY")
TABLE_TYPES = ("HBASE", "HBASE_SCAN", "HBASE_FILTER")
TABLE_NAME = "hbase-table"


def sql_to_lookup(
    df: DataFrame, key: str, value: str, alias_key: str | None = None, order_by: Sequence[str] = ()
) -> DataFrame:
    """(key, value) table of text, the last row per key winning; ``alias_key`` adds a second key per row."""
    order = F.struct(*[quoted(c) for c in order_by]) if order_by else F.struct(quoted(value).cast("string"))

    def text(name: str) -> Column:
        return F.coalesce(quoted(name).cast("string"), F.lit(""))

    entries = F.array(F.struct(text(key).alias("key"), F.lit(0).alias("turn")))
    if alias_key:
        alias = F.struct(text(alias_key).alias("key"), F.lit(1).alias("turn"))
        entries = F.when(quoted(alias_key).isNotNull(), F.concat(entries, F.array(alias))).otherwise(entries)
    pairs = df.select(order.alias("position"), text(value).alias("value"), F.explode(entries).alias("entry"))
    last = F.max_by("value", F.struct("position", "entry.turn"))
    return pairs.groupBy(F.col("entry.key").alias("key")).agg(last.alias("value"))


def unique_lookup(lookup: DataFrame) -> DataFrame:
    """One row per key, so that joining never multiplies rows."""
    return lookup.groupBy("key").agg(F.max("value").alias("value"))


def attach_lookup(df: DataFrame, lookup: DataFrame, key: Column | str, into: str) -> DataFrame:
    """Left join of one value per row. ``key`` is a Column or a ``${name}`` template."""
    rendered = key if isinstance(key, Column) else render_template(key, df.columns)
    right = unique_lookup(lookup).select(F.col("key").alias("_rv_lk"), F.col("value").alias(into))
    key = F.nullif(rendered.cast("string"), F.lit(""))
    left = df.withColumns({"_rv_found": key.isNotNull(), "_rv_key": key_or_spread(key)})
    joined = left.join(right, left["_rv_key"] == right["_rv_lk"], "left")
    return joined.withColumn(into, F.when(F.col("_rv_found"), F.col(into))).drop("_rv_found", "_rv_key", "_rv_lk")


def key_or_spread(key: Column) -> Column:
    """The key to join by; rows without one get one each that nothing has, so that they do not meet in one task."""
    return F.coalesce(key, F.concat(F.lit("\0"), F.monotonically_increasing_id()))


def attach_lookups(df: DataFrame, lookup: DataFrame, keys: Mapping[str, Column]) -> DataFrame:
    """As :func:`attach_lookup` for several columns at once, by one join however many there are.

    Each row's keys become rows of their own, of which only the first carries the row; they meet the lookup together and
    are folded back by a number drawn per row.
    """
    if len(keys) < 2:
        for into, key in keys.items():
            df = attach_lookup(df, lookup, key, into)
        return df
    asked = [
        F.struct(F.lit(i).alias("i"), F.nullif(key.cast("string"), F.lit("")).alias("key")) for i, key in enumerate(keys.values())
    ]
    asked = F.filter(F.array(*asked), lambda a: a["key"].isNotNull() | (a["i"] == 0))
    numbered = df.select(F.uuid().alias("_rv_no"), F.struct(*[quoted(c) for c in df.columns]).alias("_rv_row"), asked.alias("_rv_asked"))
    long = numbered.select("_rv_no", "_rv_row", F.explode("_rv_asked").alias("_rv_a"))
    long = long.select(
        "_rv_no", F.when(F.col("_rv_a.i") == 0, F.col("_rv_row")).alias("_rv_row"), F.col("_rv_a.i").alias("_rv_i"),
        F.col("_rv_a.key").isNotNull().alias("_rv_found"), key_or_spread(F.col("_rv_a.key")).alias("_rv_key"),
    )
    right = unique_lookup(lookup).select(F.col("key").alias("_rv_lk"), F.col("value").alias("_rv_value"))
    met = long.join(right, long["_rv_key"] == right["_rv_lk"], "left")
    value = F.when(F.col("_rv_found"), F.col("_rv_value"))
    folded = met.groupBy("_rv_no").agg(
        F.first("_rv_row", ignorenulls=True).alias("_rv_row"),
        *[F.max(F.when(F.col("_rv_i") == i, value)).alias(into) for i, into in enumerate(keys)],
    )
    return folded.select("_rv_row.*", *keys)


def single_rows(cells: DataFrame, match: Mapping[str, str] | None = None) -> DataFrame:
    """Per lookup key of a cells table: the matching row's last cell, and whether several rows match.

    Without ``match`` the lookup key is the row key; with ``{"family":…, "qualifier":…}`` it is that cell's
    value. Both steps aggregate map-side, so a key shared by very many rows stays cheap.
    """
    last = F.max_by("value", F.struct("family", "qualifier")).alias("last")
    if not match:
        return cells.groupBy(F.col("row_key").alias("key")).agg(last, F.lit(False).alias("many"))
    is_key = (F.col("family") == match["family"]) & (F.col("qualifier") == match["qualifier"])
    rows = cells.groupBy("row_key").agg(last, F.max(F.when(is_key, F.col("value"))).alias("key"))
    return (
        rows.filter("key is not null")
        .groupBy("key")
        .agg(
            F.max_by("last", "row_key").alias("last"),
            (F.min("row_key") != F.max("row_key")).alias("many"),
        )
    )


def first_values(
    result: DataFrame, params: Sequence[str], order_by: Sequence[str], value: str | None = None
) -> DataFrame:
    """Per parameter values, the first row's first column as text (wrapped, so that a null row still counts)."""
    value = value or result.columns[0]
    order = F.struct(*[quoted(c) for c in order_by])
    wrapped = F.struct(quoted(value).cast("string").alias("v"))
    return result.groupBy(*[quoted(p).alias(f"_rv_q{i}") for i, p in enumerate(params)]).agg(
        F.min_by(wrapped, order).alias("_rv_first")
    )


def _text(value: Any) -> str | None:
    if value is None:
        return None
    if isinstance(value, bool):
        return "true" if value else "false"
    return str(value)


def _typed_default(value: Any, to_type: str | None) -> tuple[Column, Column]:
    """A default as a literal of the target type, and whether it cannot be converted; untyped, it keeps its own type."""
    if to_type is None and isinstance(value, (int, float, str)):
        return F.lit(value), F.lit(False)
    return convert_type(F.lit(_text(value)).cast("string"), to_type)


class _Plan:
    """Collects the joins of one enrichment and the values they lead to."""

    def __init__(self, df: DataFrame, sources: Mapping[str, Any]):
        self.df = df
        self.columns = list(df.columns)
        self.sources = sources
        self.reasons: list[tuple[Column, Column]] = []
        self.cached: dict[str, Column] = {}
        self.count = 0

    def name(self, stem: str) -> str:
        self.count += 1
        return f"_rv_{stem}{self.count}"

    def fails(self, key: str, text: str) -> Column:
        """Every row fails, as this entry cannot be looked up at all."""
        self.reasons.append((F.lit(True), F.lit(f"{key}: {text}")))
        return F.lit(None).cast("string")

    def finish(self) -> DataFrame:
        """The rows with all lookups joined; those in the cache meet it together."""
        return attach_lookups(self.df, self.sources["cache"], self.cached) if self.cached else self.df

    def entry(self, key: str, spec: Any) -> Column:
        if not isinstance(spec, Mapping):
            if spec is None:
                return F.lit(None).cast("string")
            return render_template(_text(spec), self.columns)
        to_type = spec.get("to-type")
        default = spec.get("default")
        value = _text(spec.get("value"))
        if not value:
            converted, bad = _typed_default(default, to_type)
            self.reasons.append((bad, F.lit(f"{key}: cannot convert '{_text(default)}' to {to_type}")))
            return converted
        kind = spec.get("type", "")
        rendered = F.nullif(render_template(value, self.columns), F.lit(""))
        if kind in CACHE_TYPES:
            if "cache" in self.sources:
                found = self.name("cache")
                self.cached[found] = rendered
                result = F.col(found)
            else:
                result = self.fails(key, "there is no cache to look in")
        elif kind in TABLE_TYPES:
            result = self._cell(key, spec, rendered)
        elif kind == "SQL":
            result = self._query(key, spec, value)
        else:
            result = rendered
        text = F.coalesce(F.nullif(result, F.lit("")), F.lit(_text(default)).cast("string"))
        converted, bad = convert_type(text, to_type)
        self.reasons.append((bad, F.concat(F.lit(f"{key}: cannot convert '"), text, F.lit(f"' to {to_type}"))))
        return converted

    def _cell(self, key: str, spec: Mapping[str, Any], rendered: Column) -> Column:
        if TABLE_NAME not in spec:
            return self.fails(key, f"{TABLE_NAME} argument missing")
        table = spec[TABLE_NAME]
        if table not in self.sources.get("tables", {}):
            return self.fails(key, f"there is no table {table} to look in")
        last, many, lookup = self.name("last"), self.name("many"), self.name("cell")
        right = single_rows(self.sources["tables"][table], spec.get("match")).toDF(lookup, last, many)
        left = self.df.withColumn("_rv_key", rendered)
        self.df = left.join(right, left["_rv_key"] == right[lookup], "left").drop("_rv_key", lookup)
        self.reasons.append((F.coalesce(F.col(many), F.lit(False)), F.lit(f"{key}: several rows in {table} match")))
        return F.col(last)

    def _query(self, key: str, spec: Mapping[str, Any], text: str) -> Column:
        try:
            if has_references(text):
                return self._templated(spec, text)
            result = self.df.sparkSession.sql(text)
        except (PySparkException, TemplateError) as error:
            # the failing text goes with the reason
            said = str(error)
            return self.fails(key, said if text in said else f"{said}\n{text}")
        on = spec.get("on")
        if not on:
            order = spec.get("order-by")
            if order:
                result = result.orderBy(*[quoted(c) for c in order])
            row = result.select(quoted(result.columns[0]).cast("string")).first()
            return F.lit(row[0] if row else None).cast("string")
        first = first_values(result, list(on.values()), spec.get("order-by") or result.columns[:1])
        found = self.name("first")
        first = first.withColumnRenamed("_rv_first", found)
        condition = F.lit(True)
        for i, parent in enumerate(on):
            condition = condition & (self.df[parent] == first[f"_rv_q{i}"])
        self.df = self.df.join(first, condition, "left").drop(*[f"_rv_q{i}" for i in range(len(on))])
        return F.col(found)["v"]

    def _templated(self, spec: Mapping[str, Any], text: str) -> Column:
        """A query whose text refers to the row: its rows come with the values they were asked by."""
        template, result, ties = correlated(self.df, text)
        order = list(dict.fromkeys([*(spec.get("order-by") or ()), *[c for c in result.columns if c not in ties]]))
        found = self.name("first")
        first = first_values(result, list(ties), order, result.columns[0]).withColumnRenamed("_rv_first", found)
        rows = asking(self.df, template)
        same = F.lit(True)
        for i, name in enumerate(ties):
            same = same & (rows[name] == first[f"_rv_q{i}"])
        bad = self.name("bad")
        rows = rows.withColumn(bad, template.reason)
        self.df = rows.join(first, same, "left").drop(*ties, *[f"_rv_q{i}" for i in range(len(ties))])
        self.reasons.append((F.col(bad).isNotNull(), F.col(bad)))
        return F.col(found)["v"]


def enrich(df: DataFrame, spec: str | Mapping[str, Any], sources: Mapping[str, Any] | None = None) -> DataFrame:
    """Look up named values and put them into columns and/or a sorted JSON object in the content.

    ``spec`` (JSON text or a dict) has the sections ``extract-to-attributes`` and ``extract-to-json``, each
    mapping a name to a literal/template or to ``{"value", "type", "default", "to-type", …}``:

    * no type: the template itself; an empty result gives the default;
    * ``CACHE``: ``value`` is a key into ``sources["cache"]`` (key, value);
    * ``HBASE`` kinds: ``value`` selects a row of the cells table ``sources["tables"][spec["hbase-table"]]``
      by row key, or by the cell named in ``match``; its last cell is the result, several rows are a failure;
    * ``SQL``: ``value`` is a query whose first column and first row (by ``order-by``) is the result, tied to
      the row through ``on`` (column of the row to column of the query) or ``${name}`` in its text (see
      :func:`rivulet.functions.template.sql_template`).

    A failing row keeps its content, gets null values and goes to ``failure``. So do all rows if an entry names a source
    that is not there or a query that cannot be planned. For a spec per row see
    :func:`rivulet.operators.lookup_each.enrich_each`.
    """
    if isinstance(spec, str):
        try:
            spec = json.loads(spec)
        except json.JSONDecodeError as error:
            return failing(df, F.lit(f"bad enrichment spec: {error}"))
    plan = _Plan(df, sources or {})
    to_columns = {k: plan.entry(k, v) for k, v in (spec.get(TO_COLUMNS) or {}).items()}
    to_json = {k: plan.entry(k, v) for k, v in (spec.get(TO_JSON) or {}).items()}
    reason = F.lit(None).cast("string")
    for bad, text in reversed(plan.reasons):
        reason = F.when(bad, text).otherwise(reason)
    work = plan.finish().withColumn("_rv_reason", reason)
    fine = F.col("_rv_reason").isNull()
    added = {name: F.when(fine, value) for name, value in to_columns.items()}
    if TO_JSON in spec:
        kept = F.col("content") if "content" in df.columns else F.lit(None).cast("string")
        added["content"] = F.when(fine, json_object(to_json)).otherwise(kept)
    out = failing(work.withColumns(added), F.col("_rv_reason"))
    return out.drop(*[c for c in out.columns if c.startswith("_rv_")])
