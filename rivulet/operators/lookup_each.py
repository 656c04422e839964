"""Enrichment where every row brings its own spec."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import TARGET_TYPES, WHOLE_NUMBER
from ..functions.template import REFERENCE, quoted
from .lookup import CACHE_TYPES, TABLE_NAME, TABLE_TYPES, TO_COLUMNS, TO_JSON, key_or_spread, unique_lookup
from .routing import failing

SPEC = f"struct<`{TO_COLUMNS}` map<string,variant>, `{TO_JSON}` map<string,variant>>"


def _member(entry: Column, path: str) -> Column:
    return F.try_variant_get(entry, f"$['{path}']", "string")


def _rendered(text: Column, df: DataFrame) -> Column:
    """``${name}`` in a text that is only known per row; what names no column gives nothing."""
    for name in df.columns:
        if dict(df.dtypes)[name] not in ("variant",) and not dict(df.dtypes)[name].startswith(("map", "struct", "array")):
            text = F.replace(text, F.lit("${" + name + "}"), F.coalesce(quoted(name).cast("string"), F.lit("")))
    return F.regexp_replace(text, REFERENCE, "")


def _typed(text: Column, kind: Column) -> Column:
    """The text as a variant of the type that ``kind`` names; null where it cannot be one."""
    value = F.when(text.isNull(), F.lit(None).cast("variant"))
    for name, spark_type in TARGET_TYPES.items():
        if spark_type != "string":
            held = text.try_cast(spark_type)
            if spark_type in ("int", "bigint"):
                held = F.when(text.rlike(WHOLE_NUMBER), held)
            value = value.when(kind == name, held.cast("variant"))
    return value.otherwise(text.cast("variant"))


def _cells_found(asked: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per (table, family, qualifier, key) asked for: the last cell of the row found, and whether several rows match.

    Without a family the key is the row key, else the value of that cell.
    """
    cells = None
    for name, table in tables.items():
        table = table.select(F.lit(name).alias("t"), "row_key", F.col("family").alias("f"), F.col("qualifier").alias("q"), "value")
        cells = table if cells is None else cells.unionAll(table)
    last = cells.groupBy("t", "row_key").agg(F.max_by("value", F.struct("f", "q")).alias("_rv_last"))
    by_cell = cells.join(asked.filter("f is not null").withColumnRenamed("key", "value").distinct(), ["t", "f", "q", "value"])
    rows = by_cell.groupBy("t", "f", "q", F.col("value").alias("key")).agg(
        F.max("row_key").alias("row_key"), (F.min("row_key") != F.max("row_key")).alias("_rv_many")
    )
    none = F.lit(None).cast("string")
    by_key = asked.filter("f is null").distinct().select("t", none.alias("f"), none.alias("q"), "key", F.col("key").alias("row_key"), F.lit(False).alias("_rv_many"))
    return rows.unionByName(by_key).join(last, ["t", "row_key"]).select("t", "f", "q", "key", "_rv_last", "_rv_many")


def enrich_each(
    df: DataFrame, spec: str = "spec", sources: Mapping[str, Any] | None = None, into: str = "attributes"
) -> DataFrame:
    """As :func:`rivulet.operators.enrich` with the spec of each row in the column ``spec``.

    Names differ by row, so the values of ``extract-to-attributes`` come as text in a map column ``into``; those of
    ``extract-to-json`` as one JSON object, keys sorted, in ``content``. Entries become rows, those of one kind of source
    meet it in one join whatever their number, and they are folded back by a number drawn per row. A row whose spec is no
    JSON object, names a missing source, matches several rows, asks for a type its value cannot have, or holds a query
    (a text per row cannot be planned once) goes to ``failure`` with the first reason by name; content stays as it was.
    """
    sources = sources or {}
    tables = dict(sources.get("tables") or {})
    row = F.struct(*[quoted(c) for c in df.columns])
    parsed = F.from_json(F.col(spec), SPEC)

    def entries(section: str, number: int) -> Column:
        found = F.coalesce(F.map_entries(parsed[section]), F.array().cast("array<struct<key:string,value:variant>>"))

        def one(e: Column) -> Column:
            whole = e["value"]
            is_object = F.coalesce(F.schema_of_variant(whole).startswith("OBJECT"), F.lit(False))
            plain = F.try_variant_get(whole, "$", "string")
            value = F.when(is_object, _member(whole, "value")).otherwise(plain)
            return F.struct(
                F.lit(number).alias("section"), e["key"].alias("name"), is_object.alias("is_object"),
                F.when(value != "", _rendered(value, df)).alias("value"), F.when(is_object, _member(whole, "default")).alias("default"),
                F.when(is_object, _member(whole, "to-type")).alias("to"), F.when(is_object, F.coalesce(_member(whole, "type"), F.lit(""))).alias("kind"),
                F.when(is_object, _member(whole, TABLE_NAME)).alias("t"),
                F.when(is_object, F.try_variant_get(whole, "$.match.family", "string")).alias("f"),
                F.when(is_object, F.try_variant_get(whole, "$.match.qualifier", "string")).alias("q"),
            )

        return F.transform(found, one)

    nothing = F.struct(
        F.lit(-1).alias("section"), *[F.lit(None).cast("boolean" if n == "is_object" else "string").alias(n) for n in ("name", "is_object", "value", "default", "to", "kind", "t", "f", "q")]
    )
    # the first entry stands for the row itself and carries it
    asked = F.concat(F.array(nothing), entries(TO_COLUMNS, 0), entries(TO_JSON, 1))
    fine = F.coalesce(F.try_parse_json(F.col(spec)).isNotNull() & F.schema_of_variant(F.try_parse_json(F.col(spec))).startswith("OBJECT"), F.lit(False))
    numbered = df.select(F.uuid().alias("_rv_no"), row.alias("_rv_row"), fine.alias("_rv_fine"), (F.when(fine, parsed[TO_JSON]).isNotNull()).alias("_rv_json"), asked.alias("_rv_asked"))
    long = numbered.select("_rv_no", "_rv_row", "_rv_fine", "_rv_json", F.explode("_rv_asked").alias("e")).select(
        "_rv_no", *[F.when(F.col("e.section") < 0, F.col(c)).alias(c) for c in ("_rv_row", "_rv_fine", "_rv_json")], "e.*"
    )
    key = F.nullif(F.col("value"), F.lit(""))
    long = long.withColumn("key", key)
    none = F.lit(None).cast("string")

    # one join per kind of source, all entries in it at once
    is_cache = F.col("kind").isin(*CACHE_TYPES) & F.col("key").isNotNull()
    is_cell = F.col("kind").isin(*TABLE_TYPES) & F.col("key").isNotNull()
    work = long.withColumns({"_rv_value": F.when(~F.coalesce(is_cache | is_cell, F.lit(False)), F.col("key")), "_rv_many": F.lit(False)})
    if "cache" in sources:
        right = unique_lookup(sources["cache"]).select(F.col("key").alias("_rv_lk"), F.col("value").alias("_rv_cached"))
        work = work.withColumn("_rv_ck", key_or_spread(F.when(is_cache, F.col("key"))))
        work = work.join(right, work["_rv_ck"] == right["_rv_lk"], "left").withColumn(
            "_rv_value", F.when(is_cache, F.col("_rv_cached")).otherwise(F.col("_rv_value"))
        ).drop("_rv_ck", "_rv_lk", "_rv_cached")
    if tables:
        keys = long.filter(is_cell).select("t", "f", "q", "key")
        found = _cells_found(keys, tables).toDF("_rv_t", "_rv_f", "_rv_q", "_rv_k", "_rv_last", "_rv_hits")
        work = work.withColumn("_rv_ck", key_or_spread(F.when(is_cell, F.col("key"))))
        same = (
            (work["_rv_ck"] == found["_rv_k"]) & (work["t"] == found["_rv_t"])
            & work["f"].eqNullSafe(found["_rv_f"]) & work["q"].eqNullSafe(found["_rv_q"])
        )
        work = work.join(found, same, "left").withColumns({
            "_rv_value": F.when(is_cell, F.col("_rv_last")).otherwise(F.col("_rv_value")),
            "_rv_many": F.coalesce("_rv_hits", F.lit(False)),
        }).drop("_rv_ck", "_rv_t", "_rv_f", "_rv_q", "_rv_k", "_rv_last", "_rv_hits")

    text = F.when(F.col("is_object"), F.coalesce(F.nullif("_rv_value", F.lit("")), F.col("default"))).otherwise(F.col("value"))
    typed = _typed(text, F.coalesce("to", F.lit("string")))
    said = F.concat(F.col("name"), F.lit(": "), F.col("_rv_said"))
    work = work.withColumns({"_rv_text": text, "_rv_typed": typed}).withColumn(
        "_rv_said",
        F.when(F.lit("cache" not in sources) & is_cache, F.lit("there is no cache to look in"))
        .when(is_cell & F.col("t").isNull(), F.lit(f"{TABLE_NAME} argument missing"))
        .when(is_cell & ~F.col("t").isin(*tables), F.concat(F.lit("there is no table "), F.col("t"), F.lit(" to look in")))
        .when(F.col("_rv_many"), F.concat(F.lit("several rows in "), F.col("t"), F.lit(" match")))
        .when((F.col("kind") == "SQL") & F.col("key").isNotNull(), F.concat(F.lit("a query per row cannot be planned: "), F.col("key")))
        .when(F.col("_rv_text").isNotNull() & F.col("_rv_typed").isNull(), F.concat(F.lit("cannot convert '"), F.col("_rv_text"), F.lit("' to "), F.col("to"))),
    ).withColumn("_rv_said", said)

    def pairs(section: int, value: str) -> Column:
        return F.map_from_entries(F.collect_list(F.when(F.col("section") == section, F.struct(F.col("name"), F.col(value)))))

    folded = work.groupBy("_rv_no").agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in ("_rv_row", "_rv_fine", "_rv_json")],
        F.min("_rv_said").alias("_rv_reason"), pairs(0, "_rv_text").alias("_rv_columns"), pairs(1, "_rv_typed").alias("_rv_object"),
    )
    reason = F.when(~F.col("_rv_fine"), F.lit("the spec is no JSON object")).otherwise(F.col("_rv_reason"))
    folded = folded.withColumn("_rv_reason", reason)
    good = F.col("_rv_reason").isNull()
    kept = F.col("_rv_row.content") if "content" in df.columns else none
    made = F.to_json(F.to_variant_object("_rv_object"))
    out = folded.select(
        *[F.col("_rv_row").getField(c).alias(c) for c in df.columns if c not in (into, "content")],
        F.when(good, F.col("_rv_columns")).alias(into), F.when(good & F.col("_rv_json"), made).otherwise(kept).alias("content"), "_rv_reason",
    )
    return failing(out, F.col("_rv_reason")).drop("_rv_reason")
