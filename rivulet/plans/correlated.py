"""Queries whose text refers to columns of the asking row, run once for all rows as a lateral join."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.template import SqlTemplate, sql_template

#: Names of the asking rows, of a query's rows, and of a column that every asking row has.
ROWS, FOUND, ALL = "_rv_rows", "_rv_found", "_rv_call"


def correlated(df: DataFrame, query: str) -> tuple[SqlTemplate, DataFrame, dict[str, str]]:
    """(the template, the query's rows, the columns that tie them): rows come with the values they were asked by.

    The query runs once for each distinct combination of the values its text refers to, not once for each row. Rows of
    ``df`` meet it by the template's columns and ALL, the same on both sides.
    """
    template = sql_template(query, df, ROWS)
    keys = df.select(template.reason.alias("_rv_reason"), F.lit(0).alias(ALL), *[c.alias(n) for n, c in template.columns.items()])
    keys = keys.filter("_rv_reason is null").drop("_rv_reason").distinct()
    names = [ALL, *template.columns]
    own = ", ".join(f"{ROWS}.{n}" for n in names)
    text = template.text.strip().rstrip(";").strip()
    # the name is gone once the query is planned
    spark, view = df.sparkSession, f"{ROWS}_{uuid.uuid4().hex}"
    keys.createOrReplaceTempView(view)
    try:
        result = spark.sql(f"select {FOUND}.*, {own} from {view} {ROWS} join lateral (\n{text}\n) {FOUND} on true")
    finally:
        spark.catalog.dropTempView(view)
    return template, result, {n: n for n in names}


def asking(df: DataFrame, template: SqlTemplate) -> DataFrame:
    """``df`` with the columns that tie it to the query's rows."""
    return df.withColumns({ALL: F.lit(0), **template.columns})
