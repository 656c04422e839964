"""SQL as a source of rows, of single values, and as a script."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import strip_qualifier, to_text
from ..functions.template import TemplateError, has_references, quoted
from ..operators.lookup import first_values
from ..operators.routing import REASON as FAILURE
from ..operators.routing import ROUTE, failing, with_route
from ..plans.correlated import asking, correlated
from ..plans.skew import CHUNK, DEFAULT_HOT_ROWS, numbered


#: What keeps a row from asking a query whose text refers to it.
REASON = "_rv_reason"


def _frame(spark: SparkSession, query: str | DataFrame) -> DataFrame:
    return query if isinstance(query, DataFrame) else spark.sql(query)


def _said(error: Exception, query: str) -> str:
    text = str(error)
    return text if query in text else f"{text}\n{query}"


def sql_rows(
    df: DataFrame | None,
    query: str | DataFrame,
    params: Mapping[str, str] | None = None,
    order_by: Sequence[str] = (),
    *,
    spark: SparkSession | None = None,
    strip_qualifiers: bool = False,
    block_on_failure: bool = True,
    hot_rows: int = DEFAULT_HOT_ROWS,
) -> DataFrame:
    """One output row per query row, every value as text, with fragment columns.

    A SQL text may name columns of the input row as ``${name}``, within quotes or outside (see
    :func:`rivulet.functions.template.sql_template`); it is planned once, as a lateral join, and run once for each
    distinct combination of their values. A row whose values do not fit the text goes to ``failure`` with the text. Otherwise ``params`` ties the query
    to the input rows (input column to query column). A row without a match goes to ``empty``. With ``df=None`` the query stands alone. ``query`` is SQL text or a DataFrame (a JDBC read, say).
    Rows that ``order_by`` leaves tied go by all their columns as text, so fragments are numbered the same at any size.
    A query that cannot be planned raises, or with ``block_on_failure=False`` sends the rows to ``failure``.
    """
    session = df.sparkSession if df is not None else spark
    if df is not None and isinstance(query, str) and has_references(query):
        try:
            template, result, ties = correlated(df, query)
        except (PySparkException, TemplateError) as error:
            if block_on_failure:
                raise
            return failing(df, F.lit(_said(error, query)))
        rows = asking(df.withColumn(REASON, template.reason), template)
        fine, bad = (rows.filter(f"{REASON} is {x} null") for x in ("", "not"))
        out = sql_rows(fine, result, ties, order_by, strip_qualifiers=strip_qualifiers, hot_rows=hot_rows)
        bad = failing(bad, F.col(REASON)).select(*df.columns, *[c for c in (ROUTE, FAILURE) if c not in df.columns])
        return out.unionByName(bad, allowMissingColumns=True)
    if df is not None and not params:
        raise ValueError("params must tie the query to the input rows")
    try:
        result = _frame(session, query)
    except PySparkException as error:
        if block_on_failure or df is None:
            raise
        return failing(df, F.lit(str(error)))
    params = dict(params or {})
    target = {c: strip_qualifier(c) if strip_qualifiers else c for c in result.columns}
    order = [*[quoted(c) for c in order_by], *[to_text(quoted(c)) for c in result.columns]]
    groups = numbered(result, [quoted(c) for c in params.values()], order, hot_rows)
    values = {f"_rv_t{i}": name for i, name in enumerate(target.values())}
    rows = groups.df.select(
        *groups.keys,
        CHUNK,
        F.col("_rv_index").alias("fragment_index"),
        F.col("_rv_count").alias("fragment_count"),
        *[to_text(quoted(c)).alias(t) for c, t in zip(target, values)],
    )
    if df is None:
        # One identifier for the whole result: it is drawn once, while the plan is built.
        identifier = F.lit(session.range(1).select(F.uuid()).first()[0])
        out = rows.drop(*groups.keys, CHUNK).withColumn("fragment_identifier", identifier)
        return with_route(out.withColumnsRenamed(values), "success")

    parents = df.withColumns(
        {"_rv_id": F.uuid(), **{f"_rv_p{i}": quoted(c) for i, c in enumerate(params)}}
    )
    chunks = groups.chunk_counts()
    on = [(f"_rv_p{i}", k) for i, k in enumerate(groups.keys)]
    if chunks is None:
        parents = parents.withColumns({"_rv_n": F.lit(1), "_rv_pc": F.lit(0)})
    else:
        # A hot group's rows sit in several chunks; its parents are repeated once per chunk to meet them.
        names = [f"{k}_n" for k in groups.keys]
        chunks = chunks.toDF(*names, "_rv_n")
        condition = F.lit(True)
        for (parent, _), name in zip(on, names):
            condition = condition & (parents[parent] == chunks[name])
        parents = parents.join(F.broadcast(chunks), condition, "left").drop(*names)
        parents = parents.withColumn("_rv_n", F.coalesce("_rv_n", F.lit(1)))
        parents = parents.withColumn("_rv_pc", F.explode(F.sequence(F.lit(0), F.col("_rv_n") - 1)))
    condition = parents["_rv_pc"] == rows[CHUNK]
    for parent, key in on:
        condition = condition & (parents[parent] == rows[key])
    joined = parents.join(rows, condition, "left")
    matched = F.col("fragment_index").isNotNull()
    joined = joined.filter(matched | (F.col("_rv_n") == 1))
    added: dict[str, Column] = {name: F.col(t) for t, name in values.items()}
    for name in added:
        if name in df.columns:
            added[name] = F.when(matched, added[name]).otherwise(quoted(name).cast("string"))
    added["fragment_identifier"] = F.when(matched, F.col("_rv_id"))
    out = with_route(
        joined.withColumns(added), F.when(matched, F.lit("success")).otherwise(F.lit("empty"))
    )
    return out.drop(*[c for c in out.columns if c.startswith("_rv_")])


def sql_scalar(
    df: DataFrame,
    query: str | DataFrame,
    params: Mapping[str, str] | None = None,
    order_by: Sequence[str] = (),
    into: str = "content",
    *,
    block_on_failure: bool = True,
) -> DataFrame:
    """First column of the first query row (by ``order_by``) as text; no row at all goes to ``empty``.

    A SQL text may name columns of the input row as ``${name}``, as in :func:`sql_rows`; its first row is that of
    ``order_by``, then of all columns. Without that and without ``params`` the query is the same for every input row,
    so its one value is read once.
    """
    if isinstance(query, str) and has_references(query):
        try:
            template, result, ties = correlated(df, query)
        except (PySparkException, TemplateError) as error:
            if block_on_failure:
                raise
            return failing(df, F.lit(_said(error, query)))
        order = list(dict.fromkeys([*order_by, *[c for c in result.columns if c not in ties]]))
        first = first_values(result, list(ties), order, result.columns[0])
        rows = asking(df.withColumn(REASON, template.reason), template)
        same = F.lit(True)
        for i, name in enumerate(ties):
            same = same & (rows[name] == first[f"_rv_q{i}"])
        return _with_first(rows.join(first, same, "left"), df, into, F.col(REASON))
    try:
        result = _frame(df.sparkSession, query)
    except PySparkException as error:
        if block_on_failure:
            raise
        return failing(df, F.lit(str(error)))
    value = result.columns[0]
    if not params:
        ordered = result.orderBy(*[quoted(c) for c in order_by]) if order_by else result
        row = ordered.select(to_text(quoted(value)).alias("v")).first()
        if row is None:
            return with_route(df, "empty")
        return with_route(df.withColumn(into, F.lit(row["v"])), "success")
    if not order_by:
        raise ValueError("order_by must say which row is first")
    first = first_values(result, list(params.values()), order_by, value)
    parents = df.withColumns({f"_rv_p{i}": quoted(c) for i, c in enumerate(params)})
    condition = F.lit(True)
    for i in range(len(params)):
        condition = condition & (parents[f"_rv_p{i}"] == first[f"_rv_q{i}"])
    return _with_first(parents.join(first, condition, "left"), df, into, F.lit(None).cast("string"))


def _with_first(joined: DataFrame, df: DataFrame, into: str, reason: Column) -> DataFrame:
    """The value found goes into a column; rows without any are ``empty``, rows with a reason fail."""
    found = F.col("_rv_first").isNotNull()
    kept = quoted(into).cast("string") if into in df.columns else F.lit(None).cast("string")
    joined = joined.withColumn(into, F.when(found, to_text(F.col("_rv_first.v"))).otherwise(kept))
    out = failing(joined, reason, F.when(found, F.lit("success")).otherwise(F.lit("empty")))
    return out.drop(*[c for c in out.columns if c.startswith("_rv_")])


def run_sql_script(
    spark: SparkSession, text: str, delimiter: str = ";", raise_on_error: bool = False
) -> DataFrame:
    """Run statements in order, stopping at the first error; reports one row per statement.

    The split is literal. Each statement is itself a distributed job; only its outcome is kept here.
    """
    report = []
    failed = False
    for number, statement in enumerate((s.strip() for s in text.split(delimiter)), 1):
        if not statement:
            continue
        if failed:
            report.append((number, statement, "not run", None))
            continue
        try:
            spark.sql(statement)
            report.append((number, statement, "success", None))
        except PySparkException as error:
            if raise_on_error:
                raise
            failed = True
            report.append((number, statement, "failure", str(error)))
    return spark.createDataFrame(report, "stmt_no int, statement string, status string, failure_reason string")


def _truncate(spark: SparkSession, name: str) -> None:
    if spark.catalog.getTable(name).tableType == "EXTERNAL":
        # TRUNCATE refuses tables with a location of their own; overwriting with nothing empties them, all partitions
        # whatever mode the session is in.
        nothing = spark.createDataFrame([], spark.table(name).schema)
        nothing.write.option("partitionOverwriteMode", "static").insertInto(name, overwrite=True)
    else:
        spark.sql(f"TRUNCATE TABLE {name}")


def truncate_tables(spark: SparkSession, names: str | Sequence[str]) -> DataFrame:
    """Empty each table of the list, stopping at the first error; reports one row per table."""
    names = names.split(",") if isinstance(names, str) else list(names)
    report = []
    for name in names:
        if report and report[-1][1] != "success":
            report.append((name, "not run", None))
            continue
        try:
            _truncate(spark, name)
            report.append((name, "success", None))
        except PySparkException as error:
            report.append((name, "failure", str(error)))
    return spark.createDataFrame(report, "table_name string, route string, failure_reason string")
