"""Named outputs: each row carries the output it belongs to and, on failure, why."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUTE = "route"
REASON = "failure_reason"


def with_route(df: DataFrame, route: Column | str, reason: Column | None = None) -> DataFrame:
    """Set the route of every row (and the reason, null where there is none); a row that failed before stays failed."""
    route = F.lit(route) if isinstance(route, str) else route
    reason = F.lit(None).cast("string") if reason is None else reason
    if ROUTE in df.columns and REASON in df.columns:
        failed = F.coalesce(F.col(ROUTE) == "failure", F.lit(False))
        route = F.when(failed, F.lit("failure")).otherwise(route)
        reason = F.when(failed, F.col(REASON)).otherwise(reason)
    return df.withColumns({ROUTE: route, REASON: reason})


def failing(df: DataFrame, reason: Column, otherwise: Column | str = "success") -> DataFrame:
    """``failure`` wherever ``reason`` is not null, ``otherwise`` elsewhere."""
    other = F.lit(otherwise) if isinstance(otherwise, str) else otherwise
    return with_route(df, F.when(reason.isNotNull(), F.lit("failure")).otherwise(other), reason)


def split_routes(df: DataFrame, routes: Iterable[str]) -> dict[str, DataFrame]:
    """One DataFrame per route. The names are given, so no job runs to find them."""
    return {name: df.filter(F.col(ROUTE) == name).drop(ROUTE) for name in routes}


def route_counts(df: DataFrame) -> DataFrame:
    """Rows per route."""
    return df.groupBy(ROUTE).agg(F.count(F.lit(1)).alias("records"))
