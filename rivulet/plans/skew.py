"""Running values over ordered groups that stay balanced when one group is huge.

A window hands each group to one task. That is fine until one key holds a large share of the rows.
:class:`OrderedGroups` therefore counts the groups first. Groups no larger than an average slice of the
rows keep the plain window. A larger ("hot") group is cut along its own order into chunks; the
window then runs per (group, chunk), and what the earlier chunks of the same group amount to comes in
through a small broadcast table holding one row per chunk.

Size bounds, with P slices (``spark.sql.shuffle.partitions``, at least 1000): a hot group has more than
total/P rows, so there are fewer than P of them, and a group of n rows gets at most n/(total/P) + 2 chunks,
together fewer than 3P. Everything collected or broadcast here has at most that many rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

# A group below this many rows is never worth cutting.
DEFAULT_HOT_ROWS = 1_000_000
MIN_SLICES = 1000
SAMPLES_PER_CHUNK = 64

CHUNK = "_rv_chunk"
BOUNDS = "_rv_bounds"


@dataclass(frozen=True)
class Running:
    """One running value. ``kind``: max, min, first, last (nulls skipped), count, sum or total.

    All but ``total`` look at the rows strictly before the current one; ``total`` counts the whole group.
    """

    name: str
    kind: str
    value: Column


def _as_column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _same(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    condition = F.lit(True)
    for a, b in pairs:
        condition = condition & left[a].eqNullSafe(right[b])
    return condition


def hot_groups(df: DataFrame, keys: list[str], hot_rows: int) -> tuple[list[Row], int]:
    """(groups above the threshold with their counts, threshold).

    At most P rows reach the driver: only that many groups can each exceed total/P rows.
    """
    slices = max(MIN_SLICES, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    total = df.count()
    threshold = max(hot_rows, total // slices)
    if total <= threshold:
        return [], threshold
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rv_rows"))
    return counts.filter(F.col("_rv_rows") > threshold).collect(), threshold


class OrderedGroups:
    """Rows of ``df`` grouped by ``keys`` and ordered by ``order_by`` inside each group.

    ``order_by`` must order each group totally and is demanded at every size; ``keys`` may be empty (all rows are
    one group).
    ``df`` must be deterministic: it is read again to look for hot groups and, where there are some, to sum up
    their chunks. Those reads take just the key, order and value columns; pass a costly result through
    :func:`rivulet.session.written` first.
    """

    def __init__(
        self,
        df: DataFrame,
        keys: Sequence[str | Column],
        order_by: Sequence[str | Column],
        hot_rows: int = DEFAULT_HOT_ROWS,
    ):
        if not order_by:
            raise ValueError("ordered groups need an order")
        keys = list(keys) or [F.lit(0)]
        self.keys = [f"_rv_k{i}" for i in range(len(keys))]
        self.order = [f"_rv_o{i}" for i in range(len(order_by))]
        names = dict(zip(self.keys + self.order, [_as_column(c) for c in [*keys, *order_by]]))
        self.original = list(df.columns)
        self.added: list[str] = []
        self.bounds: DataFrame | None = None
        self.df = df.withColumns(names)
        hot, threshold = hot_groups(self.df, self.keys, hot_rows)
        if hot:
            self.bounds = self._cut(hot, threshold)
            self.df = self._with_chunk(self.df, "left")
        else:
            self.df = self.df.withColumn(CHUNK, F.lit(0))

    # -- cutting hot groups -------------------------------------------------

    def _position(self) -> Column:
        return F.struct(*[F.col(name) for name in self.order])

    def _cut(self, hot: list[Row], threshold: int) -> DataFrame:
        """Sorted cut points per hot group, taken from a sample and then frozen as literals.

        The sample only decides how even the chunks are: any set of cut points gives the same result.
        """
        spark = self.df.sparkSession
        chunks = [-(-row["_rv_rows"] // threshold) + 1 for row in hot]
        fraction = min(1.0, SAMPLES_PER_CHUNK * sum(chunks) / sum(row["_rv_rows"] for row in hot))
        key_type = ", ".join(f"{k} {self.df.schema[k].dataType.simpleString()}" for k in self.keys)
        sized = spark.createDataFrame(
            [(*[row[k] for k in self.keys], n) for row, n in zip(hot, chunks)], f"{key_type}, _rv_chunks int"
        )
        names = [f"{k}_h" for k in self.keys]
        sized = sized.toDF(*names, "_rv_chunks")
        rows = self.df.select(*self.keys, *self.order)
        sample = rows.join(
            F.broadcast(sized), _same(rows, sized, list(zip(self.keys, names))), "inner"
        ).sample(fraction=fraction, seed=7)
        by_key = Window.partitionBy(*self.keys)
        ordered = by_key.orderBy(*self.order)
        step = F.floor((F.row_number().over(ordered) - 1) * F.col("_rv_chunks") / F.count(F.lit(1)).over(by_key))
        marked = sample.select(*self.keys, self._position().alias("p"), step.alias("s"))
        firsts = marked.groupBy(*self.keys, "s").agg(F.min("p").alias("p")).filter("s > 0")
        cuts = firsts.groupBy(*self.keys).agg(F.array_sort(F.collect_set("p")).alias(BOUNDS))
        frozen = cuts.collect()
        self.most_cuts = max((len(row[BOUNDS]) for row in frozen), default=0)
        return spark.createDataFrame(frozen, cuts.schema)

    def _with_chunk(self, df: DataFrame, how: str) -> DataFrame:
        """Add the chunk number: how many cut points of the row's group are not above the row.

        A binary search, one projection per halving, which stays in generated code.
        """
        names = [f"{k}_b" for k in self.keys]
        bounds = self.bounds.toDF(*names, BOUNDS)
        out = df.join(F.broadcast(bounds), _same(df, bounds, list(zip(self.keys, names))), how)
        out = out.withColumns({"_rv_here": self._position(), CHUNK: F.lit(0)})
        for bit in reversed(range(self.most_cuts.bit_length())):
            step = 1 << bit
            reached = F.get(F.col(BOUNDS), F.col(CHUNK) + (step - 1)) <= F.col("_rv_here")
            out = out.withColumn(CHUNK, F.col(CHUNK) + F.when(reached, F.lit(step)).otherwise(F.lit(0)))
        return out.drop(*names, BOUNDS, "_rv_here")

    def chunk_counts(self) -> DataFrame | None:
        """(keys, number of chunks) of the hot groups; None when there are none."""
        if self.bounds is None:
            return None
        return self.bounds.select(*self.keys, (F.size(BOUNDS) + 1).alias("_rv_n"))

    # -- running values ------------------------------------------------------

    def with_running(self, *specs: Running) -> "OrderedGroups":
        """Add each running value as a column, in place; one shuffle for all of them."""
        values = {f"_rv_v{len(self.added)}_{i}": spec.value for i, spec in enumerate(specs)}
        self.df = self.df.withColumns(values)
        parts = Window.partitionBy(*self.keys, CHUNK).orderBy(*self.order)
        before = parts.rowsBetween(Window.unboundedPreceding, -1)
        whole = parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        local = {}
        for name, spec in zip(values, specs):
            col = F.col(name)
            local[spec.name] = {
                "max": lambda c: F.max(c).over(before),
                "min": lambda c: F.min(c).over(before),
                "first": lambda c: F.first(c, ignorenulls=True).over(before),
                "last": lambda c: F.last(c, ignorenulls=True).over(before),
                "count": lambda c: F.count(c).over(before),
                "sum": lambda c: F.coalesce(F.sum(c).over(before), F.lit(0)),
                "total": lambda c: F.count(c).over(whole),
            }[spec.kind](col)
        if self.bounds is None:
            self.df = self.df.withColumns(local).drop(*values)
        else:
            carry = self._carry(list(values), specs)
            names = [f"{k}_c" for k in self.keys] + ["_rv_cc"]
            carry = carry.toDF(*names, *[f"_rv_in{i}" for i in range(len(specs))])
            pairs = list(zip([*self.keys, CHUNK], names))
            joined = self.df.join(F.broadcast(carry), _same(self.df, carry, pairs), "left")
            joined = joined.withColumns({f"_rv_l{i}": local[s.name] for i, s in enumerate(specs)})
            merged = {}
            for i, spec in enumerate(specs):
                inside, earlier = F.col(f"_rv_l{i}"), F.col(f"_rv_in{i}")
                merged[spec.name] = {
                    "max": F.greatest(inside, earlier),
                    "min": F.least(inside, earlier),
                    "first": F.coalesce(earlier, inside),
                    "last": F.coalesce(inside, earlier),
                    "count": inside + F.coalesce(earlier, F.lit(0)),
                    "sum": inside + F.coalesce(earlier, F.lit(0)),
                    "total": F.coalesce(earlier, inside),
                }[spec.kind]
            self.df = joined.withColumns(merged).drop(
                *values, *names, *[f"_rv_in{i}" for i in range(len(specs))], *[f"_rv_l{i}" for i in range(len(specs))]
            )
        self.added.extend(spec.name for spec in specs)
        return self

    def _carry(self, values: list[str], specs: Sequence[Running]) -> DataFrame:
        """Per hot (group, chunk): what the earlier chunks of the group amount to."""
        names = [f"{k}_b" for k in self.keys]
        bounds = self.bounds.toDF(*names, BOUNDS).drop(BOUNDS)
        hot = self.df.join(F.broadcast(bounds), _same(self.df, bounds, list(zip(self.keys, names))), "left_semi")
        here = self._position()
        summary = []
        for i, (name, spec) in enumerate(zip(values, specs)):
            col = F.col(name)
            where = F.when(col.isNotNull(), here)
            summary.append(
                {
                    "max": lambda: F.max(col),
                    "min": lambda: F.min(col),
                    "first": lambda: F.min_by(col, where),
                    "last": lambda: F.max_by(col, where),
                    "count": lambda: F.count(col),
                    "sum": lambda: F.sum(col),
                    "total": lambda: F.count(col),
                }[spec.kind]().alias(f"s{i}")
            )
        chunks = hot.groupBy(*self.keys, CHUNK).agg(*summary)
        group = Window.partitionBy(*self.keys)
        before = group.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        out = []
        for i, spec in enumerate(specs):
            col = F.col(f"s{i}")
            out.append(
                {
                    "max": lambda: F.max(col).over(before),
                    "min": lambda: F.min(col).over(before),
                    "first": lambda: F.first(col, ignorenulls=True).over(before),
                    "last": lambda: F.last(col, ignorenulls=True).over(before),
                    "count": lambda: F.sum(col).over(before),
                    "sum": lambda: F.sum(col).over(before),
                    "total": lambda: F.sum(col).over(group),
                }[spec.kind]().alias(f"c{i}")
            )
        return chunks.select(*self.keys, CHUNK, *out)

    def result(self) -> DataFrame:
        """The rows with their running values and none of the helper columns."""
        return self.df.drop(*self.keys, *self.order, CHUNK)


def numbered(
    df: DataFrame, keys: Sequence[str | Column], order_by: Sequence[str | Column], hot_rows: int = DEFAULT_HOT_ROWS
) -> OrderedGroups:
    """Groups with ``_rv_index`` (from 1) and ``_rv_count`` per row."""
    one = F.lit(1)
    groups = OrderedGroups(df, keys, order_by, hot_rows).with_running(
        Running("_rv_before", "count", one), Running("_rv_count", "total", one)
    )
    groups.df = groups.df.withColumn("_rv_index", F.col("_rv_before") + 1).drop("_rv_before")
    return groups
