"""Keyed wide-column tables held as cells: (row_key, family, qualifier, value), all text.

Single-key calls become set operations: a DataFrame of keys or cells in, and, where the table changes, the
new version of the table out next to a per-request result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.template import has_references, quoted, render_template
from ..plans.skew import CHUNK, DEFAULT_HOT_ROWS, OrderedGroups, Running, numbered
from ..session import last_key_wins, written
from ..sources.tables import KeyedTable
from .routing import failing, with_route

CELL = ["row_key", "family", "qualifier"]
CELL_VALUE = [*CELL, "value"]

# The four ways of naming a cell's column.
NAME_FORMATS = ("tablename.family.qualifier", "tablename.qualifier", "family.qualifier", "qualifier")

#: Row keys a record meets at once in :func:`scan_cells_per_record`.
SCAN_BLOCK = 512


class TableChange(NamedTuple):
    """A changed table: its new cells and what happened to each request."""

    cells: DataFrame
    results: DataFrame


def cell_name(name_format: str, table_name: str | None = None) -> Column:
    """Column name of a cell in one of the four formats."""
    if name_format not in NAME_FORMATS:
        raise ValueError(f"name_format must be one of {NAME_FORMATS}")
    table = F.lit(table_name or "null")
    parts = {"tablename": table, "family": F.col("family"), "qualifier": F.col("qualifier")}
    return F.concat_ws(".", *[parts[p] for p in name_format.split(".")])


def scan_cells(
    cells: DataFrame,
    *,
    row_filter: Column | None = None,
    cell_filter: Column | None = None,
    having: Column | None = None,
    row_key_name: str = "row_key",
    name_format: str = "qualifier",
    table_name: str | None = None,
    names: Sequence[str] | None = None,
    parent: dict[str, str] | None = None,
    fragments: bool = True,
    hot_rows: int = DEFAULT_HOT_ROWS,
) -> DataFrame:
    """One row per row key, its cells as named text, numbered in row-key order.

    ``row_filter`` tests the row key, ``cell_filter`` keeps cells, ``having`` keeps rows with at least one such
    cell. With ``names`` the cells become columns through one partial aggregation; without, they come as a map
    column ``attributes`` (a row of the table is then one value). ``parent`` adds the asking record's columns.
    """
    kept = cells
    if row_filter is not None:
        kept = kept.filter(row_filter)
    if cell_filter is not None:
        kept = kept.filter(cell_filter)
    named = kept.withColumn("_rv_name", cell_name(name_format, table_name))
    # A name met in several families keeps the last one, as when a later cell overwrites an earlier.
    order = F.struct("family", "qualifier")
    test = [] if having is None else [F.max(having).alias("_rv_hit")]
    if names is not None:
        picked = [F.max_by("value", F.when(F.col("_rv_name") == n, order)).alias(n) for n in names]
        rows = named.groupBy("row_key").agg(*picked, *test)
    else:
        last_key_wins(cells)
        once = named.groupBy("row_key", "_rv_name").agg(F.max_by("value", order).alias("value"), *test)
        again = [] if having is None else [F.max("_rv_hit").alias("_rv_hit")]
        pairs = F.map_from_entries(F.collect_list(F.struct("_rv_name", "value")))
        rows = once.groupBy("row_key").agg(pairs.alias("attributes"), *again)
    if having is not None:
        rows = rows.filter("_rv_hit").drop("_rv_hit")
    if fragments:
        identifier = cells.sparkSession.range(1).select(F.uuid()).first()[0]
        # Numbering reads the rows several times, mostly just their keys.
        groups = numbered(written(rows, "scan"), [], ["row_key"], hot_rows)
        rows = groups.result().withColumns(
            {
                "fragment_identifier": F.lit(identifier),
                "fragment_index": F.col("_rv_index"),
                "fragment_count": F.col("_rv_count"),
            }
        ).drop("_rv_index", "_rv_count")
    rows = rows.withColumnsRenamed({"row_key": row_key_name})
    rows = rows.withColumns({k: F.lit(v) for k, v in (parent or {}).items()})
    return with_route(rows, "success")


def scan_cells_per_record(
    records: DataFrame,
    cells: DataFrame,
    *,
    prefix: str | Column | None = None,
    lower: str | Column | None = None,
    upper: str | Column | None = None,
    cell_filter: Column | None = None,
    row_key_name: str = "row_key",
    name_format: str = "qualifier",
    table_name: str | None = None,
    parts: int = 64,
    hot_rows: int = DEFAULT_HOT_ROWS,
) -> DataFrame:
    """Each record scans the table by its own row keys: those with a prefix, or from ``lower`` up to below ``upper``.

    The three are columns of ``records`` (or templates such as ``${region}-``). A row per record and row key comes out,
    with the record's columns, the row's cells in the map column ``attributes``, and fragments numbered by row key
    within the record. A record that finds nothing gives no row; one without a prefix, or with bounds that cross, goes
    to ``failure`` with the reason, also as ``scan.failure.reason``. A bound that is null is open.

    What a record scans is one run of the row keys in their order. So keys and bounds are put into one order, in which
    a bound's place is the number of keys before it: that gives where a record's run begins and ends, and hence its
    fragments' numbers and count without a sort of its matches. Rows and records then meet by blocks of at most
    SCAN_BLOCK keys (a block is smaller where that gives fewer than ``parts``), and a match is neither stored nor
    shuffled. Records, keys and the places of both are stored.
    """
    if (prefix is None) == (lower is None and upper is None):
        raise ValueError("a scan needs a prefix, or a lower or an upper bound")

    def value(x: str | Column | None) -> Column:
        if x is None:
            return F.lit(None).cast("string")
        if isinstance(x, str):
            return render_template(x, records.columns) if has_references(x) else quoted(x).cast("string")
        return x.cast("string")

    asked = records.withColumns({"_rv_p": value(prefix), "_rv_lo": value(lower), "_rv_hi": value(upper)})
    reason = F.when(F.lit(prefix is not None) & F.col("_rv_p").isNull(), F.lit("the record has no prefix")).when(
        F.col("_rv_lo") > F.col("_rv_hi"), F.lit("the lower bound is above the upper")
    )
    asked = written(asked.withColumns({"_rv_no": F.monotonically_increasing_id(), "_rv_reason": reason}), "records")

    kept = cells if cell_filter is None else cells.filter(cell_filter)
    keys = written(kept.select(F.col("row_key").cast("string")).filter("row_key is not null").distinct(), "keys")
    n_keys = keys.count()
    # No byte of a text is 0xFF, so a prefix and this byte come after every key that begins with the prefix.
    end = F.when(F.col("_rv_p").isNotNull(), F.concat(F.col("_rv_p").cast("binary"), F.lit(bytearray(b"\xff"))))
    sides = F.array(
        F.struct(F.lit(0).alias("side"), F.coalesce("_rv_p", "_rv_lo").cast("binary").alias("at")),
        F.struct(F.lit(1).alias("side"), F.coalesce(end, F.col("_rv_hi").cast("binary")).alias("at")),
    )
    bounds = asked.filter("_rv_reason is null").select("_rv_no", F.inline(sides)).filter("at is not null")
    placed = keys.select(F.col("row_key").cast("binary").alias("at"), F.lit(1).alias("key"), F.lit(-1).cast("long").alias("_rv_no"), F.lit(0).alias("side"))
    placed = placed.unionByName(bounds.withColumn("key", F.lit(0)))
    # a bound stands before the key it equals: the lower one is part of the run, the upper one is not
    groups = OrderedGroups(placed, [], ["at", "key", "_rv_no", "side"], hot_rows).with_running(Running("_rv_rank", "sum", F.col("key").cast("long")))
    placed = written(groups.result(), "places")
    runs = placed.filter("key = 0").groupBy("_rv_no").agg(
        *[F.max(F.when(F.col("side") == i, F.col("_rv_rank"))).alias(c) for i, c in enumerate(("_rv_first", "_rv_end"))]
    )
    ranks = placed.filter("key = 1").select(F.col("at").cast("string").alias("_rv_key"), "_rv_rank")
    block = min(SCAN_BLOCK, -(-n_keys // parts) or 1)

    last_key_wins(cells)
    named = kept.withColumn("_rv_name", cell_name(name_format, table_name))
    once = named.groupBy("row_key", "_rv_name").agg(F.max_by("value", F.struct("family", "qualifier")).alias("value"))
    rows = once.groupBy("row_key").agg(F.map_from_entries(F.collect_list(F.struct("_rv_name", "value"))).alias("attributes"))
    rows = rows.join(ranks, rows["row_key"].cast("string") == ranks["_rv_key"]).drop("_rv_key")
    rows = rows.withColumn("_rv_block", F.floor(F.col("_rv_rank") / block))
    identified = asked.filter("_rv_reason is null").withColumn(
        "fragment_identifier", F.concat_ws("-", F.lit(uuid.uuid4().hex), F.col("_rv_no"))
    )
    identified = identified.join(runs, "_rv_no", "left").withColumns(
        {"_rv_first": F.coalesce("_rv_first", F.lit(0)), "_rv_end": F.coalesce("_rv_end", F.lit(n_keys))}
    )
    reached = F.sequence(F.floor(F.col("_rv_first") / block), F.floor((F.col("_rv_end") - 1) / block))
    asks = identified.filter("_rv_first < _rv_end").withColumn("_rv_block", F.explode(reached))
    inside = (F.col("_rv_rank") >= F.col("_rv_first")) & (F.col("_rv_rank") < F.col("_rv_end"))
    found = asks.join(rows, "_rv_block").filter(inside).withColumns(
        {"fragment_index": F.col("_rv_rank") - F.col("_rv_first") + 1, "fragment_count": F.col("_rv_end") - F.col("_rv_first")}
    ).drop("_rv_block", "_rv_rank", "_rv_first", "_rv_end")
    found = with_route(found, "success").withColumn("scan.failure.reason", F.lit(None).cast("string"))
    bad = asked.filter("_rv_reason is not null")
    failed = failing(bad, F.col("_rv_reason")).withColumn("scan.failure.reason", F.col("_rv_reason"))
    out = found.unionByName(failed, allowMissingColumns=True)
    out = out.drop("_rv_no", "_rv_p", "_rv_lo", "_rv_hi", "_rv_reason")
    return out.withColumnsRenamed({"row_key": row_key_name})


def _named_cells(cells: DataFrame, family: str, qualifier: str) -> DataFrame:
    """One value per row key for one cell name."""
    wanted = cells.filter((F.col("family") == family) & (F.col("qualifier") == qualifier))
    return wanted.groupBy(F.col("row_key").alias("_rv_rk")).agg(F.max("value").alias("_rv_value"))


def kt_get(
    keys: DataFrame, cells: DataFrame, family: str, qualifier: str, key: str = "row_key", into: str = "value"
) -> DataFrame:
    """The value of one cell for each key, null where there is none."""
    found = _named_cells(cells, family, qualifier)
    out = keys.join(found, keys[key].cast("string") == found["_rv_rk"], "left")
    return out.withColumn(into, F.col("_rv_value")).drop("_rv_rk", "_rv_value")


def kt_contains(keys: DataFrame, cells: DataFrame, key: str = "row_key", into: str = "present") -> DataFrame:
    """Whether any cell exists for each key."""
    rows = cells.select(F.col("row_key").alias("_rv_rk")).distinct()
    out = keys.join(rows, keys[key].cast("string") == rows["_rv_rk"], "left")
    return out.withColumn(into, F.col("_rv_rk").isNotNull()).drop("_rv_rk")


def kt_put(cells: DataFrame, new: DataFrame, order_by: Sequence[str] = ()) -> DataFrame:
    """Insert or replace cells; of several new values for one cell the last (by ``order_by``) stays."""
    order = F.struct(*order_by) if order_by else F.struct("value")
    last = new.groupBy(*CELL).agg(F.max_by("value", order).alias("value"))
    return cells.select(*CELL_VALUE).join(last, CELL, "left_anti").unionByName(last.select(*CELL_VALUE))


def kt_put_if_absent(
    cells: DataFrame, new: DataFrame, order_by: Sequence[str] = ("value",), hot_rows: int = DEFAULT_HOT_ROWS
) -> TableChange:
    """Insert cells that do not exist yet; the first request for a cell wins. Results say ``inserted``."""
    return _put_if_absent(cells, new, order_by, hot_rows, with_old=False)


def kt_get_and_put_if_absent(
    cells: DataFrame, new: DataFrame, order_by: Sequence[str] = ("value",), hot_rows: int = DEFAULT_HOT_ROWS
) -> TableChange:
    """As :func:`kt_put_if_absent`; results carry ``old_value``, null where the request inserted."""
    return _put_if_absent(cells, new, order_by, hot_rows, with_old=True)


def _put_if_absent(
    cells: DataFrame, new: DataFrame, order_by: Sequence[str], hot_rows: int, with_old: bool
) -> TableChange:
    first = new.groupBy(*CELL).agg(F.min_by("value", F.struct(*order_by)).alias("_rv_first"))
    old = cells.groupBy(*CELL).agg(F.max("value").alias("_rv_old"), F.lit(True).alias("_rv_there"))
    settled = first.join(old, CELL, "left")
    inserted = settled.filter("_rv_there is null").select(*CELL, F.col("_rv_first").alias("value"))
    groups = numbered(new, CELL, order_by, hot_rows)
    requests = groups.result().drop("_rv_count")
    results = requests.join(settled, CELL, "left").withColumn(
        "inserted", F.col("_rv_there").isNull() & (F.col("_rv_index") == 1)
    )
    if with_old:
        results = results.withColumn(
            "old_value", F.when(~F.col("inserted"), F.coalesce("_rv_old", "_rv_first"))
        )
    results = results.drop("_rv_index", "_rv_first", "_rv_old", "_rv_there")
    return TableChange(cells.select(*CELL_VALUE).unionByName(inserted), results)


def _keyed(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, list[tuple], list[list]]]:
    """Each batch with the group of every row (its first ``width`` columns) and the other columns as lists."""
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        yield batch, list(zip(*columns[:width])), columns[width:]


def _chunk_steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Where each state that a chunk's requests expect ends up after the chunk, from its requests in reverse order."""
    width, group, ends, names = len(CELL) + 1, None, {}, [*CELL, CHUNK, "_rv_from", "_rv_to"]

    def finished() -> pa.RecordBatch:
        rows = [(*group, start, end) for start, end in ends.items()]
        types = [pa.string()] * len(CELL) + [pa.int32(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    for _, groups, (expected, value) in _keyed(batches, width):
        for here, start, end in zip(groups, expected, value):
            if here != group:
                if ends:
                    yield finished()
                group, ends = here, {}
            # what follows the request was folded before: it decides where the new value ends up
            ends[start] = ends.get(end, end)
    if ends:
        yield finished()


def _chunk_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state of a cell at the beginning of each of its chunks; a chunk's first row only names it."""
    cell, state, after = None, None, None
    for batch, groups, (first, start, end, old) in _keyed(batches, len(CELL) + 1):
        found = []
        for here, head, a, b, o in zip(groups, first, start, end, old):
            if head == 0:
                state = o if here[:-1] != cell else after
                cell, after = here[:-1], state
                found.append((*here, state))
            elif a == state:
                after = b
        types = [pa.string()] * len(CELL) + [pa.int32(), pa.string()]
        columns = list(zip(*found)) or [[]] * len(types)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [*CELL, CHUNK, "_rv_entry"])


def _outcomes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches with each request decided, in order, starting from its chunk's first state."""
    group, state = None, None
    for batch, groups, (expected, value, entry, *_) in _keyed(batches, len(CELL) + 1):
        decided = []
        for here, a, b, o in zip(groups, expected, value, entry):
            if here != group:
                group, state = here, o
            put = a == state and None not in here
            state = b if put else state
            decided.append("put" if put else "refused")
        # the row itself travels in the last column
        row = batch.column(batch.num_columns - 1)
        yield pa.RecordBatch.from_arrays([row, pa.array(decided, pa.string())], ["_rv_request", "outcome"])


def kt_check_and_put(
    cells: DataFrame,
    requests: DataFrame,
    order_by: Sequence[str] = ("value",),
    hot_rows: int = DEFAULT_HOT_ROWS,
) -> TableChange:
    """Replace a cell only while it holds ``expected`` (null: only while absent).

    Requests for one cell are decided one after the other, by ``order_by``, then value and expected; each sees what
    those before it left. ``outcome`` is ``put`` or ``refused``; a request that does not name its cell is refused. A chunk of a hot cell is first summed up as where each
    expected state would end up; one pass over those gives the state at each chunk's beginning. Memory: one such
    summary, of at most a chunk's distinct expected values.
    """
    by, order = [*CELL, CHUNK], [*order_by, "value", "expected"]
    old = cells.groupBy(*CELL).agg(F.max("value").alias("_rv_old"))
    asked = requests.withColumn("_rv_request", F.struct(*requests.columns))
    groups = OrderedGroups(asked, CELL, order, hot_rows)
    places = groups.order
    plain = [*[F.col(c).cast("string").alias(c) for c in CELL], CHUNK, F.col("expected").cast("string").alias("expected"),
             F.col("value").cast("string").alias("value")]
    work = groups.df.select(*plain, "_rv_request", *places).join(old, CELL, "left").withColumnRenamed("_rv_old", "_rv_entry")
    if groups.bounds is not None:
        hot = groups.bounds.select(*[F.col(k).cast("string").alias(c) for k, c in zip(groups.keys, CELL)])
        steps = (
            groups.df.select(*plain, *places).join(F.broadcast(hot), CELL, "left_semi")
            .repartition(*by).sortWithinPartitions(*by, *[F.desc(p) for p in places]).select(*by, "expected", "value")
            .mapInArrow(_chunk_steps, "row_key string, family string, qualifier string, _rv_chunk int, _rv_from string, _rv_to string")
        )
        steps = written(steps, "steps")
        # only the old value and what a chunk can leave behind are ever a state at a chunk's beginning
        reached = steps.select(*CELL, F.col("_rv_to").alias("_rv_from")).unionByName(
            steps.select(*CELL).distinct().join(old, CELL, "left").withColumnRenamed("_rv_old", "_rv_from")
        ).distinct().toDF(*[f"{c}_r" for c in CELL], "_rv_r")
        same = [steps[c] == reached[f"{c}_r"] for c in CELL]
        usable = steps.join(reached, [*same, steps["_rv_from"].eqNullSafe(reached["_rv_r"])], "left_semi")
        heads = steps.select(*by).distinct().withColumns({"_rv_from": F.lit(None).cast("string"), "_rv_to": F.lit(None).cast("string")})
        entries = (
            heads.withColumn("_rv_first", F.lit(0)).unionByName(usable.withColumn("_rv_first", F.lit(1)))
            .join(old, CELL, "left").repartition(*CELL).sortWithinPartitions(*by, "_rv_first")
            .select(*by, "_rv_first", "_rv_from", "_rv_to", "_rv_old")
            .mapInArrow(_chunk_entries, "row_key string, family string, qualifier string, _rv_chunk int, _rv_entry string")
        )
        # one row per chunk: fewer than three times the slices of the groups
        entries = entries.select(*by, F.col("_rv_entry").alias("_rv_later"), F.lit(True).alias("_rv_cut"))
        work = work.join(F.broadcast(entries), by, "left").withColumn(
            "_rv_entry", F.when(F.col("_rv_cut"), F.col("_rv_later")).otherwise(F.col("_rv_entry"))
        )
    decided = (
        work.repartition(*by).sortWithinPartitions(*by, *places).select(*by, "expected", "value", "_rv_entry", "_rv_request")
        .mapInArrow(_outcomes, StructType([asked.schema["_rv_request"], StructField("outcome", StringType())]))
    )
    results = decided.select("_rv_request.*", "outcome")
    puts = results.filter("outcome = 'put'")
    return TableChange(kt_put(cells, puts, order), results)


def _matching_rows(cells: DataFrame, having: Column, value: Column) -> DataFrame:
    rows = cells.groupBy("row_key").agg(F.max(having).alias("_rv_hit"), value.alias("value"))
    found = rows.filter("_rv_hit").agg(F.count(F.lit(1)).alias("rows_found"), F.max("value").alias("value"))
    many = F.col("rows_found") > 1
    return with_route(
        found.withColumn("value", F.when(~many, F.col("value"))),
        F.when(many, F.lit("failure")).otherwise(F.lit("success")),
        F.when(many, F.lit("found multiple rows for the filter")),
    )


def kt_get_by_filter(cells: DataFrame, having: Column, family: str, qualifier: str) -> DataFrame:
    """One cell of the one row that has a cell satisfying ``having``; several rows are a failure."""
    wanted = (F.col("family") == family) & (F.col("qualifier") == qualifier)
    return _matching_rows(cells, having, F.max(F.when(wanted, F.col("value"))))


def kt_last_cell_by_filter(cells: DataFrame, having: Column) -> DataFrame:
    """The last cell of the one row that has a cell satisfying ``having``; several rows are a failure."""
    return _matching_rows(cells, having, F.max_by("value", F.struct("family", "qualifier")))


def kt_remove(cells: DataFrame, keys: DataFrame, key: str = "row_key") -> TableChange:
    """Delete rows by key; results say whether each key ``existed``."""
    gone = keys.select(F.col(key).cast("string").alias("row_key")).distinct()
    return TableChange(cells.join(gone, "row_key", "left_anti"), kt_contains(keys, cells, key, "existed"))


def kt_remove_all(cells: DataFrame | KeyedTable) -> DataFrame | None:
    """The table with every row deleted; a durable table is emptied in place, by a new version without data."""
    if isinstance(cells, KeyedTable):
        return cells.clear()
    return cells.filter(F.lit(False))
