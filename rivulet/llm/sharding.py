"""Sharding by histogram sort: shards of near-equal bytes that are ranges of one order.

Rows are ordered by key, then by a hash of the row, then by a number given when the rows are stored, so that no two are
equal and a boundary may fall within many equal keys. The splitters between shards are sought all at once: in each round
every open splitter gets PROBES evenly spaced candidates between the nearest boundaries known below and above it, all
tasks count the exact bytes and rows below each candidate, and the intervals close in. A splitter is fixed when the
bytes below it are within the tolerance of its share, or when one row lies between its bounds. The order is searched one
component after the other, each over the rows that tie in those before. Then one exchange deals the rows out.

What reaches the driver is a table of candidates and their counts: shards * PROBES rows at most, whatever the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .common import in_arrow

PROBES = 15
LEAST, MOST = -(1 << 63), (1 << 63) - 1
#: Rows of the pieces in which slots are numbered, about.
PIECE_ROWS = 250_000


def _below(rows: DataFrame, probes: dict[tuple, list[int]]) -> dict:
    """By tie (values of the first components): its sorted probes of the next component, bytes and rows below each."""
    wanted = {tie: np.array(sorted(set(p)), np.int64) for tie, p in probes.items()}
    tied = len(next(iter(wanted)))
    names = ["key", "hash", "number"][: tied + 1]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        sums = {tie: np.zeros((2, len(p) + 1), np.int64) for tie, p in wanted.items()}
        for batch in batches:
            values = [np.asarray(batch.column(n)) for n in names]
            size = np.asarray(batch.column("size"))
            for tie, p in wanted.items():
                mine = np.ones(len(size), bool)
                for i, value in enumerate(tie):
                    mine &= values[i] == value
                at = np.searchsorted(p, values[tied][mine], side="right")
                sums[tie][0] += np.bincount(at, size[mine], len(p) + 1).astype(np.int64)
                sums[tie][1] += np.bincount(at, minlength=len(p) + 1)
        for k, tie in enumerate(wanted):
            n = len(sums[tie][0])
            yield {"tie": [k] * n, "place": list(range(n)), "bytes": sums[tie][0], "n": sums[tie][1]}

    parts = in_arrow(rows.select(*names, "size"), count, "tie int, place int, bytes long, n long")
    out: dict[tuple, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
    got = parts.groupBy("tie", "place").agg(F.sum("bytes"), F.sum("n")).collect()
    for k, (tie, p) in enumerate(wanted.items()):
        table = np.zeros((2, len(p) + 1), np.int64)
        for t, place, b, n in got:
            if t == k:
                table[:, place] = b, n
        out[tie] = (p, *np.cumsum(table, 1)[:, :-1])
    return out


def find_splitters(rows: DataFrame, shares: list[float], tolerance: float) -> list[tuple[int, int, int]]:
    """A boundary (key, hash, number) for each share of the bytes: rows below it make up that share, within tolerance.

    ``rows`` has key, hash, number, size. A boundary belongs to the part above it.
    """
    totals = rows.agg(
        F.coalesce(F.sum("size"), F.lit(0)), *[f(c) for c in ("key", "hash", "number") for f in (F.min, F.max)]
    ).first()
    total = totals[0]
    if totals[1] is None:
        return [(LEAST, LEAST, LEAST)] * len(shares)

    def opened(tie: tuple, base: int) -> dict:
        """The next component's bounds [low, high), with the bytes below what ties so far."""
        low, high = totals[1 + 2 * len(tie)], totals[2 + 2 * len(tie)] + 1
        known = {"low_bytes": base, "low_rows": 0, "high_bytes": None, "high_rows": None}
        return {"tie": tie, "base": base, "low": low, "high": high} | known

    open_ = [{"want": s * total} | opened((), 0) for s in shares]
    found: list = [None] * len(shares)
    while any(f is None for f in found):
        depth = min(len(o["tie"]) for o, f in zip(open_, found) if f is None)
        probes: dict[tuple, list[int]] = {}
        for o, f in zip(open_, found):
            if f is None and len(o["tie"]) == depth:
                span = o["high"] - o["low"]
                probes.setdefault(o["tie"], []).extend(
                    {o["low"] + span * (i + 1) // (PROBES + 1) for i in range(PROBES)} | {o["low"] + 1, o["low"]} - {MOST + 1}
                )
        counted = _below(rows, probes)
        for i, (o, f) in enumerate(zip(open_, found)):
            if f is not None or len(o["tie"]) != depth:
                continue
            at, below, rows_below = counted[o["tie"]]
            inside = (at >= o["low"]) & (at <= min(o["high"], MOST))
            at, below, rows_below = at[inside], below[inside] + o["base"], rows_below[inside]
            near = np.abs(below - o["want"])
            best = int(near.argmin())
            under, over = np.flatnonzero(below <= o["want"]), np.flatnonzero(below > o["want"])
            if len(under):
                o["low"], o["low_bytes"], o["low_rows"] = (int(x[under[-1]]) for x in (at, below, rows_below))
            if len(over):
                o["high"], o["high_bytes"], o["high_rows"] = (int(x[over[0]]) for x in (at, below, rows_below))
            rest = [LEAST] * (2 - depth)
            if near[best] <= tolerance * total / (len(shares) + 1):
                found[i] = (*o["tie"], int(at[best]), *rest)
            elif o["high_rows"] is not None and o["high_rows"] - (o["low_rows"] or 0) <= 1:  # one row is between
                nearer = o["want"] - o["low_bytes"] <= o["high_bytes"] - o["want"]
                found[i] = (*o["tie"], o["low"] if nearer else o["high"], *rest)
            elif o["high"] - o["low"] <= 1:  # all that is left ties in this component
                if depth == 2:
                    found[i] = (*o["tie"], o["low"])
                else:
                    o |= opened((*o["tie"], o["low"]), o["low_bytes"])
    return found


def histogram_shards(
    rows: DataFrame, key: str, size: str, shards: int = 24, tolerance: float = 0.002,
) -> DataFrame:
    """All rows and columns with ``shard`` (0 to shards - 1, near-equal sums of ``size``) and ``slot`` (gapless from 0).

    Shards are consecutive ranges of ``key`` (a whole number; nulls first), ties ordered by a hash of the row. The bytes
    up to the end of each shard are within ``tolerance`` of an even shard of their share, or within one row of it.
    Null sizes count as zero. Repeated rows are told apart by a stored number, so even one repeated row fills several
    shards; an empty table gives an empty result; columns called shard or slot are replaced. Stores the rows and finds
    the splitters when called.
    """
    names = [c for c in rows.columns if c not in ("shard", "slot")]
    stored = written(
        rows.select(
            F.struct(*names).alias("row"), F.coalesce(rows[key].cast("long"), F.lit(LEAST)).alias("key"),
            F.xxhash64(*names).alias("hash"), F.coalesce(rows[size].cast("long"), F.lit(0)).alias("size"),
        ).withColumn("number", F.monotonically_increasing_id()),
        "to_shard",
    )
    splitters = find_splitters(stored, [(i + 1) / shards for i in range(shards - 1)], tolerance)
    # finer cuts, so that numbering within a shard is spread over several tasks too; they need not be exact
    pieces = max(1, -(-stored.count() // (shards * PIECE_ROWS)))
    cuts = splitters if pieces == 1 else find_splitters(
        stored, [(i + 1) / (shards * pieces) for i in range(shards * pieces - 1)], 0.5
    )
    bounds = sorted({*splitters, *cuts})
    boundary = F.array(*[F.struct(*[F.lit(v).cast("long") for v in b]) for b in bounds]) if bounds else None
    own = F.struct("key", "hash", "number")
    piece = F.lit(0) if boundary is None else F.size(F.filter(boundary, lambda b: own >= b))
    dealt = stored.withColumn("piece", piece)
    counts = {r["piece"]: r["n"] for r in dealt.groupBy("piece").agg(F.count("*").alias("n")).collect()}
    shard_of, offset, filled = {}, {}, [0] * shards
    for p in range(len(bounds) + 1):
        s = sum(b <= bounds[p - 1] for b in splitters) if p else 0
        shard_of[p], offset[p] = s, filled[s]
        filled[s] += counts.get(p, 0)
    places = rows.sparkSession.createDataFrame(
        [(p, shard_of[p], offset[p]) for p in shard_of], "piece int, shard int, offset long"
    )
    order = Window.partitionBy("piece").orderBy("key", "hash", "number")
    numbered = dealt.withColumn("rank", F.row_number().over(order) - 1)
    return numbered.join(F.broadcast(places), "piece").select(
        *[F.col("row")[c].alias(c) for c in names], "shard", (F.col("offset") + F.col("rank")).alias("slot")
    )
