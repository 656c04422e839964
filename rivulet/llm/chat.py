"""Conversations as a prefix tree: turns that several share from the start are written once, depth first.

A turn is written ``### role: text</turn>`` and a line break. Backslashes, and ``:`` in roles or ``<`` in texts, are
escaped by a backslash, so the only unescaped ``: `` and ``</turn>`` are the template's own and texts can be read back.

A node is a sequence of turns from the start of a conversation; it is known by a hash chain over them. Distinct
conversations are sorted by their turns, which is the depth-first order of the tree: the first conversation that holds a
node brings it in, and the stream lists nodes by that conversation, then by depth. Each node has its place in the stream
(code points), the position id of its first character (the length of what leads to it), and the intervals of the stream
its characters may attend to besides themselves: its ancestors, where neighbouring ones are joined.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .common import in_arrow

#: Fixed parts of the template.
HEAD, MIDDLE, TAIL = "### ", ": ", "</turn>\n"
TURN = re.compile(r"### ((?:[^\\:]|\\.)*): ((?:[^\\<]|\\.)*)</turn>\n", re.S)


def _escaped(text: Column, special: str) -> Column:
    return F.regexp_replace(text, rf"([\\{special}])", r"\\$1")


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def prefix_tree(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """The tree's ``nodes`` and the ``members`` that lead from conversations to them.

    nodes: ``node, depth, role, piece, start, end, position, loss_start, loss_end, attends`` (loss_* is the stretch of
    the stream under the loss mask: the text of assistant turns; null elsewhere). members: ``conv_id, depth, node``.

    Turns go by ``turn`` (null first), then role, then a hash of the text. Null roles and texts are empty, a null
    conversation id is a conversation of its own, repeated rows are repeated turns, other columns are ignored, an empty
    table gives empty tables. A conversation's turns meet in one task as hashes, without their texts. Stores its steps
    when called.
    """
    given = turns.select(
        turns[conv_id].cast("long").alias("conv_id"), turns[turn].cast("long").alias("turn"),
        F.coalesce(turns[role].cast("string"), F.lit("")).alias("role"),
        F.coalesce(turns[text].cast("string"), F.lit("")).alias("text"),
    ).withColumn("row", F.monotonically_increasing_id())
    given = written(given, "turns")
    keyed = given.select(
        "conv_id", "turn", "role", "row", F.xxhash64("role", "text").alias("k1"),
        F.xxhash64(F.lit(7), "text", "role").alias("k2"),
    )
    paths = keyed.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "k1", "k2", "row"))).alias("turns")
    )

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            keys, chains, rows = [], [], []
            for turns_ in batch.column("turns").to_pylist():
                own = [t["k1"].to_bytes(8, "big", signed=True) + t["k2"].to_bytes(8, "big", signed=True) for t in turns_]
                state, nodes = b"", []
                for k in own:
                    state = hashlib.blake2b(state + k, digest_size=16).digest()
                    nodes.append(state)
                keys.append(b"".join(own))
                chains.append(nodes)
                rows.append([t["row"] for t in turns_])
            yield {"conv_id": batch.column("conv_id"), "path": keys, "nodes": chains, "rows": rows}

    chained = written(in_arrow(paths, chain, "conv_id long, path binary, nodes array<binary>, rows array<long>"), "paths")
    # sorted by range, so the number given to a row in its partition keeps the order of all
    ranked = chained.groupBy("path").agg(F.min(F.struct("nodes", "rows")).alias("p")).orderBy("path").select(
        F.monotonically_increasing_id().alias("rank"), "p.nodes", "p.rows"
    )
    ranked = written(ranked, "ranked")
    steps = ranked.select("rank", F.posexplode(F.arrays_zip("nodes", "rows")).alias("depth", "x")).select(
        "rank", "depth", F.col("x.nodes").alias("node"), F.col("x.rows").alias("row")
    )
    owned = steps.groupBy("node").agg(F.min(F.struct("rank", "depth", "row")).alias("o")).select("node", "o.*")
    piece = F.concat(
        F.lit(HEAD), _escaped(F.col("role"), ":"), F.lit(MIDDLE), _escaped(F.col("text"), "<"), F.lit(TAIL)
    )
    pieces = owned.join(given.select("row", "role", "text"), "row").select(
        "node", "rank", "depth", "role", piece.alias("piece"),
        F.char_length(_escaped(F.col("role"), ":")).alias("role_chars"),
    ).withColumn("chars", F.char_length("piece").cast("long"))
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stream = written(
        pieces.repartitionByRange(parts, "rank", "depth").withColumn("part", F.spark_partition_id()), "stream"
    )
    # a running sum in every part, on top of what the parts before amount to (a row for each part)
    sums = sorted(stream.groupBy("part").agg(F.sum("chars")).collect())
    before, total = [], 0
    for part, chars in sums:
        before.append((part, total))
        total += chars
    offsets = turns.sparkSession.createDataFrame(before, "part int, before long")
    along = Window.partitionBy("part").orderBy("rank", "depth")
    placed = stream.join(F.broadcast(offsets), "part").withColumn(
        "end", F.col("before") + F.sum("chars").over(along)
    ).select("node", "rank", "depth", "role", "piece", "role_chars", (F.col("end") - F.col("chars")).alias("start"), "end")
    placed = written(placed, "placed")

    spans = steps.select("rank", "depth", "node").join(
        placed.select("node", F.col("rank").alias("owner"), "start", "end"), "node"
    ).groupBy("rank").agg(F.array_sort(F.collect_list(F.struct("depth", "node", "owner", "start", "end"))).alias("steps"))

    def attend(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            nodes, positions, attends = [], [], []
            for rank, path in zip(batch.column("rank").to_pylist(), batch.column("steps").to_pylist()):
                seen: list[tuple[int, int]] = []
                position = 0
                for s in path:
                    if s["owner"] == rank:
                        nodes.append(s["node"])
                        positions.append(position)
                        attends.append([{"start": a, "end": b} for a, b in seen])
                    if seen and seen[-1][1] == s["start"]:
                        seen[-1] = (seen[-1][0], s["end"])
                    else:
                        seen.append((s["start"], s["end"]))
                    position += s["end"] - s["start"]
            yield {"node": nodes, "position": positions, "attends": attends}

    attending = in_arrow(spans, attend, "node binary, position long, attends array<struct<start: long, end: long>>")
    assistant = F.col("role") == "assistant"
    text_start = F.col("start") + len(HEAD) + F.col("role_chars") + len(MIDDLE)
    nodes = placed.join(attending, "node").select(
        "node", "depth", "role", "piece", "start", "end", "position",
        F.when(assistant, text_start).alias("loss_start"),
        F.when(assistant, F.col("end") - len(TAIL)).alias("loss_end"), "attends",
    )
    members = chained.select("conv_id", F.posexplode("nodes").alias("depth", "node"))
    return nodes, members


def read_back(nodes: DataFrame, members: DataFrame) -> DataFrame:
    """``conv_id, turns (role, text), loss_text, formatted_chars`` of every conversation, from the tree alone.

    The pieces of its path, put together in order, are parsed by the template; the loss mask picks the loss text.
    """
    path = members.join(nodes.select("node", "piece", "start", "loss_start", "loss_end"), "node")
    paths = path.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("depth", "piece", "start", "loss_start", "loss_end"))).alias("pieces")
    )

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            turns, losses, sizes = [], [], []
            for pieces in batch.column("pieces").to_pylist():
                whole = "".join(p["piece"] for p in pieces)
                found = list(TURN.finditer(whole))
                if sum(m.end() - m.start() for m in found) != len(whole):
                    raise ValueError("a conversation does not follow the template")
                turns.append([{"role": unescaped(m[1]), "text": unescaped(m[2])} for m in found])
                losses.append("".join(
                    unescaped(p["piece"][p["loss_start"] - p["start"] : p["loss_end"] - p["start"]])
                    for p in pieces if p["loss_start"] is not None
                ))
                sizes.append(len(whole))
            yield {"conv_id": batch.column("conv_id"), "turns": turns, "loss_text": losses, "formatted_chars": sizes}

    return in_arrow(
        paths, parse,
        "conv_id long, turns array<struct<role: string, text: string>>, loss_text string, formatted_chars long",
    )
