"""Removal of repeated passages: every word covered by a 20-word window that also starts earlier.

Each window has an anchor: the least hash among the 12-word runs within it. Windows with the same words have their
anchors at the same place, so a window occurs at most as often as its anchor does, and neighbouring windows mostly share
one, so there are some five times fewer anchors than windows. Pass 1 counts anchors in a count-min sketch: each task has
its own, with counters that stop at two, and the parts are merged block by block. The sketch never counts a window too
low, so windows whose anchor it has once are unique and need no further look; its size costs only false alarms, never
a loss. Pass 2 groups exactly those windows that may repeat. They meet in buckets by anchor, so runs of windows travel
together; a batch sends each distinct window once, so a passage that a third of all documents share is no hot group.
A window is identified within its bucket by 80 bits of two independent hashes.

Documents are ordered by id (null first), then by the hash of the text; rows that agree in both count as one document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import (
    BLOCK, MOST_CELLS, ROWS, WordHashes, has_bits, in_arrow, mixed, rolled, sketch_cells, sketched, slices, words_of,
)

#: The least id stands for null.
NULL_ID = -(1 << 63)
#: Characters of text for each bucket of the exact pass.
BUCKET_CHARS = 4_000_000


class _Windows:
    """Words of a batch of texts as hashes, and all windows that lie within one text, with their anchors."""

    def __init__(self, texts: list[bytes | None], hashes: WordHashes, window: int):
        lists = [words_of(t) for t in texts]
        self.sizes = np.array([len(x) for x in lists], np.int64)
        self.hashes = hashes.of([w for x in lists for w in x])
        self.keys = rolled(self.hashes, window)
        ends = np.cumsum(self.sizes)
        row = np.repeat(np.arange(len(lists)), self.sizes)[: len(self.keys)]
        position = np.arange(len(self.keys)) - (ends - self.sizes)[row]
        self.inside = np.flatnonzero(position + window <= self.sizes[row])
        self.keys, self.row, self.position = self.keys[self.inside], row[self.inside], position[self.inside]
        width = window * 3 // 5
        self.runs = rolled(self.hashes, width)
        self.anchors_at = self.inside
        if len(self.inside):
            within = np.lib.stride_tricks.sliding_window_view(self.runs, window - width + 1)[self.inside]
            self.anchors_at = self.inside + within.argmin(1)


def window_sketch(docs: DataFrame, window: int, power: int) -> bytes:
    """The merged sketch's cells that count two or more, as bits, row after row: ROWS * 2**power / 8 bytes."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        hashes = WordHashes()
        for batch in slices(batches, "text"):
            w = _Windows(batch.column("text").to_pylist(), hashes, window)
            yield w.runs[np.unique(w.anchors_at)]

    return sketched(docs, keys, power)


def _text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def repeated_ranges(docs: DataFrame, window: int = 20) -> DataFrame:
    """``doc_id, text_key, ranges``: for documents with repeated windows, their word ranges as (start, end) int32.

    ``docs`` has ``doc_id`` and ``text``. The ranges of a row are those of one bucket; a document may have many rows.
    """
    spark = docs.sparkSession
    chars = docs.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    power = int(min(max(np.ceil(np.log2(max(chars, 1) / 8)), BLOCK), MOST_CELLS))
    buckets = chars // BUCKET_CHARS + 1
    sketch = spark.sparkContext.broadcast(window_sketch(docs, window, power))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        hashes = WordHashes()
        bits = np.frombuffer(sketch.value, np.uint8).reshape(ROWS, -1)
        for batch in slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            ids = np.array([NULL_ID if x is None else x for x in batch.column("doc_id").to_pylist()], np.int64)
            keys = np.array([xxhash.xxh64_intdigest(t or b"", 42) for t in texts], np.uint64).view(np.int64)
            w = _Windows(texts, hashes, window)
            anchors = w.runs[w.anchors_at]
            maybe = np.ones(len(anchors), bool)
            for r in range(ROWS):
                maybe[maybe] = has_bits(bits[r], sketch_cells(anchors[maybe], r, power))
            if not maybe.any():
                continue
            # the documents in their order, and what identifies a window
            place = np.empty(len(ids), np.int64)
            place[np.lexsort((keys, ids))] = np.arange(len(ids))
            second = rolled(mixed(w.hashes ^ np.uint64(0x8EBC6AF09C88C6E3)), window)[w.inside][maybe]
            bucket = (mixed(anchors[maybe]) % np.uint64(buckets)).astype(np.int64)
            first, row, position = w.keys[maybe], w.row[maybe], w.position[maybe]
            order = np.lexsort((position, place[row], second, first, bucket))
            bucket, first, second, row, position = (x[order] for x in (bucket, first, second, row, position))
            new = np.append(True, (first[1:] != first[:-1]) | (second[1:] != second[:-1]))
            # a row of the same document and place as the first of its window is that first one, met a second time
            head = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
            same = ~new & (ids[row] == ids[row[head]]) & (keys[row] == keys[row[head]]) & (position == position[head])
            back = np.lexsort((position, row, bucket))
            bucket, first, second, row, position, new = (x[back] for x in (bucket, first, second, row, position, new))
            same = same[back]
            cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            out: dict[str, list] = {k: [] for k in ("bucket", "first", "second", "doc_id", "text_key", "places", "more")}
            for a, b in zip(cuts, np.append(cuts[1:], len(bucket))):
                fresh, more = np.flatnonzero(new[a:b]) + a, np.flatnonzero(~new[a:b] & ~same[a:b]) + a
                used, local = np.unique(row[a:b], return_inverse=True)
                out["bucket"].append(bucket[a])
                out["first"].append(first[fresh].tobytes())
                out["second"].append((second[fresh] >> np.uint64(48)).astype(np.uint16).tobytes())
                out["doc_id"].append(ids[used].tobytes())
                out["text_key"].append(keys[used].tobytes())
                for name, chosen in (("places", fresh), ("more", more)):
                    out[name].append(_packed(local[chosen - a], position[chosen]))
            yield out

    rows = in_arrow(
        docs, send,
        "bucket long, first binary, second binary, doc_id binary, text_key binary, places binary, more binary",
    )

    def decide(table: pd.DataFrame) -> pd.DataFrame:
        joined = {n: np.frombuffer(b"".join(table[n]), t) for n, t in (("first", np.uint64), ("second", np.uint16), ("doc_id", np.int64), ("text_key", np.int64))}
        offset, places = 0, {"places": [], "more": []}
        for i, ids in enumerate(table["doc_id"]):
            for name, parts in places.items():
                row, at = _unpacked(table[name].iloc[i])
                parts.append((row + offset, at))
            offset += len(ids) // 8
        (row, at), (more_row, more_at) = (map(np.concatenate, zip(*parts)) for parts in places.values())
        doc, key = joined["doc_id"][row], joined["text_key"][row]
        order = np.lexsort((at, key, doc, joined["second"], joined["first"]))
        first, second, d, k, p = (x[order] for x in (joined["first"], joined["second"], doc, key, at))
        again = np.append(False, (first[1:] == first[:-1]) & (second[1:] == second[:-1]))
        # a row of the same document and place as the first of its window is that first one, met a second time
        starts = np.maximum.accumulate(np.where(again, 0, np.arange(len(again))))
        again &= (d != d[starts]) | (k != k[starts]) | (p != p[starts])
        doc = np.concatenate((d[again], joined["doc_id"][more_row]))
        key = np.concatenate((k[again], joined["text_key"][more_row]))
        at = np.concatenate((p[again], more_at))
        order = np.lexsort((at, key, doc))
        doc, key, at = doc[order], key[order], at[order]
        if not len(doc):
            return pd.DataFrame({"doc_id": [], "text_key": [], "ranges": []})
        other = np.append(True, (doc[1:] != doc[:-1]) | (key[1:] != key[:-1]))
        starts = np.flatnonzero(other | np.append(True, at[1:] > at[:-1] + window))
        stops = np.append(starts[1:], len(at)) - 1
        ranges = np.stack((at[starts], at[stops] + window), 1).astype(np.int32)
        docs_at = np.flatnonzero(other[starts])
        cut = np.append(docs_at, len(starts))
        return pd.DataFrame({
            "doc_id": doc[starts][docs_at], "text_key": key[starts][docs_at],
            "ranges": [ranges[a:b].tobytes() for a, b in zip(cut, cut[1:])],
        })

    return rows.groupBy("bucket").applyInPandas(decide, "doc_id long, text_key long, ranges binary")


def _packed(row: np.ndarray, at: np.ndarray) -> bytes:
    """Places in order as runs of neighbours: row, first place, length."""
    if not len(row):
        return b""
    starts = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1)))
    sizes = np.diff(np.append(starts, len(row)))
    return np.stack((row[starts], at[starts], sizes), 1).astype(np.int32).tobytes()


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    row, at, size = np.frombuffer(data, np.int32).reshape(-1, 3).T.astype(np.int64)
    return np.repeat(row, size), np.repeat(at - np.cumsum(size) + size, size) + np.arange(size.sum())


def remove_repeated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 20) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text`` for every row: its words without those in repeated windows.

    ``kept_text`` has the kept words joined by single spaces. Windows are judged on the input. Null and empty texts have
    no words; texts shorter than a window keep all; rows with the same id and text count as one document and get the
    same result; a null id sorts first and stays null. Other columns are ignored, an empty table gives an empty result.
    The sketch is built when this is called.
    """
    if window < 6:
        raise ValueError("a window has at least six words")
    docs = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
    found = repeated_ranges(docs, window).groupBy("doc_id", "text_key").agg(F.collect_list("ranges").alias("ranges"))
    keyed = docs.withColumns({"_id": F.coalesce("doc_id", F.lit(NULL_ID)), "_key": _text_key(F.col("text"))})
    joined = keyed.join(
        found.withColumnsRenamed({"doc_id": "_id", "text_key": "_key"}), ["_id", "_key"], "left"
    ).select("doc_id", "text", "ranges")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in slices(batches, "text"):
            n_words, n_removed, kept = [], [], []
            for value, ranges in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist()):
                words = words_of(value)
                gone = np.zeros(len(words) + 1, np.int64)
                for part in ranges or ():
                    spans = np.frombuffer(part, np.int32).reshape(-1, 2)
                    np.add.at(gone, spans[:, 0], 1)
                    np.add.at(gone, spans[:, 1], -1)
                if ranges:
                    stay = np.cumsum(gone)[:-1] == 0
                    left = [words[i] for i in np.flatnonzero(stay)]
                else:
                    left = words
                n_words.append(len(words))
                n_removed.append(len(words) - len(left))
                kept.append(b" ".join(left).decode())
            yield {"doc_id": batch.column("doc_id"), "n_words": n_words, "n_removed": n_removed, "kept_text": kept}

    return in_arrow(joined, cut, "doc_id long, n_words long, n_removed long, kept_text string")

