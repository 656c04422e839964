"""What several of the training-data operators share: words, per-batch passes and 64-bit hashes."""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import discard, written

#: The separators of words: space and the five ASCII controls from tab to carriage return.
NOT_SPACE = r"[^\x20\x09-\x0D]+"
#: Batches are cut to about this many bytes of text before arrays are built over their words.
SLICE_BYTES = 4 << 20
#: Word-to-hash tables of a worker are emptied at this many entries.
TABLE_WORDS = 400_000
#: Rows of a sketch, the most cells of a row (as a power of two: 16 MiB for each row) and cells of a block.
ROWS, MOST_CELLS, BLOCK = 2, 27, 20
#: Bits of a map of keys (2**27 bits, 16 MiB), in blocks as bitmap_construct_agg makes them.
MAP_BITS, MAP_BLOCK = 1 << 27, 1 << 15


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a text in UTF-8. ``bytes.split`` cuts at exactly the ASCII white space of NOT_SPACE; null has none."""
    return text.split() if text else []


def slices(batches: Iterable[pa.RecordBatch], text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches with ``text`` in binary form, cut so that a slice holds ``most`` bytes of text or one row."""
    for batch in batches:
        at = batch.schema.get_field_index(text)
        batch = batch.set_column(at, text, batch.column(at).cast(pa.large_binary()))
        sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(at)), 0))
        part = np.cumsum(sizes) // most
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


class WordHashes(dict):
    """64-bit hashes of words, each computed once while the table lasts."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word, 42)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > TABLE_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


class Recent:
    """A bounded table of results by text, in two generations: what was not asked for lately is forgotten."""

    def __init__(self, most: int, longest: int = 64):
        self.most, self.longest = most, longest
        self.new: dict = {}
        self.old: dict = {}

    def with_all(self, keys: list[str], compute: Callable) -> dict:
        """A table that holds all ``keys``; ``compute`` gives the results of those that are not known."""
        if len(self.new) > self.most:
            self.new, self.old = {}, self.new
        missing = set(keys).difference(self.new)
        if missing:
            old = self.old
            self.new.update((k, old[k]) for k in missing if k in old)
            missing = [k for k in missing if k not in old]
            found = dict(zip(missing, compute(missing)))
            self.new.update((k, v) for k, v in found.items() if len(k) <= self.longest)
            long = {k: v for k, v in found.items() if len(k) > self.longest}
            if long:
                return {k: long[k] if k in long else self.new[k] for k in set(keys)}
        return self.new


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply), so that sums of hashes become well spread."""
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0x9E3779B97F4A7C15)
    return values ^ (values >> np.uint64(29))


def rolled(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of ``width`` consecutive values, by doubling; empty if there are fewer."""
    if len(hashes) < width:
        return np.zeros(0, np.uint64)
    out, covered, offset = None, 0, 0
    power, size = mixed(hashes), 1
    while covered < width:
        if width & size:
            piece = power[offset : offset + len(hashes) - width + 1]
            out = piece if out is None else mixed(out * np.uint64(0xD6E8FEB86659FD93) + piece)
            covered, offset = covered + size, offset + size
        power = mixed(power[:-size] * np.uint64(0xC2B2AE3D27D4EB4F) + power[size:]) if len(power) > size else power
        size *= 2
    return out


def packed(columns: list[np.ndarray], types: list) -> bytes:
    """Columns byte by byte (first bytes of all values, second bytes, ...), which compresses well."""
    planes = [c.astype(t).view(np.uint8).reshape(len(c), -1).T.tobytes() for c, t in zip(columns, types)]
    return zstandard.compress(b"".join(planes), 1)


def unpacked(data: bytes, types: list) -> list[np.ndarray]:
    """The columns of :func:`packed`."""
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    n = len(raw) // sum(np.dtype(t).itemsize for t in types)
    out, at = [], 0
    for t in types:
        width = np.dtype(t).itemsize
        out.append(np.ascontiguousarray(raw[at : at + n * width].reshape(width, n).T).view(t).ravel())
        at += n * width
    return out


def in_arrow(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` over the columns ``df`` has; ``function`` yields dicts of columns in the schema's order."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    target = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in function(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[f.name], f.type, from_pandas=False) for f in target], schema=target
            )

    return df.mapInArrow(run, schema)


def sketch_cells(keys: np.ndarray, row: int, power: int) -> np.ndarray:
    """The cell of each key in a row of a sketch of ``2**power`` cells a row."""
    keys = keys if row == 0 else mixed(keys ^ np.uint64(0xA0761D6478BD642F))
    return (keys >> np.uint64(64 - power)).astype(np.int64)


def set_bits(bits: np.ndarray, cells: np.ndarray) -> None:
    """Set the bits of sorted distinct cells."""
    if len(cells):
        at = cells >> 3
        starts = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        bits[at[starts]] |= np.bitwise_or.reduceat((1 << (cells & 7)).astype(np.uint8), starts)


def has_bits(bits: np.ndarray, cells: np.ndarray) -> np.ndarray:
    return (bits[cells >> 3] >> (cells & 7).astype(np.uint8)) & 1 > 0


def sketched(df: DataFrame, keys_of: Callable, power: int) -> bytes:
    """The cells that count two or more, as bits, row after row: ROWS * 2**power / 8 bytes.

    ``keys_of`` gives arrays of keys for a task's batches. Each task has a count-min sketch of its own, with counters that
    stop at two, and the parts are merged block by block. No key is counted too low.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        once = np.zeros((ROWS, 1 << power - 3), np.uint8)
        twice = np.zeros_like(once)
        any_rows = False
        for keys in keys_of(batches):
            any_rows = any_rows or len(keys) > 0
            for r in range(ROWS):
                cells, n = np.unique(sketch_cells(keys, r, power), return_counts=True)
                set_bits(twice[r], cells[(n > 1) | has_bits(once[r], cells)])
                set_bits(once[r], cells)
        if any_rows:
            for r in range(ROWS):
                for at in range(0, 1 << power - 3, 1 << BLOCK - 3):
                    part, more = once[r, at : at + (1 << BLOCK - 3)], twice[r, at : at + (1 << BLOCK - 3)]
                    if part.any():
                        yield {
                            "block": [r << power - 3 | at], "once": [zlib.compress(part.tobytes(), 1)],
                            "twice": [zlib.compress(more.tobytes(), 1)],
                        }

    parts = in_arrow(df, run, "block long, once binary, twice binary")

    def merged(table: pd.DataFrame) -> pd.DataFrame:
        once = twice = None
        for a, b in zip(table["once"], table["twice"]):
            a, b = (np.frombuffer(zlib.decompress(x), np.uint8) for x in (a, b))
            once, twice = (a, b) if once is None else (once | a, twice | b | (once & a))
        return pd.DataFrame({"block": table["block"][:1], "bits": [zlib.compress(twice.tobytes(), 1)]})

    out = np.zeros(ROWS << power - 3, np.uint8)
    blocks = written(parts.groupBy("block").applyInPandas(merged, "block long, bits binary"), "sketch")
    for block, bits in blocks.collect():
        bits = np.frombuffer(zlib.decompress(bits), np.uint8)
        out[block : block + len(bits)] = bits
    discard(blocks)
    return out.tobytes()


def key_map(keys: DataFrame) -> bytes:
    """MAP_BITS bits of which those of the keys (column key) are set; of bounded size, so others may be set as well."""
    cell = F.pmod("key", F.lit(MAP_BITS))
    blocks = keys.groupBy((cell / MAP_BLOCK).cast("int").alias("block")).agg(F.bitmap_construct_agg((cell % MAP_BLOCK)).alias("bits"))
    bits, blocks = np.zeros(MAP_BITS >> 3, np.uint8), written(blocks, "key_map")
    for block, part in blocks.toLocalIterator():
        bits[block * (MAP_BLOCK >> 3) : (block + 1) * (MAP_BLOCK >> 3)] = np.frombuffer(part, np.uint8)
    discard(blocks)
    return bits.tobytes()


def sent_bits(spark: SparkSession, bits: bytes):
    """A broadcast of a map or sketch, compressed, since every machine keeps it as a file; see :func:`bits_of`."""
    return spark.sparkContext.broadcast(zstandard.compress(bits, 1))


def bits_of(sent) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(sent.value), np.uint8)


def in_map(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key's bit is set in :func:`key_map`."""
    return has_bits(bits, keys.view(np.int64) % MAP_BITS)


def lowered(column):
    """A-Z made lower case, and nothing else."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
