"""Benchmark passages in documents: SimHashes of item-sized windows, multi-index Hamming search, exact similarity.

For each item size that matters in a document, the windows of that many words are fingerprinted (words in lower case,
each occurrence one vote) and looked up in an index of the items' fingerprints: the 64 bits are cut into BLOCKS parts,
and since whatever is within ``radius`` differs by at most radius // BLOCKS bits in one of them, each part's table holds
all values that near to an item's. So every item within the radius is found; candidates count if the weighted Jaccard
similarity of their five-word shingles (repeats counted) reaches the threshold. A window without any shingle of an item
has similarity zero to all, so only windows that hold one are fingerprinted. The radius does not hold all windows of the
threshold's similarity, so every window that holds enough of an item's shingles to reach the threshold is a candidate too,
whatever its fingerprint; nothing is missed.

One changed word moves four fingerprint bits of a 50-word item on average, and seven or eight of a 15-word item; the
radius of 15 is twice that. Items are taken in blocks of BLOCK_WORDS words, each broadcast and searched against all rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import WordHashes, in_arrow, mixed, rolled, slices, words_of

BLOCKS, BLOCK_BITS = 4, 16
#: Words of items in one broadcast block, and windows fingerprinted at once.
BLOCK_WORDS, AT_ONCE = 1 << 18, 1 << 15


def window_fingerprints(hashes: np.ndarray, size: int) -> np.ndarray:
    """SimHashes of all windows of ``size`` words; one of the whole if there are fewer."""
    size = min(size, len(hashes))
    octets = mixed(hashes).astype("<u8").view(np.uint8).reshape(-1, 8)
    votes = np.zeros((len(hashes) + 1, 64), np.int32)
    np.cumsum(np.unpackbits(octets, axis=1, bitorder="little"), axis=0, out=votes[1:])
    set_ = (votes[size:] - votes[:-size]) * 2 > size
    return np.packbits(set_, axis=1, bitorder="little").view("<u8").ravel()


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the shingles; fewer words than ``width`` form one shingle as a whole."""
    return rolled(hashes, min(width, len(hashes))) if len(hashes) else np.zeros(0, np.uint64)


class Items:
    """A block of benchmark items with their shingles and the multi-index over their fingerprints."""

    def __init__(self, rows: list[tuple[int | None, bytes | None]], radius: int, shingle: int):
        hashes = WordHashes()
        kept = [(i, hashes.of(w)) for i, t in rows if (w := words_of(t.lower() if t else None))]
        self.ids = [i for i, _ in kept]
        self.sizes = np.array([len(h) for _, h in kept], np.int64)
        self.shingle, self.radius = shingle, radius
        self.grams = [shingles(h, shingle) for _, h in kept]
        self.counts = [Counter(g.tolist()) for g in self.grams]
        self.fingerprints = np.array([window_fingerprints(h, len(h))[0] for _, h in kept], np.uint64)
        # shingle -> items, for each shingle width (items shorter than a shingle have their own)
        self.anchors: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        for width in sorted({min(shingle, int(n)) for n in self.sizes}):
            chosen = [j for j, n in enumerate(self.sizes) if min(shingle, n) == width]
            pairs = sorted({(g, j) for j in chosen for g in self.grams[j].tolist()})
            keys = np.array([g for g, _ in pairs], np.uint64)
            items = np.array([j for _, j in pairs], np.int64)
            unique, first = np.unique(keys, return_index=True)
            screen = np.zeros(1 << 20, bool)
            screen[unique >> np.uint64(44)] = True
            self.anchors[width] = (screen, unique, np.append(first, len(keys)), items)
        masks = np.array(
            [sum(1 << b for b in bits) for t in range(radius // BLOCKS + 1) for bits in combinations(range(BLOCK_BITS), t)]
        )
        self.index = []
        for block in range(BLOCKS):
            own = self._part(self.fingerprints, block)
            near = (own[:, None] ^ masks[None, :]).ravel()
            order = np.argsort(near, kind="stable")
            starts = np.searchsorted(near[order], np.arange((1 << BLOCK_BITS) + 1))
            self.index.append((starts, (order // len(masks)).astype(np.int32)))

    @staticmethod
    def _part(fingerprints: np.ndarray, block: int) -> np.ndarray:
        return (fingerprints >> np.uint64(block * BLOCK_BITS)).astype(np.int64) & ((1 << BLOCK_BITS) - 1)

    def within(self, fingerprints: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) pairs within the radius, for items of ``size`` words."""
        found = []
        for block, (starts, items) in enumerate(self.index):
            value = self._part(fingerprints, block)
            n = starts[value + 1] - starts[value]
            window = np.repeat(np.arange(len(value)), n)
            at = np.arange(len(window)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[value], n)
            item = items[at]
            right = self.sizes[item] == size
            window, item = window[right], item[right]
            near = np.bitwise_count(fingerprints[window] ^ self.fingerprints[item]) <= self.radius
            found.append(window[near] * len(self.ids) + item[near])
        pairs = np.unique(np.concatenate(found))
        return pairs // len(self.ids), pairs % len(self.ids)

    def reaching(
        self, items: np.ndarray, spots: np.ndarray, length: int, real: int, width: int, least: float
    ) -> set[tuple[int, int]]:
        """(start, item) of all windows of ``real`` words that hold enough of an item's shingles to reach ``least``."""
        out: set[tuple[int, int]] = set()
        order = np.lexsort((spots, items))
        items, spots = items[order], spots[order]
        cuts = np.flatnonzero(np.append(True, items[1:] != items[:-1]))
        for a, b in zip(cuts, np.append(cuts[1:], len(items))):
            item, own = int(items[a]), spots[a:b]
            need = least * (real - width + 1 + len(self.grams[item])) / (1 + least) - 1e-9
            if b - a >= need:
                starts = np.arange(max(0, int(own[0]) - (real - width)), min(int(own[-1]), length - real) + 1)
                held = np.searchsorted(own, starts + real - width, "right") - np.searchsorted(own, starts)
                out.update((x, item) for x in starts[held >= need].tolist())
        return out

    def hits(self, hashes: np.ndarray, grams: dict[int, np.ndarray], at: dict[int, np.ndarray], least: float) -> dict:
        """Best ``(similarity, start, end)`` by item for one document; ``at`` has the places of item shingles by width."""
        best: dict[int, tuple[float, int, int]] = {}
        for width, places in at.items():
            _, unique, first, items = self.anchors[width]
            which = np.searchsorted(unique, grams[width][places])
            n = first[which + 1] - first[which]
            flat = np.repeat(first[which] - np.cumsum(n) + n, n) + np.arange(n.sum())
            anchored = np.stack((self.sizes[items[flat]], np.repeat(places, n)), 1)
            for size in np.unique(anchored[:, 0]).tolist():
                real = min(size, len(hashes))
                spots = np.unique(anchored[anchored[:, 0] == size, 1])
                # starts of the windows that hold a shingle at one of the spots
                low, high = np.maximum(spots - (real - width), 0), np.minimum(spots, len(hashes) - real)
                wanted = np.zeros(len(hashes) - real + 2, np.int32)
                np.add.at(wanted, low, 1)
                np.add.at(wanted, high + 1, -1)
                starts = np.flatnonzero(np.cumsum(wanted)[:-1] > 0)
                runs = np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1)
                here = anchored[:, 0] == size
                pairs = self.reaching(items[flat][here], anchored[here, 1], len(hashes), real, width, least)
                for run in (r[i : i + AT_ONCE] for r in runs for i in range(0, len(r), AT_ONCE)):
                    a, b = int(run[0]), int(run[-1])
                    near = zip(*self.within(window_fingerprints(hashes[a : b + real], real), size))
                    pairs.update((a + int(w), int(item)) for w, item in near)
                for start, item in sorted(pairs):
                    mine = Counter(grams[width][start : start + real - width + 1].tolist())
                    common = sum((mine & self.counts[item]).values())
                    together = mine.total() + self.counts[item].total() - common
                    similarity = common / together
                    old = best.get(item)
                    if similarity >= least and (old is None or similarity > old[0]):
                        best[item] = (similarity, start, start + real)
        return best

    def search(self, texts: list[bytes | None], table: WordHashes, least: float) -> list[dict]:
        """``hits`` of each text; a screen over all shingles of all texts tells which need a look."""
        lists = [words_of(t.lower() if t else None) for t in texts]
        sizes = np.array([len(x) for x in lists], np.int64)
        ends = np.cumsum(sizes)
        all_hashes = table.of([w for x in lists for w in x])
        row = np.repeat(np.arange(len(lists)), sizes)
        candidates: dict[int, dict[int, np.ndarray]] = {}
        for width, (screen, unique, _, _) in self.anchors.items():
            grams = rolled(all_hashes, width)
            spots = np.flatnonzero(screen[grams >> np.uint64(44)])
            at = np.minimum(np.searchsorted(unique, grams[spots]), len(unique) - 1)
            spots = spots[unique[at] == grams[spots]]
            spots = spots[spots + width <= ends[row[spots]]]
            for r in np.unique(row[spots]).tolist():
                candidates.setdefault(r, {})[width] = spots[row[spots] == r] - (ends[r] - sizes[r])
        out: list[dict] = [{} for _ in texts]
        for r, at in candidates.items():
            own = all_hashes[ends[r] - sizes[r] : ends[r]]
            out[r] = self.hits(own, {w: rolled(own, w) for w in at}, at, least)
        return out


def _blocks(benchmark: DataFrame, item_id: str, text: str, radius: int, shingle: int) -> Iterator[Items]:
    """The benchmark in blocks of BLOCK_WORDS words, read one after the other; one item may exceed that by itself."""
    rows = benchmark.select(benchmark[item_id].cast("long").alias("i"), benchmark[text].cast("binary").alias("t"))
    block: list = []
    size = 0
    for i, t in rows.toLocalIterator():
        t = bytes(t) if t is not None else None
        block.append((i, t))
        size += len(words_of(t))
        if size >= BLOCK_WORDS:
            yield Items(block, radius, shingle)
            block, size = [], 0
    if size:
        yield Items(block, radius, shingle)


def benchmark_hits(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", similarity: float = 0.8, radius: int = 15, shingle: int = 5,
) -> DataFrame:
    """``doc_id, item_id, similarity, start, end``: the best window (word positions) of every item in every document.

    Words are compared in lower case (A-Z). A document shorter than an item is compared as a whole. Null, empty and
    blank texts and items match nothing; repeated rows and items match each; null ids are kept; other columns are
    ignored; an empty table on either side gives an empty result.
    """
    docs = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
    schema = "doc_id long, item_id long, similarity double, start long, end long"
    parts = []
    for items in _blocks(benchmark, item_id, item_text, radius, shingle):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[dict]:
            table = WordHashes()
            for batch in slices(batches, "text"):
                ids = batch.column("doc_id").to_pylist()
                found = shared.value.search(batch.column("text").to_pylist(), table, similarity)
                rows = [(d, shared.value.ids[i], *h) for d, f in zip(ids, found) for i, h in sorted(f.items())]
                yield dict(zip(("doc_id", "item_id", "similarity", "start", "end"), zip(*rows) if rows else [[]] * 5))

        parts.append(in_arrow(docs, run, schema))
    return reduce(DataFrame.unionAll, parts) if parts else docs.sparkSession.createDataFrame([], schema)


def without_benchmark(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    similarity: float = 0.8, radius: int = 15, shingle: int = 5,
) -> DataFrame:
    """The rows of ``docs`` in which no item is found, all columns as they are. One pass, no shuffle."""
    for items in _blocks(benchmark, item_id, item_text, radius, shingle):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            table = WordHashes()
            for batch in batches:
                for start in range(0, batch.num_rows, 512):
                    part = batch.slice(start, 512)
                    texts = part.column(text).cast(pa.large_binary()).to_pylist()
                    clean = [not f for f in shared.value.search(texts, table, similarity)]
                    yield part.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
