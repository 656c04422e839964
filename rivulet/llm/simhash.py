"""SimHash near-duplicates: fingerprints, and the groups they form when they differ in a few bits.

Fingerprints are searched by the generalised pigeonhole principle: the 64 bits are dealt into parts, correlated bits
into the same part, and each fingerprint gets a threshold for each part (-1: not searched) such that the thresholds
plus one sum up to the radius plus one. Whatever differs from it in at most ``radius`` bits then differs in some part in
no more than that part's threshold, so looking up all values within the thresholds finds it. A dynamic programme picks
the thresholds with the fewest expected candidates, from how full each fingerprint's own values are and from how a
bounded sample spreads; candidates are verified on all 64 bits.

A value shared by more than CROWD fingerprints is not paired up. Its fingerprints, and those that look it up, are linked
through centres instead: two fingerprints differ in at most two bits exactly if some third value differs in at most one
bit from both. Each of them names its 65 centres, and a centre links what names it to one of them.

Groups are connected components of fingerprints, found by alternating large-star and small-star steps on tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import discard, written
from .common import in_arrow, slices, words_of

BITS = 64
#: Fingerprints that take part in choosing the parts and in estimates; the results do not depend on them.
SAMPLE = 4096
#: Fingerprints that may share a value and still be paired with those that look it up.
CROWD = 64
#: Shingles whose bits are summed at once.
SUMMED = 1 << 16


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """A bit is set if it is set in over half of the hashes of the shingles, repeats included; no words: zero."""
    words = words_of(text.lower() if text else None)
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, 42)
    digest = xxhash.xxh64_intdigest
    starts = np.cumsum([0] + [len(w) + 1 for w in words])
    pairs = zip(starts[: -shingle].tolist(), (starts[shingle:] - 1).tolist())
    hashes = np.array([digest(joined[a:b], 42) for a, b in pairs], np.uint64)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), SUMMED):
        octets = hashes[at : at + SUMMED].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """``doc_id, fp`` (64 bits in a long) for every row."""
    docs = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in slices(batches, "text"):
            values = np.array([fingerprint(t, shingle) for t in batch.column("text").to_pylist()], np.uint64)
            yield {"doc_id": batch.column("doc_id"), "fp": values.view(np.int64)}

    return in_arrow(docs, run, "doc_id long, fp long")


def choose_parts(sample: np.ndarray, count: int) -> list[list[int]]:
    """Bits dealt into ``count`` parts of near-equal size, each part gathering bits that go together."""
    bits = np.unpackbits(sample.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(float)
    spread = bits - bits.mean(0) if len(bits) else np.zeros((1, BITS))
    scale = np.sqrt((spread**2).sum(0)) + 1e-9
    related = np.abs(spread.T @ spread) / scale[:, None] / scale[None, :]
    np.fill_diagonal(related, 0)
    left, parts = list(range(BITS)), []
    for k in range(count):
        size = len(left) // (count - k)
        part = [max(left, key=lambda b: (related[b, left].sum(), -b))]
        left.remove(part[0])
        while len(part) < size:
            best = max(left, key=lambda b: (related[b, part].sum(), -b))
            part.append(best)
            left.remove(best)
        parts.append(sorted(part))
    return parts


def part_count(distinct: int, radius: int) -> int:
    """How many parts cost least on evenly spread fingerprints: look-ups plus expected candidates of each one."""

    def cost(m: int) -> float:
        width, extra = BITS // m, max(0, radius + 1 - m)
        lookups = m if extra == 0 else (m - 1) + sum(len(list(combinations(range(width), t))) for t in range(extra + 1))
        return lookups * (1 + distinct / 2.0**width)

    return min(range(2, radius + 2), key=cost)


def thresholds(crowds: np.ndarray, widths: list[int], near: np.ndarray, radius: int, total: int) -> np.ndarray:
    """For each row of ``crowds`` (how many share the row's value in each part), the best threshold of each part.

    ``near[part, t]`` is the share of sampled pairs within ``t`` bits in that part. Costs are look-ups plus expected
    candidates; the programme goes over the parts and the units (threshold plus one) given out so far.
    """
    n, parts = crowds.shape
    units = radius + 1
    best = np.full((n, units + 1), np.inf)
    best[:, 0] = 0
    choice = np.zeros((parts, n, units + 1), np.int8)
    for part in range(parts):
        lookups, price = 0, [np.zeros(n)]
        for t in range(radius + 1):
            lookups += len(list(combinations(range(widths[part]), t)))
            price.append(lookups + np.maximum(crowds[:, part], near[part, t] * total))
        nxt = np.full_like(best, np.inf)
        for given in range(units + 1):
            for here in range(units + 1 - given):
                cost = best[:, given] + price[here]
                better = cost < nxt[:, given + here]
                nxt[better, given + here] = cost[better]
                choice[part, better, given + here] = here
        best = nxt
    out, at = np.zeros((n, parts), np.int64), np.full(n, units)
    for part in reversed(range(parts)):
        here = choice[part, np.arange(n), at]
        out[:, part], at = here - 1, at - here
    return out


def _masks(width: int, most: int) -> np.ndarray:
    """All values of ``width`` bits with at most ``most`` set, those with fewer first."""
    return np.array([sum(1 << b for b in bits) for t in range(most + 1) for bits in combinations(range(width), t)], np.int64)


def _value(part: list[int]) -> Column:
    """The bits of ``fp`` named by ``part``, packed."""
    value = F.lit(0).cast("long")
    for place, bit in enumerate(part):
        value = value.bitwiseOR(F.shiftleft(F.shiftrightunsigned("fp", bit).bitwiseAND(F.lit(1).cast("long")), place))
    return value


def near_links(distinct: DataFrame, radius: int = 2) -> DataFrame:
    """``a, b``: links of distinct fingerprints (column ``fp``) whose components are those of all pairs within ``radius``.

    Up to CROWD sharers of a value every close pair is a link; beyond, links go through centres (radius 2 at most).
    ``distinct`` is read several times, so it should be a stored table.
    """
    if radius > 2:
        raise ValueError("centres link fingerprints that differ in at most two bits")
    total = distinct.count()
    rows = distinct.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).toArrow()
    sample = np.asarray(rows.column("fp")).view(np.uint64)
    parts = choose_parts(sample, part_count(total, radius))
    widths = [len(p) for p in parts]
    near = np.zeros((len(parts), radius + 1))
    half = len(sample) // 2
    for i, part in enumerate(parts):
        mask = np.uint64(sum(1 << b for b in part))
        apart = np.bitwise_count((sample[:half] ^ sample[half : 2 * half]) & mask)
        near[i] = [np.mean(apart <= t) if half else 0 for t in range(radius + 1)]

    values = distinct.select("fp", *[_value(p).alias(f"v{i}") for i, p in enumerate(parts)])
    index = values.select(
        "fp", F.posexplode(F.array(*[f"v{i}" for i in range(len(parts))])).alias("part", "value")
    )
    index = written(index, "simhash_index")
    crowds = written(index.groupBy("part", "value").agg(F.count("*").alias("crowd")), "simhash_crowds")
    indexed = index.join(crowds, ["part", "value"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        masks = [[_masks(w, t) for t in range(radius + 1)] for w in widths]
        for batch in batches:
            fp = np.asarray(batch.column("fp"))
            crowd = np.array(batch.column("crowds").to_pylist(), float)
            own = np.array(batch.column("values").to_pylist(), np.int64)
            limits = thresholds(crowd, widths, near, radius, total)
            for part in range(len(parts)):
                for t in range(radius + 1):
                    chosen = np.flatnonzero(limits[:, part] == t)
                    if len(chosen):
                        looked = own[chosen, part][:, None] ^ masks[part][t][None, :]
                        n = looked.shape[1]
                        yield {
                            "probe": np.repeat(fp[chosen], n), "part": np.full(len(chosen) * n, part),
                            "value": looked.ravel(),
                        }

    by_fp = indexed.groupBy("fp").agg(
        *[F.max(F.when(F.col("part") == i, F.col("crowd"))).alias(f"c{i}") for i in range(len(parts))],
        *[F.max(F.when(F.col("part") == i, F.col("value"))).alias(f"v{i}") for i in range(len(parts))],
    ).select(
        "fp", F.array(*[f"c{i}" for i in range(len(parts))]).alias("crowds"),
        F.array(*[f"v{i}" for i in range(len(parts))]).alias("values"),
    )
    probes = in_arrow(by_fp, probe, "probe long, part int, value long")
    probes = written(probes.join(crowds, ["part", "value"]), "simhash_probes")

    small = indexed.filter(F.col("crowd") <= CROWD).select("part", "value", "fp")
    pairs = probes.filter(F.col("crowd") <= CROWD).join(small, ["part", "value"])
    pairs = pairs.filter(
        (F.col("probe") != F.col("fp")) & (F.bit_count(F.col("probe").bitwiseXOR(F.col("fp"))) <= radius)
    ).select(F.least("probe", "fp").alias("a"), F.greatest("probe", "fp").alias("b"))

    crowded = indexed.filter(F.col("crowd") > CROWD).select("fp").union(
        probes.filter(F.col("crowd") > CROWD).select(F.col("probe").alias("fp"))
    ).distinct()
    bits = F.array(F.lit(0).cast("long"), *[F.lit(1 << b if b < 63 else -(1 << 63)).cast("long") for b in range(BITS)])
    reach = crowded.select("fp", F.explode(bits if radius == 2 else bits[0:1]).alias("bit"))
    named = reach.select("fp", F.col("fp").bitwiseXOR(F.col("bit")).alias("centre"))
    heads = named.groupBy("centre").agg(F.min("fp").alias("a"), F.count("*").alias("n")).filter("n > 1")
    centred = named.join(heads, "centre").select("a", F.col("fp").alias("b")).filter("a != b")
    return pairs.union(centred).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root``: for every node of the undirected ``links`` (a, b) the least node of its component.

    Each round stores its edges in the shared folder, so lineage stays short, and deletes those of the round before; the
    stored table of the last round is what the result reads.
    """
    edges = written(links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "edges")
    state = None
    while True:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select("lo", "hi"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi")
        small = small.filter("lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).union(
            least.select("hi", F.col("m").alias("lo"))
        )
        before, edges = edges, written(small.distinct(), "edges")
        discard(before)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = edges.groupBy("hi").agg(F.min("lo").alias("root")).withColumnRenamed("hi", "node")
    return roots.union(edges.select("lo", "lo").distinct())


def near_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 2,
) -> DataFrame:
    """``doc_id, fp, component_id`` for every row: its fingerprint and the least id of the documents it hangs together with.

    Words are compared in lower case (A-Z). Null, empty and blank texts have the fingerprint zero and are linked like
    any other. A null id takes part but is never a component's id unless the component has no other. Repeated rows and
    ids appear as often as they come; other columns are ignored; an empty table gives an empty result. The fingerprints
    are stored when this is called.
    """
    marked = written(fingerprints(docs, doc_id, text, shingle), "fingerprints")
    distinct = written(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct_fingerprints")
    roots = components(near_links(distinct, radius)).withColumnRenamed("node", "fp")
    placed = distinct.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = placed.join(ids, "root").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")
