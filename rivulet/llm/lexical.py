"""Ranked lexical search: for each query the documents with the highest term-weight scores, by the NRA method.

One pass over the texts keeps of each document its length and how often it holds each query term; document frequencies
and totals are sums over these. Scores need the totals, so they are made in a second pass, over that small table only.

There, documents come in blocks. A block is an index of its own: for each term a list of postings sorted by impact. NRA
(no random access) reads the lists of a query in order of impact, level by level. What was read of a document is a lower
bound of its score; with the next unread impact of every list in which it was not met it makes an upper bound. A
document whose upper bound lies below the last place's lower bound is out. Reading ends once the documents that remain
have closed intervals, so membership, ties and scores are exact. The last place carries over from block to block of a
task, so later blocks mostly end early. Each task returns its best documents per query, and the best of those win:
nothing but these is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .common import in_arrow, slices

#: Distinct terms of the queries that are searched together; more queries take further rounds.
MOST_TERMS = 1 << 18
#: Documents and postings of a block.
BLOCK_DOCUMENTS, BLOCK_POSTINGS = 1 << 14, 1 << 22
#: By how much a level of impacts lies below the one before.
LEVEL = 0.6
#: The least id stands for null.
NULL_ID = -(1 << 63)

_TERM = np.zeros(256, bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def terms_of(texts: list[bytes | None]) -> tuple[pa.BinaryArray, np.ndarray]:
    """All terms of some texts, lower-cased (A-Z), in order, and the text each is from."""
    values = [t or b"" for t in texts]
    data = np.frombuffer(b" ".join(values), np.uint8)
    sizes = np.fromiter(map(len, values), np.int64, len(values))
    first = np.cumsum(sizes + 1) - sizes - 1
    held = _TERM[data]
    edge = np.diff(held.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    offsets = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int32)
    letters = np.ascontiguousarray(_LOWER[data[held]])
    found = pa.BinaryArray.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    return found, np.searchsorted(first, start, "right") - 1


def term_counts(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """``doc_id, n, terms, counts`` for documents with a term: all terms counted (n), and how often each of the given
    ones occurs (numbers and counts as packed int32)."""
    spark = docs.sparkSession
    wanted = spark.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        names = pa.array(wanted.value, pa.binary())
        for batch in slices(batches, "text"):
            found, row = terms_of(batch.column("text").to_pylist())
            n = np.bincount(row, minlength=batch.num_rows)
            number = pc.index_in(found, value_set=names)
            met = np.asarray(pc.is_valid(number))
            keys, counts = np.unique(
                row[met] * len(names) + np.asarray(pc.drop_null(number)).astype(np.int64), return_counts=True
            )
            row, number = keys // max(len(names), 1), keys % max(len(names), 1)
            held = np.flatnonzero(n)
            cuts = np.searchsorted(row, np.append(held, batch.num_rows))
            number, counts = number.astype(np.int32), counts.astype(np.int32)
            yield {
                "doc_id": batch.column("doc_id").take(pa.array(held)), "n": n[held],
                "terms": [number[a:b].tobytes() for a, b in zip(cuts, cuts[1:])],
                "counts": [counts[a:b].tobytes() for a, b in zip(cuts, cuts[1:])],
            }

    return in_arrow(docs, run, "doc_id long, n long, terms binary, counts binary")


def document_frequencies(counted: DataFrame, n_terms: int) -> np.ndarray:
    """In how many documents each term occurs; one row a term reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        out = np.zeros(n_terms, np.int64)
        for batch in batches:
            out += np.bincount(np.frombuffer(b"".join(batch.column("terms").to_pylist()), np.int32), minlength=n_terms)
        met = np.flatnonzero(out)
        yield {"term": met, "df": out[met]}

    table = in_arrow(counted.select("terms"), run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    out = np.zeros(n_terms, np.int64)
    out[np.asarray(table.column("term"))] = np.asarray(table.column("df"))
    return out


class _Block:
    """Impact-sorted lists of the terms over some documents, and the bounds of NRA over them."""

    def __init__(self, ids: np.ndarray, doc: np.ndarray, term: np.ndarray, gain: np.ndarray, n_terms: int):
        self.ids = ids
        order = np.lexsort((doc, -gain, term))
        self.doc, self.gain = doc[order], gain[order]
        self.cut = np.searchsorted(term[order], np.arange(n_terms + 1))
        self.lower = np.zeros(len(ids), np.int64)

    def best(self, terms: np.ndarray, top: int, floor: tuple[int, int] | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the block's documents among the ``top`` of the query, none that ``floor`` (score, id) beats."""
        at, end = self.cut[terms].copy(), self.cut[terms + 1]
        some = end > at
        at, end = at[some], end[some]
        none = np.zeros(0, np.int64)
        if not len(at):
            return none, none
        lower = self.lower
        lower[:] = 0
        met = np.zeros((len(at), len(lower)), bool)
        head = self.gain[at]
        alive = np.ones(len(lower), bool)
        level = int(head.max())
        least = floor[0] if floor else 1
        while True:
            level = int(level * LEVEL)
            for t in range(len(at)):  # sequential reads down to the level
                if at[t] < end[t] and self.gain[at[t]] >= level:
                    more = at[t] + np.searchsorted(-self.gain[at[t] : end[t]], -level, "right")
                    docs = self.doc[at[t] : more]
                    lower[docs] += self.gain[at[t] : more]
                    met[t, docs] = True
                    at[t] = more
                head[t] = self.gain[at[t]] if at[t] < end[t] else 0
            if np.count_nonzero(alive) > top:
                least = max(least, int(np.partition(lower, len(lower) - top)[len(lower) - top]))
            rest = int(head.sum())
            open_ = np.flatnonzero(alive)
            upper = lower[open_] + (rest - head @ met[:, open_] if rest else 0)
            alive[open_[upper < least]] = False
            kept = upper >= least
            if (upper[kept] == lower[open_[kept]]).all():
                break
        kept = np.flatnonzero(alive)
        kept = kept[np.lexsort((self.ids[kept], -lower[kept]))][:top]
        return self.ids[kept], lower[kept].copy()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    kept, rows, postings = [], 0, 0
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            kept.append(part)
            rows += part.num_rows
            postings += part.column("terms").nbytes // 4
            if rows >= BLOCK_DOCUMENTS or postings >= BLOCK_POSTINGS:
                yield pa.Table.from_batches(kept)
                kept, rows, postings = [], 0, 0
    if kept:
        yield pa.Table.from_batches(kept)


def _search(docs: DataFrame, queries: list[np.ndarray], terms: list[bytes], first: int, top: int) -> DataFrame:
    """``query, doc_id, score``: each task's best documents for each query; queries are numbered from ``first``."""
    counted = written(term_counts(docs, terms), "term_counts")
    n_docs, n_all = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = document_frequencies(counted, len(terms))
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)
    shared = docs.sparkSession.sparkContext.broadcast((queries, weight))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        queries, weight = shared.value
        found: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for table in _blocks(batches):
            ids = np.asarray(pc.fill_null(table.column("doc_id"), NULL_ID))
            n = np.asarray(table.column("n"))
            parts = table.column("terms").to_pylist()
            term = np.frombuffer(b"".join(parts), np.int32)
            tf = np.frombuffer(b"".join(table.column("counts").to_pylist()), np.int32).astype(np.int64)
            doc = np.repeat(np.arange(len(parts)), [len(x) // 4 for x in parts])
            m = 50 + np.array([50 * int(x) * n_docs // n_all for x in n], np.int64)  # 100 - 50 + ...
            gain = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc]))
            block = _Block(ids, doc, term, gain, len(weight))
            for q, wanted in enumerate(queries):
                old = found.get(q)
                full = old is not None and len(old[0]) == top
                new = block.best(wanted, top, (int(old[1][-1]), int(old[0][-1])) if full else None)
                if old is not None:
                    new = tuple(map(np.concatenate, zip(old, new)))
                order = np.lexsort((new[0], -new[1]))[:top]
                found[q] = new[0][order], new[1][order]
        for q, (ids, scores) in found.items():
            if len(ids):
                yield {"query": np.full(len(ids), q + first), "doc_id": pa.array(ids, mask=ids == NULL_ID), "score": scores}

    return in_arrow(counted, run, "query long, doc_id long, score long")


def search(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", top: int = 50, most_terms: int = MOST_TERMS,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: for each row of ``items`` its ``top`` best documents, best first.

    Terms are runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased. A term's weight is
    ``floor(1000 * ln((2N + 2) / (2df + 1)))``; a document gains ``weight * ((10**9 * tf) div (1000 * tf + 20 * m))`` from
    each distinct term of the item, with ``m = 50 + (50 * n * N) div L``. Only scores above 0 are returned; equal scores
    are ordered by id, null ids first; repeated documents are ranked each, and so are items with one id. Null and empty
    texts have no terms. Other columns are ignored; no documents or no items give an empty result.

    Items are read by the driver (they are queries, not a corpus); those with more than ``most_terms`` distinct terms
    in all are searched in several rounds, each over all documents. Runs jobs and stores a table in the shared folder.
    """
    spark = docs.sparkSession
    docs = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
    asked = items.select(items[item_id].alias("item_id"), items[item_text].cast("string").alias("text"))
    names: list = []
    rounds: list[tuple[int, list[np.ndarray], dict[bytes, int]]] = []
    for row in asked.toLocalIterator():
        wanted = set(terms_of([(row["text"] or "").encode()])[0].to_pylist())
        if not rounds or rounds[-1][1] and len(rounds[-1][2].keys() | wanted) > most_terms:
            rounds.append((len(names), [], {}))
        _, queries, numbers = rounds[-1]
        queries.append(np.array(sorted(numbers.setdefault(x, len(numbers)) for x in wanted), np.int64))
        names.append(row["item_id"])
    found = None
    for first, queries, numbers in rounds:
        part = _search(docs, queries, list(numbers), first, top)
        found = part if found is None else found.unionAll(part)
    if found is None:
        found = spark.createDataFrame([], "query long, doc_id long, score long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    kind = asked.schema["item_id"].dataType.simpleString()
    titles = spark.createDataFrame(list(enumerate(names)), f"query long, item_id {kind}")
    return ranked.join(titles, "query").select("item_id", "rank", "doc_id", "score")
